"""Label dictionaries, encode/decode joins, fixed-length token ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.functions.text import tokenize_words
from tixprep.operators.ranking import range_rank
from tixprep.session import dimension


def label_dictionary(df: DataFrame, targets: Sequence[str] = S.TARGETS) -> DataFrame:
    """(target, code, label): code = 0-based rank of the label in sorted (code-point) order.

    Built from distinct labels (a partial aggregate per target) and ranked inside each target;
    the window partitions only the small distinct-label table."""
    parts = None
    for t in targets:
        p = df.select(F.lit(t).alias("target"), F.col(t).cast("string").alias("label")).filter(F.col("label").isNotNull())
        parts = p if parts is None else parts.unionByName(p)
    d = parts.distinct()
    w = Window.partitionBy("target").orderBy("label")
    return d.select("target", (F.dense_rank().over(w) - 1).cast("int").alias("code"), "label")


def label_sizes(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("target").agg(F.count(F.lit(1)).alias("n_classes"))


def encode_labels(df: DataFrame, dictionary: DataFrame, targets: Sequence[str] = S.TARGETS,
                  suffix: str = "_code") -> DataFrame:
    """Attach the code of each target label (one join per target with its dictionary slice)."""
    out = df
    dictionary = dimension(dictionary)
    for t in targets:
        d = dictionary.filter(F.col("target") == t).select(F.col("label").alias(t), F.col("code").alias(t + suffix))
        out = out.join(d, on=t, how="left")
    return out


def label_decode(df: DataFrame, dictionary: DataFrame, code_cols: dict[str, str], model: str | None = None,
                 strict: bool = False) -> DataFrame:
    """code -> label for each ``{target: code column}``; optional ``model`` selects a dictionary. A
    code that the dictionary lacks gives a null label, or an error if ``strict``."""
    out = df
    dictionary = dimension(dictionary)
    for t, c in code_cols.items():
        d = dictionary.filter(F.col("target") == t)
        if model is not None:
            d = d.filter(F.col("model") == model)
        d = d.select(F.col("code").alias(c), F.col("label").alias(f"{t}_label"))
        out = out.join(d, on=c, how="left")
        if strict:
            missing = F.raise_error(F.concat(F.lit(f"no {t} label for code "), F.col(c).cast("string"))).cast("string")
            out = out.withColumn(f"{t}_label", F.when(F.col(c).isNotNull() & F.col(f"{t}_label").isNull(), missing).otherwise(F.col(f"{t}_label")))
    return out


def dual_dictionary(main: DataFrame, rare: DataFrame) -> DataFrame:
    """Two dictionaries side by side, keyed by (model, target, code)."""
    return main.select(F.lit("main").alias("model"), "*").unionByName(rare.select(F.lit("rare").alias("model"), "*"))


def vocabulary(df: DataFrame, text_col: str, reserved: int = 2) -> DataFrame:
    """(word, token_id): ids by descending frequency then word; 0 = padding, 1 = unknown."""
    words = df.select(F.explode(tokenize_words(F.col(text_col))).alias("word"))
    cnt = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # exact dense numbering in (n desc, word) order: range partitions, no single-partition window
    r = range_rank(cnt, [F.col("n").desc(), F.col("word")], out="_r")
    return r.select("word", (F.col("_r") - 1 + reserved).cast("int").alias("token_id"))


def encode_fixed_length(df: DataFrame, text_col: str, vocab: DataFrame, id_col: str,
                        max_length: int = S.MAX_LENGTH, pad_id: int = 0, unk_id: int = 1) -> DataFrame:
    """Words -> ids, cut or padded to ``max_length``, plus an attention mask.

    Only the first ``max_length`` word positions are exploded and looked up, so a long text costs
    ``max_length`` rows, and the regroup is bounded by ``max_length`` per row."""
    pos = df.select(id_col, F.posexplode(F.slice(tokenize_words(F.col(text_col)), 1, max_length)).alias("pos", "word"))
    ids = pos.join(vocab, on="word", how="left").select(
        id_col, "pos", F.coalesce("token_id", F.lit(unk_id)).alias("tid"))
    grouped = ids.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "tid"))).alias("_p"))
    seq = F.transform(F.col("_p"), lambda s: s["tid"])
    out = df.join(grouped, on=id_col, how="left").withColumn("_ids", F.coalesce(seq, F.array().cast("array<int>")))
    k = F.size("_ids")
    pad = F.array_repeat(F.lit(pad_id), F.lit(max_length) - k)
    return out.select(
        *df.columns,
        F.concat("_ids", pad).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), k), F.array_repeat(F.lit(0), F.lit(max_length) - k)).alias("attention_mask"),
    )


def truncation_rate(df: DataFrame, text_col: str, max_length: int = S.MAX_LENGTH) -> DataFrame:
    n = F.size(tokenize_words(F.col(text_col)))
    return df.agg(F.avg((n > max_length).cast("double")).alias("truncation_rate"),
                  F.count(F.lit(1)).alias("n_texts"))
