"""Training-set preparation: clean -> drop -> merge rare -> combine -> oversample -> weight -> encode.

All per-class decisions (rare merge, oversampling factors, weights, codes) are computed on the
label-triple table, which a partial aggregate builds from the label columns alone. Rows meet that
table in one join on the original triple, then three narrow explodes make the copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.operators import augment as A
from tixprep.operators import classes as C
from tixprep.operators import fields as FL
from tixprep.session import cut_lineage, label_table

T = S.TARGETS


def base_rows(tickets: DataFrame, variant: str = "basic") -> DataFrame:
    """Fill and clean the two text fields, drop rows without all three targets."""
    d = FL.fill_defaults(tickets, "main", cols=S.TEXT_FIELDS)
    d = FL.clean_columns(d, S.TEXT_FIELDS, variant)
    return FL.drop_missing_targets(d)


def triple_plan(rows: DataFrame, targets: Sequence[str] = T, min_count: int = S.MIN_SAMPLES,
                oversample: bool = True) -> DataFrame:
    """Per original triple: merged labels, copy factors, sample weight and label codes.

    The triple table (one row per observed label combination, built by a partial aggregate of the
    label columns only) is written once to the checkpoint folder; everything after it is a linear
    chain of window aggregates over that small table (class totals partitioned by label), so the
    row-side scan never runs again for the plan."""
    tri = cut_lineage(C.triple_counts(rows, targets))
    mm = C.merge_map(tri, targets, min_count)
    mcols = ["m_" + t for t in targets]
    merged = mm.groupBy(*mcols).agg(F.sum("n").alias("n"))
    merged = merged.select(*[F.col("m_" + t).alias(t) for t in targets], "n")
    if oversample:
        fac = A.oversample_factors(merged, targets)
    else:
        fac = merged.select(*targets, "n", *[F.lit(1).alias(f"f{k + 1}") for k in range(3)],
                            F.col("n").alias("n_final"))
    w = C.with_level_weights(fac.withColumn("n_in", F.col("n")).withColumn("n", F.col("n_final")), targets)
    g = F.pow(F.col("_w0") * F.col("_w1") * F.col("_w2"), F.lit(1.0 / 3.0))
    plan = w.withColumn("sample_weight", F.least(F.lit(S.MAX_WEIGHT), F.greatest(F.lit(1.0), g)))
    for t in targets:  # code = rank among distinct labels (dense_rank over the triple table)
        plan = plan.withColumn(t + "_code", (F.dense_rank().over(Window.orderBy(t)) - 1).cast("int"))
    plan = plan.drop("_w0", "_w1", "_w2").withColumn("n", F.col("n_in")).drop("n_in")
    # back to the original (un-merged) triple key
    plan = plan.select(*[F.col(t).alias("m_" + t) for t in targets], *[c for c in plan.columns if c not in targets])
    return mm.select(*targets, *mcols).join(plan, on=mcols, how="left")


def sample_keys(tickets: DataFrame) -> DataFrame:
    """(src_id, aug_no, labels) of every row of ``prepare_training_set``, without moving or editing a text: copies follow
    from the labels alone."""
    rows = cut_lineage(FL.drop_missing_targets(tickets.select(S.NUMBER, *T)))
    plan = cut_lineage(triple_plan(rows, T))
    d = rows.join(plan, on=list(T), how="left").select(F.col(S.NUMBER).alias("src_id"), *[F.col("m_" + t).alias(t) for t in T], "f1", "f2", "f3")
    for k in (1, 2, 3):
        d = d.withColumn(f"_i{k}", F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"f{k}"), F.lit(1)) - 1)))
    return d.select("src_id", F.concat_ws(".", *[F.col(f"_i{k}").cast("string") for k in (1, 2, 3)]).alias("aug_no"), *T)


def prepare_training_set(tickets: DataFrame, lexicon: DataFrame | None, oversample: bool = True,
                         field_aware: bool = False, seed: int = A.SEED) -> DataFrame:
    """Samples table: (src_id, aug_no, text, three labels, three codes, sample_weight)."""
    rows = base_rows(tickets)
    # Both small tables are written once, so that their real size is known: the plan by labels is sent to the
    # long-text rows up to ``LABEL_TABLE_MB``, the lexicon up to spark.sql.autoBroadcastJoinThreshold.
    plan = label_table(triple_plan(rows, T, oversample=oversample))
    if lexicon is not None:
        lexicon = cut_lineage(lexicon)
    d = rows.join(plan, on=list(T), how="left")
    d = d.select(*[c for c in d.columns if c not in T and not c.startswith("m_") and c not in ("n", "n_final")],
                 *[F.col("m_" + t).alias(t) for t in T])
    d = FL.fill_defaults(d, "main")
    d = FL.combine_text7(d, "combined_text")
    # only what the result holds goes on: the chain writes its rows once
    d = d.select(S.NUMBER, "combined_text", *T, *[t + "_code" for t in T], "sample_weight", "f1", "f2", "f3",
                 *([S.SHORT, S.DESC, *S.META_FIELDS] if field_aware else []))
    if oversample:
        d = A.oversample_chain(d, lexicon, "combined_text", S.NUMBER, T, factors="attached",
                               field_aware=field_aware, seed=seed)
    else:
        d = d.withColumn("aug_no", F.lit("0.0.0")).drop("f1", "f2", "f3")
    cols = [F.col(S.NUMBER).alias("src_id"), "aug_no", F.col("combined_text").alias("text"), *T,
            *[t + "_code" for t in T], "sample_weight"]
    if field_aware:
        cols += [S.SHORT, S.DESC, *S.META_FIELDS]
    return d.select(*cols)
