"""Synonym lexicon, seeded text edits, oversampling and rare-class augmentation.

Randomness: every random choice is ``uniform(seed, key, tag)`` over the row's lineage key
(``src_id`` plus copy indices), so a copy's text is the same on every run, after any retry, and
independent of partitioning. Lexicon look-ups are joins on the selected word only — never an
explode-and-regroup of whole texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.functions.hashing import TWO32, hash32, uniform
from tixprep.functions.text import ALPHA_WORD, normalize_space, nz, split_fields, tokenize_words, words_of_normal
from tixprep.operators.classes import over_all
from tixprep.session import cut_lineage, dimension, label_table

SEED = 7  # default augmentation seed


# --- lexicon ---------------------------------------------------------------------------------

def synonym_lexicon(pairs: DataFrame, synset_col: str = "synset", lemma_col: str = "lemma") -> DataFrame:
    """(word, synonyms): every lemma sharing a synset with the word, lower-cased with '_' -> ' ',
    excluding the word itself; sorted for determinism. Groups are synsets (bounded size)."""
    p = pairs.select(F.col(synset_col).alias("synset"), F.col(lemma_col).alias("lemma"))
    groups = p.groupBy("synset").agg(
        F.collect_set(F.lower(F.regexp_replace("lemma", "_", " "))).alias("members"), F.collect_set(F.lower("lemma")).alias("words"))
    j = groups.filter(F.col("synset").isNotNull()).select(F.explode("words").alias("word"), "members")
    out = j.groupBy("word").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("members")))).alias("syns"))
    out = out.select("word", F.filter("syns", lambda x: x != F.col("word")).alias("synonyms"))
    return out.filter(F.size("synonyms") > 0)


def vocabulary_synsets(texts: DataFrame, text_col: str, per_synset: int = 3, seed: int = SEED) -> DataFrame:
    """(synset, lemma) derived from the words of a text column: the distinct alphabetic words
    longer than 3 characters are hashed into ``V / per_synset`` synsets. Stands in for a lexical
    database (none is available offline); group sizes stay small as the vocabulary grows."""
    words = texts.select(F.explode(tokenize_words(F.lower(F.col(text_col)))).alias("lemma"))
    # written once: the texts are exploded for the words, not again for their number and their groups
    vocab = cut_lineage(words.filter(F.col("lemma").rlike(ALPHA_WORD) & (F.length("lemma") > 3)).distinct())
    n_sets = vocab.select(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / per_synset))).scalar()
    return vocab.select((hash32(seed, F.col("lemma"), "synset") % n_sets).alias("synset"), "lemma")


# --- single edits ----------------------------------------------------------------------------

def _lookup(df: DataFrame, lexicon: DataFrame, word: Column, key_col: str) -> DataFrame:
    """Left-join the synonym list of ``word``; rows with no word get a unique non-matching key so
    they spread evenly instead of piling onto the null-key partition."""
    k = F.coalesce(word, F.concat(F.lit("\u0000"), F.col(key_col).cast("string")))
    lx = lexicon.select(F.col("word").alias("_lw"), F.col("synonyms").alias("_syns"))
    return df.withColumn("_lk", k).join(lx, F.col("_lk") == F.col("_lw"), "left").drop("_lk", "_lw")


def one_word_synonyms(lexicon: DataFrame) -> bool:
    """Whether every synonym is one word as the tokenizer cuts words and holds no field separator. Then an edit keeps the
    number of words and their places, so that all words to look up are known before the first edit."""
    mark = S.SEP.strip()
    odd = F.exists("synonyms", lambda x: x.isNull() | (x == "") | (normalize_space(x) != x) | x.contains(" ") | x.contains(mark))
    return lexicon.filter(F.coalesce(odd, F.lit(False))).isEmpty()


def _numbered(df: DataFrame) -> DataFrame:
    """``df``, written once, with a number of its own for every row (``_rid``): keys may repeat or be null."""
    return cut_lineage(df.withColumn("_rid", F.monotonically_increasing_id()))


def _ordered(h: Column, place: Column) -> Column:
    """A 32-bit hash and a place in one number that sorts like the pair; a sort of pairs compares them by expressions."""
    return F.shiftleft(h, 31).bitwiseOR(place.cast("bigint"))


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << 31) - 1).cast("bigint")).cast("int")


def _splice(words: Column, edits: Column) -> Column:
    """``words`` with those at the places ``_p`` replaced by ``_syn``; ``edits`` are sorted by place. Linear in the words."""
    last = F.size(edits)

    def piece(j: Column) -> Column:
        before = F.get(edits, j - 1)
        start = F.when(j > 0, before["_p"] + 1).otherwise(0)
        end = F.when(j < last, F.get(edits, j)["_p"]).otherwise(F.size(words))
        rest = F.slice(words, start + 1, end - start)
        return F.when(j > 0, F.concat(F.array(before["_syn"]), rest)).otherwise(rest)
    return F.flatten(F.transform(F.sequence(F.lit(0), last), piece))


def _with_word(text: Column, at: Column, word: Column, n: Column) -> Column:
    """A normalised text of ``n`` words with ``word`` in place of the one at ``at``: cut at blanks, without a list of its words."""
    def part(count: Column) -> Column:
        return F.call_function("substring_index", text, F.lit(" "), count)
    return F.concat_ws(" ", F.when(at > 0, part(at)), word, F.when(at + 1 < n, part(at + 1 - n)))


def synonym_replace(df: DataFrame, lexicon: DataFrame, text_col: str, key: Column, tag: str,
                    apply: Column | None = None, seed: int = SEED, key_col: str = "_ekey",
                    norm_col: str | None = None, replace_count: int = 1) -> DataFrame:
    """``replace_count`` times, one word at a seeded random position becomes a seeded random synonym
    (no-op without one); a position may come up again.

    As in ``' '.join(words)``, an edited text is whitespace-normalised even when nothing was
    replaced; an empty text is returned unchanged. Rows outside ``apply`` are not tokenized at all,
    and the replacement is ``slice``/``concat`` (no per-word lambda). ``norm_col``, when given, holds
    the whitespace-normalised text (kept up to date here), so repeated edits split it directly
    instead of re-running the whitespace regex."""
    if norm_col is None:
        words = tokenize_words(F.col(text_col))
    else:
        words = F.when(F.col(norm_col) == "", F.array().cast("array<string>")).otherwise(F.split(F.col(norm_col), " "))
    d = df.withColumn("_w", words if apply is None else F.when(apply, words))
    for r in range(replace_count):
        d = d.withColumn(key_col, F.concat_ws("|", key.cast("string"), F.lit(tag if r == 0 else f"{tag}#{r}")))
        n = F.size("_w")
        idx = F.floor(uniform(seed, F.col(key_col), "pos") * n).cast("int")
        d = d.withColumn("_i", F.when(F.col("_w").isNotNull() & (n > 0), idx))
        d = _lookup(d, lexicon, F.try_element_at("_w", F.col("_i") + 1), key_col)
        pick = F.try_element_at("_syns", (F.floor(uniform(seed, F.col(key_col), "syn") * F.size("_syns")) + 1).cast("int"))
        replaced = F.concat(F.slice("_w", 1, F.col("_i")), F.array(pick), F.slice("_w", F.col("_i") + 2, n))
        d = d.withColumn("_w", F.when(F.col("_syns").isNotNull(), replaced).otherwise(F.col("_w"))).drop("_syns", key_col)
    d = d.withColumn("_ed", F.when(F.col("_i").isNotNull(), F.array_join("_w", " ")))
    d = d.withColumn(text_col, F.coalesce(F.col("_ed"), F.col(text_col)))
    if norm_col is not None:
        d = d.withColumn(norm_col, F.coalesce(F.col("_ed"), F.col(norm_col)))
    return d.drop("_w", "_i", "_ed")


def synonym_replace_fields(df: DataFrame, lexicon: DataFrame, text_col: str, key: Column, tag: str,
                           apply: Column | None = None, seed: int = SEED,
                           field_cols: Sequence[str] = (S.SHORT, S.DESC), replace_count: int = 1) -> DataFrame:
    """Field-aware variant: with >= 7 fields only fields 0 and 1 are edited, the text is rebuilt
    and both source columns are updated; otherwise the copy is unchanged."""
    parts = split_fields(F.col(text_col))
    ok = F.size(parts) >= 7 if apply is None else (apply & (F.size(parts) >= 7))
    d = df.withColumn("_parts", parts).withColumn("_ok", ok)
    d = d.withColumn("_f0", F.try_element_at("_parts", F.lit(1))).withColumn("_f1", F.try_element_at("_parts", F.lit(2)))
    d = synonym_replace(d, lexicon, "_f0", key, tag + ":f0", F.col("_ok"), seed, replace_count=replace_count)
    d = synonym_replace(d, lexicon, "_f1", key, tag + ":f1", F.col("_ok"), seed, replace_count=replace_count)
    rebuilt = F.array_join(F.concat(F.array("_f0", "_f1"), F.slice("_parts", 3, 1 << 30)), S.SEP)
    d = d.withColumn(text_col, F.when(F.col("_ok"), rebuilt).otherwise(F.col(text_col)))
    d = d.withColumn(field_cols[0], F.when(F.col("_ok"), F.col("_f0")).otherwise(F.col(field_cols[0])))
    d = d.withColumn(field_cols[1], F.when(F.col("_ok"), F.col("_f1")).otherwise(F.col(field_cols[1])))
    return d.drop("_parts", "_ok", "_f0", "_f1")


# --- oversampling ----------------------------------------------------------------------------

def oversample_factors(triples: DataFrame, targets: Sequence[str] = S.TARGETS,
                       factor: float = S.THRESHOLD_FACTOR, multiplier: int = S.OVERSAMPLE_MULTIPLIER,
                       exclude: str = S.OTHER) -> DataFrame:
    """Copy factors of the chained passes, computed on the label-triple table.

    Pass k totals each class of target k over the table as enlarged by passes < k; a class with
    total < factor * max (and not ``exclude``) gets factor ``multiplier + 1`` (original + copies).
    Result: (targets..., n, f1, f2, f3, n_final)."""
    t = triples.withColumn("_n0", F.col("n"))
    for k, tg in enumerate(targets):
        cur, nxt, f = f"_n{k}", f"_n{k + 1}", f"f{k + 1}"
        # windows over the triple table keep the three passes one linear plan (no self-joins)
        t = t.withColumn("_tot", F.sum(cur).over(Window.partitionBy(tg)))
        named = F.max(F.when(F.col(tg).isNotNull(), F.col("_tot")))
        minor = (F.col("_tot") < over_all(named) * factor) & (F.col(tg) != exclude)  # null for a null label: no copies
        t = (t.withColumn(f, F.when(minor, F.lit(multiplier + 1)).otherwise(F.lit(1)))
             .withColumn(nxt, F.col(cur) * F.col(f)).drop("_tot"))
    last = f"_n{len(targets)}"
    return t.select(*targets, "n", *[f"f{k + 1}" for k in range(len(targets))], F.col(last).alias("n_final"))


def oversample_minority(df: DataFrame, lexicon: DataFrame, target: str, text_col: str, key_col: str,
                        factor: float = S.THRESHOLD_FACTOR, multiplier: int = S.OVERSAMPLE_MULTIPLIER,
                        exclude: str = S.OTHER, seed: int = SEED, tag: str = "os") -> DataFrame:
    """One pass: each row of a minority class gets ``multiplier`` edited copies (``copy_no`` > 0)."""
    cc = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("_tot"))
    mx = cc.select(F.max("_tot")).scalar()
    flag = dimension(cc.select(target, ((F.col("_tot") < mx * factor) & (F.col(target) != exclude)).alias("_minor")))
    d = df.join(flag, on=target, how="left")
    reps = F.when(F.col("_minor"), F.lit(multiplier)).otherwise(F.lit(0))
    d = d.withColumn("copy_no", F.explode(F.sequence(F.lit(0), reps))).drop("_minor")
    key = F.concat_ws(":", F.col(key_col).cast("string"), F.col("copy_no").cast("string"))
    return synonym_replace(d, lexicon, text_col, key, tag, F.col("copy_no") > 0, seed).select(*df.columns, "copy_no")


def _null_safe_join(df: DataFrame, small: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Left join of a small table on keys that may be null."""
    right = small.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *values)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(right, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def oversample_chain(df: DataFrame, lexicon: DataFrame, text_col: str, key_col: str,
                     targets: Sequence[str] = S.TARGETS, factors: DataFrame | None = None,
                     field_aware: bool = False, seed: int = SEED) -> DataFrame:
    """Three chained oversampling passes in one go.

    Labels never change inside a copy, so each row's multiplicity depends only on its triple: the
    factors come from the triple table, one join attaches them, and three narrow explodes make
    the copies. Copy (i1, i2, i3) carries one synonym edit per non-zero index, applied in pass
    order with the randomness of its ancestor copy, exactly as repeated passes would. ``aug_no`` is
    the path "i1.i2.i3", a key beside the row's own for any number of copies. A row with a null
    label is copied by its other labels only."""
    fcols = [f"f{k + 1}" for k in range(len(targets))]
    if isinstance(factors, str) and factors == "attached":
        d = df  # the caller already joined f1..f3 onto the rows
    else:
        fac = label_table(factors if factors is not None else oversample_factors(
            df.groupBy(*targets).agg(F.count(F.lit(1)).alias("n")), targets))
        d = _null_safe_join(df, fac, targets, fcols)
    if not one_word_synonyms(lexicon):
        return _chain_by_rows(d, lexicon, text_col, key_col, fcols, field_aware, seed)
    rows = _numbered(d)
    odd = None
    if field_aware:  # a separator's mark inside a field may become a separator: such rows are cut anew after each pass
        parts = split_fields(F.col(text_col))
        odd = F.coalesce(F.concat_ws("", F.slice(parts, 1, 2)).contains(S.SEP.strip()), F.lit(False))
    out = _chain_by_places(rows if odd is None else rows.filter(~odd), lexicon, text_col, key_col, fcols, field_aware, seed)
    if odd is not None and not rows.filter(odd).isEmpty():
        out = out.unionByName(_chain_by_rows(rows.filter(odd).drop("_rid"), lexicon, text_col, key_col, fcols, True, seed))
    return out


def _edited_texts(text_col: str, field_aware: bool) -> list[Column]:
    """The texts that the chain edits, normalised: the whole one, or fields 0 and 1 of one with 7 fields or more (else null)."""
    if not field_aware:
        return [normalize_space(nz(text_col))]
    parts = split_fields(F.col(text_col))
    return [F.when(F.size(parts) >= 7, normalize_space(nz(F.try_element_at(parts, F.lit(s + 1))))) for s in (0, 1)]


def _chain_by_places(rows: DataFrame, lexicon: DataFrame, text_col: str, key_col: str, fcols: Sequence[str],
                     field_aware: bool, seed: int) -> DataFrame:
    """The chain where synonyms are single words: the places that a copy's passes edit follow from its path
    and the number of words. Narrow rows (source row, path, words at those places) are looked up pass by pass; texts
    meet the finished edits once, as source rows, and are copied last."""
    spots = [(f"{s}{k}", s, k) for s in ((0, 1) if field_aware else (0,)) for k in range(len(fcols))]  # name, field, pass
    marks = [f"_i{k + 1}" for k in range(len(fcols))]
    texts = _edited_texts(text_col, field_aware)
    words = [words_of_normal(t) for t in texts]
    m = rows.select("_rid", F.col(key_col).cast("string").alias("_key"), *fcols, *[w.alias(f"_w{s}") for s, w in enumerate(words)])
    for f, i in zip(fcols, marks, strict=True):
        m = m.withColumn(i, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f), F.lit(1)) - 1)))
    m = m.filter(F.array_max(F.array(*marks)) > 0)
    picks = []
    for name, s, k in spots:
        tag = f"p{k + 1}" + (f":f{s}" if field_aware else "")
        ekey = F.concat_ws("|", F.concat_ws(".", "_key", *[F.col(i).cast("string") for i in marks[:k + 1]]), F.lit(tag))
        n = F.size(f"_w{s}")
        at = F.when((F.col(marks[k]) > 0) & (n > 0), F.floor(uniform(seed, ekey, "pos") * n).cast("int"))
        picks += [at.alias(f"_at{name}"), F.try_element_at(f"_w{s}", at + 1).alias(f"_wd{name}"), F.when(at.isNotNull(), uniform(seed, ekey, "syn")).alias(f"_u{name}")]
    sizes = [f"_n{s}" for s in range(len(words))]
    m = m.select("_rid", *marks, *picks, *[F.size(f"_w{s}").alias(n) for s, n in enumerate(sizes)])
    for name, s, k in spots:
        word = F.col(f"_wd{name}")
        for j in range(k):  # an earlier pass may have been here
            word = F.when((F.col(f"_at{s}{j}") == F.col(f"_at{name}")) & F.col(f"_syn{s}{j}").isNotNull(), F.col(f"_syn{s}{j}")).otherwise(word)
        m = _lookup(m.withColumn("_cur", word), lexicon, F.col("_cur"), "_rid")
        m = m.withColumn(f"_syn{name}", F.try_element_at("_syns", (F.floor(F.col(f"_u{name}") * F.size("_syns")) + 1).cast("int")))
        m = m.drop("_syns", "_cur", f"_wd{name}", f"_u{name}")
    fields = [*marks, *[f"{c}{name}" for name, _, _ in spots for c in ("_at", "_syn")]]
    edits = m.groupBy("_rid").agg(F.collect_list(F.struct(*fields)).alias("_copies"), *[F.first(n).alias(n) for n in sizes])
    kind = edits.schema["_copies"].dataType.elementType
    itself = F.struct(*[(F.lit(0) if f in marks else F.lit(None)).cast(kind[f].dataType).alias(f) for f in fields])
    d = rows.join(edits, "_rid", "left")
    if field_aware:
        d = d.withColumn("_parts", split_fields(F.col(text_col)))
    d = d.withColumns({f"_e{s}": t for s, t in enumerate(texts)})
    d = d.withColumn("_c", F.explode(F.when(F.col("_copies").isNull(), F.array(itself)).otherwise(F.concat(F.array(itself), F.col("_copies")))))
    new = {}
    for s in range(len(words)):
        hit = F.lit(False)
        for name, of, _ in spots:
            if of == s:  # a step of its own for each edit, which reads the text before it several times
                at, syn = F.col(f"_c._at{name}"), F.col(f"_c._syn{name}")
                d = d.withColumn(f"_e{s}", F.when(syn.isNotNull(), _with_word(F.col(f"_e{s}"), at, syn, F.col(sizes[s]))).otherwise(F.col(f"_e{s}")))
                hit = hit | at.isNotNull()
        own = F.col(text_col) if not field_aware else F.try_element_at("_parts", F.lit(s + 1))
        new[s] = F.when(hit, F.col(f"_e{s}")).otherwise(own)
    if field_aware:
        on = (F.array_max(F.array(*[F.col(f"_c.{i}") for i in marks])) > 0) & (F.size("_parts") >= 7)
        d = d.withColumns({"_f0": new[0], "_f1": new[1]})
        rebuilt = F.array_join(F.concat(F.array("_f0", "_f1"), F.slice("_parts", 3, 1 << 30)), S.SEP)
        put = {text_col: rebuilt, S.SHORT: F.col("_f0"), S.DESC: F.col("_f1")}
        put = {c: F.when(on, v).otherwise(F.col(c)) for c, v in put.items()}
    else:
        put = {text_col: new[0]}
    cols = [put[c].alias(c) if c in put else F.col(c) for c in rows.columns if c not in fcols and c != "_rid"]
    return d.select(*cols, F.concat_ws(".", *[F.col(f"_c.{i}").cast("string") for i in marks]).alias("aug_no"))


def _chain_by_rows(d: DataFrame, lexicon: DataFrame, text_col: str, key_col: str, fcols: Sequence[str],
                   field_aware: bool, seed: int) -> DataFrame:
    """The chain pass by pass on whole rows: for synonyms of several words, which move the words behind them."""
    path = [F.col(key_col).cast("string")]
    if not field_aware:
        # normalised once per source row; every later edit splits it directly
        d = d.withColumn("_norm", normalize_space(F.coalesce(F.col(text_col), F.lit(""))))
    for k, f in enumerate(fcols):
        i = f"_i{k + 1}"
        d = d.withColumn(i, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f), F.lit(1)) - 1)))
        path.append(F.col(i).cast("string"))
        if field_aware:
            d = synonym_replace_fields(d, lexicon, text_col, F.concat_ws(".", *path), f"p{k + 1}", F.col(i) > 0, seed)
        else:
            d = synonym_replace(d, lexicon, text_col, F.concat_ws(".", *path), f"p{k + 1}", F.col(i) > 0, seed, norm_col="_norm")
    d = d.drop("_norm") if not field_aware else d
    marks = [f"_i{k + 1}" for k in range(len(fcols))]
    return d.withColumn("aug_no", F.concat_ws(".", *[F.col(i).cast("string") for i in marks])).drop(*fcols, *marks)


def union_augmented(original: DataFrame, augmented: DataFrame) -> DataFrame:
    """UNION ALL of original and augmented rows (by name)."""
    return original.unionByName(augmented, allowMissingColumns=True)


# --- rare-class augmentation -------------------------------------------------------------------

def rare_flags(df: DataFrame, targets: Sequence[str] = S.TARGETS, min_count: int = S.MIN_SAMPLES,
               heavy_below: int = S.HEAVY_THRESHOLD) -> DataFrame:
    """Adds ``is_rare`` (any target class < min_count) and ``is_heavy`` (a rare class < heavy_below).

    Class totals come from one label-triple aggregate and reach rows through one join."""
    tri = df.groupBy(*targets).agg(F.count(F.lit(1)).alias("_n"))
    rare, heavy = F.lit(False), F.lit(False)
    for i, t in enumerate(targets):
        tri = tri.withColumn(f"_t{i}", F.when(F.col(t).isNotNull(), F.sum("_n").over(Window.partitionBy(t))).otherwise(min_count))
        rare = rare | (F.col(f"_t{i}") < min_count)
        heavy = heavy | ((F.col(f"_t{i}") < min_count) & (F.col(f"_t{i}") < heavy_below))
    flags = label_table(tri.select(*targets, rare.alias("is_rare"), heavy.alias("is_heavy")))
    return _null_safe_join(df, flags, targets, ["is_rare", "is_heavy"])


def _ekey(key: Column, tag: str) -> Column:
    return F.concat_ws("|", key.cast("string"), F.lit(tag))


def synonym_replace_ratio(df: DataFrame, lexicon: DataFrame, text_col: str, key: Column, tag: str,
                          ratio: float | Column = 0.15, apply: Column | None = None, seed: int = SEED,
                          row_id: str = "_row") -> DataFrame:
    """Replace max(1, int(len * ratio)) distinct candidate words (alphabetic, > 3 characters) by
    a synonym. Unchanged text when there is no word or no candidate.

    Only the selected positions are exploded and looked up; edits regroup per row (bounded by the
    row's own word count)."""
    d = df.withColumn(row_id, _ekey(key, tag)).withColumn("_w", tokenize_words(F.col(text_col)))
    n = F.size("_w")
    d = d.withColumn("_cand", F.filter(F.transform("_w", lambda x, i: F.when(x.rlike(ALPHA_WORD) & (F.length(x) > 3), i)),
                                       lambda v: v.isNotNull()))
    r = ratio if isinstance(ratio, Column) else F.lit(ratio)
    k = F.least(F.greatest(F.lit(1), F.floor(n * r).cast("int")), F.size("_cand"))
    order = F.sort_array(F.transform("_cand", lambda i: _ordered(hash32(seed, F.col(row_id), i), i)))
    sel = F.transform(F.slice(order, 1, k), _place)
    on = (n > 0) & (F.size("_cand") > 0)
    if apply is not None:
        on = on & apply
    # selected positions are written once with the rows: both branches below read them instead of
    # re-running the per-word candidate test and the ordering
    d = _numbered(d.withColumn("_sel", F.when(on, sel)).drop("_cand", "_w"))
    d = d.withColumn("_w", tokenize_words(F.col(text_col)))
    picks = d.select("_rid", row_id, "_w", F.explode("_sel").alias("_p"))
    u = hash32(seed, F.col(row_id), F.col("_p"), "syn") / F.lit(TWO32)
    picks = picks.select("_rid", "_p", F.try_element_at("_w", F.col("_p") + 1).alias("word"), u.alias("_u"))
    chosen = picks.join(lexicon.select("word", "synonyms"), "word").select(
        "_rid", "_p", F.try_element_at("synonyms", (F.floor(F.col("_u") * F.size("synonyms")) + 1).cast("int")).alias("_syn"))
    edits = chosen.filter(F.col("_syn").isNotNull()).groupBy("_rid").agg(F.sort_array(F.collect_list(F.struct("_p", "_syn"))).alias("_m"))
    d = d.join(edits, "_rid", "left")
    edited = F.array_join(F.when(F.col("_m").isNull(), F.col("_w")).otherwise(_splice(F.col("_w"), F.col("_m"))), " ")
    return d.withColumn(text_col, F.when(F.col("_sel").isNotNull(), edited).otherwise(F.col(text_col))) \
        .drop("_w", "_sel", "_m", "_rid", row_id)


def random_insertion(df: DataFrame, lexicon: DataFrame, text_col: str, key: Column, tag: str,
                     apply: Column | None = None, seed: int = SEED, key_col: str = "_ekey", n: int = 1) -> DataFrame:
    """``n`` times, a synonym of a random word is inserted at a random position (0..len); no-op
    without one."""
    d = df.withColumn("_w", tokenize_words(F.col(text_col)))
    on = (F.size("_w") > 0) if apply is None else (apply & (F.size("_w") > 0))
    d = d.withColumn("_on", F.coalesce(on, F.lit(False)))
    for r in range(n):
        d = d.withColumn(key_col, _ekey(key, tag if r == 0 else f"{tag}#{r}"))
        size = F.size("_w")
        d = d.withColumn("_i", F.when(F.col("_on"), F.floor(uniform(seed, F.col(key_col), "pos") * size).cast("int")))
        d = _lookup(d, lexicon, F.try_element_at("_w", F.col("_i") + 1), key_col)
        syn = F.try_element_at("_syns", (F.floor(uniform(seed, F.col(key_col), "syn") * F.size("_syns")) + 1).cast("int"))
        at = (F.floor(uniform(seed, F.col(key_col), "at") * (size + 1)) + 1).cast("int")
        d = d.withColumn("_w", F.when(F.col("_syns").isNotNull(), F.array_insert("_w", at, syn)).otherwise(F.col("_w"))).drop("_i", "_syns", key_col)
    return d.withColumn(text_col, F.when(F.col("_on"), F.array_join("_w", " ")).otherwise(F.col(text_col))).drop("_w", "_on")


def random_deletion(df: DataFrame, text_col: str, key: Column, tag: str, p: float = 0.1,
                    apply: Column | None = None, seed: int = SEED) -> DataFrame:
    """Each word is dropped with probability p; texts under 4 words are unchanged; if every word
    goes, one random word is kept."""
    k = _ekey(key, tag)
    w = tokenize_words(F.col(text_col))
    d = df.withColumn("_k", k).withColumn("_w", w if apply is None else F.when(apply, w))
    kept = F.filter("_w", lambda x, i: uniform(seed, F.col("_k"), F.concat(F.lit("d"), i.cast("string"))) > p)
    d = d.withColumn("_kept", kept)
    one = F.array(F.try_element_at("_w", (F.floor(uniform(seed, F.col("_k"), "keep") * F.size("_w")) + 1).cast("int")))
    res = F.array_join(F.when(F.size("_kept") > 0, F.col("_kept")).otherwise(one), " ")
    on = F.size("_w") >= 4 if apply is None else (apply & (F.size("_w") >= 4))
    return d.withColumn(text_col, F.when(on, res).otherwise(F.col(text_col))).drop("_k", "_w", "_kept")


def random_swap_segments(df: DataFrame, text_col: str, key: Column, tag: str, segments: int = 3,
                         apply: Column | None = None, seed: int = SEED) -> DataFrame:
    """Cut into runs of len // segments words (a remainder makes an extra run), shuffle the runs;
    texts shorter than ``segments`` words are unchanged."""
    d = df.withColumn("_k", _ekey(key, tag)).withColumn("_w", tokenize_words(F.col(text_col)))
    n = F.size("_w")
    size = F.greatest(F.lit(1), (n / segments).cast("int"))
    d = d.withColumn("_sz", size)
    n_runs = F.ceil(n / F.col("_sz")).cast("int")
    runs = F.transform(F.sequence(F.lit(0), F.greatest(n_runs - 1, F.lit(0))), lambda j: F.struct(
        uniform(seed, F.col("_k"), F.concat(F.lit("r"), j.cast("string"))).alias("u"), j.alias("j"),
        F.slice("_w", j * F.col("_sz") + 1, F.col("_sz")).alias("run")))
    shuffled = F.array_join(F.flatten(F.transform(F.array_sort(runs), lambda s: s["run"])), " ")
    on = n >= segments if apply is None else (apply & (n >= segments))
    return d.withColumn(text_col, F.when(on, shuffled).otherwise(F.col(text_col))).drop("_k", "_w", "_sz")


def fast_augment(df: DataFrame, lexicon: DataFrame, text_col: str, key: Column, heavy: Column,
                 seed: int = SEED) -> DataFrame:
    """Synonym replacement (ratio 0.20 heavy / 0.10), then insertion (heavy) or deletion, then a
    segment shuffle with probability 0.5 — each step on the previous step's text."""
    if one_word_synonyms(lexicon):
        return _copies_by_places(df, lexicon, text_col, lambda _: key, F.array(F.lit(0)), heavy, "_one", seed).drop("_one")
    d = df.withColumn("_heavy", heavy).withColumn("_fakey", key.cast("string"))
    key = F.col("_fakey")
    d = synonym_replace_ratio(d, lexicon, text_col, key, "fa1", F.when(F.col("_heavy"), 0.20).otherwise(0.10), None, seed)
    d = random_insertion(d, lexicon, text_col, key, "fa2i", F.col("_heavy"), seed)
    return _cut_and_shuffled(d, text_col, key, seed).drop("_heavy", "_fakey")


def _cut_and_shuffled(d: DataFrame, text_col: str, key: Column, seed: int) -> DataFrame:
    """The steps of ``fast_augment`` that need no lexicon."""
    d = random_deletion(d, text_col, key, "fa2d", 0.1, ~F.col("_heavy"), seed)
    coin = uniform(seed, _ekey(key, "fa3"), "coin") < 0.5
    return random_swap_segments(d, text_col, key, "fa3s", 3, coin, seed)


def _synonyms_twice(lexicon: DataFrame) -> DataFrame:
    """(word, synonyms, next): ``next`` holds the synonyms of each synonym."""
    lx = lexicon.select("word", "synonyms")
    each = lx.select("word", F.posexplode("synonyms").alias("_j", "_s"))
    found = each.join(lx.select(F.col("word").alias("_s"), F.col("synonyms").alias("_ss")), "_s", "left")
    after = found.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("_j", "_ss"))).alias("_n"))
    return dimension(lx.join(after, "word", "left").select("word", "synonyms", F.transform("_n", lambda x: x["_ss"]).alias("next")))


def _copies_by_places(df: DataFrame, lexicon: DataFrame, text_col: str, key_of, copies: Column, heavy: Column, out: str, seed: int) -> DataFrame:
    """A row of ``fast_augment`` for every number in ``copies`` (``out``; its key is ``key_of`` the number), where synonyms are
    single words. The words of a source row are looked up once for all its copies: narrow rows (source row, place, word)
    meet the lexicon and return as one array beside the text; copies are then made and edited in place."""
    rows = _numbered(df.withColumn("_heavy", heavy).withColumn("_copies", copies))
    w = tokenize_words(F.col(text_col))
    n = F.size("_w")

    def place(c: Column) -> Column:
        return F.floor(uniform(seed, _ekey(key_of(c), "fa2i"), "pos") * n).cast("int")
    src = rows.withColumn("_w", w).withColumn("_in", F.when(F.col("_heavy"), F.transform("_copies", place)))
    occ = src.select("_rid", "_in", F.posexplode("_w").alias("_p", "word")).select(
        "_rid", "_p", "word", (F.col("word").rlike(ALPHA_WORD) & (F.length("word") > 3)).alias("_c"),
        F.coalesce(F.array_contains("_in", F.col("_p")), F.lit(False)).alias("_f")).filter("_c or _f")
    found = occ.join(_synonyms_twice(lexicon), "word", "left").select(
        "_rid", F.struct("_p", "_c", "synonyms", F.when(F.col("_f"), F.col("next")).alias("next")).alias("_s"))
    known = found.groupBy("_rid").agg(F.sort_array(F.collect_list("_s")).alias("_known"))
    # copies cost far more than moving a text once: rows are dealt evenly, also where they are few
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = rows.repartition(parts, "_rid").join(known, "_rid", "left").withColumn("_w", w)
    d = d.withColumn("_cand", F.filter("_known", lambda s: s["_c"])).withColumn(out, F.explode("_copies"))
    key = key_of(F.col(out))
    d = d.withColumn("_k1", _ekey(key, "fa1")).withColumn("_k2", _ekey(key, "fa2i"))
    k = F.least(F.greatest(F.lit(1), F.floor(n * F.when(F.col("_heavy"), 0.20).otherwise(0.10)).cast("int")), F.size("_cand"))
    d = d.withColumn("_top", F.when(F.size("_cand") > 0, F.slice(F.sort_array(F.transform("_cand", lambda s, j: _ordered(hash32(seed, F.col("_k1"), s["_p"]), j))), 1, k)))

    def edit(t: Column) -> Column:
        word = F.get(F.col("_cand"), _place(t))
        syns = word["synonyms"]
        at = F.floor(hash32(seed, F.col("_k1"), word["_p"], "syn") / F.lit(TWO32) * F.size(syns)).cast("int")
        return F.struct(word["_p"].alias("_p"), F.when(syns.isNotNull(), F.get(syns, at)).alias("_syn"), at.alias("_j"))
    d = d.withColumn("_edits", F.sort_array(F.filter(F.transform("_top", edit), lambda e: e["_syn"].isNotNull())))
    d = d.withColumn("_new", F.when(F.size("_edits") > 0, _splice(F.col("_w"), F.col("_edits"))).otherwise(F.col("_w")))
    # a synonym of one word of the edited text, for the insertion
    d = d.withColumn("_on", F.coalesce(F.col("_heavy") & (n > 0), F.lit(False)))
    d = d.withColumn("_at", F.when(F.col("_on"), F.floor(uniform(seed, F.col("_k2"), "pos") * n).cast("int")))
    here = F.get(F.filter("_known", lambda s: s["_p"] == F.col("_at")), F.lit(0))
    put = F.get(F.filter("_edits", lambda e: e["_p"] == F.col("_at")), F.lit(0))
    d = d.withColumn("_here", F.when(F.col("_on"), here)).withColumn("_put", F.when(F.col("_on"), put))
    d = d.withColumn("_syns", F.when(F.col("_put").isNotNull(), F.get(F.col("_here.next"), F.col("_put._j"))).otherwise(F.col("_here.synonyms")))
    syn = F.try_element_at("_syns", (F.floor(uniform(seed, F.col("_k2"), "syn") * F.size("_syns")) + 1).cast("int"))
    at = (F.floor(uniform(seed, F.col("_k2"), "at") * (n + 1)) + 1).cast("int")
    text = F.array_join(F.when(F.col("_syns").isNotNull(), F.array_insert("_new", at, syn)).otherwise(F.col("_new")), " ")
    d = d.withColumn(text_col, F.when(F.col("_on") | F.col("_top").isNotNull(), text).otherwise(F.col(text_col)))
    d = _cut_and_shuffled(d.select(*df.columns, out, "_heavy"), text_col, key, seed)
    return d.select(*df.columns, out)


def rare_subset(df: DataFrame, targets: Sequence[str] = S.TARGETS, min_count: int = S.MIN_SAMPLES) -> DataFrame:
    """Rows with a rare class (< min_count) in any target (class counts over ``df``)."""
    return rare_flags(df, targets, min_count).filter(F.col("is_rare")).drop("is_rare", "is_heavy")


def augment_rare_rows(rare_rows: DataFrame, lexicon: DataFrame, text_col: str, key_col: str,
                      rare_sets_from: DataFrame | None = None, targets: Sequence[str] = S.TARGETS,
                      seed: int = SEED) -> DataFrame:
    """Copies of the rare rows: 5 per row, 10 when heavy (a rare class under 25 rows in the rare
    subset), each passed through ``fast_augment``. Returns only the new rows with ``aug_no`` >= 1.

    Rare sets come from ``rare_sets_from`` (the full table) and the heavy test from the subset's own
    counts, as in the reference flow."""
    full = rare_sets_from if rare_sets_from is not None else rare_rows
    tri_full = full.groupBy(*targets).agg(F.count(F.lit(1)).alias("_n"))
    tri_sub = rare_rows.groupBy(*targets).agg(F.count(F.lit(1)).alias("_s"))
    for i, tg in enumerate(targets):
        tri_full = tri_full.withColumn(f"_f{i}", F.sum("_n").over(Window.partitionBy(tg)))  # totals in the full table
        tri_sub = tri_sub.withColumn(f"_r{i}", F.sum("_s").over(Window.partitionBy(tg)))  # totals in the subset
    t = _null_safe_join(tri_sub, tri_full, targets, [f"_f{i}" for i in range(len(targets))])
    heavy = F.lit(False)
    for i in range(len(targets)):
        heavy = heavy | F.coalesce(F.col(targets[i]).isNotNull() & (F.col(f"_f{i}") < S.MIN_SAMPLES) & (F.col(f"_r{i}") < S.HEAVY_THRESHOLD), F.lit(False))
    flags = label_table(t.select(*targets, heavy.alias("is_heavy")))
    d = _null_safe_join(rare_rows, flags, targets, ["is_heavy"])
    copies = F.when(F.col("is_heavy"), S.RARE_MULTIPLIER * S.HEAVY_BONUS_MULTIPLIER).otherwise(S.RARE_MULTIPLIER)
    copies = F.sequence(F.lit(1), copies)

    def key_of(copy: Column) -> Column:
        return F.concat_ws(":", F.col(key_col).cast("string"), copy.cast("string"))
    if one_word_synonyms(lexicon):
        return _copies_by_places(d, lexicon, text_col, key_of, copies, F.col("is_heavy"), "aug_no", seed)
    # the few rare rows are dealt out before they are copied: ten edited copies of a text cost far
    # more than moving it once, and rare rows may sit in few input files
    d = d.repartition(int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")), key_col)
    d = d.withColumn("aug_no", F.explode(copies))
    return fast_augment(d, lexicon, text_col, key_of(F.col("aug_no")), F.col("is_heavy"), seed)


def select_for_transform(df: DataFrame, key_col: str, share: float = S.TRANSLATE_SHARE, seed: int = SEED) -> DataFrame:
    """The seeded ``share`` of augmented rows that goes to the external text transform."""
    k = F.concat_ws(":", F.col(key_col).cast("string"), F.col("aug_no").cast("string"))
    return df.filter(uniform(seed, k, "transform") < share)


def batch_transform(df: DataFrame, fn, text_col: str, key_cols: list[str], chunk: int = S.TRANSLATE_CHUNK) -> DataFrame:
    """Run a caller's list->list text function over chunks of ``chunk`` texts (Arrow batches)."""
    from tixprep.operators.udf import map_batch
    return map_batch(df, fn, text_col, key_cols, chunk, out="new_text")


def writeback_by_id(df: DataFrame, new: DataFrame, text_col: str, key_cols: list[str]) -> DataFrame:
    """Replace ``text_col`` on the rows present in ``new`` (key_cols, new_text)."""
    j = df.join(new.select(*key_cols, "new_text"), key_cols, "left")
    return j.withColumn(text_col, F.coalesce("new_text", F.col(text_col))).drop("new_text")
