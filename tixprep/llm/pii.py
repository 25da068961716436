"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Only DataFrame functions. A text is cut at the matches of a pattern (``split``) and the matches are
taken beside it (``regexp_extract_all``); running lengths of both give code point positions. Rows
that lack a needed character skip the pattern. Patterns are written with possessive quantifiers
and only start where a run of their first class starts, which matches the same spans in linear time
and without recursion on very long digit or letter runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tixprep.llm.tables import free_name

# The base kinds in output order, then the kinds this method adds.
BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["iban", "ssn"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])",
    "ssn": r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
}
# A row is only searched if this cheaper pattern is found somewhere.
HINTS = {
    "email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]{2}|[0-9][\x20-][0-9]", "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]{2}-[0-9]",
}
CONTEXT_WORDS = {
    "email": "e-?mail|contact|write|reach", "ip": "ip|address|host|server|login", "card": "card|visa|mastercard|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax", "iban": "iban|bank|account|transfer", "ssn": "ssn|social|security"}
CONTEXT = {kind: f"(?i)(?:^|[^A-Za-z0-9])(?:{words})(?:[^A-Za-z0-9]|$)" for kind, words in CONTEXT_WORDS.items()}
START_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT_BONUS = 0.25
CONTEXT_WIDTH = 40
KEEP_SCORE = 0.5


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda s, i: s + F.when((F.length(digits) - i) % 2 == 0, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substr(digits, i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number in IBAN form leaves 1 when divided by 97 (letters count from 10)."""
    flat = F.replace(code, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(flat, F.lit(5), F.length(flat)), F.substr(flat, F.lit(1), F.lit(4)))
    def step(s, i):
        ch = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(ch < 58, (s * 10 + (ch - 48)) % 97).otherwise((s * 100 + (ch - 55)) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        small = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(m, r"\."), lambda p: (F.length(small(p)) <= 3) & (F.coalesce(F.when(F.length(small(p)) <= 3, small(p)).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(_digits(m)).between(16, 19), luhn(_digits(m))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    if kind == "iban":
        return F.when(F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34), mod97(m)).otherwise(F.lit(False))
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)") & ~m.rlike("-00-|-0000$")
    return F.lit(True)


SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _proposed(kind: str, text: Column) -> Column:
    """Pieces between matches and the matches, null where the row cannot hold one."""
    pattern = PATTERNS[kind]
    return F.when(text.rlike(HINTS[kind]), F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")))


def _placed(kind: str, p: Column, text: Column) -> Column:
    """Confirmed spans of one kind with their scores, in order of their starts."""
    walked = F.aggregate(
        F.arrays_zip(F.transform(p["between"], lambda x: F.length(x)).alias("gap"), p["found"].alias("m")),
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,m:string>>)").alias("seen")),
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + F.coalesce(F.length(x["m"]), F.lit(0))).alias("at"),
            F.when(x["m"].isNull(), s["seen"]).otherwise(F.concat(s["seen"], F.array(F.struct(
                (s["at"] + x["gap"]).alias("start"), x["m"].alias("m"))))).alias("seen")))["seen"]
    sure = F.filter(walked, lambda x: _valid(kind, x["m"]))
    def scored(x):
        end = x["start"] + F.length(x["m"])
        lead = F.greatest(x["start"] - CONTEXT_WIDTH, F.lit(0))
        near = F.concat(F.substr(text, lead + 1, x["start"] - lead), F.lit(" "), F.substr(text, end + 1, F.lit(CONTEXT_WIDTH)))
        bonus = F.when(near.rlike(CONTEXT[kind]), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), end.alias("end"),
                        F.least(F.lit(START_SCORE[kind]) + bonus, F.lit(1.0)).alias("score"))
    return F.coalesce(F.when(F.size(p["found"]) > 0, F.transform(sure, scored)), F.expr(f"cast(array() as {SPAN})"))


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii", added: bool = True) -> DataFrame:
    """``docs`` with ``out_col``: an array of (kind, start, end, score), by kind as listed, then
    start; code points, end exclusive. Spans of the base kinds always stay, spans of added kinds
    need a score of 0.5 or more. A null text has none."""
    kinds = BASE_KINDS + (ADDED_KINDS if added else [])
    names = {k: free_name(docs, f"_{out_col}_{k}") for k in kinds}
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumns({names[k]: _proposed(k, text) for k in kinds})
    out = out.withColumns({names[k]: _placed(k, F.col(names[k]), text) for k in kinds})
    spans = F.concat(*[F.col(names[k]) if k in BASE_KINDS else F.filter(names[k], lambda x: x["score"] >= KEEP_SCORE) for k in kinds])
    return out.withColumn(out_col, spans).drop(*names.values())


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _scored(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"), F.round(x["score"] * 100).cast("int").cast("string"))), ",")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, counts of the base kinds, ``base_sha256`` of the base spans, ``spans``
    (all, as kind:start:end) and ``scores`` (the same with the score in hundredths). Repeated rows
    each get a row."""
    found = find_pii(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    counts = [F.size(_of_kind("pii", k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.filter("pii", lambda x: x["kind"].isin(BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"), _scored(F.col("pii")).alias("scores"))


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``<KIND>``; overlapping spans become one, named after
    the one that starts first (the longest of these). Other columns are as they were."""
    spans = free_name(docs, "pii")
    found = find_pii(docs, text_col, spans)
    ordered = F.array_sort(F.col(spans), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    text = F.col(text_col)
    state = F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] < s["at"], s["parts"]).otherwise(F.concat(s["parts"], F.array(
                F.substr(text, s["at"] + 1, x["start"] - s["at"]), F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">"))))).alias("parts")),
        lambda s: F.concat(F.array_join(s["parts"], ""), F.substr(text, s["at"] + 1, F.length(text))))
    masked = found.withColumn(text_col, F.when(F.size(spans) == 0, text).otherwise(state))
    return masked.drop(spans).select(*[F.col(f"`{c}`") for c in docs.columns])
