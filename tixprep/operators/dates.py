"""Dates of mixed formats without a list of formats: the shape of a value says where its year, month
and day stand; where day and month look alike, the values of the same shape decide.

Evidence is one aggregate over a fixed set of shape keys (separator and year length), so the decision
is a few rows whatever the table size; parsing is column expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_TIME = r"(?:(?:[ T]|, ?)([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:\.[0-9]+)?)?(?: ?([AaPp])[Mm])?)?(?: ?(?:Z|UTC))?"
_YEAR_FIRST = r"^([0-9]{4})([-/.])([0-9]{1,2})\2([0-9]{1,2})" + _TIME + "$"
_YEAR_LAST = r"^([0-9]{1,2})([-/.])([0-9]{1,2})\2([0-9]{4}|[0-9]{2})" + _TIME + "$"
_COMPACT = r"^([0-9]{4})([0-9]{2})([0-9]{2})$"
_DAY_NAME = r"^([0-9]{1,2})[- ]([A-Za-z]{3})[a-z]*\.?[- ]([0-9]{4})" + _TIME + "$"
_NAME_DAY = r"^([A-Za-z]{3})[a-z]*\.? ([0-9]{1,2}),? ([0-9]{4})" + _TIME + "$"


@dataclass(frozen=True)
class DateOrder:
    """For each (separator, digits of the year) of dates with the year last: whether the day comes first."""

    day_first: dict[tuple[str, int], bool]
    default_day_first: bool = False


def _text(c) -> Column:
    return F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))


def _part(text: Column, pattern: str, k: int) -> Column:
    """Group ``k`` as a number; null where the pattern does not match or the group is empty."""
    return F.nullif(F.regexp_extract(text, pattern, k), F.lit("")).cast("int")


def shape_counts(df: DataFrame, col: str) -> DataFrame:
    """(separator, year_digits, n, first_beyond, second_beyond) of the values with the year last: how many have a first
    or second number that can be no month. At most six rows."""
    t = _text(col)
    d = df.filter(t.rlike(_YEAR_LAST)).select(
        F.regexp_extract(t, _YEAR_LAST, 2).alias("separator"), F.length(F.regexp_extract(t, _YEAR_LAST, 4)).alias("year_digits"),
        _part(t, _YEAR_LAST, 1).alias("a"), _part(t, _YEAR_LAST, 3).alias("b"))
    return d.groupBy("separator", "year_digits").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("a") > 12, 1)).alias("first_beyond"),
                                                     F.count(F.when(F.col("b") > 12, 1)).alias("second_beyond"))


def infer_order(df: DataFrame, col: str, default_day_first: bool = False) -> DateOrder:
    """The day comes first in a shape if more of its values have a first number beyond 12 than a second one; without
    a majority the default holds."""
    found = {}
    for r in shape_counts(df, col).collect():  # three separators, two lengths
        a, b = r["first_beyond"], r["second_beyond"]
        found[r["separator"], r["year_digits"]] = a > b if a != b else default_day_first
    return DateOrder(found, default_day_first)


def parse_dates(c, order: DateOrder) -> Column:
    """The timestamp (without zone) of a date in any known shape; null otherwise and for impossible dates. A value whose
    own numbers leave only one order is read in that order. Two-digit years are 1970 to 2069."""
    t = _text(c)
    day_first = F.lit(order.default_day_first)
    separator, digits = F.regexp_extract(t, _YEAR_LAST, 2), F.length(F.regexp_extract(t, _YEAR_LAST, 4))
    for (sep, n), first in sorted(order.day_first.items()):
        day_first = F.when((separator == sep) & (digits == n), F.lit(first)).otherwise(day_first)
    a, b, year = _part(t, _YEAR_LAST, 1), _part(t, _YEAR_LAST, 3), _part(t, _YEAR_LAST, 4)
    day_first = F.when((a > 12) & (b <= 12), F.lit(True)).when((b > 12) & (a <= 12), F.lit(False)).otherwise(day_first)
    year = F.when(digits == 2, F.when(year < 70, year + 2000).otherwise(year + 1900)).otherwise(year)
    names = F.array(*[F.lit(m) for m in MONTHS])

    def month(pattern: str, k: int) -> Column:
        return F.nullif(F.array_position(names, F.lower(F.regexp_extract(t, pattern, k))), F.lit(0)).cast("int")

    def at(pattern: str, y: Column, m: Column, d: Column, first: int | None) -> Column:
        if first is None:
            hour = minute = second = F.lit(0)
        else:
            hour, minute, second = (F.coalesce(_part(t, pattern, first + k), F.lit(0)) for k in range(3))
            half = F.lower(F.regexp_extract(t, pattern, first + 3))
            wrong = (half != "") & ((hour < 1) | (hour > 12))
            hour = F.when(wrong, F.lit(99)).when(half == "p", hour % 12 + 12).when(half == "a", hour % 12).otherwise(hour)
        return F.when(t.rlike(pattern), F.try_make_timestamp_ntz(y, m, d, hour, minute, F.when(second < 60, second).otherwise(F.lit(99)).cast("decimal(8,6)")))
    return F.coalesce(
        at(_YEAR_FIRST, _part(t, _YEAR_FIRST, 1), _part(t, _YEAR_FIRST, 3), _part(t, _YEAR_FIRST, 4), 5),
        at(_YEAR_LAST, year, F.when(day_first, b).otherwise(a), F.when(day_first, a).otherwise(b), 5),
        at(_COMPACT, _part(t, _COMPACT, 1), _part(t, _COMPACT, 2), _part(t, _COMPACT, 3), None),
        at(_DAY_NAME, _part(t, _DAY_NAME, 3), month(_DAY_NAME, 2), _part(t, _DAY_NAME, 1), 4),
        at(_NAME_DAY, _part(t, _NAME_DAY, 3), month(_NAME_DAY, 1), _part(t, _NAME_DAY, 2), 4))


def parse_dates_inferred(df: DataFrame, col: str, out: str | None = None, default_day_first: bool = False) -> DataFrame:
    """``df`` with ``out`` (``col`` itself by default) as timestamps; the order of day and month is inferred from the whole column."""
    return df.withColumn(out or col, parse_dates(col, infer_order(df, col, default_day_first)))


def date_report(df: DataFrame, col: str, default_day_first: bool = False) -> DataFrame:
    """(shape, n, parsed, failed_share): values by shape (digits as 9, letters as A, repeats of A as one) with the share that gave no date.
    Null values are no values; at most the 1,000 most frequent shapes."""
    t = _text(col)
    shape = F.regexp_replace(F.regexp_replace(t, "[0-9]", "9"), r"\p{L}+", "A")
    d = df.filter(F.col(col).isNotNull()).select(shape.alias("shape"), parse_dates(col, infer_order(df, col, default_day_first)).isNotNull().alias("ok"))
    out = d.groupBy("shape").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("ok"), 1)).alias("parsed"))
    return out.withColumn("failed_share", 1 - F.col("parsed") / F.col("n")).orderBy(F.desc("n"), "shape").limit(1000)
