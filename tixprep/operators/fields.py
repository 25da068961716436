"""Projections, fills, filters and predicates over the ticket table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tixprep import schema as S
from tixprep.functions.text import CLEANERS, clean_basic, nz

# Date formats tried in order by the mixed-format parser (ISO first, then US style).
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy", "dd-MMM-yyyy"]


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def has_columns(df: DataFrame, *cols: str) -> bool:
    """Plan-time guard: a step is skipped when one of its columns is absent."""
    return all(c in df.columns for c in cols)


def fill_defaults(df: DataFrame, policy: str = "main", cols: Iterable[str] | None = None) -> DataFrame:
    """Null default per column under a named policy (main / manual / profile)."""
    d = {k: v for k, v in S.DEFAULTS[policy].items() if k in df.columns and (cols is None or k in cols)}
    return df.na.fill(d) if d else df


def fill_nan_strings(df: DataFrame, cols: Sequence[str] | None = None, policy: str = "profile") -> DataFrame:
    """Stringify, then null or the literal 'nan' become the column default."""
    defaults = S.DEFAULTS[policy]
    cols = [c for c in (cols or S.CATEGORICAL) if c in df.columns]
    out = {}
    for c in cols:
        s = F.col(c).cast("string")
        out[c] = F.when(s.isNull() | (s == "nan"), F.lit(defaults.get(c, "Unknown"))).otherwise(s)
    return df.withColumns(out) if out else df


def drop_missing_targets(df: DataFrame, targets: Sequence[str] = S.TARGETS) -> DataFrame:
    return df.na.drop(how="any", subset=list(targets))


def parse_dates_mixed(c, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Mixed-format text to timestamp; unparseable text becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def parse_date_columns(df: DataFrame, cols: Sequence[str] = (S.DATE_OPENED,)) -> DataFrame:
    return df.withColumns({c: parse_dates_mixed(c) for c in cols if c in df.columns})


def date_to_string(c, null_text: str = "NaT") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(null_text))


def select_numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def select_categorical(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def project_processed(df: DataFrame, cols: Sequence[str] = S.TEXT_FIELDS, variant: str = "profile") -> DataFrame:
    fn = CLEANERS[variant]
    return df.withColumns({f"processed_{c}": fn(F.col(c)) for c in cols if c in df.columns})


def clean_columns(df: DataFrame, cols: Sequence[str] = S.TEXT_FIELDS, variant: str = "basic") -> DataFrame:
    """Clean text columns in place (null becomes '')."""
    fn = CLEANERS[variant]
    return df.withColumns({c: fn(F.col(c)) for c in cols if c in df.columns})


def snake_length_name(col: str) -> str:
    return col.lower().replace(" ", "_") + "_length"


def combine_text(cols: Sequence[str] = S.COMBINED_FIELDS, sep: str = S.SEP, clean=None) -> Column:
    """Fields joined by ' [SEP] '; a null field counts as '' so the field count stays fixed."""
    parts = [nz(F.col(c)) if clean is None else clean(F.col(c)) for c in cols]
    return F.concat_ws(sep, *parts)


def combine_text7(df: DataFrame, out: str = "combined_text") -> DataFrame:
    return df.withColumn(out, combine_text(S.COMBINED_FIELDS))


def combine_text2(df: DataFrame, out: str = "combined_text") -> DataFrame:
    """Two-field text, only when the column does not exist yet."""
    if out in df.columns:
        return df
    return df.withColumn(out, combine_text([S.SHORT, S.DESC]))


def combine_text7_clean(df: DataFrame, out: str = "combined_text") -> DataFrame:
    """Serving-time text: every one of the seven fields is cleaned before joining."""
    return df.withColumn(out, combine_text(S.COMBINED_FIELDS, clean=clean_basic))


def filter_lookup(df: DataFrame, key, id_col: str = S.NUMBER) -> DataFrame:
    """First row whose id equals the key (empty when absent)."""
    return df.filter(F.col(id_col) == F.lit(key)).orderBy(id_col).limit(1)


def threshold_filter(df: DataFrame, col: str, bound, op: str = "<") -> DataFrame:
    c = F.col(col)
    cond = {"<": c < bound, "<=": c <= bound, ">": c > bound, ">=": c >= bound}[op]
    return df.filter(cond)
