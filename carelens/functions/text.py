"""Names, identifiers and recoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions.dates import column


def full_name(given: Column | str, family: Column | str) -> Column:
    """Given and family name; NULL when either is missing."""
    return F.concat(column(given), F.lit(" "), column(family))


def strip_zeros(s: Column | str) -> Column:
    """Drop leading zeros of an all-digit identifier (``000`` becomes empty)."""
    c = column(s)
    return F.when(c.rlike("^[0-9]+$"), F.regexp_replace(c, "^0+", "")).otherwise(c)


def composite_key(*cols: Column | str, sep: str = "") -> Column:
    """One text key; missing parts read ``nan``.  ``sep`` makes it collision-free."""
    parts = [F.coalesce(column(c).cast("string"), F.lit("nan")) for c in cols]
    return F.concat_ws(sep, *parts)


def normalise_id(s: Column | str) -> Column:
    """Identifier as a case-insensitive, pad-space collation compares it."""
    return F.lower(F.rtrim(column(s)))


def recode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep all others."""
    value = column(c)
    chain = F
    for old, new in mapping.items():
        chain = chain.when(value == old, new)
    return chain.otherwise(value)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Turn empty text cells into NULL, as a spreadsheet round trip does."""
    text = {name for name, kind in df.dtypes if kind == "string"}

    def cell(name: str) -> Column:
        c = F.col(f"`{name}`")
        return F.when(c != "", c).alias(name) if name in text else c

    return df.select([cell(c) for c in df.columns])
