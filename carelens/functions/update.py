"""Conditional assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_where(df: DataFrame, name: str, cond: Column, value: Column | str) -> DataFrame:
    """Set column ``name`` to ``value`` (a column or text) where ``cond`` is true."""
    new = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(name, F.when(cond, new).otherwise(F.col(f"`{name}`")))
