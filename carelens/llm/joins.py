"""Joins of whole texts with sets of ids whose size is checked first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.session import cut_lineage

#: Ids of 8 or 16 bytes that are broadcast; a join with more shuffles the texts.
BROADCAST_IDS = 500_000


def content_key() -> Column:
    """128 bits of doc_id and text: what tells rows apart whose ids are null or repeated."""
    return F.struct(F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("k2"))


def checked(ids: DataFrame) -> DataFrame:
    """Distinct ``ids``, stored, and marked for broadcast where there are few enough."""
    ids = cut_lineage(ids.distinct())
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def rows_of(docs: DataFrame, ids: DataFrame, key: str = "doc_id", how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose key is (or with left_anti is not) in ``ids``; null is a key."""
    wanted = checked(ids.select(F.col(ids.columns[0]).alias("wanted_key")))
    return docs.join(wanted, F.col(key).eqNullSafe(F.col("wanted_key")), how)
