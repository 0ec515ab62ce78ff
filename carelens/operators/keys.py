"""Key handling shared by the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = str | Sequence[str]


def key_list(keys: Keys) -> list[str]:
    """One name or several; several carry e.g. the facility with the person."""
    return [keys] if isinstance(keys, str) else list(keys)


def naive(ts: Column | str) -> Column:
    """Clinical instants carry no time zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c.cast("timestamp_ntz")


def earlier_is_larger(ts: Column | str) -> Column:
    """An orderable value that grows as the instant gets earlier."""
    return F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz") - naive(ts)


def match(left: DataFrame, right: DataFrame, left_keys: Keys, right_keys: Keys,
          how: str = "left", null_safe: bool = False) -> DataFrame:
    """Equi-join that keeps the left names and drops the right keys."""
    renamed = {k: f"__right_{i}" for i, k in enumerate(key_list(right_keys))}
    other = right.withColumnsRenamed(renamed)
    cond = F.lit(True)
    for lk, rk in zip(key_list(left_keys), renamed.values(), strict=True):
        a, b = left[f"`{lk}`"], other[rk]
        cond = cond & (a.eqNullSafe(b) if null_safe else a == b)
    joined = left.join(other, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())


def match_many(left: DataFrame, right: DataFrame, left_keys: Keys, right_keys: Keys,
               how: str = "left") -> DataFrame:
    """``match`` where one key may hold a large share of the left rows.

    Adaptive execution splits a skewed partition only where a shuffle feeds the join
    directly.  An aggregated right side is partitioned by the key already and would
    join without a shuffle of its own; compared null-safe, both sides are shuffled for
    the join.  Missing keys match nothing, as in a plain join.
    """
    known = right.dropna(subset=key_list(right_keys))
    return match(left, known, left_keys, right_keys, how, null_safe=True)


def match_clustered(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """``match_many`` on equal names whose rows stay clustered and sorted by the keys.

    Aggregates by the keys, and more, that follow need no shuffle, unless adaptive execution has
    split a skewed partition: then it adds one between their partial and final step.  The right
    keys are compared as an expression, so an aggregated right side gets a shuffle of its own.
    """
    names = key_list(keys)
    own = [F.when(F.col(k).isNotNull(), F.col(k)).alias(f"__right_{i}") for i, k in enumerate(names)]
    other = right.select(*own, *[F.col(f"`{c}`") for c in right.columns if c not in names])
    cond = F.lit(True)
    for i, k in enumerate(names):
        cond = cond & (left[f"`{k}`"] == other[f"__right_{i}"])
    return left.join(other, cond, "left").drop(*[f"__right_{i}" for i in range(len(names))])
