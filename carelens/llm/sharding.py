"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows are stored once and numbered among those of equal key, then fall into source parts by a
hash of key and number, so that copies of a row are dealt like any other rows.  How many rows of each part go to each
shard is drawn so that every part gives all its rows and every shard gets its exact number:
row by row, from what the shards can still take, which is the law of a uniform shuffle.  Then
each part is permuted and dealt out by its row of the matrix, and each shard is permuted again.
Everything on rows is DataFrame operations; the driver only draws the matrix of counts.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.session import cut_lineage

#: Rows of one source part, or of one block of a shard, at most about so many.
PART_ROWS = 1_000_000
#: Parts for inputs that are smaller than that: one for each PART_LEAST rows, up to PARTS.
PART_LEAST, PARTS = 500, 4096


def parts_for(rows: int) -> int:
    """Source parts for an input; their number times the shards is what the driver draws."""
    return max(1, math.ceil(rows / PART_ROWS), min(PARTS, math.ceil(rows / PART_LEAST)))


def exact_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart."""
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def hypergeometric(rng: random.Random, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` rows come from ``good`` ones among good + bad.

    Inversion outwards from the mode, so it takes about a standard deviation of steps.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    at = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    top = math.exp(choose(good, at) + choose(bad, drawn - at) - choose(good + bad, drawn))
    up = down = at
    p_up = p_down = top
    left = rng.random() - top
    while left >= 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up += 1
            left -= p_up
            if left < 0:
                return up
        if down > low:
            p_down *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            left -= p_down
            if left < 0:
                return down
    return at


def communication_matrix(given: Sequence[int], taken: Sequence[int], seed: int) -> list[list[int]]:
    """Counts from each part (rows) to each shard; the sums are ``given`` and ``taken``."""
    if sum(given) != sum(taken):
        raise ValueError("what the parts give has to be what the shards take")
    rng, room, matrix = random.Random(seed), list(taken), []
    for rows in given:
        rest, line = sum(room), []
        for k, free in enumerate(room):
            n = hypergeometric(rng, free, rest - free, rows)
            rest, rows = rest - free, rows - n
            room[k] -= n
            line.append(n)
        matrix.append(line)
    return matrix


def _told_apart(stored: DataFrame) -> DataFrame:
    """at and id of every row of ``stored`` (at, id); the second and later ones of an id get one of their own.

    Rows are numbered within their id and task, and a task begins after the rows of those before:
    no task gets all rows of an id.
    """
    task = F.shiftright("at", 33).alias("task")  # monotonically_increasing_id: the partition
    each = stored.select("at", "id", task)
    earlier = Window.partitionBy("id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = each.groupBy("id", "task").agg(F.count(F.lit(1)).alias("n")).select(
        "id", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    number = F.row_number().over(Window.partitionBy("id", "task").orderBy("at")) - 1
    nth = each.withColumn("number", number).join(begins, ["id", "task"]).select(
        "at", "id", (F.col("begin") + F.col("number")).alias("nth"))
    return cut_lineage(nth.select(
        "at", F.when(F.col("nth") == 0, F.col("id")).otherwise(F.xxhash64("id", "nth")).alias("id")))


def shard(docs: DataFrame, shards: int = 16, key: Sequence[str] = ("doc_id", "text"),
          seed: int = 20_25) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Shard sizes are at most one apart, and every assignment of rows to slots is equally
    likely over seeds, also of rows that are equal.  The same rows, shards and seed give the same
    result, up to a swap of rows that are equal in ``key``.  Null keys count as a value.  Columns of the input that
    are named shard or slot are replaced.  An empty input gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    identity = F.xxhash64(*(F.col(c) for c in key))
    stored = cut_lineage(docs.select(F.struct(*kept).alias("row"), identity.alias("id"),
                                     F.monotonically_increasing_id().alias("at")))
    parts = parts_for(stored.count())
    rows = _told_apart(stored)
    rows = rows.withColumn("part", F.pmod(_draw(seed), F.lit(parts)))
    given = {r.part: r.n for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(given)
    taken = exact_sizes(sum(given.values()), shards)
    matrix = communication_matrix([given[p] for p in order], taken, seed)
    dealt = docs.sparkSession.createDataFrame(
        [(p, [sum(line[: k + 1]) for k in range(shards)]) for p, line in zip(order, matrix, strict=True)],
        "part long, upto array<long>")
    if len(order) * shards <= 1_000_000:  # 8 MB
        dealt = F.broadcast(dealt)
    local = Window.partitionBy("part").orderBy(_draw(seed + 1), "id")
    placed = (
        rows.withColumn("place", F.row_number().over(local)).join(dealt, "part")
        .withColumn("shard", F.size(F.filter("upto", lambda n: n < F.col("place"))).cast("int"))
    )
    # A shard is permuted in blocks, as it has no bound: random block, place within the block.
    per_shard = math.ceil(parts / shards)
    placed = placed.withColumn("block", F.pmod(_draw(seed + 2), F.lit(per_shard)))
    sizes = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    if parts + shards <= 1_000_000:  # a row for each block, 24 bytes
        begins = F.broadcast(begins)
    again = Window.partitionBy("shard", "block").orderBy(_draw(seed + 3), "id")
    return (
        placed.withColumn("place", F.row_number().over(again)).join(begins, ["shard", "block"])
        .select("at", "shard", (F.col("begin") + F.col("place") - 1).alias("slot"))
        .join(stored.select("at", "row"), "at").select("row.*", "shard", "slot")
    )


def _draw(seed: int) -> Column:
    return F.xxhash64("id", F.lit(seed))
