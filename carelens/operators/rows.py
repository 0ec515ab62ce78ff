"""Row numbers and repeated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.functions.dates import column
from carelens.operators.keys import Keys, key_list
from carelens.session import cut_lineage

LETTERS = 26


def number_rows(df: DataFrame, order: Sequence[Column | str], out: str = "row_number") -> DataFrame:
    """Serial numbers from 1 in the given order, without one task that sees all rows.

    The rows are range-partitioned and sorted, so a row's number is its position in
    its partition plus the sizes of the partitions before it.  The sorted rows are
    stored first: sampling the ranges a second time could place rows differently.  ``order`` has to be unique per row for the result to be fixed.
    """
    by = [column(c) for c in order]
    # The generated id holds the partition in its upper bits, the position below.
    spread = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = cut_lineage(spread.withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33)
    position = F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("__part")).agg((F.max(position) + 1).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the range shuffle: bounded by its number of tasks.
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    numbered = placed.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return numbered.select(
        (F.col("__start") + position + 1).alias(out), *[F.col(f"`{c}`") for c in df.columns])


def drop_all_duplicates(df: DataFrame, key: Keys) -> DataFrame:
    """Only the rows whose key occurs once (missing keys are equal)."""
    keys = key_list(key)
    cells = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in cells]) if cells else F.lit(True)
    single = df.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(
        F.count("*").alias("__n"), F.any_value(row).alias("__row"))
    # The key itself stays: a join by it needs no further shuffle.
    return single.filter(F.col("__n") == 1).select(*[
        F.col(f"`{c}`") if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def first_letters(df: DataFrame, key: str, order: Sequence[str], out: str) -> DataFrame:
    """Key, order and suffixed key of the first 27 rows of every key (see ``suffix_duplicates``)."""
    cells = [F.col(f"`{c}`") for c in (key, *order)]
    by = Window.partitionBy(cells[0]).orderBy(*cells[1:])
    ranked = df.select(*cells).withColumn("__rank", F.row_number().over(by))
    first = ranked.filter(F.col("__rank") <= LETTERS + 1)
    place = F.struct(*cells[1:])
    tie = cells[0].isNotNull() & (F.col("__rank") > 1) & place.eqNullSafe(F.lag(place).over(by))
    repeated = F.raise_error(F.lit("suffix_duplicates: order repeats within a key")).cast("int")
    first = first.withColumn("__tie", F.when(tie, repeated).otherwise(F.col("__rank")))
    first = first.withColumn("__n", F.count("*").over(Window.partitionBy(cells[0])))
    letter = F.char(F.lit(64) + F.when(F.col("__tie") <= LETTERS, F.col("__rank")))
    suffixed = F.when(F.col("__n") == 1, cells[0]).otherwise(F.concat(cells[0], F.lit("_"), letter))
    return first.select(*cells, suffixed.alias(out))


def suffix_duplicates(df: DataFrame, key: str, order: Sequence[str], out: str | None = None) -> DataFrame:
    """Append ``_A``, ``_B``, ... to every member of a repeated key.

    The 27th and later members get NULL: there is no letter left.  Only the first 26
    rows of a key and the next have to meet in one task, and Spark cuts each task's rows to
    so many per key before the shuffle; all other rows of the key are told by their absence.
    ``order`` has to be unique within a key: rows that tie where letters are given fail.
    """
    names = [key, *order]
    first = first_letters(df, key, order, "__suffixed")
    left = df.withColumns({f"__k{i}": F.col(f"`{c}`") for i, c in enumerate(names)})
    right = first.select("__suffixed", *[F.col(f"`{c}`").alias(f"__r{i}") for i, c in enumerate(names)])
    same = F.lit(True)
    for i in range(len(names)):
        same = same & F.col(f"__k{i}").eqNullSafe(F.col(f"__r{i}"))
    joined = left.join(right, same, "left")
    target = out or key
    kept = [F.col(f"`{c}`") for c in df.columns if c != target]
    return joined.select(*kept, F.col("__suffixed").alias(target))
