"""Run every query beside its SQL check and compare all values.

    python tests/oracle_check.py [folder of test tables] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, int | float):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, bytes | bytearray):
        return bytes(value).hex()
    return str(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(cell(row[i]) for i in order) for row in rows), key=repr)


# What a column may be called in either engine, as one kind.
KINDS = {
    "bigint": "long", "hugeint": "long", "int": "int", "integer": "int", "double": "double",
    "varchar": "string", "string": "string", "date": "date", "timestamp": "instant",
    "timestamp_ntz": "instant", "boolean": "boolean",
}


def kind(name: str) -> str:
    return KINDS.get(name.lower(), name.lower())


def differences(spark, con, query, sql, sf_dir, strict_types=True) -> str | None:
    """None when both results hold the same rows, else what differs."""
    result = query(spark, sf_dir)
    mine = canonical(result.columns, result.collect())
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    theirs = canonical(list(described), cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {sorted(set(mine[0]) ^ set(theirs[0]))}"
    if strict_types:
        odd = {n: (k, described[n]) for n, k in result.dtypes if kind(k) != kind(described[n])}
        if odd:
            return f"types {odd}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} and {len(theirs[1])}"
    unequal = [(a, b) for a, b in zip(mine[1], theirs[1], strict=True) if a != b]
    if unequal:
        a, b = unequal[0]
        parts = [(n, x, y) for n, x, y in zip(mine[0], a, b, strict=True) if x != y]
        return f"{len(unequal)} of {len(mine[1])} rows, first {parts}"
    return None


def main() -> int:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark, con = session(), database(sf_dir)
    oracle, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        started = time.perf_counter()
        try:
            if name in oracle:
                found = differences(spark, con, query, oracle[name], sf_dir)
            else:
                found = f"no check, {query(spark, sf_dir).count()} rows"
        except Exception as error:  # keep going: the report lists all failures
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name:28} {time.perf_counter() - started:6.1f}s  {found or 'equal'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
