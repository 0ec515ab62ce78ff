"""A stored clinical record in which the rows of a person lie together.

Tables with a person are bucketed by it, all alike, and sorted within a file (observations by
concept).  Aggregates by person and joins of person parts then need no shuffle, and the
scan of a few concepts skips most row groups.  A store is a folder: whoever reads it
registers its tables in a catalog of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.sources.tables import SCHEMAS

#: The person column of every table that has one.
PERSON_OF = {
    "patient": "patient_id",
    "patient_identifier": "patient_id",
    "obs": "person_id",
    "encounter": "patient_id",
    "person": "person_id",
    "person_name": "person_id",
    "person_attribute": "person_id",
    "person_address": "person_id",
    "patient_program": "patient_id",
    "biometricinfo": "patient_Id",
    "biometricverificationinfo": "patient_Id",
}
#: What rows of a bucket are sorted by; the person where nothing is said.
SORTED_BY = {"obs": "concept_id"}
#: Written last: how many rows each bucket has.  A folder without it is no whole store.
COUNTS = "_buckets"
_COUNTED = "store string, table string, buckets int, bucket int, n long"


def _keys(table: str, site: str | None) -> list[str]:
    return [*([site] if site else []), PERSON_OF[table]]


def _bucket(keys: list[str], buckets: int) -> Column:
    """The bucket Spark's writer puts a row into."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _registered(database: str, store: str, table: str) -> str:
    return f"{database}.carelens_{store}_{table}"


def write_clustered(tables: Mapping[str, DataFrame], path: str, buckets: int = 512, *,
                    site: str | None = None, database: str = "default", at_once: int = 6) -> str:
    """Write the clinical tables as a store in a new folder; gives the store's id.

    Rows go to the writers by ranges of buckets, which Spark finds from a sample, and within a
    bucket by the hash of the whole row: a person with a third of all rows is written by
    many tasks, as several files of one bucket.  Equal rows alone stay together.  An
    existing folder is an error; a run that fails leaves a folder that ``load_clustered``
    refuses.  A missing person is a bucket's row like any other.

    ``at_once`` tables are written at a time, observations first: most tables have too few
    splits to fill a cluster alone.
    """
    missing = sorted(SCHEMAS.keys() - tables.keys())
    if missing:
        raise ValueError(f"no table {', '.join(missing)}")
    spark = tables["obs"].sparkSession
    store = uuid.uuid4().hex

    def write(table: str) -> DataFrame | None:
        df, folder = tables[table], f"{path}/{table}"
        if table not in PERSON_OF:
            df.write.parquet(folder)
            return None
        keys = _keys(table, site)
        spread = df.repartitionByRange(_bucket(keys, buckets), F.xxhash64(*df.columns))
        spread.write.format("parquet").bucketBy(buckets, *keys).sortBy(
            SORTED_BY.get(table, keys[-1])).option("path", folder).saveAsTable(
            _registered(database, store, table))
        # An empty table has a row as well: that without a bucket.
        filled = spark.read.schema(df.schema).parquet(folder).groupBy(
            _bucket(keys, buckets).alias("bucket")).agg(F.count("*").alias("n"))
        none = spark.range(1).select(F.lit(None).cast("int").alias("bucket"), F.lit(0).cast("long").alias("n"))
        return filled.union(none).select(
            F.lit(store).alias("store"), F.lit(table).alias("table"),
            F.lit(buckets).alias("buckets"), "bucket", "n")

    with ThreadPoolExecutor(at_once) as pool:
        order = sorted(tables, key=lambda table: table != "obs")
        running = [pool.submit(inheritable_thread_target(spark)(write), table) for table in order]
        counts = [df for df in (x.result() for x in running) if df is not None]
    reduce(DataFrame.union, counts).write.parquet(f"{path}/{COUNTS}")
    return store


def load_clustered(spark: SparkSession, path: str, *, site: str | None = None,
                   database: str = "default", skew: float = 4.0,
                   skewed_rows: int = 1_000_000) -> dict[str, DataFrame]:
    """The clinical tables of a store.

    A bucket is read by one task.  A table whose largest bucket has over ``skew`` times the
    rows of an average one, and over ``skewed_rows`` rows, is therefore read without its
    buckets, in splits: Spark shuffles it, combined on the map side, and adaptive
    execution splits what is hot.  The rows are the same.
    """
    counted = spark.read.schema(_COUNTED).parquet(f"{path}/{COUNTS}").groupBy(
        "store", "table", "buckets").agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    # One row per table.
    known = {r["table"]: r for r in counted.collect()}
    extra = f"{site} string, " if site else ""
    tables = {}
    for table, schema in SCHEMAS.items():
        folder, row = f"{path}/{table}", known.get(table)
        hot = row is not None and row["most"] > max(skewed_rows, skew * row["n"] / row["buckets"])
        if row is None or hot:
            tables[table] = spark.read.schema(extra + schema).parquet(folder)
            continue
        keys, name = _keys(table, site), _registered(database, row["store"], table)
        if not spark.catalog.tableExists(name):
            place = folder.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"""
CREATE TABLE IF NOT EXISTS {name} ({extra}{schema}) USING parquet
CLUSTERED BY ({", ".join(keys)}) SORTED BY ({SORTED_BY.get(table, keys[-1])})
INTO {row["buckets"]} BUCKETS LOCATION '{place}'""")
        tables[table] = spark.table(name)
    return tables


def forget_clustered(spark: SparkSession, path: str, *, database: str = "default") -> None:
    """Take a store's tables out of the catalog; its files stay."""
    known = spark.read.schema(_COUNTED).parquet(f"{path}/{COUNTS}").select("store", "table").distinct()
    for row in known.collect():
        spark.sql(f"DROP TABLE IF EXISTS {_registered(database, row['store'], row['table'])}")
