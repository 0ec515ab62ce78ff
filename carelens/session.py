"""Session settings the operators count on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits skewed join partitions at run time, also where the join
# feeds an aggregation on the same key.  The rows here are wide: generated methods too
# long for the JVM to compile (8,000 bytes) would run interpreted, so Spark falls back to
# its split-up expression code for them.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings; all of them can be set on a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, which all executors share too; never a
    folder of one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/carelens-work"
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table of its own in the shared folder and read it back.

    The rows survive the loss of executors, are computed once however often they are
    used, and readers take only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/carelens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
