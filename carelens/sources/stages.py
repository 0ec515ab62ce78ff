"""Line-list and report files.

A stage file is Parquet or delimited text with a header.  Text cells are untyped;
blank cells are missing values.  In delimited text a cell may hold line breaks, quotes and
separators: it is quoted, and quotes in it are doubled.  Blanks around a cell stay.

Published runs are complete or not there at all: a run is written beside the others, and only
then entered in an index, from which readers take the newest run of each date.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.functions.dates import parse_date
from carelens.functions.text import blank_to_null

# Line-list columns that are numbers.
LINE_LIST_NUMBERS = {
    "Age": "int", "AgeAtStartOfARTYears": "int", "AgeAtStartOfARTMonths": "int",
    "DaysOfARVRefil": "int", "DrugDurationPreviousQuarter": "int",
    "CurrentViralLoad(c/ml)": "double", "CurrentWeight_Kg": "double",
    "CurrentHeight_Kg": "double", "Days_To_Schedule": "int", "RecaptureCount": "int",
}
# Line-list columns that are instants, and those that are days.
LINE_LIST_INSTANTS = (
    "HIVConfirmedDate", "ARTStartDate", "LastPickupDate", "LastPickupDatePreviousQuarter",
    "LastINHDispensedDate", "EnrollmentDate", "MarkAsDeseasedDeathDate", "DateOfTermination",
    "DateCreated", "PatientOutcomeDatePreviousQuarter", "PatientOutcomeDate",
    "DateReturnedToCare", "PreviousARTStatusDate",
)
LINE_LIST_DAYS = ("DOB", "LastViralLoadDate", "LastDateOfSampleCollection", "BiometricCaptureDate")
# Columns of an earlier report that are numbers, and those that are days.
BASELINE_NUMBERS = {"Months of ARV Refill": "double", "Current Viral Load (c/ml)": "double"}
BASELINE_DAYS = (
    "Last Pickup Date (yyyy-mm-dd)", "Date of Current Viral Load (yyyy-mm-dd)",
    "Date of Viral Load Sample Collection (yyyy-mm-dd)",
    "Date Commenced DMOC (yyyy-mm-dd)",
    "Date of Return of DMOC Client to Facility (yyyy-mm-dd)",
    "Date of TPT Start (yyyy-mm-dd)", "TPT Completion date (yyyy-mm-dd)",
)


#: How cells are quoted, on both sides.
QUOTING = {"header": True, "quote": '"', "escape": '"', "emptyValue": "",
           "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _read(spark: SparkSession, path: str, fmt: str, corrupt: str | None, multi_line: bool) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    # Only the header line is read here; without inference all cells are text.
    options = {**QUOTING, "nullValue": "", "multiLine": multi_line}
    plain = spark.read.options(**options).csv(path)
    if corrupt is None:
        return plain
    schema = T.StructType([*plain.schema.fields, T.StructField(corrupt, T.StringType())])
    return spark.read.options(**options, columnNameOfCorruptRecord=corrupt, mode="PERMISSIVE").schema(schema).csv(path)


def _typed(df: DataFrame, numbers: dict[str, str], instants: tuple[str, ...],
           days: tuple[str, ...]) -> DataFrame:
    kinds = dict(df.dtypes)

    def cell(name: str):
        c = F.col(f"`{name}`")
        if kinds[name] != "string":
            return c
        if name in numbers:
            return c.try_cast("double").try_cast(numbers[name]).alias(name)
        if name in instants:
            return F.coalesce(c.try_cast("timestamp_ntz"),
                              parse_date(c).cast("timestamp_ntz")).alias(name)
        if name in days:
            return parse_date(c).alias(name)
        return c

    return df.select([cell(n) for n in df.columns])


def read_line_list(spark: SparkSession, path: str, fmt: str = "parquet",
                   corrupt: str | None = None, multi_line: bool = True) -> DataFrame:
    """A line list; blank cells are NULL, cells that do not parse are NULL.

    ``corrupt`` names a further column with the text of rows that have more or fewer cells
    than the header; it is NULL for all others.  With line breaks in cells a file of
    delimited text is read by one task; ``multi_line=False`` splits large files that have none.
    """
    return _typed(blank_to_null(_read(spark, path, fmt, corrupt, multi_line)),
                  LINE_LIST_NUMBERS, LINE_LIST_INSTANTS, LINE_LIST_DAYS)


def read_baseline(spark: SparkSession, path: str, fmt: str = "parquet",
                  corrupt: str | None = None, multi_line: bool = True) -> DataFrame:
    """An earlier report, read as a line list is."""
    return _typed(blank_to_null(_read(spark, path, fmt, corrupt, multi_line)), BASELINE_NUMBERS, (), BASELINE_DAYS)


def write_line_list(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: tuple[str, ...] = ("State",), mode: str = "error") -> None:
    """Write a line list, as Parquet in one folder per state.

    Rows of a state come together before the write, in several tasks where it is large.
    """
    if fmt == "parquet":
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).options(**QUOTING).csv(path)


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        df.write.mode(mode).options(**QUOTING).csv(path)


INDEX = "end_date date, run string, published_at timestamp, n_rows long"


def publish(df: DataFrame, path: str, end_date: dt.date | str,
            partition_by: tuple[str, ...] = ("State",)) -> str:
    """Make ``df`` the run of ``end_date`` under ``path``; returns the name of the run.

    Other dates stay as they are.  A run that fails, or is repeated, changes nothing that
    readers see until its entry in the index, one file, is written.  Earlier runs of the
    date stay on disk for readers that have begun; ``retired_runs`` lists them.
    """
    spark, run = df.sparkSession, f"r{uuid.uuid4().hex}"
    folder = f"{path.rstrip('/')}/runs/run={run}"
    write_line_list(df, folder, partition_by=partition_by)
    rows = spark.read.schema(df.schema).parquet(folder).agg(F.count(F.lit(1)).alias("n_rows"))
    rows.select(F.lit(str(end_date)).cast("date").alias("end_date"), F.lit(run).alias("run"),
                F.current_timestamp().alias("published_at"), "n_rows") \
        .coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/index")
    return run


def _newest_runs(spark: SparkSession, path: str) -> DataFrame:
    index = spark.read.schema(INDEX).parquet(f"{path.rstrip('/')}/index")
    return index.groupBy("end_date").agg(F.max_by("run", F.struct("published_at", "run")).alias("run"))


def read_published(spark: SparkSession, path: str, end_date: dt.date | str | None = None) -> DataFrame:
    """The newest run of every date, or of one, with ``end_date`` as a column.

    Runs are folders, so only those wanted are read: the index, a row for each run, prunes them.
    """
    runs = _newest_runs(spark, path)
    if end_date is not None:
        runs = runs.filter(F.col("end_date") == F.lit(str(end_date)).cast("date"))
    return spark.read.option("basePath", f"{path.rstrip('/')}/runs").parquet(f"{path.rstrip('/')}/runs") \
        .join(runs, "run").drop("run")


def retired_runs(spark: SparkSession, path: str) -> DataFrame:
    """``run`` and ``end_date`` of runs that a newer one replaced; their folders may be removed."""
    index = spark.read.schema(INDEX).parquet(f"{path.rstrip('/')}/index")
    return index.join(_newest_runs(spark, path), "run", "left_anti").select("run", "end_date")
