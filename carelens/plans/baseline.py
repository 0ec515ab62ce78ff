"""Merging a line list with an earlier report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions import composite_key, day, fill_where, iit_date, newest, status_not_in, strip_zeros
from carelens.operators.keys import match
from carelens.operators.rows import drop_all_duplicates, first_letters
from carelens.plans.concepts import ENDED_REPORTED
from carelens.plans.report_columns import COMPARED_WITH_BASELINE, TAKEN_FROM_BASELINE
from carelens.plans.rules import drop_helpers

KEY = "__key"
LETTERED = "__lettered"
SUFFIX = "_baseline"
# Refill assumed for an earlier row that gives none.
UNKNOWN_REFILL_DAYS = 15
DAYS_PER_MONTH = 30


def list_key(df: DataFrame, sep: str = "") -> DataFrame:
    """Text key of a line-list row; all-digit identifiers lose their leading zeros."""
    return df.withColumn(KEY, composite_key(
        "LGA", "FaciityName", strip_zeros("PatientHospitalNo"), strip_zeros("PatientUniqueID"),
        sep=sep))


def baseline_key(base: DataFrame, sep: str = "") -> DataFrame:
    """Text key of an earlier report's row; its identifiers are taken as they are."""
    return base.withColumn(KEY, composite_key(
        "LGA", "Facility", "Hospital Number", "Unique ID", sep=sep))


def revalidate(base: DataFrame, end_date: dt.date | str) -> DataFrame:
    """Whether an earlier row would still be active at the end date."""
    days = F.coalesce(F.round(F.col("Months of ARV Refill") * DAYS_PER_MONTH),
                      F.lit(UNKNOWN_REFILL_DAYS))
    due = iit_date("Last Pickup Date (yyyy-mm-dd)", days)
    kept = (due >= day(end_date)) & status_not_in("Current ART Status", ENDED_REPORTED)
    return base.withColumn("status", F.when(kept, "Active").otherwise("Inactive"))


def attach_baseline(df: DataFrame, base: DataFrame, end_date: dt.date | str,
                    order: tuple[str, ...] = ("PatientHospitalNo", "uuid"),
                    sep: str = "", row: str | None = None) -> DataFrame:
    """Bring the compared and taken columns of the earlier report over.

    A key that occurs twice in the earlier report is left out, and one that occurs
    twice in the list gets letters, so neither matches.  Keys alone meet the earlier report;
    what they find comes back to the list in its one shuffle, by ``row`` where that column
    of ``order`` is unique in the whole list, else by key and order.
    """
    if "Patient ID" not in base.columns:
        base = base.withColumnRenamed("Patient id", "Patient ID")
    columns = ["status", *COMPARED_WITH_BASELINE, *TAKEN_FROM_BASELINE.values()]
    earlier = revalidate(baseline_key(base, sep), end_date)
    earlier = drop_all_duplicates(
        earlier.select(KEY, *[F.col(f"`{c}`") for c in columns]), KEY)
    keyed = list_key(df, sep)
    lettered = first_letters(keyed.select(KEY, *[F.col(f"`{c}`") for c in order]), KEY, order, LETTERED)
    found = match(lettered, earlier.withColumnsRenamed({c: f"{c}{SUFFIX}" for c in columns}),
                  LETTERED, KEY, "inner").drop(LETTERED)
    if row is not None:
        own = found.select(F.col(f"`{row}`"), *[F.col(f"`{c}{SUFFIX}`") for c in columns])
        return match(df, own, row, row)
    place = [KEY, *order]
    return match(keyed, found, place, place, null_safe=True).drop(KEY)


def earlier(name: str):
    return F.col(f"`{name}{SUFFIX}`")


def reactivate(df: DataFrame) -> DataFrame:
    """Lost patients whom the earlier report still has as active."""
    return fill_where(df, "CurrentARTStatus",
                      (F.col("CurrentARTStatus") == "LTFU") & (earlier("status") == "Active"),
                      "Active(A)")


def take_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({n: earlier(b) for n, b in TAKEN_FROM_BASELINE.items()})


def newer_viral_load(df: DataFrame) -> DataFrame:
    """The earlier value where its date is newer, or the only one."""
    mine, theirs = F.col("`Date of Current Viral Load (yyyy-mm-dd)`"), earlier(
        "Date of Current Viral Load (yyyy-mm-dd)")
    value = earlier("Current Viral Load (c/ml)")
    wins = (mine.isNull() & theirs.isNotNull()) | ((theirs > mine) & value.isNotNull())
    return fill_where(df, "CurrentViralLoad(c/ml)", wins, value)


def newer_dates(df: DataFrame) -> DataFrame:
    pairs = {
        "Date of Current Viral Load (yyyy-mm-dd)": "Date of Current Viral Load (yyyy-mm-dd)",
        "Date of Viral Load Sample Collection (yyyy-mm-dd)":
            "Date of Viral Load Sample Collection (yyyy-mm-dd)",
        "LastINHDispensedDate": "Date of TPT Start (yyyy-mm-dd)",
    }
    return df.withColumns({
        mine: newest(F.col(f"`{mine}`"), earlier(theirs).cast(dict(df.dtypes)[mine]))
        for mine, theirs in pairs.items()})


def update_from_baseline(df: DataFrame) -> DataFrame:
    """Taken columns, then the value (which looks at the dates), then the dates."""
    return drop_helpers(newer_dates(newer_viral_load(take_columns(df))), SUFFIX)
