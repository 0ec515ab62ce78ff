"""Ordered status rules of the line list."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions import end_of_last_quarter, iit_date, status_not_in
from carelens.plans.concepts import ENDED


def quarter_status(df: DataFrame, end_date: dt.date | str) -> DataFrame:
    """Status at the end of the previous quarter.

    The recorded outcome, else, for those with a pickup by then, Active while the
    interruption date is not before the quarter end.
    """
    due = iit_date("LastPickupDatePreviousQuarter", "DrugDurationPreviousQuarter")
    active = (due >= end_of_last_quarter(end_date)) & status_not_in(
        "PatientOutcomePreviousQuarter", ENDED)
    computed = F.when(F.col("LastPickupDatePreviousQuarter").isNotNull(),
                      F.when(active, "Active").otherwise("LTFU"))
    return df.withColumn("ARTStatusPreviousQuarter",
                         F.coalesce("PatientOutcomePreviousQuarter", computed))


# Columns the rules need but a line list does not keep.
HELPERS = ("PreviousLastPickupDate", "PreviousDaysOfARVRefil", "PreviousIITDate")


def drop_helpers(df: DataFrame, suffix: str = "_baseline") -> DataFrame:
    """Drop what only the rules needed, and the columns brought over to compare."""
    return df.drop(*HELPERS, *[c for c in df.columns if c.endswith(suffix)])


def previous_iit_date(df: DataFrame) -> DataFrame:
    return df.withColumn("PreviousIITDate",
                         iit_date("PreviousLastPickupDate", "PreviousDaysOfARVRefil"))


def returned_to_care(df: DataFrame) -> DataFrame:
    """Active again after the previous refill had lapsed: the last pickup is the return."""
    df = previous_iit_date(df)
    back = (
        F.col("PreviousLastPickupDate").isNotNull()
        & (F.col("LastPickupDate") > F.col("PreviousIITDate"))
        & (F.col("CurrentARTStatus") == "Active")
    )
    return df.withColumn("DateReturnedToCare", F.coalesce(
        "DateReturnedToCare", F.when(back, F.col("LastPickupDate"))))


def previous_status(df: DataFrame, with_date: bool = True) -> DataFrame:
    """Status before the last pickup and the date it is confirmed for."""
    if "PreviousIITDate" not in df.columns:
        df = previous_iit_date(df)
    kept = (F.col("PreviousIITDate") >= F.col("LastPickupDate")) & status_not_in(
        "PatientOutcomePreviousQuarter", ENDED)
    computed = F.when(F.col("PreviousLastPickupDate").isNotNull(),
                      F.when(kept, "Active").otherwise("LTFU"))
    df = df.withColumn("PreviousARTStatus",
                       F.coalesce("PatientOutcomePreviousQuarter", computed))
    if not with_date:
        return df
    status = F.col("PreviousARTStatus")
    return df.withColumn("PreviousARTStatusDate", F.coalesce(
        F.col("PatientOutcomeDatePreviousQuarter"),
        F.when(status == "LTFU", F.col("PreviousIITDate").cast("timestamp_ntz")),
        F.when(status == "Active", F.col("PreviousLastPickupDate")),
    ))
