"""The 66-column programme report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions import (
    blank_to_null,
    fill_where,
    iit_chance,
    iit_date,
    months_of_refill,
    newest,
    parse_date,
    recode,
    vl_indication,
)
from carelens.operators.rows import number_rows
from carelens.plans import baseline as earlier_report
from carelens.plans.report_columns import (
    BLANK_COLUMNS,
    DATE_COLUMNS,
    READ_COLUMNS,
    REGIMEN_LINES,
    REPORT_COLUMNS,
    SEX,
    STATUSES,
)

# Rows without a hospital number are told apart by their facility.
ROW_ORDER = ("State", "LGA", "FaciityName", "PatientHospitalNo", "uuid")
VL_DATE = "Date of Current Viral Load (yyyy-mm-dd)"
TRANSFERRED = "Transfer in with records"


def add_blank_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast("string") for c in BLANK_COLUMNS})


def refill_columns(df: DataFrame) -> DataFrame:
    """Interruption date from the days of refill, which then become months."""
    return df.withColumn("iit", iit_date("LastPickupDate", "DaysOfARVRefil")).withColumn(
        "DaysOfARVRefil", months_of_refill("DaysOfARVRefil"))


def copied_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "Sex": recode("Sex", SEX),
        "If Dead, Cause of Dead": F.col("CauseOfDeath"),
        "VA Cause of Dead": F.col("OtherCauseOfDeath"),
        "Reason for Transfer-Out / IIT / Stooped Treatment": F.col("DiscontinuedCareReason"),
        "Date of Viral Load Sample Collection (yyyy-mm-dd)": F.col("LastDateOfSampleCollection"),
    })


def outcome_dates(df: DataFrame) -> DataFrame:
    """Missing outcome date: the interruption date when lost, the pickup when active."""
    status = F.col("CurrentARTStatus")
    return df.withColumn("PatientOutcomeDate", F.coalesce(
        F.col("PatientOutcomeDate").cast("date"),
        F.when(status == "LTFU", F.col("iit")),
        F.when(status == "Active", F.col("LastPickupDate").cast("date"))))


def quarter_dates(df: DataFrame) -> DataFrame:
    status = F.col("ARTStatusPreviousQuarter")
    pickup = F.col("LastPickupDatePreviousQuarter")
    return df.withColumn("PatientOutcomeDatePreviousQuarter", F.coalesce(
        F.col("PatientOutcomeDatePreviousQuarter").cast("date"),
        F.when(status == "LTFU", iit_date(pickup, "DrugDurationPreviousQuarter")),
        F.when(status == "Active", pickup.cast("date"))))


def report_names(df: DataFrame) -> DataFrame:
    """Regimen lines and statuses under the names of the report."""
    return df.withColumns({
        "ARTStatusPreviousQuarter": recode("ARTStatusPreviousQuarter", STATUSES),
        "CurrentRegimenLine": recode("CurrentRegimenLine", REGIMEN_LINES),
        "InitialRegimenLine": recode("InitialRegimenLine", REGIMEN_LINES),
        "CurrentARTStatus": recode("CurrentARTStatus", STATUSES),
    })


def viral_load_date(df: DataFrame) -> DataFrame:
    kinds = dict(df.dtypes)

    def as_day(name: str):
        return parse_date(name) if kinds[name] == "string" else F.col(name).cast("date")

    return df.withColumn(VL_DATE, newest(as_day("ViralLoadReportedDate"), as_day("LastViralLoadDate")))


def viral_load_band(df: DataFrame) -> DataFrame:
    return df.withColumn("ViralLoadIndication", vl_indication(
        F.col(f"`{VL_DATE}`"), F.col("`CurrentViralLoad(c/ml)`")))


def interruption_chance(df: DataFrame, end_date: dt.date | str) -> DataFrame:
    chance = iit_chance("iit", end_date, "CurrentARTStatus")
    return df.withColumns({
        "IIT Chance (%)": chance,
        "Date calculated (yyyy-mm-dd)": F.when(chance.isNotNull(), F.col("iit")),
    })


def previous_names(df: DataFrame) -> DataFrame:
    """Previous status of transferred and new patients, then the report names."""
    df = fill_where(df, "PreviousARTStatus",
                    (F.col("TransferInStatus") == TRANSFERRED)
                    & (F.col("PreviousARTStatus") == "Active"), "Active-Transfer In")
    new = F.col("LastPickupDate") == F.col("ARTStartDate")
    return df.withColumns({
        "PreviousARTStatus": recode(
            F.when(new & F.col("PreviousARTStatus").isNull(), "HIV+ non ART")
            .otherwise(F.col("PreviousARTStatus")), STATUSES),
        "PreviousARTStatusDate": F.when(
            new & F.col("PreviousARTStatusDate").isNull(), F.col("EnrollmentDate"))
        .otherwise(F.col("PreviousARTStatusDate")),
    })


def restarts(df: DataFrame) -> DataFrame:
    """Restarted, then transferred-in patients; a restart keeps its name."""
    active = F.col("CurrentARTStatus").isin("Active", "Active(A)")
    returned = F.col("DateReturnedToCare").isNotNull()
    df = df.withColumns({
        "PatientOutcomeDate": F.when(
            returned & (active | (F.col("CurrentARTStatus") == "Active-Restart")),
            F.col("DateReturnedToCare").cast("date")).otherwise(F.col("PatientOutcomeDate")),
        "CurrentARTStatus": F.when(returned & active, "Active-Restart")
        .otherwise(F.col("CurrentARTStatus")),
    })
    transferred = F.col("TransferInStatus") == TRANSFERRED
    return df.withColumns({
        "CurrentARTStatus": F.when(transferred & active, "Active-Transfer In")
        .otherwise(F.col("CurrentARTStatus")),
        "Status at Registration": F.when(
            F.col("`Status at Registration`").isNull() & transferred, "ART Transfer In")
        .otherwise(F.col("`Status at Registration`")),
    })


def report_status(df: DataFrame, end_date: dt.date | str,
                  with_previous_names: bool = True) -> DataFrame:
    """The status rules of a report without an earlier one, in their order."""
    df = quarter_dates(outcome_dates(df))
    df = viral_load_band(viral_load_date(report_names(df)))
    df = interruption_chance(df, end_date)
    if with_previous_names:
        df = previous_names(df)
    return restarts(df)


def project_report(df: DataFrame, status_source: str = "previous") -> DataFrame:
    """The report's columns in order; days become dates, what does not parse is NULL."""
    kinds = dict(df.dtypes)
    replaced = {} if status_source == "previous" else {
        "PreviousARTStatus": "ARTStatusPreviousQuarter",
        "PreviousARTStatusDate": "PatientOutcomeDatePreviousQuarter",
    }

    def cell(name: str):
        source = replaced.get(name, name)
        c = F.col(f"`{source}`")
        if name not in DATE_COLUMNS:
            return c
        return parse_date(c) if kinds[source] == "string" else c.cast("date")

    return df.select([cell(name).alias(name) for name, _ in REPORT_COLUMNS])


def rename_report(df: DataFrame) -> DataFrame:
    return df.toDF(*[heading for _, heading in REPORT_COLUMNS])


def _numbered(line_list: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The columns a report reads, numbered; a blank cell is a missing value.

    Numbering stores these columns, and does so when it is called.
    """
    kept = {*READ_COLUMNS, *order}
    needed = blank_to_null(line_list.select([F.col(f"`{c}`") for c in line_list.columns if c in kept]))
    return number_rows(needed, order, out="S/N.")


def _prepared(numbered: DataFrame) -> DataFrame:
    """Numbered list with blank and derived columns."""
    return copied_columns(refill_columns(add_blank_columns(numbered)))


def programme_report(line_list: DataFrame, end_date: dt.date | str,
                     status_source: str = "previous",
                     order: tuple[str, ...] = ROW_ORDER) -> DataFrame:
    """The report of a line list.

    ``status_source='previous_quarter'`` reports the status at the end of the previous
    quarter in place of the status before the last pickup.
    """
    df = _prepared(_numbered(line_list, order))
    df = report_status(df, end_date, with_previous_names=status_source == "previous")
    return rename_report(project_report(df, status_source))


def merge_baseline(df: DataFrame, base: DataFrame, end_date: dt.date | str,
                   reactivate_from_baseline: bool = False,
                   order: tuple[str, ...] = ROW_ORDER, key_sep: str = "") -> DataFrame:
    """Rules up to the viral-load date, merge with the earlier report, then the band.

    By default the reactivation rule never fires, because lost patients already have
    another name when it is asked; ``reactivate_from_baseline`` asks it before.
    """
    return _merged(earlier_report.attach_baseline(df, base, end_date, order, key_sep),
                   reactivate_from_baseline)


def _merged(df: DataFrame, reactivate_from_baseline: bool) -> DataFrame:
    """The rules of a list that has the columns of the earlier report beside its own."""
    df = quarter_dates(outcome_dates(df))
    if reactivate_from_baseline:
        df = earlier_report.reactivate(df)
    df = viral_load_date(report_names(df))
    df = earlier_report.update_from_baseline(df)
    return viral_load_band(df)


def programme_report_with_baseline(line_list: DataFrame, base: DataFrame,
                                   end_date: dt.date | str,
                                   reactivate_from_baseline: bool = False,
                                   status_source: str = "previous",
                                   order: tuple[str, ...] = ROW_ORDER,
                                   key_sep: str = "") -> DataFrame:
    """The report of a line list, updated from an earlier report."""
    # Letters of repeated keys follow the serial number: it is unique where ``order`` may tie.  The
    # stored columns alone are shuffled; what follows from them is added after.
    df = earlier_report.attach_baseline(
        _numbered(line_list, order), blank_to_null(base), end_date, ("S/N.",), key_sep, row="S/N.")
    df = _merged(_prepared(df), reactivate_from_baseline)
    df = interruption_chance(df, end_date)
    if status_source == "previous":
        df = previous_names(df)
    return rename_report(project_report(restarts(df), status_source))
