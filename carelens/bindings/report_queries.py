"""The report and its parts over orders as line-list rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from carelens.bindings import clinical_queries
from carelens.bindings.line_list_sql import LINE_LIST
from carelens.bindings.stages import baseline_rows, line_list_rows
from carelens.bindings.stages_sql import (
    BASELINE,
    BLANKS,
    FILLED,
    FROM_EARLIER,
    KEYED,
    ORDERS,
    STAGE,
    final,
    numbered,
    report_columns,
)
from carelens.bindings.tables import PICKUP_END, table
from carelens.functions import blank_to_null
from carelens.plans import baseline, report
from carelens.session import shared_folder
from carelens.sources import publish, read_line_list, read_published, write_line_list


def _prepared(spark, sf):
    rows = blank_to_null(line_list_rows(spark, sf))
    return report.copied_columns(report.refill_columns(report.add_blank_columns(rows)))


def blank_columns(spark, sf):
    return report.add_blank_columns(line_list_rows(spark, sf).select("uuid"))


def report_projection(spark, sf):
    rows = _prepared(spark, sf).withColumn("S/N.", F.lit(0).cast("long"))
    return report.rename_report(report.project_report(report.viral_load_date(rows)))


def report_status(spark, sf):
    return report.report_status(_prepared(spark, sf), PICKUP_END).select(
        "uuid", "CurrentARTStatus", "PatientOutcomeDate", "ARTStatusPreviousQuarter",
        "PatientOutcomeDatePreviousQuarter", "PreviousARTStatus",
        F.col("PreviousARTStatusDate").cast("date").alias("PreviousARTStatusDate"),
        "CurrentRegimenLine", "ViralLoadIndication", F.col("`IIT Chance (%)`").alias("chance"),
        F.col("`Status at Registration`").alias("registration"))


def programme_report(spark, sf):
    return report.programme_report(line_list_rows(spark, sf), PICKUP_END)


def programme_report_quarter(spark, sf):
    return report.programme_report(line_list_rows(spark, sf), PICKUP_END, "previous_quarter")


def baseline_lookup(spark, sf):
    rows = baseline.attach_baseline(
        blank_to_null(line_list_rows(spark, sf)), blank_to_null(baseline_rows(spark, sf)), PICKUP_END)
    return rows.select(
        "uuid", baseline.earlier("status").alias("status"), baseline.earlier("Patient ID").alias("patient"),
        baseline.earlier("Case Manager").alias("manager"), baseline.earlier("TPT Type").alias("tpt_type"))


def merge_baseline(spark, sf):
    merged = report.merge_baseline(
        _prepared(spark, sf), blank_to_null(baseline_rows(spark, sf)), PICKUP_END)
    return merged.select(
        "uuid", "CurrentARTStatus", F.col("`CurrentViralLoad(c/ml)`").alias("vl"),
        F.col("`Date of Current Viral Load (yyyy-mm-dd)`").alias("vl_date"),
        F.col("`Date of Viral Load Sample Collection (yyyy-mm-dd)`").alias("sampled"),
        F.col("LastINHDispensedDate").cast("date").alias("tpt"), "ViralLoadIndication",
        F.col("`Patient id`").alias("patient"), F.col("`ART Enrollment Setting`").alias("setting"))


def programme_report_baseline(spark, sf):
    return report.programme_report_with_baseline(
        line_list_rows(spark, sf), baseline_rows(spark, sf), PICKUP_END)


def programme_report_repeated(spark, sf):
    listed = line_list_rows(spark, sf)
    return report.programme_report_with_baseline(
        listed.unionByName(listed), baseline_rows(spark, sf), PICKUP_END)


def programme_report_reactivated(spark, sf):
    return report.programme_report_with_baseline(
        line_list_rows(spark, sf), baseline_rows(spark, sf), PICKUP_END,
        reactivate_from_baseline=True)


def line_list_report(spark, sf):
    return report.programme_report(clinical_queries.line_list(spark, sf), PICKUP_END)


def _stage_cells(spark, sf):
    """Customers as line-list rows with line breaks, quotes, separators and blanks in their cells."""
    customer, home = table(spark, sf, "customer"), F.col("c_nationkey")
    return customer.select(
        F.concat(F.lit("c-"), F.col("c_custkey").cast("string")).alias("uuid"),
        F.concat(F.lit("State "), (home % 5).cast("string")).alias("State"),
        F.when(home % 5 == 0, "").when(home % 5 == 1, "F").otherwise("M").alias("Sex"),
        F.concat(F.col("c_name"), F.lit('\n"ward", '), home.cast("string"), F.lit("\r\n")).alias("Patient_Address"),
        F.concat(F.lit('  "'), "c_mktsegment", F.lit('\\" ,  ')).alias("OtherCauseOfDeath"),
        home.alias("Age"), F.date_add(F.lit("1960-01-01").cast("date"), home * 300).alias("DOB"),
        F.date_add(F.lit("2001-01-01").cast("date"), home).cast("timestamp_ntz").alias("LastPickupDate"))


def stage_round_trip(spark, sf):
    """A line list as delimited text, written and read again."""
    path = f"{shared_folder(spark)}/carelens-stage-{uuid.uuid4().hex}"
    write_line_list(_stage_cells(spark, sf), path, "csv")
    return read_line_list(spark, path, "csv", corrupt="corrupt")


def published_runs(spark, sf):
    """Two dates, of which the second is published again with other rows."""
    path = f"{shared_folder(spark)}/carelens-published-{uuid.uuid4().hex}"
    rows = _stage_cells(spark, sf).select("uuid", "State", "Age")
    publish(rows, path, "2001-03-31")
    publish(rows.filter("Age < 20"), path, "2001-06-30")
    publish(rows.filter("Age >= 20"), path, "2001-06-30")
    return read_published(spark, path).groupBy("end_date", "State").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("Age").alias("ages"))


QUERIES = {f.__name__: f for f in (
    blank_columns, report_projection, report_status, programme_report, programme_report_quarter,
    baseline_lookup, merge_baseline, programme_report_baseline, programme_report_repeated,
    programme_report_reactivated,
    line_list_report, stage_round_trip, published_runs)}

_STAGED = f"WITH {ORDERS}, {STAGE}, {numbered()}"
_REPORT = f"{_STAGED}, {final('numbered')}"
_MERGED = f"{_STAGED}, {KEYED}, {BASELINE}"
_REPEATED = (f"WITH {ORDERS}, {STAGE}, twice AS (SELECT stage.* FROM stage CROSS JOIN range(2)), "
             f"{numbered('twice')}, {KEYED}, {BASELINE}")

# What the projection finds before any rule has run.
_UNRULED = {
    **{k: v for k, v in FILLED.items() if k not in (
        "ViralLoadIndication", "Status at Registration", "IIT Chance (%)",
        "Date calculated (yyyy-mm-dd)")},
    "S/N.": "CAST(0 AS BIGINT)", "CurrentRegimenLine": "line", "InitialRegimenLine": "first_line",
    "CurrentARTStatus": "CASE status WHEN 'IIT' THEN 'LTFU' WHEN 'Dead' THEN 'Death' "
                        "WHEN 'Stopped' THEN 'Discontinued Care' WHEN 'Transferred Out' "
                        "THEN 'Transferred out' ELSE status END",
    "PatientOutcomeDate": "outcome_date",
    "PreviousARTStatus": "CASE before WHEN 'IIT' THEN 'LTFU' WHEN 'Dead' THEN 'Death' "
                         "WHEN 'Stopped' THEN 'Discontinued Care' WHEN 'Transferred Out' "
                         "THEN 'Transferred out' ELSE before END",
    "PreviousARTStatusDate": "before_date",
}
_QUARTER = {**FILLED, "PreviousARTStatus": "quarter_status", "PreviousARTStatusDate": "quarter_date"}

# The report of the line list, from the columns of the line list in SQL.
_LL_RENAMED = ("CASE {0} WHEN 'Death' THEN 'Dead' WHEN 'Discontinued Care' THEN 'Stopped' "
               "WHEN 'Transferred out' THEN 'Transferred Out' WHEN 'LTFU' THEN 'IIT' ELSE {0} END")
_LL_LINE = ("CASE {0} WHEN 'Adult 1st line ARV regimen' THEN 'Adult.1st.Line' "
            "WHEN 'Adult 2nd line ARV regimen' THEN 'Adult.2nd.Line' "
            "WHEN 'Adult 3rd line ARV regimen' THEN 'Adult.3rd.Line' "
            "WHEN 'Child 1st line ARV regimen' THEN 'Peds.1st.Line' "
            "WHEN 'Child 2nd line ARV regimen' THEN 'Peds.2nd.Line' ELSE {0} END")
_LL_STAGE = f"""
numbered AS (
  SELECT "State" AS state, "LGA" AS lga, "FaciityName" AS facility, "PatientHospitalNo" AS hospital_no,
    "PatientUniqueID" AS unique_id, CASE "Sex" WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' END AS sex,
    "DOB" AS dob, CAST("EnrollmentDate" AS DATE) AS enrolled,
    "TransferInStatus" = 'Transfer in with records' AS transferred,
    CAST("LastPickupDate" AS DATE) AS picked,
    CASE WHEN "ARTStartDate" = "LastPickupDate" THEN CAST("LastPickupDate" AS DATE) END AS started,
    CAST("ARTStartDate" AS DATE) AS art_start,
    "DaysOfARVRefil" AS days, CAST("LastPickupDate" AS DATE) + "DaysOfARVRefil" + 29 AS iit,
    "InitialRegimenLine" AS first_line, "CurrentRegimenLine" AS line, "InitialRegimen" AS first_regimen,
    "CurrentRegimen" AS regimen, "PregnancyStatus" AS pregnancy, "CurrentViralLoad(c/ml)" AS vl,
    greatest(CAST(strptime("ViralLoadReportedDate", '%d-%b-%Y') AS DATE), "LastViralLoadDate") AS vl_date,
    "LastDateOfSampleCollection" AS sampled, "CurrentWeight_Kg" AS weight,
    CAST("LastINHDispensedDate" AS DATE) AS tpt, "OTZStartDate" AS otz,
    {_LL_RENAMED.format('"CurrentARTStatus"')} AS status, CAST("PatientOutcomeDate" AS DATE) AS outcome_date,
    "CauseOfDeath" AS cause, "OtherCauseOfDeath" AS other, "DiscontinuedCareReason" AS reason,
    CAST("DateReturnedToCare" AS DATE) AS returned,
    {_LL_RENAMED.format('"PreviousARTStatus"')} AS before,
    CAST("PreviousARTStatusDate" AS DATE) AS before_date, "BiometricCaptured" AS captured,
    "BiometricCaptureDate" AS capture_date,
    row_number() OVER (ORDER BY "PatientHospitalNo" NULLS FIRST, uuid NULLS FIRST) AS n
  FROM line_list)"""
_LL_FILLED = {**FILLED, "ARTStartDate": "art_start", "VA Cause of Dead": "other",
              "InitialRegimenLine": _LL_LINE.format("first_line"),
              "CurrentRegimenLine": _LL_LINE.format("line")}

ORACLE = {
    "stage_round_trip": """
SELECT 'c-' || c_custkey AS uuid, 'State ' || c_nationkey % 5 AS "State",
  CASE c_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'F' ELSE 'M' END AS "Sex",
  c_name || chr(10) || '"ward", ' || c_nationkey || chr(13) || chr(10) AS "Patient_Address",
  '  "' || c_mktsegment || '\\" ,  ' AS "OtherCauseOfDeath", CAST(c_nationkey AS INTEGER) AS "Age",
  CAST(DATE '1960-01-01' + CAST(c_nationkey * 300 AS INTEGER) AS DATE) AS "DOB",
  CAST(DATE '2001-01-01' + CAST(c_nationkey AS INTEGER) AS TIMESTAMP) AS "LastPickupDate",
  CAST(NULL AS VARCHAR) AS corrupt
FROM customer""",
    "published_runs": """
SELECT end_date, 'State ' || c_nationkey % 5 AS "State", count(*) AS n_rows, sum(c_nationkey) AS ages
FROM customer, (VALUES (DATE '2001-03-31', 0), (DATE '2001-06-30', 20)) AS runs(end_date, least)
WHERE c_nationkey >= least GROUP BY ALL""",
    "blank_columns": f"{_STAGED} SELECT uuid, {BLANKS} FROM stage",
    "report_projection": f"{_STAGED} SELECT {report_columns(_UNRULED)} FROM stage",
    "report_status": f"""
{_REPORT} SELECT uuid, final_status AS "CurrentARTStatus", final_date AS "PatientOutcomeDate",
  quarter_status AS "ARTStatusPreviousQuarter", quarter_date AS "PatientOutcomeDatePreviousQuarter",
  final_before AS "PreviousARTStatus", final_before_date AS "PreviousARTStatusDate",
  {FILLED['CurrentRegimenLine']} AS "CurrentRegimenLine", band AS "ViralLoadIndication", chance,
  CASE WHEN transferred THEN 'ART Transfer In' END AS registration FROM ruled""",
    "programme_report": f"{_REPORT} SELECT {report_columns(FILLED)} FROM ruled",
    "programme_report_quarter": f"{_REPORT} SELECT {report_columns(_QUARTER)} FROM ruled",
    "baseline_lookup": f"""
{_MERGED} SELECT uuid, e_status AS status, e_patient AS patient, e_manager AS manager,
  e_tpt_type AS tpt_type FROM merged""",
    "merge_baseline": f"""
{_MERGED} SELECT uuid, status AS "CurrentARTStatus", vl, vl_date, sampled, tpt,
  CASE WHEN vl_date IS NOT NULL AND vl <= 1000 THEN 'Routine - Routine'
       WHEN vl_date IS NOT NULL AND vl > 1000 THEN 'Targeted - Post EAC' END AS "ViralLoadIndication",
  e_patient AS patient, e_setting AS setting FROM merged""",
    "programme_report_baseline": f"""
{_MERGED}, {final('merged')} SELECT {report_columns(FILLED | FROM_EARLIER)} FROM ruled""",
    "programme_report_repeated": f"""
{_REPEATED}, {final('merged')} SELECT {report_columns(FILLED | FROM_EARLIER)} FROM ruled""",
    "programme_report_reactivated": f"""
{_MERGED}, reactivated AS (
  SELECT * REPLACE (CASE WHEN status = 'IIT' AND e_status = 'Active' THEN 'Active(A)' ELSE status END AS status)
  FROM merged), {final('reactivated')} SELECT {report_columns(FILLED | FROM_EARLIER)} FROM ruled""",
    "line_list_report": f"""
{LINE_LIST}, {_LL_STAGE}, {final('numbered').replace('ruled AS', 'reported AS')}
SELECT {report_columns(_LL_FILLED)} FROM reported""",
}
