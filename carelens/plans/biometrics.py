"""Biometric capture status per hospital number."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions import format_date, normalise_id
from carelens.operators.filters import has_identifier, live, wrong_template
from carelens.operators.keys import Keys, key_list, match
from carelens.operators.lookups import attach_parameters
from carelens.operators.summaries import rollup_by_identifier
from carelens.plans.concepts import DATIM_PROPERTY, HOSPITAL_NUMBER, PROGRAM, UNIQUE_ID


def hospital_numbers(identifiers: DataFrame, site: Keys = (), normalise_ids: bool = False) -> DataFrame:
    """Live hospital numbers; a patient who has several gets a row for each."""
    s = key_list(site)
    rows = has_identifier(identifiers).filter(F.col("identifier_type") == HOSPITAL_NUMBER)
    number = normalise_id("identifier") if normalise_ids else F.col("identifier")
    return rows.groupBy(*s, "patient_id", number.alias("PatientHospitalNo")).agg(
        F.min("uuid").alias("uuid"))


BIOMETRIC_COLUMNS = (
    "EnrollmentDate", "RecaptureDate", "RecaptureCount", "BiometricCaptured",
    "BiometricCaptureDate", "ValidCapture",
)


def biometric_rows(tables: Mapping[str, DataFrame], site: Keys = (),
                   normalise_ids: bool = False, more: Sequence[str] = ()) -> DataFrame:
    """Enrolment, capture, recapture and validity of prints per hospital number.

    A number that several patients share has the row of the smallest patient id.
    ``more`` names identifiers to add.
    """
    s = key_list(site)
    patient = [*s, "patient_id"]
    captures = [*s, "patient_Id"]
    rows = live(tables["patient"]).select(*patient).join(
        hospital_numbers(tables["patient_identifier"], s, normalise_ids), patient)
    if "PatientUniqueID" in more:
        unique_ids = live(tables["patient_identifier"]).filter(
            F.col("identifier_type") == UNIQUE_ID).groupBy(*patient).agg(
            F.min("identifier").alias("PatientUniqueID"))
        rows = rows.join(unique_ids, patient, "left")
    enrolled = live(tables["patient_program"]).filter(F.col("program_id") == PROGRAM).groupBy(
        *patient).agg(F.min("date_enrolled").alias("EnrollmentDate"))
    rows = rows.join(enrolled, patient, "left")
    # First capture and validity come from one scan: templates are wide.
    prints = tables["biometricinfo"]
    per_patient = prints.groupBy(*captures).agg(
        F.min("date_created").alias("first_capture"),
        F.max(wrong_template(prints)).alias("invalid"))
    rows = match(rows, per_patient, patient, captures)
    again = tables["biometricverificationinfo"].groupBy(*captures).agg(
        F.max("date_created").alias("RecaptureDate"),
        F.min("recapture_count").alias("RecaptureCount"))
    rows = match(rows, again, patient, captures)
    captured = F.col("first_capture").isNotNull()
    rows = rows.withColumns({
        "BiometricCaptured": F.when(captured, "Yes").otherwise("No"),
        "BiometricCaptureDate": F.col("first_capture").cast("date"),
        "ValidCapture": F.when(~captured, "").when(F.col("invalid"), "No").otherwise("Yes"),
    })
    rolled = rollup_by_identifier(
        rows, [*s, "PatientHospitalNo"], [], [*more, *BIOMETRIC_COLUMNS], by="patient_id")
    return rolled.withColumn("RecaptureDate", format_date("RecaptureDate"))


def biometric_status(tables: Mapping[str, DataFrame], site: Keys = (),
                     normalise_ids: bool = False) -> DataFrame:
    """``biometric_rows`` with identifiers and facility code."""
    rows = biometric_rows(tables, site, normalise_ids, ["uuid", "PatientUniqueID"])
    return attach_parameters(rows, tables["global_property"], {"DatimCode": DATIM_PROPERTY}, key_list(site))
