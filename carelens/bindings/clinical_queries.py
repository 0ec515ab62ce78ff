"""The plans over a clinical record made of all test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from carelens.bindings.line_list_sql import BIOMETRICS, COLLATED, ENTRY, LINE_LIST, NORMALISED, NUMBERS, TRACKING
from carelens.bindings.sql_tables import CLINICAL
from carelens.bindings.tables import NOW, PICKUP_END, START, clinical_tables
from carelens.operators.collation import DATABASE_COLLATION
from carelens.operators.lookups import attach_demographics as demographics
from carelens.plans import biometrics as biometric_plan
from carelens.plans import line_list as plan
from carelens.plans import tracking
from carelens.plans.concepts import HOSPITAL_NUMBER
from carelens.plans.profile import person_profile
from carelens.session import shared_folder
from carelens.sources.clustered import load_clustered, write_clustered


def line_list(spark, sf):
    return plan.line_list(clinical_tables(spark, sf), START, PICKUP_END, NOW)


def line_list_normalised(spark, sf):
    t = clinical_tables(spark, sf)
    owner = F.col("patient_id")
    spelled = F.concat(F.when(owner % 2 == 0, "hn").otherwise("HN"), "identifier",
                       F.when(owner % 3 == 0, "  ").otherwise(""))
    identifiers = t["patient_identifier"].withColumn("identifier", F.when(
        F.col("identifier_type") == HOSPITAL_NUMBER, spelled).otherwise(F.col("identifier")))
    return plan.line_list({**t, "patient_identifier": identifiers}, START, PICKUP_END, NOW,
                          normalise_ids=True)


def line_list_collated(spark, sf):
    """Hospital numbers that differ in case, accents and trailing blanks are one."""
    t = clinical_tables(spark, sf)
    owner, number = F.col("patient_id"), F.col("identifier")
    spelled = F.concat(F.when(owner % 2 == 0, "hn").otherwise("HN"),
                       F.when(owner % 5 < 2, "\u00e9").when(owner % 5 == 2, "E").otherwise("e"), number,
                       F.when(owner % 3 == 0, "  ").otherwise(""))
    identifiers = t["patient_identifier"].withColumn("identifier", F.when(
        F.col("identifier_type") == HOSPITAL_NUMBER, spelled).otherwise(number))
    return plan.line_list({**t, "patient_identifier": identifiers}, START, PICKUP_END, NOW,
                          collation=DATABASE_COLLATION)


def biometric_status(spark, sf):
    return biometric_plan.biometric_status(clinical_tables(spark, sf))


def pivot_tracking(spark, sf):
    return tracking.pivot_tracking(clinical_tables(spark, sf), START, PICKUP_END)


def care_entry_point(spark, sf):
    return plan.entry_points(clinical_tables(spark, sf))


def attach_demographics(spark, sf):
    t = clinical_tables(spark, sf)
    people = t["patient"].select(F.col("patient_id").alias("person_id"))
    return demographics(people, t["person"], t["person_name"], t["person_attribute"],
                        t["person_attribute_type"], t["person_address"])


def clustered_profile(spark, sf):
    """The record is written as a clustered store first; the profile reads the store."""
    folder = f"{shared_folder(spark)}/carelens-store-{uuid.uuid4().hex}"
    write_clustered(clinical_tables(spark, sf), folder, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return person_profile(load_clustered(spark, folder), PICKUP_END)


QUERIES = {f.__name__: f for f in (
    line_list, line_list_normalised, line_list_collated, biometric_status, pivot_tracking, care_entry_point, attach_demographics,
    clustered_profile)}


def _latest(concept: int, value: str) -> str:
    """The largest value among a person's rows at the last instant of a concept."""
    return f"""(SELECT max(o.{value}) FROM seen o WHERE o.person_id = p.patient_id AND o.concept_id = {concept}
   AND o.obs_datetime = (SELECT max(i.obs_datetime) FROM seen i
     WHERE i.person_id = p.patient_id AND i.concept_id = {concept}))"""


def _identifier(kind: int) -> str:
    return f"""(SELECT min(i.identifier) FROM patient_identifier i
   WHERE i.patient_id = p.patient_id AND i.identifier_type = {kind} AND i.voided = 0)"""


ORACLE = {
    "line_list": f"{LINE_LIST} SELECT * FROM line_list",
    "line_list_normalised": f"{NORMALISED} SELECT * FROM line_list",
    "line_list_collated": f"{COLLATED} SELECT * FROM line_list",
    "biometric_status": f"""
WITH {CLINICAL}, {NUMBERS}, {BIOMETRICS}
SELECT hospital_no AS "PatientHospitalNo", uuid, unique_id AS "PatientUniqueID",
  enrolled AS "EnrollmentDate", recaptured AS "RecaptureDate", recapture_count AS "RecaptureCount",
  captured AS "BiometricCaptured", capture_date AS "BiometricCaptureDate", valid AS "ValidCapture",
  'AFRICA' AS "DatimCode"
FROM biometrics""",
    "pivot_tracking": f"""
WITH {CLINICAL}, {NUMBERS}, {TRACKING}
SELECT patient_id, uuid, unique_id AS "UniqueID", hospital_id AS "HospID",
  terminated AS "TrackerTerminationDate", entered_by AS "EnteredBy", created AS "DateCreated",
  deceased AS "MarkAsDeseased", died AS "MarkAsDeseasedDeathDate", tracking_reason AS "ReasonForTracking",
  quarter_outcome AS "PatientOutcomePreviousQuarter",
  quarter_outcome_date AS "PatientOutcomeDatePreviousQuarter", outcome_date AS "DateOfTermination",
  outcome AS "ReasonForTermination", cause AS "CauseOfDeath", other_cause AS "OtherCauseOfDeath",
  discontinued AS "DiscontinuedCareReason", returned AS "DateReturnedToCare", referred AS "ReferredFor"
FROM tracking""",
    "care_entry_point": f"""
WITH {CLINICAL}, {NUMBERS}, {ENTRY}
SELECT hospital_no AS "PatientHospitalNo", uuid, unique_id AS "PatientUniqueID",
  entry_point AS "CareEntryPoint" FROM entry""",
    "attach_demographics": f"""
WITH {CLINICAL}
SELECT p.patient_id AS person_id, pe.gender AS "Sex", pe.birthdate AS "DOB",
  pn.given_name || ' ' || pn.family_name AS "Patient_Name", pa.value AS "Phone_No", ad.address1 AS "Patient_Address"
FROM patient p LEFT JOIN person pe ON pe.person_id = p.patient_id
LEFT JOIN person_name pn ON pn.person_id = p.patient_id AND pn.voided = 0
LEFT JOIN person_attribute pa ON pa.person_id = p.patient_id AND pa.person_attribute_type_id = 8
LEFT JOIN person_address ad ON ad.person_id = p.patient_id""",
    "clustered_profile": f"""
WITH {CLINICAL},
seen AS (SELECT * FROM obs WHERE voided = 0 AND obs_datetime <= DATE '{PICKUP_END}'
   AND concept_id IN (856, 5089, 5090, 159599, 165708)),
visits AS (SELECT patient_id, count(*) AS n, max(encounter_datetime) AS last_at FROM encounter
   WHERE voided = 0 AND encounter_datetime <= DATE '{PICKUP_END}' GROUP BY 1)
SELECT p.patient_id AS person_id, {_identifier(5)} AS "PatientHospitalNo", {_identifier(4)} AS "PatientUniqueID",
  {_identifier(6)} AS "ANCNoIdentifier", {_identifier(8)} AS "HTSNo", pe.gender AS "Sex", pe.birthdate AS "DOB",
  pn.given_name || ' ' || pn.family_name AS "Patient_Name", pa.value AS "Phone_No", ad.address1 AS "Patient_Address",
  {_latest(856, 'value_numeric')} AS viral_load, {_latest(5089, 'value_numeric')} AS weight,
  {_latest(5090, 'value_numeric')} AS height, {_latest(159599, 'value_datetime')} AS art_start,
  (SELECT min(obs_datetime) FROM seen o WHERE o.person_id = p.patient_id AND o.concept_id = 165708) AS first_pickup,
  (SELECT max(obs_datetime) FROM seen o WHERE o.person_id = p.patient_id AND o.concept_id = 165708) AS last_pickup,
  v.n AS n_visits, v.last_at AS last_visit
FROM patient p LEFT JOIN person pe ON pe.person_id = p.patient_id
LEFT JOIN person_name pn ON pn.person_id = p.patient_id AND pn.voided = 0
LEFT JOIN person_attribute pa ON pa.person_id = p.patient_id AND pa.person_attribute_type_id = 8
LEFT JOIN person_address ad ON ad.person_id = p.patient_id
LEFT JOIN visits v ON v.patient_id = p.patient_id
WHERE p.voided = 0""",
}
