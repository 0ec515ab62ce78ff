"""Termination and tracking record per patient."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions import deceased_flag, end_of_last_quarter
from carelens.operators.filters import live, tracked_in_window
from carelens.operators.keys import Keys, key_list, match
from carelens.operators.latest import preferred_names
from carelens.operators.lookups import attach_entered_by, decode_coded
from carelens.operators.summaries import rollup_by_identifier
from carelens.plans.concepts import (
    CAUSE_OF_DEATH,
    DISCONTINUED_REASON,
    HOSPITAL_NUMBER,
    OTHER_CAUSE_OF_DEATH,
    OUTCOME_DATE,
    OUTCOME_REASON,
    REFERRED_FOR,
    RETURNED_DATE,
    TRACKING_FORM,
    TRACKING_REASON,
    UNIQUE_ID,
)

ANSWERS = (
    TRACKING_REASON, OUTCOME_REASON, OUTCOME_DATE, CAUSE_OF_DEATH, OTHER_CAUSE_OF_DEATH,
    DISCONTINUED_REASON, RETURNED_DATE, REFERRED_FOR,
)

#: What orders the visits of a patient, and what all comes from the first of them.
FIRST_VISIT = ("__first_at", "__first_id")
OF_FIRST_VISIT = ("TrackerTerminationDate", "EnteredBy", "DateCreated")


def tracking_answers(end_date: dt.date | str, name: str = "name") -> dict[str, Column]:
    """The recorded answers, each as a conditional maximum."""
    in_quarter = F.col("obs_datetime") <= end_of_last_quarter(end_date)

    def best(concept: int, value: str, extra: Column | None = None) -> Column:
        asked = F.col("concept_id") == concept
        return F.max(F.when(asked if extra is None else asked & extra, F.col(value)))

    return {
        "ReasonForTracking": best(TRACKING_REASON, name),
        "PatientOutcomePreviousQuarter": best(OUTCOME_REASON, name, in_quarter),
        "PatientOutcomeDatePreviousQuarter": best(OUTCOME_DATE, "obs_datetime", in_quarter),
        "DateOfTermination": best(OUTCOME_DATE, "value_datetime"),
        "ReasonForTermination": best(OUTCOME_REASON, name),
        "CauseOfDeath": best(CAUSE_OF_DEATH, name),
        "OtherCauseOfDeath": best(OTHER_CAUSE_OF_DEATH, "value_text"),
        "DiscontinuedCareReason": best(DISCONTINUED_REASON, "value_text"),
        "DateReturnedToCare": best(RETURNED_DATE, "value_datetime"),
        "ReferredFor": best(REFERRED_FOR, name),
    }


def tracking_rows(tables: Mapping[str, DataFrame], start_date: dt.date | str,
                  end_date: dt.date | str, site: Keys = ()) -> DataFrame:
    """``pivot_tracking`` with the columns that tell which visit was the first.

    The visits wanted meet their answers before any answer is decoded.
    """
    s = key_list(site)
    patient, visit = [*s, "patient_id"], [*s, "encounter_id"]
    live_ids = live(tables["patient"]).select(*patient)
    # Only live patients have a person to be dead in the window.
    persons = match(tables["person"], live_ids, [*s, "person_id"], patient, "left_semi")
    visits = tracked_in_window(
        live(tables["encounter"]), persons, start_date, end_date, TRACKING_FORM,
        encounter_person=patient, person=[*s, "person_id"])
    seen = attach_entered_by(visits, tables["users"], tables["person_name"], site=s).select(
        *visit, "patient_id", F.struct(
            F.col("encounter_datetime").alias(FIRST_VISIT[0]), F.col("encounter_id").alias(FIRST_VISIT[1]),
            F.col("encounter_datetime").alias("TrackerTerminationDate"), "EnteredBy",
            F.col("date_created").alias("DateCreated")).alias("__visit"))
    answers = tables["obs"].filter(F.col("concept_id").isin(*ANSWERS)).select(
        *visit, "concept_id", "value_coded", "value_datetime", "value_text", "obs_datetime")
    named = decode_coded(seen.join(answers, visit, "left"),
                         preferred_names(tables["concept_name"], site=s), site=s)
    outs = tracking_answers(end_date)

    kind = F.col("identifier_type")
    numbers = tables["patient_identifier"].groupBy(*patient).agg(
        F.min(F.when(kind == HOSPITAL_NUMBER, F.struct("uuid", "identifier"))).alias("number"),
        F.min(F.when(kind == UNIQUE_ID, F.col("identifier"))).alias("UniqueID"))
    numbers = numbers.select(*patient, "number.uuid", F.col("number.identifier").alias("HospID"), "UniqueID")
    deceased, death_date = deceased_flag("dead", "death_date")
    deaths = persons.groupBy(*s, "person_id").agg(
        F.max("dead").alias("dead"), F.max("death_date").alias("death_date"))
    deaths = deaths.select(*s, "person_id", deceased.alias("MarkAsDeseased"),
                           death_date.alias("MarkAsDeseasedDeathDate"))
    people = match(live_ids.withColumn("__live", F.lit(True)), deaths, patient, [*s, "person_id"])
    # One row per patient first; soft-deleted patients merge in a second step.
    per_patient = named.groupBy(*patient).agg(
        *[a.alias(out) for out, a in outs.items()], F.min("__visit").alias("__visit"))
    per_patient = per_patient.select(*patient, *outs, "__visit.*")
    per_patient = per_patient.join(numbers, patient, "left").join(people, patient, "left")
    per_patient = per_patient.withColumns({
        "patient_id": F.when(F.col("__live"), F.col("patient_id")),
        "MarkAsDeseased": F.coalesce("MarkAsDeseased", F.lit(""))})
    return rollup_by_identifier(per_patient, patient, list(outs), [
        "uuid", "UniqueID", "HospID", *FIRST_VISIT, *OF_FIRST_VISIT, "MarkAsDeseased",
        "MarkAsDeseasedDeathDate"], by=FIRST_VISIT)


def pivot_tracking(tables: Mapping[str, DataFrame], start_date: dt.date | str,
                   end_date: dt.date | str, site: Keys = ()) -> DataFrame:
    """One row per patient tracked, or dead, in the window.

    The answers are each the largest.  Visit date, creator and creation date are those
    of the first visit by (``encounter_datetime``, ``encounter_id``).  Soft-deleted patients with a
    tracking visit share one row without a patient id, whose identifiers are of the
    patient with the first visit.
    """
    return tracking_rows(tables, start_date, end_date, site).drop(*FIRST_VISIT)
