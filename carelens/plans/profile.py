"""What the record holds about every live patient, person parts alone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.operators.filters import as_of, for_concepts, live
from carelens.operators.keys import Keys, key_list
from carelens.operators.latest import pivot_latest
from carelens.operators.lookups import IDENTIFIER_TYPES, attach_demographics, pivot_identifiers
from carelens.plans import concepts as c

LATEST = {
    "viral_load": (c.VIRAL_LOAD, "value_numeric"),
    "weight": (c.WEIGHT, "value_numeric"),
    "height": (c.HEIGHT, "value_numeric"),
    "art_start": (c.ART_START, "value_datetime"),
}


def person_profile(tables: Mapping[str, DataFrame], end_date: dt.date | str,
                   site: Keys = ()) -> DataFrame:
    """Identifiers, demographics, latest values, pickups and visits, one row per live patient.

    Every part is an aggregate by person and every join is by person: over a clustered store
    nothing is shuffled, over plain tables each part is shuffled once.
    """
    s = key_list(site)
    person, patient = [*s, "person_id"], [*s, "patient_id"]
    who = F.col("patient_id").alias("person_id")
    rows = live(tables["patient"]).select(*s, who).distinct()
    numbers = pivot_identifiers(tables["patient_identifier"], IDENTIFIER_TYPES, patient)
    visits = as_of(live(tables["encounter"]), "encounter_datetime", end_date).groupBy(*s, who).agg(
        F.count("*").alias("n_visits"), F.max("encounter_datetime").alias("last_visit"))
    pickups = for_concepts(as_of(live(tables["obs"]), "obs_datetime", end_date), [c.PICKUP]).groupBy(
        *person).agg(F.min("obs_datetime").alias("first_pickup"), F.max("obs_datetime").alias("last_pickup"))
    values = pivot_latest(tables["obs"], LATEST, end_date, person)
    rows = rows.join(numbers.withColumnRenamed("patient_id", "person_id"), person, "left")
    rows = attach_demographics(
        rows, tables["person"], tables["person_name"], tables["person_attribute"],
        tables["person_attribute_type"], tables["person_address"], person, s)
    for part in (values, pickups, visits):
        rows = rows.join(part, person, "left")
    return rows
