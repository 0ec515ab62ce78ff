"""Row filters.  All are plain predicates, so they reach the file scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions.dates import day
from carelens.operators.keys import Keys, key_list, match_many

# Fixed value: how a valid fingerprint template starts.
TEMPLATE_PREFIX = "Rk1S"


def live(df: DataFrame, voided: str = "voided") -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.filter(F.col(voided) == 0)


def as_of(df: DataFrame, ts: str, end_date: dt.date | str | Column) -> DataFrame:
    """Rows up to midnight at the start of ``end_date``."""
    return df.filter(F.col(ts) <= day(end_date))


def for_concepts(df: DataFrame, ids: Iterable, concept: str = "concept_id") -> DataFrame:
    return df.filter(F.col(concept).isin(*ids))


def on_form(obs: DataFrame, encounters: DataFrame, form_id: int,
            encounter: Keys = "encounter_id", form: str = "form_id") -> DataFrame:
    """Observations whose encounter was entered on one form.

    Both sides shuffle on the encounter unless the encounters of that form are
    small enough for Spark to send them everywhere.
    """
    keys = key_list(encounter)
    wanted = encounters.filter(F.col(form) == form_id).select(*keys)
    return obs.join(wanted, keys, "left_semi")


def has_identifier(df: DataFrame, identifier: str = "identifier",
                   voided: str = "voided") -> DataFrame:
    return df.filter(F.col(identifier).isNotNull() & (F.col(voided) == 0))


def wrong_template(df: DataFrame, template: str = "template",
                   new_template: str = "new_template",
                   prefix: str = TEMPLATE_PREFIX) -> Column:
    """Whether either template has the wrong start; a missing one says nothing."""
    new = F.col(new_template)
    if dict(df.dtypes)[new_template] == "binary":
        new = F.decode(new, "UTF-8")
    return ~F.col(template).startswith(prefix) | ~new.startswith(prefix)


def invalid_template(df: DataFrame, template: str = "template",
                     new_template: str = "new_template",
                     prefix: str = TEMPLATE_PREFIX) -> DataFrame:
    """Captures of which either template has the wrong start (NULL OR true is true)."""
    return df.filter(wrong_template(df, template, new_template, prefix))


def in_window(ts: str, start: dt.date | str | Column, end: dt.date | str | Column) -> Column:
    return F.col(ts).between(day(start), day(end))


def tracked_in_window(encounters: DataFrame, persons: DataFrame,
                      start: dt.date | str, end: dt.date | str, form_id: int = 13,
                      encounter_person: Keys = "patient_id",
                      person: Keys = "person_id", form: str = "form_id",
                      ts: str = "encounter_datetime", voided: str = "voided",
                      dead: str = "dead", death_date: str = "death_date",
                      person_voided: str = "voided") -> DataFrame:
    """Encounters on the tracking form in the window, or of persons who died in it.

    The bounds are inclusive at midnight.
    """
    # Only the few persons who died in the window are joined, all others are known not
    # to have; with so few Spark need not shuffle the encounters.
    died = persons.filter(
        (F.col(dead) == 1) & in_window(death_date, start, end) & (F.col(person_voided) == 0)
    ).select(*key_list(person)).distinct().withColumn("__died", F.lit(True))
    tracked = (F.col(form) == form_id) & (F.col(voided) == 0) & in_window(ts, start, end)
    joined = match_many(encounters, died, encounter_person, person)
    return joined.filter(tracked | F.col("__died")).drop("__died")
