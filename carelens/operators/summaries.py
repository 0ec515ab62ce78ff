"""Summaries per person and per identifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.operators.filters import live
from carelens.operators.keys import Keys, key_list
from carelens.operators.lookups import decode_coded

LOW_QUALITY = 80
ENTRY_POINT = 160540


def capture_quality(captures: DataFrame, person: Keys = "patient_Id",
                    quality: str = "imageQuality", date: str = "date_created",
                    finger: str = "fingerPosition", threshold: float = LOW_QUALITY) -> DataFrame:
    """Date, number and quality of the fingerprints per person.

    A print of unknown quality counts as not low.
    """
    low = F.count_if(F.col(quality) < threshold)
    return captures.groupBy(*key_list(person)).agg(
        F.max(date).alias("recapture_date"),
        F.count(finger).alias("n_fingers"),
        F.min(quality).alias("lowest_quality"),
        F.ceil(F.avg(quality)).alias("average_quality"),
        low.alias("n_low"),
        (F.count("*") - low).alias("n_not_low"),
    )


def first_capture(captures: DataFrame, person: Keys = "patient_Id",
                  date: str = "date_created") -> DataFrame:
    """Persons with a capture and the first capture date."""
    return captures.groupBy(*key_list(person)).agg(F.min(date).alias("first_capture"))


def rollup_by_identifier(df: DataFrame, identifier: Keys, largest: Sequence[str],
                         one_row: Sequence[str], by: Keys) -> DataFrame:
    """Person rows to one row per identifier; those without one form one row.

    ``largest`` merge by their largest value.  ``one_row`` all come from the row with
    the smallest ``by``, so that no result mixes the values of several persons.
    """
    keys = key_list(identifier)
    order = [F.col(f"`{c}`").alias(f"__by{i}") for i, c in enumerate(key_list(by))]
    row = F.struct(*order, *[F.col(f"`{c}`") for c in one_row])
    rolled = df.groupBy(*keys).agg(
        *[F.max(f"`{c}`").alias(c) for c in largest], F.min(row).alias("__row"))
    return rolled.select(*keys, *[F.col(f"`{c}`") for c in largest],
                         *[F.col("__row")[c].alias(c) for c in one_row])


def care_entry_point(obs: DataFrame, names: DataFrame, person: Keys = "person_id",
                     concept: str = "concept_id", concept_id: int | str = ENTRY_POINT,
                     coded: str = "value_coded", voided: str = "voided",
                     site: Keys = ()) -> DataFrame:
    """Largest decoded name of the entry point over all time.

    Every person with a live observation gets a row.  The answers are reduced to the
    distinct codes of a person before they are decoded.
    """
    code = F.when(F.col(concept) == concept_id, F.col(coded))
    codes = live(obs, voided).select(*key_list(person), code.alias("code")).distinct()
    named = decode_coded(codes, names, "code", "CareEntryPoint", site)
    return named.groupBy(*key_list(person)).agg(F.max("CareEntryPoint").alias("CareEntryPoint"))
