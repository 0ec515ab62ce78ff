"""Latest, earliest and pivoted values of observations.

The value of a concept at its last instant is the largest value among the rows
that share this instant.  This is what ``max(struct(instant, value))`` gives, an
aggregate that Spark combines on the map side: a person (or a concept) that owns a
large share of all rows shrinks to one row per task before anything is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions.dates import day
from carelens.operators.filters import as_of, for_concepts, live
from carelens.operators.keys import Keys, earlier_is_larger, key_list


def first_last_dates(obs: DataFrame, concepts: Iterable, end_date: dt.date | str,
                     person: Keys = "person_id", concept: str = "concept_id",
                     ts: str = "obs_datetime", voided: str = "voided") -> DataFrame:
    """First and last instant per person and concept as of a date."""
    rows = for_concepts(as_of(live(obs, voided), ts, end_date), concepts, concept)
    return rows.groupBy(*key_list(person), concept).agg(
        F.min(ts).alias("first_date"), F.max(ts).alias("last_date"))


def _rows_at(obs, end_date, pick, person, concept, ts, voided):
    rows = as_of(live(obs, voided), ts, end_date)
    keys = [*key_list(person), concept]
    instants = rows.groupBy(*keys).agg(pick(ts).alias(ts))
    # The instant is part of the join key, so the rows of one person spread out,
    # and the side with one row per key can be copied when a partition is split.
    return rows.join(instants, [*keys, ts], "left_semi")


def latest_rows(obs: DataFrame, end_date: dt.date | str, person: Keys = "person_id",
                concept: str = "concept_id", ts: str = "obs_datetime",
                voided: str = "voided") -> DataFrame:
    """All rows at the last instant per person and concept; ties survive."""
    return _rows_at(obs, end_date, F.max, person, concept, ts, voided)


def earliest_rows(obs: DataFrame, end_date: dt.date | str, person: Keys = "person_id",
                  concept: str = "concept_id", ts: str = "obs_datetime",
                  voided: str = "voided") -> DataFrame:
    """All rows at the first instant per person and concept; ties survive."""
    return _rows_at(obs, end_date, F.min, person, concept, ts, voided)


def latest_unbounded(obs: DataFrame, concepts: Iterable, end_date: dt.date | str,
                     person: Keys = "person_id", concept: str = "concept_id",
                     ts: str = "obs_datetime", voided: str = "voided") -> DataFrame:
    """Last instant of each concept as of the date, NULL when a newer one exists.

    The newest instant is sought over all time and only counts if it is also the
    last one up to the date.
    """
    rows = for_concepts(live(obs, voided), concepts, concept)
    seen = rows.groupBy(*key_list(person), concept).agg(
        F.max(F.when(F.col(ts) <= day(end_date), F.col(ts))).alias("last_date"),
        F.max(ts).alias("__any"),
    )
    return seen.filter(F.col("last_date").isNotNull()).withColumn(
        "latest_date", F.when(F.col("__any") == F.col("last_date"), F.col("__any"))
    ).drop("__any")


def at_last(ts: str, value: Column, where: Column | None = None) -> Column:
    """Aggregate: the largest value among the rows (``where`` it holds) at the last instant."""
    instant = F.col(ts)
    asked = instant.isNotNull() if where is None else where & instant.isNotNull()
    return F.max(F.when(asked, F.struct(instant.alias("at"), value.alias("v"))))["v"]


def at_first(ts: str, value: Column, where: Column | None = None) -> Column:
    """Aggregate: the largest value among the rows (``where`` it holds) at the first instant."""
    instant = F.col(ts)
    asked = instant.isNotNull() if where is None else where & instant.isNotNull()
    packed = F.struct(earlier_is_larger(instant).alias("at"), value.alias("v"))
    return F.max(F.when(asked, packed))["v"]


def preferred_names(concept_name: DataFrame, locale: str = "en", site: Keys = ()) -> DataFrame:
    """One preferred name per concept (the largest, should there be several)."""
    wanted = concept_name.filter((F.col("locale") == locale) & (F.col("locale_preferred") == 1))
    return wanted.groupBy(*key_list(site), "concept_id").agg(F.max("name").alias("name"))


def pivot_latest(obs: DataFrame, spec: Mapping[str, tuple], end_date: dt.date | str,
                 person: Keys = "person_id", concept: str = "concept_id",
                 ts: str = "obs_datetime", voided: str = "voided") -> DataFrame:
    """One row per person: for each output the latest value of a concept's slot.

    ``spec`` maps an output name to ``(concept, slot column)``, or to a set of
    concepts and a slot, which takes the largest of their latest values.  Two
    aggregations run after one shuffle by person: the first, per concept, finds the
    values at the last instant, the second turns concepts into columns.
    """
    keys = key_list(person)
    sets = {out: (c if isinstance(c, set | frozenset | list | tuple) else [c], slot)
            for out, (c, slot) in spec.items()}
    slots = sorted({slot for _, slot in sets.values()})
    wanted = sorted({c for cs, _ in sets.values() for c in cs})
    rows = for_concepts(as_of(live(obs, voided), ts, end_date), wanted, concept)
    latest = rows.groupBy(*keys, concept).agg(
        *[at_last(ts, F.col(s)).alias(f"__at_{s}") for s in slots])
    return latest.groupBy(*keys).agg(*[
        F.max(F.when(F.col(concept).isin(*cs), F.col(f"__at_{slot}"))).alias(out)
        for out, (cs, slot) in sets.items()])


def max_in_concepts(obs: DataFrame, concepts: Iterable, value: str, end_date: dt.date | str,
                    person: Keys = "person_id", concept: str = "concept_id",
                    ts: str = "obs_datetime", voided: str = "voided",
                    earliest: bool = False, out: str = "value") -> DataFrame:
    """Largest of the values several concepts hold at their own last (first) instants."""
    keys = key_list(person)
    rows = for_concepts(as_of(live(obs, voided), ts, end_date), concepts, concept)
    pick = at_first if earliest else at_last
    per_concept = rows.groupBy(*keys, concept).agg(pick(ts, F.col(value)).alias("__v"))
    return per_concept.groupBy(*keys).agg(F.max("__v").alias(out))


def guarded_value(guard: Column, value: Column) -> Column:
    """``value`` only where the guarding aggregate found something."""
    return F.when(guard.isNotNull(), value)


def first_date_in_codes(obs: DataFrame, codes: Iterable, person: Keys = "person_id",
                        coded: str = "value_coded", ts: str = "obs_datetime",
                        voided: str = "voided") -> DataFrame:
    """First day on which any of a set of coded answers was recorded."""
    rows = live(obs, voided).filter(F.col(coded).isin(*codes))
    return rows.groupBy(*key_list(person)).agg(F.min(F.col(ts).cast("date")).alias("first_date"))
