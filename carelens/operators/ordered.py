"""Previous values, top rows and parent/child lookups.

"The one before the latest" needs the two newest distinct instants.  Equal instants
are merged first (a map-side combined aggregate), then a row-number filter lets
Spark cut each task's rows to the first few per person before the shuffle, so a
person with very many rows never reaches one task whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.functions.dates import day, end_of_last_quarter
from carelens.operators.filters import as_of, live, on_form
from carelens.operators.keys import Keys, key_list, match, match_many


def newest_instants(rows: DataFrame, n: int, keys: Keys, ts: str) -> DataFrame:
    """The ``n`` newest distinct instants per key with their number of rows."""
    merged = rows.filter(F.col(ts).isNotNull()).groupBy(*key_list(keys), ts).agg(
        F.count("*").alias("n_rows"))
    newest_first = Window.partitionBy(*key_list(keys)).orderBy(F.col(ts).desc())
    return merged.withColumn("rank", F.row_number().over(newest_first)).filter(F.col("rank") <= n)


def _ranked(n: int, ts: str) -> Column:
    return F.max(F.when(F.col("rank") == n, F.col(ts)))


def previous_distinct_date(obs: DataFrame, end_date: dt.date | str,
                           person: Keys = "person_id", ts: str = "obs_datetime",
                           voided: str = "voided") -> DataFrame:
    """The latest instant as of a date and the newest one strictly before it."""
    newest = newest_instants(as_of(live(obs, voided), ts, end_date), 2, person, ts)
    return newest.groupBy(*key_list(person)).agg(
        _ranked(1, ts).alias("latest_date"), _ranked(2, ts).alias("previous_date"))


def nth_latest(obs: DataFrame, end_date: dt.date | str, n: int = 2,
               person: Keys = "person_id", ts: str = "obs_datetime",
               voided: str = "voided") -> DataFrame:
    """The ``n``-th row by descending instant; rows at one instant count each."""
    newest = newest_instants(as_of(live(obs, voided), ts, end_date), n, person, ts)
    so_far = Window.partitionBy(*key_list(person)).orderBy("rank")
    counted = newest.withColumn("__rows", F.sum("n_rows").over(so_far))
    return counted.groupBy(*key_list(person)).agg(
        F.max(F.when(F.col("__rows") >= n, F.col(ts))).alias("nth_date"))


def previous_vs_global(obs: DataFrame, end_date: dt.date | str,
                       person: Keys = "person_id", ts: str = "obs_datetime",
                       voided: str = "voided") -> DataFrame:
    """Newest instant up to the date that is older than the newest of all time."""
    keys = key_list(person)
    rows = live(obs, voided).filter(F.col(ts).isNotNull()).withColumn(
        "__in_time", F.col(ts) <= day(end_date))
    newest = newest_instants(rows, 2, [*keys, "__in_time"], ts)
    inside = F.col("__in_time")
    found = newest.groupBy(*keys).agg(
        F.max(F.when(~inside, F.col(ts))).alias("__after"),
        F.max(F.when(inside & (F.col("rank") == 1), F.col(ts))).alias("__first"),
        F.max(F.when(inside & (F.col("rank") == 2), F.col(ts))).alias("__second"),
    )
    return found.select(
        *keys,
        F.when(F.col("__after").isNotNull(), F.col("__first"))
        .otherwise(F.col("__second")).alias("previous_date"),
    )


def last_date_by_period_end(obs: DataFrame, end_date: dt.date | str,
                            person: Keys = "person_id", ts: str = "obs_datetime",
                            voided: str = "voided") -> DataFrame:
    """Last instant up to the end of the quarter before ``end_date``."""
    rows = as_of(live(obs, voided), ts, end_of_last_quarter(end_date))
    return rows.groupBy(*key_list(person)).agg(F.max(ts).alias("last_date"))


def newest_value(rows: DataFrame, keys: Keys, ts: str, obs_id: str, value: Column,
                 out: str) -> DataFrame:
    """Value of the newest row; among equal instants the last inserted one."""
    top = F.max(F.struct(F.col(ts).alias("at"), F.col(obs_id).alias("id"), value.alias("v")))
    return rows.groupBy(*key_list(keys)).agg(top["v"].alias(out))


def current_value(obs: DataFrame, encounters: DataFrame, names: DataFrame,
                  concepts: Iterable, encounter_type: int, end_date: dt.date | str,
                  person: Keys = "person_id", encounter: Keys = "encounter_id",
                  concept: str = "concept_id", ts: str = "obs_datetime",
                  obs_id: str = "obs_id", coded: str = "value_coded",
                  voided: str = "voided", site: Keys = ()) -> DataFrame:
    """Name of the newest coded answer among several concepts on one encounter type.

    Only answers that have a preferred name take part.  ``names`` is one row per
    concept, as ``preferred_names`` gives it.
    """
    rows = as_of(live(obs, voided), ts, end_date).filter(F.col(concept).isin(*concepts))
    visits = live(encounters, voided).filter(F.col("encounter_type") == encounter_type)
    rows = rows.join(visits.select(*key_list(encounter)), key_list(encounter), "left_semi")
    # Each answer of a person shrinks to its newest row before it is decoded.
    per_code = rows.groupBy(*key_list(person), coded).agg(
        F.max(F.struct(F.col(ts).alias("at"), F.col(obs_id).alias("id"))).alias("__top"))
    named = match_many(per_code, names, [*key_list(site), coded],
                       [*key_list(site), "concept_id"], "inner")
    return named.groupBy(*key_list(person)).agg(F.max_by("name", "__top").alias("current_value"))


def last_sample_date(obs: DataFrame, concepts: Iterable, end_date: dt.date | str,
                     person: Keys = "person_id", concept: str = "concept_id",
                     ts: str = "obs_datetime", obs_id: str = "obs_id",
                     value: str = "value_datetime") -> DataFrame:
    """Day held by the newest row of a concept; soft-deleted rows take part."""
    rows = as_of(obs, ts, end_date).filter(F.col(concept).isin(*concepts))
    return newest_value(rows, person, ts, obs_id, F.col(value).cast("date"), "sample_date")


def child_values(obs: DataFrame, child_concept: int | str | None = None,
                 group: Keys = ("obs_group_id", "person_id"),
                 concept: str = "concept_id", obs_id: str = "obs_id",
                 value: str = "value_numeric", voided: str = "voided") -> DataFrame:
    """One rounded number per group: that of its first live child."""
    keys = key_list(group)
    rows = live(obs, voided).filter(F.col(keys[0]).isNotNull())
    if child_concept is not None:
        rows = rows.filter(F.col(concept) == child_concept)
    return rows.groupBy(*keys).agg(
        F.round(F.min_by(value, obs_id)).cast("int").alias("child_value"))


def child_value(groups: DataFrame, children: DataFrame, group_id: Keys,
                child_group: Keys = ("obs_group_id", "person_id"),
                out: str = "child_value") -> DataFrame:
    """Attach to each group row the number of its child."""
    renamed = children.withColumnRenamed("child_value", out)
    return match(groups, renamed, group_id, child_group)


def attach_child_values(df: DataFrame, children: DataFrame, ids: Mapping[str, str],
                        person: Keys = "person_id",
                        child_group: Keys = ("obs_group_id", "person_id")) -> DataFrame:
    """Attach the child numbers of several groups per person with one join.

    ``ids`` maps an output to the column with the group id; ``df`` has one row per
    person.  The ids of a person become rows, of which the first carries the other
    columns, and come together again after the join.
    """
    keys = key_list(person)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(f"`{c}`") for c in rest])
    spread = df.select(*keys, packed.alias("__row"),
                       F.posexplode(F.array(*[F.col(i) for i in ids.values()])).alias("__which", "__id"))
    spread = spread.withColumn("__row", F.when(F.col("__which") == 0, F.col("__row")))
    valued = match(spread, children, ["__id", *keys], child_group)
    whole = valued.groupBy(*keys).agg(
        F.max(F.when(F.col("__which") == 0, F.col("__row"))).alias("__row"),
        *[F.max(F.when(F.col("__which") == i, F.col("child_value"))).alias(out)
          for i, out in enumerate(ids)])
    return whole.select(*keys, *[F.col("__row")[c].alias(c) for c in rest], *ids)


def refill_before(groups: DataFrame, bounds: DataFrame, bound: str,
                  person: Keys = "person_id", ts: str = "obs_datetime",
                  obs_id: str = "obs_id") -> DataFrame:
    """Largest group id dated before a per-person instant (soft-deleted ones count).

    ``bounds`` holds one row per person.
    """
    keys = key_list(person)
    joined = match_many(groups.select(*keys, ts, obs_id), bounds.select(*keys, bound),
                        keys, keys, "inner")
    return joined.filter(F.col(ts) < F.col(bound)).groupBy(*keys).agg(
        F.max(obs_id).alias("group_id"))


def refill_at(groups: DataFrame, bounds: DataFrame, bound: str,
              person: Keys = "person_id", ts: str = "obs_datetime",
              obs_id: str = "obs_id") -> DataFrame:
    """Largest group id dated exactly at a per-person instant."""
    keys = key_list(person)
    at = bounds.filter(F.col(bound).isNotNull()).select(*keys, F.col(bound).alias(ts))
    per_instant = groups.groupBy(*keys, ts).agg(F.max(obs_id).alias("group_id"))
    return per_instant.join(at, [*keys, ts]).drop(ts)


def refill_before_latest(pickups: DataFrame, groups: DataFrame, children: DataFrame,
                         end_date: dt.date | str, person: Keys = "person_id",
                         ts: str = "obs_datetime", obs_id: str = "obs_id",
                         voided: str = "voided", capped: bool = True) -> DataFrame:
    """Refill days of the last inserted group dated before the latest pickup.

    With ``capped=False`` the latest pickup is sought over all time.
    """
    keys = key_list(person)
    rows = live(pickups, voided)
    if capped:
        rows = as_of(rows, ts, end_date)
    latest = rows.groupBy(*keys).agg(F.max(ts).alias("__latest"))
    before = refill_before(groups, latest, "__latest", person, ts, obs_id)
    return child_value(before, children, ["group_id", *keys], out="refill_days")


def refill_at_previous(pickups: DataFrame, groups: DataFrame, children: DataFrame,
                       end_date: dt.date | str, person: Keys = "person_id",
                       ts: str = "obs_datetime", obs_id: str = "obs_id",
                       voided: str = "voided") -> DataFrame:
    """Refill days of the group dated exactly at the previous pickup."""
    previous = previous_vs_global(pickups, end_date, person, ts, voided)
    at = refill_at(groups, previous, "previous_date", person, ts, obs_id)
    return child_value(at, children, ["group_id", *key_list(person)], out="refill_days")


def max_obs_id(obs: DataFrame, encounters: DataFrame, concept_id: int | str, form_id: int,
               date: dt.date | str | Column, person: Keys = "person_id",
               encounter: Keys = "encounter_id", concept: str = "concept_id",
               ts: str = "obs_datetime", obs_id: str = "obs_id",
               voided: str = "voided") -> DataFrame:
    """Newest id of a concept on a form as of a date."""
    rows = as_of(live(obs, voided), ts, date).filter(F.col(concept) == concept_id)
    return on_form(rows, encounters, form_id, encounter).groupBy(*key_list(person)).agg(
        F.max(obs_id).alias("group_id"))


def refill_by_period_end(obs: DataFrame, encounters: DataFrame, children: DataFrame,
                         concept_id: int | str, form_id: int, end_date: dt.date | str,
                         person: Keys = "person_id", encounter: Keys = "encounter_id",
                         concept: str = "concept_id", ts: str = "obs_datetime",
                         obs_id: str = "obs_id", voided: str = "voided") -> DataFrame:
    """Refill days of the newest group up to the end of the previous quarter."""
    newest = max_obs_id(obs, encounters, concept_id, form_id, end_of_last_quarter(end_date),
                        person, encounter, concept, ts, obs_id, voided)
    return child_value(newest, children, ["group_id", *key_list(person)], out="refill_days")
