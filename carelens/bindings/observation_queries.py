"""Operators over events as observations."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelens.bindings.sql_tables import OBS
from carelens.bindings.tables import (
    OBS_END,
    UNBOUNDED_END,
    encounters,
    nation_names,
    observations,
    table,
)
from carelens.functions import day, status_not_in
from carelens.operators import filters, latest, lookups, ordered
from carelens.operators.summaries import care_entry_point

CODED = ("signup", "view", "click")


def scan_obs(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").alias("obs_id"), F.col("user_id").alias("person_id"),
        F.col("event_type").alias("concept_id"), F.col("ts").alias("obs_datetime"),
        F.col("value").alias("value_numeric"))


def filter_live(spark, sf):
    return filters.live(observations(spark, sf))


def filter_as_of(spark, sf):
    return filters.as_of(observations(spark, sf), "obs_datetime", OBS_END)


def filter_concepts(spark, sf):
    return filters.for_concepts(observations(spark, sf), ("signup", "purchase"))


def filter_window_or_flag(spark, sf):
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("person_id"), (F.col("c_acctbal") > 8000).cast("int").alias("dead"),
        F.date_add(day("2024-01-01"), F.col("c_nationkey")).cast("timestamp_ntz").alias("death_date"),
        F.lit(0).alias("voided"))
    return filters.tracked_in_window(
        encounters(spark, sf), people, "2024-01-05", "2024-01-12")


def filter_not_null(spark, sf):
    ids = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("patient_id"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_name")).alias("identifier"),
        (F.col("c_acctbal") < 0).cast("int").alias("voided"))
    return filters.has_identifier(ids)


def not_in_null_true(spark, sf):
    orders = table(spark, sf, "orders")
    status = F.when(F.col("o_orderpriority") == "1-URGENT", None).when(
        F.col("o_orderpriority") == "2-HIGH", "").otherwise(F.col("o_orderstatus"))
    return orders.select("o_orderkey", status.alias("status")).withColumn(
        "kept", status_not_in("status", ["F", "O"]))


def semi_on_form(spark, sf):
    return filters.on_form(observations(spark, sf), encounters(spark, sf), 27)


def first_last_dates(spark, sf):
    return latest.first_last_dates(observations(spark, sf), CODED, OBS_END)


def latest_rows(spark, sf):
    return latest.latest_rows(observations(spark, sf), OBS_END)


def earliest_rows(spark, sf):
    return latest.earliest_rows(observations(spark, sf), OBS_END)


def attach_encounter(spark, sf):
    return lookups.attach_encounter(
        observations(spark, sf), encounters(spark, sf), ["form_id", "encounter_type"])


def decode_coded(spark, sf):
    return lookups.decode_coded(observations(spark, sf), nation_names(spark, sf))


def latest_unbounded(spark, sf):
    return latest.latest_unbounded(
        observations(spark, sf), ("signup", "view", "click", "error", "purchase"), UNBOUNDED_END)


def pivot_latest(spark, sf):
    named = lookups.decode_coded(observations(spark, sf), nation_names(spark, sf))
    return latest.pivot_latest(named, {
        "signup_name": ("signup", "name"),
        "view_value": ("view", "value_numeric"),
        "click_value": ("click", "value_numeric"),
        "error_at": ("error", "obs_datetime"),
        "any_name": (("view", "purchase"), "name"),
    }, OBS_END)


def guarded_value(spark, sf):
    wide = latest.pivot_latest(observations(spark, sf), {
        "error_value": ("error", "value_numeric"), "click_at": ("click", "obs_datetime")}, OBS_END)
    return wide.select("person_id", latest.guarded_value(
        F.col("error_value"), F.col("click_at")).alias("guarded_at"))


def max_in_concept_set(spark, sf):
    named = lookups.decode_coded(observations(spark, sf), nation_names(spark, sf))
    return latest.max_in_concepts(named, CODED, "name", OBS_END, earliest=True, out="first_name")


def first_date_in_codes(spark, sf):
    return latest.first_date_in_codes(observations(spark, sf), (3, 7, 11, 19))


def pivot_all_time(spark, sf):
    return care_entry_point(observations(spark, sf), nation_names(spark, sf), concept_id="signup")


def top1_current(spark, sf):
    return ordered.current_value(
        observations(spark, sf), encounters(spark, sf), nation_names(spark, sf),
        CODED, 13, OBS_END)


def top1_unfiltered(spark, sf):
    obs = observations(spark, sf).withColumn(
        "value_datetime", F.date_add(F.col("obs_datetime").cast("date"), F.col("value_coded")))
    return ordered.last_sample_date(obs, ("view",), OBS_END)


def max_id_on_form(spark, sf):
    return ordered.max_obs_id(
        observations(spark, sf), encounters(spark, sf), "purchase", 27, OBS_END)


QUERIES = {f.__name__: f for f in (
    scan_obs, filter_live, filter_as_of, filter_concepts, filter_window_or_flag,
    filter_not_null, not_in_null_true, semi_on_form, first_last_dates, latest_rows,
    earliest_rows, attach_encounter, decode_coded, latest_unbounded, pivot_latest,
    guarded_value, max_in_concept_set, first_date_in_codes, pivot_all_time, top1_current,
    top1_unfiltered, max_id_on_form)}

_END = f"DATE '{OBS_END}'"
_CODED = "('signup', 'view', 'click')"
_LIVE = f"voided = 0 AND obs_datetime <= {_END}"
_NAMED = f"""named AS (
  SELECT o.*, n_name AS name FROM obs o LEFT JOIN nation ON value_coded = n_nationkey
  WHERE voided = 0 AND obs_datetime <= {_END})"""


def _last(concepts: str, value: str) -> str:
    """Largest value at the last instant of each concept, over a set of concepts."""
    return f"""(SELECT max({value}) FROM named x WHERE x.person_id = p.person_id
      AND x.concept_id IN ({concepts}) AND x.obs_datetime = (
        SELECT max(y.obs_datetime) FROM named y
        WHERE y.person_id = p.person_id AND y.concept_id = x.concept_id))"""


ORACLE = {
    "scan_obs": """
SELECT event_id AS obs_id, user_id AS person_id, event_type AS concept_id, ts AS obs_datetime,
       value AS value_numeric FROM events""",
    "filter_live": f"WITH {OBS} SELECT * FROM obs WHERE voided = 0",
    "filter_as_of": f"WITH {OBS} SELECT * FROM obs WHERE obs_datetime <= {_END}",
    "filter_concepts": f"WITH {OBS} SELECT * FROM obs WHERE concept_id IN ('signup', 'purchase')",
    "filter_window_or_flag": f"""
WITH {OBS}, people AS (
  SELECT c_custkey, c_acctbal > 8000 AS dead, DATE '2024-01-01' + c_nationkey AS death_date FROM customer)
SELECT encounter.* FROM encounter LEFT JOIN people ON c_custkey = patient_id
WHERE (form_id = 13 AND voided = 0
       AND encounter_datetime BETWEEN DATE '2024-01-05' AND DATE '2024-01-12')
   OR (dead AND death_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12')""",
    "filter_not_null": """
SELECT c_custkey AS patient_id, c_name AS identifier, 0 AS voided
FROM customer WHERE c_mktsegment <> 'FURNITURE' AND c_acctbal >= 0""",
    "not_in_null_true": """
SELECT o_orderkey, status, status IS NULL OR status NOT IN ('F', 'O', '') AS kept
FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN ''
             ELSE o_orderstatus END AS status FROM orders)""",
    "semi_on_form": f"""
WITH {OBS} SELECT * FROM obs WHERE EXISTS (
  SELECT 1 FROM encounter e WHERE e.encounter_id = obs.encounter_id AND e.form_id = 27)""",
    "first_last_dates": f"""
WITH {OBS} SELECT person_id, concept_id, min(obs_datetime) AS first_date, max(obs_datetime) AS last_date
FROM obs WHERE {_LIVE} AND concept_id IN {_CODED} GROUP BY 1, 2""",
    "latest_rows": f"""
WITH {OBS} SELECT obs_id, person_id, concept_id, obs_datetime, value_numeric, value_coded,
       encounter_id, voided
FROM (SELECT *, rank() OVER (PARTITION BY person_id, concept_id ORDER BY obs_datetime DESC) AS r
      FROM obs WHERE {_LIVE}) WHERE r = 1""",
    "earliest_rows": f"""
WITH {OBS} SELECT obs_id, person_id, concept_id, obs_datetime, value_numeric, value_coded,
       encounter_id, voided
FROM (SELECT *, rank() OVER (PARTITION BY person_id, concept_id ORDER BY obs_datetime) AS r
      FROM obs WHERE {_LIVE}) WHERE r = 1""",
    "attach_encounter": f"""
WITH {OBS} SELECT obs.*, e.form_id, e.encounter_type FROM obs
LEFT JOIN encounter e ON e.encounter_id = obs.encounter_id AND e.voided = 0""",
    "decode_coded": f"""
WITH {OBS} SELECT obs.*, n_name AS name FROM obs LEFT JOIN nation ON value_coded = n_nationkey""",
    "latest_unbounded": f"""
WITH {OBS}, capped AS (
  SELECT person_id, concept_id, max(obs_datetime) AS last_date FROM obs
  WHERE voided = 0 AND obs_datetime <= DATE '{UNBOUNDED_END}' GROUP BY 1, 2),
 overall AS (SELECT person_id, concept_id, max(obs_datetime) AS top FROM obs WHERE voided = 0 GROUP BY 1, 2)
SELECT c.person_id, c.concept_id, c.last_date, o.top AS latest_date FROM capped c
LEFT JOIN overall o ON o.person_id = c.person_id AND o.concept_id = c.concept_id AND o.top = c.last_date""",
    "pivot_latest": f"""
WITH {OBS}, {_NAMED}
SELECT person_id, {_last("'signup'", 'name')} AS signup_name,
  {_last("'view'", 'value_numeric')} AS view_value, {_last("'click'", 'value_numeric')} AS click_value,
  {_last("'error'", 'obs_datetime')} AS error_at, {_last("'view', 'purchase'", 'name')} AS any_name
FROM (SELECT DISTINCT person_id FROM named) p""",
    "guarded_value": f"""
WITH {OBS}, {_NAMED}
SELECT person_id, CASE WHEN {_last("'error'", 'value_numeric')} IS NOT NULL
  THEN {_last("'click'", 'obs_datetime')} END AS guarded_at
FROM (SELECT DISTINCT person_id FROM named WHERE concept_id IN ('error', 'click')) p""",
    "max_in_concept_set": f"""
WITH {OBS}, {_NAMED}
SELECT person_id, max(name) AS first_name FROM (
  SELECT *, rank() OVER (PARTITION BY person_id, concept_id ORDER BY obs_datetime) AS r FROM named
  WHERE concept_id IN {_CODED}) WHERE r = 1 GROUP BY 1""",
    "first_date_in_codes": f"""
WITH {OBS} SELECT person_id, CAST(min(obs_datetime) AS DATE) AS first_date FROM obs
WHERE voided = 0 AND value_coded IN (3, 7, 11, 19) GROUP BY 1""",
    "pivot_all_time": f"""
WITH {OBS} SELECT person_id, max(CASE WHEN concept_id = 'signup' THEN n_name END) AS "CareEntryPoint"
FROM obs LEFT JOIN nation ON value_coded = n_nationkey WHERE voided = 0 GROUP BY 1""",
    "top1_current": f"""
WITH {OBS} SELECT person_id, name AS current_value FROM (
  SELECT o.person_id, n_name AS name,
         row_number() OVER (PARTITION BY o.person_id ORDER BY o.obs_datetime DESC, o.obs_id DESC) AS r
  FROM obs o JOIN encounter e ON e.encounter_id = o.encounter_id JOIN nation ON value_coded = n_nationkey
  WHERE o.voided = 0 AND e.voided = 0 AND e.encounter_type = 13 AND o.concept_id IN {_CODED}
    AND o.obs_datetime <= {_END}) WHERE r = 1""",
    "top1_unfiltered": f"""
WITH {OBS} SELECT person_id, sample_date FROM (
  SELECT person_id, CAST(obs_datetime AS DATE) + value_coded AS sample_date,
         row_number() OVER (PARTITION BY person_id ORDER BY obs_datetime DESC, obs_id DESC) AS r
  FROM obs WHERE concept_id = 'view' AND obs_datetime <= {_END}) WHERE r = 1""",
    "max_id_on_form": f"""
WITH {OBS} SELECT o.person_id, max(o.obs_id) AS group_id FROM obs o JOIN encounter e USING (encounter_id)
WHERE o.concept_id = 'purchase' AND e.form_id = 27 AND o.voided = 0 AND o.obs_datetime <= {_END}
GROUP BY 1""",
}
