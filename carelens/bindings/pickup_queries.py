"""Operators over orders as pickups and line items as their refills."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelens.bindings.sql_tables import PICKUPS
from carelens.bindings.tables import NOW, PICKUP_END, pickups, refills, table
from carelens.functions import (
    appointment_status as appointment,
)
from carelens.functions import (
    current_status as current,
)
from carelens.functions import (
    days_to_schedule,
    end_of_last_quarter,
)
from carelens.functions import (
    iit_chance as chance,
)
from carelens.functions import (
    iit_date as iit,
)
from carelens.functions import (
    months_of_refill as months,
)
from carelens.functions import (
    next_visit as next_day,
)
from carelens.functions import (
    retention_outcome as outcome,
)
from carelens.operators import filters, ordered
from carelens.operators.latest import at_last
from carelens.plans import rules


def _children(spark, sf):
    return refills(spark, sf).withColumnRenamed("group_id", "obs_group_id")


def _latest(spark, sf):
    """Latest pickup of each person with the refill of its newest order."""
    live = filters.as_of(filters.live(pickups(spark, sf)), "obs_datetime", PICKUP_END)
    newest = live.groupBy("person_id").agg(
        F.max("obs_datetime").alias("pickup"),
        at_last("obs_datetime", F.col("obs_id")).alias("group_id"))
    return ordered.child_value(newest, _children(spark, sf), "group_id", "obs_group_id", "refill_days")


def previous_distinct_date(spark, sf):
    return ordered.previous_distinct_date(pickups(spark, sf), PICKUP_END)


def previous_by_offset(spark, sf):
    return ordered.nth_latest(pickups(spark, sf), PICKUP_END, 2)


def previous_vs_global_max(spark, sf):
    return ordered.previous_vs_global(pickups(spark, sf), PICKUP_END)


def last_before_quarter(spark, sf):
    return ordered.last_date_by_period_end(pickups(spark, sf), PICKUP_END)


def child_value(spark, sf):
    return ordered.child_value(pickups(spark, sf).select("person_id", "obs_id"),
                               _children(spark, sf), "obs_id", "obs_group_id")


def _with_person(spark, sf):
    owner = pickups(spark, sf).select("person_id", F.col("obs_id").alias("obs_group_id"))
    return _children(spark, sf).join(owner, "obs_group_id")


def refill_before_latest(spark, sf):
    rows = pickups(spark, sf)
    return ordered.refill_before_latest(rows, rows, _with_person(spark, sf), PICKUP_END)


def refill_before_latest_uncapped(spark, sf):
    rows = pickups(spark, sf)
    return ordered.refill_before_latest(
        rows, rows, _with_person(spark, sf), PICKUP_END, capped=False)


def refill_at_previous(spark, sf):
    rows = pickups(spark, sf)
    return ordered.refill_at_previous(rows, rows, _with_person(spark, sf), PICKUP_END)


def refill_before_quarter(spark, sf):
    rows = pickups(spark, sf)
    visits = rows.select("encounter_id", "form_id")
    return ordered.refill_by_period_end(
        rows.drop("form_id"), visits, _with_person(spark, sf), 1, 27, PICKUP_END)


def retention_outcome(spark, sf):
    return _latest(spark, sf).withColumn("outcome", outcome("pickup", "refill_days", PICKUP_END))


def retention_outcome_quarter(spark, sf):
    return _latest(spark, sf).select(
        "person_id", outcome("pickup", "refill_days", end_of_last_quarter(PICKUP_END)).alias("outcome"))


def current_status(spark, sf):
    reasons = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("person_id"),
        F.when(F.col("c_acctbal") < 0, "Death").alias("reason"))
    return _latest(spark, sf).join(reasons, "person_id", "left").withColumn(
        "status", current("reason", "pickup", "refill_days", PICKUP_END))


def appointment_status(spark, sf):
    return _latest(spark, sf).select("person_id", appointment(
        next_day("pickup", "refill_days"), NOW).alias("appointment"))


def next_visit(spark, sf):
    return _latest(spark, sf).select(
        "person_id", next_day("pickup", "refill_days").alias("next_day"),
        days_to_schedule("pickup", "refill_days", NOW).alias("days_left"))


def iit_date(spark, sf):
    return _latest(spark, sf).select("person_id", iit("pickup", "refill_days").alias("iit_date"))


def iit_chance(spark, sf):
    rows = _latest(spark, sf).withColumns({
        "iit": iit("pickup", "refill_days"),
        "status": outcome("pickup", "refill_days", PICKUP_END)})
    return rows.select("person_id", "status", F.round(
        chance("iit", PICKUP_END, "status"), 4).alias("chance"))


def months_of_refill(spark, sf):
    return _latest(spark, sf).select("person_id", months("refill_days").alias("months"))


def _statuses(spark, sf):
    """Current, previous and last-quarter pickups with refills and a recorded outcome."""
    rows = pickups(spark, sf)
    current = _latest(spark, sf).select(
        "person_id", F.col("pickup").alias("LastPickupDate"),
        outcome("pickup", "refill_days", PICKUP_END).alias("CurrentARTStatus"))
    previous = ordered.previous_distinct_date(rows, PICKUP_END).select(
        "person_id", F.col("previous_date").alias("PreviousLastPickupDate"))
    before = refill_before_latest(spark, sf).select(
        "person_id", F.col("refill_days").alias("PreviousDaysOfARVRefil"))
    quarter = ordered.last_date_by_period_end(rows, PICKUP_END).withColumnRenamed(
        "last_date", "LastPickupDatePreviousQuarter")
    duration = refill_before_quarter(spark, sf).select(
        "person_id", F.col("refill_days").alias("DrugDurationPreviousQuarter"))
    recorded = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("person_id"),
        F.when(F.col("c_acctbal") < 0, "Death").when(F.col("c_acctbal") > 9500, "Transferred out")
        .alias("PatientOutcomePreviousQuarter"),
        F.when(F.col("c_acctbal") < -500, F.expr("timestamp_ntz'2001-01-15'"))
        .alias("PatientOutcomeDatePreviousQuarter"),
        F.when(F.col("c_acctbal") > 9000, F.expr("timestamp_ntz'2001-05-05'"))
        .alias("DateReturnedToCare"))
    for part in (previous, before, quarter, duration, recorded):
        current = current.join(part, "person_id", "left")
    return current


def quarter_status(spark, sf):
    return rules.quarter_status(_statuses(spark, sf), PICKUP_END).select(
        "person_id", "ARTStatusPreviousQuarter")


def returned_to_care(spark, sf):
    return rules.returned_to_care(_statuses(spark, sf)).select(
        "person_id", "PreviousIITDate", "DateReturnedToCare")


def previous_status(spark, sf):
    return rules.previous_status(_statuses(spark, sf)).select(
        "person_id", "PreviousARTStatus", "PreviousARTStatusDate")


def quarter_end(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", end_of_last_quarter(F.col("o_orderdate")).alias("quarter_end"))


QUERIES = {f.__name__: f for f in (
    previous_distinct_date, previous_by_offset, previous_vs_global_max, last_before_quarter,
    child_value, refill_before_latest, refill_before_latest_uncapped, refill_at_previous, refill_before_quarter,
    retention_outcome, retention_outcome_quarter, current_status, appointment_status, next_visit, iit_date, iit_chance,
    months_of_refill, quarter_status, returned_to_care, previous_status, quarter_end)}

_END = f"DATE '{PICKUP_END}'"
_QUARTER = "DATE '2001-03-31'"
_NOW = f"DATE '{NOW}'"
_LATEST = f"""latest AS (
  SELECT person_id, obs_datetime AS pickup, obs_id AS group_id, child_value AS refill_days FROM (
    SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY obs_datetime DESC, obs_id DESC) AS r
    FROM pickups WHERE voided = 0 AND obs_datetime <= {_END})
  LEFT JOIN refills ON group_id = obs_id WHERE r = 1)"""
_DUE = "CAST(pickup AS DATE) + refill_days"
_OUTCOME = f"CASE WHEN {_DUE} + 28 >= {_END} THEN 'Active' ELSE 'LTFU' END"
_IIT = f"({_DUE} + 29)"

_PREVIOUS = f"""previous AS (
  SELECT person_id, max(CASE WHEN r = 1 THEN obs_datetime END) AS latest_date,
         max(CASE WHEN r = 2 THEN obs_datetime END) AS previous_date FROM (
    SELECT person_id, obs_datetime,
           dense_rank() OVER (PARTITION BY person_id ORDER BY obs_datetime DESC) AS r
    FROM pickups WHERE voided = 0 AND obs_datetime <= {_END}) GROUP BY 1)"""
_GLOBAL = f"""previous_global AS (
  SELECT a.person_id, max(CASE WHEN a.obs_datetime < b.top AND a.obs_datetime <= {_END}
                               THEN a.obs_datetime END) AS previous_date
  FROM pickups a JOIN (SELECT person_id, max(obs_datetime) AS top FROM pickups WHERE voided = 0
                       GROUP BY 1) b USING (person_id) WHERE a.voided = 0 GROUP BY 1)"""
_BEFORE = f"""before AS (
  SELECT g.person_id, max(g.obs_id) AS group_id FROM pickups g JOIN (
    SELECT person_id, max(obs_datetime) AS top FROM pickups
    WHERE voided = 0 AND obs_datetime <= {_END} GROUP BY 1) t
  ON g.person_id = t.person_id AND g.obs_datetime < t.top GROUP BY 1)"""
_BY_QUARTER = f"""by_quarter AS (
  SELECT person_id, max(obs_id) AS group_id FROM pickups
  WHERE voided = 0 AND form_id = 27 AND obs_datetime <= {_QUARTER} GROUP BY 1)"""
_REFILL = "LEFT JOIN refills USING (group_id)"
_STATUSES = f"""statuses AS (
  SELECT l.person_id, l.pickup, CASE WHEN CAST(l.pickup AS DATE) + l.refill_days + 28 >= {_END}
           THEN 'Active' ELSE 'LTFU' END AS status,
         p.previous_date, CAST(p.previous_date AS DATE) + rb.child_value + 29 AS previous_iit,
         q.last_quarter, CAST(q.last_quarter AS DATE) + rq.child_value + 29 AS quarter_iit,
         CASE WHEN c_acctbal < 0 THEN 'Death' WHEN c_acctbal > 9500 THEN 'Transferred out' END AS outcome,
         CASE WHEN c_acctbal < -500 THEN TIMESTAMP '2001-01-15' END AS outcome_date,
         CASE WHEN c_acctbal > 9000 THEN TIMESTAMP '2001-05-05' END AS returned
  FROM latest l
  LEFT JOIN previous p ON p.person_id = l.person_id
  LEFT JOIN before b ON b.person_id = l.person_id
  LEFT JOIN refills rb ON rb.group_id = b.group_id
  LEFT JOIN (SELECT person_id, max(obs_datetime) AS last_quarter FROM pickups
             WHERE voided = 0 AND obs_datetime <= {_QUARTER} GROUP BY 1) q ON q.person_id = l.person_id
  LEFT JOIN by_quarter bq ON bq.person_id = l.person_id
  LEFT JOIN refills rq ON rq.group_id = bq.group_id
  LEFT JOIN customer ON c_custkey = l.person_id)"""
_ALL = f"WITH {PICKUPS}, {_LATEST}, {_PREVIOUS}, {_BEFORE}, {_BY_QUARTER}, {_STATUSES}"
_PREVIOUS_STATUS = """CASE WHEN outcome IS NOT NULL THEN outcome WHEN previous_date IS NULL THEN NULL
  WHEN previous_iit >= pickup THEN 'Active' ELSE 'LTFU' END"""

ORACLE = {
    "previous_distinct_date": f"WITH {PICKUPS}, {_PREVIOUS} SELECT * FROM previous",
    "previous_by_offset": f"""
WITH {PICKUPS} SELECT person_id, max(CASE WHEN r = 2 THEN obs_datetime END) AS nth_date FROM (
  SELECT person_id, obs_datetime, row_number() OVER (PARTITION BY person_id ORDER BY obs_datetime DESC) AS r
  FROM pickups WHERE voided = 0 AND obs_datetime <= {_END}) GROUP BY 1""",
    "previous_vs_global_max": f"WITH {PICKUPS}, {_GLOBAL} SELECT * FROM previous_global",
    "last_before_quarter": f"""
WITH {PICKUPS} SELECT person_id, max(obs_datetime) AS last_date FROM pickups
WHERE voided = 0 AND obs_datetime <= {_QUARTER} GROUP BY 1""",
    "child_value": f"""
WITH {PICKUPS} SELECT person_id, obs_id, child_value FROM pickups LEFT JOIN refills ON group_id = obs_id""",
    "refill_before_latest": f"""
WITH {PICKUPS}, {_BEFORE} SELECT person_id, group_id, child_value AS refill_days FROM before {_REFILL}""",
    "refill_before_latest_uncapped": f"""
WITH {PICKUPS}, uncapped AS (
  SELECT g.person_id, max(g.obs_id) AS group_id FROM pickups g JOIN (
    SELECT person_id, max(obs_datetime) AS top FROM pickups WHERE voided = 0 GROUP BY 1) t
  ON g.person_id = t.person_id AND g.obs_datetime < t.top GROUP BY 1)
SELECT person_id, group_id, child_value AS refill_days FROM uncapped {_REFILL}""",
    "refill_at_previous": f"""
WITH {PICKUPS}, {_GLOBAL}, chosen AS (
  SELECT p.person_id, max(p.obs_id) AS group_id FROM pickups p JOIN previous_global g
  ON g.person_id = p.person_id AND g.previous_date = p.obs_datetime GROUP BY 1)
SELECT person_id, group_id, child_value AS refill_days FROM chosen {_REFILL}""",
    "refill_before_quarter": f"""
WITH {PICKUPS}, {_BY_QUARTER}
SELECT person_id, group_id, child_value AS refill_days FROM by_quarter {_REFILL}""",
    "retention_outcome": f"WITH {PICKUPS}, {_LATEST} SELECT *, {_OUTCOME} AS outcome FROM latest",
    "retention_outcome_quarter": f"""
WITH {PICKUPS}, {_LATEST} SELECT person_id,
  CASE WHEN {_DUE} + 28 >= {_QUARTER} THEN 'Active' ELSE 'LTFU' END AS outcome FROM latest""",
    "current_status": f"""
WITH {PICKUPS}, {_LATEST}
SELECT latest.*, CASE WHEN c_acctbal < 0 THEN 'Death' END AS reason,
       CASE WHEN c_acctbal < 0 THEN 'Death' ELSE {_OUTCOME} END AS status
FROM latest LEFT JOIN customer ON c_custkey = person_id""",
    "appointment_status": f"""
WITH {PICKUPS}, {_LATEST}, due AS (SELECT person_id, {_DUE} - {_NOW} AS days FROM latest)
SELECT person_id, CASE WHEN days BETWEEN 1 AND 180 THEN 'Active With Drugs' WHEN days = 0 THEN 'Today Visit'
  WHEN days BETWEEN -28 AND -1 THEN 'Missed Appointment' ELSE 'LTFU' END AS appointment FROM due""",
    "next_visit": f"""
WITH {PICKUPS}, {_LATEST} SELECT person_id, {_DUE} AS next_day,
  CAST({_DUE} - {_NOW} AS INTEGER) AS days_left FROM latest""",
    "iit_date": f"WITH {PICKUPS}, {_LATEST} SELECT person_id, {_IIT} AS iit_date FROM latest",
    "iit_chance": f"""
WITH {PICKUPS}, {_LATEST}, s AS (SELECT person_id, {_OUTCOME} AS status, {_IIT} - {_END} AS days FROM latest)
SELECT person_id, status, CASE WHEN status = 'Active' AND days <= 29
  THEN round((29 - days) / 29.0, 4) END AS chance FROM s""",
    "months_of_refill": f"""
WITH {PICKUPS}, {_LATEST} SELECT person_id, round(refill_days / CAST(30 AS DOUBLE), 1) AS months FROM latest""",
    "quarter_status": f"""
{_ALL} SELECT person_id, CASE WHEN outcome IS NOT NULL THEN outcome WHEN last_quarter IS NULL THEN NULL
  WHEN quarter_iit >= {_QUARTER} THEN 'Active' ELSE 'LTFU' END AS "ARTStatusPreviousQuarter" FROM statuses""",
    "returned_to_care": f"""
{_ALL} SELECT person_id, previous_iit AS "PreviousIITDate",
  CASE WHEN returned IS NOT NULL THEN returned
       WHEN previous_date IS NOT NULL AND pickup > previous_iit AND status = 'Active' THEN pickup
  END AS "DateReturnedToCare" FROM statuses""",
    "previous_status": f"""
{_ALL}, named AS (SELECT *, {_PREVIOUS_STATUS} AS previous_status FROM statuses)
SELECT person_id, previous_status AS "PreviousARTStatus",
  CASE WHEN outcome_date IS NOT NULL THEN outcome_date
       WHEN previous_status = 'LTFU' THEN CAST(previous_iit AS TIMESTAMP)
       WHEN previous_status = 'Active' THEN previous_date END AS "PreviousARTStatusDate" FROM named""",
    "quarter_end": """
SELECT o_orderkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) - 1 AS quarter_end FROM orders""",
}
