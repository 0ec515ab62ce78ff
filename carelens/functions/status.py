"""Retention, appointment and risk statuses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelens.functions.dates import IIT_GRACE_DAYS, column, day, next_visit

OUTCOME_GRACE_DAYS = 28
WITH_DRUGS_DAYS = 180
SUPPRESSED_VIRAL_LOAD = 1000


def retention_outcome(pickup: Column | str, refill_days: Column | str,
                      at: Column | dt.date | str,
                      grace: int = OUTCOME_GRACE_DAYS) -> Column:
    """Active while the refill plus the grace days reach ``at``, else LTFU.

    A missing pickup or refill makes the comparison NULL, which is not Active.
    """
    due = F.date_add(next_visit(pickup, refill_days), grace)
    return F.when(due >= day(at), "Active").otherwise("LTFU")


def current_status(reason: Column | str, pickup: Column | str,
                   refill_days: Column | str, at: Column | dt.date | str,
                   grace: int = OUTCOME_GRACE_DAYS) -> Column:
    """The recorded termination reason, else the retention outcome."""
    return F.coalesce(column(reason), retention_outcome(pickup, refill_days, at, grace))


def appointment_status(next_day: Column | str, now: Column | dt.date | str) -> Column:
    left = F.datediff(column(next_day), day(now))
    # The appointment statuses.
    return (
        F.when(left.between(1, WITH_DRUGS_DAYS), "Active With Drugs")
        .when(left == 0, "Today Visit")
        .when(left.between(-OUTCOME_GRACE_DAYS, -1), "Missed Appointment")
        .otherwise("LTFU")
    )


def iit_chance(iit: Column | str, at: Column | dt.date | str,
               status: Column | str) -> Column:
    """Share of the grace period used up; only for active patients, never negative."""
    left = F.datediff(column(iit), day(at))
    chance = (F.lit(IIT_GRACE_DAYS) - left) / F.lit(float(IIT_GRACE_DAYS))
    return F.when(column(status).isin("Active", "Active(A)") & (chance >= 0), chance)


def vl_indication(date: Column | str, value: Column | str) -> Column:
    v = column(value)
    # The indications.
    return F.when(
        column(date).isNotNull(),
        F.when(v <= SUPPRESSED_VIRAL_LOAD, "Routine - Routine")
        .when(v > SUPPRESSED_VIRAL_LOAD, "Targeted - Post EAC"),
    )


def status_not_in(status: Column | str, values: list[str]) -> Column:
    """True where the status is none of ``values``; unknown passes, blank does not."""
    s = column(status)
    return s.isNull() | ~s.isin(*values, "")


def deceased_flag(dead: Column | str, death_date: Column | str) -> tuple[Column, Column]:
    """('Dead' or blank, date of death where dead)."""
    is_dead = column(dead) == 1
    return F.when(is_dead, "Dead").otherwise(""), F.when(is_dead, column(death_date))
