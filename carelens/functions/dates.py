"""Date arithmetic used by the line list and the report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two written date styles of the outputs.
STYLES = {
    "dd-Mon-yyyy": "dd-MMM-yyyy",
    "dd/mm/yyyy": "dd/MM/yyyy",
}
# The layouts a stage file may hold a date in.
PARSE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "dd-MMM-yyyy", "dd/MM/yyyy")
# Days after the refill runs out at which a treatment interruption is dated.
IIT_GRACE_DAYS = 29
DAYS_PER_MONTH = 30


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(d: Column | dt.date | str) -> Column:
    """A calendar day given as a date, an ISO string or a column."""
    if isinstance(d, Column):
        return d.cast("date")
    return F.lit(d).cast("date")


def end_of_last_quarter(d: Column | dt.date | str) -> Column:
    """Last day of the calendar quarter before the one ``d`` is in."""
    return F.date_sub(F.trunc(day(d), "quarter"), 1)


def age_years(dob: Column | str, at: Column | dt.date | str) -> Column:
    """Completed years; a 29 February birthday completes on 1 March."""
    return F.timestamp_diff("YEAR", column(dob), day(at)).cast("int")


def age_at_start(dob: Column | str, start: Column | str) -> tuple[Column, Column]:
    """(years, months): under five the years read 0 and the months are filled."""
    years = F.timestamp_diff("YEAR", column(dob), column(start))
    months = F.timestamp_diff("MONTH", column(dob), column(start))
    return (
        F.when(years >= 5, years).otherwise(0).cast("int"),
        F.when(years < 5, months).cast("int"),
    )


def next_visit(pickup: Column | str, refill_days: Column | str) -> Column:
    """The day the dispensed refill runs out; a fraction of a day is rounded."""
    return F.date_add(column(pickup).cast("date"), F.round(column(refill_days)).cast("int"))


def days_to_schedule(pickup: Column | str, refill_days: Column | str,
                     now: Column | dt.date | str) -> Column:
    return F.datediff(next_visit(pickup, refill_days), day(now))


def iit_date(pickup: Column | str, refill_days: Column | str) -> Column:
    """The day a patient who does not return counts as interrupted."""
    return F.date_add(next_visit(pickup, refill_days), IIT_GRACE_DAYS)


def months_of_refill(days: Column | str) -> Column:
    return F.bround(column(days).cast("double") / DAYS_PER_MONTH, 1)


def format_date(d: Column | str, style: str = "dd-Mon-yyyy") -> Column:
    return F.date_format(column(d), STYLES[style])


def parse_date(s: Column | str, formats: tuple[str, ...] = PARSE_FORMATS) -> Column:
    """The first layout that fits, NULL where none does."""
    return F.coalesce(*[F.try_to_date(column(s), f) for f in formats])


def newest(a: Column | str, b: Column | str) -> Column:
    """The later of two dates; a missing one never wins."""
    return F.greatest(column(a), column(b))
