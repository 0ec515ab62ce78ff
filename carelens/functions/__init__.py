"""Column functions: dates, statuses, text and conditional updates."""

from carelens.functions.dates import (
    age_at_start,
    age_years,
    day,
    days_to_schedule,
    end_of_last_quarter,
    format_date,
    iit_date,
    months_of_refill,
    newest,
    next_visit,
    parse_date,
)
from carelens.functions.status import (
    appointment_status,
    current_status,
    deceased_flag,
    iit_chance,
    retention_outcome,
    status_not_in,
    vl_indication,
)
from carelens.functions.text import (
    blank_to_null,
    composite_key,
    full_name,
    normalise_id,
    recode,
    strip_zeros,
)
from carelens.functions.update import fill_where

__all__ = [
    "age_at_start", "age_years", "appointment_status", "blank_to_null",
    "composite_key", "current_status", "day", "days_to_schedule",
    "deceased_flag", "end_of_last_quarter", "fill_where", "format_date",
    "full_name", "iit_chance", "iit_date", "months_of_refill", "newest",
    "next_visit", "normalise_id", "parse_date", "recode", "retention_outcome",
    "status_not_in", "strip_zeros", "vl_indication",
]
