from __future__ import annotations

import datetime as dt

import pytest
from conftest import day
from pyspark.sql import functions as F

from carelens import functions as fn


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def date(text):
    return F.lit(None).cast("date") if text is None else F.lit(day(text))


@pytest.mark.parametrize(("pickup", "refill", "expected"), [
    ("2024-05-03", 30, "Active"), ("2024-05-02", 30, "LTFU"),
    ("2024-05-03", None, "LTFU"), (None, 30, "LTFU")])
def test_retention_outcome(spark, pickup, refill, expected):
    column = fn.retention_outcome(date(pickup), F.lit(refill).cast("int"), "2024-06-30")
    assert value(spark, column) == expected


def test_recorded_reason_wins(spark):
    assert value(spark, fn.current_status(
        F.lit("Death"), date("2024-06-29"), F.lit(30), "2024-06-30")) == "Death"


def test_interruption_date_and_chance(spark):
    iit = fn.iit_date(date("2024-05-03"), F.lit(30))
    assert value(spark, iit) == day("2024-07-01")
    chance = value(spark, fn.iit_chance(iit, "2024-06-30", F.lit("Active")))
    assert chance == pytest.approx(28 / 29)
    assert value(spark, fn.iit_chance(iit, "2024-06-30", F.lit("IIT"))) is None
    assert value(spark, fn.iit_chance(iit, "2024-06-01", F.lit("Active"))) is None
    assert value(spark, fn.iit_chance(iit, "2024-07-20", F.lit("Active(A)"))) > 1


@pytest.mark.parametrize(("next_day", "expected"), [
    ("2024-12-27", "Active With Drugs"), ("2024-12-28", "LTFU"), ("2024-07-01", "Active With Drugs"),
    ("2024-06-30", "Today Visit"), ("2024-06-02", "Missed Appointment"), ("2024-06-01", "LTFU"),
    (None, "LTFU")])
def test_appointment_status(spark, next_day, expected):
    assert value(spark, fn.appointment_status(date(next_day), "2024-06-30")) == expected


@pytest.mark.parametrize(("given", "expected"), [
    ("2024-02-10", "2023-12-31"), ("2024-04-01", "2024-03-31"), ("2024-09-30", "2024-06-30"),
    ("2024-12-31", "2024-09-30")])
def test_end_of_last_quarter(spark, given, expected):
    assert value(spark, fn.end_of_last_quarter(given)) == day(expected)


def test_ages(spark):
    assert value(spark, fn.age_years(date("2000-02-29"), "2001-02-28")) == 0
    assert value(spark, fn.age_years(date("2000-02-29"), "2001-03-01")) == 1
    years, months = fn.age_at_start(date("2020-01-15"), date("2023-01-15"))
    assert (value(spark, years), value(spark, months)) == (0, 36)
    years, months = fn.age_at_start(date("2010-01-15"), date("2023-01-14"))
    assert (value(spark, years), value(spark, months)) == (12, None)


@pytest.mark.parametrize(("status", "expected"), [
    (None, True), ("", False), ("Active", True), ("Death", False)])
def test_status_not_in(spark, status, expected):
    assert value(spark, fn.status_not_in(F.lit(status).cast("string"), ["Death"])) is expected


def test_newest(spark):
    assert value(spark, fn.newest(date(None), date("2024-01-01"))) == day("2024-01-01")
    assert value(spark, fn.newest(date("2024-01-02"), date(None))) == day("2024-01-02")
    assert value(spark, fn.newest(date("2024-01-02"), date("2024-01-03"))) == day("2024-01-03")


@pytest.mark.parametrize(("load", "seen", "expected"), [
    (1000, "2024-01-01", "Routine - Routine"), (1001, "2024-01-01", "Targeted - Post EAC"),
    (None, "2024-01-01", None), (10, None, None)])
def test_vl_indication(spark, load, seen, expected):
    assert value(spark, fn.vl_indication(date(seen), F.lit(load).cast("double"))) == expected


@pytest.mark.parametrize(("given", "expected"), [
    ("0012", "12"), ("A012", "A012"), ("000", ""), (None, None), ("12 ", "12 ")])
def test_strip_zeros(spark, given, expected):
    assert value(spark, fn.strip_zeros(F.lit(given).cast("string"))) == expected


def test_composite_key(spark):
    missing = F.lit(None).cast("string")
    assert value(spark, fn.composite_key(F.lit("a"), missing, F.lit("b"))) == "ananb"
    assert value(spark, fn.composite_key(F.lit("a"), F.lit("b"), sep="|")) == "a|b"


def test_full_name_needs_both(spark):
    assert value(spark, fn.full_name(F.lit("Ada"), F.lit("Obi"))) == "Ada Obi"
    assert value(spark, fn.full_name(F.lit("Ada"), F.lit(None).cast("string"))) is None


def test_written_and_parsed_dates(spark):
    assert value(spark, fn.format_date(date("2024-06-05"))) == "05-Jun-2024"
    assert value(spark, fn.format_date(date("2024-06-05"), "dd/mm/yyyy")) == "05/06/2024"
    for text in ("2024-06-05", "2024-06-05 09:30:00", "05-Jun-2024", "05/06/2024"):
        assert value(spark, fn.parse_date(F.lit(text))) == day("2024-06-05")
    assert value(spark, fn.parse_date(F.lit("soon"))) is None


def test_months_of_refill(spark):
    assert value(spark, fn.months_of_refill(F.lit(100))) == pytest.approx(3.3)


def test_recode_keeps_unlisted(spark):
    df = spark.createDataFrame([("M",), ("X",), (None,)], "s string")
    out = [r[0] for r in df.select(fn.recode("s", {"M": "Male"})).collect()]
    assert out == ["Male", "X", None]


def test_deceased_flag(spark):
    flag, died = fn.deceased_flag(F.lit(1), date("2024-01-01"))
    assert (value(spark, flag), value(spark, died)) == ("Dead", day("2024-01-01"))
    flag, died = fn.deceased_flag(F.lit(None).cast("int"), date("2024-01-01"))
    assert (value(spark, flag), value(spark, died)) == ("", None)


def test_fill_where_and_blanks(spark):
    df = spark.createDataFrame([("a", 1), ("", 2)], "`x y` string, n int")
    filled = fn.fill_where(df, "x y", F.col("n") == 1, "z")
    assert [r[0] for r in filled.collect()] == ["z", ""]
    assert [r[0] for r in fn.blank_to_null(df).collect()] == ["a", None]


def test_normalised_identifiers(spark):
    assert value(spark, fn.normalise_id(F.lit("Ab1  "))) == "ab1"


def test_dates_accept_columns(spark):
    assert value(spark, fn.day(F.lit(dt.datetime(2024, 1, 2, 9)))) == day("2024-01-02")
