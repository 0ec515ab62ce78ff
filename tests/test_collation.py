"""Texts compared as a database with a case-blind collation compares them."""

from __future__ import annotations

import unicodedata

import pytest
from conftest import Clinic
from pyspark.sql import functions as F

from carelens.operators.collation import DATABASE_COLLATION, one_spelling
from carelens.plans.line_list import line_list

DATES = ("2024-04-01", "2024-06-30", "2024-06-30")


def folded(text):
    bare = "".join(x for x in unicodedata.normalize("NFD", text) if not unicodedata.combining(x))
    return bare.lower().rstrip(" ")


def test_one_spelling_equals_brute_force(spark):
    texts = ["AB1", "ab1", "Ab1  ", "áb1", " ab1", "ab 1", "", "  ", None, "Zoë", "zoe", "ZOÉ ", "zo", "ab1", "AB1"]
    rows = [(site, k, text) for site in ("x", "y") for k, text in enumerate(texts[(site == "y"):])]
    df = spark.createDataFrame(rows, "site string, k int, text string")
    smallest = {}
    for site, _, text in rows:
        if text is not None:
            key = (site, folded(text))
            smallest[key] = min(smallest.get(key, text), text)
    expected = sorted((s, k, t and smallest[s, folded(t)] if t else (None if t is None else smallest[s, ""]))
                      for s, k, t in rows)
    found = one_spelling(df, "text", among="site")
    assert found.columns == df.columns
    assert sorted(((r["site"], r["k"], r["text"]) for r in found.collect()), key=str) == sorted(expected, key=str)
    assert one_spelling(df.filter("false"), "text").count() == 0


def test_one_spelling_of_a_hot_text(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        df = spark.range(90_000).repartition(8).select(
            "id", F.when(n % 3 == 0, "Hot").when(n % 2 == 0, F.concat(F.lit("a"), (n % 5000).cast("string")))
            .otherwise(F.concat(F.lit("A"), ((n - 1) % 5000).cast("string"), F.lit(" "))).alias("text"))
        found = one_spelling(df, "text")
        assert found.groupBy("text").count().filter("text = 'Hot'").first()["count"] == 30_000
        assert found.filter("text not like 'A%' and text != 'Hot'").join(
            df.filter("text like 'A%'").select(F.lower(F.rtrim("text")).alias("text")).distinct(), "text").count() == 0
        found.agg(F.max("text"), F.max("id")).collect()
        wide = found.groupBy("id").agg(F.max("text").alias("text"))
        wide.collect()
        shape = wide._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in shape and "NestedLoop" not in shape and "Cartesian" not in shape
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def spelled(spark):
    clinic = Clinic(spark)
    for pid, number in ((1, "Éb1"), (2, "eB1  "), (3, "eb2")):
        clinic.patient(pid, number)
        clinic.pickup(pid, f"2024-0{pid}-01", 30)
    clinic.name(1, "apple")
    clinic.name(2, "Zebra")
    clinic.obs(1, 1659, "2024-05-01", coded=1)
    clinic.obs(1, 1659, "2024-05-01", coded=2)
    return clinic.tables()


def test_a_list_under_a_collation(spelled):
    plain = line_list(spelled, *DATES)
    assert sorted(r["PatientHospitalNo"] for r in plain.collect()) == ["eB1  ", "eb2", "Éb1"]
    listed = line_list(spelled, *DATES, collation=DATABASE_COLLATION)
    assert listed.dtypes == plain.dtypes
    rows = {r["PatientHospitalNo"]: r for r in listed.collect()}
    # One number for two spellings; its visit is the latest of both persons.
    assert sorted(rows) == ["eB1  ", "eb2"]
    assert str(rows["eB1  "]["LastVisitDate"]) == "01-Feb-2024"
    # By code point the largest name is apple; under the collation it is Zebra.
    by_number = {r["PatientHospitalNo"]: r["TBStatus"] for r in plain.collect()}
    assert by_number["Éb1"] == "apple" and rows["eB1  "]["TBStatus"] == "Zebra"
