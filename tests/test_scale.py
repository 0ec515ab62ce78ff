"""Plan shapes, and results when one key holds a large share of all rows."""

from __future__ import annotations

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from carelens.bindings import catalog
from carelens.bindings.tables import PICKUP_END, clinical_tables
from carelens.operators import latest, lookups, ordered, rows, summaries
from carelens.plans import concepts as c
from carelens.plans.line_list import observation_facts, person_rows, visit_facts
from carelens.plans.tracking import pivot_tracking

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


PLANNED = sorted(catalog.queries())


@pytest.mark.parametrize("name", PLANNED)
def test_no_query_pairs_all_rows(no_broadcast, name):
    shape = plan(entry.queries()[name](no_broadcast, SF_DIR))
    assert "CartesianProduct" not in shape
    assert "BroadcastNestedLoopJoin" not in shape
    assert "PythonUDF" not in shape and "MapInPandas" not in shape


def test_row_limit_runs_before_the_shuffle(spark):
    shape = plan(entry.queries()["previous_distinct_date"](spark, SF_DIR))
    assert re.search(r"WindowGroupLimit.*Partial", shape)
    shape = plan(entry.queries()["suffix_duplicates"](spark, SF_DIR))
    assert re.search(r"WindowGroupLimit.*row_number\(\), 27, Partial", shape)


def test_person_parts_join_without_further_shuffles(no_broadcast):
    t = clinical_tables(no_broadcast, SF_DIR)
    df = person_rows(t, PICKUP_END)
    # The joins by person sit right on aggregates: no exchange below a person join but
    # those of the aggregates themselves.
    joins = re.findall(r"SortMergeJoin \[person_id#\d+L\], \[person_id#\d+L\]", plan(df))
    assert len(joins) >= 5  # patients and the four demographic tables


def test_a_line_list_reads_observations_three_times(no_broadcast):
    """For visits, for all else of a person, and for the answers of tracking visits alone."""
    shape = plan(entry.queries()["line_list"](no_broadcast, SF_DIR))
    assert shape.count("events.parquet") == 3 and shape.count("lineitem.parquet") == 1
    persons = plan(person_rows(clinical_tables(no_broadcast, SF_DIR), PICKUP_END))
    assert persons.count("events.parquet") == 2


def test_facts_read_observations_once(spark):
    t = clinical_tables(spark, SF_DIR)
    names = latest.preferred_names(t["concept_name"])
    # The record's observations come from three files: each is read once.
    facts = plan(observation_facts(t["obs"], names, PICKUP_END, "person_id"))
    assert "Window" not in facts
    assert facts.count("events.parquet") == 1 and facts.count("lineitem.parquet") == 1
    visits = plan(visit_facts(t["obs"], t["encounter"], names, PICKUP_END, "person_id"))
    assert "WindowGroupLimit" in visits and visits.count("events.parquet") == 1


def test_facts_merge_without_sorts_and_stay_with_their_person(no_broadcast):
    """Rows merge in a hash table, and no shuffle follows the join with the visits."""
    t = clinical_tables(no_broadcast, SF_DIR)
    names = latest.preferred_names(t["concept_name"])
    visits = visit_facts(t["obs"], t["encounter"], names, PICKUP_END, "person_id")
    facts = plan(observation_facts(t["obs"], names, PICKUP_END, "person_id", visits=visits))
    assert "partial_min_by" in facts
    # A grain of a person, a kind of row and more sorts nothing; only names and whole visits do.
    assert not re.search(r"SortAggregate\(key=\[person_id#\d+L, [^]]*,", facts)
    assert not re.search(r"hashpartitioning\(person_id#\d+L, concept_id#\d+, \d+\)", facts)


@pytest.fixture(scope="module")
def skewed(spark):
    """300,000 observations; a third belong to person 0, many at the same instant."""
    n = 300_000
    person = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") >= 0, F.col("id") % 1000 + 1)
    return spark.range(n).repartition(8).select(
        F.col("id").alias("obs_id"), person.cast("long").alias("person_id"),
        (F.col("id") % 4).cast("int").alias("concept_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("id") / 7) * 60)
        .cast("timestamp_ntz").alias("obs_datetime"),
        (F.col("id") % 97).cast("double").alias("value_numeric"),
        (F.col("id") % 11).cast("int").alias("value_coded"),
        (F.col("id") % 13 == 0).cast("int").alias("voided")).persist()


END = "2023-12-20"


def frame(df):
    out = df.toPandas()
    return out[out.voided == 0], out


def test_latest_and_pivot_of_a_hot_person(spark, skewed):
    live, _ = frame(skewed)
    live = live[live.obs_datetime <= END]
    last = live.groupby(["person_id", "concept_id"]).obs_datetime.transform("max")
    expected = live[live.obs_datetime == last]
    assert latest.latest_rows(skewed, END).count() == len(expected)
    best = expected.groupby(["person_id", "concept_id"]).value_numeric.max()
    wide = latest.pivot_latest(skewed, {"v": (2, "value_numeric")}, END).toPandas().set_index("person_id").v
    for person in (0, 2, 6, 500):
        assert wide[person] == best[(person, 2)] if (person, 2) in best else True
    assert wide[0] == best[(0, 2)]


def test_previous_instants_of_a_hot_person(spark, skewed):
    live, _ = frame(skewed)
    mine = live[(live.person_id == 0) & (live.obs_datetime <= END)].obs_datetime
    distinct = sorted(mine.unique(), reverse=True)
    found = ordered.previous_distinct_date(skewed, END).filter("person_id = 0").toPandas()
    assert found.previous_date[0] == distinct[1]
    nth = ordered.nth_latest(skewed, END, 5).filter("person_id = 0").toPandas()
    assert nth.nth_date[0] == sorted(mine, reverse=True)[4]


def test_refill_before_latest_of_a_hot_person(spark, skewed):
    live, all_rows = frame(skewed)
    mine = live[(live.person_id == 0) & (live.obs_datetime <= END)].obs_datetime.max()
    expected = all_rows[(all_rows.person_id == 0) & (all_rows.obs_datetime < mine)].obs_id.max()
    bounds = skewed.filter("voided = 0").filter(F.col("obs_datetime") <= F.lit(END).cast("date")).groupBy(
        "person_id").agg(F.max("obs_datetime").alias("top"))
    found = ordered.refill_before(skewed, bounds, "top").filter("person_id = 0").first()
    assert found["group_id"] == expected


def test_repeated_keys_of_a_hot_key(spark, skewed):
    single = rows.drop_all_duplicates(skewed.select("person_id", "obs_id"), "person_id")
    assert single.count() == 0
    suffixed = rows.suffix_duplicates(
        skewed.select(F.col("person_id").cast("string").alias("key"), "obs_id"), "key", ["obs_id"])
    counts = suffixed.agg(F.count("*").alias("n"), F.count("key").alias("named")).first()
    _, everything = frame(skewed)
    assert counts["n"] == len(everything)
    assert counts["named"] == everything.groupby("person_id").size().clip(upper=26).sum()


def test_lookup_and_summaries_of_a_hot_key(spark, skewed, no_broadcast):
    names = spark.createDataFrame([(i, f"n{i}") for i in range(0, 11, 2)], "concept_id int, name string")
    decoded = lookups.decode_coded(skewed, names)
    assert decoded.filter("name is null").count() == skewed.filter("value_coded % 2 = 1").count()
    quality = summaries.capture_quality(
        skewed.select("person_id", "obs_datetime", F.lit("L").alias("finger"), "value_numeric"),
        "person_id", "value_numeric", "obs_datetime", "finger", 50)
    assert quality.agg(F.sum(F.col("n_low") + F.col("n_not_low"))).first()[0] == 300_000


@pytest.fixture
def small_partitions(no_broadcast):
    """Thresholds at which the test data counts as skewed."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: no_broadcast.conf.get(k, None) for k in small}
    for key, value in small.items():
        no_broadcast.conf.set(key, value)
    yield no_broadcast
    for key, value in before.items():
        if value is None:
            no_broadcast.conf.unset(key)
        else:
            no_broadcast.conf.set(key, value)


def final_plan(df):
    df.collect()
    return plan(df)


def test_hot_partitions_are_split(skewed, small_partitions):
    spark = small_partitions
    bounds = skewed.groupBy("person_id").agg(F.max("obs_datetime").alias("top"))
    assert "skew=true" in final_plan(ordered.refill_before(skewed, bounds, "top"))
    wide = [F.max(c) for c in ("obs_id", "obs_datetime", "value_numeric")]
    coded = skewed.withColumn("value_coded", F.when(F.col("person_id") == 0, 4).when(
        F.col("person_id") > 0, (F.col("obs_id") % 1000).cast("int")))
    words = spark.range(1000).select(
        F.when(F.col("id") >= 0, F.col("id").cast("int")).alias("concept_id"),
        F.col("id").cast("string").alias("name"), F.lit("en").alias("locale"),
        F.lit(1).alias("locale_preferred"))
    names = latest.preferred_names(words)
    assert "skew=true" in final_plan(lookups.decode_coded(coded, names).groupBy("name").agg(*wide))
    uncoded = coded.withColumn("value_coded", F.when(F.col("person_id") != 0, F.col("value_coded")))
    assert "skew=true" in final_plan(lookups.decode_coded(uncoded, names).groupBy("name").agg(*wide))
    visits = skewed.select((F.col("obs_id") % 5000 + 1).alias("encounter_id"), F.lit(1).alias("form_id"),
                           F.lit(0).alias("voided")).distinct()
    seen = skewed.withColumn("encounter_id", F.when(F.col("person_id") == 0, 7).otherwise(
        F.col("obs_id") % 5000 + 1))
    assert "skew=true" in final_plan(lookups.attach_encounter(seen, visits, ["form_id"]).groupBy(
        "form_id").agg(*wide))


@pytest.fixture(scope="module")
def hot_refills(spark):
    """90,000 refill groups with a child each; a third belong to person 0."""
    n = 90_000
    person = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000 + 1).cast("long").alias("person_id")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("id") / 7) * 60).cast("timestamp_ntz")
    own = spark.range(n).repartition(8).select(person, at.alias("obs_datetime"), F.col("id"))
    empty = {"value_coded": F.lit(None).cast("int"), "value_datetime": F.lit(None).cast("timestamp_ntz"),
             "voided": F.lit(0)}
    groups = own.withColumns({**empty, "obs_id": F.col("id"), "concept_id": F.lit(c.REFILL_GROUP),
                              "obs_group_id": F.lit(None).cast("long"), "value_numeric": F.lit(None).cast("double")})
    children = own.withColumns({**empty, "obs_id": F.col("id") + n, "concept_id": F.lit(c.REFILL_DAYS),
                                "obs_group_id": F.col("id"), "value_numeric": (F.col("id") % 97).cast("double")})
    return groups.union(children.select(groups.columns)).drop("id").persist()


def test_refills_of_a_hot_person(hot_refills, small_partitions):
    spark = small_partitions
    names = spark.createDataFrame([], "concept_id int, name string")
    bound = F.timestamp_seconds(F.lit(1_700_000_000 + 6_000_00)).cast("timestamp_ntz")
    visits = spark.range(2000).select(
        F.col("id").alias("person_id"), bound.alias("latest_pickup"), F.lit(30_000).cast("long").alias("quarter_group"))
    df = observation_facts(hot_refills, names, "2024-01-01", "person_id", visits=visits)
    found = {r.person_id: r for r in df.collect()}
    assert "skew=true" in plan(df)
    groups = hot_refills.filter(F.col("concept_id") == c.REFILL_GROUP).toPandas()
    edge = groups.obs_datetime.min() + pd.Timedelta(seconds=600_000)
    for person in (0, 2, 500):
        mine = groups[groups.person_id == person]
        last = mine[mine.obs_datetime == mine.obs_datetime.max()].obs_id.max()
        before = mine[mine.obs_datetime < edge].obs_id.max()
        assert (found[person].DaysOfARVRefil, found[person].PreviousDaysOfARVRefil) == (last % 97, before % 97)
    assert found[0].DrugDurationPreviousQuarter == 30_000 % 97 and found[2].DrugDurationPreviousQuarter is None


def test_tracking_is_one_row_per_patient(spark):
    t = clinical_tables(spark, SF_DIR)
    found = pivot_tracking(t, "1995-01-01", "2001-06-30")
    assert found.count() == found.select("patient_id").distinct().count()
