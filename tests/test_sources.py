from __future__ import annotations

import itertools
import threading

import pytest
from conftest import Clinic, at, day
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from carelens import sources
from carelens.plans.line_list import LINE_LIST_COLUMNS, line_list
from carelens.plans.profile import person_profile
from carelens.plans.report import programme_report
from carelens.sources import clustered


def small(clinic):
    clinic.patient(1, "0001")
    clinic.patient(2, "0002")
    clinic.pickup(1, "2024-05-01", 60)
    clinic.pickup(2, "2024-05-01", 10)
    clinic.obs(1, 856, "2024-05-01", number=20.0)
    return clinic.tables()


@pytest.fixture
def stored(clinic, tmp_path):
    for name, df in small(clinic).items():
        df.write.parquet(f"{tmp_path}/clinic/{name}")
    return f"{tmp_path}/clinic"


def test_clinical_tables_round_trip(spark, stored):
    tables = sources.load_clinical(spark, stored)
    assert set(tables) == set(sources.SCHEMAS) and len(tables) == 16
    assert tables["obs"].filter("concept_id = 856").first()["obs_datetime"] == at("2024-05-01")


def test_filters_and_columns_reach_the_scan(spark, stored):
    obs = sources.load_clinical(spark, stored)["obs"].filter(
        "voided = 0 and concept_id in (856, 5089)").select("person_id", "value_numeric")
    plan = obs._jdf.queryExecution().executedPlan().toString()
    assert "In(concept_id, [" in plan[plan.index("PushedFilters"):]
    assert "EqualTo(voided,0)" in plan
    read = plan[plan.index("ReadSchema"):]
    assert "value_text" not in read and "value_numeric" in read


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_line_list_file_feeds_the_report(spark, stored, tmp_path, fmt):
    listed = line_list(sources.load_clinical(spark, stored), "2024-04-01", "2024-06-30", "2024-06-30")
    sources.write_line_list(listed, f"{tmp_path}/list", fmt)
    read = sources.read_line_list(spark, f"{tmp_path}/list", fmt)
    assert sorted(read.columns) == sorted(LINE_LIST_COLUMNS)
    direct = programme_report(listed, "2024-06-30").orderBy("`S/No.`").collect()
    through = programme_report(read, "2024-06-30").orderBy("`S/No.`").collect()
    assert direct == through


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report_file_is_a_baseline(spark, stored, tmp_path, fmt):
    listed = line_list(sources.load_clinical(spark, stored), "2024-04-01", "2024-06-30", "2024-06-30")
    out = programme_report(listed, "2024-06-30")
    sources.write_report(out, f"{tmp_path}/report", fmt)
    back = sources.read_baseline(spark, f"{tmp_path}/report", fmt)
    assert back.columns == out.columns
    row = back.orderBy("`S/No.`").first()
    assert row["Last Pickup Date (yyyy-mm-dd)"] == day("2024-05-01")
    assert row["Months of ARV Refill"] == 2.0 and row["Case Manager"] is None


def test_unreadable_cells_are_missing(spark, tmp_path):
    (tmp_path / "list.csv").write_text("uuid,DOB,Age,LastPickupDate,Sex\nu1,soon,many,05-Jun-2024,\n")
    row = sources.read_line_list(spark, f"{tmp_path}/list.csv", "csv").first()
    assert (row["DOB"], row["Age"], row["Sex"]) == (None, None, None)
    assert row["LastPickupDate"] == at("2024-06-05")


def test_a_database_is_never_read_in_one_task_unasked(spark):
    with pytest.raises(ValueError, match="one_partition"):
        sources.load_clinical(spark, {"url": "jdbc:none"})
    with pytest.raises(ValueError, match="patient_program"):
        sources.load_clinical(spark, {"url": "jdbc:none"}, bounds={"obs": (1, 2)})


ODD_CELLS = ("first\nsecond", "carriage\r\nreturn", 'a "quoted" word', '"', '""', "a, b, c", "  both  ", "back\\slash",
             '\\"', "'", "#not a comment", " ", "tab\there", "é世界", ",", "\n", 'end"\n"', "null", "NaN")


@pytest.mark.parametrize("write, read", [(sources.write_line_list, sources.read_line_list),
                                         (sources.write_report, sources.read_baseline)])
def test_cells_of_delimited_text_come_back_whole(spark, tmp_path, write, read):
    rows = [(f"u{k}", cell, ODD_CELLS[-k - 1]) for k, cell in enumerate(ODD_CELLS)] + [("v", None, ""), ("w", "", None)]
    df = spark.createDataFrame(rows, "uuid string, Patient_Address string, OtherCauseOfDeath string")
    write(df.repartition(2), f"{tmp_path}/cells", "csv")
    back = read(spark, f"{tmp_path}/cells", "csv", corrupt="_corrupt")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(
        [(a, b or None, c or None, None) for a, b, c in rows], key=str)


def test_rows_that_do_not_fit_the_header_are_told(spark, tmp_path):
    (tmp_path / "list.csv").write_text('uuid,Sex,Age\nu1,F,30\nu2,M\nu3,F,31,more\n"u4","M\nF",32\n')
    found = {r["uuid"]: r for r in sources.read_line_list(spark, f"{tmp_path}/list.csv", "csv", corrupt="_corrupt").collect()}
    assert {u: r["_corrupt"] for u, r in found.items()} == {"u1": None, "u2": "u2,M", "u3": "u3,F,31,more", "u4": None}
    assert found["u4"]["Sex"] == "M\nF" and found["u4"]["Age"] == 32
    assert sources.read_line_list(spark, f"{tmp_path}/list.csv", "csv").columns == ["uuid", "Sex", "Age"]


def test_a_second_run_of_a_date_replaces_just_that_date(spark, tmp_path):
    made = lambda *rows: spark.createDataFrame(list(rows), "State string, uuid string, Age int")
    path = f"{tmp_path}/published"
    sources.publish(made(("A", "a", 1), ("B", "b", 2)), path, "2024-03-31")
    first = sources.publish(made(("A", "a", 3), ("B", "b", 4), (None, "c", 5)), path, "2024-06-30")
    sources.publish(made(("A", "a", 6)), path, "2024-06-30")
    found = sorted((str(r["end_date"]), r["State"], r["uuid"], r["Age"]) for r in sources.read_published(spark, path).collect())
    assert found == [("2024-03-31", "A", "a", 1), ("2024-03-31", "B", "b", 2), ("2024-06-30", "A", "a", 6)]
    assert [r["Age"] for r in sources.read_published(spark, path, "2024-06-30").collect()] == [6]
    assert [r["run"] for r in sources.retired_runs(spark, path).collect()] == [first]


def test_a_run_that_fails_changes_nothing(spark, tmp_path):
    from pyspark.errors import PySparkException

    path = f"{tmp_path}/published"
    good = spark.createDataFrame([("A", "a", 1), ("B", "b", 2)], "State string, uuid string, Age int")
    sources.publish(good, path, "2024-06-30")
    bad = good.withColumn("Age", F.when(F.col("State") == "B", F.raise_error(F.lit("lost")).cast("int")).otherwise(9))
    with pytest.raises(PySparkException):
        sources.publish(bad, path, "2024-06-30")
    assert sorted(r["Age"] for r in sources.read_published(spark, path).collect()) == [1, 2]


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sorted_rows(df):
    return sorted(map(repr, df.collect()))


def test_a_clustered_store_gives_the_same_list(spark, clinic, tmp_path):
    tables = small(clinic)
    sources.write_clustered(tables, f"{tmp_path}/store", 4)
    back = sources.load_clustered(spark, f"{tmp_path}/store")
    assert set(back) == set(sources.SCHEMAS)
    for name, df in tables.items():
        assert back[name].dtypes == df.dtypes
        assert sorted_rows(back[name]) == sorted_rows(df)
    dates = ("2024-04-01", "2024-06-30", "2024-06-30")
    assert sorted_rows(line_list(back, *dates)) == sorted_rows(line_list(tables, *dates))


def test_person_parts_of_a_store_meet_without_a_shuffle(shuffled_joins, clinic, tmp_path):
    tables = small(clinic)
    sources.write_clustered(tables, f"{tmp_path}/store", 4)
    back = sources.load_clustered(shuffled_joins, f"{tmp_path}/store")
    on_store, plain = person_profile(back, "2024-06-30"), person_profile(tables, "2024-06-30")
    assert sorted_rows(on_store) == sorted_rows(plain)
    assert planned(plain).count("hashpartitioning") >= 8
    assert "hashpartitioning" not in planned(on_store) and planned(on_store).count("SortMergeJoin") >= 8


def test_a_store_of_facilities_is_clustered_by_both(shuffled_joins, tmp_path):
    clinic = Clinic(shuffled_joins, "facility")
    for facility in ("A", "B"):
        clinic.patient(1, f"{facility}1", facility=facility)
        clinic.obs(1, 5089, "2024-05-01", number=50.0, facility=facility)
    tables = clinic.tables()
    sources.write_clustered(tables, f"{tmp_path}/store", 4, site="facility")
    back = sources.load_clustered(shuffled_joins, f"{tmp_path}/store", site="facility")
    found = person_profile(back, "2024-06-30", "facility")
    assert sorted((r["facility"], r["PatientHospitalNo"], r["weight"]) for r in found.collect()) == [
        ("A", "A1", 50.0), ("B", "B1", 50.0)]
    # Attribute types belong to a facility, not to a person: both sides of their join are shuffled,
    # then phones by person, then to the number of buckets.  Nothing else is.
    plain = person_profile(tables, "2024-06-30", "facility")
    assert sorted_rows(found) == sorted_rows(plain)
    assert planned(found).count("hashpartitioning") == 4 and planned(plain).count("hashpartitioning") >= 12


def test_a_hot_person_is_written_by_many_tasks_and_read_in_splits(spark, clinic, tmp_path):
    tables = small(clinic)
    schema = tables["obs"].schema
    empty = {f.name: F.lit(None).cast(f.dataType) for f in schema}
    hot = spark.range(40_000).select(*[x.alias(n) for n, x in {**empty, **{
        "obs_id": F.col("id"), "person_id": F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 > 0, F.col("id") % 500),
        "concept_id": F.lit(5089), "value_numeric": F.col("id").cast("double"), "voided": F.lit(0),
        "obs_datetime": F.lit("2024-05-01").cast("timestamp_ntz")}}.items()])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    typed = hot.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    sources.write_clustered({**tables, "obs": typed}, f"{tmp_path}/store", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", before)
    whole = sources.load_clustered(spark, f"{tmp_path}/store")
    split = sources.load_clustered(spark, f"{tmp_path}/store", skewed_rows=1000)
    files = spark.read.parquet(f"{tmp_path}/store/obs").filter("person_id = 7").select(F.input_file_name()).distinct()
    assert files.count() >= 2
    agg = lambda t: t["obs"].groupBy("person_id").agg(F.max("value_numeric").alias("v"))
    assert "hashpartitioning" not in planned(agg(whole)) and "hashpartitioning" in planned(agg(split))
    assert sorted_rows(agg(whole)) == sorted_rows(agg(split)) and agg(split).count() == 501
    assert whole["obs"].count() == 40_000


def test_part_of_a_store_is_refused(spark, clinic, tmp_path):
    tables = small(clinic)
    with pytest.raises(ValueError, match="obs"):
        sources.write_clustered({k: v for k, v in tables.items() if k != "obs"}, f"{tmp_path}/none", 4)
    tables["users"].write.parquet(f"{tmp_path}/part/users")
    with pytest.raises(AnalysisException):
        sources.load_clustered(spark, f"{tmp_path}/part")
    store = sources.write_clustered(tables, f"{tmp_path}/store", 2)
    with pytest.raises(AnalysisException):
        sources.write_clustered(tables, f"{tmp_path}/store", 2)
    assert spark.catalog.tableExists(f"default.carelens_{store}_obs")
    sources.forget_clustered(spark, f"{tmp_path}/store")
    assert not spark.catalog.tableExists(f"default.carelens_{store}_obs")
    # Another session knows the store by its folder alone.
    assert sources.load_clustered(spark, f"{tmp_path}/store")["obs"].count() == tables["obs"].count()


def test_tables_of_a_store_are_written_at_once(spark, clinic, tmp_path, monkeypatch):
    """The first two tables wait for each other: one after the other they never meet."""
    meet, calls, bucket = threading.Barrier(2, timeout=60), itertools.count(), clustered._bucket

    def waiting(keys, buckets):
        if next(calls) < 2:
            meet.wait()
        return bucket(keys, buckets)

    monkeypatch.setattr(clustered, "_bucket", waiting)
    tables = small(clinic)
    sources.write_clustered(tables, f"{tmp_path}/store", 4)
    back = sources.load_clustered(spark, f"{tmp_path}/store")
    assert all(back[n].count() == df.count() for n, df in tables.items())
