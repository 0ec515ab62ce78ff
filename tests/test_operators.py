from __future__ import annotations

import pytest
from conftest import at, day, rows_of
from pyspark.sql import functions as F

from carelens.operators import filters, latest, lookups, ordered, rows, summaries

OBS = ("obs_id long, person_id long, concept_id int, obs_datetime timestamp_ntz, "
       "value_numeric double, name string, voided int")


def obs(spark, *data):
    full = [(i + 1, *d) if len(d) == 6 else (i + 1, *d, 0) for i, d in enumerate(data)]
    return spark.createDataFrame([(*r[:3], at(r[3]), *r[4:]) for r in full], OBS)


def test_cut_off_is_midnight(spark):
    df = obs(spark, (1, 5, "2024-06-30 09:00", 1.0, "a"), (1, 5, "2024-06-30", 2.0, "b"))
    assert [r["name"] for r in filters.as_of(df, "obs_datetime", "2024-06-30").collect()] == ["b"]


def test_latest_rows_keep_ties_and_skip_voided(spark):
    df = obs(spark, (1, 5, "2024-01-02", 1.0, "a"), (1, 5, "2024-01-02", 2.0, "b"),
             (1, 5, "2024-01-01", 3.0, "c"), (1, 5, "2024-01-03", 4.0, "d", 1))
    assert [r["name"] for r in rows_of(latest.latest_rows(df, "2024-06-30"), "name")] == ["a", "b"]
    assert [r["name"] for r in rows_of(latest.earliest_rows(df, "2024-06-30"), "name")] == ["c"]


def test_pivot_takes_the_largest_value_of_the_last_instant(spark):
    df = obs(spark, (1, 5, "2024-01-02", 1.0, "A"), (1, 5, "2024-01-02", 2.0, "B"),
             (1, 5, "2024-01-01", 9.0, "Z"), (1, 6, "2024-01-05", None, None))
    row = latest.pivot_latest(df, {"n": (5, "name"), "v": (5, "value_numeric"), "w": (6, "value_numeric"),
                                   "any": ({5, 6}, "name")}, "2024-06-30").first()
    assert (row["n"], row["v"], row["w"], row["any"]) == ("B", 2.0, None, "B")


def test_latest_unbounded_hides_superseded_values(spark):
    df = obs(spark, (1, 856, "2024-01-01", 1.0, "a"), (1, 856, "2024-09-01", 1.0, "b"),
             (2, 856, "2024-01-01", 1.0, "a"))
    found = rows_of(latest.latest_unbounded(df, (856,), "2024-06-30"), "person_id")
    assert [r["latest_date"] for r in found] == [None, at("2024-01-01")]


def test_previous_dates_with_and_without_ties(spark):
    tied = obs(spark, (1, 5, "2024-03-01", 1.0, "a"), (1, 5, "2024-03-01", 1.0, "b"),
               (1, 5, "2024-01-01", 1.0, "c"))
    assert ordered.previous_distinct_date(tied, "2024-06-30").first()["previous_date"] == at("2024-01-01")
    assert ordered.nth_latest(tied, "2024-06-30").first()["nth_date"] == at("2024-03-01")
    assert ordered.nth_latest(tied, "2024-06-30", 3).first()["nth_date"] == at("2024-01-01")
    assert ordered.nth_latest(tied, "2024-06-30", 4).first()["nth_date"] is None


def test_previous_against_all_time(spark):
    df = obs(spark, (1, 5, "2024-01-01", 1.0, "a"), (1, 5, "2024-02-01", 1.0, "b"),
             (1, 5, "2024-09-01", 1.0, "c"))
    assert ordered.previous_vs_global(df, "2024-06-30").first()["previous_date"] == at("2024-02-01")
    assert ordered.previous_distinct_date(df, "2024-06-30").first()["previous_date"] == at("2024-01-01")


def test_previous_equals_second_latest_without_ties(spark):
    df = obs(spark, *[(p, 5, f"2024-0{m}-0{p}", 1.0, "x") for p in range(1, 6) for m in range(1, p + 1)])
    one = {r["person_id"]: r["previous_date"]
           for r in ordered.previous_distinct_date(df, "2024-06-30").collect()}
    two = {r["person_id"]: r["nth_date"] for r in ordered.nth_latest(df, "2024-06-30").collect()}
    assert one == two and one[1] is None


def test_last_date_by_period_end(spark):
    df = obs(spark, (1, 5, "2024-03-31", 1.0, "a"), (1, 5, "2024-04-02", 1.0, "b"))
    assert ordered.last_date_by_period_end(df, "2024-06-30").first()["last_date"] == at("2024-03-31")


def test_child_value_is_that_of_the_first_live_child(spark):
    children = spark.createDataFrame(
        [(10, 1, 7, 159368, 30.4, 0), (11, 1, 7, 159368, 60.0, 0), (9, 1, 7, 159368, 90.0, 1),
         (12, 1, None, 159368, 5.0, 0), (13, 2, 7, 159368, 6.0, 0)],
        "obs_id long, person_id long, obs_group_id long, concept_id int, value_numeric double, voided int")
    values = ordered.child_values(children, 159368)
    groups = spark.createDataFrame([(1, 7), (2, 8)], "person_id long, group_id long")
    found = rows_of(ordered.child_value(groups, values, ["group_id", "person_id"]), "person_id")
    assert [r["child_value"] for r in found] == [30, None]


def test_attach_child_values_keeps_all_rows(spark):
    values = spark.createDataFrame([(7, 1, 30), (8, 1, 60), (7, 2, 9)],
                                   "obs_group_id long, person_id long, child_value int")
    people = spark.createDataFrame([(1, 7, 8, "x"), (2, None, 99, None), (3, None, None, "z")],
                                   "person_id long, a long, b long, kept string")
    found = rows_of(ordered.attach_child_values(people, values, {"first": "a", "second": "b"}), "person_id")
    assert [(r["first"], r["second"], r["kept"]) for r in found] == [
        (30, 60, "x"), (None, None, None), (None, None, "z")]


def test_current_value_breaks_ties_by_id(spark):
    data = spark.createDataFrame(
        [(1, 1, 4, 100, at("2024-01-01"), 1, 0), (2, 1, 4, 100, at("2024-01-01"), 2, 0),
         (3, 1, 4, 101, at("2024-02-01"), 1, 0), (4, 1, 4, 100, at("2024-03-01"), 9, 0)],
        "obs_id long, person_id long, concept_id int, encounter_id long, "
        "obs_datetime timestamp_ntz, value_coded int, voided int")
    visits = spark.createDataFrame([(100, 13, 0), (101, 11, 0)],
                                   "encounter_id long, encounter_type int, voided int")
    names = spark.createDataFrame([(1, "one"), (2, "two")], "concept_id int, name string")
    found = ordered.current_value(data, visits, names, (4,), 13, "2024-06-30").first()
    assert found["current_value"] == "two"


def test_invalid_template_three_valued(spark):
    data = spark.createDataFrame(
        [(1, "Rk1Sx", b"Rk1Sy"), (2, "bad", None), (3, None, b"bad"), (4, "Rk1S", None), (5, None, None)],
        "id int, template string, new_template binary")
    assert [r["id"] for r in filters.invalid_template(data).orderBy("id").collect()] == [2, 3]


def test_capture_quality(spark):
    data = spark.createDataFrame(
        [(1, at("2024-01-01"), "L", 70), (1, at("2024-02-01"), "R", 90), (1, at("2024-01-01"), "T", None)],
        "patient_Id long, date_created timestamp_ntz, fingerPosition string, imageQuality int")
    row = summaries.capture_quality(data).first()
    assert (row["n_low"], row["n_not_low"], row["lowest_quality"], row["average_quality"]) == (1, 2, 70, 80)


def test_rollup_merges_shared_and_missing_numbers(spark):
    data = spark.createDataFrame(
        [("h", 2, 1, "a", None), ("h", 1, 2, "b", "z"), (None, 3, 3, None, "y"), (None, 4, 4, "d", "x")],
        "no string, id int, top int, low string, other string")
    once = summaries.rollup_by_identifier(data, "no", ["top"], ["low", "other", "id"], by="id")
    # What does not merge is of one row, also where that row has nothing.
    assert {tuple(r) for r in once.collect()} == {("h", 2, "b", "z", 1), (None, 4, None, "y", 3)}
    again = summaries.rollup_by_identifier(once, "no", ["top"], ["low", "other", "id"], by="id")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, once.collect()))


def test_lookup_unique_matches_missing_keys_and_rejects_repeats(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "uuid string, n int")
    right = spark.createDataFrame([("a", "x"), (None, "y")], "uuid string, v string")
    found = rows_of(lookups.lookup_unique(left, right, "uuid", ["v"]), "n")
    assert [r["v"] for r in found] == ["x", "y", None]
    twice = right.union(right.filter("uuid is null"))
    with pytest.raises(Exception, match="not unique"):
        lookups.lookup_unique(left, twice, "uuid", ["v"]).collect()


def test_drop_all_duplicates(spark):
    data = spark.createDataFrame([("k", 1), ("k", 2), ("m", 3), (None, 4)], "key string, n int")
    assert [r["n"] for r in rows_of(rows.drop_all_duplicates(data, "key"), "n")] == [3, 4]


def test_suffix_duplicates(spark):
    data = spark.createDataFrame([("k", 1), ("k", 2), ("m", 3)], "key string, n int")
    found = rows_of(rows.suffix_duplicates(data, "key", ["n"]), "n")
    assert [r["key"] for r in found] == ["k_A", "k_B", "m"]


def test_suffixes_run_out_after_the_alphabet(spark):
    data = spark.range(40).select(F.lit("k").alias("key"), "id").repartition(6)
    found = {r["id"]: r["key"] for r in rows.suffix_duplicates(data, "key", ["id"]).collect()}
    assert (found[0], found[25], found[26], found[39]) == ("k_A", "k_Z", None, None)
    assert len(found) == 40


def test_number_rows_is_dense_and_ordered(spark):
    data = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(7)
    found = rows.number_rows(data, ["k"]).collect()
    assert sorted((r["k"], r["row_number"]) for r in found) == [(i, i + 1) for i in range(5000)]


def test_number_rows_of_nothing(spark):
    assert rows.number_rows(spark.range(0), ["id"]).collect() == []


def test_tracked_in_window(spark):
    visits = spark.createDataFrame(
        [(1, 1, 13, at("2024-01-10"), 0), (2, 1, 13, at("2024-02-10"), 0), (3, 1, 13, at("2024-01-10"), 1),
         (4, 2, 27, at("2020-01-01"), 0), (5, 3, 13, at("2024-01-31 01:00"), 0)],
        "encounter_id long, patient_id long, form_id int, encounter_datetime timestamp_ntz, voided int")
    people = spark.createDataFrame([(2, 1, at("2024-01-15"), 0), (1, 0, None, 0)],
                                   "person_id long, dead int, death_date timestamp_ntz, voided int")
    found = filters.tracked_in_window(visits, people, "2024-01-01", "2024-01-31")
    assert sorted(r["encounter_id"] for r in found.collect()) == [1, 4]


def test_identifiers_parameters_and_facility(spark):
    patients = spark.createDataFrame([(1, 0), (2, 1)], "patient_id long, voided int")
    ids = spark.createDataFrame(
        [(1, "H2", 5, "u2", 0), (1, "H1", 5, "u1", 0), (1, "old", 4, "u3", 1), (2, "H9", 5, "u9", 0)],
        "patient_id long, identifier string, identifier_type int, uuid string, voided int")
    found = rows_of(lookups.attach_identifiers(patients, ids, uuid_of="PatientHospitalNo"), "patient_id")
    assert [(r["PatientHospitalNo"], r["PatientUniqueID"], r["uuid"]) for r in found] == [
        ("H1", None, "u1"), (None, None, None)]
    settings = spark.createDataFrame([("facility_datim_code", "X1")], "property string, property_value string")
    coded = lookups.attach_parameters(patients, settings, {"DatimCode": "facility_datim_code", "No": "none"})
    regions = spark.createDataFrame([("X1", "Kano", "Dala")], "datim_code string, state_name string, lga_name string")
    row = lookups.attach_facility(coded, regions).orderBy("patient_id").first()
    assert (row["DatimCode"], row["No"], row["State"], row["LGA"]) == ("X1", None, "Kano", "Dala")


def test_settings_per_facility(spark):
    rows_ = spark.createDataFrame([("f1", 1), ("f2", 2)], "site string, id int")
    settings = spark.createDataFrame(
        [("f1", "name", "One"), ("f2", "name", "Two"), ("f2", "other", "x")],
        "site string, property string, property_value string")
    found = rows_of(lookups.attach_parameters(rows_, settings, {"n": "name"}, site="site"), "id")
    assert [r["n"] for r in found] == ["One", "Two"]


def test_first_dates(spark):
    df = obs(spark, (1, 5, "2024-01-02", 1.0, "a"), (1, 5, "2024-03-01", 2.0, "b"),
             (1, 6, "2024-01-01", 3.0, "c"))
    row = latest.first_last_dates(df, (5,), "2024-06-30").first()
    assert (row["first_date"], row["last_date"]) == (at("2024-01-02"), at("2024-03-01"))
    coded = df.withColumn("value_coded", F.col("value_numeric").cast("int"))
    assert latest.first_date_in_codes(coded, (2, 3)).first()["first_date"] == day("2024-01-01")


def test_refills_at_and_before(spark):
    pick = spark.createDataFrame(
        [(1, 1, at("2024-01-01"), 0), (2, 1, at("2024-02-01"), 0), (3, 1, at("2024-03-01"), 0)],
        "obs_id long, person_id long, obs_datetime timestamp_ntz, voided int")
    groups = spark.createDataFrame(
        [(90, 1, at("2024-01-01"), 0), (20, 1, at("2024-02-01"), 1), (30, 1, at("2024-03-01"), 0)],
        "obs_id long, person_id long, obs_datetime timestamp_ntz, voided int")
    values = spark.createDataFrame([(90, 1, 9), (20, 1, 2)],
                                   "obs_group_id long, person_id long, child_value int")
    # The last inserted group counts, not the last dated one; soft-deleted ones take part.
    before = ordered.refill_before_latest(pick, groups, values, "2024-06-30").first()
    assert (before["group_id"], before["refill_days"]) == (90, 9)
    at_previous = ordered.refill_at_previous(pick, groups, values, "2024-06-30").first()
    assert (at_previous["group_id"], at_previous["refill_days"]) == (20, 2)
    uncapped = ordered.refill_before_latest(pick, groups, values, "2024-01-15", capped=False).first()
    assert uncapped["group_id"] == 90
    assert ordered.refill_before_latest(pick, groups, values, "2024-01-01").collect() == []


def test_suffix_duplicates_fails_on_ties(spark):
    data = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "key string, n int")
    with pytest.raises(Exception, match="order repeats within a key"):
        rows.suffix_duplicates(data, "key", ["n"]).collect()


def test_facility_columns_come_from_one_row(spark):
    mapping = spark.createDataFrame([("X", "Kano", "X1"), ("X", "Abia", "Z9")],
                                    "datim_code string, state_name string, lga_name string")
    found = lookups.attach_facility(spark.createDataFrame([("X",)], "DatimCode string"), mapping).first()
    assert (found.State, found.LGA) == ("Abia", "Z9")
