"""Ordered operators against plain Python on random rows full of ties."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from carelens.operators import latest, ordered, rows

END = dt.datetime(2024, 1, 8)
SCHEMA = ("obs_id long, person_id long, concept_id int, obs_datetime timestamp_ntz, "
          "value_numeric double, name string, value_datetime timestamp_ntz, voided int")


@pytest.fixture(scope="module", params=[1, 2])
def data(request):
    rng = random.Random(request.param)
    ids = rng.sample(range(10_000), 500)
    found = []
    for i in ids:
        instant = dt.datetime(2024, 1, rng.randint(1, 12), rng.choice([0, 0, 9]))
        found.append((i, rng.randint(1, 25), rng.randint(1, 3), instant,
                      rng.choice([None, float(rng.randint(1, 9))]), rng.choice([None, "a", "b", "c"]),
                      rng.choice([None, dt.datetime(2024, 2, rng.randint(1, 28))]), int(rng.random() < 0.15)))
    return found


@pytest.fixture(scope="module")
def obs(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def persons(data, live=True, capped=True):
    groups = {}
    for row in data:
        if (not live or row[7] == 0) and (not capped or row[3] <= END):
            groups.setdefault(row[1], []).append(row)
    return groups


def by_person(df, column):
    return {r["person_id"]: r[column] for r in df.collect()}


def test_previous_instants(data, obs):
    expected = {}
    for person, mine in persons(data).items():
        instants = sorted({r[3] for r in mine}, reverse=True)
        expected[person] = instants[1] if len(instants) > 1 else None
    assert by_person(ordered.previous_distinct_date(obs, "2024-01-08"), "previous_date") == expected


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_nth_latest(data, obs, n):
    expected = {}
    for person, mine in persons(data).items():
        instants = sorted((r[3] for r in mine), reverse=True)
        expected[person] = instants[n - 1] if len(instants) >= n else None
    assert by_person(ordered.nth_latest(obs, "2024-01-08", n), "nth_date") == expected


def test_previous_against_all_time(data, obs):
    expected = {}
    for person, mine in persons(data, capped=False).items():
        top = max(r[3] for r in mine)
        expected[person] = max((r[3] for r in mine if r[3] < top and r[3] <= END), default=None)
    assert by_person(ordered.previous_vs_global(obs, "2024-01-08"), "previous_date") == expected


def test_group_before_the_latest(data, obs, spark):
    bounds = {p: max(r[3] for r in mine) for p, mine in persons(data).items()}
    expected = {}
    for person, mine in persons(data, live=False, capped=False).items():
        ids = [r[0] for r in mine if person in bounds and r[3] < bounds[person]]
        if ids:
            expected[person] = max(ids)
    frame = spark.createDataFrame(list(bounds.items()), "person_id long, top timestamp_ntz")
    assert by_person(ordered.refill_before(obs, frame, "top"), "group_id") == expected


def largest_at(mine, concept, slot, pick=max):
    of = [r for r in mine if r[2] == concept]
    if not of:
        return None
    instant = pick(r[3] for r in of)
    return max((r[slot] for r in of if r[3] == instant and r[slot] is not None), default=None)


def test_pivot(data, obs):
    wide = latest.pivot_latest(obs, {
        "number": (1, "value_numeric"), "name": (2, "name"), "date": (3, "value_datetime"),
        "any": ((1, 3), "name")}, "2024-01-08")
    found = {r["person_id"]: (r["number"], r["name"], r["date"], r["any"]) for r in wide.collect()}
    expected = {}
    for person, mine in persons(data).items():
        names = [n for n in (largest_at(mine, c, 5) for c in (1, 3)) if n is not None]
        expected[person] = (largest_at(mine, 1, 4), largest_at(mine, 2, 5), largest_at(mine, 3, 6),
                            max(names, default=None))
    assert found == expected


def test_largest_first_answer(data, obs):
    found = by_person(latest.max_in_concepts(obs, (1, 2), "name", "2024-01-08", earliest=True), "value")
    expected = {}
    for person, mine in persons(data).items():
        if any(r[2] in (1, 2) for r in mine):
            names = [n for n in (largest_at(mine, c, 5, min) for c in (1, 2)) if n is not None]
            expected[person] = max(names, default=None)
    assert found == expected


def test_latest_and_earliest_rows(data, obs):
    for operator, pick in ((latest.latest_rows, max), (latest.earliest_rows, min)):
        expected = set()
        for mine in persons(data).values():
            for concept in (1, 2, 3):
                of = [r for r in mine if r[2] == concept]
                expected |= {r[0] for r in of if r[3] == pick(x[3] for x in of)}
        assert {r["obs_id"] for r in operator(obs, "2024-01-08").collect()} == expected


def test_latest_unbounded(data, obs):
    expected = {}
    for person, mine in persons(data, capped=False).items():
        of = [r[3] for r in mine if r[2] == 2]
        capped = [x for x in of if x <= END]
        if capped:
            expected[person] = max(of) if max(of) == max(capped) else None
    assert by_person(latest.latest_unbounded(obs, (2,), "2024-01-08"), "latest_date") == expected


def test_repeated_keys(data, obs):
    keys = [(str(r[1]), r[0]) for r in data]
    counts = {}
    for key, _ in keys:
        counts[key] = counts.get(key, 0) + 1
    keyed = obs.selectExpr("cast(person_id as string) as key", "obs_id")
    expected = {}
    for key in counts:
        for place, i in enumerate(sorted(i for k, i in keys if k == key)):
            expected[i] = key if counts[key] == 1 else f"{key}_{chr(65 + place)}" if place < 26 else None
    found = {r["obs_id"]: r["key"] for r in rows.suffix_duplicates(keyed, "key", ["obs_id"]).collect()}
    assert found == expected
    single = {r["obs_id"] for r in rows.drop_all_duplicates(keyed, "key").collect()}
    assert single == {i for k, i in keys if counts[k] == 1}
