from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from carelens.session import tune  # noqa: E402
from carelens.sources import SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "1")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(shared / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows_of(df, *order):
    """Rows as dictionaries, in the order of some columns."""
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: repr([r[c] for c in order])) if order else rows


def table(spark, name, rows, site=None):
    schema = (f"{site} string, " if site else "") + SCHEMAS[name]
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


class Clinic:
    """A small clinical record, built row by row."""

    def __init__(self, spark, site=None):
        self.spark, self.site = spark, site
        self.rows = {name: [] for name in SCHEMAS}
        self.next_obs = 0

    def add(self, name, /, **values):
        for optional in ("voided",):
            if optional in SCHEMAS[name]:
                values.setdefault(optional, 0)
        self.rows[name].append(values)
        return values

    def patient(self, pid, hospital=None, voided=0, **person):
        extra = {self.site: person.pop(self.site)} if self.site else {}
        self.add("patient", patient_id=pid, voided=voided, **extra)
        self.add("person", person_id=pid, **{"gender": "F", "birthdate": day("1980-01-01"),
                                            "dead": 0, **person}, **extra)
        if hospital is not None:
            self.add("patient_identifier", patient_id=pid, identifier=hospital, identifier_type=5,
                     uuid=f"uuid-{pid}", **extra)

    def encounter(self, eid, pid, when, form=27, kind=13, **other):
        self.add("encounter", encounter_id=eid, patient_id=pid, form_id=form, encounter_type=kind,
                 encounter_datetime=at(when), date_created=at(when), **other)

    def obs(self, pid, concept, when, number=None, coded=None, instant=None, text=None,
            encounter=None, group=None, voided=0, **other):
        self.next_obs += 1
        self.add("obs", obs_id=other.pop("obs_id", self.next_obs), person_id=pid, concept_id=concept,
                 obs_datetime=at(when), value_numeric=number, value_coded=coded,
                 value_datetime=at(instant) if instant else None, value_text=text,
                 encounter_id=encounter, obs_group_id=group, voided=voided, **other)
        return self.next_obs

    def pickup(self, pid, when, days, encounter=None, form=27, **other):
        """A pharmacy visit: pickup, refill group and its child."""
        if encounter is None:
            encounter = 1000 * pid + len(self.rows["encounter"])
            self.encounter(encounter, pid, when, form, **other)
        self.obs(pid, 165708, when, encounter=encounter, **other)
        group = self.obs(pid, 162240, when, encounter=encounter, **other)
        if days is not None:
            self.obs(pid, 159368, when, number=float(days), group=group, encounter=encounter, **other)
        return group

    def name(self, concept, name, locale="en", preferred=1):
        self.add("concept_name", concept_id=concept, name=name, locale=locale,
                 locale_preferred=preferred)

    def tables(self):
        return {n: table(self.spark, n, r, self.site) for n, r in self.rows.items()}


@pytest.fixture
def clinic(spark):
    return Clinic(spark)
