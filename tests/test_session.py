from __future__ import annotations

from types import SimpleNamespace

from carelens.session import SETTINGS, cut_lineage, shared_folder


def pretended(folder=None):
    held = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "hdfs://x/warehouse"}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: held[key] or default))


def test_settings_are_applied(spark):
    assert {k: spark.conf.get(k) for k in SETTINGS} == SETTINGS


def test_the_cluster_names_the_shared_folder():
    assert shared_folder(pretended("hdfs://x/shared/")) == "hdfs://x/shared"


def test_without_it_tables_go_to_the_warehouse():
    assert shared_folder(pretended()) == "hdfs://x/warehouse/carelens-work"


def test_stored_rows_come_back_whole(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, 2.5)], "id int, `a b(c/d).` string, n double")
    back = cut_lineage(df)
    assert back.schema == df.schema
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    assert "parquet" in back._jdf.queryExecution().executedPlan().toString()
