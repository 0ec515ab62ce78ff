"""The pipeline against brute force, stage by stage."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from test_llm_operators import contaminated_by_force, groups_by_force

from carelens.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_every_stage_keeps_the_right_rows(spark, tmp_path):
    docs, last = queries.read(spark, SF_DIR, "documents"), None
    labels = {r.doc_id: r.quality for r in queries.read(spark, SF_DIR, "labels").collect()}
    items = [(r.item_id, r.text) for r in queries.read(spark, SF_DIR, "benchmark").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        columns, docs = docs.columns, spark.read.parquet(f"{tmp_path}/{k}")
        after = [tuple(r) for r in docs.collect()]
        assert docs.columns[: len(columns)] == columns and (docs.columns == columns or k == 4)
        if k < 3:
            assert not Counter(after) - Counter(before)
        ids = {r[0] for r in after}
        if name == "quality classifier":
            assert sum(labels.get(r[0]) == 1 for r in before if r[0] not in ids) <= 3
            assert sum(labels.get(i) == 0 for i in ids) <= 3
        if name == "n-gram Jaccard join":
            kept = {c for (_, _, c) in groups_by_force(before, 5, 80)}
            assert ids == kept
        if name == "benchmark decontamination":
            found = contaminated_by_force([r[:2] for r in before], items)
            assert ids == {i for i, *_, bad in found if not bad}
        if name == "mixing sources":
            assert ids <= {r[0] for r in before} and abs(len(after) / len(before) - 1) < 0.5
        if name == "sharding":
            last = docs
            assert Counter(r[:5] for r in after) == Counter(before)
    sizes = Counter(r.shard for r in last.collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {"doc_id", "text", "shard", "slot"} <= set(rows[0].asDict())
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)


def test_null_and_repeated_ids_are_decided_row_by_row(spark):
    queries.ship(spark)
    item = next(r.text for r in queries.read(spark, SF_DIR, "benchmark").collect() if len(r.text.split()) >= 13)
    text = lambda k: " ".join(f"v{k}x{i}" for i in range(30))
    rows = [(1, text(1), "a"), (None, text(1), "b"), (None, text(2), "c"), (2, text(3), "d"), (2, text(1), "e"),
            (3, text(4), "f"), (3, text(4), "f"), (3, text(4), "g"), (None, text(5), "h"), (None, text(5), "i"),
            (None, item, "j"), (4, item, "k"), (4, text(6), "l"), (None, "", "m"), (None, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted(r.lang for r in kept.collect()) == ["a", "c", "d", "f", "h", "k", "l", "m", "n"]
    clean = corpus_pipeline.decontaminated(spark, docs, SF_DIR)
    assert clean.columns == docs.columns
    assert Counter(r.lang for r in clean.collect()) == Counter(r[2] for r in rows if r[1] != item)
