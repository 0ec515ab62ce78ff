"""The corpus operators against brute force, on small tables with every odd row."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import oracle_check
import pytest
from pyspark.sql import functions as F

from carelens.llm import fingerprints, languages, quality, queries, sharding, substring_dedup, toxicity
from carelens.llm import token_counts as tc
from carelens.llm.decontaminate import PositionalIndex, contamination, uncontaminated
from carelens.llm.jaccard_join import JaccardJoin, Rule, near_duplicates, one_of_each
from carelens.llm.mixing import equal_weights, mix, poisson_law, repetition_rates

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.ship(spark)


def made(spark, rows):
    return spark.createDataFrame(
        [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows], SCHEMA)


def odd_rows():
    words = " ".join(f"w{k}" for k in range(3000))
    return [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", None), (4, "one", None, "a"),
            (5, words, "en", "b"), (6, words + " tail", "en", "b"), (6, words + " tail", "en", "b"),
            (None, "null id", "en", "a"), (7, "ONE", "de", "c"), (8, "é" * 40 + " 世界 \U0001F600", "fr", "a"),
            (9, "a" * 5000, "en", "a"), (10, "a a a " * 700, "en", "a")]


@pytest.fixture(scope="module")
def odd(spark):
    return made(spark, odd_rows())


@pytest.fixture(scope="module")
def empty(spark):
    return made(spark, [])


@pytest.fixture(scope="module")
def clashing(odd):
    for name in ("shard", "slot", "copy", "mix_key", "row", "id", "part", "key", "range", "words", "n", "u"):
        odd = odd.withColumn(name, odd.n_chars.cast("string"))
    return odd


# near duplicates

def shingles(text, n):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return set()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or {tuple(words)}


def groups_by_force(rows, n, percent):
    sets = [shingles(t, n) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return Counter((r[0], len(s), least.get(find(k)) if s else r[0]) for k, (r, s) in enumerate(zip(rows, sets)))


def edited_copies(seed):
    rng, rows = random.Random(seed), []
    for family in range(25):
        n = rng.choice([1, 2, 3, 6, 9, 12, 20, 40, 90, 300])
        base = [f"t{rng.randrange(40 if n < 10 else 4000)}" for _ in range(n)]
        for _ in range(rng.randrange(1, 9)):
            copy = base[:]
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, n // 30])):
                at = rng.randrange(len(copy))
                copy[at : at + rng.choice([0, 1])] = [f"x{rng.randrange(30)}"] * rng.choice([0, 1])
                copy = copy or ["x"]
            rows.append((len(rows) * 7 % 1009, " ".join(copy), "en", "s"))
    return rows


@pytest.mark.parametrize("rule", [(3, 90), (5, 80)])
@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, rule, seed):
    rows = edited_copies(seed) + odd_rows()
    found = near_duplicates(made(spark, rows), *rule).collect()
    assert Counter(map(tuple, found)) == groups_by_force(rows, *rule)


def test_every_link_is_found_when_asked_for(spark):
    rows = [r for r in edited_copies(3)]
    join = JaccardJoin(made(spark, rows), Rule(3, 90), all_links=True)
    distinct = list({frozenset(shingles(t, 3)) for _, t, *_ in rows})
    links = sum(100 * len(a & b) >= 90 * len(a | b) for k, a in enumerate(distinct) for b in distinct[:k])
    assert join.links.count() == links


def one_word_changed(copies, changes, seed):
    rng = random.Random(seed)
    base = [f"t{k}" for k in range(60)]
    rows = []
    for k in range(copies):
        words = base[:]
        for at in rng.sample(range(60), changes):
            words[at] = f"x{k}_{at}"
        rows.append((k + 10, " ".join(words), "en", "s"))
    return rows


@pytest.mark.parametrize("changes", [1, 2])
@pytest.mark.parametrize("rule", [(5, 80), (3, 90)])
def test_near_copies_that_do_not_all_link(spark, rule, changes, monkeypatch):
    monkeypatch.setattr("carelens.llm.jaccard_join.CROWD", 48)
    rows = one_word_changed(150, changes, 4) + edited_copies(5) + one_word_changed(70, 1, 6)[:60] * 2
    found = near_duplicates(made(spark, rows).repartition(3), *rule).collect()
    assert Counter(map(tuple, found)) == groups_by_force(rows, *rule)


@pytest.mark.parametrize("seed", [7, 8])
def test_crowds_of_any_size_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr("carelens.llm.jaccard_join.CROWD", 2)
    rows = edited_copies(seed) + odd_rows() + one_word_changed(40, 1, seed) + one_word_changed(30, 3, seed)
    for rule in ((3, 90), (5, 80), (2, 50), (1, 100)):
        found = near_duplicates(made(spark, rows), *rule).collect()
        assert Counter(map(tuple, found)) == groups_by_force(rows, *rule)


def test_pairs_grow_with_the_group_not_its_square(spark, monkeypatch):
    """Where the groups are crowds; smaller ones are compared pair by pair."""
    monkeypatch.setattr("carelens.llm.jaccard_join.CROWD", 48)
    seen = []
    for name in ("_counted", "_common_by_difference"):
        plain = getattr(JaccardJoin, name)
        monkeypatch.setattr(JaccardJoin, name, lambda self, pairs, *rest, plain=plain: (
            seen.append(pairs.count()), plain(self, pairs, *rest))[1])
    asked = []
    for copies in (200, 800):
        seen.clear()
        near_duplicates(made(spark, one_word_changed(copies, 1, 3)), 5, 80).count()
        asked.append(sum(seen))
    assert asked[1] < 6 * asked[0] < 6 * 200 * 20


def test_segments_of_repeated_rows_stand_once(spark):
    rows = [(None, "a b c d e f g h i j k l", "", "")] * 50 + [(None, "a b c d e f g h i j k l m", "", "")] * 50
    join = JaccardJoin(made(spark, rows), Rule(3, 80))
    pairs = join.classes.select(F.min("class_id").alias("a"), F.max("class_id").alias("b"))
    assert join._segments(pairs).count() == 2


def test_one_of_each_keeps_clashing_and_unorderable_columns(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "other words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({
        "row_key": F.lit("mine"), "a b.c": F.lit(1), "held": F.create_map(F.lit("k"), F.col("doc_id"))})
    found = one_of_each(docs)
    assert found.columns == docs.columns
    assert sorted((r.doc_id, r.row_key, r.held["k"]) for r in found.collect()) == [(1, "mine", 1), (3, "mine", 3)]


def test_long_sets_are_counted_in_several_fragments(spark):
    words = [f"w{k}" for k in range(9000)]
    rows = [(1, " ".join(words), "", ""), (2, " ".join(words[:8800]), "", ""), (3, " ".join(words[:4000]), "", "")]
    found = {r.doc_id: r.component_id for r in near_duplicates(made(spark, rows), 3, 90).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


# fingerprints

def test_fingerprints_and_edited_texts(spark, odd):
    rows = sorted(((i if i is not None else -1, t or "") for i, t, *_ in odd_rows()))
    found = sorted(map(tuple, fingerprints.compare_with_next(odd).collect()), key=lambda r: (
        -1 if r[0] is None else r[0], r[2]))
    expected = []
    for k, (i, t) in enumerate(rows):
        new = fingerprints.edited(t, rows[(k + 1) % len(rows)][1])
        expected.append((None if i == -1 else i, len(t), hashlib.sha256(new.encode()).hexdigest()))
    assert Counter(r[:3] for r in found) == Counter(expected)
    prints = {t: fingerprints.of_texts([t])[0].hex() for _, t in rows}
    by_id = {i: prints[t] for i, t in rows}
    assert all(r[3] == by_id[-1 if r[0] is None else r[0]] for r in found)
    assert all(0 <= r[5] <= 1 and 0 <= r[6] <= 1 for r in found)


def test_the_next_document_is_found_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_LEAST", 7)
    rows = [(k * 3, f"text {k} " * (k % 5 + 1), "en", "s") for k in random.Random(5).sample(range(400), 150)]
    found = {r.doc_id: r.edited_sha256 for r in fingerprints.compare_with_next(made(spark, rows)).collect()}
    ordered = sorted(rows)
    assert found == {
        a[0]: hashlib.sha256(fingerprints.edited(a[1], b[1]).encode()).hexdigest()
        for a, b in zip(ordered, ordered[1:] + ordered[:1])}


def test_equal_substrings_share_phrases_at_any_offset():
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(500))
    same, moved, other = fingerprints.of_texts([text, "zz" + text, text[::-1]])
    assert fingerprints.likeness(same, same) == 1.0
    assert fingerprints.likeness(same, moved) > 0.9
    assert fingerprints.likeness(same, other) < 0.1


def test_no_documents_have_no_fingerprints(empty):
    assert fingerprints.compare_with_next(empty).count() == 0


# languages

def test_language_on_held_out_documents(spark):
    docs = {r.doc_id: r.lang for r in queries.read(spark, MIDDLE, "documents").collect()}
    rows = [r for r in queries.op3_language_id(spark, MIDDLE).collect() if r.held_out]
    assert sum(docs[r.doc_id] == r.lang_pred for r in rows) >= 0.97 * len(rows) > 100


def test_odd_texts_have_a_language_or_none(odd, empty):
    model = languages.fit(languages.language_counts(odd))
    found = {(r.doc_id, r.lang_pred, r.score) for r in languages.identify(odd, model).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)} <= found
    assert {r.lang_pred for r in languages.identify(odd, languages.fit(languages.language_counts(empty))).collect()} \
        == {"und"}


def test_a_mixture_shows_both_languages(spark):
    rng = random.Random(2)
    speak = lambda letters, n: " ".join("".join(rng.choices(letters, k=6)) for _ in range(n))
    train = made(spark, [(1, speak("abcde", 400), "x", ""), (2, speak("vwxyz", 400), "y", "")])
    model = languages.fit(languages.language_counts(train))
    mixed = made(spark, [(3, speak("abcde", 70) + " " + speak("vwxyz", 30), None, ""), (4, speak("abcde", 50), None, "")])
    found = {r.doc_id: r.mixture for r in languages.identify(mixed, model).collect()}
    assert found[3]["x"] == pytest.approx(0.7, abs=0.05) and set(found[4]) == {"x"}


def best_set(likely, count, penalty):
    """The best penalised likelihood over every set of languages, and its proportions."""
    best, many = (-np.inf, None), likely.shape[1]
    cost = penalty * np.log(max(count.sum(), 2)) / 2
    for size in range(1, many + 1):
        for chosen in itertools.combinations(range(many), size):
            own, share = likely[:, chosen], np.full(size, 1 / size)
            for _ in range(400 if size > 1 else 0):
                share = share * ((own / (own @ share)[:, None]) * count[:, None]).sum(axis=0) / count.sum()
            value = (count * np.log(own @ share)).sum() - (size - 1) * cost
            if value > best[0]:
                whole = np.zeros(many)
                whole[list(chosen)] = share
                best = value, whole
    return best


@pytest.mark.parametrize("many", range(2, 7))
def test_the_set_of_languages_is_the_best_of_all(many):
    """Related languages, mixtures of one to all of them, a second one at 5 %."""
    rng = np.random.default_rng(many)
    buckets = 300
    common = rng.dirichlet(np.ones(buckets))
    likely = np.stack([0.5 * common + 0.5 * rng.dirichlet(np.full(buckets, 0.3)) for _ in range(many)], axis=1)
    mixtures = [np.eye(many)[0], 0.95 * np.eye(many)[0] + 0.05 * np.eye(many)[1], np.full(many, 1 / many),
                *rng.dirichlet(np.full(many, 0.4), 4)]
    counts = [rng.multinomial(n, likely @ m) for m in mixtures for n in (1, 60, 1_500)]
    row, bucket = np.nonzero(np.array(counts))
    model = languages.LanguageModel([str(k) for k in range(many)], likely)
    found = model.infer(row, bucket, np.array(counts)[row, bucket], len(counts))
    for share, count in zip(found, counts, strict=True):
        at = np.flatnonzero(count)
        value, whole = best_set(likely[at], count[at], languages.PENALTY)
        cost = (np.count_nonzero(share) - 1) * languages.PENALTY * np.log(max(count.sum(), 2)) / 2
        reached = (count[at] * np.log(likely[at] @ share)).sum() - cost
        assert share.sum() == pytest.approx(1) and reached >= value - 2 * languages.TOLERANCE


def test_six_languages_of_one_text_are_all_in_its_mixture(spark):
    rng = random.Random(6)
    alphabets = [chr(97 + 4 * k) + chr(98 + 4 * k) + chr(99 + 4 * k) + chr(100 + 4 * k) for k in range(6)]
    speak = lambda letters, n: " ".join("".join(rng.choices(letters, k=6)) for _ in range(n))
    train = made(spark, [(k, speak(a, 400), str(k), "") for k, a in enumerate(alphabets)])
    model = languages.fit(languages.language_counts(train))
    (row,) = languages.identify(made(spark, [(9, " ".join(speak(a, 60) for a in alphabets), None, "")]), model).collect()
    assert set(row.mixture) == set("012345") and all(v == pytest.approx(1 / 6, abs=0.01) for v in row.mixture.values())


# token counts

@pytest.fixture(scope="module")
def database():
    return oracle_check.database(SMALL)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, database, name):
    assert oracle_check.differences(spark, database, queries.QUERIES[name], queries.ORACLE[name], SMALL) is None


def test_a_batch_counts_once_and_a_broken_one_is_written_again(spark, odd, tmp_path):
    counted = tc.count_documents(odd, {"words": tc.pattern_counter(queries.WORDS)})
    rollup = tc.Rollup(spark, str(tmp_path))
    left = Path(tmp_path) / "batch=one"
    left.mkdir()
    (left / "part-0.parquet").write_text("what a lost driver left")
    assert rollup.commit("one", tc.inserts(counted)) and not rollup.commit("one", tc.inserts(counted))
    assert rollup.commit("two", tc.deletes(counted.where("doc_id = 5")))
    total = lambda names: sum(r.tokens for r in rollup.totals(names).collect())
    every = sum(len((t or "").split()) for _, t, *_ in odd_rows())
    assert total(["one"]) == every and total(["one", "two", "two", "three"]) == every - 3000
    assert rollup.compact(["one", "two"], "both") and total(["both"]) == every - 3000
    assert rollup.totals(["none"]).count() == 0
    assert {r.docs for r in rollup.totals(["both"]).collect() if r.source is None} == {1}


def test_tokens_of_a_vocabulary_file(odd):
    import tiktoken

    pattern = r"""'s|'t| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    found = tc.vocabulary_counter(VOCABULARY, pattern)(odd).collect()
    assert all(r.tokens == (len(own.encode_ordinary(r.text)) if r.text else 0) for r in found)


# mixing

def test_copies_follow_the_target_weights(spark):
    docs = made(spark, [(k, "x" * 10, "en", "big" if k % 10 else None) for k in range(20_000)])
    weights = spark.createDataFrame([("big", 1.0), (None, 3.0)], "source string, weight double")
    rates = {r.source: r.rate for r in repetition_rates(docs, weights).collect()}
    assert rates["big"] == pytest.approx(0.25 / 0.9) and rates[None] == pytest.approx(7.5)
    mixed = mix(docs, weights)
    by = Counter(r.source for r in mixed.select("source").collect())
    assert by["big"] == pytest.approx(5_000, rel=0.06) and by[None] == pytest.approx(15_000, rel=0.03)
    assert Counter(map(tuple, mixed.collect())) == Counter(map(tuple, mix(docs, weights).collect()))


@pytest.mark.parametrize("rate", [0.3, 15.0, 25.0, 4_000.0, 500_000.0])
def test_the_poisson_law_is_that_of_the_rate(spark, rate):
    row = poisson_law(spark.createDataFrame([("a", rate)], "source string, rate double")).first()
    total = 0.0
    for k, upto in enumerate(row.upto, row["first"]):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        assert upto == pytest.approx(total, abs=1e-7)
    assert row.upto[-1] == pytest.approx(1, abs=1e-9) and len(row.upto) < 24 * math.sqrt(rate) + 130


def test_a_small_source_is_repeated_very_often(spark):
    docs = made(spark, [(1, "x", "en", "small"), *((k, "y" * 50_000, "en", "big") for k in range(2, 6))])
    got = Counter(r.doc_id for r in mix(docs, equal_weights(docs)).select("doc_id").collect())
    assert got[1] == pytest.approx(100_000, abs=6 * 317)


def test_rows_without_id_draw_apart_and_rows_of_one_id_are_spread(spark):
    docs = made(spark, [(None if k % 2 else 7, f"text {k}", "en", "a") for k in range(4_000)])
    mixed = mix(docs, equal_weights(docs)).cache()
    nameless = mixed.where("doc_id is null")
    assert nameless.select("mix_key").distinct().count() == nameless.count() == pytest.approx(2_000, abs=250)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = mix(docs, equal_weights(docs)).where("doc_id = 7").groupBy(F.spark_partition_id()).count().collect()
        assert not parts or len(parts) == 2 and min(p["count"] for p in parts) > 0.4 * sum(p["count"] for p in parts)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert Counter(map(tuple, mixed.collect())) == Counter(map(tuple, mix(docs, equal_weights(docs)).collect()))


def test_mixing_odd_rows(spark, clashing, empty):
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("zz", 5.0)], "source string, weight double")
    mixed = mix(clashing, weights)
    assert {r.source for r in mixed.collect()} <= {"a", "b"}
    assert mixed.columns == [c for c in clashing.columns if c not in ("copy", "mix_key")] + ["copy", "mix_key"]
    assert mix(empty, weights).count() == 0
    assert mix(clashing, weights.where("false")).count() == 0


# repeated passages

def passage(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(n))


def test_repeated_passages_are_found_and_short_ones_left(spark):
    long, short = passage(1, 60), passage(2, 40)
    rows = [(1, passage(3, 200) + "\n" + long + "\n" + passage(4, 100), "", ""),
            (2, long + " " + passage(5, 300), "", ""), (3, passage(6, 90) + " " + long, "", ""),
            (4, passage(7, 80) + " " + short + " " + passage(8, 9), "", ""),
            (5, short + " " + passage(9, 200), "", ""), (6, passage(10, 400), "", "")]
    found = substring_dedup.repeated_passages(made(spark, rows)).collect()
    assert {(r.doc_id, r.passage, r.first) for r in found} == {(1, long, True), (2, long, False), (3, long, False)}
    rest = {r.doc_id: r.text for r in substring_dedup.remove_repeats(
        made(spark, rows), substring_dedup.repeated_passages(made(spark, rows))).collect()}
    assert rest[1] == rows[0][1] and rest[2] == rows[1][1].replace(long, "") and rest[6] == rows[5][1]


def test_a_copy_stays_where_a_smaller_id_has_a_part_of_it(spark):
    shared, other = passage(31, 120), passage(32, 90)
    part = " ".join(shared.split()[40:65])
    rows = [(3, passage(33, 80) + " " + part + " " + passage(34, 80), "", ""),
            (10, passage(35, 70) + " " + shared + " " + passage(36, 50), "", ""),
            (11, shared + " " + passage(37, 60), "", ""),
            (12, passage(38, 60) + " " + other, "", ""), (13, passage(39, 60) + " " + other + " " + shared, "", "")]
    docs = made(spark, rows)
    found = substring_dedup.repeated_passages(docs)
    assert {(r.doc_id, r.first) for r in found.collect() if shared in r.passage} == {
        (10, True), (11, False), (13, False)}
    rest = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs, found).collect()}
    assert all(rest[k] == t for k, t, *_ in rows if k in (3, 10, 12))
    assert rest[11] == " " + passage(37, 60) and len(rest[13].split()) < 70


def test_odd_rows_have_the_passages_they_share(odd, empty):
    found = substring_dedup.repeated_passages(odd).collect()
    assert {(r.doc_id, r.n_words) for r in found} == {(5, 3000), (6, 3000)}
    assert substring_dedup.repeated_passages(empty).count() == 0


def test_chunks_cover_the_text_and_resist_insertions():
    import numpy as np
    import pyarrow as pa

    from carelens.llm import kernels as K

    text = passage(11, 3000)
    sets = []
    for t in (text, "inserted " + text, ""):
        block = next(K.blocks(pa.array([t])))
        row, begin, end, digest = substring_dedup.chunks(block)
        assert not t or (begin[0] == 0 and end[-1] == len(t) and (begin[1:] == end[:-1]).all())
        assert (np.diff(np.append(begin, len(t))) <= substring_dedup.MOST).all()
        sets.append(set(digest.tolist()))
    assert len(sets[0] & sets[1]) > 0.98 * len(sets[0])


# classifiers

def rate(rows, truth):
    rows = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    return sum(a == b for a, b in rows) / len(rows)


def test_quality_on_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in queries.read(spark, MIDDLE, "labels").collect()}
    assert rate(queries.op7_quality_classifier(spark, MIDDLE).collect(), truth) > 0.95


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in queries.read(spark, sf_dir, "labels").collect()}
    rows = queries.op8_toxicity(spark, sf_dir).collect()
    assert rate(rows, truth) > 0.94
    flagged = [truth[r.doc_id] for r in rows if r.predicted and r.held_out and r.doc_id in truth]
    assert sum(flagged) > 0.9 * len(flagged) > 50


def test_odd_rows_and_no_labels_have_scores(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (99, 1, 1), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    measured = quality.measure(odd)
    for own in (labels, labels.where("false")):
        model = quality.fit(quality.labelled(measured, own))
        scores = [r.score for r in quality.scored(measured, model).collect()]
        assert len(scores) == 12 and all(0 <= s <= 1 for s in scores)
        assert quality.keep_good(odd, model, 0.0).count() == 12
        weights = toxicity.train(toxicity.sample(odd, own))
        assert all(0 <= r.score <= 1 for r in toxicity.scored(odd, weights).collect())
    assert quality.measure(empty).count() == 0


def test_isotonic_levels_rise():
    import numpy as np

    x, _, mean = quality.isotonic(np.arange(6.0), np.ones(6), np.array([0, 1, 0, 1, 1, 0.0]))
    assert (np.diff(mean) > 0).all() and (np.diff(x) > 0).all()


# decontamination

def contaminated_by_force(docs, items):
    words = lambda t: re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(13, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(own[k : k + size])]
        out.append((i, len(own), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(own)))
    return Counter(out)


def test_contamination_equals_brute_force(spark, odd):
    benchmark = queries.read(spark, SMALL, "benchmark")
    docs = queries.read(spark, SMALL, "documents")
    few = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (3, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"),
                                 (4, "a a a"), (5, "世界"), (6, "w2990 w2991 w2992 w2993 w2994 w2995 w2996 w2997 w2998 "
                                 "w2999 tail more words"), (None, "null id")], "item_id long, text string")
    for d, b in ((docs, benchmark), (odd, few), (odd, few.where("false")), (odd.where("false"), few)):
        found = contamination(d, b).collect()
        expected = contaminated_by_force([(r.doc_id, r.text) for r in d.collect()],
                                         [(r.item_id, r.text) for r in b.collect() if r.item_id is not None])
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found
                       if r.doc_id is not None) == Counter({k: v for k, v in expected.items() if k[0] is not None})


def test_clashing_columns_stay_as_they_are(spark):
    text = " ".join(f"w{k}" for k in range(20))
    docs = made(spark, [(1, text, "en", "a"), (2, "clean words", "en", "a")]).withColumns(
        {"row_key": F.lit("own"), "digest": F.lit(5), "a.b": F.lit("dot"), "tags": F.create_map(F.lit("x"), F.lit(1))})
    items = spark.createDataFrame([("i", text)], "item_id string, text string")
    (row,) = uncontaminated(docs, items).collect()
    assert (row.doc_id, row.row_key, row.digest, row["a.b"], row.tags) == (2, "own", 5, "dot", {"x": 1})


def test_items_without_id_contaminate(spark):
    docs = made(spark, [(1, "one two three", "", ""), (None, "one two", "", ""), (2, "three", "", ""), (3, None, "", "")])
    items = spark.createDataFrame([(None, "one two"), (5, "three"), (None, None)], "item_id long, text string")
    found = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated)
                    for r in contamination(docs, items).collect())
    assert found == Counter([(1, 3, 3, ("5",), True), (None, 2, 2, (), True), (2, 1, 1, ("5",), True), (3, 0, 0, (), False)])


def test_a_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    docs, benchmark = (queries.read(spark, SMALL, t) for t in ("documents", "benchmark"))
    whole = Counter(map(str, contamination(docs, benchmark).collect()))
    monkeypatch.setattr("carelens.llm.decontaminate.BLOCK_WORDS", 400)
    assert Counter(map(str, contamination(docs, benchmark).collect())) == whole


def test_rare_terms_near_each_other(spark):
    docs = made(spark, [(1, "alpha x beta y gamma z", "", ""), (2, "gamma beta alpha", "", ""),
                        (3, "alpha " + "x " * 50 + "beta gamma", "", "")])
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    index = PositionalIndex(docs, items, window=1, seeds=1)
    assert {(r.doc_id, r.item) for r in index.proximity(terms=3, within=6).collect()} == {(1, "7"), (2, "7")}


def near_places(index, terms, within):
    """The same by brute force over the stored postings: every window, every place of its rarest term."""
    postings, seeds = {}, {}
    for r in index.postings.collect():
        postings.setdefault(r.term, set()).add((r.doc_id, r.digest, r.position))
    for r in index.seeds.collect():
        seeds.setdefault(r.item_row, {})[r.place] = r.term
    found = set()
    for item in index.items.collect():
        span = max(index.window, terms)
        for begin in range(max(1, len(item.words) - span + 1)):
            own = {t for place, t in seeds[item.item_row].items() if begin <= place < begin + span}
            ranked = sorted(own, key=lambda t: (len(postings.get(t, ())), t))[:terms]
            for doc, digest, at in postings.get(ranked[0], ()):
                near = [[p for d, g, p in postings.get(t, ()) if (d, g) == (doc, digest) and abs(p - at) < within]
                        for t in ranked]
                if all(near):
                    places = list(itertools.chain(*near))
                    found.add((doc, digest, item.item, at, min(places), max(places)))
    return Counter((doc, item, first, last) for doc, _, item, _, first, last in found)


def test_near_terms_of_long_items_equal_brute_force(spark):
    rng = random.Random(5)
    said = [f"w{k}" for k in range(60)]
    long_items = [[rng.choice(said) for _ in range(n)] for n in (45, 80, 13, 4)] + [["rep"] * 30]
    texts = [[rng.choice(said) for _ in range(rng.choice((5, 40, 300)))] for _ in range(25)]
    texts += [item[:] for item in long_items] + [["rep"] * 200]
    mixed = long_items[1][20:33]
    rng.shuffle(mixed)
    texts.append(["x"] * 30 + mixed + ["y"] * 30)
    rows = [(k, " ".join(t), "", "") for k, t in enumerate(texts)]
    docs = made(spark, rows + [rows[3], (None, "w1 w2", "", ""), (None, " ".join(long_items[0]), "", ""), (99, None, "", ""),
                               (98, "", "", "")])
    items = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(long_items)] + [(None, "w5 w6"), (77, None), (78, "!")],
                                  "item_id long, text string")
    index = PositionalIndex(docs, items)
    exact = {(r.doc_id, i) for r in index.report().collect() for i in r["items"]}
    assert len(exact) >= 6
    for terms, within in ((2, 5), (3, 20)):
        found = index.proximity(terms, within).collect()
        assert Counter((r.doc_id, r.item, r["first"], r["last"]) for r in found) == near_places(index, terms, within)
    matched = {(r.doc_id, r.item) for r in found}
    assert exact <= matched                  # an exact window is a near match, in long items too
    assert (len(texts) - 1, "1") in matched  # so are its words in another order


def test_near_places_of_a_repeated_word_grow_with_the_text(spark):
    items = spark.createDataFrame([(1, "a b " * 20)], "item_id long, text string")
    docs = made(spark, [(1, "a b " * 500, "", ""), (2, "a b " * 1000, "", "")])
    found = Counter(r.doc_id for r in PositionalIndex(docs, items).proximity().collect())
    assert 0 < found[1] <= 1000 and found[1] < found[2] <= 2 * found[1] + 4


# sharding

@pytest.mark.parametrize("rows, shards", [(0, 3), (1, 16), (1000, 16), (1003, 7)])
def test_shards_have_exact_sizes_and_gapless_slots(spark, rows, shards):
    docs = made(spark, [(k // 2, f"t{k % 5}", "en", "s") for k in range(rows)])
    found = sharding.shard(docs, shards).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r.doc_id, r.text) for r in docs.collect())
    sizes = Counter(r.shard for r in found)
    assert sorted(sizes.values()) == sorted(n for n in sharding.exact_sizes(rows, shards) if n)
    for k, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == k) == list(range(n))


def test_copies_of_a_row_spread_over_shards(spark):
    rows = [(1, "copy", "en", "s")] * 800 + [(None, None, "en", "s")] * 400 + [(k, f"t{k}", "en", "s") for k in range(2, 1202)]
    docs = made(spark, rows).repartition(5)
    first, again = (Counter((r.doc_id, r.text, r.shard, r.slot) for r in sharding.shard(d, 8).collect())
                    for d in (docs, docs.coalesce(2)))
    assert first == again and sum(first.values()) == len(rows)
    for of, n in ((1, 800), (None, 400)):
        by = Counter(s for i, _, s, _ in first if i == of)
        assert len(by) == 8 and max(by.values()) < 1.5 * n / 8
        slots = sorted(slot for i, _, s, slot in first if i == of and s == 0)
        assert slots[-1] - slots[0] > 200 and len(slots) < 0.7 * (slots[-1] - slots[0])


def test_the_matrix_has_the_law_of_a_shuffle():
    given, taken = [5, 9, 2], [4, 4, 8]
    seen = Counter()
    for seed in range(3000):
        matrix = sharding.communication_matrix(given, taken, seed)
        assert [sum(r) for r in matrix] == given and [sum(c) for c in zip(*matrix)] == taken
        seen[matrix[0][0]] += 1
    balls, law = [0] * 4 + [1] * 12, Counter()
    rng = random.Random(9)
    for _ in range(3000):
        law[rng.sample(balls, 5).count(0)] += 1
    assert all(abs(seen[k] - law[k]) < 200 for k in range(5))


def test_odd_rows_keep_their_columns(clashing):
    found = sharding.shard(clashing, 4)
    assert found.columns == [c for c in clashing.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert found.count() == 12
