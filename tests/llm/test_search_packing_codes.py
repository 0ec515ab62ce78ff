"""Lexical search, packing and vector codes against brute force, with every odd row."""

from __future__ import annotations

import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from carelens.llm import lexical_search, packing, queries, vector_codes
from carelens.llm.lexical_search import LexicalSearch
from carelens.llm.packing import Encoder, Limits, Packing, best_fit
from carelens.llm.vector_codes import Slices, VectorCodes

DOCS, ITEMS = "doc_id long, text string", "item_id string, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.ship(spark)


# lexical search

def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked_by_force(docs, items, top):
    words = [(i, terms_of(t)) for i, t in docs]
    n_docs = sum(bool(w) for _, w in words)
    total = sum(len(w) for _, w in words)
    frequency = Counter(t for _, w in words for t in set(w))
    out = Counter()
    for item, text in items:
        scored = []
        for i, w in words:
            tf, m = Counter(w), 100 - 50 + ((50 * len(w) * n_docs) // total if total else 0)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1)))
                        * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in set(terms_of(text)) if tf[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, nameless, i) in enumerate(sorted(scored)[:top], 1):
            out[item, rank, None if nameless else i, -score] += 1
    return out


def zipf_texts(seed, rows, words):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    weights = [1 / (k + 1) for k in range(300)]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, words))) for _ in range(rows)]


ODD_DOCS = [(900, None), (901, ""), (902, " .,;\t"), (903, "W1 w1-W1\x00w2"), (None, "w5 w6 w7"), (903, "w9"),
            (904, "w250 " * 3000), (905, "é世界 w3"), (906, "w40 w41"), (907, "w40 w41"), (907, "w40 w41")]
ODD_ITEMS = [("none", None), ("empty", " . "), (None, "w5 w6 W7 w7"), ("same", "w40 w41"), ("same", "w40 w41"),
             ("strange", "nothing of this"), ("é", "世界 é世界 w3")]


@pytest.mark.parametrize("seed, top", [(1, 50), (2, 3), (3, 10)])
def test_search_equals_scoring_everything(spark, seed, top, monkeypatch):
    monkeypatch.setattr(lexical_search, "SAMPLE_ROWS", 60)
    docs = list(enumerate(zipf_texts(seed, 700, 40))) + ODD_DOCS
    items = [(f"i{k}", t) for k, t in enumerate(zipf_texts(seed + 10, 40, 25))] + ODD_ITEMS
    search = LexicalSearch(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), top)
    found = Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in search.ranked().collect())
    assert found == ranked_by_force(docs, items, top)


def test_search_in_blocks_of_items_and_postings(spark, monkeypatch):
    docs = list(enumerate(zipf_texts(5, 200, 30)))
    items = [(f"i{k}", t) for k, t in enumerate(zipf_texts(6, 12, 25))]
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 40)
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", 100)
    search = LexicalSearch(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 5)
    found = Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in search.ranked().collect())
    assert found == ranked_by_force(docs, items, 5)


@pytest.mark.parametrize("docs, items", [([], ODD_ITEMS), (ODD_DOCS, []), ([(1, None)], [("a", None)])])
def test_search_of_empty_tables(spark, docs, items):
    search = LexicalSearch(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    found = Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in search.ranked().collect())
    assert found == ranked_by_force(docs, items, 50)


def test_pair_bounds_leave_fewer_candidates():
    """Two terms that are never together add no more than the greater one."""
    terms = np.arange(6)
    known = lexical_search.Bounds([terms], np.ones(6, np.int64), {(a, b): k for k, (a, b) in enumerate(
        (a, b) for a in range(6) for b in range(a + 1, 6))}, [list(range(6))], 10, 100,
        np.full(6, 10), np.zeros(15, np.int64))
    single = lexical_search.Bounds([terms], known.weight, {}, [[]], 10, 100, known.term, np.zeros(0, np.int64))
    assert len(lexical_search.Choice(terms, list(range(6)), known, 31).essential) \
        < len(lexical_search.Choice(terms, [], single, 31).essential)


# packing

@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(VOCABULARY)
    plain.encode_special_tokens = True
    return plain


ODD_TEXTS = ["", None, "one", "a  b   c\n\nd \t e ", " x", "x ", "a\xa0b 　c  世界 é ñ \U0001F600",
             "it's we'll  'tis don't", "x <|endoftext|> y", "a" * 30_000, " " * 3000 + "x", "word " * 6000,
             "\x85 a \x1c b", "Ⅷ ² ½", "same text", "same text"]


def ids_of(plain, text):
    return [*plain.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("limits", [
    Limits(64), Limits(64, documents=3), Limits(64, attention=900), Limits(2048),
    Limits(64, documents=4, attention=2000, rule="dot", weights=(1.0, 0.5, 0.5))])
def test_packing_keeps_every_token_and_every_capacity(spark, plain, limits):
    rng = random.Random(3)
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "no id"), (3, "id again")] + [
        (1000 + k, " ".join(rng.choice(["alpha", "the", "of", "naïve", "x1"]) for _ in range(rng.randrange(60))))
        for k in range(300)]
    packed = Packing(spark.createDataFrame(rows, DOCS).repartition(3), VOCABULARY, limits, with_ids=True)
    found = packed.places().collect()
    whole, longest = Counter(), limits.longest()
    for i, t in rows:
        ids = ids_of(plain, t)
        cuts = [0, *range((len(ids) - 1) % longest + 1, len(ids), longest), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            whole[i, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), tuple(ids[a:b])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in found) == whole
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= limits.tokens
        assert limits.documents is None or len(own) <= limits.documents
        assert limits.attention is None or sum(n * n for _, n in own) <= limits.attention
    assert len(by) == packed.plan.sequences
    texts = {r.sequence_id: r.ids for r in packed.sequences().collect()}
    assert sum(len(t) for t in texts.values()) == sum(r.length for r in found)


def best_fit_one_by_one(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(left) if room >= n]
        if fits:
            left[min(fits, key=lambda k: left[k])] -= n
        else:
            left.append(capacity - n)
    return len(left)


def test_classes_fill_as_many_sequences_as_best_fit_one_by_one():
    rng = np.random.default_rng(5)
    for seed in range(20):
        lengths = np.minimum(rng.lognormal(3, 1, 400).astype(int) + 1, 100).tolist()
        plan = best_fit(dict(Counter(lengths)), Limits(100))
        assert plan.sequences == best_fit_one_by_one(lengths, 100)
        assert sum(plan.runs["n"]) == 400


def test_many_small_texts_fill_sequences_to_the_last_token():
    plan = best_fit({700: 1000, 300: 5000, 7: 100_000, 1: 5000}, Limits(2048))
    assert plan.sequences == -(-(700 * 1000 + 300 * 5000 + 7 * 100_000 + 5000) // 2048)


def test_packing_of_no_documents(spark):
    packed = Packing(spark.createDataFrame([], DOCS), VOCABULARY)
    assert packed.places().collect() == [] and packed.plan.sequences == 0


def test_tokens_equal_the_library_s_on_every_kind_of_text(plain, tmp_path):
    import pyarrow as pa

    from carelens.llm import kernels

    texts = [t or "" for t in ODD_TEXTS] + ["".join(chr(c) for c in range(a, a + 40)) for a in range(0x80, 0x3400, 40)]
    encoder = Encoder(VOCABULARY)
    ids, upto = encoder.encode(next(kernels.blocks(pa.array(texts))))
    assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == [ids_of(plain, t) for t in texts]
    encoder.different |= {"é"}  # a character that the libraries read differently
    assert encoder.ids("é a", True) == plain.encode("é a", add_special_tokens=False).ids
    held = json.loads(open(VOCABULARY).read())
    held["normalizer"] = {"type": "Lowercase"}
    (tmp_path / "other.json").write_text(json.dumps(held))
    assert Encoder(str(tmp_path / "other.json")).ids("ABC", True) == plain.encode("abc", add_special_tokens=False).ids


# vector codes

VECTORS = "vec_id long, embedding array<float>, label int"


def codes_by_force(rows, parts=4, entries=256, rounds=4):
    kept = sorted((i is None, i or 0, [math.floor(1024 * np.float64(np.float32(x))) for x in v], label)
                  for i, v, label in rows
                  if v and all(x is not None and math.isfinite(x) for x in v))
    cut = [np.array([k[2] for k in kept], dtype=np.int64).reshape(len(kept), parts, -1)[:, p] for p in range(parts)]
    books = [c[:entries].copy() for c in cut]

    def near(x, book):
        away = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        return away.argmin(axis=1), away.min(axis=1)

    for _ in range(rounds):
        for x, book in zip(cut, books):
            index, _ = near(x, book)
            for e in set(index.tolist()):
                book[e] = x[index == e].sum(axis=0) // (index == e).sum()
    found = [near(x, book) for x, book in zip(cut, books)]
    errors = sum(f[1] for f in found)
    by_label = Counter()
    for k, e in zip(kept, errors):
        by_label[k[3]] += int(e)
    rows = Counter((None if k[0] else k[1], "".join("%02x" % f[0][n] for f in found), int(errors[n]), by_label[k[3]])
                   for n, k in enumerate(kept))
    return rows, books


def odd_vectors(seed, rows, clusters=9):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(clusters, 16))
    out = [(int(k), (centre[rng.integers(clusters)] + rng.normal(size=16) / 9).tolist(),
            None if k % 7 == 0 else int(k % 3 if k % 3 else 1)) for k in rng.permutation(rows)]
    same = [0.25] * 16
    return out + [(5000, None, 1), (5001, [], 1), (5002, [None] + same[1:], 1), (5003, [float("nan")] + same[1:], 2),
                  (5004, [float("-inf")] + same[1:], 2), (5005, same, 2), (5005, same, 2), (5006, same, None),
                  (None, [-0.0001] * 16, 4), (5007, [0.5 + 1e-7] * 16, 4)]


@pytest.mark.parametrize("rows, entries", [(700, 256), (40, 256), (300, 17)])
def test_codes_equal_all_distances(spark, rows, entries):
    made = odd_vectors(rows, rows)
    codes = VectorCodes(spark.createDataFrame(made, VECTORS).repartition(3), entries=entries)
    expected, books = codes_by_force(made, entries=entries)
    assert all((a == b).all() for a, b in zip(codes.books.books, books))
    found = codes.codes()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in found.collect()) == expected
    near = {r.vec_id: r.decoded for r in codes.decode(found.where("vec_id < 20")).collect()}
    for i, v, _ in made:
        if i in near:
            assert max(abs(a - b) for a, b in zip(near[i], v)) < 2


def test_masks_and_radius_leave_the_nearest_entry():
    rng = np.random.default_rng(2)
    for spread, entries in ((3, 70), (1000, 256), (0, 5)):
        book = rng.integers(-spread, spread + 1, size=(entries, 4))
        x = rng.integers(-2 * spread, 2 * spread + 1, size=(500, 4))
        index, distance = Slices(book).nearest(x)
        away = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (index == away.argmin(axis=1)).all() and (distance == away.min(axis=1)).all()
    box = Slices(np.array([[0, 0], [5, 5], [1, 9]])).box(np.array([[1, 1]]), np.array([4]))
    assert box.tolist() == [[0b011]]


def test_codes_of_no_vectors_and_of_odd_lengths(spark):
    empty = VectorCodes(spark.createDataFrame([(1, None, 1)], VECTORS))
    assert empty.codes().collect() == [] and empty.books.sha256() == VectorCodes(
        spark.createDataFrame([], VECTORS)).books.sha256()
    mixed = VectorCodes(spark.createDataFrame([(1, [0.0] * 8, 1), (2, [1.0] * 4, 1), (3, [1.0] * 8, 1)], VECTORS))
    assert sorted(r.vec_id for r in mixed.codes().collect()) == [1, 3]
    with pytest.raises(ValueError, match="equal parts"):
        VectorCodes(spark.createDataFrame([(1, [0.0] * 6, 1)], VECTORS))
    with pytest.raises(ValueError, match="no long"):
        VectorCodes(spark.createDataFrame([(1, [1e30] * 4, 1)], VECTORS))


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_vector_best_fit", "op13_vector_codes"])
def test_queries_return_the_columns_of_their_contract(spark, name):
    found = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    columns = {"op11_lexical_search": "item_id rank doc_id score",
               "op12_vector_best_fit": "doc_id piece start length ids_crc32 sequence_id offset",
               "op13_vector_codes": "vec_id code error label_error codebooks_sha256"}[name].split()
    assert found.columns == columns and found.count() > 0


def test_extra_columns_with_clashing_names(spark):
    extra = [("n", 1), ("terms", 2), ("rank", 3), ("part", 4), ("length", 5), ("score", 6), ("components", 7), ("code", 8)]
    docs = spark.createDataFrame([(1, "w1 w2"), (2, "w2")], DOCS)
    items = spark.createDataFrame([("a", "w1 w2")], ITEMS)
    vectors = spark.createDataFrame([(1, [0.5] * 8, 1), (2, [0.25] * 8, None)], VECTORS)
    from pyspark.sql import functions as F

    for name, value in extra:
        docs, items, vectors = (d.withColumn(name, F.lit(value)) for d in (docs, items, vectors))
    assert [r.doc_id for r in LexicalSearch(docs, items).ranked().orderBy("rank").collect()] == [1, 2]
    assert Packing(docs, VOCABULARY).places().count() == 2
    assert VectorCodes(vectors).codes().count() == 2
