"""Ranked lexical search by MaxScore with bounds of single terms and of pairs of terms.

The index is partitioned by document.  For every document it holds the query terms it has with
their impacts, and the pairs of an item's selective terms it has with their joint impacts: the
precomputed intersection lists.  The greatest impact of each list bounds what a term, or two
together, can add to any score.

A task inverts its documents' lists block by block and evaluates every item against them, with a
threshold: the score of the last of the best documents known.  Terms of low bounds are
non-essential while their combined bound stays below it; two of them with a pair list add no more
than their joint maximum or the greater single one.  Of the other terms, those that cannot reach
the threshold with the non-essential ones alone need no list of their own: documents that matter
have two of them, hence stand in a pair list, and pair lists whose joint maximum is too low are
left out as well.  What remains are the lists that candidates come from.  Their scores are exact,
and bounds are upper bounds, so the result is that of scoring every document.

The first threshold comes from a sample of documents; it changes the cost, never the result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm import kernels as K
from carelens.session import cut_lineage

#: Documents that are returned for each item.
TOP = 50
#: Terms of an item that have pair lists: the rarest that more documents than these hold.
PAIR_TERMS = 10
#: Distinct item terms, with repeats between items, searched at once; more go in blocks.
BLOCK_TERMS = 1 << 20
#: Postings that a task inverts at once.
BLOCK_POSTINGS = 1 << 21
#: Documents that the first thresholds are learned from, at least and as a share.
SAMPLE_ROWS, SAMPLE_SHARE = 20_000, 0.02
#: A threshold that rises by this share is worth new choices.
RISE = 1.05


def item_terms(items: DataFrame) -> DataFrame:
    """``items`` (item_id, text) with item_row and the sorted hashes of the distinct ``terms`` of each."""
    schema = T.StructType([items.schema["item_id"], T.StructField("terms", T.ArrayType(T.LongType()))])

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in K.blocks(batch.column("text")):
            words = K.Words(block, K.alnum_words())
            row, h = _distinct(words.row, words.hash)
            yield {"item_id": batch.column("item_id")[block.rows],
                   "terms": K.list_array(K.signed(h), np.bincount(row, minlength=block.n))}

    return K.map_batches(items.select("item_id", F.col("text").cast("string")), function, schema) \
        .withColumn("item_row", F.monotonically_increasing_id())


def _distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def _counted(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n (all terms), and the ``terms`` (places in ``vocabulary``) it has, how often each."""

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        table = K.Lookup(vocabulary)
        for block in K.blocks(batch.column("text")):
            words = K.Words(block, K.alnum_words())
            at, found = table.find(words.hash)
            key, times = np.unique(words.row[found] * len(vocabulary) + at[found], return_counts=True)
            row, term = np.divmod(key, max(len(vocabulary), 1))
            size = np.bincount(row, minlength=block.n)
            yield {"doc_id": batch.column("doc_id")[block.rows], "n": words.count,
                   "terms": K.list_array(term.astype(np.int32), size),
                   "times": K.list_array(times.astype(np.int32), size)}

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return K.map_batches(own, function, T.StructType.fromDDL(
        "doc_id long, n long, terms array<int>, times array<int>"))


class Inverted:
    """Lists by key of some documents: which rows, ascending, and their values."""

    def __init__(self, row: np.ndarray, key: np.ndarray, value: np.ndarray, keys: int):
        order = np.argsort(key, kind="stable")
        self.row, self.value = row[order], value[order]
        self.upto = np.concatenate(([0], np.cumsum(np.bincount(key, minlength=keys))))

    def rows(self, key: int) -> np.ndarray:
        return self.row[self.upto[key] : self.upto[key + 1]]

    def values(self, key: int) -> np.ndarray:
        return self.value[self.upto[key] : self.upto[key + 1]]


def _lists(batch: pa.RecordBatch, first: str, *others: str) -> tuple[np.ndarray, ...]:
    """Row and value of every element of list columns of equal lengths."""
    size = batch.column(first).value_lengths().to_numpy(zero_copy_only=False)
    flat = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (first, *others)]
    return (np.repeat(np.arange(batch.num_rows), size), *flat)


def _sliced(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of a bounded number of elements of a list column, or of one row."""
    upto = np.cumsum(batch.column(column).value_lengths().to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + BLOCK_POSTINGS, side="right")))
        yield batch.slice(first, last - first)
        first = last


@dataclass
class Bounds:
    """What the driver knows of one block of items: bounded by their terms."""

    items: list[np.ndarray]  # terms of each item
    weight: np.ndarray
    pairs: dict[tuple[int, int], int]  # place of each pair of terms
    chosen: list[list[int]]  # terms of each item that have pair lists
    documents: int
    words: int
    term: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))  # greatest impact
    joint: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))  # of each pair

    def of_pair(self, a: int, b: int) -> int | None:
        """Bound of what two terms add together, if they have a pair list."""
        at = self.pairs.get((min(a, b), max(a, b)))
        return None if at is None else max(int(self.joint[at]), int(self.term[a]), int(self.term[b]))


def term_weights(frequency: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequency],
                    dtype=np.int64)


def _indexed(counted: DataFrame, known: Bounds) -> DataFrame:
    """doc_id, terms with ``shares`` (impact by weight), ``pairs`` with ``joints`` (joint impact)."""
    schema = T.StructType.fromDDL(
        "doc_id long, terms array<int>, shares array<int>, pairs array<int>, joints array<long>")
    partners: dict[int, list[tuple[int, int]]] = {}
    for (a, b), at in known.pairs.items():
        partners.setdefault(a, []).append((b, at))

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in _sliced(batch, "terms"):
            row, term, times = _lists(part, "terms", "times")
            times = times.astype(np.int64)
            length = 50 + (50 * part.column("n").to_numpy() * known.documents) // max(known.words, 1)
            share = (1_000_000_000 * times) // (1000 * times + 20 * length[row])
            lists = Inverted(row, term, known.weight[term] * share, len(known.weight))
            rows, places, joints = [], [], []
            value = np.zeros(part.num_rows, dtype=np.int64)
            has = np.zeros(part.num_rows, dtype=bool)
            for a, others in partners.items():
                own = lists.rows(a)
                if not len(own):
                    continue
                has[own], value[own] = True, lists.values(a)
                for b, at in others:
                    both = has[lists.rows(b)]
                    rows.append(found := lists.rows(b)[both])
                    places.append(np.full(len(found), at, dtype=np.int32))
                    joints.append(lists.values(b)[both] + value[found])
                has[own] = False
            rows = np.concatenate([np.zeros(0, dtype=np.int64), *rows])
            order = np.argsort(rows, kind="stable")
            size = np.bincount(rows, minlength=part.num_rows)
            yield {"doc_id": part.column("doc_id"), "terms": part.column("terms"),
                   "shares": K.list_array(share.astype(np.int32), np.bincount(row, minlength=part.num_rows)),
                   "pairs": K.list_array(np.concatenate([np.zeros(0, np.int32), *places])[order], size),
                   "joints": K.list_array(np.concatenate([np.zeros(0, np.int64), *joints])[order], size)}

    return K.map_batches(counted.select("doc_id", "n", "terms", "times"), function, schema)


def _maxima(index: DataFrame, known: Bounds) -> DataFrame:
    """kind, key, most: the greatest share of each term and joint impact of each pair."""

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for kind, key, value, n in (("term", "terms", "shares", len(known.weight)),
                                    ("pair", "pairs", "joints", len(known.pairs))):
            _, key, value = _lists(batch, key, value)
            most = np.zeros(n, dtype=np.int64)
            np.maximum.at(most, key, value)
            some = np.flatnonzero(most)
            yield {"kind": np.full(len(some), kind), "key": some, "most": most[some]}

    return K.map_batches(index.drop("doc_id"), function, T.StructType.fromDDL("kind string, key long, most long")) \
        .groupBy("kind", "key").agg(F.max("most").alias("most"))


class Choice:
    """Lists that an item's candidates come from, and those that only complete their scores."""

    def __init__(self, terms: np.ndarray, chosen: list[int], known: Bounds, threshold: int):
        self.threshold = threshold
        order = sorted((int(t) for t in terms if known.term[t] > 0), key=lambda t: (int(known.term[t]), t))
        low, bound = 0, 0
        alone: list[int] = []  # non-essential terms not bound together with another
        self.bound = [0]  # of the first k terms of ``order``
        for k, t in enumerate(order):
            most = int(known.term[t])
            best, with_term = bound + most, None
            for u in alone:
                joint = known.of_pair(t, u)
                if joint is not None and bound - int(known.term[u]) + joint < best:
                    best, with_term = bound - int(known.term[u]) + joint, u
            if best >= threshold:
                break
            bound, low = best, k + 1
            self.bound.append(bound)
            if with_term is None:
                alone.append(t)
            else:
                alone.remove(with_term)
        self.rest, self.essential = order[:low], order[low:]
        paired = set(chosen)
        self.weak = [t for t in self.essential if t in paired and int(known.term[t]) + bound < threshold]
        if len(self.weak) < 2:  # a document has one of them at most, which is too little
            self.pairs = []
        else:
            self.pairs = self._needed_pairs(known, bound)
        self.strong = [t for t in self.essential if t not in set(self.weak)]

    def _needed_pairs(self, known: Bounds, bound: int) -> list[int]:
        """All pairs of weak terms but some that are too low, no three of which share three terms.

        So a document with three weak terms or more stands in the list of another pair of them.
        """
        each = sorted((known.of_pair(a, b), a, b) for a, b in itertools.combinations(self.weak, 2))
        skipped: dict[int, set[int]] = {t: set() for t in self.weak}
        needed = []
        for joint, a, b in each:
            if joint + bound < self.threshold and not skipped[a] & skipped[b]:
                skipped[a].add(b)
                skipped[b].add(a)
            else:
                needed.append(known.pairs[min(a, b), max(a, b)])
        return needed

    def scores(self, terms: Inverted, pairs: Inverted, total: np.ndarray, mark: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
        """Rows that reach the threshold, and their scores.  ``total`` and ``mark`` are zero, and are so after."""
        rows = [terms.rows(t) for t in self.strong] + [pairs.rows(p) for p in self.pairs]
        for r in rows:
            mark[r] = True
        found = np.flatnonzero(mark) if rows else np.zeros(0, dtype=np.int64)
        mark[found] = False
        if not len(found):
            return found, found
        for t in self.essential:
            total[terms.rows(t)] += terms.values(t)
        score = total[found]
        for t in self.essential:
            total[terms.rows(t)] = 0
        for k in range(len(self.rest), 0, -1):
            keep = score + self.bound[k] >= self.threshold
            found, score = found[keep], score[keep]
            rows = terms.rows(self.rest[k - 1])
            if len(found) and len(rows):
                at = np.minimum(np.searchsorted(rows, found), len(rows) - 1)
                score = score + np.where(rows[at] == found, terms.values(self.rest[k - 1])[at], 0)
        keep = score >= self.threshold
        return found[keep], score[keep]


SCORED = "item long, doc_id long, score long"
_LAST = np.iinfo(np.int64).max


def _searched(index: DataFrame, known: Bounds, thresholds: list[int], top: int) -> DataFrame:
    """Of each task the best ``top`` documents of every item that reach its threshold."""
    schema = T.StructType.fromDDL(SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choices = [Choice(t, c, known, max(1, least)) for t, c, least in
                   zip(known.items, known.chosen, thresholds, strict=True)]
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in choices]
        for batch in batches:
            for part in _sliced(batch, "terms"):
                ids = part.column("doc_id")
                nameless = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(_LAST).to_numpy()
                row, term, share = _lists(part, "terms", "shares")
                terms = Inverted(row, term, known.weight[term] * share.astype(np.int64), len(known.weight))
                pairs = Inverted(*_lists(part, "pairs", "joints"), len(known.pairs))
                total, mark = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, bool)
                for k, choice in enumerate(choices):
                    found, score = choice.scores(terms, pairs, total, mark)
                    if not len(found):
                        continue
                    have = [np.concatenate(x) for x in zip(
                        best[k], (score, ids[found], nameless[found]), strict=True)]
                    order = np.lexsort((have[2], have[1], -have[0]))[:top]
                    best[k] = tuple(x[order] for x in have)
                    least = int(best[k][0][-1]) if len(order) == top else 0
                    if least > choice.threshold * RISE:
                        choices[k] = Choice(known.items[k], known.chosen[k], known, least)
        item = np.repeat(np.arange(len(best)), [len(b[0]) for b in best])
        score, ids, nameless = (np.concatenate([b[j] for b in best] or [np.zeros(0, np.int64)]) for j in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(ids, pa.int64(), mask=nameless.astype(bool)),
             pa.array(score, pa.int64())], names=schema.names)

    return index.mapInArrow(run, schema)


class LexicalSearch:
    """The stored index of documents for a set of items, and its results.

    ``docs`` has doc_id and text, ``items`` item_id and text.  Null and empty texts have no terms: such
    documents are found by no item and such items find nothing.  Every row is a document, or an
    item, of its own, whatever its id; null ids come last among equal scores.  Without documents
    or items the result is empty.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, top: int = TOP):
        self.top = top
        self.items = cut_lineage(item_terms(items))
        total = self.items.agg(F.sum(F.size("terms"))).first()[0] or 0
        n = max(1, -(-total // BLOCK_TERMS))
        block = F.pmod(F.xxhash64("item_row"), F.lit(n))
        found = [self._block(docs, self.items.where(block == k)) for k in range(n)]
        self.found = found[0]
        for more in found[1:]:
            self.found = self.found.union(more)

    def _block(self, docs: DataFrame, items: DataFrame) -> DataFrame:
        held = items.orderBy("item_row").select("item_row", "terms").collect()
        every = np.array([t for r in held for t in r.terms], dtype=np.int64)
        vocabulary = np.unique(K.unsigned(every))
        counted = cut_lineage(_counted(docs, vocabulary))
        known = self._known(counted, [np.searchsorted(vocabulary, K.unsigned(np.array(r.terms, dtype=np.int64)))
                                      for r in held])
        index = cut_lineage(_indexed(counted, known))
        known.term, known.joint = np.zeros(len(known.weight), np.int64), np.zeros(len(known.pairs), np.int64)
        for kind, key, most in _maxima(index, known).collect():
            if kind == "term":
                known.term[key] = most * known.weight[key]
            else:
                known.joint[key] = most
        share = max(SAMPLE_ROWS / max(known.documents, 1), SAMPLE_SHARE)
        some = index.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < math.ceil(min(share, 1) * (1 << 20)))
        first = _searched(some, known, [1] * len(held), self.top)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        thresholds = [1] * len(held)
        for item, score in first.withColumn("rank", rank).where(F.col("rank") == self.top).select("item", "score").collect():
            thresholds[item] = score
        scored = _searched(index, known, thresholds, self.top)
        spark = docs.sparkSession
        rows = spark.createDataFrame([(k, r.item_row) for k, r in enumerate(held)], "item long, item_row long")
        return cut_lineage(scored.join(rows, "item").drop("item"))

    def _known(self, counted: DataFrame, items: list[np.ndarray]) -> Bounds:
        documents, words = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        frequency = np.zeros(int(max((t.max() for t in items if len(t)), default=-1)) + 1, dtype=np.int64)
        for term, n in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            frequency[term] = n
        chosen, pairs = [], {}
        for terms in items:
            many = sorted((int(t) for t in terms if frequency[t] > self.top), key=lambda t: (int(frequency[t]), t))
            chosen.append(many[:PAIR_TERMS])
            for a, b in itertools.combinations(sorted(chosen[-1]), 2):
                pairs.setdefault((a, b), len(pairs))
        return Bounds(items, term_weights(frequency, documents), pairs, chosen, documents, words or 0)

    def ranked(self) -> DataFrame:
        """item_row, item_id, rank, doc_id, score: of every item the best documents with a score above 0."""
        order = Window.partitionBy("item_row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        return self.found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.top) \
            .join(self.items.select("item_row", "item_id"), "item_row") \
            .select("item_row", "item_id", "rank", "doc_id", "score")
