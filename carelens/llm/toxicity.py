"""Toxicity score: logistic regression on hashed word n-grams and skip-grams by FTRL-proximal.

Each coordinate has its own learning rate, and an L1 penalty keeps most weights at exactly
zero, so the weights that scoring tasks get are few.  Training runs in rounds: every shard of
the bounded training sample continues from the common state, and each coordinate moves by the
average over the shards that moved it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm import kernels as K
from carelens.session import cut_lineage

#: Coordinates that n-grams are hashed to; the state is two doubles for each, 8 MB.
BITS = 19
#: Labelled documents that training takes at most: those of the smallest hashes of their ids.
SAMPLE = 30_000
SHARDS, ROUNDS, PASSES = 2, 3, 2


@dataclass(frozen=True)
class Ftrl:
    """``toxic_weight``: how much more a toxic document counts, as there are few of them."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 12.0
    l2: float = 1.0
    toxic_weight: float = 5.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def learn(self, z: np.ndarray, n: np.ndarray, at: np.ndarray, label: float) -> None:
        """One document: ``at`` are its coordinates, each with value 1."""
        w = self.weights(z[at], n[at])
        g = (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label) * (self.toxic_weight if label else 1.0)
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / self.alpha
        z[at] += g - sigma * w
        n[at] += g * g


def grams(block: K.Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and coordinate of words, pairs and pairs with one word between; 0 is the constant."""
    words = K.Words(block, K.alnum_words())
    h, row = words.hash, words.row
    rows, values = [np.arange(block.n), row], [np.zeros(block.n, np.uint64), h]
    with np.errstate(over="ignore"):
        for gap, salt in ((1, 0x632BE59BD9B4E019), (2, 0xE220A8397B1DCDAF)):
            same = row[gap:] == row[:-gap]
            rows.append(row[gap:][same])
            values.append(K.mix(h[:-gap] * np.uint64(3) + h[gap:] + np.uint64(salt))[same])
    value = np.concatenate([values[0], *(1 + v % np.uint64((1 << BITS) - 1) for v in values[1:])])
    return np.concatenate(rows), value.astype(np.int64)


def distinct_grams(block: K.Block) -> tuple[np.ndarray, np.ndarray]:
    row, value = grams(block)
    key = np.unique((row.astype(np.int64) << BITS) | value)
    return key >> BITS, key & ((1 << BITS) - 1)


def sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """label and coordinates of at most ``limit`` labelled documents, dealt over SHARDS.

    The share that the limit allows is taken by a hash of the id, so the sample is the same
    each time; its ids are bounded and broadcast.
    """
    own = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    own = own.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    n = own.count()
    if n > limit:
        own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(own), "doc_id")

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in K.blocks(batch.column("text")):
            row, value = distinct_grams(block)
            yield {"doc_id": batch.column("doc_id")[block.rows], "label": batch.column("label")[block.rows],
                   "grams": K.list_array(value.astype(np.int32), np.bincount(row, minlength=block.n))}

    rows = K.map_batches(texts, function, T.StructType.fromDDL("doc_id long, label double, grams array<int>"))
    order = F.xxhash64("doc_id", F.lit("order"))
    return cut_lineage(rows.withColumn("shard", F.pmod(order, F.lit(SHARDS)).cast("int")).withColumn("place", order))


STATE = "shard int, moved array<int>, z array<double>, n array<double>"


def train(rows: DataFrame, rounds: int = ROUNDS, ftrl: Ftrl = Ftrl()) -> np.ndarray:
    """Weights of all coordinates after some rounds over the shards; zeros without rows.

    A round brings the state of each shard to the driver: SHARDS times 10 MB at most.
    """
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(rounds):
        parts = rows.groupBy("shard").applyInArrow(_round(z, n, ftrl), STATE).toArrow()
        z, n, by = z.copy(), n.copy(), np.zeros(len(z))
        steps = [(m.values.to_numpy(), a.values.to_numpy(), b.values.to_numpy()) for m, a, b in zip(
            parts["moved"], parts["z"], parts["n"], strict=True)]
        for at, _, _ in steps:
            by[at] += 1
        for at, dz, dn in steps:
            z[at] += dz / by[at]
            n[at] += dn / by[at]
    return ftrl.weights(z, n)


def _round(z0: np.ndarray, n0: np.ndarray, ftrl: Ftrl):
    """Learn the documents of a shard in their order, PASSES times; gives what the state moved by."""

    def learn(table: pa.Table) -> pa.Table:
        z, n = z0.copy(), n0.copy()
        table = table.sort_by([("place", "ascending"), ("doc_id", "ascending")])
        labels = table["label"].to_pylist()
        grams = [at.values.to_numpy() for at in table["grams"]]
        for _ in range(PASSES):
            for label, at in zip(labels, grams, strict=True):
                ftrl.learn(z, n, at, label)
        moved = np.flatnonzero((z != z0) | (n != n0)).astype(np.int32)
        state = [K.list_array(v, np.array([len(moved)])) for v in (moved, (z - z0)[moved], (n - n0)[moved])]
        return pa.table([table["shard"].combine_chunks().slice(0, 1), *state],
                        names=["shard", "moved", "z", "n"])

    return learn


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every whole text; a text without words has the constant's score."""
    some = np.flatnonzero(weights)
    held = (some, weights[some])

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        dense = np.zeros(1 << BITS)
        dense[held[0]] = held[1]
        for block in K.blocks(batch.column("text")):
            row, value = grams(block)
            used = dense[value] != 0
            key = np.unique((row[used].astype(np.int64) << BITS) | value[used])
            total = np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)], minlength=block.n)
            yield {"doc_id": batch.column("doc_id")[block.rows],
                   "score": 1 / (1 + np.exp(-np.clip(total, -35, 35)))}

    return K.map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), function,
                         T.StructType.fromDDL("doc_id long, score double"))
