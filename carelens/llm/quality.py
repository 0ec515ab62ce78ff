"""Quality score: ridge regression on random Fourier features, calibrated by isotonic regression.

Statistics of a document's text are scaled and mapped to cosines whose inner products
approximate a Gaussian kernel.  Every task sums its share of the normal equations, Spark adds
the shares, and the driver solves a system as large as the number of features.  Scores of
documents kept out of the fit are grouped and made monotone against their labels.
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

#: What is measured of a text, in this order.
STATISTICS = (
    "log words", "log bytes per line", "bytes per word", "longest word", "upper case", "digits",
    "stops and commas", "exclamations", "bars", "other symbols", "non-ASCII", "words without letters",
    "distinct words", "repeats of the word before", "distinct pairs", "commonest word", "capitalised words",
)
SEED = 7


def _class_table() -> np.ndarray:
    """Kind of each byte: 1 upper, 2 digit, 3 stop or comma, 4 '!', 5 '|', 6 symbol, 7 non-ASCII, 8 lower."""
    table = np.zeros(256, dtype=np.uint8)
    table[33:127] = 6
    table[65:91], table[97:123], table[48:58], table[128:] = 1, 8, 2, 7
    for characters, kind in ((".,", 3), ("!", 4), ("|", 5)):
        table[[ord(c) for c in characters]] = kind
    return table


KINDS = _class_table()


def _per_row(values: np.ndarray, upto: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return (sums[upto[1:]] - sums[upto[:-1]]).astype(float)


def statistics(block: K.Block) -> np.ndarray:
    """A row of STATISTICS for each text; without words all are 0."""
    words = K.Words(block, K.white_words(), lower=False)
    n, size = words.count.astype(float), np.diff(block.bounds).astype(float)
    some, length = np.maximum(n, 1), words.end - words.start
    kind = KINDS[block.data]
    share = {k: _per_row(kind == k, block.bounds) / np.maximum(size, 1) for k in range(1, 9)}
    lines = _per_row(block.data == 10, block.bounds) + 1
    letters = np.concatenate(([0], np.cumsum((kind == 1) | (kind == 8) | (kind == 7))))
    bare = letters[words.end] == letters[words.start]
    longest = np.zeros(block.n)
    np.maximum.at(longest, words.row, length)
    h, row = words.hash, words.row
    order = np.lexsort((h, row))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (h[order][1:] != h[order][:-1])
    begin = np.flatnonzero(new)
    common = np.zeros(block.n)
    np.maximum.at(common, row[order][begin], np.diff(np.append(begin, len(h))))
    distinct = np.bincount(row[order][begin], minlength=block.n)
    follows = np.zeros(len(h), dtype=bool)
    follows[1:] = row[1:] == row[:-1]
    again = follows.copy()
    again[1:] &= h[1:] == h[:-1]
    with np.errstate(over="ignore"):
        pair = K.mix(h[1:] * np.uint64(3) + h[:-1])[follows[1:]]
    pair_row = row[follows]
    order = np.lexsort((pair, pair_row))
    new = np.ones(len(pair), dtype=bool)
    new[1:] = (pair_row[order][1:] != pair_row[order][:-1]) | (pair[order][1:] != pair[order][:-1])
    pairs = np.bincount(pair_row[order][new], minlength=block.n)
    capital = kind[words.start] == 1
    out = np.stack([
        np.log1p(n), np.log1p(size / lines), size / some, np.log1p(longest),
        share[1] / np.maximum(share[1] + share[8], 1e-9), share[2], share[3], share[4], share[5], share[6],
        share[7], _per_row(bare, words.upto) / some, distinct / some, _per_row(again, words.upto) / some,
        pairs / np.maximum(n - 1, 1), common / some, _per_row(capital, words.upto) / some,
    ], axis=1)
    out[n == 0] = 0.0
    return out


@dataclass
class QualityModel:
    """Fitted numbers; a few hundred kilobytes at most, whatever the corpus holds."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    ridge: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(x @ self.weights + self.shift) * np.sqrt(2 / len(self.shift))
        return np.concatenate((waves, np.ones((len(x), 1))), axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.ridge

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated; a hundredth of the raw score orders what isotonic steps make equal."""
        raw = self.raw(x)
        level = np.interp(raw, self.knots, self.levels)
        return np.clip(0.99 * level + 0.01 * np.clip(raw, 0, 1), 0, 1)


MEASURED = "doc_id long, statistics array<double>"


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every whole text."""

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in K.blocks(batch.column("text")):
            values = statistics(block)
            yield {"doc_id": batch.column("doc_id")[block.rows],
                   "statistics": K.list_array(values.ravel(), np.full(block.n, values.shape[1]))}

    return K.map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), function,
                         T.StructType.fromDDL(MEASURED))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=float).reshape(len(column), len(STATISTICS))


def fit(rows: DataFrame, waves: int = 256, width: float = 6.0, penalty: float = 1e-2,
        bins: int = 2000) -> QualityModel:
    """Fit on ``rows``: statistics, label (0 or 1) and ``calibrate`` (kept for the isotonic part).

    ``waves`` random features of a Gaussian kernel of ``width`` scaled units.  Without rows of
    both labels the score is their mean, or a half without rows.
    """
    d = len(STATISTICS)
    moments = rows.agg(F.count(F.lit(1)), F.avg("label"), *(
        f(F.col("statistics")[k]) for k in range(d) for f in (F.avg, F.stddev_pop))).first()
    count, prior = moments[0], 0.5 if moments[1] is None else float(moments[1])
    numbers = np.array([0.0 if v is None else v for v in moments[2:]]).reshape(d, 2)
    rng = np.random.default_rng(SEED)
    model = QualityModel(
        mean=numbers[:, 0], scale=np.where(numbers[:, 1] > 1e-12, numbers[:, 1], 1.0),
        weights=rng.normal(size=(d, waves)) / width, shift=rng.uniform(0, 2 * np.pi, waves),
        ridge=np.zeros(waves + 1), knots=np.array([0.0]), levels=np.array([prior]))
    if not count or prior in (0.0, 1.0):
        return model
    size = waves + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, seen = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            for part in range(0, batch.num_rows, 4096):
                rows_here = batch.slice(part, 4096)
                z = model.features(_matrix(rows_here.column("statistics")))
                y = np.asarray(rows_here.column("label"), dtype=float)
                left, right, seen = left + z.T @ z, right + z.T @ y, seen + len(y)
        if seen:
            values = np.concatenate((left[np.triu_indices(size)], right))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values))), pa.array(values)], names=["entry", "value"])

    shares = rows.where(~F.col("calibrate")).select("statistics", "label").mapInArrow(
        equations, "entry long, value double")
    summed = {r.entry: r.value for r in shares.groupBy("entry").agg(F.sum("value").alias("value")).collect()}
    if summed:
        values = np.array([summed[k] for k in range(len(summed))])
        left = np.zeros((size, size))
        left[np.triu_indices(size)] = values[:-size]
        left = left + np.triu(left, 1).T
        held = penalty * np.eye(size)
        held[-1, -1] = 0.0
        model.ridge = np.linalg.solve(left + held + 1e-9 * np.eye(size), values[-size:])

    def binned(batch: pa.RecordBatch) -> Iterator[dict]:
        raw = model.raw(_matrix(batch.column("statistics")))
        yield {"bin": np.floor(np.clip(raw, -1, 2) * bins / 3).astype(np.int64), "label": batch.column("label")}

    groups = K.map_batches(rows.where("calibrate").select("statistics", F.col("label").cast("double")), binned,
                           T.StructType.fromDDL("bin long, label double"))
    steps = groups.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")) \
        .orderBy("bin").collect()
    if steps:
        x, weight, mean = isotonic(np.array([(r.bin + 0.5) * 3 / bins for r in steps]),
                                   np.array([r.n for r in steps], dtype=float),
                                   np.array([r.good for r in steps], dtype=float))
        # One row of either label for each step, so that a small step is not sure of itself.
        model.knots, model.levels = x, np.maximum.accumulate((mean * weight + prior) / (weight + 1))
    return model


def isotonic(x: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pool adjacent violators: mean place, weight and mean of the groups that remain."""
    groups: list[list[float]] = []
    for place, w, t in zip(x, weight, total, strict=True):
        groups.append([place * w, w, t])
        while len(groups) > 1 and groups[-2][2] * groups[-1][1] >= groups[-1][2] * groups[-2][1]:
            last = groups.pop()
            groups[-1] = [a + b for a, b in zip(groups[-1], last, strict=True)]
    out = np.array(groups)
    return out[:, 0] / out[:, 1], out[:, 1], out[:, 2] / out[:, 1]


def scored(measured: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of measured documents."""

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {"doc_id": batch.column("doc_id"), "score": model.score(_matrix(batch.column("statistics")))}

    return K.map_batches(measured.select("doc_id", "statistics"), function,
                         T.StructType.fromDDL("doc_id long, score double"))


def keep_good(docs: DataFrame, model: QualityModel, least: float) -> DataFrame:
    """The rows of ``docs`` with a score of ``least`` or more, all columns as they are.

    Texts are scored where they are read, so no text is shuffled.
    """
    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        scores = [model.score(statistics(block)) for block in K.blocks(batch.column("text"))]
        good = pa.array(np.concatenate(scores) >= least) if scores else pa.array([], pa.bool_())
        kept = batch.filter(good)
        yield {name: kept.column(k) for k, name in enumerate(kept.schema.names)}

    return K.map_batches(docs, function, docs.schema)


def labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows to fit on: held-out documents are left out, a quarter of the rest calibrates."""
    fold = F.crc32(F.col("doc_id").cast("string"))
    own = labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    return measured.where(fold % 5 != 0).join(own, "doc_id").withColumn("calibrate", fold % 20 > 14)
