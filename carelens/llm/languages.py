"""Language identification by inference of multilingual mixtures.

Each language is a distribution of character n-grams, learned from labelled texts.  A document
is a mixture of some languages; expectation-maximisation finds the proportions that make its
n-grams likeliest, and the set of languages is the one whose likelihood, less a penalty for
each language in it, is best.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm import kernels as K

#: n-grams are hashed to so many buckets; a language is a double for each, 256 KB.
BUCKETS = 1 << 15
#: Rounds after which proportions stand as they are, should their bound not have closed in by then.
ROUNDS = 5_000
#: Rounds from one look at the bound to the next.
CHECK = 5
#: Log likelihood that proportions may lack of the largest.
TOLERANCE = 0.1
#: Rows whose n-grams are counted in one table of BUCKETS numbers each.
DENSE_ROWS = 64
#: Likelihood that another language has to add, in units of log(n-grams) / 2.
PENALTY = 4.0
UNKNOWN = "und"


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point, whether it is a letter, and its lower case."""
    points = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000)]
    lower = np.fromiter((ord(x) if len(x) == 1 else ord(c) for c, x in ((c, c.lower()) for c in points)),
                        dtype=np.uint32, count=len(points))
    return np.fromiter((c.isalpha() for c in points), dtype=bool, count=len(points)), lower


def ngrams(block: K.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of the n-grams of one to three letters, and which rows have letters.

    Words are runs of letters; a run is padded by one mark on either side.
    """
    is_letter, lower = _letters()
    data = block.data
    begin = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of code points
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    if len(points) != len(begin):  # bytes that are no UTF-8: row by row
        return _ngrams_by_row(block)
    row = np.repeat(np.arange(block.n), np.diff(np.searchsorted(begin, block.bounds)))
    return _ngrams(points, row, block.n, is_letter, lower)


def _ngrams_by_row(block: K.Block):
    rows, texts = [], []
    for k in range(block.n):
        text = block.data[block.bounds[k] : block.bounds[k + 1]].tobytes().decode("utf-8", "replace")
        texts.append(text)
        rows.append(len(text))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    return _ngrams(points, np.repeat(np.arange(block.n), rows), block.n, *_letters())


def _ngrams(points, row, n, is_letter, lower):
    letter = is_letter[points]
    symbol = np.where(letter, lower[points], 0).astype(np.uint64)
    inner = np.flatnonzero(letter)
    has = np.bincount(row[inner], minlength=n) > 0
    # neighbours of each letter, 0 beyond the word or the row
    padded = np.concatenate(([0, 0], symbol, [0, 0])).astype(np.uint64)
    edge = np.concatenate(([-1, -1], row, [-1, -1]))

    def at(shift):
        return np.where(edge[inner + 2 + shift] == row[inner], padded[inner + 2 + shift], 0)

    before, here, after = at(-1), symbol[inner], at(1)
    with np.errstate(over="ignore"):
        three = K.mix((before << np.uint64(42)) | (here << np.uint64(21)) | after)
        two = K.mix((before << np.uint64(21)) | here | np.uint64(1 << 63))
        one = K.mix(here | np.uint64(1 << 62))
    bucket = np.concatenate((one, two, three)) % np.uint64(BUCKETS)
    return np.tile(row[inner], 3), bucket.astype(np.int64), has


def counted(block: K.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and count of the distinct n-grams of each row, and which rows have letters."""
    row, bucket, has = ngrams(block)
    per_row = len(row) // 3  # the letters, once for each order
    letters = np.searchsorted(row[:per_row], np.arange(0, block.n + DENSE_ROWS, DENSE_ROWS))
    keys, counts = [], []
    for k, (low, high) in enumerate(zip(letters, letters[1:], strict=False)):
        first = k * DENSE_ROWS
        at = np.concatenate([np.arange(low, high) + order * per_row for order in range(3)])
        dense = np.bincount((row[at] - first) * BUCKETS + bucket[at])
        some = np.flatnonzero(dense)
        keys.append(some + first * BUCKETS)
        counts.append(dense[some])
    key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    return key // BUCKETS, key % BUCKETS, count, has


def language_counts(docs: DataFrame) -> DataFrame:
    """lang, bucket, count over all of ``docs`` (text, lang)."""

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        langs = batch.column("lang").dictionary_encode()
        code, names = langs.indices.to_numpy(), langs.dictionary
        total = np.zeros((len(names), BUCKETS), dtype=np.int64)
        for block in K.blocks(batch.column("text")):
            row, bucket, _ = ngrams(block)
            total += np.bincount(code[block.rows][row] * BUCKETS + bucket,
                                 minlength=total.size).reshape(total.shape)
        lang, bucket = np.nonzero(total)
        yield {"lang": names.take(pa.array(lang)), "bucket": bucket, "count": total[lang, bucket]}

    rows = K.map_batches(docs.where("lang is not null").select("text", "lang"), function,
                         T.StructType.fromDDL("lang string, bucket int, count long"))
    return rows.groupBy("lang", "bucket").agg(F.sum("count").alias("count"))


@dataclass
class LanguageModel:
    """Names, and the probability of each bucket (rows) in each language (columns)."""

    names: list[str]
    likely: np.ndarray

    def infer(self, row: np.ndarray, bucket: np.ndarray, count: np.ndarray, n: int,
              penalty: float = PENALTY) -> np.ndarray:
        """Proportions of the languages (columns) in each row; all 0 without n-grams.

        ``row`` is sorted.  No set of languages is likelier than all of them together, and what
        all reach has an upper bound at any proportions (``_Sample.bound``): sets are tried, the
        largest proportions first, for as long as that bound less the penalties is above the best.
        The best then changes by one language more, less or another while that is better, so the
        result is the best set but for sets that differ from it in several languages at once.
        """
        best = np.zeros((n, len(self.names)))
        size = np.bincount(row, count, minlength=n)
        here = np.flatnonzero(size > 0)
        if not len(here):
            return best
        data = _Sample(np.searchsorted(row, np.append(here, n)), self.likely[bucket].T.copy(),
                       count.astype(float), size[here])
        single = np.stack([data.sums(data.count * np.log(p)) for p in data.likely], axis=1)
        top = single.argmax(axis=1)
        value = single.max(axis=1)
        share = np.zeros_like(single)
        share[np.arange(len(here)), top] = 1.0
        cost = penalty * np.log(np.maximum(data.size, 2)) / 2
        alone = data.bound(value, data.slopes(share)[0], np.ones_like(share))
        open_ = tried = np.flatnonzero(alone - cost > value)
        every, likely, most = data.part(open_).maximise(np.ones((len(open_), len(self.names))), (value + cost)[open_])
        order = np.argsort(-every, axis=1, kind="stable")
        for k in range(2, len(self.names) + 1):
            some = np.flatnonzero(most - (k - 1) * cost[open_] > value[open_])
            open_, every, likely, most, order = open_[some], every[some], likely[some], most[some], order[some]
            if not len(open_):
                break
            paid = (k - 1) * cost[open_]
            if k == len(self.names):
                found, reached = every, likely
            else:
                allowed = np.zeros((len(open_), len(self.names)))
                np.put_along_axis(allowed, order[:, :k], 1.0, axis=1)
                found, reached, _ = data.part(open_).maximise(allowed, value[open_] + paid)
            better = reached - paid > value[open_]
            share[open_[better]], value[open_[better]] = found[better], (reached - paid)[better]
        while len(tried):
            found, reached = data.part(tried).neighbours(share[tried], value[tried], cost[tried])
            better = reached > value[tried] + TOLERANCE
            tried = tried[better]
            share[tried], value[tried] = found[better], reached[better]
        best[here] = share
        return best


class _Sample:
    """n-grams of some rows one after another: where each row begins, likelihoods by language."""

    def __init__(self, begin: np.ndarray, likely: np.ndarray, count: np.ndarray, size: np.ndarray):
        self.begin, self.likely, self.count, self.size = begin, likely, count, size
        self.length = np.diff(begin)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.begin[:-1])

    def part(self, rows: np.ndarray) -> _Sample:
        keep = np.zeros(len(self.length), dtype=bool)
        keep[rows] = True
        each = np.repeat(keep, self.length)
        begin = np.concatenate(([0], np.cumsum(self.length[rows])))
        return _Sample(begin, self.likely[:, each], self.count[each], self.size[rows])

    def slopes(self, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By row and language, the factor by which a round changes each proportion, and each n-gram's likelihood."""
        total = np.zeros(len(self.count))
        for j, p in enumerate(self.likely):
            total += np.repeat(share[:, j], self.length) * p
        weight = self.count / total
        return np.stack([self.sums(p * weight) for p in self.likely], axis=1) / self.size[:, None], total

    def bound(self, likely: np.ndarray, slopes: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """What no proportions of the allowed languages exceed, from the log likelihood at some of them.

        By Jensen's inequality the gain to proportions w is at most n-grams * log(sum of w * slopes).
        """
        return likely + self.size * np.log(np.maximum((slopes * allowed).max(axis=1), 1.0))

    def neighbours(self, share: np.ndarray, value: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best of the sets that differ from those of ``share`` in one language: proportions, penalised likelihood.

        Only a language whose slope is above 1 can come in, as the bound of the set with it shows.
        """
        has = share > 0
        many = has.sum(axis=1)
        gain = self.size[:, None] * np.log(np.maximum(self.slopes(share)[0], 1.0))
        best, found = value.copy(), share.copy()

        def attempt(rows: np.ndarray, out: int | None, into: int | None) -> None:
            allowed = has[rows].astype(float)
            if out is not None:
                allowed[:, out] = 0
            if into is not None:
                allowed[:, into] = 1
            paid = (allowed.sum(axis=1) - 1) * cost[rows]
            new, likely, _ = self.part(rows).maximise(allowed, best[rows] + paid)
            better = likely - paid > best[rows]
            at = rows[better]
            best[at], found[at] = (likely - paid)[better], new[better]

        several = has & (many > 1)[:, None]
        for out in np.flatnonzero(several.any(axis=0)):
            attempt(np.flatnonzero(several[:, out]), out, None)
        for into in np.flatnonzero(((gain > TOLERANCE) & ~has).any(axis=0)):
            comes = (gain[:, into] > TOLERANCE) & ~has[:, into]
            rows = np.flatnonzero(comes & (gain[:, into] > cost))
            if len(rows):
                attempt(rows, None, into)
            for out in np.flatnonzero((several & comes[:, None]).any(axis=0)):
                attempt(np.flatnonzero(several[:, out] & comes), out, into)
        return found, best

    def maximise(self, allowed: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Proportions of the allowed languages, log likelihood and its bound, by expectation-maximisation.

        A row is done when the bound is within TOLERANCE of what is reached, or not above ``least``.
        """
        share = allowed / allowed.sum(axis=1, keepdims=True)
        likely, most = np.full(len(share), -np.inf), np.full(len(share), np.inf)
        rows, data = np.arange(len(share)), self
        for k in range(ROUNDS):
            if not len(rows):
                break
            slopes, total = data.slopes(share[rows])
            if (k + 1) % CHECK == 0 or k == ROUNDS - 1:
                likely[rows] = data.sums(data.count * np.log(total))
                most[rows] = data.bound(likely[rows], slopes, allowed[rows])
                going = np.flatnonzero((most[rows] > least[rows]) & (most[rows] - likely[rows] > TOLERANCE))
                data, rows, slopes = data.part(going), rows[going], slopes[going]
            share[rows] *= slopes
        return share, likely, most


def fit(counts: DataFrame, smoothing: float = 0.5) -> LanguageModel:
    """From the summed counts: BUCKETS numbers for each language come to the driver."""
    table = counts.toArrow()
    names = sorted(set(table["lang"].to_pylist()))
    total = np.zeros((BUCKETS, len(names)))
    place = {name: k for k, name in enumerate(names)}
    total[table["bucket"].to_numpy(), [place[x] for x in table["lang"].to_pylist()]] = table["count"].to_numpy()
    total += smoothing
    return LanguageModel(names, total / total.sum(axis=0) if names else total)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and ``mixture`` (language to proportion) of every whole text.

    lang_pred has the largest proportion, which is the score; ``und`` with score 0 where the
    text is null or has no letter, or no language was learned.
    """
    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in K.blocks(batch.column("text")):
            row, bucket, count, has = counted(block)
            if model.names:
                share = model.infer(row, bucket, count, block.n)
            else:
                share, has = np.zeros((block.n, 1)), np.zeros(block.n, dtype=bool)
            top = share.argmax(axis=1)
            names = [model.names[k] if ok else UNKNOWN for k, ok in zip(top, has, strict=True)]
            mixture = [[(model.names[k], float(s[k])) for k in np.flatnonzero(s > 0)] if ok else []
                       for s, ok in zip(share, has, strict=True)]
            yield {"doc_id": batch.column("doc_id")[block.rows], "lang_pred": pa.array(names, pa.string()),
                   "score": np.where(has, np.clip(share.max(axis=1), 0, 1), 0.0),
                   "mixture": pa.array(mixture, pa.map_(pa.string(), pa.float64()))}

    return K.map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), function,
                         T.StructType.fromDDL("doc_id long, lang_pred string, score double, "
                                              "mixture map<string, double>"))
