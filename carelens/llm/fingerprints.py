"""Document fingerprints by locally consistent parsing.

A text is parsed level by level.  On each level neighbours that are equal are first one symbol
with a count; then deterministic coin tossing shortens the names of the symbols to a few
colours that differ between neighbours, and a phrase begins wherever the colour is a local
maximum.  The name of a phrase is a hash of its symbols, and the phrases are the symbols of the
next level.  Whether a phrase begins depends on a few neighbours only, so equal substrings are
parsed alike wherever they stand, but for their ends.

The fingerprint holds the length of the text, the name of its last phrase, and the least names
among the phrases of a middle level, a sample that all texts draw in the same way.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm import kernels as K

#: Rounds of coin tossing: 64 bits, then at most 7, 4, 3 and 3 bits are left (6 colours).
TOSSES = 4
#: Names that a fingerprint holds at most, of 32 bits each.
HELD = 64
#: Level whose phrases are compared; a phrase there is about 30 characters long.
LEVEL = 3
_U = np.uint64


def _place_and_bit(name: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Twice the lowest place in which a name differs from its left neighbour, plus its bit there."""
    with np.errstate(over="ignore"):
        differ = name ^ left
        place = np.bitwise_count((differ - name.dtype.type(1)) & ~differ)
    return (place << np.uint8(1)) | ((name >> place.astype(name.dtype)) & name.dtype.type(1)).astype(np.uint8)


@functools.cache
def _small_tosses() -> np.ndarray:
    """The same for all pairs of names under 128: colour by 128 * left + name."""
    left, name = np.divmod(np.arange(1 << 14), 128)
    out = _place_and_bit(name.astype(np.uint8), left.astype(np.uint8))
    out[left == name] = 0
    return out


def _toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Colours that differ between neighbours, from names that do; ``first``: begins a text."""
    starts = np.flatnonzero(first)
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[starts] = ~names[starts]  # a beginning differs from nothing in its lowest bit
    colour = _place_and_bit(names, left)
    for _ in range(TOSSES - 1):
        pair = np.empty(len(colour), dtype=np.uint16)
        pair[1:] = colour[:-1]
        pair[starts] = colour[starts] ^ 1
        pair <<= np.uint16(7)
        pair |= colour
        colour = _small_tosses()[pair]
    return colour


def _phrases(names: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the next level, and how many each text has."""
    n = len(count)
    text = np.repeat(np.arange(n), count)
    new = np.ones(len(names), dtype=bool)  # runs of equal names
    new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(names)))
    with np.errstate(over="ignore"):
        names = np.where(length > 1, K.mix(names[begin] + K.mix(length.astype(_U))), names[begin])
        text = text[begin]
        # Two runs side by side may share a name by their counts only if they share the symbol,
        # and then they would be one run.
        first = np.ones(len(names), dtype=bool)
        first[1:] = text[1:] != text[:-1]
        last = np.append(first[1:], True)
        colour = _toss(names, first)
        top = np.zeros(len(names), dtype=bool)
        top[1:-1] = (colour[1:-1] > colour[:-2]) & (colour[1:-1] >= colour[2:])
        top &= ~first & ~last
        cut = np.flatnonzero(top | first)
        place = np.arange(len(names)) - np.repeat(cut, np.diff(np.append(cut, len(names))))
        each = K.mix(names * _U(3) + K.mix(np.arange(place.max() + 1, dtype=_U))[place])
        sums = np.concatenate((np.zeros(1, _U), np.cumsum(each)))
        ends = np.append(cut[1:], len(names))
        out = K.mix(sums[ends] - sums[cut])
    return out, np.bincount(text[cut], minlength=n)


def fingerprints(points: np.ndarray, count: np.ndarray) -> list[bytes]:
    """A fingerprint for each text, from the code points of all one after another."""
    n = len(count)
    names, left = K.mix(points.astype(_U) + _U(1)), count.copy()
    root = np.zeros(n, dtype=_U)
    held: list[np.ndarray] = [np.zeros(0, np.uint32)] * n
    level = 0
    while len(names):
        # Phrases of the chosen level, or of the last that a short text has.
        upto = np.concatenate(([0], np.cumsum(left)))
        done = left == 1
        root[done] = names[upto[:-1][done]]
        chosen = np.flatnonzero((left > 0) & ((level == LEVEL) | (done & (level < LEVEL))))
        for k in chosen.tolist():
            least = np.unique(K.mix(names[upto[k] : upto[k + 1]]) >> _U(32)).astype(np.uint32)
            held[k] = least[:HELD]
        keep = np.repeat(~done, left)
        names, left = names[keep], np.where(done, 0, left)
        if len(names):
            names, left = _phrases(names, left)
        level += 1
    return [struct.pack(">QQ", int(c), int(r)) + h.astype(">u4").tobytes()
            for c, r, h in zip(count, root, held, strict=True)]


def likeness(a: bytes, b: bytes) -> float:
    """Estimated share of phrases that two texts have in common among those of either.

    1 for equal fingerprints; it compares the least names of both sets together.
    """
    if a == b:
        return 1.0
    x, y = (np.frombuffer(v[16:], dtype=">u4") for v in (a, b))
    both = np.union1d(x, y)
    if len(x) == HELD or len(y) == HELD:
        both = both[:HELD]
    if not len(both):
        return 0.0
    return float(np.isin(both, np.intersect1d(x, y)).sum() / len(both))


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def of_texts(texts: list[str]) -> list[bytes]:
    points = [points_of(t) for t in texts]
    return fingerprints(np.concatenate(points) if points else np.zeros(0, np.uint32),
                        np.array([len(p) for p in points], dtype=np.int64))


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint, in hex, of every row; null text counts as empty."""

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in K.blocks(batch.column("text")):
            texts = batch.column("text")[block.rows].fill_null("").to_pylist()
            yield {"doc_id": batch.column("doc_id")[block.rows],
                   "fingerprint": pa.array([f.hex() for f in of_texts(texts)])}

    return K.map_batches(docs.select("doc_id", F.col("text").cast("string")), function,
                         T.StructType.fromDDL("doc_id long, fingerprint string"))


def edited(text: str, after: str) -> str:
    """The last half of ``text``, rounded down, replaced by the beginning of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double")


#: Rows of a range of ids, at most about; smaller inputs get one range for each RANGE_LEAST, up to RANGES.
RANGE_ROWS, RANGE_LEAST, RANGES = 500_000, 400, 4000


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    The next document is that of the next larger doc_id, the first one's after the last; rows
    of one doc_id follow each other by text, and a null doc_id comes first.  Documents are cut
    into ranges of ids of bounded rows, sorted in each; the first row of each range
    is also sent to the range before as the end of it.  A document that is alone is its own next.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = rows.select("doc_id")
    total = ids.count()
    if not total:
        return spark.createDataFrame([], COMPARED)
    ranges = max(1, -(-total // RANGE_ROWS), min(RANGES, total // RANGE_LEAST))
    cuts = sorted({int(c) for c in ids.approxQuantile(
        "doc_id", [k / ranges for k in range(1, ranges)], 0.1 / ranges)}) if ranges > 1 else []
    # The range of an id: how many cuts are at most as large; a null id is in the first.
    at = _range(cuts)
    placed = rows.withColumn("range", at)
    first_ids = placed.groupBy("range").agg(
        F.min_by("doc_id", F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first_id"))
    order = [r.range for r in first_ids.select("range").orderBy("range").collect()]
    before = {r: order[k - 1] for k, r in enumerate(order)}
    turn = spark.createDataFrame(list(before.items()), "own int, before int")
    first_ids = first_ids.join(F.broadcast(turn), F.col("range") == F.col("own")).select(
        F.col("before"), F.col("first_id"))
    leading = placed.select("doc_id", "text").join(
        F.broadcast(first_ids), F.col("doc_id").eqNullSafe(F.col("first_id")), "inner") \
        .groupBy("before", "doc_id").agg(F.min("text").alias("text")).select(
            "doc_id", "text", F.col("before").alias("range"), F.lit(True).alias("end"))
    dealt = placed.select("doc_id", "text", "range", F.lit(False).alias("end")).union(leading)
    lined = dealt.repartition(max(1, len(order)), "range").sortWithinPartitions(
        "range", "end", F.col("doc_id").asc_nulls_first(), "text")
    fields = T.StructType.fromDDL(COMPARED).fields
    schema = pa.schema([(f.name, K.arrow_type(f.dataType)) for f in fields])
    return lined.mapInArrow(lambda batches: _walk(batches, schema), COMPARED)


def _range(cuts: list[int]) -> Column:
    """Binary search in SQL: as many steps as the number of cuts has binary digits."""
    if not cuts:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    held = F.array(*(F.lit(c).cast("long") for c in cuts))

    def further(low: Column, step: Column) -> Column:
        fits = (low + step <= len(cuts)) & (
            F.element_at(held, F.least(low + step, F.lit(len(cuts)))) <= F.col("doc_id"))
        return F.when(fits, low + step).otherwise(low)

    return F.aggregate(F.array(*(F.lit(s) for s in steps)), F.lit(0), further)


def _walk(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pairs of rows that follow each other in a range; the fingerprint of each is made once."""
    import hashlib

    last: tuple | None = None  # (range, doc_id, text, fingerprint)
    for batch in batches:
        texts_all = batch.column("text")
        for block in K.blocks(texts_all):
            texts = texts_all[block.rows].to_pylist()
            ids = batch.column("doc_id")[block.rows].to_pylist()
            ranges = batch.column("range")[block.rows].to_pylist()
            prints = of_texts(texts)
            line = ([last] if last else []) + list(zip(ranges, ids, texts, prints, strict=True))
            pairs = [(a, b) for a, b in zip(line, line[1:], strict=False) if a[0] == b[0]]
            changed = [edited(a[2], b[2]) for a, b in pairs]
            changed_prints = of_texts(changed)
            out = [(a[1], len(a[2]), hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest(), a[3].hex(),
                    p.hex(), likeness(a[3], p), likeness(a[3], b[3]))
                   for (a, b), t, p in zip(pairs, changed, changed_prints, strict=True)]
            last = line[-1]
            columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
