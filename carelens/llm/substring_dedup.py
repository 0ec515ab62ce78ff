"""Repeated passages by content-defined chunking.

A gear rolling hash over the last 32 bytes cuts each text where it has zeros in its leading
bits, so the cuts move with the content: after an insertion the chunks are soon the same again.
Chunks are compared by digest, in pairs of neighbours, so that a passage is a run of chunks
that follow each other elsewhere too, not lines that are common each for itself.  What runs of
repeated pairs cover is then widened at both ends, byte by byte, as far as the text there
equals that around the same pair in another document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm import kernels as K
from carelens.llm.joins import rows_of
from carelens.session import cut_lineage

#: Bytes of a chunk: at least, at most, and zero bits at a cut (so 16 more on average).
LEAST, MOST, ZEROS = 16, 128, 4
#: Bytes the rolling hash depends on, and how far a run is widened at most.
ROLL, AROUND = 32, 512
#: Words of a passage, at least.
MIN_WORDS = 50


def gear() -> np.ndarray:
    return (K.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) \
        .astype(np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """For each byte, the sum of the gear numbers of the last 32 bytes, each doubled by its age."""
    h = gear()[data]
    with np.errstate(over="ignore"):
        for step in (1, 2, 4, 8, 16):
            older = h[:-step] << np.uint32(step)
            h = h.copy()
            h[step:] += older
    return h


def chunk_ends(block: K.Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and end (in the block) of every chunk.

    Where no cut comes in time, as in a word said over and over, the largest hash among the
    places allowed cuts, so that such stretches are cut alike too.
    """
    h = rolling(block.data)
    may = np.flatnonzero(h >> np.uint32(32 - ZEROS) == 0) + 1
    upto = np.searchsorted(may, block.bounds, side="right")
    may = may.tolist()
    ends, rows = [], []
    bounds = block.bounds.tolist()

    def forced(begin: int, last: int) -> int:
        low = max(last + LEAST, begin + ROLL)
        return low + int(h[low - 1 : last + MOST].argmax())

    for row in range(block.n):
        begin, end = bounds[row], bounds[row + 1]
        last, first = begin, len(ends)
        for cut in may[upto[row] : upto[row + 1]]:
            if cut - begin < ROLL or cut - last < LEAST:
                continue
            while cut - last > MOST:
                last = forced(begin, last)
                ends.append(last)
            if cut - last >= LEAST:
                ends.append(cut)
                last = cut
        while end - last > MOST:
            last = forced(begin, last)
            ends.append(last)
        if end > last:
            ends.append(end)
        rows.append(len(ends) - first)
    return np.repeat(np.arange(block.n), rows), np.array(ends, dtype=np.int64)


def chunks(block: K.Block) -> tuple[np.ndarray, ...]:
    """Row, begin, end (in the row) and digest of every chunk."""
    row, end = chunk_ends(block)
    begin = np.concatenate(([0], end[:-1])) if len(end) else end
    first = np.ones(len(row), dtype=bool)
    first[1:] = row[1:] != row[:-1]
    begin[first] = block.bounds[row[first]]
    return row, begin - block.bounds[row], end - block.bounds[row], K.span_hash(block.data, begin, end)


PAIRS = "key long, doc_id long, digest long, begin int, finish int"


def _pairs(docs: DataFrame) -> DataFrame:
    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in K.blocks(batch.column("text")):
            row, begin, end, digest = chunks(block)
            next_too = np.flatnonzero(row[1:] == row[:-1])
            with np.errstate(over="ignore"):
                both = K.mix(digest[next_too] * np.uint64(3) + digest[next_too + 1])
            at = pa.array(row[next_too] + block.first)
            yield {"key": batch.column("key").take(at), "doc_id": batch.column("doc_id").take(at),
                   "digest": K.signed(both), "begin": begin[next_too].astype(np.int32),
                   "finish": end[next_too + 1].astype(np.int32)}

    return K.map_batches(docs, function, T.StructType.fromDDL(PAIRS))


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents by a hash of id and text: repeated rows are one document."""
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


#: Texts to widen by: one that has a run's edge pair, and the one of the least id that has the
#: edge pair of its first or last held stretch.
PARTNERS = ("left", "right", "left_first", "right_first")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """Runs of chunk pairs that other documents have too, with other documents at each end.

    ``held``: the stretches whose pairs all stand in documents with smaller ids.
    """
    pairs = _pairs(_keyed(docs))
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "key"))
    repeated = pairs.groupBy("digest").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.min(named).alias("least")).where("low <> high")
    shared = cut_lineage(
        pairs.join(repeated, "digest").select(
            "key", "doc_id", "digest", "begin", "finish",
            F.expr("if(low = key, high, low)").alias("other"),
            F.expr("coalesce(least.doc_id < doc_id, least is not null)").alias("held"), "least.key")
        .toDF("key", "doc_id", "digest", "begin", "finish", "other", "held", "first_key"))
    by = Window.partitionBy("key").orderBy("begin", "finish")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    upto, held_upto = F.max("finish").over(before), F.max(F.when(F.col("held"), F.col("finish"))).over(before)
    # A next pair shares a chunk with the last, so it begins before the last one's end.
    starts = F.when(upto.isNull() | (F.col("begin") >= upto), 1).otherwise(0)
    held_starts = F.when(F.col("held") & (held_upto.isNull() | (F.col("begin") >= held_upto)), 1).otherwise(0)
    numbered = shared.withColumn("starts", starts).withColumn("held_starts", held_starts) \
        .withColumn("run", F.sum("starts").over(by)) \
        .withColumn("stretch", F.when(F.col("held"), F.sum("held_starts").over(by)).otherwise(0))
    edge = F.struct("digest", "other", "first_key")
    held = F.col("stretch") > 0
    runs = cut_lineage(
        numbered.groupBy("key", "run", "stretch").agg(
            F.first("doc_id").alias("doc_id"), F.min("begin").alias("begin"), F.max("finish").alias("finish"),
            F.min_by(edge, "begin").alias("left"), F.max_by(edge, "finish").alias("right"))
        .groupBy("key", "run").agg(
            F.first("doc_id").alias("doc_id"), F.min("begin").alias("own_begin"), F.max("finish").alias("own_finish"),
            F.min_by("left", "begin").alias("left"), F.max_by("right", "finish").alias("right"),
            F.min_by("left", F.when(held, F.col("begin"))).alias("left_first"),
            F.max_by("right", F.when(held, F.col("finish"))).alias("right_first"),
            F.array_sort(F.collect_list(F.when(held, F.struct("begin", "finish")))).alias("held"))
        .withColumnsRenamed({"own_begin": "begin", "own_finish": "finish"})
        .withColumn("run_id", F.monotonically_increasing_id()))
    places = shared.groupBy("key", "digest").agg(F.min("begin").alias("begin"), F.min("finish").alias("finish"))
    sides = runs.select("run_id", F.explode(F.array(*(
        F.struct(F.lit(k).alias("side"), F.col(f"{k}.digest").alias("digest"),
                 F.col(f"{k}.{'first_key' if 'first' in k else 'other'}").alias("key"))
        for k in PARTNERS))).alias("edge")).select("run_id", "edge.*").where("key is not null")
    at = sides.join(places, ["key", "digest"]).groupBy("run_id").agg(
        *(F.max(F.when(F.col("side") == k, F.struct(
            "key", F.col("begin" if k.startswith("left") else "finish").alias("place")))).alias(f"{k}_at")
          for k in PARTNERS))
    return runs.select("run_id", "key", "doc_id", "begin", "finish", "held").join(at, "run_id")


SPANS = ("run_id long, doc_id long, begin int, finish int, n_words int, other_doc_id long, first boolean, "
         "passage string, held array<struct<begin: int, finish: int>>")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, begin, finish (bytes), n_words, other_doc_id, first, passage, held: a row for each
    passage of ``min_words`` whole words or more whose parts stand, one after another, in other
    documents too.  ``other_doc_id`` has its beginning; most often it has all of it.

    ``first``: a part of it stands in no document with a smaller id, so that part is the one
    to keep.  ``held``: the spans that documents with smaller ids have, part after part: all
    of the passage that was compared with them where it is not first, else stretches of
    ``min_words`` or more.  A null id is the largest.  Repeats within
    one document, and between rows of equal id and text, do not count.  Null and empty texts
    have no passages.  A run is widened by AROUND bytes at most on either side.
    """
    runs = cut_lineage(repeated_runs(docs))
    before = lambda place: F.greatest(place - AROUND, F.lit(0)).alias("from")
    asks = [F.struct(F.lit("own").alias("kind"), F.col("key"), before(F.col("begin")),
                     (F.col("finish") + AROUND).alias("to"))]
    for k in PARTNERS:
        place = F.col(f"{k}_at.place")
        span = (before(place), place.alias("to")) if k.startswith("left") else (
            place.alias("from"), (place + AROUND).alias("to"))
        asks.append(F.struct(F.lit(k).alias("kind"), F.col(f"{k}_at.key").alias("key"), *span))
    asked = runs.select("run_id", F.explode(F.array(*asks)).alias("ask")).select("run_id", "ask.*") \
        .where("key is not null")
    texts = rows_of(_keyed(docs), asked.select("key"), "key")
    part = F.substring(F.col("text").cast("binary"), F.col("from") + 1, F.col("to") - F.col("from"))
    got = texts.join(asked, "key").select("run_id", "kind", "doc_id", part.alias("bytes"))
    wide = got.groupBy("run_id").agg(
        *(F.max(F.when(F.col("kind") == k, F.col("bytes"))).alias(k) for k in ("own", *PARTNERS)),
        *(F.max(F.when(F.col("kind") == k, F.col("doc_id"))).alias(f"{k}_id") for k in PARTNERS))
    rows = runs.select("run_id", "doc_id", "begin", "finish", "held").join(wide, "run_id")
    return _widen(rows, min_words).drop("run_id")


def _common_end(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = np.frombuffer(a, np.uint8)[len(a) - n :][::-1] != np.frombuffer(b, np.uint8)[len(b) - n :][::-1]
    return int(x.argmax()) if x.any() else n


def _common_start(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = np.frombuffer(a, np.uint8)[:n] != np.frombuffer(b, np.uint8)[:n]
    return int(x.argmax()) if x.any() else n


def whole_words(own: bytes, begin: int, end: int) -> tuple[int, int, int]:
    """Count, begin and end of the words of ``own`` that lie in the span as a whole."""
    block = K.Block(0, np.frombuffer(own, np.uint8), np.array([0, len(own)]))
    words = K.Words(block, K.white_words(), lower=False)
    inside = np.flatnonzero((words.start >= begin) & (words.end <= end))
    if not len(inside):
        return 0, begin, begin
    return len(inside), int(words.start[inside[0]]), int(words.end[inside[-1]])


def _widen(rows: DataFrame, min_words: int) -> DataFrame:
    schema = T.StructType.fromDDL(SPANS)
    names = schema.names

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        out = []
        for r in batch.to_pylist():
            from_ = max(r["begin"] - AROUND, 0)
            own = r["own"]
            begin, end = r["begin"] - from_, r["finish"] - from_
            smaller = lambda k: r[f"{k}_id"] is not None and (  # noqa: B023, E731
                r["doc_id"] is None or r[f"{k}_id"] < r["doc_id"])
            left, right = _common_end(own[:begin], r["left"] or b""), _common_start(own[end:], r["right"] or b"")
            spans = [[x["begin"] - from_, x["finish"] - from_] for x in r["held"]]
            other = r["left_id"]
            if spans:
                a, z = spans[0][0], spans[-1][1]
                spans[0][0] -= _common_end(own[:a], r["left_first"] or b"")
                spans[-1][1] += _common_start(own[z:], r["right_first"] or b"")
                if a == begin and smaller("left"):
                    spans[0][0] = min(spans[0][0], begin - left)
                if z == end and smaller("right"):
                    spans[-1][1] = max(spans[-1][1], end + right)
                if spans[0][0] <= begin - left:
                    other = r["left_first_id"]
            first = not (len(spans) == 1 and spans[0][0] <= begin and spans[0][1] >= end)
            begin = min([begin - left, *(a for a, _ in spans)])
            end = max([end + right, *(z for _, z in spans)])
            n, begin, end = whole_words(own, begin, end)
            held = []
            for a, z in spans:
                m, a, z = whole_words(own, a, z)
                if m >= (min_words if first else 1):
                    held.append({"begin": from_ + a, "finish": from_ + z})
            if n >= min_words:
                out.append((r["run_id"], r["doc_id"], from_ + begin, from_ + end, n, other, first,
                            own[begin:end].decode("utf-8", "replace"), held))
        yield dict(zip(names, zip(*out, strict=True) if out else [[]] * len(names), strict=True))

    return K.map_batches(rows, function, schema)


def remove_repeats(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` with what documents of smaller ids hold of the passages cut out of their texts.

    Other columns stay; rows of one doc_id have to have one text.
    """
    cut = passages.groupBy(F.col("doc_id").alias("cut_doc")).agg(
        F.array_sort(F.flatten(F.collect_list("held"))).alias("cut_spans"))
    kept = docs.columns
    joined = docs.select(F.struct(*kept).alias("row"), "doc_id", F.col("text").cast("binary").alias("bytes")).join(
        cut, F.col("doc_id") == F.col("cut_doc"), "left")
    rest = F.expr("""
        aggregate(coalesce(cut_spans, array()), struct(cast(0 as int) as at, cast('' as binary) as kept),
          (a, s) -> struct(greatest(a.at, s.finish) as at,
            concat(a.kept, substring(bytes, a.at + 1, greatest(s.begin - a.at, 0))) as kept),
          a -> cast(concat(a.kept, substring(bytes, a.at + 1, length(bytes))) as string))""")
    return joined.select(F.when(F.col("cut_spans").isNull(), F.col("row")).otherwise(
        F.col("row").withField("text", rest)).alias("row")).select("row.*")
