"""Benchmark decontamination with a distributed positional inverted index.

The index holds, for the terms that matter, where each stands in every training document:
(term, document, position).  Terms that matter are the rarest of each benchmark window, by
their counts in the whole corpus.  A window stands in a document only where the lists of its
rarest terms, each shifted back by the term's place, meet in one position; where they do, the
words themselves are compared.  Documents, postings and alignments stay in Spark tables; only
the words of the benchmark, block by block, reach the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm import kernels as K
from carelens.llm.joins import content_key, rows_of
from carelens.session import cut_lineage

#: Consecutive words that have to be equal.
WINDOW = 13
#: Terms whose lists are intersected for each window.
SEEDS = 2
#: Benchmark words held at once, 8 bytes each in a task; a larger benchmark goes in blocks.
BLOCK_WORDS = 1 << 21
#: When a document counts as contaminated.
CONTAMINATED = "n_hit > 0 and 20 * n_hit >= n_words"


def _word_lists(df: DataFrame, column: str, keep: str) -> DataFrame:
    """``keep`` and ``words``: the hashes of the words of each row's text."""
    schema = T.StructType([df.schema[keep], T.StructField("words", T.ArrayType(T.LongType()))])

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in K.blocks(batch.column(column)):
            words = K.Words(block, K.alnum_words())
            yield {keep: batch.column(keep)[block.rows],
                   "words": K.list_array(K.signed(words.hash), words.count)}

    return K.map_batches(df.select(keep, column), function, schema)


def _term_counts(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """term, times: how often the sorted ``terms`` stand in all documents."""

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        times, table = np.zeros(len(terms), dtype=np.int64), K.Lookup(terms)
        for block in K.blocks(batch.column("text")):
            at, found = table.find(K.Words(block, K.alnum_words()).hash)
            times += np.bincount(at[found], minlength=len(terms))
        some = np.flatnonzero(times)
        yield {"term": K.signed(terms[some]), "times": times[some]}

    counted = K.map_batches(docs.select("text"), function, T.StructType.fromDDL("term long, times long"))
    return counted.groupBy("term").agg(F.sum("times").alias("times"))


INDEXED = "doc_id long, n_words long, digest long, postings array<struct<term: long, position: int>>"


def _index(docs: DataFrame, terms: np.ndarray, carried: Sequence[str] = ()) -> DataFrame:
    """A row for each document: its words, a digest of them, the postings of ``terms``, what is carried."""

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        table = K.Lookup(terms)
        for block in K.blocks(batch.column("text")):
            words = K.Words(block, K.alnum_words())
            at, found = table.find(words.hash)
            hit = np.flatnonzero(found)
            place = hit - words.upto[:-1][words.row[hit]]
            each = pa.StructArray.from_arrays(
                [pa.array(K.signed(terms[at[hit]])), pa.array(place.astype(np.int32))], ["term", "position"])
            bounds = np.zeros(block.n + 1, dtype=np.int32)
            np.cumsum(np.bincount(words.row[hit], minlength=block.n), out=bounds[1:])
            yield {"doc_id": batch.column("doc_id")[block.rows], "n_words": words.count,
                   "digest": _digest(words),
                   "postings": pa.ListArray.from_arrays(pa.array(bounds), each)} | {
                       c: batch.column(c)[block.rows] for c in carried}

    schema = T.StructType(T.StructType.fromDDL(INDEXED).fields + [docs.schema[c] for c in carried])
    return K.map_batches(docs, function, schema)


def _digest(words: K.Words) -> np.ndarray:
    """Of each row's words in their order."""
    place = np.arange(len(words.row)) - words.upto[:-1][words.row]
    with np.errstate(over="ignore"):
        each = K.mix(words.hash + K.mix(place.astype(np.uint64)))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(each)))
        return K.signed(sums[words.upto[1:]] - sums[words.upto[:-1]])


class PositionalIndex:
    """Postings of the benchmark's rarest terms, and what they match."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, seeds: int = SEEDS,
                 carried: Sequence[str] = ()):
        """``carried``: further columns of ``docs`` that ``rows`` keeps."""
        self.window, self.carried = window, carried
        own = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
        self.docs, self.whole = docs.select(*own), docs.select(*own, *carried)
        texts = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string"))
        self.items = cut_lineage(
            _word_lists(texts, "text", "item").where("size(words) > 0")
            .withColumn("item_row", F.monotonically_increasing_id()))
        blocks = self._blocks()
        parts = [self._seeds(block, seeds) for block in blocks]
        self.seeds = parts[0]
        for part in parts[1:]:
            self.seeds = self.seeds.union(part)
        self.seeds = cut_lineage(self.seeds)
        self.rows, self.postings = self._stored_postings(blocks)

    def _blocks(self) -> list[DataFrame]:
        """The benchmark in blocks of bounded words."""
        total = self.items.agg(F.sum(F.size("words"))).first()[0] or 0
        n = max(1, -(-total // BLOCK_WORDS))
        block = F.pmod(F.xxhash64("item_row"), F.lit(n))
        return [self.items.where(block == k) for k in range(n)]

    def _places(self, items: DataFrame) -> DataFrame:
        return items.select("item_row", F.size("words").alias("length"),
                            F.posexplode("words").alias("place", "term"))

    def _seeds(self, items: DataFrame, seeds: int) -> DataFrame:
        """item_row, place, term, needed: the rarest places of every window of the items."""
        places = self._places(items)
        terms = np.unique(K.unsigned(np.array(
            [r.term for r in places.select("term").distinct().collect()], dtype=np.int64)))
        times = _term_counts(self.docs, terms)
        counted = places.join(times, "term", "left").withColumn("times", F.coalesce("times", F.lit(0)))
        # place p stands in the windows that begin at p - window + 1 to p, within the item
        begins = F.explode(F.expr(
            f"sequence(greatest(0, place - {self.window} + 1), least(place, greatest(0, length - {self.window})))"))
        rank = F.row_number().over(Window.partitionBy("item_row", "begin").orderBy("times", "place"))
        ranked = counted.withColumn("begin", begins).withColumn("rank", rank)
        needed = F.least(F.lit(seeds), F.least("length", F.lit(self.window)))
        return ranked.where(f"rank <= {seeds}").select(
            "item_row", "place", "term", needed.alias("needed")).distinct()

    def _stored_postings(self, blocks: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
        if len(blocks) == 1:
            terms = self.seeds.select("term").distinct().collect()
            stored = cut_lineage(_index(self.whole, np.unique(K.unsigned(
                np.array([r.term for r in terms], dtype=np.int64))), self.carried).withColumn(
                    "row_id", F.monotonically_increasing_id()))
            rows = stored
        else:
            stored = None
            for items in blocks:
                own = self.seeds.join(items.select("item_row"), "item_row", "left_semi")
                terms = np.unique(K.unsigned(np.array(
                    [r.term for r in own.select("term").distinct().collect()], dtype=np.int64)))
                part = cut_lineage(_index(self.whole, terms, self.carried).withColumn(
                    "row_id", F.monotonically_increasing_id()))
                rows = part if stored is None else rows
                stored = part if stored is None else stored.unionByName(part)
        postings = stored.select("doc_id", "digest", "n_words", F.explode("postings").alias("posting")) \
            .select("doc_id", "digest", "n_words", "posting.*").distinct()
        return rows.select("row_id", "doc_id", "digest", "n_words", *self.carried), postings

    def alignments(self) -> DataFrame:
        """doc_id, digest, item_row, shift: where the shifted lists of the rarest terms meet."""
        met = self.postings.join(self.seeds, "term")
        return met.groupBy("doc_id", "digest", "item_row", (F.col("position") - F.col("place")).alias("shift"),
                           "needed").agg(F.count(F.lit(1)).alias("lists")).where("lists >= needed") \
            .select("doc_id", "digest", "item_row", "shift")

    def phrases(self) -> DataFrame:
        """doc_id, digest, n_hit and items: words that exact windows cover, and their items."""
        wanted = cut_lineage(self.alignments())
        docs = rows_of(self.docs, wanted.select("doc_id"))
        words = _digested(docs).dropDuplicates(["doc_id", "digest"])
        listed = wanted.join(self.items.select("item_row", "item", F.col("words").alias("phrase")), "item_row") \
            .groupBy("doc_id", "digest").agg(F.collect_list(F.struct("item", "phrase", "shift")).alias("found"))
        both = listed.withColumnsRenamed({"doc_id": "of_doc", "digest": "of_digest"}).join(
            words, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("digest") == F.col("of_digest")))
        return _compare(both.select("doc_id", "digest", "words", "found"), self.window)

    def proximity(self, terms: int = 3, within: int = 20) -> DataFrame:
        """doc_id, item, first, last: a window's rarest terms near each other, in any order.

        Of every window of an item (of ``terms`` words at least) the ``terms`` indexed terms with the fewest postings are
        taken (a term is counted once; all, if the window has fewer).  They match where all stand
        less than ``within`` words from a place of the rarest; ``first`` and ``last`` are their
        outermost places there.  With ``within`` of at least the window, a document that holds a
        window matches its item.  A row for each such place, once for all windows that take
        the same terms.  Places meet by blocks of ``within`` words, so a repeated word
        meets its neighbours alone.
        """
        times = self.postings.groupBy("term").agg(F.count(F.lit(1)).alias("times"))
        lengths = self.items.select("item_row", F.size("words").alias("length"))
        span = max(self.window, terms)
        begins = F.explode(F.expr(
            f"sequence(greatest(0, place - {span} + 1), least(place, greatest(0, length - {span})))"))
        of_window = self.seeds.select("item_row", "place", "term").join(lengths, "item_row") \
            .select("item_row", "term", begins.alias("begin")).distinct() \
            .join(times, "term", "left").withColumn("times", F.coalesce("times", F.lit(0)))
        # a window holds few terms: its list is as long as the window at most
        sets = of_window.groupBy("item_row", "begin").agg(
            F.slice(F.array_sort(F.collect_list(F.struct("times", "term"))), 1, terms).alias("ranked")) \
            .select("item_row", F.col("ranked.term").alias("ranked")).distinct()
        chosen = sets.select("item_row", "ranked", F.posexplode("ranked").alias("rank", "term"))
        placed = cut_lineage(self.postings.join(chosen, "term").select(
            "doc_id", "digest", "item_row", "ranked", "rank", "position",
            F.floor(F.col("position") / within).alias("block")))
        key = ["digest", "item_row", "ranked", "block"]
        rarest = placed.where("rank = 0").select(
            F.col("doc_id").alias("of_doc"), "digest", "item_row", "ranked", F.col("position").alias("at"),
            F.explode(F.array(*[F.col("block") + k for k in (-1, 0, 1)])).alias("block"))
        near = rarest.join(placed, key).where(
            F.col("of_doc").eqNullSafe(F.col("doc_id")) & F.expr(f"abs(position - at) < {within}"))
        return near.groupBy("doc_id", "digest", "item_row", "ranked", "at").agg(
            F.countDistinct("rank").alias("met"),
            F.min("position").alias("first"), F.max("position").alias("last")) \
            .where("met = size(ranked)").join(self.items.select("item_row", "item"), "item_row") \
            .select("doc_id", "digest", "item", "at", "first", "last").distinct() \
            .select("doc_id", "item", "first", "last")

    def report(self) -> DataFrame:
        """A row for each document: n_words, n_hit and the sorted distinct ``items``."""
        hits = self.phrases().withColumnsRenamed({"doc_id": "of_doc", "digest": "of_digest"})
        rows = self.rows.join(hits, F.col("doc_id").eqNullSafe(F.col("of_doc"))
                              & (F.col("digest") == F.col("of_digest")), "left")
        return rows.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                           F.coalesce("items", F.array().cast("array<string>")).alias("items"), *self.carried)


def _digested(docs: DataFrame) -> DataFrame:
    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in K.blocks(batch.column("text")):
            words = K.Words(block, K.alnum_words())
            yield {"doc_id": batch.column("doc_id")[block.rows], "digest": _digest(words),
                   "words": K.list_array(K.signed(words.hash), words.count)}

    return K.map_batches(docs.select("doc_id", "text"), function,
                         T.StructType.fromDDL("doc_id long, digest long, words array<long>"))


def covered(words: np.ndarray, phrase: np.ndarray, shift: int, window: int) -> np.ndarray:
    """Places in ``words`` that a window of ``phrase`` covers when it begins at ``shift``."""
    size = min(window, len(phrase))
    low, high = max(0, shift), min(len(words), shift + len(phrase))
    if high - low < size:
        return np.zeros(0, dtype=np.int64)
    equal = words[low:high] == phrase[low - shift : high - shift]
    run = np.concatenate(([0], np.cumsum(equal)))
    whole = np.flatnonzero(run[size:] - run[:-size] == size)
    marks = np.zeros(high - low + 1, dtype=np.int64)
    np.add.at(marks, whole, 1)
    np.add.at(marks, whole + size, -1)
    return low + np.flatnonzero(np.cumsum(marks)[:-1])


def _compare(df: DataFrame, window: int) -> DataFrame:
    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        hits, items = [], []
        for words, found in zip(batch.column("words"), batch.column("found"), strict=True):
            words = words.values.to_numpy(zero_copy_only=False)
            hit, own = np.zeros(len(words), dtype=bool), set()
            for one in found:
                places = covered(words, one["phrase"].values.to_numpy(zero_copy_only=False),
                                 one["shift"].as_py(), window)
                if len(places):
                    hit[places] = True
                    own.add(one["item"].as_py())
            hits.append(int(hit.sum()))
            items.append(sorted(x for x in own if x is not None))
        yield {"doc_id": batch.column("doc_id"), "digest": batch.column("digest"),
               "n_hit": pa.array(hits, pa.int64()), "items": pa.array(items, pa.list_(pa.string()))}

    return K.map_batches(df, function, T.StructType.fromDDL(
        "doc_id long, digest long, n_hit long, items array<string>"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items, contaminated of every row of ``docs`` (doc_id, text).

    Words are runs of digits, letters a to z and characters beyond ASCII, in lower case.  A
    word is hit inside any occurrence of ``window`` consecutive words of an item of
    ``benchmark`` (item_id, text); an item of fewer, but not none, counts as a whole.  A
    document is contaminated when a twentieth of its words or more is hit.  Null texts have no
    words, items without words match nothing, equal items count by their ids, an item with a
    null id hits like others but is not listed, repeated rows come back as often.
    """
    return PositionalIndex(docs, benchmark, window).report().withColumn("contaminated", F.expr(CONTAMINATED))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that ``contamination`` finds, each decided by its own text."""
    name = f"row_key_{uuid.uuid4().hex}"  # no column of the documents has it
    own = docs.withColumn(name, content_key())
    found = PositionalIndex(own.select("doc_id", "text", name), benchmark, window, carried=(name,)).report() \
        .where(CONTAMINATED)
    return rows_of(own, found.select(name), name, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
