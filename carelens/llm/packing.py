"""Best-fit packing of tokenized documents into sequences under several capacities.

A piece of a document asks for tokens, for one place among the documents of a sequence, and for
attention (the square of its length); a sequence has a residual capacity of each.  Pieces of
equal length ask for the same, so what has to be packed is a histogram of lengths, no longer
than a sequence has tokens.  The longest lengths go first.  Sequences with equal residuals form a
class; of the classes where a length fits under every capacity, best fit takes the one of the
least weighted residual norm after it, or of the largest weighted dot product of demand and
residual.  A whole class is filled in one step, each sequence with as many pieces as fit: what
best fit does one by one, since a sequence just chosen stays the fullest that still fits.

The driver sees the histogram and gives each length its runs of places; which piece takes which
place follows from its rank among the pieces of its length.  Texts are tokenized, counted,
ranked and placed in Spark; no task gets all pieces of a length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm import kernels as K
from carelens.session import cut_lineage

#: Token that ends every document.
END = 0
#: How the byte-level tokenizer cuts texts into words, and white space beyond ASCII.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER_SPACES = frozenset("\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                         "\u2028\u2029\u202f\u205f\u3000")
#: The same words of texts in which no two white spaces are adjacent, cut without looking ahead.
SINGLE_SPACED = WORDS.replace(r"\s+(?!\S)|\s+", r"\s")
#: White space in a row from which on looking ahead runs out of stack.
LONG_SPACE = re.compile(r"\s{500}")


def _ranks(path: str) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids, if the file at ``path`` is a plain byte-level vocabulary in
    merge order, which both tokenizer libraries read alike; else None."""
    held = json.loads(Path(path).read_text())
    cut = held.get("pre_tokenizer") or {}
    vocabulary, merges = held["model"].get("vocab"), held["model"].get("merges")
    if held.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") \
            or not cut.get("use_regex", True) or held["model"].get("type") != "BPE":
        return None
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
    if any(vocabulary.get(token) != 256 + k for k, token in enumerate(joined)):
        return None
    return {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if i < 256 + len(joined)}


class Encoder:
    """Token ids of whole texts, those of the ``tokenizers`` library for a vocabulary file.

    Where the file allows it, ``tiktoken`` finds the same ids in a fifth of the time.  It cuts words by
    the same pattern; whether both know a character as a letter, digit, white space or other is
    asked for each character once, and texts with one on which they differ, or with very long white
    space, go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.alike, self.different = {chr(c) for c in range(128)}, set()
        ranks = _ranks(path)
        self.fast = ranks and tuple(
            tiktoken.Encoding(name, pat_str=words, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            for name, words in (("words", WORDS), ("single", SINGLE_SPACED)))

    def _alike(self, characters: set[str]) -> bool:
        for c in characters - self.alike - self.different:
            probe = f"a{c}a 1{c}1 {c} .{c}. {c}a"
            (self.alike if self.fast[0](probe) == self._plain(probe) else self.different).add(c)
        return characters <= self.alike

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str, single_spaced: bool) -> list[int]:
        """Of one text; ``single_spaced``: it has no two adjacent white spaces of ASCII."""
        if not self.fast:
            return self._plain(text)
        if not text.isascii():
            characters = set(text)
            if not self._alike(characters):
                return self._plain(text)
            single_spaced = single_spaced and not characters & OTHER_SPACES
        if single_spaced:
            return self.fast[1](text)
        return self._plain(text) if LONG_SPACE.search(text) else self.fast[0](text)

    def encode(self, block: K.Block) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts of a block, each with its end, and where each text's begin."""
        white = ~K.white_words()[block.data]
        double = np.flatnonzero(white[1:] & white[:-1])
        single = np.searchsorted(double, block.bounds[:-1]) == np.searchsorted(double, block.bounds[1:])
        raw, tokens, upto = block.data.tobytes(), [], [0]
        for a, b, one in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), single.tolist(), strict=True):
            tokens += self.ids(raw[a:b].decode(), one)
            tokens.append(END)
            upto.append(len(tokens))
        return np.array(tokens, dtype=np.uint32), np.array(upto)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each vocabulary and worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def pieces(docs: DataFrame, path: str, capacity: int, with_ids: bool = False) -> DataFrame:
    """Every document's pieces of at most ``capacity`` tokens, stored, in the order of each task.

    ``part`` is the task that wrote a piece and ``place`` its rank there among those of its length.
    Pieces but the first have ``capacity`` tokens.  ``with_ids`` adds the tokens themselves.
    """
    fields = T.StructType.fromDDL(PIECES).fields
    if with_ids:
        fields = fields + [T.StructField("ids", T.ArrayType(T.LongType()))]
    schema = T.StructType(fields)
    kinds = [K.arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, texts = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64), encoder(path)
        for batch in batches:
            for block in K.blocks(batch.column("text")):
                tokens, upto = texts.encode(block)
                total = np.diff(upto)
                number = -(-total // capacity)
                row = np.repeat(np.arange(block.n), number)
                piece = np.arange(len(row)) - (np.cumsum(number) - number)[row]
                first = total - (number - 1) * capacity
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[row], capacity)
                begin = upto[row] + start
                raw = memoryview(tokens.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin, begin + length, strict=True)]
                order = np.argsort(length, kind="stable")
                own, times = np.unique(length, return_counts=True)
                rank = np.empty(len(row), dtype=np.int64)
                rank[order] = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                rank += seen[length]
                seen[own] += times
                columns = [batch.column("doc_id")[block.rows].take(pa.array(row)), piece, start, length,
                           np.array(crc, dtype=np.int64), np.full(len(row), part), rank]
                if with_ids:
                    columns.append(K.list_array(tokens.astype(np.int64), length))
                yield pa.RecordBatch.from_arrays(
                    [(c if isinstance(c, pa.Array) else pa.array(c)).cast(kind)
                     for c, kind in zip(columns, kinds, strict=True)], names=schema.names)

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return cut_lineage(own.mapInArrow(run, schema))


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence and how sequences are chosen.

    ``documents`` and ``attention`` (sum of squared lengths) are unlimited where None.  ``rule`` is
    "norm" (least weighted residual norm after placing) or "dot" (largest weighted dot product of
    demand and residual); ``weights`` are those of tokens, documents and attention, each as a share
    of its capacity.  Of equal classes the oldest is taken.
    """

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)

    def capacities(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens ** 2],
                        dtype=np.int64)

    def longest(self) -> int:
        """Tokens of the longest piece that any sequence can hold."""
        most = int(self.tokens)
        if self.attention:
            most = min(most, int(np.sqrt(np.float64(self.attention))))
            while most * most > self.attention:
                most -= 1
        if most < 1 or (self.documents is not None and self.documents < 1):
            raise ValueError("a sequence has to hold at least one token of one document")
        return most


class Plan:
    """Runs of places: ``n`` pieces of ``length`` from ``rank`` on go to sequences from ``sequence``
    on, ``each`` in every one, the first at ``offset``."""

    COLUMNS = ("length", "rank", "n", "sequence", "each", "offset")

    def __init__(self, runs: list[tuple[int, ...]], sequences: int):
        table = np.array(runs, dtype=np.int64).reshape(-1, len(self.COLUMNS))
        table = table[np.lexsort((table[:, 1], table[:, 0]))]
        self.runs = dict(zip(self.COLUMNS, table.T, strict=True))
        self.sequences = sequences

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces given by length and rank."""
        lengths, first = np.unique(self.runs["length"], return_index=True)
        last = np.append(first[1:], len(self.runs["length"]))
        at = np.zeros(len(length), dtype=np.int64)
        order = np.argsort(length, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else ():
            k = np.searchsorted(lengths, length[own[0]])
            ranks = self.runs["rank"][first[k] : last[k]]
            at[own] = first[k] + np.searchsorted(ranks, rank[own], side="right") - 1
        beyond = rank - self.runs["rank"][at]
        each = self.runs["each"][at]
        return self.runs["sequence"][at] + beyond // each, self.runs["offset"][at] + beyond % each * length


def best_fit(histogram: dict[int, int], limits: Limits) -> Plan:
    """Pack ``histogram`` (pieces of each length), longest first, class by class."""
    capacity = limits.capacities()
    scale = np.array(limits.weights) / capacity.astype(np.float64)
    residual, size, first = np.zeros((64, 3), dtype=np.int64), np.zeros(64, np.int64), np.zeros(64, np.int64)
    classes = sequences = 0
    runs: list[tuple[int, ...]] = []

    def add(left: np.ndarray, number: int, begin: int) -> None:
        nonlocal residual, size, first, classes
        if number <= 0 or left.min() <= 0:
            return
        if classes == len(size):
            residual, size, first = (np.concatenate((x, np.zeros_like(x))) for x in (residual, size, first))
        residual[classes], size[classes], first[classes] = left, number, begin
        classes += 1

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        demand = np.array([length, 1, length * length], dtype=np.int64)
        while left:
            fits = np.flatnonzero((size[:classes] > 0) & (residual[:classes] >= demand).all(axis=1))
            if len(fits):
                over = residual[fits]
                if limits.rule == "norm":
                    chosen = fits[np.argmin((((over - demand) * scale) ** 2).sum(axis=1))]
                else:
                    chosen = fits[np.argmax((over * scale * (demand * scale)).sum(axis=1))]
                have, begin, number = residual[chosen].copy(), int(first[chosen]), int(size[chosen])
            else:
                have, begin, number = capacity.copy(), sequences, -1
            each = int((have // demand).min())
            whole, rest = divmod(left, each)
            if number < 0:
                number = whole + (rest > 0)
                sequences += number
            else:
                size[chosen] = 0
            if whole >= number:
                whole, rest = number, 0
            offset = int(capacity[0] - have[0])
            for many, take in ((whole, each), (1, rest)):
                if many and take:
                    runs.append((length, rank, many * take, begin, take, offset))
                    add(have - take * demand, many, begin)
                    rank, left, begin, number = rank + many * take, left - many * take, begin + many, number - many
            add(have, number, begin)
    return Plan(runs, sequences)


class Packing:
    """The stored pieces of documents, their plan and their places.

    Every row of ``docs`` (doc_id, text) is a document of its own, whatever its id; null texts are
    empty, and an empty text is its end token.  No row is left out; an empty table has no sequence.
    ``path`` is a vocabulary file that every executor has.  ``with_ids`` keeps the tokens.
    """

    def __init__(self, docs: DataFrame, path: str, limits: Limits = Limits(), with_ids: bool = False):
        self.limits = limits
        self.pieces = pieces(docs, path, limits.longest(), with_ids)
        self.counts = cut_lineage(self.pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
        histogram = self.counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # a row for each length
        self.plan = best_fit({r.length: r.n for r in histogram}, limits)

    def places(self) -> DataFrame:
        """The pieces with sequence_id and offset."""
        before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        # Both sides grow with the documents, so neither is sent everywhere, however small its file.
        offsets = self.counts.select(F.col("part").alias("of_part"), F.col("length").alias("of_length"),
                                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
        ranked = self.pieces.join(offsets.hint("merge"), (F.col("part") == F.col("of_part")) & (F.col("length") == F.col("of_length"))) \
            .withColumn("rank", F.col("before") + F.col("place"))
        plan = self.plan
        kept = [c for c in self.pieces.columns if c not in ("part", "place")]
        schema = T.StructType([self.pieces.schema[c] for c in kept]
                              + T.StructType.fromDDL("sequence_id long, offset long").fields)

        def function(batch: pa.RecordBatch) -> Iterator[dict]:
            sequence, offset = plan.place(*(batch.column(c).to_numpy() for c in ("length", "rank")))
            yield {c: batch.column(c) for c in kept} | {"sequence_id": sequence, "offset": offset}

        return K.map_batches(ranked.select(*kept, "rank"), function, schema)

    def sequences(self) -> DataFrame:
        """sequence_id, ids and the doc_ids of their pieces in order; needs the tokens.

        A group is one sequence, so as large as its capacity at most.
        """
        each = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
        return self.places().groupBy("sequence_id").agg(each.alias("each")).select(
            "sequence_id", F.flatten("each.ids").alias("ids"), F.col("each.doc_id").alias("doc_ids"))
