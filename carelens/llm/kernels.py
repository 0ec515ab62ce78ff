"""Array helpers that tasks share: whole texts of an Arrow column as bytes, words and hashes.

A block is a run of rows whose texts are processed together; a longer text is a block of its
own, so memory follows the block size and the longest single text, never the batch.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK_BYTES = 1 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64

#: ASCII white space as the contracts define it.
WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the SplitMix64 finaliser)."""
    x = np.array(x, dtype=_U)
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> _U(shift)
            x *= _U(factor)
        x ^= x >> _U(31)
    return x


@functools.cache
def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@functools.cache
def white_words() -> np.ndarray:
    """Which bytes belong to words that white space separates."""
    table = np.ones(256, dtype=bool)
    table[list(WHITE)] = False
    return table


@functools.cache
def alnum_words() -> np.ndarray:
    """Which bytes, after lower-casing, belong to words of digits, a-z and non-ASCII."""
    table = np.zeros(256, dtype=bool)
    table[0x30:0x3A] = table[0x61:0x7B] = True
    table[0x80:] = True
    return table


@functools.cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * _BASE)


_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        have = np.full(size, base, dtype=_U)
        have[0] = 1
        _powers[name] = have = np.multiply.accumulate(have)
    return have[:n]


def span_hash(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(_byte_values()[data] * _power(int(_BASE), len(data), "up"), out=sums[1:])
        down = _power(pow(int(_BASE), -1, 1 << 64), len(data) + 1, "down")
        return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(_U))


class Block:
    """Some rows of a text column; ``data`` holds their bytes, ``bounds`` where each begins."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray):
        self.first, self.data, self.bounds = first, data, bounds
        self.n = len(bounds) - 1

    @property
    def rows(self) -> slice:
        return slice(self.first, self.first + self.n)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of about ``limit`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        part = bounds[first : last + 1]
        yield Block(first, data[part[0] : part[-1]], part - part[0])
        first = last


class Words:
    """The words of a block: byte range, row and 64-bit hash of each, in text order."""

    def __init__(self, block: Block, is_word: np.ndarray, lower: bool = True):
        data = lower_ascii()[block.data] if lower else block.data
        inside = is_word[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        begins = block.bounds[:-1][block.bounds[:-1] < block.bounds[1:]]
        ends = block.bounds[1:][block.bounds[:-1] < block.bounds[1:]] - 1
        first[begins] = inside[begins]
        last[ends] = inside[ends]
        self.block, self.data = block, data
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.upto = np.searchsorted(self.start, block.bounds)  # words before each row
        self.count = np.diff(self.upto)
        self.row = np.repeat(np.arange(block.n), self.count)

    @functools.cached_property
    def hash(self) -> np.ndarray:
        return span_hash(self.data, self.start, self.end)

    def runs(self, size: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of every run of ``size`` words in text order.

        With ``whole``, a row of fewer words (but not none) gives them as one run.
        """
        with np.errstate(over="ignore"):
            begin, row, length = self.run_starts(size, whole)
            out = mix(length.astype(_U))
            for k in range(size):
                take = k < length
                at = np.minimum(begin + k, len(self.start) - 1)
                out = np.where(take, mix(out * _U(3) + self.hash[at]), out) if len(out) else out
            return row, out

    def run_starts(self, size: int, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the first word, row and length of every run, in text order."""
        left = self.upto[1:][self.row] - np.arange(len(self.row))  # words from here to the end
        keep = left >= size
        if whole:
            keep |= (self.count[self.row] < size) & (left == self.count[self.row])
        begin = np.flatnonzero(keep)
        return begin, self.row[begin], np.minimum(left[begin], size)


class Lookup:
    """Finds 64-bit values in a sorted table; a bitmap of leading bits tells most others apart."""

    def __init__(self, table: np.ndarray, bits: int = 20):
        self.table, self.shift = table, _U(64 - bits)
        self.first = np.zeros(1 << bits, dtype=bool)
        self.first[table >> self.shift] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each value in the table, and whether it is there."""
        found = self.first[values >> self.shift]
        at = np.zeros(len(values), dtype=np.int64)
        if len(self.table):
            at[found] = np.minimum(np.searchsorted(self.table, values[found]), len(self.table) - 1)
            found &= self.table[at] == values
        return at, found


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.uint64)


def list_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A list column from the values of all rows one after another."""
    bounds = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[dict]], schema: T.StructType
) -> DataFrame:
    """Apply ``function`` to every Arrow batch; it yields columns by name, cast to ``schema``."""
    names = schema.names
    kinds = [arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in function(batch):
                arrays = []
                for name, kind in zip(names, kinds, strict=True):
                    value = columns[name]
                    if not isinstance(value, (pa.Array, pa.ChunkedArray)):
                        value = pa.array(value)
                    if isinstance(value, pa.ChunkedArray):
                        value = value.combine_chunks()
                    arrays.append(value if value.type == kind else value.cast(kind))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)
