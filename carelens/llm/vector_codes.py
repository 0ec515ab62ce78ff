"""Compression of vectors to short codes, the nearest entries found by slice-and-intersect bitmasks.

A vector of integers is cut into parts; each part is replaced by the index of the nearest entry
of its part's codebook.  A codebook is sliced by dimension: the coordinates of its entries are
sorted, and each place of that order carries a mask of the entries before it.  The entries whose
coordinate lies within a radius are then the difference of two masks, and the AND over all
dimensions leaves the entries in a box around the vector.  Only those are compared.  If the
nearest of them is within the radius, nothing outside the box can be as near; the rest is asked
again with the distance found, or twice the radius if the box was empty.  So the result is
exact whatever the first radius is.

Codebooks (entries times width) are the only thing that reaches the driver; vectors, sums and
codes stay in Spark tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm import kernels as K
from carelens.llm.joins import checked
from carelens.session import cut_lineage

#: Components times this become integers.
SCALE = 1024
#: Largest size of an integer component, so that every sum of squares is a long.
LARGEST = 1 << 24
#: Rows that the first radius of a batch is measured on, and pairs compared at once.
RADIUS_ROWS, PAIRS_AT_ONCE = 64, 1 << 18


class Slices:
    """One part's codebook with its prefix masks."""

    def __init__(self, book: np.ndarray):
        self.book = book.astype(np.int64)
        entries, self.width = book.shape
        self.words = -(-entries // 64)
        own = np.zeros((entries, self.words), dtype=np.uint64)
        at = np.arange(entries)
        own[at, at // 64] = np.uint64(1) << (at % 64).astype(np.uint64)
        order = np.argsort(self.book, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.book, order, axis=0)
        self.prefix = np.zeros((self.width, entries + 1, self.words), dtype=np.uint64)
        for j in range(self.width):
            self.prefix[j, 1:] = np.bitwise_or.accumulate(own[order[:, j]], axis=0)

    def box(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Mask of the entries within ``radius`` of each row of ``x`` in every dimension."""
        mask = np.full((len(x), self.words), ~np.uint64(0))
        for j in range(self.width):
            low = np.searchsorted(self.sorted[:, j], x[:, j] - radius, side="left")
            high = np.searchsorted(self.sorted[:, j], x[:, j] + radius, side="right")
            mask &= self.prefix[j][high] & ~self.prefix[j][low]
        return mask

    def best_of(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry in each row's mask and its squared distance; -1 where the mask is empty."""
        index = np.full(len(x), -1, dtype=np.int64)
        distance = np.full(len(x), -1, dtype=np.int64)
        step = max(1, PAIRS_AT_ONCE // len(self.book))
        for first in range(0, len(x), step):
            bits = np.unpackbits(mask[first : first + step].view(np.uint8), axis=1, bitorder="little")
            row, entry = np.nonzero(bits)
            if not len(row):
                continue
            away = self.book[entry] - x[first + row]
            squared = np.einsum("ij,ij->i", away, away)
            begin = np.flatnonzero(np.diff(row, prepend=-1))
            least = np.minimum.reduceat(squared, begin)
            size = np.diff(np.append(begin, len(row)))
            nearest = np.flatnonzero(squared == np.repeat(least, size))
            nearest = nearest[np.diff(row[nearest], prepend=-1) > 0]  # the lowest index of equal ones
            index[first + row[nearest]] = entry[nearest]
            distance[first + row[begin]] = least
        return index, distance

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row of ``x``, of equal ones the lowest, and its squared distance."""
        index = np.full(len(x), -1, dtype=np.int64)
        distance = np.zeros(len(x), dtype=np.int64)
        if not len(x):
            return index, distance
        radius = np.full(len(x), self._first_radius(x), dtype=np.int64)
        left = np.arange(len(x))
        while len(left):
            found, squared = self.best_of(x[left], self.box(x[left], radius[left]))
            sure = (found >= 0) & (squared <= radius[left] ** 2)
            index[left[sure]], distance[left[sure]] = found[sure], squared[sure]
            left, found, squared = left[~sure], found[~sure], squared[~sure]
            radius[left] = np.where(found >= 0, _root_up(squared), 2 * radius[left])
        return index, distance

    def _first_radius(self, x: np.ndarray) -> int:
        """Within which half of some rows find their nearest entry."""
        some = x[:: max(1, len(x) // RADIUS_ROWS)][:RADIUS_ROWS]
        every = np.repeat(self.prefix[0, -1:], len(some), axis=0)
        return max(1, int(_root_up(np.array([np.median(self.best_of(some, every)[1])]))[0]))


def _root_up(squared: np.ndarray) -> np.ndarray:
    """The least integer whose square is as large."""
    root = np.floor(np.sqrt(np.maximum(squared, 0).astype(np.float64))).astype(np.int64)
    return root + (root * root < squared)


def integers(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows whose vector has only finite components, with ``components``: floor(scale * x)."""
    x = F.col(vector).cast("array<double>")
    endless = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where((F.size(x) > 0) & ~endless).withColumn(
        "components", F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))))


@dataclass(frozen=True)
class Codebooks:
    """For each part a matrix of entries by width."""

    books: tuple[np.ndarray, ...]

    def sha256(self) -> str:
        """Of the decimal components by part, entry and place, joined by commas."""
        every = (str(c) for book in self.books for entry in book.tolist() for c in entry)
        return hashlib.sha256(",".join(every).encode()).hexdigest()

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return np.split(x, len(self.books), axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """part, entry, n and the sums of the parts that the entry is nearest to; one row for each and task."""
    width = books.books[0].shape[1]
    schema = T.StructType.fromDDL("part int, entry int, n long, " + ", ".join(f"s{j} long" for j in range(width)))
    kinds = [K.arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = [Slices(book) for book in books.books]
        entries = len(books.books[0])
        n = np.zeros((len(sliced), entries), dtype=np.int64)
        sums = np.zeros((len(sliced), entries, width), dtype=np.int64)
        for batch in batches:
            for p, x in enumerate(books.parts(_matrix(batch.column("components")))):
                code, _ = sliced[p].nearest(x)
                n[p] += np.bincount(code, minlength=entries)
                for j in range(width):  # sums of a batch are far below 2**53, so doubles are exact
                    sums[p, :, j] += np.bincount(code, weights=x[:, j], minlength=entries).astype(np.int64)
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c).cast(kind) for c, kind in zip(
                [part, entry, n[part, entry], *sums[part, entry].T], kinds, strict=True)], names=schema.names)

    return rows.select("components").mapInArrow(run, schema)


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floor of the mean of what it is nearest to; unused ones stay."""
    each = _sums(rows, books)
    summed = each.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in each.columns[2:])).collect()
    after = [book.copy() for book in books.books]
    for part, entry, n, *sums in summed:
        after[part][entry] = [s // n for s in sums]
    return Codebooks(tuple(after))


CODED = "code string, error long"


def coded(rows: DataFrame, books: Codebooks, *carried: str) -> DataFrame:
    """``carried`` columns, the ``code`` (two hex digits a part) and its squared ``error``."""
    schema = T.StructType([rows.schema[c] for c in carried] + T.StructType.fromDDL(CODED).fields)

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        sliced = [Slices(book) for book in books.books]
        error = np.zeros(batch.num_rows, dtype=np.int64)
        codes = []
        for s, x in zip(sliced, books.parts(_matrix(batch.column("components"))), strict=True):
            code, squared = s.nearest(x)
            codes.append(code)
            error += squared
        code = np.stack(codes, axis=1).astype(np.uint8)
        yield {c: batch.column(c) for c in carried} | {"code": [bytes(c).hex() for c in code], "error": error}

    return K.map_batches(rows.select("components", *carried), function, schema)


class VectorCodes:
    """The stored vectors of one table, the codebooks fitted to all of them, and the codes.

    ``vectors`` has ``key`` and ``vector``, an array of numbers.  A vector that is null, empty or
    holds null or non-finite components is left out; so is one whose length differs from that of
    the smallest key (null keys are largest; of a repeated key the smallest vector).  Repeated rows
    count as often as they come.  With fewer vectors than ``entries``, codebooks have fewer entries;
    without any there is no code.  Lengths that ``parts`` do not divide, more than 256 entries, and
    components beyond 16,384 in size, whose squares would not fit, are refused with an error.
    """

    def __init__(self, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = SCALE):
        if not 1 <= entries <= 256:
            raise ValueError("a code has two hex digits for each part, so 1 to 256 entries")
        own = vectors.select(F.col(key).alias("vec_id"), F.col(vector).alias("embedding"), F.col(label).alias("label"))
        every = integers(own, scale=scale).drop("embedding")
        first = every.orderBy(F.col("vec_id").asc_nulls_last(), "components").limit(1).collect()
        width = len(first[0].components) if first else parts
        if width % parts:
            raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
        self.rows = cut_lineage(every.where(F.size("components") == width))
        size = self.rows.agg(F.max(F.expr("array_max(transform(components, c -> abs(c)))"))).first()[0]
        if size and size > LARGEST:
            raise ValueError(f"components of up to {size / scale:.0f} in size have squares that no long holds")
        start = self.rows.orderBy(F.col("vec_id").asc_nulls_last(), "components").limit(entries).collect()
        matrix = np.array([r.components for r in start], dtype=np.int64).reshape(-1, width)
        self.books = Codebooks(tuple(np.split(matrix, parts, axis=1)))
        for _ in range(rounds if len(matrix) else 0):
            self.books = improved(self.rows, self.books)

    def codes(self) -> DataFrame:
        """vec_id, label, code, error and label_error: the errors of all rows of the label, null being one."""
        if not len(self.books.books[0]):
            return self.rows.select("vec_id", "label").withColumns(
                {"code": F.lit(""), "error": F.lit(0).cast("long"), "label_error": F.lit(0).cast("long")})
        found = cut_lineage(coded(self.rows, self.books, "vec_id", "label"))
        labels = checked(found.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")))
        return found.join(labels, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")

    def decode(self, codes: DataFrame) -> DataFrame:
        """``codes`` with ``decoded``: the entries that stand for each part, as numbers of the first scale."""
        books, width, names = self.books, sum(b.shape[1] for b in self.books.books), codes.columns
        schema = T.StructType([*codes.schema.fields, T.StructField("decoded", T.ArrayType(T.DoubleType()))])

        def function(batch: pa.RecordBatch) -> Iterator[dict]:
            text = "".join(batch.column("code").to_pylist())
            code = np.frombuffer(bytes.fromhex(text), dtype=np.uint8).reshape(batch.num_rows, -1)
            near = np.concatenate([b[code[:, p]] for p, b in enumerate(books.books)], axis=1) / SCALE
            yield {c: batch.column(c) for c in names} | {
                "decoded": K.list_array(near.ravel(), np.full(len(near), width))}

        return K.map_batches(codes, function, schema)

