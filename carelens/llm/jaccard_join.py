"""N-gram Jaccard self-join by vertical partitioning.

All shingles have one global order: first those not known to be common, each part by 64-bit
hash.  Sets of n elements that are similar to others have to share one of their first few
elements in that order with each of them (n - t * n + 1 for a similarity of t).  So

1. equal sets become one class, and only classes are compared;
2. classes meet in the elements that begin their sets, their signatures;
3. the order is cut into fragments; for classes that meet, the common elements are counted in
   each fragment on its own, and the partial counts are summed for each pair;
4. in each signature all are first compared with its most typical class.  Classes joined by
   that need no further comparison;
5. where many others are left, they meet in what sets them apart.  Classes of about one size
   in a signature have a centre, and each is the centre's set less what it lacks, plus what it
   adds.  Two of them have in common as much as the centre has, less what either lacks, plus
   what their differences share; so unless both are linked to the centre, similar ones share a
   number of elements of their differences that is known beforehand, hence one of the first
   few in an order by rarity.  There, step 4 is done once more;
6. in all other signatures classes are compared with each other where the places of the
   signature in both sets, less the elements nobody shares, leave room for enough common ones.
   Pairs are counted only if they share enough signatures.

Steps 4 and 5 keep a group of thousands of near copies, linked or not, from becoming all its
pairs, and lose no link that would join two components.  Common shingles are learned from a
sample of documents; they only decide the order, and every order gives the same result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm import kernels as K
from carelens.llm.components import components
from carelens.llm.joins import checked, content_key, rows_of
from carelens.session import cut_lineage

_U = np.uint64
#: Shingles in one row of the table that partial overlaps are counted from.
SEGMENT_ROWS = 2048
#: Documents that common shingles are learned from: at least, and as a share of all; how often
#: a common one stands there, and how many are held (8 bytes each in a task).
SAMPLE_ROWS, SAMPLE_SHARE, COMMON_TIMES, COMMON = 20_000, 0.02, 3, 400_000
#: Classes of one signature that are compared with each other; more meet in their differences, which
#: costs all their elements once, so it is worth it only there.  The result is the same either way.
CROWD = 512


@dataclass(frozen=True)
class Rule:
    """``words`` in a shingle, and the least similarity in hundredths."""

    words: int = 5
    percent: int = 80

    def similar(self, a: str, b: str, common: str) -> str:
        return f"100 * {common} >= {self.percent} * ({a} + {b} - {common})"

    def smallest_partner(self, n: np.ndarray) -> np.ndarray:
        return -(-self.percent * n // 100)


SETS = "doc_id long, n long, d1 long, d2 long, signatures array<long>"


def shingle_sets(block: K.Block, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash (63 bits) of the distinct shingles of a block's rows, sorted by row and hash."""
    row, h = K.Words(block, K.white_words()).runs(rule.words, whole=True)
    h = h >> _U(1)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def digests(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two independent 64-bit sums of each row's set."""
    size = np.bincount(row, minlength=n)
    upto = np.concatenate(([0], np.cumsum(size)))
    with np.errstate(over="ignore"):
        out = []
        for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
            sums = np.concatenate((np.zeros(1, _U), np.cumsum(K.mix(h ^ _U(salt)))))
            out.append(sums[upto[1:]] - sums[upto[:-1]])
    return size, out[0], out[1]


def _segments(row: np.ndarray, h: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, fragment, begin and end of the segments; ``pieces`` for each element."""
    part = ((h >> _U(31)) * pieces.astype(_U)) >> _U(32)
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
    begin = np.flatnonzero(new)
    return row[begin], part[begin], begin, np.append(begin[1:], len(row))


def signatures(row: np.ndarray, h: np.ndarray, size: np.ndarray, common: np.ndarray, rule: Rule) -> np.ndarray:
    """Indexes of the elements that begin their row's set in the global order, in that order.

    ``common``: which elements come last.
    """
    begin = (np.cumsum(size) - size)[row]
    rare_upto = np.cumsum(~common)
    rare_before = np.concatenate(([0], rare_upto))[begin]
    rare = rare_upto - rare_before  # rare ones of the row up to this one
    all_rare = np.bincount(row[~common], minlength=len(size))[row]
    place = np.where(common, all_rare + np.arange(len(row)) - begin - rare, rare - 1)
    first = np.flatnonzero(place < (size - rule.smallest_partner(size) + 1)[row])
    return first[np.lexsort((place[first], row[first]))]


def _sets(docs: DataFrame, rule: Rule, common: np.ndarray, carried: Sequence[str] = ()) -> DataFrame:
    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        known = K.Lookup(common, 22)
        for block in K.blocks(batch.column("text")):
            row, h = shingle_sets(block, rule)
            size, d1, d2 = digests(row, h, block.n)
            begins = signatures(row, h, size, known.find(h << _U(1))[1], rule)
            yield {
                "doc_id": batch.column("doc_id")[block.rows], "n": size,
                "d1": K.signed(d1), "d2": K.signed(d2),
                "signatures": K.list_array(K.signed(h[begins]), np.bincount(row[begins], minlength=block.n)),
            } | {c: batch.column(c)[block.rows] for c in carried}

    schema = T.StructType(T.StructType.fromDDL(SETS).fields + [docs.schema[c] for c in carried])
    return K.map_batches(docs, function, schema)


def common_shingles(docs: DataFrame, rule: Rule) -> np.ndarray:
    """Hashes of shingles that stand in several documents of a sample, sorted, shifted by one bit."""
    rows = docs.count()
    share = min(1.0, max(SAMPLE_ROWS / max(rows, 1), SAMPLE_SHARE))
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))

    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in K.blocks(batch.column("text")):
            h, times = np.unique(shingle_sets(block, rule)[1], return_counts=True)
            yield {"hash": K.signed(h), "times": times}

    counted = K.map_batches(some.select("text"), function, T.StructType.fromDDL("hash long, times long"))
    top = counted.groupBy("hash").agg(F.sum("times").alias("times")).where(f"times >= {COMMON_TIMES}") \
        .orderBy(F.desc("times"), "hash").limit(COMMON).select("hash").toArrow()
    return np.sort(K.unsigned(top["hash"].to_numpy())) << _U(1)


SEGMENTS = "d1 long, d2 long, pieces int, part int, hashes array<long>"


def _count_pieces(size: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Fragments to count in, as for the own size and as for the smallest partner's."""
    up = lambda n: 1 << np.ceil(np.log2(np.maximum(n / SEGMENT_ROWS, 1))).astype(np.int64)
    return up(size), up(rule.smallest_partner(size))


def count_pieces(smaller: str) -> str:
    """The same in SQL for a pair, from the smaller size."""
    return (f"cast(shiftleft(1L, cast(ceil(log2(greatest({smaller} / {SEGMENT_ROWS}.0D, 1.0D))) as int)) as int)")


def _segment_rows(docs: DataFrame, rule: Rule) -> DataFrame:
    def function(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in K.blocks(batch.column("text")):
            row, h = shingle_sets(block, rule)
            size, d1, d2 = digests(row, h, block.n)
            own, lower = _count_pieces(size, rule)
            for pieces, used in ((own, size > 0), (lower, (size > 0) & (lower != own))):
                take = used[row]
                if not take.any():
                    continue
                at, part, begin, end = _segments(row[take], h[take], pieces[row[take]])
                yield {"d1": K.signed(d1[at]), "d2": K.signed(d2[at]), "pieces": pieces[at],
                       "part": part.astype(np.int32),
                       "hashes": K.list_array(K.signed(h[take]), end - begin)}

    return K.map_batches(docs, function, T.StructType.fromDDL(SEGMENTS))


class JaccardJoin:
    """The stored tables of one join: rows, classes, links between classes and components."""

    def __init__(self, docs: DataFrame, rule: Rule = Rule(), all_links: bool = False, carried: Sequence[str] = ()):
        """``carried``: further columns of ``docs`` that ``rows`` keeps."""
        self.rule = rule
        own = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
        self.docs = docs.select(*own)
        self.rows = cut_lineage(
            _sets(docs.select(*own, *carried), rule, common_shingles(self.docs, rule), carried)
            .withColumn("row_id", F.monotonically_increasing_id()))
        self.classes = cut_lineage(
            self.rows.where("n > 0").groupBy("d1", "d2")
            .agg(F.min("row_id").alias("class_id"), F.min("doc_id").alias("first_id"),
                 F.first("n").alias("n")))
        self.links = self._links(all_links)

    def _links(self, all_links: bool) -> DataFrame:
        """a, b (class ids) and the size of the intersection."""
        shared = self._shared()
        score = shared.groupBy("class_id").agg(F.sum("members").alias("score"))
        scored = shared.join(score, "class_id")
        centre = scored.groupBy("signature").agg(F.max(F.struct("score", "class_id", "n")).alias("centre"))
        lists = cut_lineage(shared.groupBy("class_id").agg(F.collect_list("signature").alias("signatures")))
        to_centre = (
            shared.join(centre, "signature").where(
                f"class_id <> centre.class_id and {self._sizes_fit('n', 'centre.n')}")
            .select(F.col("centre.class_id").alias("a"), F.col("class_id").alias("b"),
                    F.col("centre.n").alias("a_n"), F.col("n").alias("b_n")).distinct()
        )
        links = self._similar(self._counted(self._share_enough(to_centre, lists)))
        found = components(links)
        member = self._undecided(shared, found, all_links)
        if not all_links:
            size = member.groupBy("signature").agg(F.count(F.lit(1)).alias("crowd"))
            member = cut_lineage(member.join(size, "signature"))
            crowded = member.where(f"crowd > {CROWD}")
            if not crowded.isEmpty():
                links = self._crowd_links(crowded.join(score, "class_id"), links)
                found = components(links)
            member = self._undecided(member.where(f"crowd <= {CROWD}").drop("root"), found, all_links)
        rest = self._similar(self._counted(self._share_enough(self._rest(member, all_links), lists)))
        return cut_lineage(links.union(rest).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                                                    "common").distinct())

    def _undecided(self, shared: DataFrame, found: DataFrame, all_links: bool) -> DataFrame:
        """``shared`` with the component of each class, where a signature has several."""
        member = shared.join(found.withColumnRenamed("node", "class_id"), "class_id", "left") \
            .withColumn("root", F.coalesce("root", "class_id"))
        if not all_links:
            roots = member.groupBy("signature").agg(F.min("root").alias("least"), F.max("root").alias("most"))
            member = member.join(roots.where("least < most").select("signature"), "signature")
        return cut_lineage(member.select("signature", "class_id", "n", "root", "place", "known", "last"))

    def _crowd_links(self, member: DataFrame, links: DataFrame) -> DataFrame:
        """``links`` and those that the differences of ``member`` (signature, class_id, n, score) show."""
        # Sizes of similar sets lie in one band or two that adjoin, which meet in the upper one.
        width = math.log(100 / self.rule.percent) * (1 + 1e-9) or 1e-12
        band = F.floor(F.log(F.col("n").cast("double")) / width)
        banded = member.withColumn("band", F.explode(F.array(band, band + 1)))
        centre = banded.groupBy("signature", "band").agg(
            F.max(F.struct("score", "class_id", "n")).alias("centre"), F.count(F.lit(1)).alias("own")).where("own > 1")
        around = banded.join(cut_lineage(centre), ["signature", "band"]).where("class_id <> centre.class_id").select(
            F.col("centre.class_id").alias("a"), F.col("class_id").alias("b"),
            F.col("centre.n").alias("a_n"), F.col("n").alias("b_n")).distinct()
        apart = self._differences(cut_lineage(around))
        to_centre = apart.select("a", "b", "a_n", "b_n", (F.col("a_n") - F.col("lacks")).alias("common"))
        links = links.union(self._similar(to_centre))
        keys = cut_lineage(self._difference_keys(apart))
        columns = ("class_id", "n", "root", "rank", "size", "weight")
        p = self.rule.percent
        shared = f"ceil((weight_a + weight_b - {100 + p} * centre_n) / {100 + p})"
        similar = (f"root_a <> root_b and {self._sizes_fit('n_a', 'n_b')} and rank_a <= size_a - {shared} + 1 "
                   f"and rank_b <= size_b - {shared} + 1")
        for with_all in (False, True):
            rooted = self._rooted(keys, components(links))
            b = rooted.select("centre", "element", "centre_n", *(F.col(c).alias(f"{c}_b") for c in columns))
            if with_all:
                a = rooted.select("centre", "element", *(F.col(c).alias(f"{c}_a") for c in columns))
                found = f"class_id_a < class_id_b and {similar}"
            else:
                a = rooted.groupBy("centre", "element").agg(F.min(F.struct("weight", *(c for c in columns if c != "weight")))
                                                            .alias("one")).select(
                    "centre", "element", *(F.col(f"one.{c}").alias(f"{c}_a") for c in columns))
                found = similar
            pairs = a.join(b, (a.centre == b.centre) & (a.element == b.element) & F.expr(found)) \
                .select(a.centre, "class_id_a", "class_id_b").distinct()
            links = cut_lineage(links.union(self._similar(self._common_by_difference(pairs, apart))))
        return links

    def _differences(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a: a centre, b) with how many elements of a b ``lacks``, and those ``apart``: what b
        adds, then what it lacks, each by hash."""
        segments = self._segments(pairs)
        pairs = pairs.withColumn("pieces", F.expr(count_pieces("least(a_n, b_n)")))
        of_a = segments.select(F.col("class_id").alias("a"), "pieces", "part", F.col("hashes").alias("x"))
        of_b = segments.select(F.col("class_id").alias("b"), "pieces", "part", F.col("hashes").alias("y"))
        keys, none = ["a", "b", "a_n", "b_n"], F.array().cast("array<long>")
        lacking = pairs.join(of_a, ["a", "pieces"]).join(of_b, ["b", "pieces", "part"], "left").select(
            *keys, F.array_except("x", F.coalesce("y", none)).alias("apart"), F.lit(True).alias("lacking"))
        adding = pairs.join(of_b, ["b", "pieces"]).join(of_a, ["a", "pieces", "part"], "left").select(
            *keys, F.array_except("y", F.coalesce("x", none)).alias("apart"), F.lit(False).alias("lacking"))
        lists = [F.sort_array(F.flatten(F.collect_list(F.when(F.col("lacking") == x, F.col("apart")))))
                 for x in (False, True)]
        return cut_lineage(lacking.union(adding).groupBy(*keys).agg(
            F.sum(F.when(F.col("lacking"), F.size("apart")).otherwise(0)).alias("lacks"),
            F.concat(*lists).alias("apart")))

    def _difference_keys(self, apart: DataFrame) -> DataFrame:
        """The first elements of the differences, as many as needed, with their ``rank`` among them.

        Two classes share at least (p * (n_a + n_b) + (100 + p) * (lacks_a + lacks_b)) / (100 + p)
        elements less those of the centre, and one at least unless both are linked to it.  What
        classes add is rarer than what they lack, so it comes first.
        """
        p = self.rule.percent
        weighed = apart.withColumn("weight", F.expr(f"{p} * b_n + {100 + p} * lacks")).withColumn("size", F.size("apart"))
        least = cut_lineage(weighed.groupBy("a").agg(F.min("weight").alias("least")))
        needed = f"greatest(1, ceil((weight + least - {100 + p} * a_n) / {100 + p}))"
        return weighed.join(least, "a").select(
            F.col("a").alias("centre"), F.col("a_n").alias("centre_n"), F.col("b").alias("class_id"),
            F.col("b_n").alias("n"), "weight", "size",
            F.posexplode(F.expr(f"slice(apart, 1, cast(greatest(0, size - {needed} + 1) as int))")).alias("place", "element"),
        ).withColumn("rank", F.col("place") + 1).drop("place")

    def _rooted(self, keys: DataFrame, found: DataFrame) -> DataFrame:
        """``keys`` with the component of each class, where those of a key differ."""
        rooted = cut_lineage(keys.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
                             .withColumn("root", F.coalesce("root", "class_id")))
        several = rooted.groupBy("centre", "element").agg(F.min("root").alias("least"), F.max("root").alias("most")) \
            .where("least < most").select("centre", "element")
        return cut_lineage(rooted.join(several, ["centre", "element"]))

    def _common_by_difference(self, pairs: DataFrame, apart: DataFrame) -> DataFrame:
        """a, b, their sizes and ``common`` elements: those of the centre less what either lacks, plus shared ones."""
        of_a, of_b = (apart.select(F.col("a").alias("centre"), F.col("b").alias(f"class_id_{x}"), "a_n",
                                   F.col("b_n").alias(f"n_{x}"), F.col("lacks").alias(f"lacks_{x}"),
                                   F.col("apart").alias(f"apart_{x}")) for x in "ab")
        both = pairs.join(of_a, ["centre", "class_id_a"]).join(of_b.drop("a_n"), ["centre", "class_id_b"])
        common = F.col("a_n") - F.col("lacks_a") - F.col("lacks_b") + F.size(F.array_intersect("apart_a", "apart_b"))
        return both.select(F.col("class_id_a").alias("a"), F.col("class_id_b").alias("b"), F.col("n_a").alias("a_n"),
                           F.col("n_b").alias("b_n"), common.alias("common")).distinct()

    def _share_enough(self, pairs: DataFrame, lists: DataFrame) -> DataFrame:
        """Pairs with enough common signatures.

        All common elements up to the end of the shorter prefix are signatures of both, and what
        lies beyond it is as large as the smallest partner of that set, less one.
        """
        of_a = lists.select(F.col("class_id").alias("a"), F.col("signatures").alias("x"))
        of_b = lists.select(F.col("class_id").alias("b"), F.col("signatures").alias("y"))
        p = self.rule.percent
        most = f"size(array_intersect(x, y)) + ceil({p} * greatest(a_n, b_n) / 100) - 1"
        return cut_lineage(pairs.join(of_a, "a").join(of_b, "b").where(
            f"{100 + p} * ({most}) >= {p} * (a_n + b_n)").select("a", "b", "a_n", "b_n"))

    def _sizes_fit(self, a: str, b: str) -> str:
        return f"100 * least({a}, {b}) >= {self.rule.percent} * greatest({a}, {b})"

    def _similar(self, counted: DataFrame) -> DataFrame:
        return counted.where(self.rule.similar("a_n", "b_n", "common")).select("a", "b", "common")

    def _shared(self) -> DataFrame:
        """Signatures that at least two classes have, with their classes and places.

        ``place``: elements of the set that come before; ``known``: those among them that
        are shared signatures too, so that another set can have them; ``last``: the last of those.
        """
        first = self.classes.select(F.col("class_id").alias("row_id"))
        each = (
            self.rows.select("row_id", "n", "signatures").join(first, "row_id", "left_semi")
            .select(F.posexplode("signatures").alias("place", "signature"), F.col("row_id").alias("class_id"), "n")
        )
        members = each.groupBy("signature").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        by = Window.partitionBy("class_id").orderBy("place")
        return cut_lineage(each.join(members, "signature").select(
            "*", (F.row_number().over(by) - 1).alias("known"), F.lag("signature").over(by).alias("last")))

    def _segments(self, pairs: DataFrame) -> DataFrame:
        """class_id, pieces, part, hashes of the classes in ``pairs``, once each."""
        wanted = pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct()
        classes = cut_lineage(self.classes.join(wanted, "class_id", "left_semi"))
        docs = rows_of(self.docs, classes.select("first_id"))
        segments = cut_lineage(
            _segment_rows(docs.select("text"), self.rule)
            .join(checked(classes.select("d1", "d2", "class_id")), ["d1", "d2"])
            .select("class_id", "pieces", "part", "hashes"))
        keys = ["class_id", "pieces", "part"]
        if segments.groupBy(*keys).count().where("count > 1").isEmpty():
            return segments
        # Rows of a repeated or null id with the same text: each task keeps one of its own first.
        return cut_lineage(segments.groupBy(*keys).agg(F.any_value("hashes").alias("hashes")))

    def _counted(self, pairs: DataFrame) -> DataFrame:
        """Partial overlaps in every fragment, summed for each pair."""
        segments = self._segments(pairs)
        pairs = pairs.withColumn("pieces", F.expr(count_pieces("least(a_n, b_n)")))
        of_a = segments.select(F.col("class_id").alias("a"), "pieces", "part", F.col("hashes").alias("x"))
        of_b = segments.select(F.col("class_id").alias("b"), "pieces", "part", F.col("hashes").alias("y"))
        partial = pairs.join(of_b, ["b", "pieces"]).join(of_a, ["a", "pieces", "part"])
        return cut_lineage(
            partial.select("a", "b", "a_n", "b_n", "part", F.size(F.array_intersect("x", "y")).alias("partial"))
            .groupBy("a", "b", "a_n", "b_n", "part").agg(F.max("partial").alias("partial"))
            .groupBy("a", "b", "a_n", "b_n").agg(F.sum("partial").alias("common"))
        )

    def _rest(self, member: DataFrame, all_links: bool) -> DataFrame:
        """Pairs that share a signature, can be similar and are in different components."""
        columns = ("class_id", "n", "root", "place", "known", "last")
        a, b = (member.select("signature", *(F.col(c).alias(f"{c}_{x}") for c in columns)) for x in "ab")
        # Common elements: before this one only known ones, this one, after it what both have.
        most = "least(known_a, known_b) + 1 + least(n_a - place_a, n_b - place_b) - 1"
        p = self.rule.percent
        # With the same last signature they met there; so a pair meets once for each common stretch.
        where = [f"class_id_a < class_id_b and {self._sizes_fit('n_a', 'n_b')}",
                 "(last_a is null or last_b is null or last_a <> last_b)",
                 f"{100 + p} * ({most}) >= {p} * (n_a + n_b)"]
        if not all_links:
            where.append("root_a <> root_b")
        return cut_lineage(
            a.join(b, (a.signature == b.signature) & F.expr(" and ".join(where)))
            .select(F.col("class_id_a").alias("a"), F.col("class_id_b").alias("b"),
                    F.col("n_a").alias("a_n"), F.col("n_b").alias("b_n")).distinct()
        )

    def members(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every row.

        component_id is the smallest doc_id that links reach, itself included; a document
        without words links with nothing.  Null ids are in the result, but never smallest.
        """
        found = components(self.links)
        classes = self.classes.join(found.withColumnRenamed("node", "class_id"), "class_id", "left") \
            .withColumn("root", F.coalesce("root", "class_id"))
        first = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = cut_lineage(classes.join(first, "root").select("d1", "d2", "component_id"))
        return self.rows.select("doc_id", "n", "d1", "d2").join(named, ["d1", "d2"], "left").select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (doc_id, text, ...) with one row of each component, that of the smallest doc_id.

    Rows are told apart by id and text: null ids are larger than others, a repeated id is
    a document for each of its texts, and what is equal in both keeps the smallest row.
    Texts without words are in no component, so all of them stay.
    """
    name = f"row_key_{uuid.uuid4().hex}"  # no column of the documents has it
    own = docs.withColumn(name, content_key())
    join = JaccardJoin(own.select("doc_id", "text", f"{name}.k1", f"{name}.k2"), Rule(words, percent),
                       carried=("k1", "k2"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "k1", "k2")).alias("least")
    classes = join.classes.select("d1", "d2", "class_id").join(
        join.rows.where("n > 0").groupBy("d1", "d2").agg(least), ["d1", "d2"])
    classes = cut_lineage(classes.join(components(join.links).withColumnRenamed("node", "class_id"), "class_id", "left")
                          .withColumn("root", F.coalesce("root", "class_id")))
    first = classes.groupBy("root").agg(F.min("least").alias("first"))
    named = cut_lineage(classes.join(first, "root").select("d1", "d2", "first.k1", "first.k2").withColumnsRenamed(
        {"k1": "first_k1", "k2": "first_k2"}))
    rows = join.rows.where("n > 0").select("d1", "d2", "k1", "k2").join(named, ["d1", "d2"])
    is_first = F.expr("k1 = first_k1 and k2 = first_k2")
    key = F.struct("k1", "k2").alias(name)
    others = rows.where(~is_first).select(key)
    repeated = rows.where(is_first).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("times")) \
        .where("times > 1").select(key)
    # Of repeated rows the smallest is an aggregate, so that no task gets all of them.
    repeated = cut_lineage(repeated)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    stays = rows_of(own, others.union(repeated), name, "left_anti").select(*columns)
    ordered = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    least = F.min_by(F.struct(*columns), F.struct(*ordered)).alias("row")
    once = rows_of(own, repeated, name).groupBy(name).agg(least)
    return stays.union(once.select("row.*"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Null and empty texts, and texts without words, have no shingles and stay alone.  A text of
    fewer words than a shingle has is one shingle.  Repeated rows come back as often.
    """
    return JaccardJoin(docs, Rule(words, percent)).members()
