"""Mix sources to target weights by Poisson replication.

A source that should make up ``weight`` of the mixture and holds ``size`` of the corpus is
repeated weight * total / size times on average.  Each document draws its number of copies
from the Poisson law of that mean, by inverting it at a number hashed from its id, is exploded
by it, and all copies are shuffled globally by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.session import cut_lineage

#: Entries of all sources' laws that are broadcast, 16 MB; with more, documents are joined with them.
BROADCAST_NUMBERS = 2_000_000
#: Copies that are exploded from one array.
BLOCK = 4096
#: Logarithm of the Poisson law for k > 20, by the series for log k!, without differences of large numbers.
LOG_MASS = ("k - rate - k * log1p((k - rate) / rate) - 0.5 * ln(2 * pi() * k)"
            " - 1 / (12 * k) + 1 / (360 * pow(k, 3)) - 1 / (1260 * pow(k, 5)) + 1 / (1680 * pow(k, 7))")
SEED = "mix-1"


def unit(*parts: Column | str) -> Column:
    """A number in (0, 1) hashed from the parts: 52 bits of their MD5."""
    return (_bits(*parts).cast("double") + 0.5) / F.lit(float(1 << 52))


def _bits(*parts: Column | str) -> Column:
    text = F.concat_ws("|", *(F.coalesce(p if isinstance(p, Column) else F.col(p).cast("string"), F.lit("null"))
                              for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def repetition_rates(docs: DataFrame, weights: DataFrame, epochs: float = 1.0) -> DataFrame:
    """source, size, weight and rate: the mean copies of a source's documents.

    ``weights`` (source, weight) need not sum to one.  Sources it lacks have weight 0, and
    so has a source without bytes.  ``epochs``: size of the mixture, as a multiple of the corpus.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
                                       .alias("size"))
    wanted = weights.groupBy(F.col("source").alias("wanted")).agg(F.sum("weight").alias("weight"))
    both = sizes.join(wanted, F.col("source").eqNullSafe(F.col("wanted")), "left").select(
        "source", "size", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight"))
    both = cut_lineage(both)
    total = both.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    share = F.col("weight") / F.lit(float(total.weight or 1)) * F.lit(float(total.size or 0)) / F.col("size")
    return both.select(
        "source", "size", "weight",
        F.when((F.col("size") > 0) & (F.col("weight") > 0), share * F.lit(float(epochs))).otherwise(0.0)
        .alias("rate"))


def poisson_law(rates: DataFrame) -> DataFrame:
    """source, ``first`` and ``upto`` of every source with a rate: P(copies <= first + i) for i from 0.

    The law is summed from 12 standard deviations (and 60) below the rate, where less than 1e-30
    lies beneath, to as many above it, where it is 1 in doubles: a number of entries that grows
    with the root of the rate, one running sum for each source.
    """
    spread = 12 * F.sqrt("rate") + 60
    k = F.explode(F.sequence(F.greatest(F.lit(0), F.floor(F.col("rate") - spread)).cast("long"),
                             F.ceil(F.col("rate") + spread).cast("long")))
    terms = rates.where("rate > 0").select("source", "rate", k.alias("k"))
    mass = F.when(F.col("k") <= 20, F.exp(F.col("k") * F.log("rate") - F.col("rate")) / F.factorial(
        F.least("k", F.lit(20)).cast("int"))).otherwise(F.exp(F.expr(LOG_MASS)))
    summed = F.sum(mass).over(Window.partitionBy("source").orderBy("k"))
    return terms.select("source", "k", summed.alias("upto")).groupBy("source").agg(
        F.min("k").alias("first"), F.array_sort(F.collect_list(F.struct("k", "upto"))).alias("terms")
    ).select("source", "first", F.col("terms.upto").alias("upto"))


def mix(docs: DataFrame, weights: DataFrame, epochs: float = 1.0, seed: str = SEED) -> DataFrame:
    """``docs`` with each row as often as drawn, ``copy`` (long, from 1) and ``mix_key``, shuffled.

    Copies depend on the seed, doc_id and source's rate alone; rows of one doc_id draw the same.
    Rows without id draw by their text, so different ones draw apart.  A null source is a
    source.  Rows lie in partitions by the hash of mix_key and text, so different texts of one id
    are spread, and sorted by mix_key in each; rows equal in id and text lie together.  Columns named
    copy or mix_key are replaced.  Documents that draw no copy, those of sources without weight
    and of sources without bytes are left out.  An empty input, or weights without any of its
    sources, give no rows.
    """
    kept = [c for c in docs.columns if c not in ("copy", "mix_key")]
    law = cut_lineage(poisson_law(repetition_rates(docs, weights, epochs)).withColumnRenamed("source", "drawn_from"))
    if (law.agg(F.sum(F.size("upto"))).first()[0] or 0) <= BROADCAST_NUMBERS:
        law = F.broadcast(law)
    identity = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null "), F.xxhash64("text").cast("string")))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col("source").alias("own_source"),
                       identity.alias("identity"), F.xxhash64("text").alias("text_hash"),
                       unit(F.lit(seed), identity).alias("u"))
    drawn = rows.join(law, F.col("own_source").eqNullSafe(F.col("drawn_from"))).withColumn(
        "copies", F.col("first") + F.size(F.filter("upto", lambda p: p <= F.col("u"))))
    # In blocks, since an array has no more than 2^31 entries.
    blocks = drawn.where("copies > 0").select(
        "row", "identity", "text_hash", "copies",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / BLOCK))).alias("block"))
    copies = blocks.select("row", "identity", "text_hash", F.explode(F.sequence(
        F.col("block") * BLOCK + 1, F.least(F.col("copies"), (F.col("block") + 1) * BLOCK))).alias("copy"))
    keyed = copies.withColumn("mix_key", _bits(F.lit(seed + "/order"), "identity", "copy"))
    return keyed.repartition("mix_key", "text_hash").sortWithinPartitions("mix_key", "text_hash").select(
        "row.*", "copy", "mix_key")


def equal_weights(docs: DataFrame) -> DataFrame:
    """Every source of ``docs`` with the same weight."""
    return docs.select("source").distinct().withColumn("weight", F.lit(1.0))
