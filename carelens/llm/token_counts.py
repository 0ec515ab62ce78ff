"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A change inserts, deletes or revises the counts of one document under one tokenizer version.
Totals are sums, so a batch of changes is first summed to a few signed rows, and only those are
committed.  A batch has a name and counts once, however often it is sent: a folder that Spark
has marked complete is never written again, one that a lost driver left behind is overwritten.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm import kernels as K

KEYS = ("source", "lang", "tokenizer")
#: A counter: expression of the number of tokens of a text column.
Counter = Callable[[Column], Column]
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long, chars long"


def pattern_counter(pattern: str) -> Counter:
    """Counts the matches of a pattern."""
    return lambda text: F.regexp_count(text, F.lit(pattern)).cast("long")


def vocabulary_counter(path: str, pattern: str) -> Callable[[DataFrame], DataFrame]:
    """Counts byte-level BPE tokens of a vocabulary file of ranks; adds ``tokens``.

    The file is read once on the driver and goes to the tasks; it is a few MB.
    """
    import base64

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}

    def count(docs: DataFrame) -> DataFrame:
        kept = [c for c in docs.columns if c != "tokens"]
        schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("tokens", T.LongType())])
        held: list = []

        def function(batch: pa.RecordBatch) -> Iterator[dict]:
            import tiktoken

            if not held:
                held.append(tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))
            texts = batch.column("text").to_pylist()
            tokens = [len(held[0].encode_ordinary(t)) if t else 0 for t in texts]
            yield {**{c: batch.column(c) for c in kept}, "tokens": pa.array(tokens, pa.int64())}

        return K.map_batches(docs.select(*kept), function, schema)

    return count


def count_documents(docs: DataFrame, counters: dict[str, Counter]) -> DataFrame:
    """doc_id, source, lang, tokenizer, tokens, chars: a row for each document and version.

    Null text has no tokens and no characters.
    """
    text = F.coalesce("text", F.lit(""))
    each = F.array(*(F.struct(F.lit(name).alias("tokenizer"), count(text).alias("tokens"))
                     for name, count in counters.items()))
    return docs.select("doc_id", "source", "lang", F.length(text).cast("long").alias("chars"),
                       F.explode(each).alias("count")).select("doc_id", "source", "lang", "count.*", "chars")


def inserts(counted: DataFrame) -> DataFrame:
    return _change(counted, 1, F.col("tokens"), F.col("chars"))


def deletes(counted: DataFrame) -> DataFrame:
    return _change(counted, -1, -F.col("tokens"), -F.col("chars"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old counts out and new counts in; the number of documents stays."""
    return deletes(old).unionByName(inserts(new))


def _change(counted: DataFrame, docs: int, tokens: Column, chars: Column) -> DataFrame:
    return counted.select(*KEYS, F.lit(docs).cast("long").alias("docs"), tokens.alias("tokens"),
                          chars.alias("chars"))


def summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in ("docs", "tokens", "chars")))


class Rollup:
    """Committed batches in a shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _complete(self, batch: str) -> bool:
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._path(batch)}/_SUCCESS")
        return marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(marker)

    def _path(self, batch: str) -> str:
        if not batch or not all(c.isalnum() or c in "-_." for c in batch):
            raise ValueError("a batch name has letters, digits, '-', '_' and '.'")
        return f"{self.folder}/batch={batch}"

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False where it is there already, and nothing is read or written."""
        if self._complete(batch):
            return False
        summed(changes).coalesce(1).write.mode("overwrite").parquet(self._path(batch))
        return True

    def totals(self, batches: list[str]) -> DataFrame:
        """Totals over the named batches that are committed; groups without documents go."""
        done = [self._path(b) for b in dict.fromkeys(batches) if self._complete(b)]
        if not done:
            return self.spark.createDataFrame([], TOTALS)
        rows = self.spark.read.schema(TOTALS).parquet(*done)
        return summed(rows).where("docs <> 0 or tokens <> 0 or chars <> 0")

    def compact(self, batches: list[str], into: str) -> bool:
        """Commit the totals of some batches as one batch, to be named in their place."""
        return self.commit(into, self.totals(batches))
