"""A training corpus from raw documents, stage by stage.

Every stage takes what the one before kept, as a stored table with the columns of documents;
the last adds where each row goes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from carelens.llm import quality
from carelens.llm.decontaminate import uncontaminated
from carelens.llm.jaccard_join import one_of_each
from carelens.llm.mixing import equal_weights, mix
from carelens.llm.queries import read, ship
from carelens.llm.sharding import shard
from carelens.session import cut_lineage, shared_folder

#: Documents with a lower score go: the threshold of the classifier's own query.
LEAST_QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, does not reject."""
    ship(spark)
    measured = cut_lineage(quality.measure(docs))
    model = quality.fit(quality.labelled(measured, read(spark, sf_dir, "labels")))
    return quality.keep_good(docs, model, LEAST_QUALITY)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8), the row with the smallest id.

    Rows of a null or repeated id are decided one by one; a null id is the largest.
    """
    ship(spark)
    return one_of_each(docs, words=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that benchmark items do not contaminate, whatever other rows of their id hold."""
    ship(spark)
    return uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many bytes of each source on average, by Poisson replication, in random order."""
    ship(spark)
    return mix(docs, equal_weights(docs)).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in 16 shards of equal size and random order."""
    ship(spark)
    return shard(docs, 16)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
    ("sharding", sharded),
]

#: A fitted classifier and a random shuffle are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from documents on; each is stored and read again as the next one's input."""
    docs = read(ship(spark), sf_dir, "documents")
    folder = f"{shared_folder(spark)}/carelens-pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
