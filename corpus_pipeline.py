"""From raw documents to a training mixture: five stages, each over all that the one before has kept."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from fieldlens.llm import decontaminate, exact_dedup, mixing, quality, simhash
from fieldlens.llm.common import read


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.drop_low(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.drop_near(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the order in which they are used, repeated as their source's budget asks."""
    return mixing.mixture(docs, carry=tuple(docs.columns))


STAGES = [
    ("quality", accept_quality),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("mixture", mix_sources),
]

#: Neighbour voting and random walks have no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written and read again, in the folder that the cluster shares."""
    home = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="pipeline-")
    folder = f"{home.rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
