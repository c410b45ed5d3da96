"""From raw documents to encoded training text, in five stages.

Every stage but the last returns the columns of ``documents``. A stage sees all
that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.llm import exact_dedup, mixing, pieces, quality, simhash
from salescast.llm.text import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that fail the base rules or diverge from their language."""
    return quality.filter_quality(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each text."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop and repeat documents until the sources have their target weights."""
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word pieces of every document of the mix, decoded again; ``text_md5`` is of the decoded text."""
    encoded = pieces.encode(docs, digest=True)
    return encoded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "text_md5")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash", near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Fingerprints and piece lattices are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
