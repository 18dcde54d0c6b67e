"""A corpus pipeline: toxic documents go, then those in no language, then near-duplicates; what stays is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqlab.llm import language, packing, simhash, toxicity
from seqlab.session import land


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 by a model of the table labels, fitted on ``docs``."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in a language; those without any letter go."""
    return language.drop_unknown(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of all documents that stayed, cut and packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


#: Models, fingerprints and tokens are beyond SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None
