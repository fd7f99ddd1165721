"""The corpus pipeline: classify, drop copies, drop near copies, mix, pack."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.exact_dedup import drop_copies
from riskloom.llm.mixing import mixed_documents
from riskloom.llm.packing import pack, piece_digest
from riskloom.llm.quality import accepted
from riskloom.llm.simhash import drop_near_copies
from riskloom.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digest(pack(docs))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("simhash near-dedup", near_copies),
    ("source mixing", mixed),
    ("packing", packed),
]

#: Model training, shingle hashes and the tokenizer have no SQL form; the tests hold a run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = shared_dir(spark, "corpus", uuid.uuid4().hex)
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{work}/{k}")
        docs = spark.read.parquet(f"{work}/{k}")
    return docs
