"""From raw documents to packed sequences: quality rules, near-duplicates, repeated passages, secrets, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.packing import pack_documents
from tidepool.llm.quality import judge, train
from tidepool.llm.secret_scan import redact
from tidepool.llm.simhash import one_of_each
from tidepool.llm.substring_dedup import dedup_substrings
from tidepool.session import materialized


def _sized(docs: DataFrame) -> DataFrame:
    """The length beside a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the model keep."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, model).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs, words=3, bits=2)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones hold."""
    return _sized(dedup_substrings(docs).drop("removed")).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets blotted out."""
    return _sized(redact(docs)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' tokens in sequences of 2048."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("passages", passages), ("secrets", secrets), ("packing", packing)]

#: The fitted model, the fingerprints and the packing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each on what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialized(docs, name)
    return docs
