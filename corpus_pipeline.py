"""A training corpus from documents: filter, deduplicate, decontaminate, redact, encode.

Each stage takes all that the one before it kept. A stage is a function of the session, the
documents and the folder of the tables. ``run`` writes what each returns as Parquet in the
shared folder and reads it as the next one's documents, so a lost executor costs a stage at
most. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm import bpe, copies, decontaminate, quality, secrets
from demandlake.llm.queries import VOCABULARY
from demandlake.llm.rows import written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of verified near duplicates: the one with the smallest identifier."""
    return copies.keep_one(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; ``n_chars`` counts the text that is left."""
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = dict(docs.dtypes)["n_chars"]
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, ``ids`` (array of token identifiers), ``n_tokens``, and
    ``intact``: whether decoding gives the bytes of the text back."""
    return bpe.packed_documents(docs, VOCABULARY, public_tokenizers.PATTERN)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("decontamination", clean_documents),
    ("secrets", redacted_documents),
    ("tokens", encoded_documents),
]

# The classifier and the tokenizer have no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
