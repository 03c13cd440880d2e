"""From raw documents to packed training sequences, one written table after the other.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir). Each stage works on
all documents its predecessor kept, and all but the last return the columns of documents.
The operators in ``brightloom.llm`` say how they treat nulls, repeats and empty tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brightloom.llm import minhash, mixing, packing, quality
from brightloom.llm.queries import vocabulary
from brightloom.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the classifier keep."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    return minhash.keep_one(docs, minhash.Scheme(width=5, percent=80, rows=5, bands=38))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary(), end=1, capacity=2048).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_rules), ("near_duplicates", near_duplicates), ("mix", source_mix), ("pack", packed),
]

#: SQL has neither the classifier nor the tokenizer; tests compare the stages with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
