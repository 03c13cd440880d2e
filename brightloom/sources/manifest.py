"""Provenance manifest: one row per ingested file, latest entries, inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_entries(spark: SparkSession, folder: str, dataset: str, version: str, source: str, url: str, rows: int | None, columns: int | None) -> DataFrame:
    """Manifest rows of the files in a folder, with size and content hash. Each file is
    hashed by the task that reads it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(folder)
    return files.select(
        F.lit(dataset).alias("dataset"), F.lit(version).alias("dataset_version"), F.lit(source).alias("source_name"),
        F.lit(url).alias("source_url"), F.col("path").alias("file_path"), F.col("modificationTime").alias("written_at"),
        F.sha2("content", 256).alias("sha256"), F.lit(rows).cast("long").alias("rows"), F.lit(columns).cast("int").alias("columns"),
        F.col("length").alias("bytes"), F.lit("success").alias("fetch_status"), F.lit("passed").alias("validation_status"))


def append(entries: DataFrame, manifest: str) -> None:
    entries.write.mode("append").json(manifest)


def latest(entries: DataFrame, dataset: str, order: list[str]) -> DataFrame:
    """The last appended entry of each dataset."""
    rest = [c for c in entries.columns if c != dataset]
    return entries.groupBy(dataset).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_e")).select(dataset, "_e.*")


def inventory(metadata: DataFrame, newest: DataFrame, dataset: str, shown: dict[str, Column]) -> DataFrame:
    """Every known dataset with its newest entry; 'not yet fetched' where there is none."""
    found = newest.select(dataset, *[c.cast("string").alias(n) for n, c in shown.items()])
    return metadata.join(found, dataset, "left").select(
        *metadata.columns, *[F.coalesce(n, F.lit("not yet fetched")).alias(n) for n in shown])
