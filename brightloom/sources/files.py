"""Readers and writers of the file formats in use."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.session import shared_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on the shared store; nothing is ever overwritten there."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header under a declared schema. A missing path fails here, a header
    that differs from the schema fails when read."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_star(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_star(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def write_version(df: DataFrame, base: str, slug: str, at: datetime | None = None) -> str:
    """Write under a time-stamped path that must not exist yet; earlier versions stay."""
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")
    path = f"{base}/{slug}/run_ts={stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def land(df: DataFrame, path: str, day: Column, name: str = "date") -> None:
    """Parquet partitioned by date. The rebalance hint gives files of even size: a heavy
    day is split over tasks, light days share them."""
    df.withColumn(name, day).hint("rebalance", name).write.mode("errorifexists").partitionBy(name).parquet(path)


def decode_key_map(
    payloads: DataFrame, payload: str, value: str, table_id: str, turvar: str, turtahun: str, parents_only: bool = False
) -> DataFrame:
    """Values of a statistics payload whose map is keyed region‖table‖turvar‖year‖turtahun.
    Pairs without a key are left out; names lose their markup. ``parents_only`` keeps
    region codes that are multiples of 100."""
    item = "array<struct<val:string,label:string>>"
    p = payloads.select(F.from_json(payload, f"vervar {item}, tahun {item}, datacontent map<string,double>").alias("p"))
    pairs = p.select(F.explode("p.vervar").alias("r"), F.col("p.tahun").alias("ys"), F.col("p.datacontent").alias("m")).select(
        "r", F.explode("ys").alias("y"), "m")
    if parents_only:
        pairs = pairs.filter(F.col("r.val").cast("long") % 100 == 0)
    key = F.concat(F.col("r.val"), F.lit(table_id), F.lit(turvar), F.col("y.val"), F.lit(turtahun))
    return pairs.select(
        F.trim(F.regexp_replace("r.label", "</?b>", "")).alias("entity"),
        F.col("y.label").cast("int").alias("year"), F.try_element_at("m", key).alias(value),
    ).filter(F.col(value).isNotNull())


def flatten_features(collections: DataFrame, properties: dict[str, str], name_candidates: Sequence[str], name: str = "name") -> DataFrame:
    """Properties of all features; the name is the first candidate property with a value.
    ``collections`` has ``features array<struct<properties struct<…>>>``."""
    f = collections.select(F.explode("features").alias("f"))
    return f.select(
        F.coalesce(*[F.col(f"f.properties.{c}") for c in name_candidates]).alias(name),
        *[F.col(f"f.properties.{p}").alias(n) for p, n in properties.items()])


def search_pages(spark: SparkSession, folder: str, schema: str, items: str, title: str, needle: str) -> DataFrame:
    """All result pages of a folder as one table, searched by a part of the title."""
    rows = spark.read.schema(schema).json(folder).select(F.explode(items).alias("i")).select("i.*")
    return rows.filter(F.lower(title).contains(needle.lower()))


def find_column(columns: Sequence[str], *needles: str) -> str | None:
    """First column whose lower-cased name contains a needle."""
    return next((c for c in columns if any(n.lower() in c.lower() for n in needles)), None)


def parse_percent(text: Column) -> Column:
    """'5,0%' to 5.0; unreadable text is null."""
    return F.translate(F.trim(text), ",%", ".").try_cast("double")


def melt_crosstab(df: DataFrame, category: str, entity: str, value: str, year: int) -> DataFrame:
    """Header-row crosstab to rows; cells that are no number are left out."""
    cols = [c for c in df.columns if c != category]
    text = df.select(category, *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    return text.unpivot([category], cols, entity, "_cell").select(
        category, entity, F.round(F.col("_cell").try_cast("double"), 4).alias(value), F.lit(year).alias("year"),
    ).filter(F.col(value).isNotNull())


def repeated_entities(melted: DataFrame, entity: str) -> DataFrame:
    """Entities that sit in more than one category."""
    return melted.groupBy(entity).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def export_json(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)
