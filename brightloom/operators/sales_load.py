"""Incremental, repeatable load of sales batches into snapshot tables.

Every load writes the next version of each dimension beside the current one, and of the fact
only the months that its batch touches, each to a folder of its own; it checks them, and only
then writes the state row that names these folders and makes them current. A load that dies
half way leaves the current version as it was, and nothing that a state row names is ever
written again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightloom.functions.sales import PRODUCT_RULES
from brightloom.operators import quality, sales, upsert
from brightloom.session import stage

NOT_NULL = ["invoice_no", "stock_code", "description", "invoice_ts", "quantity", "unit_price"]
TABLES = ["dim_date", "dim_store", "dim_product", "fact_sales"]


STATE = "version long, last_invoice_ts timestamp_ntz, folder string, fact_schema string, fact_parts map<string,string>"


def _newest(spark: SparkSession, base: str):
    return upsert.newest(spark, f"{base}/state/*", STATE)


def current_state(spark: SparkSession, base: str):
    """(version, last_invoice_ts) of the newest complete load, or (0, None)."""
    s = _newest(spark, base)
    return (s["version"], s["last_invoice_ts"]) if s else (0, None)


def table(spark: SparkSession, base: str, name: str, version: int) -> DataFrame:
    """A table as it was after a load."""
    found = spark.read.schema(STATE).parquet(f"{base}/state/v={version}").first()
    if name == "fact_sales":
        return upsert.read_partitions(spark, found["fact_parts"], StructType.fromJson(json.loads(found["fact_schema"])))
    return spark.read.parquet(f"{found['folder']}/{name}")


def load_batch(raw: DataFrame, base: str, rules: Sequence = PRODUCT_RULES) -> int:
    """Gate, clean, filter by the watermark, model, check, upsert, check again, commit.
    Returns the version that is current afterwards; a batch without new lines changes
    nothing."""
    spark = raw.sparkSession
    quality.require_columns(raw, [*NOT_NULL, "customer_id", "country"])
    quality.raise_on(quality.null_counts(raw, NOT_NULL).filter("null_count > 0"), "null checks")

    now = _newest(spark, base)
    version, mark = (now["version"], now["last_invoice_ts"]) if now else (0, None)
    # Lines are numbered before the watermark filter: a line keeps its number in every run.
    numbered = sales.number_lines(stage(sales.clean_sales(raw)))
    batch = stage(sales.after_watermark(numbered, "invoice_ts", mark))
    if batch.isEmpty():
        return version
    star = {n: stage(df) for n, df in sales.star_schema(batch, rules).items()}
    lines = star["fact_sales_stage"]
    quality.raise_on(quality.duplicate_keys({
        "dim_date": (star["dim_date"], ["date_key"]), "dim_store": (star["dim_store"], ["country"]),
        "dim_product": (star["dim_product"], ["stock_code"]), "fact": (lines, ["invoice_no", "line_no"]),
    }).filter("duplicates > 0"), "duplicate keys")
    quality.raise_on(quality.missing_references(lines, {
        "dates": ("date_key", star["dim_date"], "date_key"), "stores": ("country", star["dim_store"], "country"),
        "products": ("stock_code", star["dim_product"], "stock_code")}).filter("missing_keys > 0"), "missing members")

    if version:
        old = {n: spark.read.parquet(f"{now['folder']}/{n}") for n in TABLES[:3]}
        dates = upsert.insert_absent(old["dim_date"], star["dim_date"], ["date_key"])
        stores = upsert.upsert_members(old["dim_store"], star["dim_store"], "country", "store_key")
        products = upsert.upsert_members(old["dim_product"], star["dim_product"], "stock_code", "product_key")
    else:
        dates = star["dim_date"]
        stores = sales.surrogate_keys(star["dim_store"], "country", "store_key")
        products = sales.surrogate_keys(star["dim_product"], "stock_code", "product_key")
    new, folder = version + 1, f"{base}/{uuid.uuid4().hex}"
    dims = {"dim_date": dates, "dim_store": stores, "dim_product": products}
    for name, df in dims.items():
        df.write.parquet(f"{folder}/{name}")
    dims = {name: spark.read.parquet(f"{folder}/{name}") for name in dims}
    fact = sales.resolve_fact(lines, dims["dim_store"], dims["dim_product"]).withColumn("source_updated_at", F.current_timestamp())
    # a line's date never changes, so its month hangs on its key
    fact = fact.withColumn("month", (F.col("date_key") / 100).cast("int"))
    keys = ["invoice_no", "line_no"]
    parts = upsert.merge_partitions(now["fact_parts"] if now else {}, fact, keys, "month", f"{folder}/fact_sales")
    schema = StructType.fromJson(json.loads(now["fact_schema"])) if now else fact.schema

    suite = quality.warehouse_suite(
        upsert.read_partitions(spark, parts, schema),
        {"dates": ("date_key", dims["dim_date"], "date_key"), "stores": ("store_key", dims["dim_store"], "store_key"),
         "products": ("product_key", dims["dim_product"], "product_key")},
        keys, ["quantity", "unit_price", "sales_amount"])
    quality.raise_on(suite.filter("NOT ok"), "warehouse quality")
    state = spark.createDataFrame([(new, mark)], "version long, last_invoice_ts timestamp_ntz")
    last = sales.next_watermark(batch, state, "invoice_ts").first()["last_invoice_ts"]
    row = spark.createDataFrame([(new, last, folder, schema.json(), parts)], STATE)
    row.coalesce(1).write.mode("errorifexists").parquet(f"{base}/state/v={new}")
    return new
