"""Sales cleaning, star schema, incremental state and key resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.sales import PRODUCT_RULES, date_key, keyword_category
from brightloom.operators.ordering import row_numbers

REQUIRED = ["invoice_no", "stock_code", "description", "invoice_ts", "unit_price"]


def clean_sales(raw: DataFrame) -> DataFrame:
    """Usable sales lines: complete, positive, not a return ('C…' invoices)."""
    named = raw.toDF(*[c.strip() for c in raw.columns])
    if dict(named.dtypes)["invoice_ts"] == "string":
        named = named.withColumn("invoice_ts", F.try_to_timestamp("invoice_ts").cast("timestamp_ntz"))
    return (
        named.dropna(subset=REQUIRED)
        .filter(F.col("quantity") > 0)
        .filter(F.col("unit_price") > 0)
        .filter(~F.col("invoice_no").cast("string").startswith("C"))
        .select(
            F.col("invoice_no").cast("string").alias("invoice_no"),
            F.col("stock_code").cast("string").alias("stock_code"),
            F.trim("description").alias("description"),
            F.col("quantity").cast("int").alias("quantity"),
            "invoice_ts",
            F.col("unit_price").cast("decimal(12,4)").alias("unit_price"),
            F.col("customer_id").cast("long").cast("string").alias("customer_id"),
            F.trim("country").alias("country"),
        )
        .withColumn(
            "sales_amount", (F.col("quantity") * F.col("unit_price")).cast("decimal(14,4)")
        )
    )


def number_lines(clean: DataFrame) -> DataFrame:
    """``line_no`` inside each invoice by time and stock code; the other columns break ties."""
    order = ["invoice_ts", "stock_code", "quantity", "unit_price", "description", "country", "customer_id"]
    return row_numbers(clean, ["invoice_no"], [F.col(c) for c in order], "line_no")


def with_category(df: DataFrame, rules: Sequence = PRODUCT_RULES) -> DataFrame:
    text = F.concat_ws(" ", "stock_code", "description")
    return df.withColumn("category", keyword_category(text, rules))


def date_dimension(days: DataFrame, ts: str) -> DataFrame:
    day = F.col("full_date")
    return (
        days.select(F.to_date(ts).alias("full_date")).distinct()
        .select(
            date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.dayofmonth(day).alias("day"),
            (F.weekday(day) + 1).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.weekofyear(day).alias("week_of_year"),
        )
    )


def store_dimension(clean: DataFrame) -> DataFrame:
    return clean.select("country").distinct().select(
        "country",
        F.concat(F.lit("Online - "), "country").alias("store_name"),
        F.lit("Online").alias("channel"),
    )


def product_dimension(clean: DataFrame, rules: Sequence = PRODUCT_RULES) -> DataFrame:
    """The earliest description of each stock code wins."""
    first = F.min_by("description", F.struct("invoice_ts", "invoice_no", "description"))
    return with_category(
        clean.groupBy("stock_code").agg(first.alias("description")), rules
    ).withColumnRenamed("description", "product_name")


def fact_stage(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "invoice_no", "line_no", "invoice_ts", date_key(F.col("invoice_ts")).alias("date_key"),
        "country", "stock_code", "customer_id", "quantity", "unit_price", "sales_amount",
    )


def star_schema(numbered: DataFrame, rules: Sequence = PRODUCT_RULES) -> dict[str, DataFrame]:
    return {
        "dim_date": date_dimension(numbered, "invoice_ts"),
        "dim_store": store_dimension(numbered),
        "dim_product": product_dimension(numbered, rules),
        "fact_sales_stage": fact_stage(numbered),
    }


def after_watermark(df: DataFrame, ts: str, watermark: object | None) -> DataFrame:
    """Rows strictly newer than the stored maximum; everything when there is none."""
    if watermark is None:
        return df
    kind = dict(df.dtypes)[ts]
    return df.filter(F.col(ts) > F.lit(watermark).cast(kind))


def next_watermark(batch: DataFrame, state: DataFrame, ts: str) -> DataFrame:
    """One-row state; an empty batch leaves it as it was. Write it after the checks only."""
    fresh = batch.agg(F.max(ts)).scalar()
    return state.select(F.coalesce(fresh, F.col("last_invoice_ts")).alias("last_invoice_ts"))


def surrogate_keys(dim: DataFrame, natural: str, key: str, above: DataFrame | None = None) -> DataFrame:
    """Number new members from the highest key in use."""
    numbered = row_numbers(dim, [], [F.col(natural)], key)
    if above is None:
        return numbered
    top = F.coalesce(above.agg(F.max(key)).scalar(), F.lit(0))
    return numbered.withColumn(key, F.col(key) + top)


def resolve_fact(stage: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Natural keys to surrogate keys; lines without a member are left out."""
    return (
        stage.join(dim_store.select("country", "store_key"), "country")
        .join(dim_product.select("stock_code", "product_key"), "stock_code")
        .select(
            "invoice_no", "line_no", "invoice_ts", "date_key", "store_key", "product_key",
            "customer_id", "quantity", "unit_price", "sales_amount",
        )
    )
