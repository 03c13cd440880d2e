"""Retail sales: cleaning, star schema, loads, checks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.operators import sales, upsert
from brightloom.plans.registry import Tables, query
from brightloom.session import cut, stage
from brightloom.sources.files import scratch

# Category words that occur in the given part names.
PART_RULES = [
    ("KITCHEN", ["plate"]),
    ("TOOLS", ["anvil", "rod"]),
    ("HARDWARE", ["bolt", "gear"]),
    ("APPAREL", ["ring"]),
    ("GADGETS", ["gizmo"]),
]

CUT_DAY = "2001-01-01"

# The same mapping as raw_sales(), clean_sales() and number_lines(), for DuckDB.
SALES = """
raw_sales AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS invoice_no,
         CAST(l_partkey AS VARCHAR) AS stock_code, p_name AS description,
         CAST(l_quantity AS INTEGER) AS quantity, o_orderdate AS invoice_ts,
         CAST(p_retailprice AS DECIMAL(12,4)) AS unit_price,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         n_name AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
clean AS (
  SELECT *, CAST(quantity * unit_price AS DECIMAL(14,4)) AS sales_amount
  FROM raw_sales WHERE quantity > 0 AND unit_price > 0 AND invoice_no NOT LIKE 'C%'),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY invoice_no ORDER BY invoice_ts, stock_code, quantity,
         unit_price, description, country, customer_id NULLS FIRST) AS line_no FROM clean),
dim_store AS (
  SELECT row_number() OVER (ORDER BY country) AS store_key, country,
         'Online - ' || country AS store_name, 'Online' AS channel
  FROM (SELECT DISTINCT country FROM clean)),
dim_product AS (
  SELECT row_number() OVER (ORDER BY stock_code) AS product_key, stock_code, product_name,
         CASE WHEN product_name LIKE '%plate%' THEN 'KITCHEN'
              WHEN product_name LIKE '%anvil%' OR product_name LIKE '%rod%' THEN 'TOOLS'
              WHEN product_name LIKE '%bolt%' OR product_name LIKE '%gear%' THEN 'HARDWARE'
              WHEN product_name LIKE '%ring%' THEN 'APPAREL'
              WHEN product_name LIKE '%gizmo%' THEN 'GADGETS' ELSE 'OTHER' END AS category
  FROM (SELECT stock_code, min(description) AS product_name FROM clean GROUP BY stock_code))
"""


def raw_sales(t: Tables) -> DataFrame:
    """Order lines as sales lines; customers in debt count as guests."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    return (
        lines.join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                   F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part.select("p_partkey", "p_name", "p_retailprice"),
              F.col("l_partkey") == F.col("p_partkey"))
        .join(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"),
              F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.when(F.col("l_returnflag") == "R", "C").otherwise(""),
                     F.col("l_orderkey").cast("string")).alias("invoice_no"),
            F.col("l_partkey").cast("string").alias("stock_code"),
            F.col("p_name").alias("description"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("o_orderdate").alias("invoice_ts"),
            F.col("p_retailprice").cast("decimal(12,4)").alias("unit_price"),
            F.when(F.col("c_acctbal") >= 0, F.col("o_custkey")).alias("customer_id"),
            F.col("n_name").alias("country"),
        )
    )


def clean(t: Tables) -> DataFrame:
    return sales.clean_sales(raw_sales(t))


def staged(t: Tables) -> DataFrame:
    """Numbered sales lines, frozen between the stages: dimensions, fact and checks all
    read them, and the joins behind them run once."""
    return stage(sales.number_lines(stage(clean(t))))


def stores(lines: DataFrame) -> DataFrame:
    return sales.surrogate_keys(cut(sales.store_dimension(lines)), "country", "store_key")


def products(lines: DataFrame) -> DataFrame:
    return sales.surrogate_keys(
        cut(sales.product_dimension(lines, PART_RULES)), "stock_code", "product_key"
    )


CLEAN_COLS = (
    "invoice_no, stock_code, description, quantity, CAST(invoice_ts AS DATE) AS invoice_day, "
    "unit_price, customer_id, country, sales_amount"
)


@query("retail_clean_sales", f"WITH {SALES} SELECT {CLEAN_COLS} FROM clean", money=["unit_price", "sales_amount"], days=["invoice_day"])
def _(t):
    return clean(t).withColumn("invoice_day", F.to_date("invoice_ts")).drop("invoice_ts")


@query("retail_line_no", f"WITH {SALES} SELECT invoice_no, line_no, stock_code, quantity FROM numbered")
def _(t):
    return sales.number_lines(stage(clean(t))).select("invoice_no", "line_no", "stock_code", "quantity")


@query("retail_category", """
SELECT p_partkey, CASE WHEN p_name LIKE '%plate%' THEN 'KITCHEN'
  WHEN p_name LIKE '%anvil%' OR p_name LIKE '%rod%' THEN 'TOOLS'
  WHEN p_name LIKE '%bolt%' OR p_name LIKE '%gear%' THEN 'HARDWARE'
  WHEN p_name LIKE '%ring%' THEN 'APPAREL' WHEN p_name LIKE '%gizmo%' THEN 'GADGETS'
  ELSE 'OTHER' END AS category FROM part""")
def _(t):
    parts = t.part.select("p_partkey", F.col("p_partkey").cast("string").alias("stock_code"),
                          F.col("p_name").alias("description"))
    return sales.with_category(parts, PART_RULES).select("p_partkey", "category")


@query("retail_dim_date", """
SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
  CAST(o_orderdate AS DATE) AS full_date, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month,
  monthname(o_orderdate) AS month_name, CAST(day(o_orderdate) AS INTEGER) AS day,
  CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week, dayname(o_orderdate) AS day_name,
  CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year FROM orders""", days=["full_date"])
def _(t):
    return sales.date_dimension(t.orders.select("o_orderdate"), "o_orderdate")


@query("retail_dim_store", f"WITH {SALES} SELECT country, store_name, channel FROM dim_store")
def _(t):
    return sales.store_dimension(clean(t))


@query("retail_dim_product", f"WITH {SALES} SELECT stock_code, product_name, category FROM dim_product")
def _(t):
    return sales.product_dimension(clean(t), PART_RULES)


@query("retail_fact_stage", f"""WITH {SALES}
SELECT invoice_no, line_no, CAST(strftime(invoice_ts, '%Y%m%d') AS INTEGER) AS date_key, country,
  stock_code, customer_id, quantity, unit_price, sales_amount FROM numbered""", money=["unit_price", "sales_amount"])
def _(t):
    return sales.fact_stage(sales.number_lines(stage(clean(t)))).drop("invoice_ts")


@query("retail_fact_resolved", f"""WITH {SALES}
SELECT invoice_no, line_no, store_key, product_key, quantity, sales_amount
FROM numbered JOIN dim_store USING (country) JOIN dim_product USING (stock_code)""", money=["sales_amount"])
def _(t):
    lines = staged(t)
    return sales.resolve_fact(sales.fact_stage(lines), stores(lines), products(lines)).select(
        "invoice_no", "line_no", "store_key", "product_key", "quantity", "sales_amount"
    )


@query("retail_incremental", f"""
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_day, o_totalprice
FROM orders WHERE o_orderdate > TIMESTAMP '{CUT_DAY} 00:00:00'""", days=["order_day"])
def _(t):
    return sales.after_watermark(t.orders, "o_orderdate", CUT_DAY).select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_day"), "o_totalprice"
    )


@query("retail_watermark", """
SELECT CAST(max(o_orderdate) AS DATE) AS last_invoice_ts FROM orders""", days=["last_invoice_ts"])
def _(t):
    state = t.spark.sql(f"SELECT TIMESTAMP_NTZ '{CUT_DAY} 00:00:00' AS last_invoice_ts")
    batch = sales.after_watermark(t.orders, "o_orderdate", CUT_DAY)
    return sales.next_watermark(batch, state, "o_orderdate").select(
        F.to_date("last_invoice_ts").alias("last_invoice_ts")
    )


def _total():
    return F.sum("sales_amount").cast("decimal(28,4)").alias("total_sales")


@query("retail_sales_by_month", f"""WITH {SALES}
SELECT CAST(year(invoice_ts) AS INTEGER) AS year, CAST(month(invoice_ts) AS INTEGER) AS month,
  CAST(sum(sales_amount) AS DECIMAL(28,4)) AS total_sales FROM clean GROUP BY 1, 2""", money=["total_sales"])
def _(t):
    return (clean(t).groupBy(F.year("invoice_ts").alias("year"), F.month("invoice_ts").alias("month"))
            .agg(_total()).orderBy("year", "month"))


@query("retail_sales_by_category", f"""WITH {SALES}
SELECT category, CAST(sum(sales_amount) AS DECIMAL(28,4)) AS total_sales
FROM clean JOIN dim_product USING (stock_code) GROUP BY category""", money=["total_sales"])
def _(t):
    per_product = clean(t).groupBy("stock_code").agg(
        F.min_by("description", F.struct("invoice_ts", "invoice_no", "description")).alias("description"),
        F.sum("sales_amount").alias("sales_amount"),
    )
    return (sales.with_category(per_product, PART_RULES).groupBy("category").agg(_total())
            .orderBy(F.desc("total_sales"), "category"))


@query("retail_sales_by_store", f"""WITH {SALES}
SELECT 'Online - ' || country AS store_name, CAST(sum(sales_amount) AS DECIMAL(28,4)) AS total_sales
FROM clean GROUP BY 1""", money=["total_sales"])
def _(t):
    return (clean(t).groupBy("country").agg(_total())
            .select(F.concat(F.lit("Online - "), "country").alias("store_name"), "total_sales")
            .orderBy(F.desc("total_sales"), "store_name"))


@query("retail_top_products", f"""WITH {SALES}
SELECT stock_code, product_name, CAST(sum(quantity) AS BIGINT) AS units_sold,
  CAST(sum(sales_amount) AS DECIMAL(28,4)) AS total_sales
FROM clean JOIN dim_product USING (stock_code) GROUP BY ALL
ORDER BY total_sales DESC, stock_code LIMIT 20""", money=["total_sales"])
def _(t):
    return (
        clean(t).groupBy("stock_code")
        .agg(F.min_by("description", F.struct("invoice_ts", "invoice_no", "description")).alias("product_name"),
             F.sum("quantity").alias("units_sold"), _total())
        .orderBy(F.desc("total_sales"), "stock_code").limit(20)
    )


@query("retail_sales_daily", f"""WITH {SALES}
SELECT CAST(invoice_ts AS DATE) AS full_date, CAST(sum(sales_amount) AS DECIMAL(28,4)) AS total_sales
FROM clean GROUP BY 1""", money=["total_sales"], days=["full_date"])
def _(t):
    return clean(t).groupBy(F.to_date("invoice_ts").alias("full_date")).agg(_total())


# Loads: the warehouse holds everything before CUT_DAY, the batch everything from a year
# earlier, so the two overlap.
OVERLAP_DAY = "2000-01-01"


@query("upsert_ignore", """
SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
  CAST(o_orderdate AS DATE) AS full_date FROM orders""", days=["full_date"])
def _(t):
    old = t.orders.filter(F.col("o_orderdate") < F.lit(CUT_DAY).cast("timestamp_ntz"))
    new = t.orders.filter(F.col("o_orderdate") >= F.lit(OVERLAP_DAY).cast("timestamp_ntz"))
    merged = upsert.insert_absent(
        sales.date_dimension(old, "o_orderdate"), sales.date_dimension(new, "o_orderdate"), ["date_key"]
    )
    return merged.select("date_key", "full_date")


@query("upsert_scd1", """
WITH old AS (SELECT p_brand AS brand, min(p_name) AS label, row_number() OVER (ORDER BY p_brand) AS brand_key
             FROM part WHERE p_size <= 10 GROUP BY p_brand),
new AS (SELECT p_brand AS brand, max(p_name) AS label FROM part WHERE p_size > 10 GROUP BY p_brand),
fresh AS (SELECT brand, label, row_number() OVER (ORDER BY brand) + (SELECT max(brand_key) FROM old) AS brand_key
          FROM new WHERE brand NOT IN (SELECT brand FROM old))
SELECT old.brand, coalesce(new.label, old.label) AS label, brand_key FROM old LEFT JOIN new USING (brand)
UNION ALL SELECT brand, label, brand_key FROM fresh""")
def _(t):
    old = t.part.filter("p_size <= 10").groupBy(F.col("p_brand").alias("brand")).agg(
        F.min("p_name").alias("label"))
    new = t.part.filter("p_size > 10").groupBy(F.col("p_brand").alias("brand")).agg(
        F.max("p_name").alias("label"))
    return upsert.upsert_members(
        sales.surrogate_keys(old, "brand", "brand_key"), new, "brand", "brand_key"
    )


@query("upsert_fact", f"""WITH {SALES},
loaded AS (SELECT invoice_no, line_no, quantity, sales_amount FROM numbered
           WHERE invoice_ts < TIMESTAMP '{CUT_DAY} 00:00:00'),
batch AS (SELECT invoice_no, line_no, quantity, CAST(sales_amount * 2 AS DECIMAL(14,4)) AS sales_amount
          FROM numbered WHERE invoice_ts >= TIMESTAMP '{OVERLAP_DAY} 00:00:00')
SELECT * FROM batch UNION ALL
SELECT * FROM loaded ANTI JOIN batch USING (invoice_no, line_no)""", money=["sales_amount"])
def _(t):
    lines = staged(t).select("invoice_no", "line_no", "quantity", "sales_amount", "invoice_ts")
    lines = lines.withColumn("month", F.date_format("invoice_ts", "yyyyMM"))
    loaded = lines.filter(F.col("invoice_ts") < F.lit(CUT_DAY).cast("timestamp_ntz"))
    batch = lines.filter(F.col("invoice_ts") >= F.lit(OVERLAP_DAY).cast("timestamp_ntz")).withColumn(
        "sales_amount", (F.col("sales_amount") * 2).cast("decimal(14,4)"))
    fact = upsert.PartitionedTable(t.spark, scratch(t.spark, "fact"), ["invoice_no", "line_no"], "month")
    fact.upsert(loaded)
    fact.upsert(batch)
    return fact.read().select("invoice_no", "line_no", "quantity", "sales_amount")
