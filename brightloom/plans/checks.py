"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.operators import quality as q
from brightloom.operators import sales
from brightloom.plans.registry import query
from brightloom.plans.retail import SALES, products, raw_sales, staged, stores
from brightloom.session import cut, stage

RAW_COLUMNS = ["invoice_no", "stock_code", "description", "invoice_ts", "quantity", "unit_price", "customer_id"]


@query("dq_null_counts", f"WITH {SALES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM raw_sales"
    for c in RAW_COLUMNS))
def _(t):
    return q.null_counts(raw_sales(t), RAW_COLUMNS)


@query("dq_duplicate_keys", """
SELECT 'orders' AS check_name, CAST(count(*) - count(DISTINCT o_orderkey) AS BIGINT) AS duplicates FROM orders
UNION ALL SELECT 'part', count(*) - count(DISTINCT p_partkey) FROM part
UNION ALL SELECT 'nation', count(*) - count(DISTINCT n_nationkey) FROM nation
UNION ALL SELECT 'lineitem', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""")
def _(t):
    return q.duplicate_keys({
        "orders": (t.orders, ["o_orderkey"]), "part": (t.part, ["p_partkey"]),
        "nation": (t.nation, ["n_nationkey"]), "lineitem": (t.lineitem, ["l_orderkey", "l_linenumber"]),
    })


REFS = """
SELECT 'orders' AS reference, count(DISTINCT l_orderkey) AS missing_keys FROM lineitem ANTI JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'active_customers', count(DISTINCT o_custkey) FROM orders
  ANTI JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o_custkey = c_custkey
UNION ALL SELECT 'event_users', count(DISTINCT user_id) FROM events ANTI JOIN supplier ON user_id = s_suppkey"""


@query("dq_ref_integrity", REFS)
def _(t):
    return q.missing_references(t.lineitem, {"orders": ("l_orderkey", t.orders, "o_orderkey")}).unionByName(
        q.missing_references(t.orders, {"active_customers": ("o_custkey", t.customer.filter("c_acctbal >= 0"), "c_custkey")})
    ).unionByName(q.missing_references(t.events, {"event_users": ("user_id", t.supplier, "s_suppkey")}))


@query("dq_orphans", """
SELECT event_id, user_id FROM events ANTI JOIN supplier ON user_id = s_suppkey""")
def _(t):
    return q.orphans(t.events, "user_id", t.supplier, "s_suppkey").select("event_id", "user_id")


@query("dq_warehouse_suite", f"""WITH {SALES}
SELECT 'fact rows' AS check_name, count(*) AS value, count(*) > 0 AS ok FROM numbered
UNION ALL SELECT 'missing dates', 0, true UNION ALL SELECT 'missing stores', 0, true
UNION ALL SELECT 'missing products', 0, true
UNION ALL SELECT 'duplicate facts', count(*), count(*) = 0 FROM
  (SELECT 1 FROM numbered GROUP BY invoice_no, line_no HAVING count(*) > 1)
UNION ALL SELECT 'null measures', count(*), count(*) = 0 FROM numbered
  WHERE quantity IS NULL OR unit_price IS NULL OR sales_amount IS NULL""")
def _(t):
    numbered = staged(t)
    dim_store, dim_product = cut(stores(numbered)), cut(products(numbered))
    fact = stage(sales.resolve_fact(sales.fact_stage(numbered), dim_store, dim_product))
    return q.warehouse_suite(
        fact,
        {"dates": ("date_key", sales.date_dimension(numbered, "invoice_ts"), "date_key"),
         "stores": ("store_key", dim_store, "store_key"),
         "products": ("product_key", dim_product, "product_key")},
        ["invoice_no", "line_no"], ["quantity", "unit_price", "sales_amount"],
    )


CONTRACTS = {
    "nation": {"required_columns": ["n_nationkey", "n_name"],
               "validation": {"n_name": {"unique_count_min": 30, "unique_count_max": 40},
                              "n_nationkey": {"min": 0, "max": 24}}},
    "customer": {"required_columns": ["c_custkey", "c_name", "c_phone"],
                 "validation": {"c_acctbal": {"min": 0, "max": 10000},
                                "c_mktsegment": {"unique_count_max": 4}, "c_name": {"min": 0}}},
    "lineitem": {"required_columns": ["l_orderkey", "l_quantity"],
                 "validation": {"l_quantity": {"min": 1, "max": 50}, "l_discount": {"min": 0, "max": 0.09}}},
}


CONTRACT_SQL = """
SELECT 'nation' AS dataset, 'n_name: ' || count(DISTINCT n_name) || ' distinct values, minimum 30' AS violation
  FROM nation HAVING count(DISTINCT n_name) < 30
UNION ALL SELECT 'nation', 'n_nationkey: above 24' FROM nation HAVING max(n_nationkey) > 24
UNION ALL SELECT 'customer', 'missing column c_phone'
UNION ALL SELECT 'customer', 'c_acctbal: below 0' FROM customer HAVING min(c_acctbal) < 0
UNION ALL SELECT 'customer', 'c_acctbal: above 10000' FROM customer HAVING max(c_acctbal) > 10000
UNION ALL SELECT 'customer', 'c_mktsegment: ' || count(DISTINCT c_mktsegment) || ' distinct values, maximum 4'
  FROM customer HAVING count(DISTINCT c_mktsegment) > 4
UNION ALL SELECT 'customer', 'c_name: non-numeric values' FROM customer
  HAVING count(*) FILTER (WHERE try_cast(c_name AS DOUBLE) IS NULL) > 0 AND count(*) FILTER (WHERE c_name IS NULL) = 0
UNION ALL SELECT 'lineitem', 'l_quantity: below 1' FROM lineitem HAVING min(l_quantity) < 1
UNION ALL SELECT 'lineitem', 'l_quantity: above 50' FROM lineitem HAVING max(l_quantity) > 50
UNION ALL SELECT 'lineitem', 'l_discount: above 0.09' FROM lineitem HAVING max(l_discount) > 0.09"""


@query("dq_contract", CONTRACT_SQL)
def _(t):
    return q.union_all([q.contract_violations(getattr(t, n), n, c) for n, c in CONTRACTS.items()])


@query("dq_contract_batch", f"""
WITH v AS ({CONTRACT_SQL}), d AS (SELECT unnest(['nation', 'customer', 'lineitem', 'supplier']) AS dataset)
SELECT d.dataset, count(v.violation) AS violations,
  CASE WHEN count(v.violation) = 0 THEN 'pass' ELSE 'fail' END AS status
FROM d LEFT JOIN v USING (dataset) GROUP BY d.dataset""")
def _(t):
    sets = {n: (getattr(t, n), c) for n, c in CONTRACTS.items()}
    sets["supplier"] = (t.supplier, {"required_columns": ["s_suppkey"], "validation": {"s_acctbal": {"max": 1000000}}})
    return q.contract_batch(sets)


@query("dq_merged_table", """
WITH m AS (SELECT c_nationkey, avg(c_acctbal) AS balance, max(c_acctbal) AS top FROM customer GROUP BY 1)
SELECT 'expected 30 rows, got ' || count(*) AS violation FROM m HAVING count(*) <> 30
UNION ALL SELECT 'missing column late_share'
UNION ALL SELECT 'top: outside 0 to 9500' FROM m HAVING count(*) FILTER (WHERE top NOT BETWEEN 0 AND 9500) > 0
UNION ALL SELECT 'balance: outside 0 to 10000' FROM m HAVING count(*) FILTER (WHERE balance NOT BETWEEN 0 AND 10000) > 0""")
def _(t):
    merged = t.customer.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("balance"), F.max("c_acctbal").alias("top"))
    return q.merged_table_violations(
        merged, "c_nationkey", 30, {"balance": (0, 10000), "top": (0, 9500), "late_share": (0, 1)})


@query("dq_report", """
SELECT 'schema' AS check_name, 'FAIL' AS status, 'c_phone' AS detail
UNION ALL SELECT 'duplicate_rows', CASE WHEN count(*) > count(DISTINCT (c_name, c_nationkey, c_acctbal, c_mktsegment))
  THEN 'WARNING' ELSE 'PASS' END, CAST(count(*) - count(DISTINCT (c_name, c_nationkey, c_acctbal, c_mktsegment)) AS VARCHAR) FROM customer
UNION ALL SELECT 'invalid_categories', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(count(DISTINCT c_mktsegment) AS VARCHAR)
  FROM customer WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')
UNION ALL SELECT 'impossible_values', CASE WHEN min(c_acctbal) < 0 THEN 'FAIL' ELSE 'PASS' END,
  CASE WHEN min(c_acctbal) < 0 THEN 'c_acctbal' ELSE '' END FROM customer""")
def _(t):
    df = t.customer
    absent = [c for c in ["c_custkey", "c_acctbal", "c_mktsegment", "c_phone"] if c not in df.columns]
    schema = df.sparkSession.createDataFrame(
        [("schema", "FAIL" if absent else "PASS", ", ".join(absent))], "check_name string, status string, detail string")
    dup = q.duplicate_rows(df, ["c_custkey"]).select(
        F.lit("duplicate_rows").alias("check_name"),
        F.when(F.col("duplicate_rows") > 0, "WARNING").otherwise("PASS").alias("status"),
        F.col("duplicate_rows").cast("string").alias("detail"))
    cats = q.invalid_categories(df, {"c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]}).agg(
        F.count(F.lit(1)).alias("n")).select(
        F.lit("invalid_categories").alias("check_name"),
        F.when(F.col("n") > 0, "FAIL").otherwise("PASS").alias("status"), F.col("n").cast("string").alias("detail"))
    limits = q.impossible_values(df, {"c_acctbal": (0, None)}).filter("verdict <> 'ok'").agg(
        F.count(F.lit(1)).alias("n"), F.concat_ws(", ", F.sort_array(F.collect_list("column_name"))).alias("detail")
    ).select(F.lit("impossible_values").alias("check_name"),
             F.when(F.col("n") > 0, "FAIL").otherwise("PASS").alias("status"), "detail")
    return q.union_all([schema, dup, cats, limits])


MISSING = ["doc_id", "text", "lang", "source", "quality", "toxic"]


@query("dq_missing_profile", "WITH j AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) "
       + " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL{" OR regexp_full_match(" + c + ", '\\s*')" if c in ("text", "lang", "source") else ""}) AS missing_count,
  round(count(*) FILTER (WHERE {c} IS NULL{" OR regexp_full_match(" + c + ", '\\s*')" if c in ("text", "lang", "source") else ""}) * 100.0 / count(*), 2) AS missing_pct FROM j"""
                            for c in MISSING))
def _(t):
    return q.missing_profile(t.documents.join(t.labels, "doc_id", "left"), MISSING)


@query("dq_duplicate_rows", """
SELECT CAST(count(*) - count(DISTINCT (l_partkey, l_quantity, l_returnflag)) AS BIGINT) AS duplicate_rows FROM lineitem""")
def _(t):
    return q.duplicate_rows(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag"), ["l_orderkey"])


@query("dq_invalid_categories", """
SELECT 'o_orderpriority' AS column_name, o_orderpriority AS value, count(*) AS rows FROM orders
  WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 2
UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 2""")
def _(t):
    return q.invalid_categories(t.orders, {
        "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"], "o_orderstatus": ["O", "F"], "absent": ["x"]})


@query("dq_impossible", """
SELECT 'c_acctbal' AS column_name, min(c_acctbal) AS min_value, max(c_acctbal) AS max_value,
  CASE WHEN min(c_acctbal) < 0 THEN 'below minimum' ELSE 'ok' END AS verdict FROM customer
UNION ALL SELECT 'c_nationkey', min(c_nationkey)::DOUBLE, max(c_nationkey)::DOUBLE,
  CASE WHEN min(c_nationkey) < 0 THEN 'below minimum' WHEN max(c_nationkey) > 20 THEN 'above maximum' ELSE 'ok' END FROM customer""")
def _(t):
    return q.impossible_values(t.customer, {"c_acctbal": (0, None), "c_nationkey": (0, 20)})


@query("dq_target_balance", """
SELECT quality, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM labels WHERE quality IS NOT NULL), 2) AS pct
FROM labels WHERE quality IS NOT NULL GROUP BY quality""")
def _(t):
    return q.label_balance(t.labels, "quality")


def _iqr_sql(table: str, col: str) -> str:
    return f"""SELECT '{col}' AS column_name, count(*) FILTER (WHERE v < low OR v > high) AS outliers,
  round(count(*) FILTER (WHERE v < low OR v > high) * 100.0 / count(*), 2) AS outlier_pct,
  round(max(low), 2) AS low, round(max(high), 2) AS high
FROM (SELECT {col} AS v FROM {table}), (SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM
  (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {table}))"""


@query("dq_iqr_outliers", _iqr_sql("events", "value") + " UNION ALL " + _iqr_sql("lineitem", "l_extendedprice"))
def _(t):
    return q.iqr_outliers(t.events, "value").unionByName(q.iqr_outliers(t.lineitem, "l_extendedprice"))


@query("dq_conflicting_keys", """
SELECT l_orderkey, l_linenumber, count(DISTINCT (l_partkey, l_quantity)) AS variants, count(*) AS rows
FROM lineitem GROUP BY ALL HAVING count(DISTINCT (l_partkey, l_quantity)) > 1""")
def _(t):
    return q.conflicting_keys(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_quantity"])


@query("dq_exact_dedup", "SELECT DISTINCT l_suppkey, l_quantity, l_discount FROM lineitem")
def _(t):
    cols = ["l_suppkey", "l_quantity", "l_discount"]
    return q.drop_exact_duplicates(t.lineitem.select(*cols), cols)


@query("dq_join_sides", """
WITH a AS (SELECT DISTINCT n_nationkey AS k FROM nation WHERE n_regionkey <= 3),
b AS (SELECT DISTINCT s_nationkey AS k FROM supplier)
SELECT coalesce(a.k, b.k) AS nationkey, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both'
  WHEN a.k IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side FROM a FULL JOIN b ON a.k = b.k""")
def _(t):
    return q.join_sides(
        t.nation.filter("n_regionkey <= 3").select(F.col("n_nationkey").alias("nationkey")),
        t.supplier.select(F.col("s_nationkey").alias("nationkey")), "nationkey")
