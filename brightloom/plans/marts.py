"""Marts, subscription metrics, forecasts, prices, ledger, tickets and retrieval."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.common import rounded
from brightloom.operators import marts as m
from brightloom.operators import retrieval as r
from brightloom.operators import vector_index
from brightloom.plans.registry import Tables, query
from brightloom.session import cut, shared_dir
from brightloom.session import stage as frozen


def month_text(df: DataFrame, *cols: str) -> DataFrame:
    return rounded(df).withColumns({c: F.col(c).cast("string") for c in cols})


def _later(step: str, before: str) -> str:
    return f"""(SELECT e.user_id, CAST(e.ts AS DATE) AS d, min(e.ts) AS t FROM events e JOIN {before} b ON b.user_id = e.user_id AND b.d = CAST(e.ts AS DATE) AND e.ts > b.t
  WHERE e.event_type = '{step}' GROUP BY 1, 2)"""


@query("funnel_dropoff", f"""WITH s1 AS (SELECT user_id, CAST(ts AS DATE) AS d, min(ts) AS t FROM events WHERE event_type = 'view' GROUP BY 1, 2),
s2 AS {_later('click', 's1')}, s3 AS {_later('signup', 's2')}, s4 AS {_later('purchase', 's3')},
n AS (SELECT (SELECT count(*) FROM s1) AS n1, (SELECT count(*) FROM s2) AS n2, (SELECT count(*) FROM s3) AS n3, (SELECT count(*) FROM s4) AS n4)
SELECT 1 AS position, 'view' AS step, n1 AS users, 1.0::DOUBLE AS conversion FROM n UNION ALL SELECT 2, 'click', n2, round(n2 / n1, 6) FROM n
UNION ALL SELECT 3, 'signup', n3, round(n3 / n2, 6) FROM n UNION ALL SELECT 4, 'purchase', n4, round(n4 / n3, 6) FROM n""")
def _(t):
    return rounded(m.funnel_dropoff(t.events, "user_id", "ts", "event_type", ["view", "click", "signup", "purchase"], F.to_date("ts")))


def stage(t: Tables) -> dict[str, DataFrame]:
    """One staging frame per source table, renamed only; the SQL models take them as arguments."""
    return {
        "stg_orders": t.orders.selectExpr("o_orderkey AS order_id", "o_custkey AS customer_id", "o_orderstatus AS status", "o_orderdate AS ordered_at"),
        "stg_lines": t.lineitem.selectExpr("l_orderkey AS order_id", "l_partkey AS product_id", "l_linenumber AS line_no", "l_quantity AS quantity",
                                           "CAST(l_extendedprice AS DECIMAL(14,2)) AS amount", "CAST(l_discount AS DECIMAL(4,2)) AS discount"),
        "stg_customers": t.customer.selectExpr("c_custkey AS customer_id", "c_name AS name", "c_mktsegment AS segment"),
        "stg_products": t.part.selectExpr("p_partkey AS product_id", "p_name AS name", "p_type AS type"),
    }


@query("mart_fct_orders", """SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_day, o_orderstatus AS status,
  l_quantity AS quantity, CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net_amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey""", money=["net_amount"], days=["order_day"])
def _(t):
    return t.spark.sql("""SELECT l.order_id, l.line_no, l.product_id, o.customer_id, CAST(o.ordered_at AS DATE) AS order_day, o.status, l.quantity,
      CAST(l.amount * (1 - l.discount) AS DECIMAL(18,4)) AS net_amount FROM {stg_lines} l JOIN {stg_orders} o USING (order_id)""", **stage(t))


@query("mart_dim_customers", """SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment, CAST(min(o_orderdate) AS DATE) AS first_order, CAST(max(o_orderdate) AS DATE) AS last_order, count(o_orderkey) AS orders
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL""", days=["first_order", "last_order"])
def _(t):
    return t.spark.sql("""WITH o AS (SELECT customer_id, CAST(min(ordered_at) AS DATE) AS first_order, CAST(max(ordered_at) AS DATE) AS last_order, count(*) AS orders FROM {stg_orders} GROUP BY customer_id)
      SELECT c.customer_id, c.name, c.segment, o.first_order, o.last_order, coalesce(o.orders, 0L) AS orders FROM {stg_customers} c LEFT JOIN o USING (customer_id)""", **stage(t))


@query("mart_dim_products", """SELECT p_partkey AS product_id, p_name AS name, p_type AS type, count(l_orderkey) AS lines, coalesce(CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT), 0) AS units
FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY ALL""")
def _(t):
    return t.spark.sql("""WITH l AS (SELECT product_id, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units FROM {stg_lines} GROUP BY product_id)
      SELECT p.product_id, p.name, p.type, coalesce(l.lines, 0L) AS lines, coalesce(l.units, 0L) AS units FROM {stg_products} p LEFT JOIN l USING (product_id)""", **stage(t))


@query("mart_tests", """SELECT 'unique order' AS test, count(*) AS failures FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique line order', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'not null user', count(*) FROM events WHERE user_id IS NULL
UNION ALL SELECT 'events have suppliers', count(*) FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""")
def _(t):
    return m.failing_rows({
        "unique order": m.unique_violations(t.orders, "o_orderkey"), "unique line order": m.unique_violations(t.lineitem, "l_orderkey"),
        "not null user": m.null_violations(t.events, "user_id"),
        "events have suppliers": m.relationship_violations(t.events, "user_id", t.supplier, "s_suppkey")})


SCD2 = """WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority FROM orders GROUP BY 1, 2),
c AS (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS p FROM d)
SELECT o_custkey, o_orderpriority, valid_from, lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current FROM c WHERE p IS NULL OR p <> o_orderpriority WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from)"""


@query("mart_scd2", SCD2, days=["valid_from", "valid_to"])
def _(t):
    return m.attribute_history(t.orders, "o_custkey", "o_orderdate", "o_orderpriority", "o_orderkey")


@query("mart_scd2_merge", SCD2, days=["valid_from", "valid_to"])
def _(t):
    """The same history from four batches in no order of time, one of them twice."""
    share = F.pmod(F.col("o_orderkey"), F.lit(4))
    batches = [t.orders.filter(share == i) for i in (2, 0, 3, 1)]
    names = ("o_custkey", "o_orderdate", "o_orderpriority", "o_orderkey")
    history = frozen(m.open_history(batches[0], *names))
    for batch in (*batches[1:], batches[1]):
        history = frozen(m.merge_history(history, batch, *names))
    return history.drop("seen")


@query("mart_monthly_revenue", """WITH f AS (SELECT o_custkey, date_trunc('month', min(o_orderdate)) AS f FROM orders GROUP BY 1)
SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(20,2)) AS revenue, count(DISTINCT o_custkey) AS active_customers,
  count(DISTINCT o_custkey) FILTER (WHERE f = date_trunc('month', o_orderdate)) AS new_customers FROM orders JOIN f USING (o_custkey) GROUP BY 1""", money=["revenue"])
def _(t):
    return month_text(m.revenue_trend(t.orders, "o_custkey", "o_orderdate", "o_totalprice"), "month")


MRR = """mo AS (SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(20,2)) AS mrr FROM orders GROUP BY 1, 2),
lg AS (SELECT *, lag(month) OVER w AS pm, lag(mrr) OVER w AS pv, lead(month) OVER w AS nm FROM mo WINDOW w AS (PARTITION BY customer ORDER BY month)),
mv AS (SELECT customer, month, CASE WHEN pm IS NULL OR pm <> month - INTERVAL 1 MONTH THEN 'new' WHEN mrr > pv THEN 'expansion' WHEN mrr < pv THEN 'contraction' END AS kind,
   CAST(mrr - CASE WHEN pm = month - INTERVAL 1 MONTH THEN pv ELSE 0 END AS DECIMAL(20,2)) AS amount FROM lg
 UNION ALL SELECT customer, CAST(month + INTERVAL 1 MONTH AS DATE), 'churned', CAST(-mrr AS DECIMAL(20,2)) FROM lg WHERE (nm IS NULL OR nm <> month + INTERVAL 1 MONTH) AND month < (SELECT max(month) FROM mo)),
br AS (SELECT month, """ + ", ".join(f"CAST(coalesce(sum(amount) FILTER (WHERE kind = '{k}'), 0) AS DECIMAL(20,2)) AS {k}" for k in ("new", "expansion", "contraction", "churned")) + " FROM mv WHERE kind IS NOT NULL GROUP BY month)"


def monthly(t: Tables) -> DataFrame:
    """Customer months, frozen: movements and cohorts read them more than once."""
    return cut(m.monthly_amounts(t.orders, "o_custkey", "o_orderdate", "o_totalprice"))


@query("saas_mrr_bridge", f"WITH {MRR} SELECT CAST(month AS VARCHAR) AS month, new, expansion, contraction, churned FROM br", money=["new", "expansion", "contraction", "churned"])
def _(t):
    return month_text(m.movement_bridge(m.movements(monthly(t))), "month")


@query("saas_mrr_reconcile", f"""WITH {MRR}, e AS (SELECT month, sum(mrr) AS e FROM mo GROUP BY 1), j AS (SELECT br.*, CAST(coalesce(e, 0) AS DECIMAL(20,2)) AS end_mrr FROM br LEFT JOIN e USING (month)),
s AS (SELECT *, CAST(coalesce(lag(end_mrr) OVER (ORDER BY month), 0) AS DECIMAL(20,2)) AS start_mrr, CAST(new + expansion + contraction + churned AS DECIMAL(20,2)) AS net_change FROM j)
SELECT CAST(month AS VARCHAR) AS month, start_mrr, net_change, end_mrr, CAST(start_mrr + net_change - end_mrr AS DECIMAL(20,2)) AS difference FROM s""", money=["start_mrr", "net_change", "end_mrr", "difference"])
def _(t):
    mo = monthly(t)
    return month_text(m.reconcile(mo, m.movement_bridge(m.movements(mo))), "month")


@query("saas_cohort_retention", """WITH mo AS (SELECT DISTINCT o_custkey AS c, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders), f AS (SELECT c, min(month) AS cohort FROM mo GROUP BY 1),
z AS (SELECT cohort, count(*) AS cohort_size FROM f GROUP BY 1)
SELECT CAST(cohort AS VARCHAR) AS cohort, CAST(date_diff('month', cohort, month) AS INTEGER) AS month_no, count(*) AS active, any_value(cohort_size) AS cohort_size, round(count(*) / any_value(cohort_size), 6) AS retention
FROM mo JOIN f USING (c) JOIN z USING (cohort) GROUP BY cohort, 2""")
def _(t):
    return month_text(m.cohort_retention(monthly(t)), "cohort")


@query("saas_events", f"""WITH {MRR} SELECT customer, CAST(month AS VARCHAR) AS month, CASE kind WHEN 'new' THEN 'signup' WHEN 'expansion' THEN 'upgrade' WHEN 'contraction' THEN 'downgrade' ELSE 'cancellation' END AS event, amount
FROM mv WHERE kind IS NOT NULL""", money=["amount"])
def _(t):
    return month_text(m.subscription_events(m.movements(monthly(t))), "month")


DEMAND = """sold AS (SELECT p_type AS item, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(sum(l_quantity) AS DOUBLE) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
sp AS (SELECT item, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM (SELECT DISTINCT item FROM sold), (SELECT min(month) AS lo, max(month) AS hi FROM sold)),
dem AS (SELECT item, month, coalesce(q, 0) AS demand FROM sp LEFT JOIN sold USING (item, month))"""


def demand(t: Tables) -> DataFrame:
    """Units by part type; lines are folded per part before they meet the part table."""
    per_part = t.lineitem.groupBy("l_partkey", m.month_of("l_shipdate").alias("month")).agg(F.sum("l_quantity").alias("q"))
    df = per_part.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return cut(m.monthly_demand(df, "p_type", "month", "q"))


@query("fc_seasonal_naive", f"WITH {DEMAND} SELECT item, CAST(month AS VARCHAR) AS month, demand, lag(demand, 12) OVER (PARTITION BY item ORDER BY month) AS forecast FROM dem")
def _(t):
    return month_text(m.seasonal_naive(demand(t)), "month")


@query("fc_features", f"WITH {DEMAND} SELECT item, CAST(month AS VARCHAR) AS month, demand, " + ", ".join(f"lag(demand, {n}) OVER w AS lag_{n}" for n in (1, 2, 3, 12)) + ", "
       + ", ".join(f"round(avg(demand) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 6) AS mean_{n}, max(demand) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS max_{n}" for n in (3, 6, 12))
       + " FROM dem WINDOW w AS (PARTITION BY item ORDER BY month)")
def _(t):
    return month_text(m.demand_features(demand(t)), "month")


BACKTEST = f"""{DEMAND}, k AS (SELECT *, avg(demand) OVER (PARTITION BY item ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mean_fc, lag(demand, 12) OVER (PARTITION BY item ORDER BY month) AS naive_fc FROM dem),
o AS (SELECT item, month AS origin, mean_fc FROM k, (SELECT max(month) AS hi FROM dem) WHERE month <= hi - INTERVAL 3 MONTH AND month > hi - INTERVAL 15 MONTH),
x AS (SELECT o.item, k.demand, o.mean_fc, k.naive_fc FROM o, (SELECT unnest([1, 2, 3]) AS h), k WHERE k.item = o.item AND k.month = o.origin + to_months(h::INTEGER)),
lo AS (SELECT item, demand, 'rolling_mean' AS method, mean_fc AS fc FROM x UNION ALL SELECT item, demand, 'seasonal_naive', naive_fc FROM x WHERE naive_fc IS NOT NULL)"""


@query("fc_backtest_wape", f"""WITH {BACKTEST} SELECT item, method, count(*) AS n, round(avg(abs(demand - fc) / demand) FILTER (WHERE demand <> 0) * 100, 6) AS mape, round(sum(abs(demand - fc)) / sum(demand) * 100, 6) AS wape FROM lo GROUP BY ALL""")
def _(t):
    return rounded(m.backtest(demand(t)))


@query("cap_inventory", f"""WITH {DEMAND}, k AS (SELECT *, avg(demand) OVER (PARTITION BY item ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent, lag(demand, 11) OVER (PARTITION BY item ORDER BY month) AS forecast FROM dem)
SELECT item, round(recent, 6) AS recent, forecast, CASE WHEN forecast IS NULL THEN 'no history' WHEN forecast > k.recent * 1.1 THEN 'reorder' WHEN forecast < k.recent * 0.9 THEN 'reduce' ELSE 'hold' END AS advice
FROM k WHERE month = (SELECT max(month) FROM dem)""")
def _(t):
    return rounded(m.inventory_advice(demand(t)))


PRICES = """px AS (SELECT event_type AS ticker, CAST(ts AS DATE) AS day, arg_max(value, (ts, event_id)) AS close, max(value) AS high, min(value) AS low, count(*) AS volume FROM events GROUP BY 1, 2),
rt AS (SELECT *, close / lag(close) OVER w - 1 AS ret FROM px WINDOW w AS (PARTITION BY ticker ORDER BY day)),
ft AS (SELECT ticker, day, close, volume, ret, CASE WHEN row_number() OVER w >= 10 THEN avg(close) OVER (w ROWS 2 PRECEDING) / avg(close) OVER (w ROWS 9 PRECEDING) - 1 END AS trend,
  close / lag(close, 10) OVER w - 1 AS momentum, CASE WHEN row_number() OVER w > 10 THEN CAST(close > max(high) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS INTEGER) END AS breakout,
  CASE WHEN row_number() OVER w > 10 THEN volume / avg(volume) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) END AS volume_ratio,
  CASE WHEN count(ret) OVER (w ROWS 9 PRECEDING) = 10 THEN stddev_samp(ret) OVER (w ROWS 9 PRECEDING) END AS volatility FROM rt WINDOW w AS (PARTITION BY ticker ORDER BY day)),
sc AS (SELECT *, CASE WHEN trend > 0 THEN 30 ELSE 0 END + CASE WHEN momentum > 0 THEN 25 ELSE 0 END + CASE WHEN breakout = 1 THEN 20 ELSE 0 END + CASE WHEN volume_ratio > 1 THEN 15 ELSE 0 END
  + CASE WHEN volatility < 1 THEN 10 ELSE 0 END AS score FROM ft WHERE volatility IS NOT NULL),
rk AS (SELECT ticker, day, score, CAST(dense_rank() OVER (PARTITION BY day ORDER BY score DESC) AS INTEGER) AS position, CASE WHEN score >= 70 THEN 'A' WHEN score >= 40 THEN 'B' ELSE 'C' END AS tier FROM sc)"""


def prices(t: Tables) -> DataFrame:
    return cut(m.daily_prices(t.events, "event_type", "ts", "value", "event_id"))


@query("px_features", f"WITH {PRICES} SELECT ticker, day, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("ret", "trend", "momentum", "volume_ratio", "volatility")) + ", breakout FROM ft", days=["day"])
def _(t):
    return rounded(m.price_features(prices(t)).select("ticker", "day", "ret", "trend", "momentum", "volume_ratio", "volatility", "breakout"))


@query("px_score", f"WITH {PRICES} SELECT * FROM rk", days=["day"])
def _(t):
    return m.price_score(m.price_features(prices(t)))


@query("px_forward_return", f"""WITH {PRICES}, ah AS (SELECT ticker, day, lead(close, 1) OVER w / close - 1 AS r1, lead(close, 3) OVER w / close - 1 AS r3, lead(close, 5) OVER w / close - 1 AS r5 FROM px WINDOW w AS (PARTITION BY ticker ORDER BY day)),
lo AS (""" + " UNION ALL ".join(f"SELECT tier, {h} AS hold, r{h} AS r FROM rk JOIN ah USING (ticker, day) WHERE r{h} IS NOT NULL" for h in (1, 3, 5)) + """)
SELECT tier, hold, count(*) AS n, round(avg(r), 6) AS mean_return, round(count(*) FILTER (WHERE r > 0) / count(*), 6) AS hit_rate FROM lo GROUP BY ALL""")
def _(t):
    p = prices(t)
    return rounded(m.forward_returns(m.price_score(m.price_features(p)), p))


@query("px_drawdown", f"WITH {PRICES} SELECT ticker, round(min(d), 6) AS max_drawdown FROM (SELECT ticker, close / max(close) OVER (PARTITION BY ticker ORDER BY day) - 1 AS d FROM px) GROUP BY 1")
def _(t):
    return rounded(m.drawdown(prices(t)))


RULES = [("ring", "jewels"), ("rod", "tools"), ("red", "colour"), ("cold", "climate"), ("hot", "climate"), ("widget", "parts"), ("old ring", "antiques")]
LEDGER = """led AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CASE WHEN p_name LIKE '%old ring%' THEN 'antiques' WHEN p_name LIKE '%widget%' THEN 'parts'
  WHEN p_name LIKE '%ring%' THEN 'jewels' WHEN p_name LIKE '%cold%' THEN 'climate' WHEN p_name LIKE '%rod%' THEN 'tools' WHEN p_name LIKE '%red%' THEN 'colour'
  WHEN p_name LIKE '%hot%' THEN 'climate' ELSE 'other' END AS category,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS spend FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def ledger(t: Tables) -> DataFrame:
    per_part = t.lineitem.groupBy("l_partkey", m.month_of("l_shipdate").alias("month")).agg(F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).alias("spend"))
    named = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return named.groupBy("month", m.categorize(F.col("p_name"), RULES).alias("category")).agg(F.sum("spend").cast("decimal(20,2)").alias("spend"))


@query("exp_monthly", f"WITH {LEDGER} SELECT CAST(month AS VARCHAR) AS month, category, spend FROM led", money=["spend"])
def _(t):
    return month_text(ledger(t), "month")


@query("exp_mom", f"""WITH {LEDGER}, p AS (SELECT *, CASE WHEN CAST(lag(month) OVER w AS DATE) = CAST(CAST(month AS DATE) - INTERVAL 1 MONTH AS DATE) THEN lag(spend) OVER w END AS previous FROM led WINDOW w AS (PARTITION BY category ORDER BY month))
SELECT CAST(month AS VARCHAR) AS month, category, spend, previous, CAST(spend - previous AS DECIMAL(21,2)) AS change, round(CAST(spend - previous AS DOUBLE) / CAST(previous AS DOUBLE) * 100, 6) AS change_pct FROM p""", money=["spend", "previous", "change"])
def _(t):
    return month_text(m.month_over_month(ledger(t), "category", "spend"), "month")


FAQ = [("refund", "see the refund page"), (" und ", "see the German page"), (" les ", "see the French page"), ("with", "see the English page")]


@query("triage_batch", """WITH k AS (SELECT conv_id || '/' || turn AS ticket, lower(text) AS x, o_orderstatus AS s, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS age
  FROM conversations LEFT JOIN orders ON o_orderkey = conv_id WHERE role = 'user'),
f AS (SELECT *, CASE WHEN contains(x, 'refund') THEN 'see the refund page' WHEN contains(x, ' und ') THEN 'see the German page' WHEN contains(x, ' les ') THEN 'see the French page' WHEN contains(x, 'with') THEN 'see the English page' ELSE '' END AS faq FROM k),
a AS (SELECT *, CASE WHEN s = 'F' AND age <= 700 THEN 'return' WHEN s IS NOT NULL THEN 'status' WHEN faq <> '' THEN 'faq' ELSE 'escalate' END AS action FROM f)
SELECT ticket, action, CASE action WHEN 'return' THEN 'return until day 700' WHEN 'status' THEN 'order is ' || s WHEN 'faq' THEN faq END AS answer FROM a""")
def _(t):
    """Every user turn is a ticket; tickets without an order are answered from the FAQ."""
    turns = t.conversations.filter("role = 'user'").select(
        F.concat_ws("/", "conv_id", "turn").alias("ticket"), F.col("conv_id").alias("order_key"), "text")
    known = t.orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("ordered"))
    return m.triage(turns, known, FAQ, F.lit("2001-08-02").cast("date"), 700)


@query("rag_chunks", """WITH c AS (SELECT doc_id, text, unnest(range(0, CAST(greatest(0, ceil((length(text) - 500) / 400.0)) AS BIGINT) + 1)) AS i FROM documents WHERE length(text) > 0)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, substr(text, i * 400 + 1, 500) AS chunk FROM c""")
def _(t):
    return r.chunks(t.documents, "doc_id", "text")


RAG = """qd AS (SELECT label, unnest(range(1, 65)) AS d, unnest(embedding) AS x FROM embeddings), qm AS (SELECT label, d, CAST(avg(CAST(x AS DOUBLE)) AS FLOAT) AS x FROM qd GROUP BY 1, 2),
qv AS (SELECT label::BIGINT AS query_id, list(CAST(x AS DOUBLE) ORDER BY d) AS v FROM qm GROUP BY 1), pv AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
hit AS (SELECT query_id, vec_id AS passage_id, label, round(list_cosine_similarity(qv.v, pv.v), 6) AS cosine, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(qv.v, pv.v), 12) DESC, vec_id) AS INTEGER) AS position FROM qv, pv QUALIFY position <= 5)"""


def top(t: Tables) -> DataFrame:
    passages = t.embeddings.select(F.col("vec_id").alias("passage_id"), F.col("embedding").alias("vector"))
    return r.top_k(r.mean_vectors(t.embeddings, "label", "embedding"), passages)


@query("rag_topk", f"WITH {RAG} SELECT query_id, passage_id, cosine, position FROM hit")
def _(t):
    return rounded(top(t))


@query("rag_hit_rate", f"WITH {RAG}, p AS (SELECT query_id, avg(CAST(label = query_id AS INTEGER)) AS p FROM hit GROUP BY 1) SELECT count(*) AS queries, round(avg(CAST(p > 0 AS INTEGER)), 6) AS hit_rate, round(avg(p), 6) AS \"precision\" FROM p")
def _(t):
    labels = t.embeddings.select(F.col("vec_id").alias("passage_id"), F.col("label").alias("passage_label"))
    queries = t.embeddings.select(F.col("label").cast("long").alias("query_id"), F.col("label").alias("query_label")).distinct()
    return rounded(r.hit_rate(top(t), queries, labels))


NEIGHBOURS = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
hit AS (SELECT q.vec_id AS query_id, p.vec_id AS passage_id, round(list_cosine_similarity(q.x, p.x), 6) AS cosine, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.x, p.x), 12) DESC, p.vec_id) AS INTEGER) AS position
  FROM v q JOIN v p ON q.vec_id <> p.vec_id WHERE q.vec_id % 50 = 0 QUALIFY position <= 5)"""


def neighbours(t: Tables) -> DataFrame:
    """Five nearest other passages of every fiftieth one, through the index."""
    index = vector_index.build(t.embeddings, "vec_id", "embedding", f"{shared_dir(t.spark)}/vectors-{uuid.uuid4().hex}")
    asked = t.embeddings.filter("vec_id % 50 = 0")
    probes = vector_index.choose_probes(index, asked, "vec_id", "embedding", 5, 0.93, others=True)
    return vector_index.search(index, asked, "vec_id", "embedding", 5, probes, others=True)


@query("rag_index_topk", f"{NEIGHBOURS} SELECT query_id, passage_id, cosine, position FROM hit")
def _(t):
    return rounded(neighbours(t).drop("probed"))


@query("rag_index_recall", f"{NEIGHBOURS} SELECT count(DISTINCT query_id) AS queries, count(*) AS hits, true AS recall_reached FROM hit")
def _(t):
    """What the lists read first find of the true hits: 0.9 at least."""
    return neighbours(t).agg(F.countDistinct("query_id").alias("queries"), F.count(F.lit(1)).alias("hits"), (F.avg(F.col("probed").cast("int")) >= 0.9).alias("recall_reached"))
