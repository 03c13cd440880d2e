import itertools
from datetime import date, datetime
from decimal import Decimal as D

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from brightloom.operators import marts as m
from brightloom.operators import retrieval as r


def test_movements(frame):
    df = frame([("a", date(2024, 1, 1), D("10.00")), ("a", date(2024, 2, 1), D("15.00")), ("a", date(2024, 3, 1), D("5.00")),
                ("b", date(2024, 1, 1), D("7.00")), ("b", date(2024, 3, 1), D("8.00"))], "customer string, month date, mrr decimal(20,2)")
    moves = m.movements(df)
    got = {(x["customer"], x["month"].month, x["kind"]): x["amount"] for x in moves.collect()}
    assert got == {("a", 1, "new"): D("10.00"), ("a", 2, "expansion"): D("5.00"), ("a", 3, "contraction"): D("-10.00"),
                   ("b", 1, "new"): D("7.00"), ("b", 2, "churned"): D("-7.00"), ("b", 3, "new"): D("8.00")}
    assert {x["difference"] for x in m.reconcile(df, m.movement_bridge(moves)).collect()} == {D("0.00")}
    kept = {(x["cohort"].month, x["month_no"]): x["retention"] for x in m.cohort_retention(df).collect()}
    assert kept == {(1, 0): 1.0, (1, 1): 0.5, (1, 2): 1.0}
    assert {x["event"] for x in m.subscription_events(moves).collect()} == {"signup", "upgrade", "downgrade", "cancellation"}


def test_history(frame):
    df = frame([("a", datetime(2024, 1, 1), "x", 1), ("a", datetime(2024, 1, 1), "y", 2), ("a", datetime(2024, 1, 5), "y", 3), ("a", datetime(2024, 2, 1), "z", 4)],
               "k string, ts timestamp_ntz, v string, id int")
    got = rows(m.attribute_history(df, "k", "ts", "v", "id").select("v", "valid_from", "valid_to", "is_current"), "valid_from")
    assert got == [("y", date(2024, 1, 1), date(2024, 2, 1), False), ("z", date(2024, 2, 1), None, True)]


def test_funnel(frame):
    t = lambda h: datetime(2024, 1, 1, h)
    df = frame([("u", t(1), "view"), ("u", t(2), "click"), ("v", t(3), "click"), ("v", t(4), "view"), ("w", t(1), "view")], "user string, ts timestamp_ntz, step string")
    got = rows(m.funnel_dropoff(df, "user", "ts", "step", ["view", "click", "purchase"], F.to_date("ts")).select("step", "users", "conversion"), "users")
    assert got == [("purchase", 0, 0.0), ("click", 1, pytest.approx(1 / 3)), ("view", 3, 1.0)]
    early = frame([("u", t(1), "click"), ("u", t(2), "view"), ("u", t(3), "click"), (None, t(1), "view")], "user string, ts timestamp_ntz, step string")
    got = rows(m.funnel_dropoff(early, "user", "ts", "step", ["view", "click"], F.to_date("ts")).select("step", "users"))
    assert sorted(got) == [("click", 1), ("view", 1)]  # the click before the view hides nothing


def test_forecasts(frame):
    months = [date(2022 + i // 12, i % 12 + 1, 1) for i in range(30)]
    df = frame([("i", mo, 10.0 + mo.month) for mo in months if mo != months[20]], "item string, ts date, q double")
    d = m.monthly_demand(df, "item", "ts", "q")
    assert d.count() == 30 and d.filter(F.col("month") == F.lit(months[20])).first()["demand"] == 0.0
    naive = {x["month"]: x["forecast"] for x in m.seasonal_naive(d).collect()}
    assert naive[months[0]] is None and naive[months[12]] == 11.0
    bt = {x["method"]: x for x in m.backtest(d, origins=4, horizon=2).collect()}
    assert bt["seasonal_naive"]["n"] == 8 and bt["rolling_mean"]["wape"] > 0
    f = m.demand_features(d).orderBy("month").toPandas()
    assert f["mean_3"].iloc[3] == pytest.approx((11 + 12 + 13) / 3) and f["lag_2"].iloc[2] == 11.0
    assert m.inventory_advice(d).first()["advice"] in ("reorder", "hold", "reduce")


def test_prices(frame):
    df = frame([("t", datetime(2024, 1, d, 9), float(p)) for d, p in enumerate([10, 12, 9, 6, 12], 1)], "k string, ts timestamp_ntz, p double")
    px = m.daily_prices(df, "k", "ts", "p", "p")
    assert m.drawdown(px).first()["max_drawdown"] == pytest.approx(-0.5)
    scored = px.select("ticker", "day", F.lit("A").alias("tier"))
    one = m.forward_returns(scored, px, [1]).first()
    assert one["n"] == 4 and one["hit_rate"] == 0.5


def test_ledger_and_triage(frame):
    df = frame([("the RED ring",), ("plain",)], "t string")
    assert [x[0] for x in df.select(m.categorize(F.col("t"), [("red", "c"), ("ring", "j"), ("ing", "z")])).collect()] == ["j", "other"]
    tickets = frame([(1, 10, "hi"), (2, 11, "hi"), (3, 12, "my refund please"), (4, 13, "?")], "ticket int, order_key int, text string")
    orders = frame([(10, "F", date(2024, 1, 20)), (11, "F", date(2023, 1, 1))], "order_key int, status string, ordered date")
    got = rows(m.triage(tickets, orders, [("refund", "refund page")], F.lit("2024-02-01").cast("date")), "ticket")
    assert got == [(1, "return", "return until day 30"), (2, "status", "order is F"), (3, "faq", "refund page"), (4, "escalate", None)]


def test_generic_checks(frame):
    a, b = frame([(1,), (1,), (None,)], "k int"), frame([(2,)], "k int")
    got = dict(rows(m.failing_rows({"unique": m.unique_violations(a, "k"), "null": m.null_violations(a, "k"), "rel": m.relationship_violations(a, "k", b, "k")})))
    assert got == {"unique": 1, "null": 1, "rel": 2}


def test_chunks_cover_the_text(frame):
    text = "".join(chr(97 + i % 26) for i in range(1234))
    got = [x["chunk"] for x in r.chunks(frame([(1, text), (2, "short"), (3, "")], "id int, t string"), "id", "t", 500, 100).filter("id = 1").orderBy("chunk_no").collect()]
    assert got[0] + "".join(c[100:] for c in got[1:]) == text and len(got) == 3
    assert r.chunks(frame([(2, "short"), (3, "")], "id int, t string"), "id", "t").count() == 1


@pytest.mark.parametrize("q_rows, p_rows", [(1000, 1000), (4, 11)])
def test_top_k(frame, q_rows, p_rows):
    rng = np.random.default_rng(3)
    p, q = rng.normal(size=(60, 8)).astype("float32"), rng.normal(size=(9, 8)).astype("float32")
    p[7] = p[3]
    passages = frame([(i, [float(x) for x in v]) for i, v in enumerate(p)], "passage_id long, vector array<float>")
    queries = frame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "query_id long, vector array<float>")
    got = r.top_k(queries, passages, 4, q_rows, p_rows)
    unit = lambda a: a.astype("float64") / np.linalg.norm(a.astype("float64"), axis=1, keepdims=True)
    sims = unit(q) @ unit(p).T
    want = {(i, j, n + 1) for i in range(9) for n, j in enumerate(sorted(range(60), key=lambda j: (-round(sims[i, j], 12), j))[:4])}
    assert {(x["query_id"], x["passage_id"], x["position"]) for x in got.collect()} == want


def test_history_keeps_changes_to_and_from_null(spark):
    rows = [("a", f"2024-01-0{d}", v, d) for d, v in ((1, "x"), (2, None), (3, None), (4, "x"))]
    df = spark.createDataFrame(rows, "e string, ts string, v string, t int")
    got = [(r.v, str(r.valid_from)) for r in m.attribute_history(df, "e", "ts", "v", "t").orderBy("valid_from").collect()]
    assert got == [("x", "2024-01-01"), (None, "2024-01-02"), ("x", "2024-01-04")]


def test_missing_month_has_no_change(spark):
    df = spark.createDataFrame([("c", "2024-01-01", 1.0), ("c", "2024-02-01", 3.0), ("c", "2024-04-01", 9.0)], "k string, month string, s double")
    df = df.withColumn("month", F.to_date("month"))
    assert [r.change for r in m.month_over_month(df, "k", "s").orderBy("month").collect()] == [None, 2.0, None]


def test_history_from_batches_in_any_order(frame):
    schema, d = "e string, ts timestamp_ntz, v string, k int", datetime
    rows_ = [("a", d(2020, 1, 1, 9), "x", 1), ("a", d(2020, 1, 3), "x", 2), ("a", d(2020, 1, 5), "y", 3), ("a", d(2020, 1, 2), "z", 4), ("a", d(2020, 1, 1, 10), "w", 5),
             ("a", d(2020, 1, 9), None, 6), ("b", d(2020, 1, 1), "x", 7), (None, d(2020, 1, 1), "x", 8), (None, d(2020, 1, 4), "y", 9), ("a", d(2020, 1, 3), "u", 0)]
    names, cols = ("e", "ts", "v", "k"), ["e", "v", "valid_from", "valid_to", "is_current"]
    want = sorted(map(tuple, m.attribute_history(frame(rows_, schema), *names).select(*cols).collect()), key=repr)
    for order in itertools.islice(itertools.permutations([rows_[:3], rows_[3:6], rows_[6:]]), 0, 6, 2):
        history = m.open_history(frame(order[0], schema), *names)
        for batch in (*order[1:], order[0]):
            history = m.merge_history(history, frame(batch, schema), *names)
        assert sorted(map(tuple, history.select(*cols).collect()), key=repr) == want
    same = m.merge_history(history, frame([], schema), *names)
    assert sorted(map(tuple, same.select(*cols).collect()), key=repr) == want


def test_late_change_splits_a_range(frame):
    schema, d = "e string, ts timestamp_ntz, v string, k int", datetime
    history = m.open_history(frame([("a", d(2020, 1, 1), "x", 1), ("a", d(2020, 1, 9), "x", 2)], schema), "e", "ts", "v", "k")
    assert [(r.valid_from, r.valid_to) for r in history.collect()] == [(date(2020, 1, 1), None)]
    split = m.merge_history(history, frame([("a", d(2020, 1, 4), "y", 3)], schema), "e", "ts", "v", "k")
    got = [(r.v, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current) for r in split.orderBy("valid_from").collect()]
    assert got == [("x", 1, 4, False), ("y", 4, 9, False), ("x", 9, None, True)]
