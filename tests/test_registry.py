"""The driver's contract, plan shapes, and a sample of queries beside DuckDB."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from brightloom import plans

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given tables")
SAMPLE = [
    "retail_sales_by_category", "dq_conflicting_keys", "flood_hours_above", "npi_tier_jenks", "ml_roc_auc", "drift_unseen",
    "geo_queen", "cv_priority_merge", "text_period_parse", "saas_mrr_bridge", "rag_topk", "stream_funnel_tumbling", "flood_alert_text",
]


def _explain(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(plans.QUERIES) <= set(entry.queries())


def test_entry_is_one_row_per_entity(spark):
    df = entry.entry(spark)
    assert df.count() == 25 and "rank" in df.columns


@pytest.mark.parametrize("name", SAMPLE)
def test_beside_duckdb(spark, name):
    con = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    df = plans.QUERIES[name](spark, FOLDER)
    rel = con.execute(plans.ORACLE[name])
    cols = sorted(d[0] for d in rel.description)
    want = rel.fetchdf()[cols].astype(str).values.tolist()
    got = df.select(*cols).toPandas().astype(str).values.tolist()
    assert sorted(got) == sorted(want)


def test_filters_and_columns_reach_the_scan(spark):
    plan = _explain(plans.QUERIES["retail_incremental"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan
    plan = _explain(plans.QUERIES["retail_sales_by_category"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_top_products_never_sorts_everything(spark):
    assert "TakeOrderedAndProject" in _explain(plans.QUERIES["retail_top_products"](spark, FOLDER))


@pytest.mark.parametrize("name", ["mart_fct_orders", "mart_scd2", "cv_training_dedupe", "dq_conflicting_keys", "rag_chunks", "text_normalize_name"])
def test_no_row_at_a_time_python(spark, name):
    plan = _explain(plans.QUERIES[name](spark, FOLDER))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
