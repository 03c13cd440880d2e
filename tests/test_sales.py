from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from brightloom.functions.sales import keyword_category
from brightloom.operators import quality, sales, upsert

SCHEMA = ("invoice_no string, stock_code string, description string, quantity int, invoice_ts timestamp_ntz, "
          "unit_price double, customer_id long, country string")


@pytest.fixture
def raw(frame):
    return frame([
        ("1001", "A1", " RED MUG ", 2, datetime(2011, 1, 4, 10), 5.0, 17850, "United Kingdom "),
        ("1001", "B2", "PAPER CARD", 1, datetime(2011, 1, 4, 10), 2.5, 17850, "United Kingdom"),
        ("C1002", "A1", "RED MUG", -1, datetime(2011, 1, 4, 11), 5.0, 17850, "United Kingdom"),
        ("1003", "C3", "UNMATCHED ITEM", 3, datetime(2011, 1, 5, 9), 4.0, None, "France"),
    ], SCHEMA)


def test_clean_and_number(raw):
    got = rows(sales.number_lines(sales.clean_sales(raw)).select(
        "invoice_no", "line_no", "description", "customer_id", F.col("sales_amount").cast("double")), "invoice_no", "line_no")
    assert got == [
        ("1001", 1, "RED MUG", "17850", 10.0), ("1001", 2, "PAPER CARD", "17850", 2.5), ("1003", 1, "UNMATCHED ITEM", None, 12.0)]


def test_hot_invoice_is_numbered_in_slices(spark, raw):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    copies = F.explode(F.sequence(F.lit(1), F.lit(200)))
    many = raw.filter("invoice_no = '1001'").withColumn("quantity", copies)
    got = sorted(r["line_no"] for r in sales.number_lines(sales.clean_sales(many)).collect())
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == list(range(1, 401))


def test_text_timestamps_that_do_not_parse_are_dropped(raw):
    bad = raw.withColumn("invoice_ts", F.when(F.col("invoice_no") == "1003", "never").otherwise("2011-01-04 10:00:00"))
    assert sales.clean_sales(bad).count() == 2


def test_star(raw):
    star = sales.star_schema(sales.number_lines(sales.clean_sales(raw)))
    assert {n: df.count() for n, df in star.items()} == {"dim_date": 2, "dim_store": 2, "dim_product": 3, "fact_sales_stage": 3}
    assert rows(star["dim_date"].select("date_key", "day_of_week", "day_name", "week_of_year"), "date_key") == [
        (20110104, 2, "Tuesday", 1), (20110105, 3, "Wednesday", 1)]
    assert rows(star["dim_store"], "country")[0] == ("France", "Online - France", "Online")


@pytest.mark.parametrize("code, text, want", [
    ("A1", "RED MUG", "KITCHEN"), ("B2", "PAPER CARD", "STATIONERY"), ("Z9", "UNMATCHED ITEM", "OTHER"),
    ("POST", "postage box", "POSTAGE"),
])
def test_category(frame, code, text, want):
    df = frame([(code, text)], "c string, d string")
    assert df.select(keyword_category(F.concat_ws(" ", "c", "d"))).first()[0] == want


def test_watermark(raw, frame):
    clean = sales.clean_sales(raw)
    first_two = clean.filter("invoice_no = '1001'")
    none = frame([(None,)], "last_invoice_ts timestamp_ntz")
    state = sales.next_watermark(first_two, none, "invoice_ts")
    mark = state.first()[0]
    assert [r["invoice_no"] for r in sales.after_watermark(clean, "invoice_ts", mark).collect()] == ["1003"]
    assert sales.after_watermark(clean, "invoice_ts", None).count() == 3
    assert sales.next_watermark(clean.filter("false"), state, "invoice_ts").first()[0] == mark


def test_upserts(frame):
    old = frame([(1, "UK", "old"), (2, "FR", "stay")], "key long, country string, name string")
    new = frame([("UK", "new"), ("DE", "fresh"), ("AT", "fresh")], "country string, name string")
    got = rows(upsert.upsert_members(old, new, "country", "key"), "key")
    assert got == [(1, "UK", "new"), (2, "FR", "stay"), (3, "AT", "fresh"), (4, "DE", "fresh")]
    days = frame([(1, "a")], "k int, v string")
    more = frame([(1, "b"), (2, "c"), (2, "c")], "k int, v string")
    assert rows(upsert.insert_absent(days, more, ["k"]), "k") == [(1, "a"), (2, "c")]
    fact = frame([("1", 1, 5), ("1", 2, 6)], "invoice string, line int, q int")
    batch = frame([("1", 2, 7), ("2", 1, 8)], "invoice string, line int, q int")
    once = upsert.upsert_rows(fact, batch, ["invoice", "line"])
    assert rows(once, "invoice", "line") == [("1", 1, 5), ("1", 2, 7), ("2", 1, 8)]
    assert rows(upsert.upsert_rows(once, batch, ["invoice", "line"]), "invoice", "line") == rows(once, "invoice", "line")
    assert upsert.upsert_rows(fact, batch.filter("false"), ["invoice", "line"]).count() == 2
    stamped = upsert.upsert_rows(fact, batch, ["invoice", "line"], stamp=F.current_timestamp())
    assert rows(stamped.filter("source_updated_at IS NULL").select("line")) == [(1,)]


def test_star_checks(raw, frame):
    star = sales.star_schema(sales.number_lines(sales.clean_sales(raw)))
    twice = star["fact_sales_stage"].unionByName(star["fact_sales_stage"].filter("invoice_no = '1003'"))
    dup = quality.duplicate_keys({"fact": (twice, ["invoice_no", "line_no"]), "dim_store": (star["dim_store"], ["country"])})
    assert dict(rows(dup)) == {"fact": 1, "dim_store": 0}
    miss = quality.missing_references(twice, {"stores": ("country", star["dim_store"].filter("country = 'France'"), "country")})
    assert rows(miss) == [("stores", 1)]
    with pytest.raises(quality.QualityError):
        quality.raise_on(miss.filter("missing_keys > 0"), "referential integrity")


def test_loads_are_repeatable(raw, frame, spark, tmp_path):
    from brightloom.operators import sales_load as sl

    base, good = str(tmp_path), raw.filter("invoice_no <> 'C1002'")
    assert sl.load_batch(good.filter("invoice_no = '1001'"), base) == 1
    assert sl.load_batch(good.filter("invoice_no = '1001'"), base) == 1  # nothing newer
    assert sl.load_batch(good, base) == 2
    fact = sl.table(spark, base, "fact_sales", 2)
    assert rows(fact.select("invoice_no", "line_no", "store_key"), "invoice_no", "line_no") == [("1001", 1, 1), ("1001", 2, 1), ("1003", 1, 2)]
    assert sl.table(spark, base, "dim_product", 2).count() == 3 and sl.current_state(spark, base)[0] == 2
    with pytest.raises(quality.QualityError, match="null checks"):
        sl.load_batch(good.withColumn("unit_price", F.lit(None).cast("double")), base)
    with pytest.raises(quality.QualityError, match="missing columns"):
        sl.load_batch(good.drop("country"), base)
    assert sl.current_state(spark, base)[0] == 2


def test_partitioned_upsert_touches_what_changed(frame, spark, tmp_path):
    schema = "invoice string, line int, month string, q int"
    table = upsert.PartitionedTable(spark, f"{tmp_path}/t", ["invoice", "line"], "month")
    first = frame([("1", 1, "200001", 5), ("1", 2, "200001", 6), ("2", 1, "200002", 7), ("3", 1, "200003", 8), ("4", 1, None, 9)], schema)
    assert table.upsert(first) == 1
    before = table._state()["parts"]
    batch = frame([("1", 2, "200001", 60), ("1", 3, "200001", 61), ("1", 3, "200001", 62), ("5", 1, "200004", 1), ("4", 1, None, 90)], schema)
    assert table.upsert(batch) == 2
    want = [("1", 1, "200001", 5), ("1", 2, "200001", 60), ("1", 3, "200001", 62), ("2", 1, "200002", 7), ("3", 1, "200003", 8), ("4", 1, None, 90), ("5", 1, "200004", 1)]
    assert rows(table.read(), "invoice", "line") == want
    after = table._state()["parts"]
    untouched = {k for k in before if before[k] == after[k]}
    assert len(untouched) == 2 and len(after) == 5  # the second and third month stay where they are
    # the same batch again gives the same table, an empty one changes nothing
    assert table.upsert(batch) == 3 and rows(table.read(), "invoice", "line") == want
    assert table.upsert(batch.filter("false")) == 3
    with pytest.raises(ValueError):
        table.upsert(batch.drop("q"))


def test_partitioned_upsert_reads_touched_folders_only(frame, spark, tmp_path, monkeypatch):
    schema = "k int, month int, v int"
    table = upsert.PartitionedTable(spark, f"{tmp_path}/t", ["k"], "month")
    table.upsert(frame([(i, i % 6, 0) for i in range(60)], schema))
    seen = []
    keep = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **kw: seen.extend(p) or keep(self, *p, **kw))
    table.upsert(frame([(2, 2, 1), (8, 2, 1), (61, 1, 1)], schema))
    assert len([p for p in seen if "_part=" in p]) == 2
    assert rows(table.read().groupBy("v").count(), "v") == [(0, 58), (1, 3)]


def test_unreadable_state_is_no_first_load(spark, tmp_path):
    assert upsert.newest(spark, f"{tmp_path}/none/*", upsert.STATE) is None
    (tmp_path / "state" / "v=1").mkdir(parents=True)
    (tmp_path / "state" / "v=1" / "part-0.parquet").write_bytes(b"broken")
    with pytest.raises(Exception, match="Parquet"):
        upsert.newest(spark, f"{tmp_path}/state/*", upsert.STATE)
