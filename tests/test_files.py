from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from brightloom import session
from brightloom.sources import files, manifest
from brightloom.streaming import events as ev


def test_csv(frame, spark, tmp_path):
    df = frame([(1, "a,b"), (2, None)], "id int, t string")
    files.export_csv(df, f"{tmp_path}/x")
    assert rows(files.read_csv(spark, f"{tmp_path}/x", "id int, t string"), "id") == [(1, "a,b"), (2, None)]
    with pytest.raises(Exception):
        files.read_csv(spark, f"{tmp_path}/absent", "id int").count()
    with pytest.raises(Exception):
        files.read_csv(spark, f"{tmp_path}/x", "wrong int, names string").collect()


def test_versions_stay(frame, tmp_path):
    df, at = frame([(1,)], "id int"), datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    assert files.write_version(df, str(tmp_path), "d", at).endswith("d/run_ts=20240102T030405Z")
    with pytest.raises(Exception):
        files.write_version(df, str(tmp_path), "d", at)


def test_manifest(frame, spark, tmp_path):
    df = frame([(1, "x")], "id int, t string").coalesce(1)
    for name in ("a", "b"):
        df.write.csv(f"{tmp_path}/{name}")
        manifest.append(manifest.file_entries(spark, f"{tmp_path}/{name}", name, "v1", "s", "u", 1, 2), f"{tmp_path}/m")
    entries = spark.read.json(f"{tmp_path}/m")
    assert entries.select("sha256").distinct().count() == 1 and entries.count() == 2
    log = frame([("d", 1, "old"), ("d", 2, "new")], "dataset string, seq int, path string")
    newest = manifest.latest(log, "dataset", ["seq"])
    assert rows(newest.select("path")) == [("new",)]
    inv = manifest.inventory(frame([("d",), ("e",)], "dataset string"), newest, "dataset", {"path": F.col("path")})
    assert rows(inv, "dataset") == [("d", "new"), ("e", "not yet fetched")]


def test_key_map(frame):
    payload = """{"vervar":[{"val":"1100","label":"<b>ACEH</b>"},{"val":"1101","label":"Town"}],"tahun":[{"val":"124","label":"2024"},{"val":"125","label":"2025"}],
      "datacontent":{"1100192434124062":1.0,"1100192434":9,"110019243412462":12.5,"110119243412562":3.5}}"""
    df = frame([(payload,)], "p string")
    assert rows(files.decode_key_map(df, "p", "v", "192", "434", "62"), "entity") == [("ACEH", 2024, 12.5), ("Town", 2025, 3.5)]
    assert rows(files.decode_key_map(df, "p", "v", "192", "434", "62", parents_only=True)) == [("ACEH", 2024, 12.5)]


def test_crosstab_and_percent(frame):
    df = frame([("Low", "12.34567", "-"), ("High", None, "3")], "cat string, A string, B string")
    melted = files.melt_crosstab(df, "cat", "province", "rate", 2024)
    assert rows(melted, "province") == [("Low", "A", 12.3457, 2024), ("High", "B", 3.0, 2024)]
    assert files.repeated_entities(melted, "province").count() == 0
    assert files.find_column(["Provinsi", "Prevalensi (%)"], "preval") == "Prevalensi (%)" and files.find_column(["a"], "z") is None
    assert [r[0] for r in frame([("5,0%",), (" 7.5 ",), ("n/a",)], "t string").select(files.parse_percent(F.col("t"))).collect()] == [5.0, 7.5, None]


def test_landing_prunes_partitions(frame, spark, tmp_path):
    df = frame([(i, datetime(2024, 1, 1 + i % 3)) for i in range(30)], "id int, ts timestamp_ntz")
    files.land(df, f"{tmp_path}/l", F.to_date("ts"))
    one = spark.read.parquet(f"{tmp_path}/l").filter(F.col("date") == "2024-01-02")
    assert one.count() == 10
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().explainString(one._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).replace("\n", " ")


def test_stream(frame, spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    first = frame([(i, t0 + timedelta(minutes=i), "view" if i % 2 else "click") for i in range(180)], "event_id long, ts timestamp_ntz, event_type string")
    first.unionByName(first.filter("event_id >= 175")).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = ev.event_stream(spark, f"{tmp_path}/in", first.schema, "ts")
    counts = ev.funnel_counts(ev.once_only(stream, "event_id", "ts", "10 minutes"), "ts", "event_type", ["view", "click"], "1 hour")
    ev.run_available(counts, f"{tmp_path}/out", f"{tmp_path}/cp")
    got = rows(spark.read.parquet(f"{tmp_path}/out").groupBy("event_type").agg(F.sum("events")), "event_type")
    assert got == [("click", 60), ("view", 60)]  # the third hour is still open
    late = frame([(500, t0, "view"), (501, t0 + timedelta(hours=4), "view")], "event_id long, ts timestamp_ntz, event_type string")
    late.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    q = ev.run_available(counts, f"{tmp_path}/out", f"{tmp_path}/cp")
    done = spark.read.parquet(f"{tmp_path}/out").agg(F.sum("events")).first()[0]
    assert done == 180 and ev.late_rows(q) == 1


def test_shared_folder(spark):
    assert session.shared_dir(spark) and session.cut(spark.range(3)).count() == 3
