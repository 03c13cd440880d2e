"""The ledger of micro-batches: late, repeated and replayed rows."""

from datetime import datetime as d

from conftest import rows
from pyspark.sql import functions as F

from brightloom.streaming import batches

SCHEMA = "id long, ts timestamp, v string"


def _sink(frame, tmp_path):
    return batches.Sink(f"{tmp_path}/out", frame([], SCHEMA).schema, "id", "ts", "1 hour")


def test_late_repeated_and_unplaced_rows(frame, spark, tmp_path):
    sink = _sink(frame, tmp_path)
    at = lambda h, m=0: d(2024, 1, 1, h, m)
    one = [(1, at(1), "a"), (2, at(3), "b"), (2, at(3), "b"), (None, at(2), "c"), (3, None, "d"), (4, at(5), "e")]
    two = [(5, at(3, 59), "late"), (6, at(4), "edge"), (2, at(3), "late too"), (4, at(5), "again"), (7, at(9), "f")]
    assert sink.keep(frame(one, SCHEMA), 0) and sink.keep(frame(two, SCHEMA), 1)
    counts = rows(sink.ledger(spark).select("batch", "n_rows", "unplaced", "late", "repeated", "kept"), "batch")
    assert counts == [(0, 6, 2, 0, 1, 3), (1, 5, 0, 2, 1, 2)]
    target = rows(sink.target(spark).select("id", "v"), "id")
    assert target == [(1, "a"), (2, "b"), (4, "e"), (6, "edge"), (7, "f")]
    # a replayed batch changes nothing, whatever came after it
    assert not sink.keep(frame(one, SCHEMA), 0) and not sink.keep(frame(two, SCHEMA), 1)
    assert rows(sink.target(spark).select("id", "v"), "id") == target and sink.ledger(spark).count() == 2


def test_a_batch_that_died_is_not_seen_and_is_written_again(frame, spark, tmp_path):
    sink = _sink(frame, tmp_path)
    sink.keep(frame([(1, d(2024, 1, 1, 1), "a")], SCHEMA), 0)
    # died after the data, before the ledger
    frame([(8, d(2024, 1, 1, 2), "x")], SCHEMA).withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{tmp_path}/out/data/batch=1")
    assert rows(sink.target(spark).select("id")) == [(1,)]
    assert sink.keep(frame([(9, d(2024, 1, 1, 3), "y")], SCHEMA), 1)
    assert rows(sink.target(spark).select("id"), "id") == [(1,), (9,)]


def test_stream_of_several_runs(frame, spark, tmp_path):
    sink = _sink(frame, tmp_path)
    for i in range(3):
        frame([(10 * i + j, d(2024, 1, 1 + i, j), "v") for j in range(5)] + [(10 * i, d(2024, 1, 1 + i), "v")], SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
        sink.run(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), f"{tmp_path}/checkpoint")
    assert rows(sink.ledger(spark).select("batch", "n_rows", "repeated", "kept"), "batch") == [(0, 6, 1, 5), (1, 6, 1, 5), (2, 6, 1, 5)]
    assert sink.target(spark).count() == 15


def test_empty_batch(frame, spark, tmp_path):
    sink = _sink(frame, tmp_path)
    assert sink.target(spark).count() == 0 and sink.keep(frame([], SCHEMA), 0)
    assert rows(sink.ledger(spark)) == [(0, 0, 0, 0, 0, 0, None)]
    assert sink.keep(frame([(1, d(2024, 1, 1), "a")], SCHEMA), 1) and sink.target(spark).count() == 1
