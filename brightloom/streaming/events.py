"""Event streams from landed files: windowed funnel counts and a replay-safe sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_stream(spark: SparkSession, folder: str, schema: str, ts: str, pattern: str = "*.parquet") -> DataFrame:
    """Stream over the Parquet files of a folder; the event time becomes a TIMESTAMP,
    which watermarks ask for."""
    raw = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return raw.withColumn(ts, F.col(ts).cast("timestamp"))


def once_only(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Drop repeats of an event id that arrive within the delay; state stays bounded by it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def funnel_counts(stream: DataFrame, ts: str, step: str, steps: Sequence[str], width: str) -> DataFrame:
    """Events per step and tumbling window."""
    return (
        stream.filter(F.col(step).isin(list(steps))).groupBy(F.window(ts, width).alias("w"), step)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), step, "events")
    )


def run_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Process what is there into Parquet, exactly once per checkpoint, then stop."""
    q = (
        stream.writeStream.format("parquet").outputMode("append").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q


def late_rows(q: StreamingQuery) -> int:
    """Rows that came behind the watermark and were dropped, over the query's progress."""
    return sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)
