"""Micro-batches with a ledger: late and repeated rows are told and counted, and a batch that
comes again changes nothing.

A batch is kept in three steps: its rows are sorted out, the good ones are written to a folder
of the batch's own, and the ledger gets one row for it. What the ledger does not name does not
count, so a run that dies before the last step leaves no trace in the target, and its batch is
written again from the start.

The watermark is the latest event time of all earlier batches less the allowed delay. Rows
behind it are late and left out. Rows with the id of a row kept before, or of an earlier row
of the same batch, are repeated; only days from the watermark on are read to find them, as an
older row with the same time would be late. Rows without an id or a time have no place.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from brightloom.operators.upsert import last_per_key
from brightloom.session import stage

LEDGER = "batch long, n_rows long, unplaced long, late long, repeated long, kept long, latest timestamp"


class Sink:
    """Keeps the batches of one stream below ``base``. ``key`` is the event's id, ``ts`` its
    time (a TIMESTAMP), ``delay`` an interval text such as '10 minutes'."""

    def __init__(self, base: str, schema: StructType, key: str, ts: str, delay: str):
        self.base, self.schema, self.key, self.ts, self.delay = base, schema, key, ts, delay

    def ledger(self, spark: SparkSession) -> DataFrame:
        """One row per batch that was kept."""
        try:
            return spark.read.schema(LEDGER).parquet(f"{self.base}/ledger/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], LEDGER)

    def target(self, spark: SparkSession) -> DataFrame:
        """The rows of all batches in the ledger."""
        schema = StructType([*self.schema.fields, StructField("day", DateType()), StructField("batch", LongType())])
        try:
            found = spark.read.schema(schema).parquet(f"{self.base}/data")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)
        return found.join(self.ledger(spark).select("batch"), "batch", "left_semi")

    def keep(self, rows: DataFrame, batch: int) -> bool:
        """Bring a batch in; False if the ledger has it already."""
        spark = rows.sparkSession
        ledger = self.ledger(spark)
        if not ledger.filter(F.col("batch") == batch).isEmpty():
            return False
        mark = ledger.filter(F.col("batch") < batch).agg(F.max("latest") - F.expr(f"INTERVAL {self.delay}")).first()[0]
        placed = F.col(self.key).isNotNull() & F.col(self.ts).isNotNull()
        late = F.lit(False) if mark is None else F.col(self.ts) < F.lit(mark)
        told = stage(rows.select(*self.schema.names).withColumn("_state", F.when(~placed, "unplaced").when(late, "late").otherwise("good")))
        good = last_per_key(told.filter("_state = 'good'").drop("_state"), [self.key], [F.col(self.ts)])
        seen = self.target(spark)
        if mark is not None:
            seen = seen.filter(F.col("day") >= F.to_date(F.lit(mark)))
        fresh = good.join(seen.select(self.key), self.key, "left_anti").select(*self.schema.names)
        path = f"{self.base}/data/batch={batch}"
        fresh.withColumn("day", F.to_date(self.ts)).hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)
        kept = spark.read.schema(self.schema).parquet(path).agg(F.count(F.lit(1)))
        count = lambda state: F.count(F.when(F.col("_state") == state, 1))
        row = told.agg(F.count(F.lit(1)).alias("n_rows"), count("unplaced").alias("unplaced"), count("late").alias("late"), count("good").alias("good"), F.max(self.ts).alias("latest"))
        row = row.withColumn("kept", kept.scalar()).select(
            F.lit(batch).cast("long").alias("batch"), "n_rows", "unplaced", "late", (F.col("good") - F.col("kept")).alias("repeated"), "kept", "latest")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/ledger/batch-{batch}")
        return True

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Bring in what has arrived since the checkpoint, then stop."""
        q = stream.writeStream.foreachBatch(lambda rows, batch: self.keep(rows, batch) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        return q
