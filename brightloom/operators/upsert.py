"""Idempotent loads on snapshot tables: each returns the next snapshot to write beside
the one it reads, never over it.

Small tables are returned whole. A fact table is kept in partitions (``PartitionedTable``): a
load reads and writes only the partitions that its batch touches, and its state row names the
folder that holds each partition from then on.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightloom.operators.sales import surrogate_keys
from brightloom.session import stage

STATE = "version long, schema string, parts map<string,string>"


def one_per_key(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch folded to one row per key: of several, the largest in its columns' order."""
    rest = [c for c in incoming.columns if c not in keys]
    if not rest:
        return incoming.distinct()
    last = incoming.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in incoming.columns])


def insert_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows already there stay untouched."""
    new = one_per_key(incoming, keys).join(target, list(keys), "left_anti")
    return target.unionByName(new)


def upsert_members(target: DataFrame, incoming: DataFrame, natural: str, key: str) -> DataFrame:
    """Overwrite attributes of known members and keep their keys; number the new ones. A key
    that the batch repeats counts once."""
    incoming = one_per_key(incoming, [natural])
    attrs = [c for c in target.columns if c not in (natural, key)]
    fresh = surrogate_keys(incoming.join(target, natural, "left_anti"), natural, key, target)
    t, i = target.alias("t"), incoming.alias("i")
    known = t.join(i, F.col(f"t.{natural}") == F.col(f"i.{natural}"), "left").select(
        F.col(f"t.{key}"), F.col(f"t.{natural}"),
        *[
            F.when(F.col(f"i.{natural}").isNotNull(), F.col(f"i.{a}"))
            .otherwise(F.col(f"t.{a}")).alias(a)
            for a in attrs
        ],
    )
    return known.unionByName(fresh.select(*known.columns))


def upsert_rows(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], stamp: Column | None = None
) -> DataFrame:
    """Insert or replace whole rows by key; the incoming row wins.

    The aggregation keeps one row per key in flight, so a repeated key costs no more
    than its map-side partials.
    """
    cols = [c for c in target.columns if c not in keys]
    if stamp is not None:
        incoming = incoming.withColumn("source_updated_at", stamp)
        cols = list(dict.fromkeys([*cols, "source_updated_at"]))
    old = target.select(*keys, F.lit(0).alias("_prio"), F.struct(*[
        (F.col(c) if c in target.columns else F.lit(None).cast(incoming.schema[c].dataType)).alias(c)
        for c in cols
    ]).alias("_row"))
    new = incoming.select(*keys, F.lit(1).alias("_prio"), F.struct(*cols).alias("_row"))
    last = F.max_by("_row", F.struct("_prio", "_row"))
    return old.unionByName(new).groupBy(*keys).agg(last.alias("_row")).select(*keys, "_row.*")


def newest(spark: SparkSession, path: str, schema: str):
    """The state row of highest version, or None where nothing was ever committed. Any other
    failure to read the state is raised: a load must not take it for a first one."""
    try:
        found = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    columns = found.columns
    return found.agg(F.max_by(F.struct(*columns), "version").alias("s")).first()["s"]


def last_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first in ``order``, then the largest in its columns' order. Each
    task brings at most one row of a key to the shuffle."""
    rest = [F.col(c).desc_nulls_last() for c in batch.columns if c not in keys]
    if not rest:
        return batch.distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return batch.withColumn("_place", place).filter("_place = 1").drop("_place")


def merge_partitions(parts: dict[str, str], batch: DataFrame, keys: Sequence[str], part: str, folder: str) -> dict[str, str]:
    """Write the partitions that the batch touches below a new folder, with its rows in place
    of rows of equal key, and return where every partition is then. ``part`` must hang on the
    keys alone; the number of its values bounds what comes to the driver. Untouched
    partitions are neither read nor written. Null keys equal each other."""
    spark = batch.sparkSession
    place = F.coalesce(F.hex(F.col(part).cast("string")), F.lit("null"))
    folded = stage(last_per_key(batch, keys).withColumn("_part", place))
    touched = [r["_part"] for r in folded.select("_part").distinct().collect()]
    if not touched:
        return parts
    merged = folded
    if known := [parts[x] for x in touched if x in parts]:
        old = spark.read.schema(batch.schema).parquet(*known)
        new = folded.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
        same = F.lit(True)
        for k in keys:
            same = same & old[k].eqNullSafe(new[f"_new_{k}"])
        merged = folded.unionByName(old.join(new, same, "left_anti").withColumn("_part", place))
    merged.repartitionByRange("_part", *keys).write.partitionBy("_part").parquet(folder)
    return parts | {x: f"{folder}/_part={x}" for x in touched}


def read_partitions(spark: SparkSession, parts: dict[str, str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*parts.values()) if parts else spark.createDataFrame([], schema)


class PartitionedTable:
    """A table of rows with unique keys below ``base``, one folder per partition and load."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], part: str):
        self.spark, self.base, self.keys, self.part = spark, base, list(keys), part

    def _state(self):
        return newest(self.spark, f"{self.base}/state/*", STATE)

    def version(self) -> int:
        state = self._state()
        return state["version"] if state else 0

    def upsert(self, batch: DataFrame) -> int:
        """Insert or replace rows by key; returns the version that is current afterwards. A
        batch without rows changes nothing. The state row is written last and only if no
        other load has written that version meanwhile, so a load that dies leaves the table
        as it was, and loading the batch again gives the same rows."""
        state = self._state()
        version, parts, kept = (state["version"], state["parts"], state["schema"]) if state else (0, {}, batch.schema.json())
        if StructType.fromJson(json.loads(kept)).names != batch.columns:
            raise ValueError("the batch has other columns than the table")
        found = merge_partitions(parts, batch, self.keys, self.part, f"{self.base}/data/{uuid.uuid4().hex}")
        if found is parts:
            return version
        row = self.spark.createDataFrame([(version + 1, kept, found)], STATE)
        row.coalesce(1).write.mode("errorifexists").parquet(f"{self.base}/state/v={version + 1}")
        return version + 1

    def read(self) -> DataFrame:
        state = self._state()
        if not state:
            raise ValueError(f"nothing was loaded to {self.base}")
        return read_partitions(self.spark, state["parts"], StructType.fromJson(json.loads(state["schema"])))
