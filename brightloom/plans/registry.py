"""Where the plan modules register their queries and checking SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StructType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """Lazy handles on the given Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:  # footers are read once, not by every query
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)


def _plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles and days as text, at the very end, for comparison."""
    return df.withColumns({
        f.name: F.col(f"`{f.name}`").cast("double" if isinstance(f.dataType, DecimalType) else "string")
        for f in df.schema.fields if isinstance(f.dataType, (DecimalType, DateType))
    })


def _plain_sql(sql: str, money: Sequence[str], days: Sequence[str]) -> str:
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in money] + [f"CAST({c} AS VARCHAR) AS {c}" for c in days]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})" if casts else sql


def query(name: str, sql: str | None = None, money: Sequence[str] = (), days: Sequence[str] = ()):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with its DuckDB text if any.
    ``money`` and ``days`` name the decimal and date columns of that text."""

    def keep(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: _plain(fn(Tables(spark, folder)))
        if sql is not None:
            ORACLE[name] = _plain_sql(sql, money, days)
        return fn

    return keep
