"""Passages: overlapping chunks and nearest-vector search."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_ROWS = 1024
PASSAGE_ROWS = 20_000


def chunks(df: DataFrame, key: str, text: str, size: int = 500, overlap: int = 100) -> DataFrame:
    """Whole texts in pieces of ``size`` characters, each starting ``size - overlap``
    after the one before; the last piece ends with the text."""
    stride = size - overlap
    n = F.length(text)
    last = F.greatest(F.lit(0), F.ceil((n - size) / stride).cast("int"))
    pieces = df.filter(n > 0).select(key, text, F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    start = (F.col("chunk_no") * stride + 1).cast("int")
    return pieces.select(key, "chunk_no", F.substring(F.col(text), start, F.lit(size)).alias("chunk"))


def _unit(rows: pd.Series) -> np.ndarray:
    m = np.stack(rows.to_numpy()).astype("float64")
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def top_k(queries: DataFrame, passages: DataFrame, k: int = 5, query_rows: int = QUERY_ROWS, passage_rows: int = PASSAGE_ROWS) -> DataFrame:
    """The k passages of highest cosine per query: (query_id, passage_id, cosine,
    position); ties by passage id.

    Both sides are cut in blocks of bounded size by a hash of the id; each passage block
    meets each query block in one task as a matrix product, and only k rows per query
    leave it. Passages are copied once per query block (one copy up to ``query_rows``
    queries), nothing is collected or broadcast.
    """
    q_blocks = queries.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / query_rows))).first()[0]
    p_blocks = passages.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / passage_rows))).first()[0]
    vec = "array<float>"

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))

    q = queries.select(F.col("query_id").alias("id"), F.col("vector").cast(vec).alias("vector"), F.lit(True).alias("is_query"),
                       F.pmod(F.xxhash64("query_id"), F.lit(int(q_blocks))).cast("int").alias("qb"), every(p_blocks).alias("pb"))
    p = passages.select(F.col("passage_id").alias("id"), F.col("vector").cast(vec).alias("vector"), F.lit(False).alias("is_query"),
                        F.pmod(F.xxhash64("passage_id"), F.lit(int(p_blocks))).cast("int").alias("pb"), every(q_blocks).alias("qb"))

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        qs, ps = pdf[pdf["is_query"]], pdf[~pdf["is_query"]]
        if not len(qs) or not len(ps):
            return pd.DataFrame({"query_id": [], "passage_id": [], "cosine": []})
        ids = ps["id"].to_numpy()
        sims = _unit(qs["vector"]) @ _unit(ps["vector"]).T
        order = np.lexsort((np.broadcast_to(ids, sims.shape), -sims), axis=1)[:, :k]
        return pd.DataFrame({"query_id": np.repeat(qs["id"].to_numpy(), order.shape[1]), "passage_id": ids[order].ravel(),
                             "cosine": np.take_along_axis(sims, order, 1).ravel()})

    hits = q.unionByName(p).groupBy("qb", "pb").applyInPandas(best, "query_id long, passage_id long, cosine double")
    w = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "passage_id")
    return hits.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)


def hit_rate(found: DataFrame, query_labels: DataFrame, passage_labels: DataFrame) -> DataFrame:
    """Share of queries with a relevant passage among their hits, and mean precision."""
    judged = found.join(query_labels, "query_id").join(passage_labels, "passage_id")
    per = judged.groupBy("query_id").agg(F.avg((F.col("query_label") == F.col("passage_label")).cast("double")).alias("precision"))
    return per.agg(F.count(F.lit(1)).alias("queries"), F.avg((F.col("precision") > 0).cast("double")).alias("hit_rate"), F.avg("precision").alias("precision"))


def mean_vectors(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label as (query_id, vector); one row per label and dimension is
    shuffled."""
    dims = df.select(F.col(label).cast("long").alias("query_id"), F.posexplode(vector).alias("d", "x"))
    mean = dims.groupBy("query_id", "d").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return mean.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda s: s["x"]).alias("vector"))
