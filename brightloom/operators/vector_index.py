"""Nearest vectors by an inverted-list index that also proves its answers.

Centroids are fitted on a bounded sample of the rows (``SAMPLE``, the smallest in a fixed hash
of their ids); then every row goes to the list of its nearest centroid. Lists are Parquet
partitions, cut in blocks of at most ``BLOCK`` rows in id order; each block knows the widest
angle between its rows and the centroid.

A search reads the lists nearest to a query first. Their k-th best cosine then tells which
other lists can still hold a better row: none whose widest angle cannot bridge the gap to the
query. The rest is read in a second round, so the result is exact; ``probed`` tells which hits
the first round would have found on its own, and their share is its recall.

Queries meet lists in batches of bounded size, and only k rows a query and block leave a task.
Centroids and radii, at most ``LISTS`` of them, are what travels with the tasks. A zero vector
has cosine 0 to everything. Rows with a null id, vector or component take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightloom.session import stage

#: Rows that centroids are fitted on, and lists, at most.
SAMPLE = 20_000
LISTS = 256
#: Rows of a block, and queries that meet a block at once.
BLOCK = 4096
QUERIES = 1024
#: Digits that tell two cosines apart.
DIGITS = 12


@dataclass(frozen=True)
class Index:
    """A written index: its folder, centroids (unit vectors) and the widest angle per list."""

    folder: str
    centroids: np.ndarray
    radii: np.ndarray

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("ids binary, vectors binary, radius double, list int").parquet(f"{self.folder}/lists")


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def _vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    whole = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull())
    return df.filter(F.col(key).isNotNull() & whole).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def fit_centroids(vectors: DataFrame, lists: int, sample: int = SAMPLE, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of the sample, in one task: (id, vector) to at most ``lists`` units."""
    chosen = vectors.select("vector").orderBy(F.xxhash64("id"), "id").limit(sample)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x = _unit(np.stack(rows["vector"].to_numpy()))
        c = np.unique(x[: min(lists, len(x))], axis=0)
        for _ in range(rounds):
            nearest = (x @ c.T).argmax(1)
            sums = np.zeros_like(c)
            np.add.at(sums, nearest, x)
            c = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), c)
        return pd.DataFrame({"place": np.arange(len(c)), "centroid": list(c)})

    found = chosen.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(run, "place int, centroid array<double>").orderBy("place").collect()
    return np.array([r["centroid"] for r in found])


def build(passages: DataFrame, key: str, vector: str, folder: str, lists: int = 64) -> Index:
    """Write the index of all passages below a new folder."""
    vectors = _vectors(passages, key, vector)
    centroids = fit_centroids(vectors, min(lists, LISTS))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                x = _unit(np.stack(rows["vector"].to_numpy()))
                yield pd.DataFrame({"list": (x @ centroids.T).argmax(1).astype("int32"), "id": rows["id"], "vector": list(x)})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def block(rows: pa.Table) -> pa.RecordBatch:
            number = rows.column("list")[0].as_py()
            x = np.array(rows.column("vector").to_pylist(), np.float64)
            # a zero vector is at any angle
            angle = np.where((x == 0).all(1), np.pi, _angles(x @ centroids[number]))
            return pa.RecordBatch.from_arrays(
                [pa.array([rows.column("id").to_numpy().tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()), pa.array([float(angle.max())]), pa.array([number], pa.int32())],
                names=["ids", "vectors", "radius", "list"])

        def flush(rest: pa.Table, final: bool) -> Iterator[pa.RecordBatch]:
            """Full blocks, and partial ones where a list ends."""
            numbers = rest.column("list").to_numpy()
            at = 0
            while at < len(numbers):
                end = int(np.searchsorted(numbers, numbers[at], side="right"))
                stop = min(end, at + BLOCK)
                if stop == len(numbers) and stop - at < BLOCK and not final:
                    break
                yield block(rest.slice(at, stop - at))
                at = stop
            held[:] = [rest.slice(at)] if at < len(numbers) else []

        for batch in batches:
            yield from flush(pa.concat_tables([*held, pa.Table.from_batches([batch])]), False)
        if held:
            yield from flush(pa.concat_tables(held), True)

    if len(centroids):
        rows = vectors.mapInPandas(assign, "list int, id long, vector array<double>")
        ordered = rows.repartitionByRange("list", "id").sortWithinPartitions("list", "id")
        blocks = ordered.mapInArrow(pack, "ids binary, vectors binary, radius double, list int")
    else:
        blocks = passages.sparkSession.createDataFrame([], "ids binary, vectors binary, radius double, list int")
    blocks.write.partitionBy("list").parquet(f"{folder}/lists")
    index = Index(folder, centroids, np.zeros(len(centroids)))
    for r in index.blocks(passages.sparkSession).groupBy("list").agg(F.max("radius").alias("radius")).collect():
        index.radii[r["list"]] = r["radius"]
    return index


def search(index: Index, queries: DataFrame, key: str, vector: str, k: int = 5, probes: int = 8, others: bool = False) -> DataFrame:
    """(query_id, passage_id, cosine, position, probed): the k passages of highest cosine,
    equal ones by id; ``others`` leaves out the passage with the query's own id."""
    spark, centroids, radii = queries.sparkSession, index.centroids, index.radii
    hits = "query_id long, passage_id long, cosine double, probed boolean"
    if not len(centroids):
        return spark.createDataFrame([], "query_id long, passage_id long, cosine double, position int, probed boolean")
    asked = _vectors(queries, key, vector)

    def send(first: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                for at in range(0, len(rows), QUERIES):
                    part = rows.iloc[at : at + QUERIES]
                    x = _unit(np.stack(part["vector"].to_numpy()))
                    near = x @ centroids.T
                    rank = np.argsort(np.argsort(-near, axis=1, kind="stable"), axis=1)
                    least = np.full(len(part), -2.0) if first else part["least"].to_numpy()
                    # the highest cosine that a list can hold, a rounding error added
                    reach = np.cos(np.maximum(_angles(near) - radii, 0.0)) + 1e-9
                    goes = rank < probes if first else (rank >= probes) & (reach >= least[:, None])
                    for number in np.flatnonzero(goes.any(0)):
                        mine = goes[:, number]
                        yield pd.DataFrame({"list": [np.int32(number)], "probe_ids": [part["id"].to_numpy()[mine].tobytes()],
                                            "probes": [x[mine].tobytes()], "least": [least[mine].tobytes()]})
        return run

    def meet(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    ids, own = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["probe_ids"], np.int64)
                    least = np.frombuffer(row["least"], np.float64)
                    cosines = np.round(np.frombuffer(row["probes"]).reshape(len(own), -1) @ np.frombuffer(row["vectors"]).reshape(len(ids), -1).T, DIGITS)
                    fits = cosines >= least[:, None]
                    if others:
                        fits &= ids != own[:, None]
                    order = np.argsort(-cosines, axis=1, kind="stable")  # ids ascend in a block
                    ranked = np.take_along_axis(fits, order, 1)
                    q, place = np.nonzero(ranked & (np.cumsum(ranked, axis=1) <= k))
                    p = order[q, place]
                    yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(ids[p]), pa.array(cosines[q, p]), pa.array(np.full(len(q), first))], names=["query_id", "passage_id", "cosine", "probed"])
        return run

    sent = "list int, probe_ids binary, probes binary, least binary"

    def round_of(rows: DataFrame, first: bool) -> DataFrame:
        return rows.mapInPandas(send(first), sent).join(index.blocks(spark), "list").mapInArrow(meet(first), hits)

    def best(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "passage_id")
        return found.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)

    near = stage(best(round_of(asked, True)))
    bar = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("cosine")).alias("least"))
    left = asked.join(bar, asked["id"] == bar["query_id"], "left").select("id", "vector", F.coalesce("least", F.lit(-2.0)).alias("least"))
    return best(near.drop("position").unionByName(round_of(left, False))).select("query_id", "passage_id", "cosine", "position", "probed")


def choose_probes(index: Index, queries: DataFrame, key: str, vector: str, k: int = 5, target: float = 0.9, sample: int = 256, others: bool = False) -> int:
    """The fewest lists to read first so that, on a bounded sample of the queries, their share
    of the true hits reaches the target."""
    asked = _vectors(queries, key, vector).orderBy(F.xxhash64("id"), "id").limit(sample)
    centroids = index.centroids

    def ranks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                near = _unit(np.stack(rows["vector"].to_numpy())) @ centroids.T
                rank = np.argsort(np.argsort(-near, axis=1, kind="stable"), axis=1)
                home = (_unit(np.stack(rows["hit"].to_numpy())) @ centroids.T).argmax(1)
                yield pd.DataFrame({"rank": rank[np.arange(len(rows)), home].astype("int32")})

    found = search(index, asked, "id", "vector", k, 1, others)
    spark = queries.sparkSession
    ids = index.blocks(spark).mapInPandas(_unpacked, "passage_id long, hit array<double>")
    both = found.join(asked, F.col("query_id") == F.col("id")).select("passage_id", "vector").join(ids, "passage_id")
    counts = {r["rank"]: r["n"] for r in both.mapInPandas(ranks, "rank int").groupBy("rank").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a list
    seen, total = 0, sum(counts.values())
    for probes in range(1, len(centroids) + 1):
        seen += counts.get(probes - 1, 0)
        if seen >= target * total:
            return probes
    return max(1, len(centroids))


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for ids, raw in zip(rows["ids"], rows["vectors"]):
            own = np.frombuffer(ids, np.int64)
            yield pd.DataFrame({"passage_id": own, "hit": list(np.frombuffer(raw).reshape(len(own), -1))})
