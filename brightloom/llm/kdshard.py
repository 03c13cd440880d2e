"""Shards of near-equal bytes by a k-d tree over document metadata, in DataFrame functions.

Documents are folded to units: equal texts are one unit, so copies share a shard. A group of
copies that alone holds more than a ``1 / SPLIT`` part of a shard's target is cut into chunks
by a hash of doc_id, so that no group, however large, unbalances the shards; there are never
more than shards x SPLIT such groups.

The tree starts with all units and as many leaves as there are shards. A node splits along
its widest dimension (its range over the whole table's) where the weight to the left is to
the weight to the right as the leaves are, until each node is one leaf, that is, holds the
target bytes. The weighted median is found by all nodes of a level at once: a histogram over
the range, one over the bin it falls in, and, as metadata often ties, one over a hash of the
units left in that bin. Only these histograms come to the driver: nodes x bins rows.

Dimensions: source and lang (their first bytes as a number, which keeps their order) and the
smallest doc_id of a unit. Nulls count as the least value; a null text has no bytes and
weighs the 8 of its row. Rows repeated in every column are one unit. Empty tables give no
rows; with fewer units than shards some shards stay empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.operators.ordering import row_numbers
from brightloom.session import cut, stage

DIMENSIONS = ("x_source", "x_lang", "x_doc")
#: Bins of the histograms over values and over hashes.
BINS, HASH_BINS = 512, 4096
#: A group of copies above this part of a shard's target is cut up.
SPLIT = 32


def text_number(value: Column) -> Column:
    """The first six bytes of a string as a number that keeps their order; null is 0."""
    padded = F.rpad(F.hex(F.substring(F.encode(value, "utf-8"), 1, 6)), 12, "0")
    return F.coalesce(F.conv(padded, 16, 10).cast("double"), F.lit(0.0))


@dataclass
class Node:
    """A node of the tree and its cut: left is what lies in bins below; in the critical bin,
    sub-bins below; in the critical sub-bin, hashes below."""

    shard: int
    leaves: int
    dimension: int = 0
    low: float = 0.0
    wide: float = 1.0
    bin: int = -1
    sub: int = -1
    hashed: int = -1
    goal: float = 0.0


class Level:
    """The nodes of a level by the number of their first shard, as columns over units."""

    def __init__(self, nodes: list[Node], shards: int):
        self.nodes = {n.shard: n for n in nodes}
        self.shards = shards

    def of(self, name: str) -> Column:
        """A node's figure for the unit at hand; null outside the level."""
        values = [getattr(self.nodes[i], name) if i in self.nodes else None for i in range(self.shards)]
        kind = "double" if name in ("low", "wide") else "int"
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("node") + 1)

    def place(self) -> Column:
        """Where on its node's axis a unit lies, in bins."""
        value = F.element_at(F.array(*[F.col(d) for d in DIMENSIONS]), self.of("dimension") + 1)
        return (value - self.of("low")) / self.of("wide") * BINS

    def with_bins(self, units: DataFrame) -> DataFrame:
        """Units of the level with their bins; sub-bin and hash where the bins above are critical."""
        top = F.lit(BINS - 1)
        placed = units.withColumn("_place", self.place()).filter("_place is not null")
        placed = placed.withColumn("coarse", F.least(F.greatest(F.floor("_place").cast("int"), F.lit(0)), top))
        fine = F.floor((F.col("_place") - self.of("bin")) * BINS).cast("int")
        placed = placed.withColumn("fine", F.when(F.col("coarse") == self.of("bin"), F.least(F.greatest(fine, F.lit(0)), top)))
        hashed = F.pmod(F.col("unit"), F.lit(HASH_BINS)).cast("int")
        return placed.withColumn("hashed", F.when(F.col("fine") == self.of("sub"), hashed)).drop("_place")

    def histogram(self, units: DataFrame, axis: str) -> dict[int, list[tuple[int, float]]]:
        rows = self.with_bins(units).filter(f"{axis} is not null").groupBy("node", axis).agg(F.sum("weight").cast("double").alias("w")).collect()
        out: dict[int, list[tuple[int, float]]] = {i: [] for i in self.nodes}
        for node, at, w in rows:
            out[node].append((at, w))
        return out

    def descend(self, units: DataFrame) -> DataFrame:
        """Every unit of the level in its half; the others where they are."""
        inside = units.filter(F.col("node").isin(list(self.nodes)))
        rest = units.filter(~F.col("node").isin(list(self.nodes)))
        right = (F.col("coarse") > self.of("bin")) | F.coalesce(F.col("fine") > self.of("sub"), F.lit(False)) | F.coalesce(F.col("hashed") >= self.of("hashed"), F.lit(False))
        half = F.element_at(F.array(*[F.lit(self.nodes[i].leaves // 2 if i in self.nodes else 0) for i in range(self.shards)]), F.col("node") + 1)
        moved = self.with_bins(inside).withColumn("node", F.when(right, F.col("node") + half).otherwise(F.col("node")))
        return moved.select(*units.columns).unionByName(rest)


def _crossing(histogram: list[tuple[int, float]], goal: float) -> tuple[int, float]:
    """The bin in which the running sum reaches the goal, and what is still missing there."""
    before = 0.0
    for at, weight in sorted(histogram):
        if before + weight >= goal:
            return at, goal - before
        before += weight
    return (max(at for at, _ in histogram), 0.0) if histogram else (0, 0.0)


def _nearest(histogram: list[tuple[int, float]], goal: float) -> int:
    """The bin below which the sum is nearest to the goal."""
    best, cut_at, before = abs(goal), 0, 0.0
    for at, weight in sorted(histogram):
        before += weight
        if abs(before - goal) < best:
            best, cut_at = abs(before - goal), at + 1
    return cut_at


def build(units: DataFrame, shards: int) -> DataFrame:
    """(unit, weight and the dimensions) with ``node``, the shard."""
    whole = units.agg(*[F.max(d) - F.min(d) for d in DIMENSIONS]).first()
    span = [max(w or 0.0, 1e-12) for w in whole]
    units = units.withColumn("node", F.lit(0))
    nodes = [Node(0, shards)]
    while any(n.leaves > 1 for n in nodes):
        level = Level([n for n in nodes if n.leaves > 1], shards)
        ends = [f(d).alias(f"{f.__name__}{i}") for i, d in enumerate(DIMENSIONS) for f in (F.min, F.max)]
        found = {r.node: r for r in units.groupBy("node").agg(F.sum("weight").cast("double").alias("w"), *ends).collect()}
        for n in level.nodes.values():
            if r := found.get(n.shard):
                n.dimension = max(range(len(DIMENSIONS)), key=lambda i: (r[f"max{i}"] - r[f"min{i}"]) / span[i])
                n.low = r[f"min{n.dimension}"]
                n.wide = max(r[f"max{n.dimension}"] - n.low, 1e-9)
                n.goal = r.w * (n.leaves // 2) / n.leaves
        for i, h in level.histogram(units, "coarse").items():
            level.nodes[i].bin, level.nodes[i].goal = _crossing(h, level.nodes[i].goal)
        for i, h in level.histogram(units, "fine").items():
            level.nodes[i].sub, level.nodes[i].goal = _crossing(h, level.nodes[i].goal)
        for i, h in level.histogram(units, "hashed").items():
            level.nodes[i].hashed = _nearest(h, level.nodes[i].goal)
        units = cut(level.descend(units))
        nodes = [
            half for n in nodes
            for half in ([Node(n.shard, n.leaves // 2), Node(n.shard + n.leaves // 2, n.leaves - n.leaves // 2)] if n.leaves > 1 else [n])
        ]
    return units


def shard(docs: DataFrame, shards: int = 24, target_bytes: int | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard and slot (gapless from 0 in its
    shard). With ``target_bytes`` the number of shards follows from it."""
    text = F.coalesce("text", F.lit(""))
    slim = stage(docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).cast("long").alias("text_crc32"),
        F.xxhash64(text, F.col("text").isNull()).alias("hash"), text_number(F.col("source")).alias("x_source"), text_number(F.col("lang")).alias("x_lang"),
        F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.0)).alias("x_doc"),
    ))
    total = slim.agg(F.sum("size")).first()[0] or 0
    if target_bytes:
        shards = max(1, -(-total // target_bytes))
    most = max(total / shards / SPLIT, 1.0)
    copies = slim.groupBy("hash", "size").agg(F.count(F.lit(1)).alias("n"))
    large = copies.filter((F.col("n") > 1) & (F.col("n") * F.col("size") > most)).select(
        F.col("hash").alias("_hash"), F.col("size").alias("_size"), F.ceil(F.col("n") * F.col("size") / F.lit(most)).alias("chunks")
    )
    # at most shards x SPLIT groups can be this large
    marked = slim.join(F.broadcast(large), (F.col("hash") == F.col("_hash")) & (F.col("size") == F.col("_size")), "left")
    chunk = F.when(F.col("chunks").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("chunks"))).otherwise(F.lit(0))
    marked = marked.withColumn("unit", F.xxhash64("hash", "size", chunk)).drop("_hash", "_size", "chunks")
    units = stage(marked.groupBy("unit").agg(F.sum("size").alias("weight"), *[F.min(d).alias(d) for d in DIMENSIONS]))
    home = build(units, shards).select("unit", F.col("node").cast("int").alias("shard"))
    placed = marked.select("doc_id", "size", "text_crc32", "unit").join(home, "unit")
    numbered = row_numbers(placed, ["shard"], [F.col("doc_id"), F.col("unit")], "_n")
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("_n") - 1).alias("slot"))
