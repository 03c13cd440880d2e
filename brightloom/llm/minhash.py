"""Near-duplicate documents: universal hash minima, bands, exact confirmation, components.

Two texts are linked when the Jaccard similarity of their sets of word windows reaches a
threshold; a component is what links connect. The steps:

1. ``describe``: per row the class of its set (texts with equal sets share it), the low
   bytes of all minima, and one key per band of minima. Nothing else leaves the task.
2. Texts that share a band key share a bucket. Only a bucket's *leader* is compared with its
   members: first minima, then the full sets. Links give components by alternating
   large-star and small-star steps; a bucket whose members are in one component is done.
   Buckets larger than a block get new leaders, from outside their largest component, as
   long as each round at least halves what is open in them.
3. The remaining buckets are compared in blocks of bounded size inside tasks, pairs of one
   component skipped. In a bucket larger than a block, members of its largest component are
   never placed beside each other: they meet the blocks of the others only. A first pass lets out a forest, the likeliest pairs that join a block's
   components, at most one per member; the full sets confirm them and components merge. The
   last pass names the members that have a possible partner in another component, brings
   their full sets to their blocks and compares all such pairs there; again a forest, now of
   true links, comes out. So no link between texts that share a band is lost, and no group
   is expanded into all its pairs. A pair that shares several bands is compared in its first,
   as told by the full keys that make the buckets.

With 6 rows and 32 bands, two texts at similarity 0.85 share no band with a chance of
3e-7; at 0.8, 38 bands of 5 rows, likewise.

Nulls and odd input: a null, empty or blank text has an empty set and links with nothing.
Copies of a row are one class. A null doc_id takes part like any other; a component's id is
its smallest doc_id that is not null. An empty table gives an empty result. Columns besides
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from brightloom.llm.columns import row_hash, spare
from brightloom.llm.words import ROWS, has_words, mix, multipliers, release, shingle_sets, text_column
from brightloom.session import cut, stage

#: Members of a bucket that are compared in one block; bounds a task's memory.
BLOCK = 512
#: Rows of a small table that one task takes on.
TASK_ROWS = 200_000
#: Passes over the buckets, in order.
PASSES = ("leader", "again", "forest", "rest")


@dataclass(frozen=True)
class Scheme:
    """Window width in words, least similarity in percent, and how minima form bands."""

    width: int = 5
    percent: int = 80
    rows: int = 5
    bands: int = 38

    @property
    def minima(self) -> int:
        return self.rows * self.bands

    @property
    def least_agreeing(self) -> int:
        """Minima that agree at least: five deviations below what the threshold gives."""
        p = self.percent / 100
        return int(self.minima * p - 5 * (self.minima * p * (1 - p)) ** 0.5)

    @property
    def likely_agreeing(self) -> int:
        """Minima that agree in a likely link: one deviation below."""
        p = self.percent / 100
        return int(self.minima * p - (self.minima * p * (1 - p)) ** 0.5)


def signature(windows: np.ndarray, scheme: Scheme) -> np.ndarray:
    """Minimum of each universal hash (a x + b) over the set."""
    a, b = multipliers(scheme.minima, 101)[:, None], multipliers(scheme.minima, 202)[:, None]
    best = np.full(scheme.minima, np.iinfo(np.uint64).max, np.uint64)
    x = windows >> np.uint64(32)
    for at in range(0, len(x), 2048):  # long texts in bounded steps
        np.minimum(best, (a * x[None, at : at + 2048] + b).min(axis=1), out=best)
    return best >> np.uint64(32)


def band_keys(minima: np.ndarray, scheme: Scheme) -> np.ndarray:
    power = multipliers(scheme.rows, 303)
    key = (minima.reshape(scheme.bands, scheme.rows) * power).sum(axis=1, dtype=np.uint64)
    return mix(key + np.arange(scheme.bands, dtype=np.uint64) * np.uint64(0x1000000000B)).view(np.int64)


def class_id(windows: np.ndarray) -> int:
    """Texts with equal sets have equal ids; the null id stands for an empty set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(windows.tobytes())).astype(np.int64))


def describe(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, text_hash, cid (class, null for an empty set), n, bands, minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sets = shingle_sets(text_column(part.column("text")), scheme.width)
                ids, bands, low = [], [], []
                for s in sets:
                    if not len(s):
                        ids.append(None)
                        bands.append(None)
                        low.append(None)
                        continue
                    m = signature(s, scheme)
                    ids.append(class_id(s))
                    bands.append(band_keys(m, scheme))
                    low.append(m.astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("text_hash"), pa.array(ids, pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "cid", "n", "bands", "minima"],
                )
        release()

    slim = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return slim.mapInArrow(run, "doc_id long, text_hash long, cid long, n long, bands array<long>, minima binary")


def _sets(docs: DataFrame, wanted: DataFrame, scheme: Scheme) -> DataFrame:
    """Full sets of the wanted classes (cid, doc_id, text_hash, rows), each read from one of
    its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sets = shingle_sets(text_column(part.column("text")), scheme.width)
                yield pa.RecordBatch.from_arrays(
                    [part.column("cid"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["cid", "windows"],
                )
        release()

    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    same = texts.doc_id.eqNullSafe(wanted.doc_id) & (texts.text_hash == wanted.text_hash)
    # by shuffle at every size: the list grows with the input
    found = texts.join(wanted.hint("merge"), same).select("cid", "text")
    if (wanted.agg(F.max("rows")).first()[0] or 0) > 1:  # rows that are repeated in every column
        found = found.dropDuplicates(["cid"])
    return found.mapInArrow(run, "cid long, windows array<long>")


def _cut(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """The table written once, in as many partitions as its rows ask for, and figures that
    are counted while it is written."""
    seen = Observation()
    kept = cut(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count(F.when(c, 1)).alias(n) for n, c in counts.items()]))
    found = seen.get
    return kept.coalesce(found["rows"] // TASK_ROWS + 1), found


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (u, v), by alternating large-star and
    small-star steps. The root is a component's smallest node. Minima are folded before the
    shuffle and joined back, so a node with very many links is no single group. The steps end
    when none moves an edge: every node then hangs on a root that hangs on nothing."""
    edges, _ = _cut(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u")
        large, moved = _cut(large.select(F.col("v").alias("u"), F.col("m").alias("v"), (F.col("m") < F.col("u")).alias("new")), new=F.col("new"))
        large = large.select("u", "v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"), (F.col("v") != F.col("m")).alias("new"))
        # a node whose parents differ keeps the least, which the row of that parent gives
        edges, also = _cut(small, new=F.col("new"))
        edges = edges.select("u", "v")
        if not moved["new"] and not also["new"]:
            tree = edges.distinct()
            return tree.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                tree.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )


def _estimated(pairs: DataFrame, signs: DataFrame, scheme: Scheme) -> DataFrame:
    """Signature verification: pairs (a, b) whose minima agree often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one = np.frombuffer(b"".join(batch.column("one").to_pylist()), np.uint8).reshape(-1, scheme.minima)
            two = np.frombuffer(b"".join(batch.column("two").to_pylist()), np.uint8).reshape(-1, scheme.minima)
            yield batch.select(["a", "b"]).filter(pa.array((one == two).sum(axis=1) >= scheme.least_agreeing))

    slim = signs.select("cid", "minima")
    one = pairs.join(slim.select(F.col("cid").alias("a"), F.col("minima").alias("one")), "a")
    return one.join(slim.select(F.col("cid").alias("b"), F.col("minima").alias("two")), "b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs whose full sets reach the threshold, as links (u, v)."""
    full = sets.select("cid", "windows")
    held = pairs.join(full.select(F.col("cid").alias("b"), F.col("windows").alias("two")), "b")
    held = held.join(full.select(F.col("cid").alias("a"), F.col("windows").alias("one")), "a")
    both = F.size(F.array_intersect("one", "two"))
    return held.withColumn("both", both).filter(
        F.lit(100) * F.col("both") >= F.lit(scheme.percent) * (F.size("one") + F.size("two") - F.col("both"))
    ).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _open_buckets(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with the bucket's size (held) and
    its largest component (major) with the members of it (top)."""
    sizes = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", "root"))
    mixed = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("held"), largest.alias("l")).filter("parts > 1")
    return members.join(mixed.select("bucket", "held", F.col("l.root").alias("major"), F.col("l.n").alias("top")), "bucket")


def _met(held: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of a leader per bucket and its members in other components. The leader is
    outside the largest component and another one in each turn."""
    rank = F.xxhash64("cid", F.lit(turn))
    lead = held.filter("root <> major").groupBy("bucket").agg(F.min(F.struct(rank.alias("rank"), "cid", "root")).alias("lead"))
    met = held.join(lead, "bucket").filter("root <> lead.root")
    return met.select(F.col("lead.cid").alias("a"), F.col("cid").alias("b")).distinct()


def _forest(root: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs (i, j, agreeing minima) those that join components, the likeliest first."""
    if not pairs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, j, agree = (np.concatenate(x) for x in zip(*pairs))
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    taken = []
    order = np.argsort(-agree, kind="stable")
    for at, x, y in zip(order.tolist(), root[i[order]].tolist(), root[j[order]].tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[x] = y
            taken.append(at)
    return i[taken], j[taken]


def _cells(members: DataFrame) -> DataFrame:
    """Members of open buckets in cells: a block with itself (side 2) or two blocks (0 and 1).
    Above one block, the largest component has blocks of its own, which come after those of
    the others and meet only them."""
    small = F.col("held") <= BLOCK
    rest = F.when(small, 1).otherwise(F.ceil((F.col("held") - F.col("top")) / F.lit(BLOCK))).cast("int")
    major = F.when(small, 0).otherwise(F.ceil(F.col("top") / F.lit(BLOCK))).cast("int")
    hashed, apart = F.xxhash64("cid", "bucket"), (F.col("root") == F.col("major")) & ~small
    placed = members.withColumns({"_rest": rest, "_major": major}).withColumns({
        "own": F.when(apart, F.col("_rest") + F.pmod(hashed, F.col("_major"))).otherwise(F.pmod(hashed, F.col("_rest"))).cast("int"),
        "last": F.when(apart, F.col("_rest")).otherwise(F.col("_rest") + F.col("_major")) - 1,
    })
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last")))).select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "bucket", "cid", "root",
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )


def _candidates(cell: pa.Table, scheme: Scheme, enough: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (i, j, agreeing minima) of a cell in two components that share no earlier band."""
    side, root = cell.column("side").to_numpy(), cell.column("root").to_numpy()
    low = np.frombuffer(b"".join(cell.column("minima").to_pylist()), np.uint8).reshape(-1, scheme.minima)
    keys = cell.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, scheme.bands)
    bucket = cell.column("bucket").to_numpy()
    found = []
    for i in np.flatnonzero(side != 1):
        rest = np.flatnonzero((side == 1) if side[i] == 0 else (np.arange(len(side)) > i))
        rest = rest[root[rest] != root[i]]
        agree = (low[rest] == low[i]).sum(axis=1)
        rest, agree = rest[agree >= enough], agree[agree >= enough]
        if len(rest):
            # minima are known by low bytes only, so the first shared band goes by its full key
            first = keys[i][(keys[rest] == keys[i]).argmax(axis=1)] == bucket[i]
            found.append((np.full(first.sum(), i), rest[first], agree[first]))
    return found


def _over_cells(carried: DataFrame, schema: str, body: Callable[[pa.Table], pa.RecordBatch]) -> DataFrame:
    """``body`` on every cell; rows come in the order of cells, and one cell is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            cell = table.column("cell").to_numpy()
            edge = np.flatnonzero(np.diff(cell)) + 1
            for x, y in zip([0, *edge[:-1]], edge):
                yield body(table.slice(x, y - x))
            held = table.slice(edge[-1]) if len(edge) else table
        if held is not None and held.num_rows:
            yield body(held)

    return carried.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, schema)


def _likely(cells: DataFrame, signs: DataFrame, scheme: Scheme) -> DataFrame:
    """A forest of likely pairs (a, b) between the components of each cell."""

    def body(cell: pa.Table) -> pa.RecordBatch:
        i, j = _forest(cell.column("root").to_numpy(), _candidates(cell, scheme, scheme.likely_agreeing))
        cid = cell.column("cid").to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(cid[i], cid[j])), pa.array(np.maximum(cid[i], cid[j]))], names=["a", "b"])

    return _over_cells(cells.join(signs, "cid"), "a long, b long", body).distinct()


def _links(cells: DataFrame, sets: DataFrame, signs: DataFrame, scheme: Scheme) -> DataFrame:
    """A forest of true links (u, v) between the components of each cell, from all its pairs."""

    def name(cell: pa.Table) -> pa.RecordBatch:
        pairs = _candidates(cell, scheme, scheme.least_agreeing)
        named = np.unique(np.concatenate([x for i, j, _ in pairs for x in (i, j)])) if pairs else np.empty(0, np.int64)
        columns = ["cell", "bucket", "cid", "root", "side"]
        return pa.RecordBatch.from_arrays([pa.array(cell.column(c).to_numpy()[named]) for c in columns], names=columns)

    def compare(cell: pa.Table) -> pa.RecordBatch:
        windows = [np.sort(w.values.to_numpy()) for w in cell.column("windows").combine_chunks()]
        true = []
        for i, j, agree in _candidates(cell, scheme, scheme.least_agreeing):
            for x, y, n in zip(i.tolist(), j.tolist(), agree.tolist()):
                both = len(np.intersect1d(windows[x], windows[y], assume_unique=True))
                if 100 * both >= scheme.percent * (len(windows[x]) + len(windows[y]) - both):
                    true.append((x, y, n))
        i, j = _forest(cell.column("root").to_numpy(), [tuple(np.array(true).T)] if true else [])
        cid = cell.column("cid").to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(cid[i]), pa.array(cid[j])], names=["u", "v"])

    named, _ = _cut(_over_cells(cells.join(signs, "cid"), "cell long, bucket long, cid long, root long, side int", name))
    return _over_cells(named.join(signs, "cid").join(sets.select("cid", "windows"), "cid"), "u long, v long", compare)


def near_links(docs: DataFrame, described: DataFrame, scheme: Scheme) -> DataFrame:
    """(node, root) for classes that have links; other classes stand alone."""
    rows = described.filter("n > 0").select("cid", F.explode("bands").alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("cid").alias("x"), F.max("cid").alias("y")).filter("x < y")
    members = stage(rows.join(buckets.select("bucket"), "bucket").distinct())
    named = members.select("cid").distinct()
    wanted = described.filter("n > 0").groupBy("cid").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("minima").alias("minima"), F.first("bands").alias("bands"))
    wanted = wanted.join(named, "cid").select("cid", "minima", "bands", "first.*")
    rows_of = described.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    wanted = wanted.join(rows_of, wanted.doc_id.eqNullSafe(rows_of.doc_id) & (wanted.text_hash == rows_of.text_hash)).select(
        wanted["*"], rows_of["rows"]
    )
    wanted = stage(wanted)
    signs = wanted.select("cid", "minima", "bands")
    # a table of its own, so that Spark measures these few columns when it picks the join
    sets = stage(_sets(docs, stage(wanted.select("cid", "doc_id", "text_hash", "rows")), scheme))

    roots = None
    steps, turn, before = list(PASSES), 0, None
    while steps:
        if roots is None:
            now = members.withColumn("root", F.col("cid"))
        else:
            now = members.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
        held, open_ = _cut(_open_buckets(now), large=F.col("held") > BLOCK)
        if not open_["rows"]:
            break
        step = steps[0]
        if step == "again" and (not open_["large"] or (before is not None and 2 * open_["large"] > before)):
            steps.pop(0)
            if not steps:
                break
            step = steps[0]
        if step == "again":
            before = open_["large"]
        else:
            steps.pop(0)
        if step in ("leader", "again"):
            met = _met(held if step == "leader" else held.filter(F.col("held") > BLOCK), turn)
            turn += 1
            links = _confirmed(_estimated(met, signs, scheme), sets, scheme)
        elif step == "forest":
            links = _confirmed(_likely(_cells(held), signs, scheme), sets, scheme)
        else:
            links = _links(_cells(held), sets, signs, scheme)
        found, new = _cut(links)
        if new["rows"]:
            grown = found if roots is None else found.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
            roots, _ = _cut(components(grown))
    if roots is None:
        return members.select(F.col("cid").alias("node"), F.col("cid").alias("root")).limit(0)
    return roots


def near_duplicates(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """One row per input row: doc_id, text_hash, n_shingles, component (of classes, null for
    an empty set), component_id (its smallest doc_id) and kept (doc_id = component_id)."""
    described = stage(describe(docs, scheme))
    roots = near_links(docs, described, scheme)
    slim = described.select("doc_id", "text_hash", "cid", F.col("n").alias("n_shingles"))
    slim = slim.join(roots, slim.cid == roots.node, "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("root", "cid").alias("component")
    )
    least = slim.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = slim.join(least, "component", "left").withColumn(
        "component_id", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    )
    return out.select(
        "doc_id", "text_hash", "n_shingles", "component", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """The documents that stay, one row per component, all columns as they came: the one of
    least doc_id, of equal ones that of least hash. Rows without any word have no component
    and all stay."""
    found = near_duplicates(docs, scheme).filter("component is not null")
    own_id, own_hash, text_hash, rows, key = spare(docs, "_id", "_hash", "_text_hash", "_row_hash", "_key")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    pick = found.groupBy("component").agg(least.alias("pick")).select(F.col("pick.doc_id").alias(own_id), F.col("pick.text_hash").alias(own_hash))
    hashed = docs.withColumns({text_hash: F.xxhash64("text"), rows: row_hash(docs)})
    same = hashed.doc_id.cast("long").eqNullSafe(F.col(own_id)) & (hashed[text_hash] == F.col(own_hash))
    # of rows with the same doc_id and text one stays, told by the hash of all columns; it is
    # named by hashes alone, so that whole rows are shuffled once
    slim = hashed.select("doc_id", text_hash, rows).join(pick, same, "left_semi")
    # never null, as on the other side: keys of one type need no cast, which would cost a shuffle
    first = slim.groupBy("doc_id", text_hash).agg(F.coalesce(F.min(rows), F.lit(0)).alias(rows)).select(F.struct("doc_id", text_hash, rows).alias(key))
    columns = [f"`{c}`" for c in docs.columns]
    keyed = docs.select(*columns, F.struct("doc_id", F.xxhash64("text").alias(text_hash), row_hash(docs).alias(rows)).alias(key))
    # by shuffle at every size, and equal rows meet in the same one
    stays = keyed.join(first.hint("merge"), key, "left_semi").dropDuplicates([key])
    return stays.select(*columns).unionByName(docs.filter(~has_words(F.col("text"))).select(*columns))
