"""Hard negatives by zone maps over Hilbert-ordered blocks of vectors.

Rows are ordered along a Hilbert curve through all dimensions (``BITS`` bits of each, between
its least and largest value) and written as Parquet in blocks of ``BLOCK`` rows; beside its
rows, a block has the least and largest value of every dimension (its zone) and how many rows
it has of each label. Anchors are packed the same way, in groups of ``GROUP``.

What is looked for are the best k rows of the anchor's own label, or of other labels, whose
score lies in a window. Interval arithmetic on an anchor and a zone bounds the scores of the
block from below and above, which is used twice, on zones alone:

- blocks that lie in a window as a whole tell how high its k-th score is at least: the window
  is narrowed to that from below;
- a block is read for the windows that its bounds meet, and for no others.

Only then anchors meet the rows of those blocks, as matrix products. First this finds the
positives (one window, all scores), whose scores make the windows of the negatives.

Anchors meet zones in pairs of a group and ``ZONES`` zones, blocks in pairs of a group and a
block: a stated query set against all rows, in blocks. Each pair is worked on alone, k rows a
window leave it, and nothing but one row for each dimension comes to the driver.

Rows with a null id, label or vector, or a null or non-finite component take no part. Vectors
that are shorter than the longest one count as zero beyond their end. Scores are exact as long
as they fit 64 bits. Rows that repeat an id are rows of their own; no row is the positive of
an anchor with the same id. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.words import release
from brightloom.session import stage

#: Bits of each dimension that the curve tells apart.
BITS = 4
#: Rows of a block, anchors of a group, zones that meet a group at once.
BLOCK = 512
GROUP = 512
ZONES = 2048
#: Scores beyond all others.
FAR = 1 << 62
_EXACT = 1 << 53

_KEYED = "vec_id long, label long, vector binary, key binary"
_BLOCK = "block long, n long, vec_ids binary, labels binary, vectors binary, low binary, high binary, kinds binary, counts binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (rows, dimensions), as big-endian bytes. Skilling's
    transform: undo the turns of the curve from the coarsest bit down, then take Gray codes."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        q, below = 1 << bit, (1 << bit) - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(up, below, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= turn
    planes = np.stack([(x >> bit) & 1 for bit in range(bits - 1, -1, -1)])  # (bits, dimensions, rows)
    return np.packbits(planes.reshape(bits * n, -1).T.astype(np.uint8), axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of a with those of b."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _matrix(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(raw, "<i8").reshape(rows, -1) if rows else np.empty((0, 0), np.int64)


def _ints(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


def _raw(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, "<i8").tobytes()


def _frame(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [c.split(" ") for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[kind]) for x, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])


def quantized(table: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, vector as bytes of 64-bit floor(scale * x)) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            size = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.isfinite(values)
            upto = np.concatenate([[0], np.cumsum(size)])
            bad = np.concatenate([[0], np.cumsum(~whole)])
            ok = bad[upto[1:]] == bad[upto[:-1]]
            ints = np.clip(np.floor(np.where(whole, values, 0) * scale), -FAR, FAR).astype("<i8")
            keep = np.flatnonzero(ok)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(keep)), batch.column("label").take(pa.array(keep)), pa.array([ints[upto[i] : upto[i + 1]].tobytes() for i in keep], pa.binary())],
                names=["vec_id", "label", "vector"],
            )

    slim = table.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>"))
    return slim.dropna().mapInArrow(run, "vec_id long, label long, vector binary")


def _spans(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            for raw in batch.column("vector").to_pylist():
                v = _ints(raw)
                if len(v) > len(low):
                    more = np.zeros(len(v) - len(low), np.int64)
                    low, high = np.append(low, more), np.append(high, more)
                low[: len(v)] = np.minimum(low[: len(v)], v)
                high[: len(v)] = np.maximum(high[: len(v)], v)
        yield _frame("dimension long, low long, high long", [np.arange(len(low)), low, high])

    found = rows.select("vector").mapInArrow(run, "dimension long, low long, high long")
    spans = found.groupBy("dimension").agg(F.min("low"), F.max("high")).orderBy("dimension").collect()
    return np.array([r[1] for r in spans], np.int64), np.array([r[2] for r in spans], np.int64)


def keyed(rows: DataFrame) -> DataFrame:
    """The rows with vectors of one length and their place on the curve."""
    low, high = _spans(rows)
    width = np.maximum(high - low, 1)
    dims = max(len(low), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.zeros((batch.num_rows, dims), np.int64)
            for i, raw in enumerate(batch.column("vector").to_pylist()):
                v = _ints(raw)
                vectors[i, : len(v)] = v
            cells = vectors[:, : len(low)] - low
            cells = np.minimum((cells / width * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            keys = hilbert_keys(cells, BITS) if len(low) else np.zeros((batch.num_rows, 1), np.uint8)
            yield _frame(_KEYED, [batch.column("vec_id"), batch.column("label"), [_raw(v) for v in vectors], [k.tobytes() for k in keys]])

    return stage(rows.mapInArrow(run, _KEYED))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Keyed rows in blocks of at most ``size`` along the curve, see ``_BLOCK``; equal keys by
    vec_id."""

    def block(number: int, batch: pa.Table) -> pa.RecordBatch:
        ids, labels = (batch.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
        order = np.argsort(ids, kind="stable")  # so that equal scores come by vec_id
        vectors = _matrix(b"".join(batch.column("vector").to_pylist()), len(ids))[order]
        kinds, counts = np.unique(labels, return_counts=True)
        return _frame(_BLOCK, [[number], [len(ids)], *([_raw(x)] for x in (ids[order], labels[order], vectors, vectors.min(0), vectors.max(0), kinds, counts))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == size:
                    yield block(number, pa.Table.from_batches(held))
                    number, held, n = number + 1, [], 0
        if held:
            yield block(number, pa.Table.from_batches(held))

    ordered = rows.repartitionByRange("key", "vec_id").sortWithinPartitions("key", "vec_id")
    return stage(ordered.select("vec_id", "label", "vector").mapInArrow(run, _BLOCK))


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that an anchor can have in a zone: (anchors, zones) each."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _of_label(labels: np.ndarray, zones: list[dict]) -> np.ndarray:
    """(anchors, zones): rows with the anchor's label."""
    kinds, which = np.unique(labels, return_inverse=True)
    out = np.zeros((len(kinds), len(zones)), np.int64)
    for z, zone in enumerate(zones):
        there, count = _ints(zone["kinds"]), _ints(zone["counts"])
        at = np.searchsorted(kinds, there)
        hit = (at < len(kinds)) & (kinds[np.minimum(at, len(kinds) - 1)] == there)
        out[at[hit], z] = count[hit]
    return out[which]


def narrowed(least: np.ndarray, most: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray, need: int) -> np.ndarray:
    """Windows' lower ends (anchors, windows), raised to what the best ``need`` rows have at
    least: zones that lie in the window as a whole, from the highest least score down."""
    order = np.argsort(-least, axis=1)
    best, last, count = (np.take_along_axis(x, order, 1) for x in (least, most, rows))
    out = low.copy()
    for w in range(low.shape[1]):
        inside = (best >= low[:, w : w + 1]) & (last <= high[:, w : w + 1])
        enough = np.cumsum(np.where(inside, count, 0), axis=1) >= need
        some = enough.any(1)
        out[some, w] = best[some, enough[some].argmax(1)]
    return out


def _pairs(groups: DataFrame, zones: DataFrame) -> DataFrame:
    """Every group beside every run of zones."""
    runs = zones.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / ZONES))).first()[0]
    fields = ["block", "n", "low", "high", "kinds", "counts"]
    run = zones.select(F.pmod(F.xxhash64("block"), F.lit(int(runs)).cast("long")).alias("run"), F.struct(*fields).alias("zone"))
    packed_runs = run.groupBy("run").agg(F.collect_list("zone").alias("zones"))
    spread = groups.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(int(runs) - 1).cast("long"))))
    return spread.join(packed_runs, "run")


def _met(row: dict, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    labels, zones = _ints(row["labels"]), row["zones"]
    anchors = _matrix(row["vectors"], len(labels))
    least, most = bounds(anchors, np.stack([_ints(z["low"]) for z in zones]), np.stack([_ints(z["high"]) for z in zones]))
    own = _of_label(labels, zones)
    return least, most, own if same else np.array([z["n"] for z in zones]) - own


def in_windows(groups: DataFrame, blocks: DataFrame, k: int, same: bool) -> DataFrame:
    """(block, anchor, window, vec_id, score): for every anchor and window the k best rows of
    its label (``same``) or of other ones, equal scores by vec_id. groups: packed anchors with
    arrays ``lows`` and ``highs``, the windows of one anchor after those of the other."""

    def tighten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                least, most, rows = _met(row, same)
                low, high = (np.array(row[c]).reshape(len(least), -1) for c in ("lows", "highs"))
                # an anchor may be one of the rows of its label
                yield _frame("group long, lows array<long>", [[row["block"]], [narrowed(least, most, rows, low, high, k + same).ravel().tolist()]])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                least, most, rows = _met(row, same)
                low, high = (np.array(row[c]).reshape(len(least), -1) for c in ("lows", "highs"))
                meets = np.zeros(least.shape, bool)
                for w in range(low.shape[1]):
                    a, b = low[:, w : w + 1], high[:, w : w + 1]
                    meets |= (most >= a) & (least <= b) & (a <= b)
                meets &= rows > 0
                read = np.flatnonzero(meets.any(0))
                yield _frame("group long, block long, anchors binary", [[row["block"]] * len(read), [row["zones"][z]["block"] for z in read], [_raw(np.flatnonzero(meets[:, z])) for z in read]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                anchors, ids, labels = _ints(row["anchors"]), _ints(row["vec_ids"]), _ints(row["labels"])
                own_ids, own_labels = _ints(row["own_ids"]), _ints(row["own_labels"])
                low, high = (np.array(row[c]).reshape(len(own_ids), -1)[anchors] for c in ("lows", "highs"))
                scores = products(_matrix(row["own_vectors"], len(own_ids))[anchors], _matrix(row["vectors"], len(ids)))
                fits = labels == own_labels[anchors][:, None]
                fits = fits & (ids != own_ids[anchors][:, None]) if same else ~fits
                order = np.argsort(-scores, axis=1, kind="stable")
                scores, fits = (np.take_along_axis(x, order, 1) for x in (scores, fits))
                for w in range(low.shape[1]):
                    inside = fits & (scores >= low[:, w : w + 1]) & (scores <= high[:, w : w + 1])
                    a, place = np.nonzero(inside & (np.cumsum(inside, axis=1) <= k))
                    if len(a):
                        yield _frame(found, [np.full(len(a), row["group"]), anchors[a], np.full(len(a), w), ids[order[a, place]], scores[a, place]])
        release()

    found = "group long, anchor long, window long, vec_id long, score long"
    zones = blocks.select("block", "n", "low", "high", "kinds", "counts")
    slim = groups.select("block", "labels", "vectors", "lows", "highs")
    raised = _pairs(slim, zones).mapInArrow(tighten, "group long, lows array<long>").select("group", F.posexplode("lows").alias("slot", "low"))
    raised = raised.groupBy("group", "slot").agg(F.max("low").alias("low"))
    lows = raised.groupBy("group").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "low"))), lambda x: x["low"]).alias("lows"))
    tight = stage(groups.drop("lows").join(lows, groups["block"] == lows["group"]))
    reads = stage(_pairs(tight.select("block", "labels", "vectors", "lows", "highs"), zones).mapInArrow(choose, "group long, block long, anchors binary"))
    own = tight.select("group", F.col("vec_ids").alias("own_ids"), F.col("labels").alias("own_labels"), F.col("vectors").alias("own_vectors"), "lows", "highs")
    met = reads.join(own, "group").join(blocks.select("block", "vec_ids", "labels", "vectors"), "block")
    order = Window.partitionBy("group", "anchor", "window").orderBy(F.desc("score"), "vec_id")
    ranked = met.mapInArrow(score, found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def mine(table: DataFrame, anchors: Column, scale: int = 256, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each
    anchor its first ``positives`` other rows of its label, and for each of them the first
    ``negatives`` rows of other labels whose score is ``least`` to ``most`` percent of it. table:
    vec_id, label, vector; ``anchors`` tells which rows are anchors, by vec_id."""
    rows = keyed(quantized(table, scale))
    blocks, groups = packed(rows, BLOCK), packed(rows.filter(anchors), GROUP)
    everywhere = groups.withColumns({"lows": F.array_repeat(F.lit(-FAR), F.col("n").cast("int")), "highs": F.array_repeat(F.lit(FAR), F.col("n").cast("int"))})
    first = stage(in_windows(everywhere, blocks, positives, True).select("group", "anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    def windows(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.column("n")[0].as_py()
        low, high = np.full((n, positives), 1, np.int64), np.zeros((n, positives), np.int64)
        at = right.column("anchor").to_numpy(), right.column("window").to_numpy()
        score = right.column("positive_score").to_numpy().astype(object)  # 95 times a score may need more than 64 bits
        low[at], high[at] = [-(-least * s // 100) for s in score], [most * s // 100 for s in score]
        return pa.Table.from_batches([_frame("block long, lows array<long>, highs array<long>", [[key[0].as_py()], [low.ravel().tolist()], [high.ravel().tolist()]])])

    slots = groups.select("block", "n").groupBy("block").cogroup(first.withColumnRenamed("group", "block").groupBy("block"))
    asked = groups.join(slots.applyInArrow(windows, "block long, lows array<long>, highs array<long>"), "block")
    hard = in_windows(asked, blocks, negatives, False).select("group", "anchor", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = _ints(row["vec_ids"])
                yield _frame("group long, anchor long, anchor_id long", [np.full(len(ids), row["block"]), np.arange(len(ids)), ids])

    known = groups.select("block", "vec_ids").mapInArrow(names, "group long, anchor long, anchor_id long")
    named = hard.join(first, ["group", "anchor", "window"]).join(known, ["group", "anchor"])
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
