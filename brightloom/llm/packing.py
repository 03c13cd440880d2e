"""Token sequences of at most a given length, packed by multiway differencing.

A document is its ids and one end id. Full windows are cut off as sequences of their own;
what is left, in pieces of at most ``piece_tokens``, is dealt into groups of bounded size.
In a group, the Karmarkar-Karp method puts the pieces into k windows: the two partial
partitions with the largest imbalance are merged again and again, the large sums of one
against the small sums of the other, until one partition with near-equal windows is left.
k starts at the least possible count and rises whenever a window exceeds the capacity.

No id is dropped: each lies in exactly one piece. A null or empty text is its end id alone.
Rows that repeat a doc_id, or whole rows, are packed as documents of their own. An empty
table gives no piece. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm.tokens import ROWS, Encoder
from brightloom.llm.words import release, text_column
from brightloom.session import stage

#: Pieces a group holds on average; bounds the memory of a task.
GROUP = 2048
#: Numbers of packed windows start here; full windows are numbered from 0.
PACKED = 1 << 62


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window (0 .. windows - 1) of every piece."""
    n = len(sizes)
    joined = np.arange(n)  # a slot's pieces hang below the piece that stands for the slot
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap = []
    for i, size in enumerate(sizes.tolist()):
        total, stands = np.zeros(windows, np.int64), np.full(windows, -1)
        total[0], stands[0] = size, i
        sums[i] = total, stands
        heap.append((-size, i))
    heapq.heapify(heap)
    fresh = n
    while len(heap) > 1:
        (one, mine), (two, yours) = sums.pop(heapq.heappop(heap)[1]), sums.pop(heapq.heappop(heap)[1])
        total, yours = one + two[::-1], yours[::-1]
        meet = (mine >= 0) & (yours >= 0)
        joined[yours[meet]] = mine[meet]
        stands = np.where(mine >= 0, mine, yours)
        order = np.argsort(-total, kind="stable")
        total = total[order]
        sums[fresh] = total, stands[order]
        heapq.heappush(heap, (int(total[-1] - total[0]), fresh))
        fresh += 1
    while (joined != joined[joined]).any():
        joined = joined[joined]
    _, stands = sums.popitem()[1]
    window = np.full(n, -1)
    window[stands[stands >= 0]] = np.flatnonzero(stands >= 0)
    return window[joined]


def pack_group(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of every piece; no window holds more than ``capacity``."""
    total = int(sizes.sum())
    windows = max(1, -(-total // capacity))
    while True:
        window = difference(sizes, windows)
        held = np.bincount(window, weights=sizes, minlength=windows)
        if held.max() <= capacity:
            break
        excess = held.max() - total / windows  # what a window takes above the mean
        windows = max(windows + 1, int(np.ceil(total / max(capacity - excess, 1))) if excess < capacity // 2 else 0)
    order = np.argsort(window, kind="stable")
    upto = np.cumsum(sizes[order])
    first = np.searchsorted(window[order], np.arange(windows))
    base = np.concatenate([[0], upto])[first]
    offset = np.empty(len(sizes), np.int64)
    offset[order] = upto - sizes[order] - base[window[order]]
    return window, offset


def pieces(docs: DataFrame, path: str, end: int, capacity: int, piece_tokens: int, with_ids: bool) -> DataFrame:
    """Every document cut up: piece (a unique number), doc_id, start, length, ids_crc32,
    doc_tokens, whole (a full window) and, if asked for, the ids."""
    end_id = np.asarray([end], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = Encoder.of(path), TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, upto = encoder.encode(text_column(part.column("text")))
                rows: list[tuple] = []
                for doc, a, b in zip(part.column("doc_id").to_pylist(), upto[:-1], upto[1:]):
                    own = np.concatenate([ids[a:b], end_id])
                    begin = 0
                    while begin < len(own):
                        left = len(own) - begin
                        size = capacity if left >= capacity else min(left, piece_tokens)
                        raw = own[begin : begin + size].tobytes()
                        rows.append((number, doc, begin, size, zlib.crc32(raw), len(own), size == capacity, raw if with_ids else None))
                        number += 1
                        begin += size
                columns = list(zip(*rows)) or [[]] * 8
                types = [pa.int64()] * 6 + [pa.bool_(), pa.binary()]
                names = ["piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "whole", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        release()

    schema = "piece long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, whole boolean, ids binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pack(
    docs: DataFrame, path: str, end: int = 1, capacity: int = 2048, piece_tokens: int = 1024, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and ids (little-endian 32-bit, null unless ``with_ids``)."""
    cut_up = stage(pieces(docs, path, end, capacity, piece_tokens, with_ids))
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    whole = cut_up.filter("whole").select(*kept, F.col("piece").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = cut_up.filter("not whole")
    groups = max(1, -(-rest.count() // GROUP))
    dealt = rest.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by("piece")
        window, offset = pack_group(group.column("length").to_numpy(), capacity)
        number = PACKED + (group.column("group").to_numpy() << 20) + window
        return group.select(kept).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, sequence_id long, offset long"
    return whole.unionByName(dealt.groupBy("group").applyInArrow(place, schema))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: their tokens and pieces in order. A sequence holds
    ``capacity`` ids at most, so each group is bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x.length).alias("n_tokens"),
        F.transform("p", lambda x: F.struct(x.doc_id.alias("doc_id"), x.start.alias("start"), x.length.alias("length"))).alias("pieces"),
        F.unhex(F.concat_ws("", F.transform("p", lambda x: F.hex(x.ids)))).alias("ids"),
    )
