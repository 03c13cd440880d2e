"""Token ids in files of Simple-8b words, written by range of doc_id and read back.

A 64-bit word has a selector in its upper four bits; it says how many values of how many
bits share the other 60. Ids are coded in blocks of ``BLOCK``; a word never crosses blocks,
and the place of each block's first word is stored, so blocks are coded and decoded side by
side as arrays. Values of more than 60 bits are escapes: zero in the words, and position and
value in a list of their own.

The files are a Parquet table, so that any store Spark writes to will do and a lost task is
written again as a whole. A row is a run of whole documents: ``shard`` (ascending ranges of
doc_id), ``segment``, ``before`` (ids of the shard before it), ``ids`` (its own ids),
``doc_ids`` and ``payload``:

    S8B1 | documents, ids, blocks, words, escapes (5 x u64) | ids per document (u64)
    | first word of each block (u64) | words (u64) | escape positions, escape values (u64)

all little-endian. Rows follow ascending doc_id, null first, equal ones by text. A null or
empty text is its end id alone; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightloom.llm.tokens import ROWS, Encoder
from brightloom.llm.words import release, text_column
from brightloom.session import shared_dir

# Fixed values of the format: values and bits per word, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int32)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"S8B1"

#: Ids of a block, and blocks coded together.
BLOCK = 1024
TOGETHER = 64


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value takes, 0 for 0; of values beyond 2 ** 53, one more at most."""
    return np.frexp(values.astype(np.float64))[1]


def code(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block, escape positions, escape values. Each word takes as
    many of the next values as fit; the last of a block may hold fewer than its selector says."""
    values = values.astype(np.uint64)
    escape = np.flatnonzero(values >> np.uint64(60))
    escaped = values[escape]
    values[escape] = 0
    words, block_at, before = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    for at in range(0, len(values), TOGETHER * BLOCK):
        some, first = _code(values[at : at + TOGETHER * BLOCK])
        words.append(some)
        block_at.append(first + before)
        before += len(some)
    return np.concatenate(words), np.concatenate(block_at), escape, escaped


def _code(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(values)
    blocks = -(-n // BLOCK)
    need = _bits(values)
    end = np.minimum((np.arange(n, dtype=np.int32) // BLOCK + 1) * BLOCK, n).astype(np.int32)
    choice = np.full(n, 15, np.int8)
    fit = np.arange(n, dtype=np.int32)
    for s in range(14, -1, -1):  # the smallest selector that fits holds the most values
        fit = fit[need[fit] <= BITS[s]]
        if not len(fit):
            break
        last = np.append(np.flatnonzero(fit[1:] != fit[:-1] + 1), len(fit) - 1)  # of runs of narrow values
        run = np.diff(last, prepend=-1)
        stop = np.repeat(fit[last] + 1, run)
        choice[fit[stop >= np.minimum(fit + COUNTS[s], end[fit])]] = s
    # from word to word, all blocks at once
    at, step = np.arange(blocks) * BLOCK, COUNTS[choice]
    starts = np.zeros(n, bool)
    live = at
    while len(live):
        starts[live] = True
        later = live + step[live]
        live = later[later < end[live]]
    first = np.flatnonzero(starts)
    selector = choice[first]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector):
        if not BITS[s]:
            continue
        here = np.flatnonzero(selector == s)
        index = first[here][:, None] + np.arange(COUNTS[s])
        inside = index < end[first[here]][:, None]
        taken = np.where(inside, values[np.minimum(index, n - 1)], 0).astype(np.uint64)
        words[here] |= np.bitwise_or.reduce(taken << (np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(BITS[s])), axis=1)
    return words, np.searchsorted(first, at)


def decode(words: np.ndarray, block_at: np.ndarray, n: int, escape: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    """The values again."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    upto = np.cumsum(counts) - counts
    block = np.searchsorted(block_at, np.arange(len(words)), side="right") - 1
    place = upto - upto[block_at][block] + block * BLOCK if len(words) else upto
    end = np.minimum((block + 1) * BLOCK, n)
    out = np.zeros(n, np.uint64)
    for s in np.unique(selector):
        if not BITS[s]:
            continue
        here = np.flatnonzero(selector == s)
        shift = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(BITS[s])
        values = (words[here][:, None] >> shift) & np.uint64((1 << int(BITS[s])) - 1)
        index = place[here][:, None] + np.arange(COUNTS[s])
        inside = index < end[here][:, None]
        out[index[inside]] = values[inside]
    out[escape] = escaped
    return out


def to_payload(ids: np.ndarray, per_doc: np.ndarray) -> bytes:
    words, block_at, escape, escaped = code(ids)
    head = np.array([len(per_doc), len(ids), len(block_at), len(words), len(escape)], "<u8")
    return MAGIC + b"".join(np.asarray(x, "<u8").tobytes() for x in (head, per_doc, block_at, words, escape, escaped))


def from_payload(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and ids per document."""
    if payload[:4] != MAGIC:
        raise ValueError("not a Simple-8b segment")
    all_ = np.frombuffer(payload, "<u8", offset=4)
    docs, n, blocks, words, escapes = all_[:5].astype(np.int64)
    per_doc, block_at, coded, escape, escaped = np.split(all_[5:], np.cumsum([docs, blocks, words, escapes]))
    return decode(coded, block_at.astype(np.int64), int(n), escape.astype(np.int64), escaped), per_doc.astype(np.int64)


def write(docs: DataFrame, path: str, folder: str, end: int = 2) -> None:
    """Encode all documents and write their ids below ``folder``."""
    end_id = np.asarray([end], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = Encoder.of(path), TaskContext.get().partitionId()
        segment = before = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, upto = encoder.encode(text_column(part.column("text")))
                ids = np.insert(ids, upto[1:], end_id)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard]), pa.array([segment]), pa.array([before]), pa.array([len(ids)]),
                        pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([to_payload(ids, np.diff(upto) + 1)], pa.binary()),
                    ],
                    names=["shard", "segment", "before", "ids", "doc_ids", "payload"],
                )
                segment += 1
                before += len(ids)
        release()

    slim = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    coded = slim.mapInArrow(run, "shard long, segment long, before long, ids long, doc_ids array<long>, payload binary")
    coded.write.parquet(folder)


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 and, if asked for, the ids (little-endian 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before, docs, payload in zip(*(batch.column(c).to_pylist() for c in ("shard", "before", "doc_ids", "payload"))):
                ids, per_doc = from_payload(payload)
                ids = ids.astype("<u4")
                upto = np.concatenate([[0], np.cumsum(per_doc)])
                raw = [ids[a:b].tobytes() for a, b in zip(upto[:-1], upto[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64()), pa.array([shard] * len(docs)), pa.array(before + upto[:-1]), pa.array(per_doc),
                        pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array(raw if with_ids else [None] * len(raw), pa.binary()),
                    ],
                    names=["doc_id", "shard", "inside", "n_tokens", "ids_crc32", "ids"],
                )

    schema = "shard long, segment long, before long, ids long, doc_ids array<long>, payload binary"
    files = spark.read.schema(schema).parquet(folder)
    rows = files.select("shard", "before", "doc_ids", "payload").mapInArrow(
        run, "doc_id long, shard long, inside long, n_tokens long, ids_crc32 long, ids binary"
    )
    # a row per shard
    totals = files.groupBy("shard").agg(F.sum("ids").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return rows.join(bases, "shard").select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids")


def round_trip(docs: DataFrame, path: str, end: int = 2) -> DataFrame:
    """Write the documents to a new folder in the shared place and read them back."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    write(docs, path, folder, end)
    return read(spark, folder)
