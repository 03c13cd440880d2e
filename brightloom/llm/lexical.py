"""Ranked lexical search by range maxima over posting lists.

Index: documents are taken in blocks as they are read, ordered by doc_id inside; a row of the
index is one block with a posting list for each of its terms. Nothing is shuffled.

Search: every block meets all items of a chunk. A term's list of a block has a sparse table
that tells the highest gain in any range of it. An interval of documents is bounded by the sum
of its terms' range maxima; the intervals of highest bound are split first, at the document
where the term that adds most has its maximum. That document is scored in full, and what
remains left and right of it gets bounds of its own. Intervals that cannot beat the k-th best
score so far are dropped; those that tie with it stay as long as they begin with a smaller
doc_id. The best of earlier blocks of the same task hold for the next ones. The best of all
tasks meet in two steps of k rows an item.

Items are read in chunks of bounded size (``CHUNK_ITEMS``, ``CHUNK_BYTES``; one item at
least), each searched in all documents and written before the next one is read. A chunk's
terms and weights travel with the tasks, so their size is bounded too.

A null text has no terms; documents and items without terms are in no result. Rows that repeat
are documents, or items, of their own. A null doc_id counts as the largest one and comes back
as null. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.words import parts, release, text_column, word_codes
from brightloom.session import shared_dir

#: Terms are runs of these: digits, letters and all that is not ASCII; A-Z are lowered.
_PLAIN = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256)).lower()
#: Documents and bytes of text of a block.
ROWS = 2048
BLOCK_BYTES = 8 << 20
#: Items and bytes of text of a chunk.
CHUNK_ITEMS = 4096
CHUNK_BYTES = 1 << 20
#: Places in a table of items and terms that are searched together, and intervals of an item
#: that are split together; they bound memory and change no result.
TOGETHER = 4096
SPLIT = 8
#: Stands for a null doc_id.
LAST = np.iinfo(np.int64).max

INDEX = "block long, documents long, occurrences long, doc_ids binary, lengths binary, terms binary, begins binary, places binary, counts binary"


def term_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Per term the number of its text and of its entry in the list of distinct terms."""
    _, offsets, data = texts.buffers()
    plain = pa.py_buffer((data.to_pybytes() if data else b"").translate(_PLAIN))
    return word_codes(pa.LargeStringArray.from_buffers(len(texts), offsets, plain))


def index(docs: DataFrame) -> DataFrame:
    """One row per block of documents, see ``INDEX``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in parts(batch, "text", BLOCK_BYTES, ROWS):
                ids = pc.fill_null(part.column("doc_id"), LAST).to_numpy(zero_copy_only=False).astype(np.int64)
                order = np.argsort(ids, kind="stable")
                owner, codes, names = term_codes(text_column(part.column("text")))
                place = np.empty(len(ids), np.int64)
                place[order] = np.arange(len(ids))
                lengths = np.bincount(place[owner], minlength=len(ids))
                posting, counts = np.unique(codes * ROWS + place[owner], return_counts=True)
                begins = np.searchsorted(posting, np.arange(len(names) + 1) * ROWS)
                # an entry that only blanks held has no postings, and none is looked for
                row = [
                    block, int((lengths > 0).sum()), int(lengths.sum()), ids[order].astype("<i8").tobytes(), lengths.astype("<i8").tobytes(),
                    "\n".join(names.to_pylist()).encode(), begins.astype("<u4").tobytes(), (posting % ROWS).astype("<u2").tobytes(), counts.astype("<u4").tobytes(),
                ]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64() if isinstance(x, int) else pa.binary()) for x in row], names=[c.split()[0] for c in INDEX.split(", ")])
                block += 1
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX)


class Lists:
    """Posting lists of one block, one after the other, with their sparse table."""

    def __init__(self, doc: np.ndarray, gain: np.ndarray, begins: np.ndarray, documents: int):
        """doc ascends within a list; the last list must be empty."""
        self.doc, self.gain, self.begins, self.documents = doc, gain, begins, documents
        lists = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        self.keys = lists * (documents + 1) + doc
        longest = int(np.diff(begins).max(initial=1))
        n = len(doc)
        self.table = [np.arange(n, dtype=np.int32)]  # place of the maximum of 2 ** k postings from a place on
        for k in range(1, longest.bit_length()):
            low = self.table[-1][: max(n - (1 << k) + 1, 0)]
            high = self.table[-1][1 << (k - 1) :][: len(low)]
            best = np.where(gain[low] >= gain[high], low, high)
            self.table.append(np.concatenate([best, np.zeros(n - len(best), np.int32)]))
        self.table = np.stack(self.table)
        self.level = np.zeros(longest + 1, np.int8)
        for k in range(1, longest.bit_length()):
            self.level[1 << k :] = k

    def highest(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the highest gain from begin to before end, and that gain, 0 of none."""
        size = end - begin
        some = size > 0
        k = self.level[size]
        a = self.table[k, np.where(some, begin, 0)]
        b = self.table[k, np.where(some, end - (1 << k.astype(np.int64)), 0)]
        place = np.where(self.gain[a] >= self.gain[b], a, b)
        return place, np.where(some, self.gain[place], 0)

    def find(self, lists: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The place of a document, or of the first one after it, in each list."""
        return np.searchsorted(self.keys, lists * (self.documents + 1) + doc)


class Best:
    """The k best documents of every item so far, equal scores by doc_id."""

    def __init__(self, items: int, k: int):
        self.items, self.k = items, k
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))
        self.least = np.zeros(items, np.int64)  # an item with k documents: its last one's score
        self.last = np.full(items, -1, np.int64)  # and doc_id

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        item, score, doc = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = (rank < self.k) & (score > 0)
        self.item, self.score, self.doc = item[kept], score[kept], doc[kept]
        full = rank[kept] == self.k - 1
        self.least[self.item[full]] = self.score[full]
        self.last[self.item[full]] = self.doc[full]

    def open(self, item: np.ndarray, bound: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether documents from ``first`` on with at most that score can still come in."""
        return (bound > self.least[item]) | (bound == self.least[item]) & (bound > 0) & (first < self.last[item])


def search_lists(lists: Lists, ids: np.ndarray, item: np.ndarray, terms: np.ndarray, factor: np.ndarray, best: Best) -> int:
    """Bring the items' best documents of one block into ``best``; returns how many documents
    were scored. terms: (items, terms) numbers of lists, the last one for none; factor: what a
    term's gain counts for."""
    nowhere = len(lists.begins) - 2

    def bounded(row, begin, end, low, high):
        place, gain = lists.highest(begin, end)
        part = gain * factor[row]
        split = lists.doc[place[np.arange(len(row)), part.argmax(1)]] if len(row) else low
        return [row, begin, end, low, high, part.sum(1), split]

    def narrowed(state):
        row, low, high, bound = state[0], state[3], state[4], state[5]
        keep = (low < high) & best.open(item[row], bound, ids[np.minimum(low, len(ids) - 1)])
        return [x[keep] for x in state]

    if not len(lists.doc):
        return 0
    row = np.arange(len(item))
    low = np.zeros(len(row), np.int64)
    state = narrowed(bounded(row, lists.begins[terms], lists.begins[terms + 1], low, low + lists.documents))
    scored = 0
    while len(state[0]):
        order = np.lexsort((-state[5], state[0]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - np.searchsorted(state[0][order], state[0][order])
        now = rank < SPLIT
        row, begin, end, low, high, _, split = (x[now] for x in state)
        own = terms[row]
        place = lists.find(own, split[:, None])
        there = (place < end) & (own != nowhere)
        there &= lists.doc[np.minimum(place, len(lists.doc) - 1)] == split[:, None]
        score = (np.where(there, lists.gain[np.minimum(place, len(lists.doc) - 1)], 0) * factor[row]).sum(1)
        scored += len(row)
        best.add(item[row], score, ids[split])
        left = bounded(row, begin, np.maximum(np.minimum(place, end), begin), low, split)
        right = bounded(row, np.minimum(np.maximum(place, begin) + there, end), end, split + 1, high)
        rest = [x[~now] for x in state]
        state = narrowed([np.concatenate(x) for x in zip(rest, left, right)])
    return scored


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _groups(items: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[list[int]]:
    """Items of like numbers of terms, at most ``TOGETHER`` places in all or one item."""
    group: list[int] = []
    for i in sorted(range(len(items)), key=lambda i: len(items[i][0])):
        if group and (len(group) + 1) * len(items[i][0]) > TOGETHER:
            yield group
            group = []
        if len(items[i][0]):
            group.append(i)
    if group:
        yield group


def _lists(row: dict, wanted: pa.Array, at: np.ndarray, m: np.ndarray) -> tuple[Lists, np.ndarray]:
    """The lists of some of the wanted terms in a block, and for each of them which it is."""
    begins, places, counts = (np.frombuffer(row[c], t).astype(np.int64) for c, t in (("begins", "<u4"), ("places", "<u2"), ("counts", "<u4")))
    here = at >= 0
    a, b = begins[at[here]], begins[at[here] + 1]
    size = b - a
    upto = np.concatenate([[0], np.cumsum(size)])
    take = np.arange(upto[-1]) + np.repeat(a - upto[:-1], size)
    doc, tf = places[take], counts[take]
    number = np.full(len(at), here.sum())
    number[here] = np.arange(here.sum())
    return Lists(doc, 1_000_000_000 * tf // (1000 * tf + 8 * m[doc]), np.append(upto, upto[-1]), len(m)), number


def _search_chunk(blocks: DataFrame, first: int, texts: list[str | None], k: int, n: int, total: int) -> DataFrame:
    """(item number, doc_id, score) of the best documents of a chunk of items, k a task."""
    owner, codes, wanted = term_codes(text_column(pa.array(texts, pa.large_string())))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                at = pc.fill_null(pc.index_in(wanted, _names(row)), -1).to_numpy(zero_copy_only=False)
                begins = np.frombuffer(row["begins"], "<u4").astype(np.int64)
                found[at >= 0] += np.diff(begins)[at[at >= 0]]
        term = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(found[term], pa.int64())], names=["term", "df"])

    counted = blocks.select("terms", "begins").mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weights = np.zeros(len(wanted), np.int64)
    for term, df in counted.collect():  # at most the terms of the chunk
        weights[term] = weight(n, df)
    pairs, repeats = np.unique(owner * max(len(wanted), 1) + codes, return_counts=True)
    of_item, term = np.divmod(pairs, max(len(wanted), 1))
    useful = weights[term] > 0
    of_item, term, factor = of_item[useful], term[useful], (repeats * weights[term])[useful]
    bounds = np.searchsorted(of_item, np.arange(len(texts) + 1))
    items = [(term[a:b], factor[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, groups = Best(len(items), k), list(_groups(items))
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, lengths = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["lengths"], "<i8")
                m = 100 - 75 + 75 * lengths * n // total
                at = pc.fill_null(pc.index_in(wanted, _names(row)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                for group in groups:
                    used = np.unique(np.concatenate([items[g][0] for g in group]))
                    lists, number = _lists(row, wanted, at[used], m)
                    width = max(len(items[g][0]) for g in group)
                    terms, times = np.full((len(group), width), len(lists.begins) - 2), np.zeros((len(group), width), np.int64)
                    for j, g in enumerate(group):
                        terms[j, : len(items[g][0])] = number[np.searchsorted(used, items[g][0])]
                        times[j, : len(items[g][0])] = items[g][1]
                    search_lists(lists, ids, np.array(group), terms, times, best)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (best.item + first, best.doc, best.score)], names=["item", "doc_id", "score"])
        release()

    return blocks.select("doc_ids", "lengths", "terms", "begins", "places", "counts").mapInArrow(run, "item long, doc_id long, score long")


def _names(row: dict) -> pa.Array:
    return pa.array(row["terms"].decode().split("\n"), pa.large_string())


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, equal scores by
    ascending doc_id, none with score 0. docs: doc_id, text; items: item_id, text."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/lexical-{uuid.uuid4().hex}"
    index(docs).write.option("parquet.block.size", 32 << 20).parquet(f"{folder}/index")
    blocks = spark.read.schema(INDEX).parquet(f"{folder}/index")
    n, total = blocks.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("occurrences"), F.lit(0))).first()
    kind = items.schema["item_id"].dataType.simpleString()
    names, found = f"item long, item_id {kind}", "item long, doc_id long, score long"
    empty = spark.createDataFrame([], names), spark.createDataFrame([], found)
    for frame, part in zip(empty, ("items", "found")):
        frame.write.parquet(f"{folder}/{part}")

    def flush(first: int, chunk: list) -> None:
        spark.createDataFrame([(first + i, x.item_id) for i, x in enumerate(chunk)], names).write.mode("append").parquet(f"{folder}/items")
        _search_chunk(blocks, first, [x.text for x in chunk], k, n, total).write.mode("append").parquet(f"{folder}/found")

    chunk, size, first = [], 0, 0
    for x in items.select("item_id", "text").toLocalIterator() if total else ():
        if chunk and (len(chunk) == CHUNK_ITEMS or size + len(x.text or "") > CHUNK_BYTES):
            flush(first, chunk)
            first, chunk, size = first + len(chunk), [], 0
        chunk.append(x)
        size += len(x.text or "")
    if chunk:
        flush(first, chunk)

    best = spark.read.schema(found).parquet(f"{folder}/found").withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(32)))
    order = (F.desc("score"), "doc_id")
    for keys in (["item", "share"], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    named = best.join(spark.read.schema(names).parquet(f"{folder}/items"), "item")
    return named.select("item_id", "rank", F.nullif("doc_id", F.lit(int(LAST))).alias("doc_id"), "score")
