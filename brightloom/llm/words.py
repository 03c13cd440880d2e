"""Words and hashed word windows of whole texts, a batch at a time.

A word is a run of characters other than space and tab to carriage return
(``[^\\x20\\x09-\\x0D]+``); a null text has none. Hashes are 64 bits wide.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The same words for Spark's SQL functions: split here and drop empty pieces.
BLANKS = "[\\x20\\x09-\\x0D]+"
#: Rows of a batch that are worked on together; bounds memory, changes no result.
ROWS = 512

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def release() -> None:
    """Give memory that a task has freed back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # only the GNU library has it
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers (the splitmix one)."""
    x = x.astype(np.uint64) + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers drawn by a fixed rule."""
    return mix(np.arange(n, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003)) | np.uint64(1)


def has_words(text: Column) -> Column:
    """Whether a text holds a word; a null one does not."""
    return F.coalesce(text.rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))


def text_column(values: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Whole texts as one array of its own, as some functions misread slices; null texts
    become empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return pc.fill_null(values.cast(pa.large_string()).take(pa.array(np.arange(len(values)))), "")


def parts(batch: pa.RecordBatch, column: str, size: int, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes of one column and at most ``rows`` rows; a longer value
    is a slice of its own."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, side="right")))
        stop = min(stop, at + rows) if rows else stop
        yield batch.slice(at, stop - at)
        at = stop


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Per word the number of its text and of its entry in the list of distinct words."""
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:  # what stands before a leading and after a trailing blank
        real = codes != blank
        owner, codes = owner[real], codes[real]
    return owner, codes, coded.dictionary


def hash_words(distinct: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word windows. A text of fewer
    words has one window, all its words; one without words has none."""
    owner, codes, distinct = word_codes(pc.ascii_lower(texts))
    hashed = hash_words(distinct)[codes]
    counts = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(counts)])
    power = multipliers(width, 17)
    rolled = np.zeros(len(hashed), np.uint64)
    for j in range(width):  # words of the next text are cut off below
        rolled[: max(len(hashed) - j, 0)] += hashed[j:] * power[j]
    out = []
    for a, n in zip(first[:-1], counts):
        if n >= width:
            out.append(np.unique(mix(rolled[a : a + n - width + 1])))
        elif n:
            out.append(mix((hashed[a : a + n] * power[:n]).sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
