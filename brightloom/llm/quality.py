"""Quality rules and a calibrated n-gram classifier for documents.

Counts per text (words are ``[^\\x20\\x09-\\x0D]+``): n_words, word_chars, n_symbols,
n_dup_lines, n_repeat_words. Rules on them reject a text outright (``base_failed``). The
others are judged by a logistic regression on hashed word 1- and 2-grams and character 2- to
4-grams: each kind's relative frequencies meet one weight per hash bucket. It is trained on
the labelled rows of the quality column, at most ``SAMPLE`` of them, the smallest in a fixed
hash of their ids; probabilities are calibrated by Platt's two parameters on a quarter of
these held out from training. Scoring runs in Arrow batches over whole texts; a document is
kept when its probability reaches ``THRESHOLD``.

Nulls and odd input: a null text has no words and fails the rules, as an empty one does.
Labels that are null, that call a document both good and bad, or whose document is missing,
are not trained on; without labels of both kinds every text that passes the rules is kept. Equal rows get equal verdicts. An empty
table gives an empty result. Columns besides ``doc_id`` and ``text`` pass through unread.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm.words import ROWS, hash_words, mix, multipliers, release, text_column, word_codes

#: Labelled rows the classifier is fitted on, at most. Bounds memory of the one fitting task.
SAMPLE = 4096
#: Buckets of hashed n-grams, per kind.
BUCKETS = 1 << 16
#: Least probability of good quality.
THRESHOLD = 0.5
#: Kinds of n-grams: words 1 and 2, characters 2 to 4.
WORD_GRAMS, CHAR_GRAMS = (1, 2), (2, 3, 4)
KINDS = len(WORD_GRAMS) + len(CHAR_GRAMS)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"[#*$%&|<>]"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS[1:-1])] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _per_text(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(marked)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _duplicate_lines(text: str) -> int:
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(" \t\n\x0b\x0c\r"):
            seen.add(line)
    return again


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The five counts, as arrays over texts."""
    raw, offsets = _bytes(texts)
    owner, codes, distinct = word_codes(texts)
    n = len(texts)
    n_words = np.bincount(owner, minlength=n)
    hashed = hash_words(distinct)[codes]
    first = np.concatenate([[0], np.cumsum(n_words)])
    power = multipliers(3, 23)
    windows = mix(hashed[:-2] * power[0] + hashed[1:-1] * power[1] + hashed[2:] * power[2]) if len(hashed) > 2 else hashed[:0]
    repeat = np.zeros(n, np.int64)
    for i in np.flatnonzero(n_words >= 4):
        own = windows[first[i] : first[i + 1] - 2]
        _, back, count = np.unique(own, return_inverse=True, return_counts=True)
        found = np.flatnonzero(count[back] > 1)
        if len(found):
            covered = np.zeros(n_words[i], bool)
            for j in range(3):
                covered[found + j] = True
            repeat[i] = covered.sum()
    return {
        "n_words": n_words, "word_chars": _per_text(((raw & 0xC0) != 0x80) & ~_BLANK[raw], offsets),
        "n_symbols": _per_text(_SYMBOL[raw], offsets),
        "n_dup_lines": np.fromiter((_duplicate_lines(t) if "\n" in t else 0 for t in texts.to_pylist()), np.int64, n),
        "n_repeat_words": repeat,
    }


def base_failed(m: dict[str, np.ndarray]) -> np.ndarray:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def grams(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind of n-gram the owner (number of the text) and the bucket of every n-gram."""
    out = []
    owner, codes, distinct = word_codes(texts)
    hashed = hash_words(distinct)[codes]
    for n in WORD_GRAMS:
        out.append(_windows(owner, hashed, n, 31 + n))
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    for n in CHAR_GRAMS:
        out.append(_windows(owner, points, n, 41 + n))
    return out


def _windows(owner: np.ndarray, values: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(len(values) - n + 1, 0)
    total = np.zeros(size, np.uint64)
    for j, power in enumerate(multipliers(n, seed)):
        total += values[j : j + size] * power
    inside = owner[:size] == owner[n - 1 : n - 1 + size]  # not across two texts
    bucket = ((total * multipliers(1, seed + 100)[0]) >> np.uint64(48)).astype(np.int32)
    return owner[:size][inside], bucket[inside]


def linear(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Per text the sum over kinds of the mean weight of its n-grams. weights: KINDS x BUCKETS."""
    score = np.zeros(len(texts))
    for kind, (owner, bucket) in enumerate(grams(texts)):
        count = np.bincount(owner, minlength=len(texts))
        score += np.bincount(owner, weights[kind][bucket], len(texts)) / np.maximum(count, 1)
    return score


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(texts: pa.Array, good: np.ndarray, held_out: np.ndarray, steps: int = 60) -> tuple[np.ndarray, float, float]:
    """Weights, and slope and shift that turn a score into a calibrated log odds."""
    train = np.flatnonzero(~held_out)
    chunks = []  # (first row, rows, row, column, value) of each part; never joined, to save memory
    for at in range(0, len(texts), ROWS):
        some = texts.slice(at, ROWS)
        for kind, (owner, bucket) in enumerate(grams(some)):
            cell, count = np.unique(owner.astype(np.int64) * BUCKETS + bucket, return_counts=True)
            row = cell // BUCKETS
            total = np.bincount(row, count, len(some))
            column = (cell % BUCKETS + kind * BUCKETS).astype(np.int32)
            chunks.append((at, len(some), row.astype(np.int16), column, (count / total[row]).astype(np.float32)))

    def score(weights: np.ndarray) -> np.ndarray:
        z = np.zeros(len(texts))
        for at, n, row, column, value in chunks:
            z[at : at + n] += np.bincount(row, weights[column] * value, n)
        return z

    share = good[train].mean()
    balance = np.where(good, 0.5 / share, 0.5 / (1 - share)) / len(train)  # both kinds weigh the same
    weights, shift = np.zeros(KINDS * BUCKETS), 0.0
    square, shift_square = np.full(KINDS * BUCKETS, 1e-8), 1e-8
    for _ in range(steps):  # full batches, a step size of its own for every weight
        z = score(weights) + shift
        slope = (_sigmoid(z) - good) * balance
        slope[held_out] = 0
        change = 1e-7 * weights
        for at, _, row, column, value in chunks:
            change += np.bincount(column, slope[row + np.int64(at)] * value, len(weights))
        square += change**2
        weights -= 0.5 * change / np.sqrt(square)
        shift_square += slope.sum() ** 2
        shift -= 0.1 * slope.sum() / np.sqrt(shift_square)
    scores = score(weights)
    # Platt: two parameters by Newton steps on the held-out rows, with his smoothed targets
    z, y = scores[held_out], good[held_out]
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2)
    t, x = np.where(y, high, low), np.stack([z, np.ones(len(z))], axis=1)
    beta = np.array([1.0, shift])
    for _ in range(50):
        p = _sigmoid(x @ beta)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - t) + 1e-6 * (beta - [1.0, shift]))
        beta -= np.clip(step, -2, 2)
    return weights.reshape(KINDS, BUCKETS), float(beta[0]), float(beta[1])


Model = tuple[np.ndarray, float, float]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on the bounded sample, in one task; None without labels of both kinds."""
    known = labels.filter("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max("quality").alias("quality"), F.min("quality").alias("other")
    ).filter("quality = other").select("_id", "quality")
    order = F.xxhash64(F.lit(7), "_id")
    chosen = known.join(docs.select(F.col("doc_id").cast("long").alias("_id")).distinct(), "_id", "left_semi").orderBy(order, "_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(chosen), "_id")
    texts = texts.filter("text is not null").groupBy("_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_id")
        good = rows.column("quality").to_numpy() == 1
        ids = rows.column("_id").to_numpy().view(np.uint64)
        held_out = mix(ids) % np.uint64(4) == 0
        both = [good[~held_out], good[held_out]]
        if any(not len(g) or g.all() or not g.any() for g in both):
            return pa.table({"weights": pa.array([], pa.binary()), "slope": pa.array([], pa.float64()), "shift": pa.array([], pa.float64())})
        weights, slope, shift = fit(text_column(rows.column("text")), good, held_out)
        release()
        return pa.table({"weights": [weights.astype("<f4").tobytes()], "slope": [slope], "shift": [shift]})

    found = texts.withColumn("_one", F.lit(1)).groupBy("_one").applyInArrow(run, "weights binary, slope double, shift double").collect()
    if not found:
        return None
    return np.frombuffer(found[0].weights, "<f4").reshape(KINDS, BUCKETS), found[0].slope, found[0].shift


def judge(texts: pa.Array, model: Model | None) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts, base_failed, probability and kept of a batch."""
    m = measures(texts)
    failed = base_failed(m)
    if model is None:
        p = np.ones(len(texts))
    else:
        weights, slope, shift = model
        p = _sigmoid(slope * linear(texts, weights) + shift)
    return m, failed, p, ~failed & (p >= THRESHOLD)


def _over(docs: DataFrame, schema: str, body: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield body(batch.slice(at, ROWS))
        release()

    return docs.mapInArrow(run, schema)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed, probability, kept; one row per input row."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))  # weights: a fixed size

    def body(part: pa.RecordBatch) -> pa.RecordBatch:
        m, failed, p, kept = judge(text_column(part.column("text")), model.value)
        columns = [part.column("doc_id"), *[pa.array(x.astype(np.int64)) for x in m.values()], pa.array(failed), pa.array(p), pa.array(kept)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *m, "base_failed", "probability", "kept"])

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, probability double, kept boolean"
    )
    return _over(docs.select(F.col("doc_id").cast("long"), "text"), schema, body)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, columns as they came."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def body(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(judge(text_column(part.column("text")), model.value)[3]))

    return _over(docs, docs.schema, body)
