import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brightloom.llm import packing, simple8b
from brightloom.llm.queries import vocabulary
from brightloom.llm.tokens import Encoder

SCHEMA = "doc_id long, text string, sequence_id long, shard long"
ODD = ["", None, " \n ", "a", "It's, the.End of—l'été, ß,. 12,5", "x" * 3000, "<|endoftext|> The End, <|ENDOFTEXT|>", "word " * 5000, "Ünï\u0301,code\u00a0x\u2003y"]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aBzÉéß,.'s <|endoftxt>\n\t12—ıİǅ\u0301\u1e9e", max_size=40), min_size=1, max_size=5))
def test_ids_by_word_are_those_of_the_tokenizer(texts):
    encoder = Encoder.of(vocabulary())
    ids, upto = encoder.encode(pa.array(texts, pa.large_string()))
    assert [ids[a:b].tolist() for a, b in zip(upto[:-1], upto[1:])] == [encoder.model.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 3) | st.just(0), max_size=3000))
def test_words_decode_to_the_values(values):
    v = np.array(values, np.uint64)
    ids, per_doc = simple8b.from_payload(simple8b.to_payload(v, np.array([len(v)])))
    assert ids.tolist() == values and per_doc.tolist() == [len(values)]


def test_zeros_take_the_long_runs():
    assert len(simple8b.code(np.zeros(1024))[0]) == 5


def docs(spark):
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice(["the", "of", "Zebra,", "qu", "12"]) for _ in range(rng.randrange(2500))) for _ in range(25)]
    rows = [(i * 7 % 101, t, 1, 2) for i, t in enumerate(texts)] + [(None, "null id", 1, 2), (5, "again", 1, 2), (5, "again", 1, 2)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_files_beside_brute_force(spark):
    rows, df = docs(spark)
    model = Encoder.of(vocabulary()).model
    want, before = [], 0
    for doc, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc, before, len(ids), crc(ids)))
        before += len(ids)
    got = [tuple(r)[:4] for r in simple8b.round_trip(df, vocabulary()).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simple8b.round_trip(df.limit(0), vocabulary()).count() == 0


def test_starts_follow_over_many_shards(spark):
    # 453, 115689 and 192673 ids have count bytes that open a sequence in UTF-8
    sizes = [453, 115689, 192673, 197, 50000, 1, 70000, 453] * 2
    df = spark.createDataFrame([(i, "the " * (n - 1)) for i, n in enumerate(sizes)], "doc_id long, text string")
    model = Encoder.of(vocabulary()).model
    tokens = {n: len(model.encode("the " * (n - 1), add_special_tokens=False).ids) + 1 for n in set(sizes)}
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        folder = f"{simple8b.shared_dir(spark)}/ids-many-shards-{random.randrange(2**60)}"
        simple8b.write(df, vocabulary(), folder)
        shards = spark.read.parquet(folder).select("shard").distinct().count()
        got = sorted(tuple(r)[:3] for r in simple8b.read(spark, folder).collect())
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    want, before = [], 0
    for i, n in enumerate(sizes):
        want.append((i, before, tokens[n]))
        before += tokens[n]
    assert shards > 4 and {453, 115689, 192673} <= set(tokens.values())
    assert got == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=80), st.integers(64, 100))
def test_windows_hold_their_capacity(sizes, capacity):
    sizes = np.array(sizes)
    window, offset = packing.pack_group(sizes, capacity)
    held = np.bincount(window, weights=sizes)
    assert held.max() <= capacity
    taken = sorted((w, o, o + s) for w, o, s in zip(window, offset, sizes))
    for (w, _, end), (x, begin, _) in zip(taken, taken[1:]):
        assert begin == (end if w == x else 0)


def test_differencing_is_near_equal():
    rng = np.random.default_rng(2)
    held = np.bincount(packing.difference(sizes := rng.integers(1, 1000, 400), 40), weights=sizes)
    assert held.max() - held.min() < 100


def test_packing_loses_no_id(spark):
    rows, df = docs(spark)
    model = Encoder.of(vocabulary()).model
    packed = packing.pack(df, vocabulary(), with_ids=True)
    pieces = packed.collect()
    want = sorted(([*model.encode(t or "", add_special_tokens=False).ids, 1] for _, t, *_ in rows), key=repr)
    assert sum(p["length"] for p in pieces) == sum(map(len, want))
    assert all(p.ids_crc32 == zlib.crc32(p.ids) and len(p.ids) == 4 * p["length"] for p in pieces)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    own = sorted(by_doc[14], key=lambda p: p.start)
    text = next(t for d, t, *_ in rows if d == 14)
    assert np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist() == [*model.encode(text or "", add_special_tokens=False).ids, 1]
    full = packing.sequences(packed).collect()
    assert max(s.n_tokens for s in full) <= 2048 and sum(s.n_tokens for s in full) == sum(map(len, want))
    assert all(len(s.ids) == 4 * s.n_tokens for s in full)
    assert packing.pack(df.limit(0), vocabulary()).count() == 0


def test_words_of_letters_are_cut_by_their_ends(monkeypatch):
    """Words of letters need no word between them, also beside ones that fall into several pieces."""
    from brightloom.llm import tokens
    from brightloom.llm.queries import vocabulary

    encoder = tokens.Encoder(vocabulary())
    words = ["été", "word", "İstanbul", "ǅ", "日本語", "한국어", "ﬀ", "a", "don", "x1", "it's", "a|b", "—", "ª", "ｗｉｄｅ", "क्षि", "Ω"] + [f"q{'z' * n}e" for n in range(40)]
    seen, keep = [], tokens.Encoder._plain
    monkeypatch.setattr(tokens, "JOINED", 5)
    monkeypatch.setattr(tokens.Encoder, "_plain", lambda self, texts: seen.extend(texts) or keep(self, texts))
    got = encoder._words(words)
    alone = [encoder.model.encode(w, add_special_tokens=False).ids for w in words]
    assert [np.frombuffer(x, np.uint32).tolist() for x in got] == alone
    out = [None] * len(words)
    encoder._letters(words, out)
    assert sum(x is not None for x in out) >= 40 and "a|b" in seen
    assert all(x is None or np.frombuffer(x, np.uint32).tolist() == ids for x, ids in zip(out, alone))
