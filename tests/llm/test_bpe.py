"""Trie BPE beside the public library, which works word by word and merge by merge."""

import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from brightloom.llm import bpe
from brightloom.llm.queries import BYTE_VOCABULARY, QUERIES, vocabulary

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))


@pytest.fixture(scope="module")
def ours():
    return bpe.Bpe.of(vocabulary(BYTE_VOCABULARY))


def _same(ours, library, texts):
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4") for t in texts]
    got = ours.encode(pa.array(texts, pa.large_string()))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.tolist() for w in want]
    assert [bpe.text_of(g, ours.pieces) for g in got] == [library.decode(w.tolist(), skip_special_tokens=False) for w in want]


def test_trie_shares_prefixes():
    assert list(bpe.trie([b"abd", b"b", b"abc", b"a"])) == [(b"a", 0), (b"abc", 1), (b"abd", 2), (b"b", 0)]


def test_each_shared_prefix_is_walked_once(ours, monkeypatch):
    words = [b" understand", b" understanding", b" understandings", b" under"]
    fresh = {}
    for word, depth in bpe.trie(words):
        fresh[word] = len(word) - depth
    assert sum(fresh.values()) == len(b" understandings")
    assert len(dict(ours.encode_words(words))) == 4


def test_words_of_any_kind(ours, library):
    random.seed(3)
    parts = ["a", "b", "ing", "the", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "1", "23", "é", "漢", "😀", "<|endoftext|>", "<|", "-", "----", "\x00", "\x1c", "\x85", " ", "Z"]
    _same(ours, library, ["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(2000)])
    _same(ours, library, [c * k for c in "a -=.\n0_" for k in (1, 2, 3, 7, 40, 129, 1000)])


def test_any_characters(ours, library):
    random.seed(4)
    draw = lambda: chr(random.choice([random.randint(32, 126), random.randint(32, 0x2FF), random.randint(32, 0xD7FF), random.randint(0x10000, 0x2FFFF)]))
    _same(ours, library, ["".join(draw() for _ in range(random.randint(0, 30))) for _ in range(2000)])


def test_one_word_of_many_bytes(ours, library):
    random.seed(5)
    _same(ours, library, ["".join(random.choices("abcdeé", k=30_000)), "x" * 50_000])


def test_nothing_is_forgotten_wrongly(library, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCHES", 40)
    monkeypatch.setattr(bpe, "PAIRS", 10)
    small, draw = bpe.Bpe(vocabulary(BYTE_VOCABULARY)), random.Random(6)
    for _ in range(20):
        _same(small, library, [" ".join("".join(draw.choices("aeinrst", k=draw.randint(1, 6))) for _ in range(30))])


def test_query_on_rows_of_all_kinds(spark, tmp_path, library):
    texts = [None, "", "A cat.", "A cat.", " two  blanks ", "long " * 4000, "<|endoftext|>x"]
    rows = [(i if i != 2 else None, t, "s", 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens long, bpe string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, QUERIES["op13_trie_bpe"](spark, str(tmp_path)).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op13_trie_bpe"](spark, str(tmp_path)).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Bpe(vocabulary("word_bpe_49k.json"))
