"""Ranked search beside a plain scan of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from brightloom.llm import lexical

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, items, k=10):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total, df = len(bags), sum(b.total() for _, b in bags), Counter(g for _, b in bags for g in b)
    out = []
    for item, text in items:
        wanted, scores = TERM.findall((text or "").translate(LOWER)), []
        for i, b in bags:
            m = 100 - 75 + 75 * b.total() * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[g] + 1))) * (1000000000 * b[g] // (1000 * b[g] + 8 * m)) for g in wanted if b[g])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def _texts(n, seed, words):
    draw = random.Random(seed)
    pool = ["".join(draw.choices("aeinrstA1é", k=draw.randint(1, 5))) for _ in range(words)]
    return [" ".join(draw.choices(pool, weights=[1 / (j + 1) for j in range(words)], k=draw.randint(0, 60))) + draw.choice(["", ".", "\n"]) for _ in range(n)]


@pytest.mark.parametrize("rows,together,split", [(2048, 4096, 8), (16, 64, 1), (7, 5, 3)])
def test_beside_a_scan(spark, monkeypatch, rows, together, split):
    # workers see module values of their own: the search is driven here without Spark
    monkeypatch.setattr(lexical, "SPLIT", split)
    monkeypatch.setattr(lexical, "TOGETHER", together)
    docs = list(enumerate(_texts(300, 1, 80)))
    docs += [(1000 + i, docs[5][1]) for i in range(40)]  # copies tie
    items = list(enumerate(_texts(12, 2, 80) + [docs[5][1], "", docs[7][1] * 2]))
    random.Random(3).shuffle(docs)
    assert _local(docs, items, rows) == brute(docs, items)


def _local(docs, items, rows, k=10):
    """The same steps as the tasks take, over blocks of the given number of rows."""
    import pyarrow as pa

    from brightloom.llm.words import text_column

    n = sum(bool(TERM.search(t or "")) for _, t in docs)
    total = sum(len(TERM.findall(t or "")) for _, t in docs)
    owner, codes, names = lexical.term_codes(text_column(pa.array([t for _, t in items], pa.string())))
    vocab, df, blocks = names.to_pylist(), Counter(), []
    for at in range(0, len(docs), rows):
        part = sorted(docs[at : at + rows])
        bags = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in part]
        df.update(g for b in bags for g in b)
        blocks.append(([i for i, _ in part], bags))
    best = lexical.Best(len(items), k)
    bags = [Counter(codes[owner == i].tolist()) for i in range(len(items))]
    for ids, docs_in in blocks:
        lists = [[(d, b[g]) for d, b in enumerate(docs_in) if b[g]] for g in vocab]
        begins = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        doc = np.array([d for x in lists for d, _ in x], np.int64)
        tf = np.array([c for x in lists for _, c in x], np.int64)
        m = 25 + 75 * np.array([b.total() for b in docs_in]) * n // total
        held = lexical.Lists(doc, 1_000_000_000 * tf // (1000 * tf + 8 * m[doc]), np.append(begins, begins[-1]), len(ids))
        pairs = [(np.array(sorted(b), np.int64), np.array([b[c] * lexical.weight(n, df[vocab[c]]) for c in sorted(b)], np.int64)) for b in bags]
        for group in lexical._groups(pairs):
            width = max(len(pairs[g][0]) for g in group)
            terms, factor = np.full((len(group), width), len(vocab)), np.zeros((len(group), width), np.int64)
            for j, g in enumerate(group):
                terms[j, : len(pairs[g][0])], factor[j, : len(pairs[g][0])] = pairs[g]
            lexical.search_lists(held, np.array(ids), np.array(group), terms, factor, best)
    order = np.lexsort((best.doc, -best.score, best.item))
    rank = Counter()
    out = []
    for i in order.tolist():
        rank[best.item[i]] += 1
        out.append((items[best.item[i]][0], rank[best.item[i]], int(best.doc[i]), int(best.score[i])))
    return sorted(out, key=str)


def test_range_maxima():
    draw = random.Random(5)
    begins = np.array([0, 9, 9, 20, 20])
    doc = np.concatenate([np.sort(draw.sample(range(30), n)) for n in (9, 11)])
    gain = np.array(draw.choices(range(5), k=20))
    lists = lexical.Lists(doc, gain, begins, 30)
    for a, b in [(a, b) for s, e in ((0, 9), (9, 20)) for a in range(s, e) for b in range(a, e + 1)]:
        place, top = lists.highest(np.array([[a]]), np.array([[b]]))
        assert top[0, 0] == (max(gain[a:b]) if b > a else 0)
        assert a == b or a <= place[0, 0] < b and gain[place[0, 0]] == top[0, 0]


def test_few_documents_are_scored():
    """Intervals that cannot win are never split."""
    n = 5000
    gain = np.full(n, 10)
    gain[::500] = 1000
    lists = lexical.Lists(np.arange(n), gain, np.array([0, n, n]), n)
    best = lexical.Best(1, 10)
    scored = lexical.search_lists(lists, np.arange(n), np.array([0]), np.array([[0]]), np.array([[1]]), best)
    assert best.doc.tolist() == list(range(0, n, 500)) and scored < 60


def test_rows_of_all_kinds(spark):
    texts = [None, "", "...", "Cat dog", "cat dog", "cat", "dog dog dog", "é É", "x" * 40_000 + " cat", "cat dog"]
    docs = [(i if i != 4 else None, t) for i, t in enumerate(texts)]
    items = [(0, "CAT dog cat"), (None, "dog"), (2, None), (3, "é"), (4, "none of these"), (0, "CAT dog cat")]
    wide = spark.createDataFrame([(i, t, 1, "x", 0) for i, t in docs], "doc_id long, text string, block long, terms string, rank int")
    asked = spark.createDataFrame([(i, t, 1.0, "y") for i, t in items], "item_id int, text string, score double, item string")
    got = sorted(map(tuple, lexical.search(wide, asked, 3).collect()), key=str)
    assert got == brute(docs, items, 3)


def test_items_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK_ITEMS", 2)
    docs, items = list(enumerate(_texts(60, 8, 30))), list(enumerate(_texts(5, 9, 30)))
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "cat")], "doc_id long, text string")
    assert lexical.search(none, some.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert lexical.search(some, none.withColumnRenamed("doc_id", "item_id")).count() == 0
    blank = spark.createDataFrame([(1, "..."), (2, None)], "doc_id long, text string")
    assert lexical.search(blank, some.withColumnRenamed("doc_id", "item_id")).count() == 0
