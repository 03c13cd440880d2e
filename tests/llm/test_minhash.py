import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brightloom.llm import minhash
from brightloom.llm.minhash import Scheme, components, keep_one, near_duplicates
from brightloom.llm.words import shingle_sets
from tests.llm import brute

SCHEME = Scheme(3, 85, 6, 32)
SCHEMA = "doc_id long, text string"


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abAB \t\n\x0b\x1c\x85  éÉ", max_size=30), max_size=6), st.integers(1, 5))
def test_window_sets_are_those_of_the_rule(texts, width):
    got = shingle_sets(pa.array(texts, pa.large_string()), width)
    assert [len(s) for s in got] == [len(brute.shingles(t, width)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (got[i].tolist() == got[j].tolist()) == (brute.shingles(a, width) == brute.shingles(b, width))


def family(rng, n, size, changes):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(changes + 1)):
            w[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_components_beside_all_pairs(spark):
    rng = random.Random(3)
    texts = []
    for size in (4, 30, 120, 400):
        texts += family(rng, 25, size, max(2, size // 12))
    texts += [texts[5]] * 30 + [re.sub("w", "W", texts[60]), None, "", " \n", "one", "one", "one two"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    want = sorted(brute.near_components(rows, 3, 85), key=repr)
    assert result(near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), SCHEME)) == want


@pytest.mark.parametrize("passes", [("rest",), ("leader", "forest", "rest"), ("leader", "again", "forest", "rest")])
def test_blocks_find_what_leaders_miss(spark, monkeypatch, passes):
    monkeypatch.setattr(minhash, "PASSES", passes)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(5)
    rows = list(enumerate(family(rng, 80, 200, 14)))
    want = sorted(brute.near_components(rows, 3, 85), key=repr)
    assert len({w[2] for w in want}) > 5
    assert result(near_duplicates(spark.createDataFrame(rows, SCHEMA), SCHEME)) == want


def test_blocks_of_a_large_component_meet_only_the_others(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = [(b, b * 1000 + i, b * 1000 if i < top else b * 1000 + i) for b, n, top in ((1, 6, 3), (2, 100, 90), (3, 40, 1)) for i in range(n)]
    held = minhash._open_buckets(spark.createDataFrame(rows + [(4, 1, 1), (4, 2, 1)], "bucket long, cid long, root long"))
    cells = {}
    for r in minhash._cells(held).collect():
        cells.setdefault((r.bucket, r.cell), []).append(r)
    met = set()
    for cell in cells.values():
        for i, a in enumerate(cell):
            for b in cell[i + 1 :]:
                if a.root != b.root and (a.side == b.side == 2 or {a.side, b.side} == {0, 1}):
                    assert (pair := frozenset((a.cid, b.cid))) not in met
                    met.add(pair)
    want = {frozenset((a[1], b[1])) for a in rows for b in rows if a[0] == b[0] and a[2] != b[2]}
    assert met == want
    # 90 of one component stand in the two blocks of the ten others, these in two and twelve
    assert sum(len(c) for (b, _), c in cells.items() if b == 2) == 90 * 2 + 10 * 14


def test_bands_that_agree_in_low_bytes_only_hide_no_link(spark, monkeypatch):
    # 0 and 896 agree in band 3 by low bytes alone; in each band they share, another text meets them
    def text(seed, changed):
        gone = set(random.Random(seed).sample(range(120), changed))
        return " ".join(f"x{seed}_{i}" if i in gone else f"w{i}" for i in range(120))

    scheme = Scheme(1, 85, 6, 32)
    rows = [(0, text(0, 0)), (896, text(896, 9)), *((i, text(i, 30)) for i in (10005, 10006, 10017, 10102, 10255))]
    m = [minhash.signature(s, scheme) for s in shingle_sets(pa.array([t for _, t in rows], pa.large_string()), 1)]
    low = [x.astype("uint8").reshape(32, 6) for x in m]
    assert (low[0] == low[1]).all(axis=1).argmax() < (minhash.band_keys(m[0], scheme) == minhash.band_keys(m[1], scheme)).argmax()
    monkeypatch.setattr(minhash, "PASSES", ("rest",))
    want = sorted(brute.near_components(rows, 1, 85), key=repr)
    assert len({w[2] for w in want}) == 6
    assert result(near_duplicates(spark.createDataFrame(rows, SCHEMA), scheme)) == want


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i * 7919 % 200, (i + 1) * 7919 % 200) for i in range(150)], "u long, v long")
    found = components(links).collect()
    assert len(found) == 151 and {r.root for r in found} == {min(r.node for r in found)}


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    text = "a b c d e f g h i j k l m n o p"
    rows = [(None, text, 1), (4, text, 2), (4, text, 2), (2, text.upper(), 3), (7, None, 4), (None, None, 5), (8, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component long")
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == {(None, 2, False), (4, 2, False), (2, 2, True), (7, 7, True), (None, None, True), (8, 8, True)}
    kept = sorted(((r.doc_id, r.text, r.component) for r in keep_one(docs).collect()), key=repr)
    assert kept == sorted([(2, text.upper(), 3), (7, None, 4), (None, None, 5), (8, "", 6)], key=repr)
    assert near_duplicates(docs.limit(0)).count() == 0 and keep_one(docs.limit(0)).columns == docs.columns


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "x y z u v w")] * 5 + [(2, "x y z u v w")], SCHEMA)
    assert [r.doc_id for r in keep_one(docs).collect()] == [1]


def test_whole_rows_are_shuffled_once_to_keep_one(spark):
    """One copy of a row stays whatever its doc_id; blank rows all stay, repeated ones too."""
    text = "a b c d e f g h"
    rows = [(None, text, "x")] * 3 + [(5, "other words stand in this text", "y"), (5, "other words stand in this text", "z")]
    blank = [(None, None, "n"), (None, None, "n"), (7, "", "e"), (7, " \t\x0b\r", "w"), (7, " \t\x0b\r", "w")]
    edges = [(8, "\x1c", "s"), (9, "\xa0", "s"), (9, "\xa0", "s")]  # words, though Unicode calls them space
    docs = spark.createDataFrame(rows + blank + edges, "doc_id long, text string, source string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        out = keep_one(docs)
        got = sorted((tuple(r) for r in out.collect()), key=repr)
        plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple").split("Initial Plan")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert [r for r in got if r[0] != 5] == sorted([rows[0], *blank, *edges[:2]], key=repr)
    assert len([r for r in got if r[0] == 5]) == 1
    moved = re.findall(r"Exchange hashpartitioning[^\n]*\n([^\n]*)", plan)
    assert len([m for m in moved if "text#" in re.sub(r"xxhash64\([^)]*\)", "", m)]) == 1, plan
