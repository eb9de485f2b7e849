import random

import cases
import numpy as np
import pytest

from shelfwise.llm import minhash
from shelfwise.llm.graph import components


def as_map(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None}


def variants(n, seed, n_words=80, edits=6):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(n_words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(n_words)] = f"e{rng.randrange(5000)}"
        out.append(" ".join(text))
    return out


def test_classes_equal_all_pairs(spark):
    texts = [*variants(60, 1), *variants(40, 2, 30, 3), *variants(30, 3, 12, 3), "a b c", "A b C", "a b", None, ""]
    pairs = list(enumerate(texts))
    got = minhash.classes(cases.frame(spark, pairs))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert as_map(got) == cases.near_classes(pairs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_blocks_give_the_same_classes(spark, monkeypatch):
    pairs = list(enumerate(variants(90, 5)))
    monkeypatch.setattr(minhash.likely_links, "__defaults__", (80, 16))
    monkeypatch.setattr(minhash.confirmed_links, "__defaults__", (4, 80, 1000))
    assert as_map(minhash.classes(cases.frame(spark, pairs))) == cases.near_classes(pairs)


def test_odd_rows(spark):
    got = minhash.classes(cases.frame(spark)).collect()
    assert len(got) == len(cases.ODD)
    wanted = cases.near_classes([p for p in cases.ODD if p[0] is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id} == wanted
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    left = minhash.without_copies(cases.frame(spark))
    assert left.columns == cases.frame(spark).columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == sorted({i or 0 for i, _ in cases.ODD} - {2, 7})


def test_empty_table(spark):
    assert minhash.classes(cases.nothing(spark)).count() == 0
    assert minhash.without_copies(cases.nothing(spark)).count() == 0


def test_estimate_corrects_for_chance():
    rng = np.random.default_rng(0)
    one = [minhash.packed(minhash.minima(rng.integers(0, 2**63, 400).astype(np.uint64))) for _ in range(30)]
    apart = minhash.estimate(one[0], np.array(one[1:]))
    assert abs(apart.mean()) < 0.03
    assert minhash.estimate(one[0], np.array(one[:1]))[0] == 1
    shared = rng.integers(0, 2**63, 900).astype(np.uint64)
    a, b = shared[:850], shared[50:]
    got = minhash.estimate(minhash.packed(minhash.minima(a)), minhash.packed(minhash.minima(b))[None])[0]
    assert got == pytest.approx(800 / 900, abs=0.12)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (20, 21), (21, 22), (7, 7), *[(100, 100 + i) for i in range(1, 40)], *[(200 + i, 201 + i) for i in range(30)]]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    wanted = {1: 1, 2: 1, 3: 1, 9: 1, 20: 20, 21: 20, 22: 20, **{100 + i: 100 for i in range(40)}, **{200 + i: 200 for i in range(31)}}
    assert got == wanted
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
