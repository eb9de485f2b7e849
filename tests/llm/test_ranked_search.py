import math
import re
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import ranked_search as rs

LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, c) for i, c in bags if c]
    n, total = len(bags), sum(c.total() for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in bags:
            m = 25 + 75 * c.total() * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i, score))
        out += [(item, r + 1, i, s) for r, (_, _, i, s) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1, "x", 7) for i, t in items], "item_id int, text string, doc_id int, term string, rank int")


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    names = [f"t{i}" for i in range(400)]
    weight = 1 / np.arange(1, 401)
    return [(int(i), " ".join(rng.choice(names, rng.integers(1, 60), p=weight / weight.sum()))) for i in range(n)]


@pytest.mark.parametrize("postings", [2**20, 700])
def test_equals_scoring_everything(spark, postings):
    docs = corpus(400, 1) + [(1000 + i, "t3 t3 T50, t50") for i in range(15)]
    items = [(i, t) for i, t in corpus(25, 2)] + [(90, "T50 t50 t3"), (91, "unknown words"), (92, None), (93, ""), (90, "T50 t50 t3"), (94, "t9")]
    df = rs.search(cases.frame(spark, docs), items_of(spark, items), shard_postings=postings)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(df) == plain(docs, items)


def test_odd_rows(spark):
    items = [(1, "quick brown word5 fox"), (2, "é ça 日本語 über"), (3, "x" * 100_000), (4, "row without id"), (5, "ÉÉ"), (6, "S I'll 12"), (None, "lazy dog")]
    assert got(rs.search(cases.frame(spark), items_of(spark, items))) == plain(cases.ODD, items)


def test_empty_tables(spark):
    some = items_of(spark, [(1, "one")])
    assert rs.search(cases.nothing(spark), some).count() == 0
    assert rs.search(cases.frame(spark), items_of(spark, [])).count() == 0
    assert rs.search(cases.frame(spark, [(1, None), (2, "")]), some).count() == 0


def shard_of(bags, n, total):
    flat = [t for c in bags for t in c]
    counts = np.array([c[t] for c in bags for t in c])
    return rs.Shard(list(range(len(bags))), np.array([c.total() for c in bags]), np.array([len(c) for c in bags]), pa.array(flat), counts, n, total)


def test_best_positions_stop_early_and_keep_ties():
    rng = np.random.default_rng(5)
    bags = [Counter({"rare": int(rng.integers(1, 30)), "other": int(rng.integers(1, 30))}) for _ in range(5000)]
    bags += [Counter({"rare": 40, "other": 40}) for _ in range(12)]
    bags = [c + Counter({"rest": 100 - c.total()}) for c in bags]
    shard = shard_of(bags, len(bags), sum(c.total() for c in bags))
    docs, scores, looked = shard.best(["rare", "other"], [5, 3], 10)
    assert docs == list(range(5000, 5010)) and len(set(scores)) == 1
    assert looked < 500
    # Everything ties: nothing may be skipped before the ids are compared.
    same = shard_of([Counter({"a": 1, "b": 2})] * 300, 300, 900)
    assert same.best(["a", "b"], [1, 1], 10)[0] == list(range(10))
