import math
import random
from collections import Counter, defaultdict

import pytest

from shelfwise.operators import similarity, text


def product_rows(seed, n=120):
    r = random.Random(seed)
    rare = [f"w{i}" for i in range(60)]
    common = ["a", "b", "c", "d"]
    rows = []
    for i in range(n):
        words = [w for w in common if r.random() < 0.5] + [r.choice(rare) for _ in range(r.randrange(0, 4))]
        if i % 3 == 0:
            words = ["a", "w1", "w2"]  # a third of the products are copies
        if i == 7:
            words = ["a", "a", "w3"]
        rows.append((i, "|".join(words) or "only"))
    return rows


def brute_force(rows, threshold):
    bags = {i: Counter(t.lower().replace("|", " ").split(" ")) for i, t in rows}
    df = Counter(w for bag in bags.values() for w in bag)
    m = len(rows)
    vec = {i: {w: n * math.log((m + 1) / (df[w] + 1)) for w, n in bag.items()} for i, bag in bags.items()}
    length = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in vec.items()}
    out = {}
    for i in vec:
        for j in vec:
            if i != j and length[i] and length[j]:
                s = sum(x * vec[j].get(w, 0.0) for w, x in vec[i].items()) / (length[i] * length[j])
                if s > threshold:
                    out[i, j] = s
    return out


@pytest.mark.parametrize("threshold", [0.1, 0.4, 0.8])
@pytest.mark.parametrize("chunk", [4, 2048])
def test_content_pairs_equal_brute_force(spark, monkeypatch, threshold, chunk):
    monkeypatch.setattr(similarity, "CHUNK", chunk)
    rows = product_rows(3)
    df = spark.createDataFrame(rows, "productId long, tags string")
    sim = similarity.content_similarity(df, threshold)
    found = similarity.to_pairs(sim).collect()
    got = {(r.productId, r.simProductId): r.score for r in found}
    expected = brute_force(rows, threshold)
    assert len(found) == len(got)
    assert set(got) == set(expected)
    assert all(got[p] == pytest.approx(expected[p]) for p in got)


@pytest.mark.parametrize("k", [1, 5, 50])
def test_top_similar_equals_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(similarity, "ID_BLOCK", 16)
    rows = product_rows(4)
    df = spark.createDataFrame(rows, "productId long, tags string")
    sim = similarity.content_similarity(df)
    lists = defaultdict(list)
    for r in similarity.top_similar(sim, df, k).orderBy("productId", "rank").collect():
        lists[r.productId].append(r.simProductId)
    expected = defaultdict(list)
    for (i, j), s in brute_force(rows, 0.4).items():
        expected[i].append((-round(s, 9), j))
    assert dict(lists) == {i: [j for _, j in sorted(v)[:k]] for i, v in expected.items()}


def test_many_ties_and_a_large_group_stay_narrow(spark):
    """Reads stay near k per group although every group ties and one holds a third of all items."""
    members = spark.range(300).selectExpr("id as productId", "if(id % 3 = 0, 0, id) as grp")
    groups = [r.grp for r in members.select("grp").distinct().collect()]
    rows = [(a, b, 0.75) for a in groups for b in groups if a != b] + [(0, 0, 1.0)]
    pairs = spark.createDataFrame(rows, "grp long, simGrp long, score double")
    sim = similarity.Similarity(members, pairs)
    k = 4
    lists = defaultdict(list)
    for r in similarity.top_similar(sim, members, k).orderBy("productId", "rank").collect():
        lists[r.productId].append(r.simProductId)
    group = {i: 0 if i % 3 == 0 else i for i in range(300)}
    for i in range(300):
        order = sorted((-(1.0 if group[i] == group[j] else 0.75), j) for j in range(300) if j != i)
        assert lists[i] == [j for _, j in order[:k]]
    asked = spark.createDataFrame([(g, g, k + 1) for g in groups], "owner long, grp long, need int")
    assert similarity.nearest(sim, asked, ["owner"], k + 1).count() <= len(groups) * (k + 1) * (k + 2) // 2


def test_plain_pairs_round_trip(spark):
    pairs = [(1, 2, 0.9), (2, 1, 0.9), (1, 3, 0.5), (3, 1, 0.5)]
    df = spark.createDataFrame(pairs, "productId long, simProductId long, score double")
    back = similarity.to_pairs(similarity.from_pairs(df)).collect()
    assert sorted(map(tuple, back)) == sorted(pairs)


def test_places_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(similarity, "ID_BLOCK", 8)
    members = spark.range(100).selectExpr("id * 3 as productId", "if(id % 3 = 0, 'hot', cast(id as string)) as grp")
    hot = similarity.ranked_members(members).where("grp = 'hot'").orderBy("productId").collect()
    assert [r.place for r in hot] == list(range(1, 35))
    assert [r.level for r in hot] == [int(math.log2(i)) for i in range(1, 35)]


def test_hashed_vectors_equal_exact_without_collision(spark):
    rows = [(1, "red|ring"), (2, "red|bolt"), (3, "blue|bolt")]
    df = spark.createDataFrame(rows, "productId long, tags string")
    exact = {}
    for r in text.tfidf(df).collect():
        exact.setdefault(r.productId, []).append(round(r.weight, 9))
    unit = {}
    for r in text.hashed_vectors(df, 2**12).collect():
        unit[r.grp] = sorted(round(e.w, 9) for e in r.entries)
    for product, weights in exact.items():
        length = math.sqrt(sum(w * w for w in weights))
        assert unit[product] == pytest.approx(sorted(w / length for w in weights), abs=1e-8)


def test_hashed_similarity_equals_exact_without_collision(spark):
    df = spark.createDataFrame(product_rows(5, 60), "productId long, tags string")
    exact = {tuple(r)[:2] for r in similarity.to_pairs(similarity.content_similarity(df)).collect()}
    hashed = {tuple(r)[:2] for r in similarity.to_pairs(similarity.hashed_content_similarity(df)).collect()}
    # 800 buckets may merge words; pairs of copies never change.
    assert {(i, j) for i, j in exact if i % 3 == 0 and j % 3 == 0} <= hashed
