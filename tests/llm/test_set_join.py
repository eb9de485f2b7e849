import random

import cases
import numpy as np
import pyarrow as pa
import pytest

from shelfwise import session
from shelfwise.llm import minhash, set_join


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


def chain(n, seed, n_words=60):
    """Each text changes the one before it: the ends have nothing in common but are one class."""
    rng = random.Random(seed)
    text = [f"c{rng.randrange(10**6)}" for _ in range(n_words)]
    out = []
    for i in range(n):
        out.append(" ".join(text))
        text[i % n_words] = f"c{rng.randrange(10**6)}"
    return out


def with_passage(n, seed, passage=50, own=70):
    rng = random.Random(seed)
    shared = " ".join(f"p{i}" for i in range(passage))
    return [" ".join(f"o{rng.randrange(10**6)}" for _ in range(own)) + " " + shared for _ in range(n)]


def as_map(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None}


MIXED = [*variants(50, 1), *chain(40, 2), *with_passage(40, 3), *with_passage(30, 5, 200, 14), *variants(30, 4, 500, 40), "a b c d", "A b C d", "a b", None, "", *variants(25, 6, 9, 3)]


@pytest.mark.parametrize("limits", [{}, {"small": 100, "token_bits": 5, "chunk": 1500}])
def test_classes_equal_all_pairs(spark, limits):
    texts = list(MIXED)
    random.Random(9).shuffle(texts)
    pairs = list(enumerate(texts))
    got = set_join.classes(cases.frame(spark, pairs), **limits)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert as_map(got) == cases.near_classes(pairs, 5)


def test_odd_rows(spark):
    got = set_join.classes(cases.frame(spark)).collect()
    assert len(got) == len(cases.ODD)
    wanted = cases.near_classes([p for p in cases.ODD if p[0] is not None], 5)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id} == wanted
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_an_id_with_several_texts_links_through_each(spark):
    one, two = "a b c d e f g h", "q r s t u v w x"
    got = set_join.classes(cases.frame(spark, [(5, one), (5, two), (3, one), (9, two), (12, "other words than these are")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (5, 3), (5, 3), (9, 3), (12, 12)]


def test_empty_table(spark):
    assert set_join.classes(cases.nothing(spark)).count() == 0
    assert set_join.classes(cases.frame(spark, [(1, None), (2, "")])).count() == 2


def sketch_index(texts, class_of=None):
    low = lambda t: t[(t >= 0) & (t < 2**62)]
    sets = [minhash.shingles(t, 5).view(np.int64) for t in texts]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(sets)), pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array(class_of or range(len(sets)), pa.int64()),
         pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))],
        names=["node", "size", "class", "tokens"],
    )
    return set_join._Index([batch], low), batch, low


def test_bound_opens_only_groups_that_may_hold_a_partner():
    """Members with one long passage and little of their own look alike to a look-up, not to the bound on sizes."""
    members = with_passage(20, 7, 60, 16)
    index, batch, low = sketch_index(members)
    assert index.pairs(batch, 80, 256, low).num_rows == 0
    near = variants(12, 8)
    index, batch, low = sketch_index(near)
    found = index.pairs(batch, 80, 256, low)
    wanted = {(a, b) for a in range(12) for b in range(12) if a != b and cases.near_classes([(0, near[a]), (1, near[b])], 5)[1][1] == 0}
    got = set(zip(found["q"].to_pylist(), found["s"].to_pylist()))
    assert {frozenset(p) for p in wanted if len(set(near[i] for i in p)) == 2} <= {frozenset(p) for p in got}


def test_group_of_copies_is_not_compared_pair_by_pair(spark):
    """After the kin step one class holds nearly all near copies, so few pairs are left to verify."""
    pairs = list(enumerate(variants(300, 11, 200, 3)))
    docs = cases.frame(spark, pairs)
    slim = docs.select("doc_id", "text")
    rows = set_join.sketches(slim, 5, 256, 2).where("set_id IS NOT NULL").dropDuplicates(["set_id"])
    nodes = rows.selectExpr("doc_id AS node", "n_shingles AS size", "low", "high").persist()
    links = set_join.kin_links(slim, nodes, 5, 80, 3000)
    assert len(links) > 1
    named = set_join._named(nodes, links)
    sizes = sorted((r["count"] for r in named.groupBy("class").count().collect()), reverse=True)
    assert sizes[0] > 0.95 * sum(sizes)
    nodes.unpersist()


def test_edited_copies_meet_their_leader(spark, monkeypatch):
    """Copies that were each edited elsewhere are like the text that they were made from, hardly like one another."""
    rng = random.Random(3)
    base = [f"b{rng.randrange(10**6)}" for _ in range(150)]
    texts = [" ".join(base)]
    for _ in range(150):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(150)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rng.shuffle(texts)
    pairs = list(enumerate(texts))
    seen = []
    verified = set_join.verified

    def counted(docs, pairs, *rest):
        seen.append(pairs.count())
        return verified(docs, pairs, *rest)

    monkeypatch.setattr(set_join, "verified", counted)
    got = as_map(set_join.classes(cases.frame(spark, pairs), chunk=4000))
    assert got == cases.near_classes(pairs, 5)
    assert sum(seen) < 4 * len(texts)


def test_tables_of_tokens_are_removed(spark):
    """Sketches, nodes, the matrix and full sets hold the corpus several times; the result reads none of them."""
    before = set(session._runs)
    got = set_join.classes(cases.frame(spark, list(enumerate(MIXED))))
    left = {run.rpartition("/")[2].rpartition("-")[0] for run in set(session._runs) - before}
    assert left.isdisjoint({"set-sketches", "set-nodes", "shared-tokens", "matrix", "pair-sets"})
    assert {"set-rows", "set-names"} <= left
    assert got.count() == len(MIXED)


def test_matrix_holds_only_the_rarest_tokens_of_a_node(spark):
    """Texts with one long passage and words of their own are found by their rarest shingles, not by each of the passage."""
    docs = cases.frame(spark, list(enumerate(with_passage(40, 3, 60, 8))))
    rows = set_join.sketches(docs.select("doc_id", "text"), 5, 256, 2)
    nodes = rows.selectExpr("doc_id AS node", "n_shingles AS size", "tokens", "size(tokens) AS n_usable")
    ranked = set_join.ranked_tokens(nodes, 80, 256, 2).collect()
    size = ranked[0]["size"]
    assert len(ranked) == 40 * 56  # the shingles within the passage
    held = [r for r in ranked if r["holds"]]
    assert len(held) == 40 * (size // 5 + 1 - (size - 56))
    assert len({r["token"] for r in held}) == len(held) // 40
    assert {r["token"] for r in ranked if r["asks"]} <= {r["token"] for r in held}


def nearly_alike(n, seed, n_words=400, edits=22):
    """Variants with edits from a small store, so that few shingles are one text's own and hardly any two texts link."""
    rng = random.Random(seed)
    base = [f"n{rng.randrange(10**6)}" for _ in range(n_words)]
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(0, n_words, 10), edits):
            words[at] = "an edit"
        out.append(" ".join(words))
    return out


def test_rows_do_not_grow_with_the_pairs_of_a_group(spark, monkeypatch):
    """Tokens of large sets leave most pairs of such a group open; they are settled in the group's task, not as rows."""
    largest = []
    stored = set_join.stored

    def counted(df, purpose):
        made = stored(df, purpose)
        if "token" not in made.columns:
            largest.append(made.count())
        return made

    monkeypatch.setattr(set_join, "stored", counted)
    pairs = list(enumerate([*nearly_alike(120, 5), *chain(20, 6, 400)]))
    random.Random(4).shuffle(pairs)
    got = as_map(set_join.classes(cases.frame(spark, pairs)))
    assert got == cases.near_classes(pairs, 5)
    assert len({c for _, c in got.values()}) > 60
    assert max(largest) <= 5 * len(pairs)


def test_links_that_connect_no_classes_stay_in_the_task(spark):
    """A chain's links join its texts once; queries in several pieces meet the same members."""
    docs = cases.frame(spark, list(enumerate(variants(60, 8, 80, 6))))
    rows = set_join.sketches(docs.select("doc_id", "text"), 5, 256, 2)
    nodes = rows.dropDuplicates(["set_id"]).selectExpr("doc_id AS node", "n_shingles AS size", "tokens")
    groups = nodes.selectExpr("node", "size", "size AS reach", "node AS class", "1L AS group")
    asked = groups.select("node", "group")
    texts = dict(enumerate(variants(60, 8, 80, 6)))
    kept = [r.node for r in nodes.select("node").collect()]
    wanted = cases.near_classes([(i, texts[i]) for i in kept], 5)
    found = set_join.opened(nodes, groups, asked, 80, 256, 2).collect()
    assert all(r.other is not None for r in found) and len(found) < len(kept)
    assert len(found) == len(kept) - len({c for _, c in wanted.values()})
    dealt = set_join._dealt(groups, asked, 80, 16).groupBy("piece", "is_query").count().collect()
    assert {r["count"] for r in dealt if not r.is_query} == {len(kept)}
    assert sum(r["count"] for r in dealt if r.is_query) == len(kept)
    assert len([r for r in dealt if not r.is_query]) == -(-len(kept) // 16)


def test_nodes_without_kin_are_looked_up_by_group(spark, monkeypatch):
    """A token of many such nodes has a matrix row for each of their few groups, not for each node."""
    seen = {}
    stored = set_join.stored

    def kept(df, purpose):
        made = stored(df, purpose)
        if purpose == "matrix":
            seen["most"] = made.groupBy("token").count().agg({"count": "max"}).first()[0]
        if purpose == "set-groups":
            alone = made.groupBy("class").count().where("count = 1").join(made, "class")
            seen["alone"], seen["groups"] = alone.count(), made.select("group").distinct().count()
        return made

    monkeypatch.setattr(set_join, "stored", kept)
    pairs = list(enumerate(nearly_alike(150, 7)))
    assert as_map(set_join.classes(cases.frame(spark, pairs))) == cases.near_classes(pairs, 5)
    assert seen["alone"] > 4 * seen["groups"]
    assert seen["most"] <= seen["groups"]


def edited_apart(n, seed, n_words=700):
    """Variants that are each edited elsewhere with words of their own: too many edits to link, few among the shingles of a sketch."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10**6)}" for _ in range(n_words)]
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(0, n_words, 7), 26):
            words[at] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_rows_of_the_look_up_grow_with_the_nodes(spark, monkeypatch):
    """Full sets show that most texts with one passage link to none; the others meet those from one source in few groups, not bucket by bucket."""
    made = []
    candidates = set_join.candidates

    def counted(lookups, tokens, groups, percent):
        of = groups.where(set_join.F.col("reach") * 100 >= set_join.F.col("size") * percent).select("node", "size", "family")
        held = tokens.select("node", "size", "token").join(of, ["node", "size"]).select("token", "family").distinct()
        made.append(lookups.select("node", "token").join(held, "token").count())
        return candidates(lookups, tokens, groups, percent)

    monkeypatch.setattr(set_join, "candidates", counted)
    rows = []
    for n in (60, 240):
        made.clear()
        # One linked text apart from the others, and some that differ in more or fewer words of a small store.
        texts = [*edited_apart(n, 3), *nearly_alike(n // 2, 5, 700, 24)]
        pairs = list(enumerate([*texts, *(" ".join(t.split()[:-2]) for t in texts[:: n // 10])]))
        random.Random(4).shuffle(pairs)
        assert as_map(set_join.classes(cases.frame(spark, pairs))) == cases.near_classes(pairs, 5)
        rows.append(sum(made))
    assert rows[1] <= 4 * rows[0], rows


def test_shingles_alone_in_the_crowd(spark):
    """An id with two texts of one size has none, since they are not told apart; repeated rows hide none."""
    shared = " ".join(f"s{i}" for i in range(20))
    texts = [(1, f"{shared} a b"), (2, f"{shared} c"), (2, f"{shared} c"), (3, f"{shared} d e f"), (3, f"{shared} g h i"), (4, "x y z u v w")]
    docs = cases.frame(spark, texts).select("doc_id", "text")
    nodes = spark.createDataFrame([(i, len(set(minhash.shingles(t, 5).tolist()))) for i, t in texts if i < 4], "node bigint, size int").distinct()
    found = set_join.alone_by_full_sets(docs, nodes, 5)
    assert sorted((r.node, r.size, r.alone) for r in found.collect()) == [(1, 18, 2), (2, 17, 1), (3, 19, 0)]


def test_crowd_holds_the_wide_nodes_and_all_they_may_find(spark):
    docs = cases.frame(spark, list(enumerate(MIXED)))
    rows = set_join.sketches(docs.select("doc_id", "text"), 5, 256, 2).where("set_id IS NOT NULL").dropDuplicates(["set_id"])
    nodes = rows.selectExpr("doc_id AS node", "n_shingles AS size", "tokens", "size(tokens) AS n_usable")
    shared = set_join.ranked_tokens(nodes, 80, 256, 2).persist()
    lookups = shared.where("asks").select("node", "size", "token")
    wide = shared.where("asks AND df > 16").select("node").distinct()
    kept = {r.node for r in set_join.crowd(lookups, shared, wide).collect()}
    is_wide = {r.node for r in wide.collect()}
    rows = shared.collect()
    sought = {r.token for r in rows if r.asks and r.node in is_wide}
    assert is_wide and is_wide <= kept < {r.node for r in rows}
    assert kept == {r.node for r in rows if r.holds and r.token in sought}
    shared.unpersist()
