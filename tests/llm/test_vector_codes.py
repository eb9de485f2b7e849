import hashlib
import math

import numpy as np
import pytest

from shelfwise.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, id int, codes string, whole int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "c", 2) for i, v, label in rows], SCHEMA)


def plain(rows, entries=vc.ENTRIES, rounds=vc.ROUNDS):
    """The same by whole-number loops without any transform."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}, ""
    width = max(1, -(-max(len(v) for _, v, _ in kept) // 4))
    whole = [[math.floor(1024 * float(np.float32(x))) for x in v] + [0] * (4 * width - len(v)) for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, whole[r]))
    cut = [[w[p * width : (p + 1) * width] for p in range(4)] for w in whole]
    books = [[list(cut[r][p]) for r in order[:entries]] for p in range(4)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            taken = {}
            for parts in cut:
                taken.setdefault(best(parts[p], books[p])[1], []).append(parts[p])
            for j, members in taken.items():
                books[p][j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out, by_label = [], {}
    for (i, _, label), parts in zip(kept, cut, strict=True):
        found = [best(parts[p], books[p]) for p in range(4)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), label))
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    text = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(((i, c, e, by_label[la]) for i, c, e, la in out), key=repr), hashlib.sha256(text.encode()).hexdigest()


def got(df):
    rows = df.collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in rows), key=repr), {r.codebooks_sha256 for r in rows}


def vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    rows = rng.normal(0, 0.2, (n, dims)).astype(np.float32)
    return [(int(i), [float(x) for x in rows[i]], None if i % 5 == 0 else int(i % 3)) for i in range(n)]


@pytest.mark.parametrize("n, dims, seed", [(300, 16, 1), (40, 12, 2), (270, 10, 3)])
def test_codes_equal_plain_loops(spark, n, dims, seed):
    rows = vectors(n, dims, seed)
    wanted, digest = plain(rows)
    df = vc.codes(frame(spark, rows))
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got(df) == (wanted, {digest})


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (3, [0.5, -0.5, 0.25, 1.0], 1), (3, [0.5, -0.5, 0.25, 1.0], 1), (None, [0.1, 0.2, 0.3, 0.4], None), (1, None, 1), (2, [nan, 1.0], 1),
        (4, [inf, 0.0, 0.0, 0.0], 2), (5, [0.0, None, 0.0, 0.0], 2), (6, [], 3), (7, [0.25], None), (8, [-inf], 1), (9, [-0.0001] * 7, 4),
    ]
    wanted, digest = plain(rows)
    assert got(vc.codes(frame(spark, rows))) == (wanted, {digest})
    assert len(wanted) == 6


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, [float(i % 2)] * 8, i) for i in range(6)]
    wanted, digest = plain(rows)
    assert got(vc.codes(frame(spark, rows))) == (wanted, {digest})
    assert {c for _, c, _, _ in wanted} == {"00000000", "01010101"}


def test_large_components_stay_inside_64_bits(spark):
    rows = [(i, [3e38 if i % 2 else -3e38] * 64, i) for i in range(4)]
    assert [r.error for r in vc.codes(frame(spark, rows)).collect()] == [0] * 4


def test_empty_table(spark):
    assert vc.codes(frame(spark, [])).count() == 0
    assert vc.codes(frame(spark, [(1, None, 1)])).count() == 0


def test_transform_keeps_distances_and_orders_by_sign_changes():
    rows = np.random.default_rng(1).integers(-(2**20), 2**20, (50, 13))
    turned = vc.transform(rows)
    assert turned.shape == (50, 16)
    assert (((turned[:, None] - turned[None]) ** 2).sum(2) == 16 * ((rows[:, None] - rows[None]) ** 2).sum(2)).all()
    matrix = vc.transform(np.eye(32, dtype=np.int64)).T
    assert [(row[1:] != row[:-1]).sum() for row in matrix] == list(range(32))


def test_entries_are_given_up_early(spark, sf_dir):
    whole = vc.whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).orderBy("id").collect()
    rows = np.array([r.whole for r in whole], np.int64)
    turned = vc.transform(rows[:, :16])
    index, distance, work = vc.nearest(turned, turned[:256])
    apart = ((rows[:, None, :16] - rows[None, :256, :16]) ** 2).sum(2)
    assert (index == apart.argmin(1)).all() and (distance == apart.min(1)).all()
    assert work < 0.6 * len(rows) * 256 * 16


def test_decoding_gives_the_entries(spark):
    rows = vectors(60, 8, 9)
    whole = vc.whole_vectors(frame(spark, rows))
    books = vc.fit(whole, rounds=2, entries=16)
    coded = vc.encode(whole, books)
    error = {r.id: r.error for r in coded.collect()}
    exact = {r.id: r.whole for r in whole.collect()}
    for r in vc.decode(coded, books).collect():
        assert sum((a - b) ** 2 for a, b in zip(exact[r.id], r.whole, strict=True)) == error[r.id]
