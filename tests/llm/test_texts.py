"""Mixing, language, toxicity, fingerprints, BPE and Hamming search."""

import random
import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import bpe, hamming, langid, mixing, spotsigs, toxicity

ENCODING = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(bpe.RANKS)), special_tokens={}
)


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


# Mixing


def plain_targets(sizes):
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        weight = sum(w for s, w in weights.items() if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * w / weight for s, w in weights.items()}
        over = {s for s in sizes if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix_meets_targets(spark):
    rng = random.Random(1)
    sizes = {"a": 40, "é": 6, "b": 300, "z": 2, None: 50, "hot": 900}
    docs, i = None, 0
    for source, n in sizes.items():
        pairs = [(i + k, " ".join(["w"] * rng.choice([0, 1, 5, 30, 700]))) for k in range(n)]
        i += n
        part = cases.frame(spark, pairs, source=source)
        docs = part if docs is None else docs.union(part)
    line, pieces = mixing.mix(docs, block_words=16)
    got = mixing.taken(line, pieces).collect()
    assert len(got) == i
    by_source = {r.source: r.n for r in docs.selectExpr("source", "size(split(text, ' ')) * int(text <> '') n").groupBy("source").sum("n").toDF("source", "n").collect()}
    wanted = plain_targets(by_source)
    source_of = {r.doc_id: r.source for r in docs.collect()}
    total = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == by_source[source_of[r.doc_id]]
        assert r.target == pytest.approx(wanted[source_of[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size
        total[source_of[r.doc_id]] += r.taken
    assert all(abs(total[s] - wanted[s]) <= 1 for s in sizes)
    again = mixing.taken(*mixing.mix(docs.repartition(7), block_words=16)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    # Any prefix of the schedule holds the sources in proportion.
    early = {r.skey: r.n for r in pieces.where("slot < 800").groupBy("skey").sum("words").toDF("skey", "n").collect()}
    everything = sum(wanted.values())
    assert all(abs(early.get(f"0{s}", 0) - 800 * 16 * wanted[s] / everything) < 16 * 12 for s in ("a", "b", "hot"))


def test_mix_of_odd_rows(spark):
    got = mixing.taken(*mixing.mix(cases.frame(spark))).collect()
    texts = dict(cases.ODD)
    assert sorted(r.size for r in got) == sorted(len(cases.words(t)) for _, t in cases.ODD)
    assert all(r.taken == len(cases.words(texts[r.doc_id])) for r in got)
    assert mixing.taken(*mixing.mix(cases.nothing(spark))).count() == 0
    assert [r.taken for r in mixing.taken(*mixing.mix(cases.frame(spark, [(1, None), (2, "")]))).collect()] == [0, 0]


# Language


def sentences(seed, n, parts):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 40))) for _ in range(n)]


def test_language_of_held_out_texts(spark):
    own = {"en": ["the", "ing", "er", "th", "on"], "de": ["sch", "ung", "ein", "ü", "heit"], "fr": ["eau", "é", "ment", "ou", "les"]}
    docs = None
    for k, (lang, parts) in enumerate(own.items()):
        part = cases.frame(spark, [(1000 * k + i, t) for i, t in enumerate(sentences(k, 120, parts))], lang=lang)
        docs = part if docs is None else docs.union(part)
    odd = cases.frame(spark, [(9000 + (i or 0), t) for i, t in cases.ODD], lang=None)
    got = {r.doc_id: r for r in langid.identify(docs.union(odd)).collect()}
    texts = {r.doc_id: r for r in docs.collect()}
    assert all(got[i].held_out == held_out(i) for i in texts)
    tested = [i for i in texts if held_out(i)]
    assert sum(got[i].lang_pred == texts[i].lang for i in tested) >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 for r in got.values())
    for i, t in cases.ODD:
        r = got[9000 + (i or 0)]
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in t or ""))
    left = langid.keep_known(docs.union(odd))
    assert left.columns == docs.columns
    assert set(texts) <= {r.doc_id for r in left.collect()}
    assert not {9003, 9004, 9005, 9011, 9013} & {r.doc_id for r in left.collect()}


def test_language_backs_off(spark):
    model = langid.Model(["a", "b"], {"word": [-1.0, -5.0]}, {"xy": [-6.0, -2.0], "q": [-3.0, -3.5]})
    assert list(model.of_word("word")) == [-1.0, -5.0]
    assert list(model.of_word("mxyn")) == [-6.0, -2.0]  # no longer n-gram is known
    assert list(model.of_word("kqk")) == [-3.0, -3.5]
    assert model.of_word("zzz") is None
    score = model.scorer()
    assert score("word Word!")[0] == "a" and score("xyxy")[0] == "b"
    assert score("zzz") == ("a", 0.5) and score("12 ½") == ("und", 0.0)


def test_language_without_anything(spark):
    assert langid.identify(cases.nothing(spark)).count() == 0
    got = langid.identify(cases.frame(spark, [(1, "some words")], lang=None)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


# Toxicity


def toxic_table(spark, n=600):
    rng = random.Random(4)
    pairs, marks = [], []
    for i in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 40))]
        kind = rng.randrange(8)
        if kind < 3:
            words[rng.randrange(len(words))] = "insult"
        if kind in (2, 3, 4):
            words[rng.randrange(len(words))] = "group"
        if "insult" in words and rng.random() < 0.05:
            words.append("insult")
        pairs.append((i, " ".join(words)))
        marks.append((i, int("insult" in words and "group" in words), 1))
    return cases.frame(spark, pairs), spark.createDataFrame(marks, "doc_id bigint, toxic int, quality int"), dict(pairs), {i: t for i, t, _ in marks}


def test_pairs_of_terms_decide(spark):
    docs, labels, texts, truth = toxic_table(spark)
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    tested = [i for i in texts if held_out(i)]
    wrong = [i for i in tested if got[i].predicted != truth[i]]
    assert len(wrong) <= 0.03 * len(tested), wrong  # an additive score cannot tell one word from both
    assert all(r.predicted == int(r.score >= 0.7) and r.held_out == held_out(r.doc_id) for r in got.values())


def syllables(rng):
    return "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))


@pytest.mark.parametrize("apart", [True, False])
def test_only_the_pair_of_two_words_decides(spark, apart):
    """Toxic with exactly one of two words, or with both or neither: no word tells anything alone."""
    rng = random.Random(11)
    names = sorted({syllables(rng) for _ in range(400)})
    pairs, marks = [], []
    for i in range(3000):
        words = rng.choices(names, k=20)
        both = [w for w in ("alpha", "omega") if rng.random() < 0.5]
        pairs.append((i, " ".join([*words, *both])))
        marks.append((i, int((len(both) == 1) == apart)))
    docs, labels = cases.frame(spark, pairs), spark.createDataFrame(marks, "doc_id bigint, toxic int")
    truth, tested = dict(marks), [i for i, _ in pairs if held_out(i)]
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    assert sum((got[i] >= 0.5) == truth[i] for i in tested) >= 0.95 * len(tested)


def test_score_is_the_plain_sum_over_pairs(spark):
    docs, labels, texts, _ = toxic_table(spark, 300)
    machine = toxicity.learn(docs, labels)
    of = toxicity.Terms(machine.chosen)
    plain = {}
    for i, text in texts.items():
        terms = of(text)
        z = machine.w0 + sum(machine.w[t] for t in terms)
        z += sum(machine.v[a] @ machine.v[b] for k, a in enumerate(terms) for b in terms[:k])
        plain[i] = 1 / (1 + np.exp(-z))
    assert {r.doc_id: r.score for r in toxicity.score(docs, machine).collect()} == pytest.approx(plain)


def test_ties_and_repeated_rows_have_equal_scores(spark):
    docs, labels, texts, _ = toxic_table(spark, 300)
    machine = toxicity.learn(docs, labels)
    twice = cases.frame(spark, [*texts.items(), *[(i + 1000, " ".join(reversed(t.split()))) for i, t in texts.items()]])
    got = {r.doc_id: r.score for r in toxicity.score(twice, machine).collect()}
    assert all(got[i] == pytest.approx(got[i + 1000]) for i in texts)


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, None), (None, 1), (6, 0)], "doc_id bigint, toxic int")
    docs = cases.frame(spark)
    got = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(got) == len(cases.ODD) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.learn(docs, labels.where("false"))
    assert {(r.score, r.predicted) for r in toxicity.score(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.score(cases.nothing(spark), none).count() == 0


# Fingerprints


def plain_edits(pairs):
    order = sorted(pairs, key=lambda p: -p[0])
    out = {}
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        out[doc_id] = (len(text), cases.sha(text[: len(text) - half] + following[:half]))
    return out


@pytest.mark.parametrize("run", [8192, 3])
def test_fingerprints(spark, monkeypatch, run):
    monkeypatch.setattr(spotsigs, "RUN", run)
    monkeypatch.setattr(spotsigs, "SEGMENTS", 4)
    rng = random.Random(8)
    pairs = [(i * i % 4001, " ".join(rng.choices(["the", "of", "house", "tree", "river", "de", "stone", "sky", "wind"], k=60))) for i in range(40)]
    pairs += [(5000 + (i or 0), t) for i, t in dict(cases.ODD).items() if i]
    got = {r.doc_id: r for r in spotsigs.fingerprints(cases.frame(spark, pairs)).collect()}
    wanted = plain_edits(pairs)
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == wanted
    assert got[5001].fingerprint == got[5002].fingerprint
    assert all(0 <= x <= 1 for r in got.values() for x in (r.near_edited, r.near_next))
    assert got[5002].near_next == 1.0


def test_signatures(spark):
    text = "At a rally to kick off a weeklong campaign for the South Carolina primary"
    plain = ["at rally kick", "a rally kick", "to kick off", "a weeklong campaign", "for south carolina", "the south carolina"]
    df = spark.createDataFrame([(text, plain)], "text string, plain array<string>")
    r = df.select(spotsigs.signatures(df.text).alias("got"), spotsigs.F.expr("array_sort(transform(plain, x -> xxhash64(x)))").alias("want")).first()
    assert r.got == r.want


def test_signatures_pass_over_any_run_of_anchors(spark):
    rng = random.Random(9)
    for run in (3, 9, 40, 5000):
        words = [w for i in range(6) for w in [f"c{i}", *rng.choices(["the", "of", "|", "für"], k=run)]]
        content = [i for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
        want = set()
        for i, w in enumerate(words):
            after = [words[j] for j in content if j > i][:2]
            if w in spotsigs.ANCHORS and len(after) == 2:
                want.add(" ".join([w, *after]))
        df = spark.createDataFrame([(" ".join(words), sorted(want))], "text string, plain array<string>")
        r = df.select(spotsigs.signatures(df.text).alias("got"), spotsigs.F.expr("array_sort(transform(plain, x -> xxhash64(x)))").alias("want")).first()
        assert r.got == r.want


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_near_pairs_equal_all_pairs(spark, threshold):
    rng = random.Random(6)
    base = [f"{rng.choice(['the', 'of', 'and'])} w{rng.randrange(200)} v{rng.randrange(200)}".split() for _ in range(40)]
    pairs = []
    for i in range(60):
        kept = [w for w in base if rng.random() < rng.choice([0.7, 0.95, 1.0])]
        pairs.append((i, " ".join(w for ws in kept for w in ws)))
    docs = cases.frame(spark, [*pairs, *[(1000 + (i or 0), t) for i, t in cases.ODD]])
    members, near = spotsigs.near_pairs(docs, threshold)
    sets = {r.doc_id: frozenset(r.s) for r in docs.select("doc_id", spotsigs.signatures(docs.text).alias("s")).collect() if r.s}
    node = {r.doc_id: r.node for r in members.collect()}
    least = {}
    for i in sorted(sets):
        least.setdefault(sets[i], i)
    assert node == {i: least[s] for i, s in sets.items()}
    nodes = sorted(set(node.values()))
    wanted = {}
    for a in nodes:
        for b in nodes:
            like = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            if a < b and like >= threshold:
                wanted[a, b] = like
    got = near.collect()
    assert {(r.a, r.b): r.likeness for r in got} == pytest.approx(wanted) and len(got) == len(wanted)


def test_fingerprints_of_few_rows(spark):
    assert spotsigs.fingerprints(cases.nothing(spark)).count() == 0
    got = spotsigs.fingerprints(cases.frame(spark, [(7, "abcd the end")])).first()
    assert got.edited_sha256 == cases.sha("abcd t" + "abcd t") and got.near_next == 1.0
    assert spotsigs.fingerprints(cases.frame(spark)).count() == len(cases.ODD)


# BPE


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from([" ", "  ", "\n", "a", "The", "é", "日", "😀", "'s", "12", " ", "\x1c", "\x85", "!?", "½"]), max_size=20).map("".join))
def test_bpe_equals_tiktoken(text):
    codec = bpe.codec(*bpe.default_vocabulary())
    ids = codec.encode(text)
    assert ids == ENCODING.encode_ordinary(text)
    assert codec.decode_bytes(ids) == text.encode()
    offsets = codec.encode_with_offsets(text)
    assert [i for i, _, _ in offsets] == ids
    assert b"".join(text.encode()[s:e] for _, s, e in offsets) == text.encode()


def test_bpe_rows(spark):
    got = bpe.digests(cases.frame(spark)).collect()
    texts = dict(cases.ODD)
    for r in got:
        ids = ENCODING.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == bpe.hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == cases.sha(texts[r.doc_id] or "")
    back = bpe.decode(bpe.encode(cases.frame(spark))).collect()
    assert len(back) == len(cases.ODD)
    assert all(r.text == (texts[r.doc_id] or "") and bytes(r.decoded) == r.text.encode() for r in back)
    assert bpe.digests(cases.nothing(spark)).count() == 0
    for r in bpe.encode_with_offsets(cases.frame(spark)).collect():
        raw, ids = (texts[r.doc_id] or "").encode(), ENCODING.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == ids and len(r.ends) == len(ids)
        assert [raw[a:b] for a, b in zip([0, *r.ends], r.ends)] == [ENCODING.decode_single_token_bytes(i) for i in ids]
    part = ENCODING.encode_ordinary("日")[:1]
    assert bpe.codec(*bpe.default_vocabulary()).decode(part) == "�"


# Hamming search


def plain_top(rows, k):
    codes = {i: [x is not None and x == x and x > 0 for x in v] for i, v in rows if v}
    dims = max(map(len, codes.values()))
    codes = {i: c + [False] * (dims - len(c)) for i, c in codes.items()}
    out = set()
    for q in codes:
        if q % 100 == 0:
            near = sorted((sum(a != b for a, b in zip(codes[q], c, strict=True)), i) for i, c in codes.items() if i != q)
            out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(near[:k])}
    return out


@pytest.mark.parametrize("k,dims", [(5, 20), (12, 64)])
def test_top_k(spark, k, dims):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=dims)]) for i in range(600)]
    rows += [(i, rows[100][1]) for i in range(600, 640)]  # copies of a query
    rows += [(700, None), (701, []), (800, [1.0, None, float("nan")]), (801, [2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as code", "2 as query")
    got = hamming.top_k(df, k=k).collect()
    assert {tuple(r) for r in got} == plain_top(rows, k) and len(got) == len(set(got))


def test_top_k_of_few_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert hamming.top_k(spark.createDataFrame([], schema)).count() == 0
    few = spark.createDataFrame([(0, [1.0, -1.0]), (1, [1.0, 1.0]), (2, None)], schema)
    assert [tuple(r) for r in hamming.top_k(few).collect()] == [(0, 1, 1, 1)]
