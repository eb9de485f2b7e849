"""Operators that SQL cannot express against plain versions of the whole method."""

import itertools
import math
import random
import re
from collections import Counter

import cases
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from shelfwise.llm import langid, licences, pii, spotsigs

# Language


def plain_language(rows, asked):
    """Fitting and scoring by dictionaries. rows: (text, lang) to learn from."""
    sizes = Counter(lang for _, lang in rows)
    languages = sorted(sizes, key=lambda la: (-sizes[la], la))
    letters = regex.compile(r"\p{L}+").findall
    words = {la: Counter(w for t, x in rows if x == la for w in letters(t.lower()) if len(w) <= langid.LONGEST) for la in languages}
    grams = {la: Counter() for la in languages}
    for la in languages:
        for w, n in words[la].items():
            padded = f" {w} "
            for k in langid.GRAMS:
                for i in range(len(padded) - k + 1):
                    if padded[i : i + k] != " ":
                        grams[la][padded[i : i + k]] += n

    def logs(counts):
        keys = set().union(*counts.values())
        total = {la: sum(counts[la].values()) + langid.SMOOTH * len(keys) for la in languages}
        return {k: [math.log((counts[la][k] + langid.SMOOTH) / total[la]) for la in languages] for k in keys}

    known_words, known_grams = logs(words), logs(grams)

    def of_word(word):
        if word in known_words:
            return known_words[word]
        padded = f" {word} "
        for k in langid.GRAMS:
            got = [known_grams[g] for i in range(len(padded) - k + 1) if (g := padded[i : i + k]) in known_grams]
            if got:
                return [sum(c) / len(got) for c in zip(*got, strict=True)]
        return None

    out = []
    for text in asked:
        found = [w for t in (text or "").lower().split() for w in letters(t)]
        if not found:
            out.append(("und", 0.0))
            continue
        sums = np.sum([s for w in found if (s := of_word(w)) is not None] or [[0.0] * len(languages)], axis=0)
        logits = sums / len(found) * min(len(found), langid.WEIGHT)
        odds = np.exp(logits - logits.max())
        out.append((languages[int(odds.argmax())], float(odds.max() / odds.sum())))
    return out


def test_language_equals_plain_fit_and_score(spark):
    rng = random.Random(3)
    rows = []
    for i in range(90):
        lang = rng.choice(["aa", "bb", "cc"])
        letters = {"aa": "abcde", "bb": "cdefgh", "cc": "éfghab"}[lang]
        rows.append((i, " ".join("".join(rng.choices(letters, k=rng.randrange(1, 6))) for _ in range(rng.randrange(1, 40))), lang, "s", 1, 1, "k", 1, 1))
    # Two texts of equal words in either order, and one whose languages tie.
    rows += [(500, "abcd efgh", "aa", "s", 1, 1, "k", 1, 1), (501, "efgh abcd", "aa", "s", 1, 1, "k", 1, 1), (502, "zzz", None, "s", 1, 1, "k", 1, 1)]
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    learnt = [(r[1], r[2]) for r in rows if r[2] and not got[r[0]].held_out]
    wanted = plain_language(learnt, [r[1] for r in rows])
    for r, (lang, score) in zip(rows, wanted, strict=True):
        assert got[r[0]].score == pytest.approx(score, abs=1e-9)
        assert got[r[0]].lang_pred == lang
    assert got[500].score == got[501].score
    # No known letter: every language is as likely, the commonest is named.
    common = Counter(la for _, la in learnt)
    assert got[502].lang_pred == min(common, key=lambda la: (-common[la], la)) and got[502].score == pytest.approx(1 / 3)


# Licences


def plain_grams(text):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    return set(words) | {f"{a} {b}" for a, b in zip(words, words[1:])}


@pytest.fixture(scope="module")
def classifier(spark):
    return licences.learn(cases.frame(spark, [(i, f"plain words number {i} of the day and of the night") for i in range(40)]))


def plain_scores(classifier, lines):
    weights = {}
    for r in classifier.weights.collect():
        weights.setdefault(r.gram, {})[r.family] = r.weight
    out = {}
    for line in lines:
        raw = {f: weights[None].get(f, 0.0) + sum(weights.get(g, {}).get(f, 0.0) for g in plain_grams(line)) for f in classifier.families}
        top = max(raw.values())
        best = max(raw, key=lambda f: (raw[f], f))
        out[line] = (best, 1 / sum(math.exp(x - top) for x in raw.values()))
    return out


LINES = [
    *[t for notices in licences.TEMPLATES.values() for t in notices], *licences.ALIKE, "Words of no kind at all.", "The house by the river.",
    "free software", "a public version", "MIT", "distributed", "You may copy this", "under the terms of use", "Version 2.0 of the plan",
]


def test_licence_scores_equal_plain_sums(spark, classifier):
    lines = spark.createDataFrame([(t,) for t in LINES], "line string")
    by_key = {r.key: r.line for r in lines.selectExpr("md5(line) AS key", "line").collect()}
    wanted = plain_scores(classifier, LINES)
    for r in licences.classify(lines, classifier).collect():
        likely, score = wanted[by_key[r.key]]
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.family in (likely, "unknown")


def test_licence_gate_loses_nothing(spark, classifier):
    """Every line that the weights would not call none passes the gate."""
    rng = random.Random(4)
    vocabulary = sorted({w for t in LINES for w in t.split()} | {"house", "river", "is", "was"})
    made = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 12))) for _ in range(1500)]
    scores = plain_scores(classifier, [*LINES, *made])
    passed = {r.line for r in spark.createDataFrame([(t,) for t in scores], "line string").where(f"line RLIKE r'{classifier.gate}'").collect()}
    lost = [t for t, (f, _) in scores.items() if f != "none" and t not in passed]
    assert not lost
    assert len(passed) < len(scores)


def test_gate_pattern_keeps_what_can_turn_the_sum():
    margins = {"a": 0.1, "b": 0.2, "big word": 3.0, "c": 0.5, "down": -4.0}
    pattern = re.compile(licences.gate_pattern(margins, -0.4).replace(r"[^\p{L}\p{N}]", r"[\W_]").replace(r"[\p{L}\p{N}]", r"[^\W_]"))
    assert pattern.search("x c y") and pattern.search("Big,  WORD") and not pattern.search("a b down big")
    assert licences.gate_pattern(margins, 0.1) == ""


UNGATED = {
    "Available under CC BY-SA 4.0.": "cc-by-sa",
    "Creative Commons Attribution 4.0 International": "cc-by",
    "CC0 1.0 Universal": "public-domain",
    "Distributed under the terms of the GNU GPL v3": "gpl",
    "Apache-2.0": "apache",
}
OTHERS = {
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)": "boost",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "cc-by-nd",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0": "epl",
    "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL": "eupl",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
    "arising from the use of this software.": "zlib",
}
#: Denied, of a name that no template has, or with a mark that the family has not: unknown, never none or confirmed.
DOUBTFUL = [
    "This is not licensed under the MIT License.",
    "This file is no longer released under the GNU General Public License, version 3.",
    "Licensed under the Wibbleworth Public License, version 3.",
    "Released under the Quince Valley License.",
    "Licensed under CC BY-NC-ND 4.0.",
]


def test_notices_without_licence_words_and_further_families(spark, classifier):
    rows = list(enumerate([*UNGATED, *OTHERS, *DOUBTFUL, "She read about Apache history and the general public of Boston.", "Das Haus mit dem Dach"]))
    got = {r.doc_id: r for r in licences.scan(cases.frame(spark, rows), classifier).collect()}
    for i, text in rows:
        family = (UNGATED | OTHERS).get(text, "")
        assert got[i].families == family, (text, got[i])
        if text in DOUBTFUL:
            assert got[i].n_unknown >= 1, (text, got[i])
    assert all(got[i].n_lines == 0 for i in (len(rows) - 2, len(rows) - 1))


def test_calibration_takes_the_least_score_that_few_unseen_notices_pass():
    held = [(2, [0.0, 0.0, 3.0]), (0, [3.0, 0.0, 0.0])]
    unseen = [[0.0, 0.0, 0.6]] * 19 + [[0.0, 0.0, 9.0]]
    sharpness, sure = licences.calibrated(held, unseen, 2)
    assert sharpness == max(licences.TEMPERATURES)
    assert sure == next(t for t in licences.LEAST_SCORES if t > licences._chances([0, 0, 0.6], sharpness)[2])


# Personal data


def enumerated(field, rows, fixed, edges, members):
    """Marginals by going through all labellings of nodes and entities."""
    n, k = len(rows), len(pii.LABELS)
    own = np.array([field.unary[r].sum(0) for r in rows] + [np.zeros(k)] * len(members))
    for i, of in enumerate([*[[i] for i in range(n)], *members]):
        known = [fixed[j] for j in of if fixed[j]]
        if known:
            own[i] = -30.0
            for label in set(known):
                own[i, label] = np.log(known.count(label) / len(known))
    total = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n + len(members)):
        score = sum(own[i, x] for i, x in enumerate(labels))
        score += sum(field.between(kind)[labels[i], labels[j]] for i, j, kind in edges)
        for i in range(n):
            total[i, labels[i]] += math.exp(score)
    return total / total.sum(1, keepdims=True)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_marginals_on_trees_equal_enumeration(seed):
    """Without a loop the messages are exact: a chain, and a star of repeats around their entity."""
    rng = np.random.default_rng(seed)
    k = len(pii.LABELS)
    field = pii.Field(rng.normal(0, 1, (pii.N_FEATURES, k)), rng.normal(0, 1, (k, k)), np.array([0.0, 2.0, 1.0]))
    rows = [[int(x)] for x in rng.integers(0, pii.N_FEATURES, 4)]
    chain = [(0, 1, pii.CHAIN), (1, 2, pii.CHAIN), (2, 3, pii.CHAIN)]
    star = [(0, 4, pii.SAME), (1, 4, pii.SAME), (2, 4, pii.SAME)]
    for fixed in ([0, 0, 0, 0], [2, 0, 0, 0]):
        assert field.marginals(rows, fixed, chain) == pytest.approx(enumerated(field, rows, fixed, chain, []), abs=5e-3)
        got = field.marginals(rows, fixed, star, [[0, 1, 2]])
        assert got == pytest.approx(enumerated(field, rows, fixed, star, [[0, 1, 2]]), abs=5e-3)


def test_marginals_with_a_loop_agree_with_enumeration_on_labels():
    rng = np.random.default_rng(8)
    k = len(pii.LABELS)
    field = pii.Field(rng.normal(0, 1, (pii.N_FEATURES, k)), 0.3 * rng.normal(0, 1, (k, k)), np.array([0.0, 2.0, 1.0]))
    rows = [[0], [5], [9], [12]]
    edges = [(0, 1, pii.CHAIN), (1, 2, pii.CHAIN), (0, 4, pii.SAME), (2, 4, pii.SAME)]
    got, exact = field.marginals(rows, [0] * 4, edges, [[0, 2]]), enumerated(field, rows, [0] * 4, edges, [[0, 2]])
    assert np.abs(got - exact).max() < 0.1


# Fingerprints


def test_likeness_equals_sets(spark):
    rng = random.Random(8)
    pairs = [(i * 7 % 41, " ".join(rng.choices(["the", "of", "house", "tree", "river", "de", "stone", "sky", "wind"], k=50))) for i in range(41)]
    pairs += [(100, ""), (101, None), (102, "the"), (103, "word"), (104, pairs[0][1]), (105, pairs[0][1])]
    texts = dict(pairs)
    order = sorted(texts, reverse=True)
    following = {i: order[(p + 1) % len(order)] for p, i in enumerate(order)}
    edits = {}
    for i in order:
        own, after = texts[i] or "", texts[following[i]] or ""
        half = len(own) // 2
        edits[i] = own[: len(own) - half] + after[:half]
    rows = [(i, texts[i], edits[i]) for i in order]
    sets = {
        r.i: (set(r.own), set(r.changed))
        for r in spark.createDataFrame(rows, "i bigint, own string, changed string")
        .select("i", spotsigs.signatures(spotsigs.F.col("own")).alias("own"), spotsigs.signatures(spotsigs.F.col("changed")).alias("changed"))
        .collect()
    }

    def like(a, b):
        return 1.0 if not a and not b else len(a & b) / len(a | b)

    for r in spotsigs.fingerprints(cases.frame(spark, pairs)).collect():
        own, changed = sets[r.doc_id]
        assert r.near_edited == pytest.approx(like(own, changed))
        assert r.near_next == pytest.approx(like(own, sets[following[r.doc_id]][0]))
        assert r.n_signatures == len(own)


def test_only_what_may_be_a_licence_leaves_the_scan(spark, classifier, monkeypatch):
    """Units of common words that the gate has to let pass are scored in the scan; their lines are neither stored nor moved."""
    rows = [(i, f"Page {i} of the nd series.\nThe mit of day {i}.") for i in range(30)] + [(30, "Released under the MIT License."), (31, None)]
    docs = cases.frame(spark, rows)
    assert docs.where(F.col("text").rlike(classifier.gate)).count() == 31
    tables, stored = {}, licences.stored
    monkeypatch.setattr(licences, "stored", lambda df, purpose: tables.setdefault(purpose, stored(df, purpose)))
    got = {r.doc_id: (r.n_lines, r.families) for r in licences.scan(docs, classifier).collect()}
    assert got == {i: (0, "") for i in range(32)} | {30: (1, "mit")}
    assert [r.line for r in tables["licence-lines"].collect()] == ["Released under the MIT License."]
    assert tables["licence-found"].where("line IS NOT NULL").count() == 1


def test_words_are_split_once():
    """A long paragraph is not split again for each of its passages, nor a unit for each of its word pairs."""
    assert str(licences.units(F.col("text"), "x")).count(r"\s+") == 1
    assert str(licences.grams(F.col("line"))).count("split(") == 1
