"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words and their first three to six letters, each hashed to one of ``2**HASH_BITS``
buckets and present or not; two or three different words in one bucket are terms of their own. The machine scores ``w0 + sum of w + sum over pairs of <v, v>`` of the
buckets present, so two terms together (an insult and whom it is aimed at) can say more than their weights
added. It is fitted in two steps. A first machine takes all terms of at least ``MIN_TEXTS`` texts, so terms that tell nothing
alone but much together are learnt too. The second is fitted to those ``N_PAIRED`` of them that interact most, by
the length of their factors times how much their presence varies, and to the ``n_terms`` that tell the classes apart best
alone (by ``MIN_STRENGTH`` standard deviations).

Bounds, as parameters: about ``sample`` labelled texts (by a hash of the id, all if there are fewer),
``n_terms`` and ``N_PAIRED`` terms, ``FACTORS`` numbers each. Scoring reads whole texts.

Edge cases: a null or empty text has no terms and gets the score of the constant alone; a null label is no
label; several labels of an id all count, scores do not use them; without any labels
every score is 0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import is_held_out, parts

HASH_BITS = 20
LEVELS = 3
PREFIXES = (3, 4, 5, 6)
SAMPLE = 12_000
N_TERMS = 4096
MIN_TEXTS = 4
MIN_STRENGTH = 4.0
N_PAIRED = 128
FACTORS = 6
EPOCHS = 250
FIRST_EPOCHS = 10
FIRST_BATCH = 256
THRESHOLD = 0.7
CACHE = 100_000
FIT_CACHE = 20_000
NOTHING: dict[str, tuple[int, ...]] = {}


def buckets_of(word: str) -> tuple[int, ...]:
    """Buckets of a lower-case word and of its beginnings."""
    terms = [f"^{word[:n]}" for n in PREFIXES if len(word) > n] + [word]
    return tuple(zlib.crc32(t.encode()) >> (32 - HASH_BITS) for t in terms)


class Terms:
    """The (chosen) terms of whole texts, with a bounded memory of tokens.

    A bucket that several different words of a text fall into counts as further terms, up to ``LEVELS``.
    """

    def __init__(self, chosen: dict[int, int] | None = None):
        import regex

        self.letters = regex.compile(r"\p{L}+").findall
        self.chosen, self.seen = chosen, {}
        self.wanted = None if chosen is None else {t // LEVELS for t in chosen}

    def of_token(self, token: str) -> dict[str, tuple[int, ...]]:
        own = {}
        for word in self.letters(token):
            buckets = buckets_of(word)
            if self.wanted is not None:
                buckets = tuple(b for b in buckets if b in self.wanted)
            if buckets:
                own[word] = buckets
        if len(self.seen) >= (FIT_CACHE if self.wanted is None else CACHE):
            self.seen.clear()
        if len(token) <= 64:
            self.seen[token] = own or NOTHING
        return own

    def __call__(self, text: str | None) -> list[int]:
        words: dict[str, tuple[int, ...]] = {}
        seen = self.seen
        for token in set((text or "").lower().split()):
            own = seen.get(token)
            if own is None:
                own = self.of_token(token)
            if own:
                words.update(own)
        counts = Counter(chain.from_iterable(words.values()))
        terms = sorted(b * LEVELS + level for b, n in counts.items() for level in range(min(n, LEVELS)))
        return terms if self.chosen is None else [self.chosen[t] for t in terms if t in self.chosen]


class Machine:
    """w0, w and v of the chosen buckets."""

    def __init__(self, chosen: dict[int, int], w0: float, w: np.ndarray, v: np.ndarray):
        self.chosen, self.w0, self.w, self.v = chosen, w0, w, v

    def score(self, places: list[int]) -> float:
        if self.w0 is None:
            return 0.0
        v = self.v[places]
        both = 0.5 * float((v.sum(0) ** 2 - (v**2).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(self.w0 + self.w[places].sum() + both, -30, 30))))


def fit(rows: list[list[int]], labels: list[int], n_terms: int, epochs: int = EPOCHS, decay: float = 0.3, rate: float = 0.02) -> tuple[float, np.ndarray, np.ndarray]:
    """Full-batch Adam on the logistic loss with decaying weights; the same input gives the same machine."""
    rows = [r or [n_terms] for r in rows]  # one idle bucket keeps empty rows in place
    flat = np.concatenate([np.array(r, np.int64) for r in rows])
    heads = np.cumsum([0, *[len(r) for r in rows[:-1]]])
    of_row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    y = np.array(labels, float)
    rng = np.random.default_rng(7)
    decay /= len(rows)
    live = np.append(np.ones(n_terms), 0.0)
    w, v = np.zeros(n_terms + 1), rng.normal(0, 0.05, (n_terms + 1, FACTORS)) * live[:, None]
    w0 = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (np.zeros(1), w, v)]
    for step in range(1, epochs + 1):
        vf = v[flat]
        sums = np.add.reduceat(vf, heads)
        z = w0 + np.add.reduceat(w[flat], heads) + 0.5 * ((sums**2).sum(1) - np.add.reduceat((vf**2).sum(1), heads))
        slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        own = slope[of_row]
        gw = np.bincount(flat, own, n_terms + 1) * live
        gv = np.stack([np.bincount(flat, own * (sums[of_row, f] - vf[:, f]), n_terms + 1) for f in range(FACTORS)], 1) * live[:, None]
        grads = (np.array([slope.sum()]), gw + decay * w, gv + decay * v)
        moves = []
        for (m, s), g in zip(moments, grads, strict=True):
            m *= 0.9
            m += 0.1 * g
            s *= 0.999
            s += 0.001 * g * g
            moves.append(rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8))
        w0 -= float(moves[0][0])
        w = w - moves[1] * live
        v = v - moves[2] * live[:, None]
    return w0, w[:n_terms], v[:n_terms]


def first_factors(flat: np.ndarray, lengths: np.ndarray, y: np.ndarray, n_terms: int, rate: float = 0.1, decay: float = 1e-3) -> np.ndarray:
    """Factors of a machine over all terms, by small batches with a step of its own for each term.

    ``flat`` are the terms (0 to ``n_terms``) of all rows, ``lengths`` how many each row has, ``y`` the labels."""
    rng = np.random.default_rng(7)
    starts = np.cumsum(lengths) - lengths
    w, v = np.zeros(n_terms), rng.normal(0, 0.02, (n_terms, FACTORS))
    w0 = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    past_w, past_v, past_0 = np.full(n_terms, 1e-2), np.full(n_terms, 1e-2), 1e-2
    full = np.flatnonzero(lengths > 0)
    for _ in range(FIRST_EPOCHS):
        order = rng.permutation(full)
        for at in range(0, len(order), FIRST_BATCH):
            rows = order[at : at + FIRST_BATCH]
            size = lengths[rows]
            heads = np.cumsum(size) - size
            terms = flat[np.repeat(starts[rows] - heads, size) + np.arange(size.sum())]
            here, place = np.unique(terms, return_inverse=True)
            of_row = np.repeat(np.arange(len(rows)), size)
            own = v[here][place]
            sums = np.add.reduceat(own, heads)
            z = w0 + np.add.reduceat(w[here][place], heads) + 0.5 * ((sums**2).sum(1) - np.add.reduceat((own**2).sum(1), heads))
            slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            each = slope[of_row]
            gw = np.bincount(place, each, len(here)) + decay * w[here]
            gv = np.stack([np.bincount(place, each * (sums[of_row, f] - own[:, f]), len(here)) for f in range(FACTORS)], 1) + decay * v[here]
            past_w[here] += gw * gw
            past_v[here] += (gv * gv).mean(1)
            past_0 += slope.sum() ** 2
            w[here] -= rate * gw / np.sqrt(past_w[here])
            v[here] -= rate * gv / np.sqrt(past_v[here])[:, None]
            w0 -= rate * float(slope.sum()) / past_0**0.5
    return v


def choose(rows: list[np.ndarray], y: np.ndarray, n_terms: int = N_TERMS, n_paired: int = N_PAIRED) -> list[int]:
    """The terms that the machine is fitted to, rising. ``rows``: distinct terms of each text."""
    lengths = np.array([len(r) for r in rows])
    terms, place, n = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    often = n >= MIN_TEXTS
    if not often.any():
        return []
    of_row = np.repeat(np.arange(len(rows)), lengths)
    total, ones = len(y), max(float(y.sum()), 1.0)
    with_one = np.bincount(place, y[of_row], len(terms))
    share = n / total
    gap = with_one / ones - (n - with_one) / max(total - y.sum(), 1.0)
    strength = np.abs(gap) / np.sqrt(share * (1 - share) * (1 / ones + 1 / max(total - y.sum(), 1.0)) + 1e-12)
    alone = np.flatnonzero(often & (strength >= MIN_STRENGTH))
    alone = alone[np.lexsort((terms[alone], -strength[alone]))][:n_terms]
    number = np.cumsum(often) - 1
    kept = often[place]
    v = first_factors(number[place[kept]], np.bincount(of_row[kept], minlength=len(rows)), y, int(often.sum()))
    reach = np.sqrt((v**2).sum(1) * (share * (1 - share))[often])
    paired = np.flatnonzero(often)[np.argsort(-reach, kind="stable")[:n_paired]]
    return sorted(terms[np.union1d(alone, paired)].tolist())


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    n_terms: int = N_TERMS,
) -> Machine:
    """The machine of the labelled rows that are not held out."""
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))
    )
    n_labels = marks.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(2**30)) / 2**30 < F.lit(sample / max(n_labels, 1))

    @F.pandas_udf("array<int>")
    def terms(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Terms()
        for texts in batches:
            yield texts.map(of)

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = texts.where(draw).join(marks.where(draw), "doc_id").select("doc_id", "toxic", terms("text").alias("terms"))
    table = known.orderBy("doc_id", "toxic", F.xxhash64("terms")).select("toxic", "terms").toArrow()
    if not table.num_rows:
        return Machine({}, None, np.zeros(0), np.zeros((0, FACTORS)))
    y = table["toxic"].to_numpy().astype(float)
    rows = [r for chunk in table["terms"].chunks for r in np.split(chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())[:-1])]
    picked = choose(rows, y, n_terms)
    chosen = {t: i for i, t in enumerate(picked)}
    wanted = np.array(picked, np.int64)
    places = [np.flatnonzero(np.isin(wanted, r)).tolist() for r in rows]
    w0, w, v = fit(places, y.astype(int).tolist(), len(chosen))
    return Machine(chosen, w0, w, v)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by the number of terms

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        of = Terms(own.chosen)
        for batch in parts(source):
            scores = [own.score(of(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    slim = rows.mapInArrow(batches, "doc_id bigint, score double")
    return slim.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
