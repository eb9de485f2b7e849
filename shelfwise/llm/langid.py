"""Language identification by words first, then shorter and shorter character n-grams.

A known word scores by its log frequency in each language. An unseen word falls back to its known
n-grams of four letters, else three, two, one (the mean of their log frequencies); a word without any
known letter says nothing. A text's score is the posterior over languages of its mean word score,
counted as at most ``WEIGHT`` words.

Bounds, as parameters: about ``sample`` labelled texts a language (chosen by a hash of the id, all if
there are fewer), the ``n_known_words`` commonest words, the ``n_known_grams`` commonest n-grams, and words
up to ``LONGEST`` letters as words. Prediction reads whole texts.

Edge cases: a null text or one without letters is ``und`` with score 0, as is everything when there is
nothing to learn from; texts in letters never seen get the commonest language with score 1/n; rows
without id, repeated rows and extra columns are treated like any other; an empty table gives none.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import is_held_out, parts

SAMPLE = 2000
N_WORDS = 50_000
N_GRAMS = 100_000
GRAMS = (4, 3, 2, 1)
LONGEST = 64
SMOOTH = 0.5
WEIGHT = 30
CACHE = 100_000
UNKNOWN = "und"


class Model:
    """Score vectors (one number per language) of words and n-grams."""

    def __init__(self, languages: list[str], words: dict[str, list[float]], grams: dict[str, list[float]]):
        self.languages = languages
        self.words, self.grams = words, grams

    def of_word(self, word: str) -> list[float] | None:
        """Scores of one lower-case word; None if nothing in it is known."""
        if (known := self.words.get(word)) is not None:
            return known
        padded = f" {word} "
        for n in GRAMS:
            found = map(self.grams.get, [padded[i : i + n] for i in range(len(padded) - n + 1)])
            if got := [g for g in found if g is not None]:
                return [sum(column) / len(got) for column in zip(*got, strict=True)]
        return None

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores whole texts; keeps the sums of tokens met before, up to ``CACHE`` of them."""

    def __init__(self, model: Model):
        import regex

        self.model = model
        self.letters = regex.compile(r"\p{L}+").findall
        self.rows: dict[str, int] = {}
        self.sums = np.zeros((CACHE, len(model.languages) + 1))

    def of_token(self, token: str) -> list[float]:
        """Summed scores of the words in a token, and their number."""
        words = self.letters(token)
        scored = [s for s in map(self.model.of_word, words) if s is not None]
        sums = scored[0] if len(scored) == 1 else [sum(c) for c in zip(*scored, strict=True)] or [0.0] * len(self.model.languages)
        return [*sums, len(words)]

    def __call__(self, text: str | None) -> tuple[str, float]:
        counts = Counter((text or "").lower().split())
        if len(self.rows) + len(counts) > CACHE:
            self.rows.clear()
        total = np.zeros(len(self.model.languages) + 1)
        places, times = [], []
        for token, n in counts.items():
            at = self.rows.get(token)
            if at is None:
                own = self.of_token(token)
                if len(token) > LONGEST or len(self.rows) >= CACHE:
                    total += n * np.array(own)
                    continue
                at = self.rows[token] = len(self.rows)
                self.sums[at] = own
            places.append(at)
            times.append(n)
        if places:
            total += np.array(times, float) @ self.sums[places]
        n = total[-1]
        if not n or not self.model.languages:
            return UNKNOWN, 0.0
        logits = total[:-1] / n * min(n, WEIGHT)
        odds = np.exp(logits - logits.max())
        best = int(odds.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def _vectors(counted: DataFrame, key: str, most: int, languages: list[str]) -> dict[str, list[float]]:
    """Log frequency by language of the ``most`` commonest keys."""
    spread = counted.groupBy(key).agg(
        F.sum("n").alias("total"), *[F.sum(F.when(F.col("lang") == l, F.col("n")).otherwise(0)).alias(f"l{i}") for i, l in enumerate(languages)]
    )
    rows = spread.orderBy(F.desc("total"), key).limit(most).collect()
    sums = [sum(r[f"l{i}"] for r in rows) + SMOOTH * len(rows) for i in range(len(languages))]
    return {r[key]: [math.log((r[f"l{i}"] + SMOOTH) / s) for i, s in enumerate(sums)] for r in rows}


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    n_known_words: int = N_WORDS,
    n_known_grams: int = N_GRAMS,
) -> Model:
    """The model of the labelled rows that are not held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id"))
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes, key=lambda l: (-sizes[l], l))
    if not languages:
        return Model([], {}, {})
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(2**30)) / 2**30
    share = F.coalesce(*[F.when(F.col("lang") == l, F.lit(sample / sizes[l])) for l in languages])
    words = (
        rows.where(draw < share)
        .select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
        .where(F.char_length("word") <= LONGEST)
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
        .persist()
    )
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    places = lambda n: F.when(F.char_length(padded) >= n, F.sequence(F.lit(1), F.char_length(padded) - n + 1)).otherwise(F.array().cast("array<int>"))
    cut = lambda n: F.transform(places(n), lambda i: F.substring(padded, i, F.lit(n)))
    grams = words.select("lang", "n", F.explode(F.flatten(F.array(*[cut(n) for n in GRAMS]))).alias("gram"))
    known = grams.where(F.col("gram") != " ").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    model = Model(
        languages, _vectors(words, "word", n_known_words, languages), _vectors(known, "gram", n_known_grams, languages)
    )
    words.unpersist()
    return model


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = model or learn(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the numbers of words and n-grams

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in parts(source):
            found = [score(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    judged = rows.mapInArrow(batches, "doc_id bigint, lang_pred string, score double")
    return judged.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, model: Model | None = None, min_lift: float = 1.1) -> DataFrame:
    """``docs`` (with doc_id, text, lang) without those in no known language, each ``lang`` as predicted.

    Rejected are ``und`` and texts whose posterior is not ``min_lift`` times that of a blind guess.
    """
    model = model or learn(docs)
    least = min_lift / len(model.languages) if len(model.languages) > 1 else 0.0
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("lang")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in parts(source):
            found = [score(text) for text in batch.column("text").to_pylist()]
            named = batch.set_column(place, "lang", pa.array([f[0] for f in found], pa.string()))
            yield named.filter(pa.array([f[0] != UNKNOWN and f[1] >= least for f in found], pa.bool_()))

    return docs.mapInArrow(batches, docs.schema)
