"""Ranked lexical search by the Best Position Algorithm.

Scores are sums of whole-number impacts, so results are exact and ties are real ties (smaller id first).

1. One pass over the texts counts every document's terms; of the counts only those of terms that some item may hold are
   kept (a bit table of fixed size passes a superset of them; joins on the terms themselves follow).
2. Documents are dealt into shards of about ``SHARD_POSTINGS`` counts. A task holds one shard at a time: per term a list of
   documents by falling impact, and a look-up from document to place in the list.
3. Items stream past the shards. For each, all lists are read a step deeper in turn; a document met for the first time
   is looked up in every list at once (direct access), which gives its whole score and marks its
   places as seen. The *best position* of a list is the end of its unbroken run of seen places, which direct accesses
   push beyond what was read. No unseen document scores above the sum of the impacts behind the best positions;
   the search ends once that sum is strictly below the k-th score, so ties at the k-th place are never missed.
4. The k best of each shard meet in a window per item, cut to k in every task before the shuffle.

Items are copied once to every shard, in streams: a task never holds more than one of them.

Edge cases: a null or empty text has no term, is counted nowhere and never found; items without a term that occurs have no
rows; rows that share an item id but not the text are searched separately, repeated items once; rows of equal ids are
documents of their own; a null document id comes after all others on ties; fewer than k documents above 0 give
fewer; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import parts, stored

K = 10
SHARD_POSTINGS = 2**20
MOST_TASKS = 10_000
FILTER_BITS = 20
FIRST_STEP = 8
#: A list as long as this share of its shard has a direct table; shorter ones are searched by bisection.
DENSE = 1 / 16

#: Bytes below 0x80 that are no letter or digit separate terms.
_TERMS = bytes.maketrans(*(lambda apart: (apart, b" " * len(apart)))(bytes(b for b in range(128) if not chr(b).isalnum())))
_SPARK_SEED = 42
_COUNTED = "doc_id bigint, n bigint, terms array<string>, counts array<int>"


def term_counts(text: str | None) -> Counter:
    """Occurrences of every term; only A-Z are lower-cased."""
    return Counter((text or "").encode().lower().translate(_TERMS).split())


def term_filter(terms: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A table of ``2 ** bits`` flags, set where a term's hash falls: its size does not depend on the number of terms."""
    places = terms.select(F.pmod(F.xxhash64("term"), F.lit(2**bits)).cast("int").alias("place")).distinct()
    flags = np.zeros(2**bits, bool)
    for row in places.collect():
        flags[row.place] = True
    return flags


def counted(docs: DataFrame, wanted: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (all terms), terms and counts (of wanted terms)."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, known = len(wanted), {}
        for batch in parts(source):
            totals, lengths, terms, counts = [], [0], [], []
            for text in batch.column("text").to_pylist():
                found = term_counts(text)
                totals.append(found.total())
                for term, n in found.items():
                    keep = known.get(term)
                    if keep is None:
                        if len(known) >= 200_000:
                            known.clear()
                        keep = known[term] = bool(wanted[xxhash.xxh64_intdigest(term, _SPARK_SEED) % size])
                    if keep:
                        terms.append(term)
                        counts.append(n)
                lengths.append(len(terms))
            at = pa.array(lengths, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(totals, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(terms, pa.string())),
                    pa.ListArray.from_arrays(at, pa.array(counts, pa.int32())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(batches, _COUNTED)


class Shard:
    """Impact lists of some documents, with direct access."""

    def __init__(self, ids: list[int | None], lengths: np.ndarray, per_doc: np.ndarray, terms: pa.Array, counts: np.ndarray, n: int, total: int):
        given = [i for i in ids if i is not None]
        last = max(given, default=0) + 1
        keys = np.array([last if i is None else i for i in ids], np.int64)
        order = np.argsort(keys, kind="stable")  # documents in the order of ids, null last
        self.ids = [ids[i] for i in order]
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        owner = place[np.repeat(np.arange(len(ids)), per_doc)]
        weighed = 100 - 75 + 75 * lengths[order] * n // total
        count = counts.astype(np.int64)
        impact = 1_000_000_000 * count // (1000 * count + 8 * weighed[owner])
        coded = terms.dictionary_encode()
        code = coded.indices.to_numpy()
        self.number = {t: i for i, t in enumerate(coded.dictionary.to_pylist())}
        by_list = np.lexsort((owner, -impact, code))
        self.docs, self.impacts = owner[by_list].astype(np.int32), impact[by_list]
        self.starts = np.searchsorted(code[by_list], np.arange(len(self.number) + 1))
        self.tables: dict[int, tuple] = {}

    def _places(self, term: int, docs: np.ndarray) -> np.ndarray:
        """Place of each document in the term's list, -1 where it is in none."""
        if term not in self.tables:
            mine = self.docs[self.starts[term] : self.starts[term + 1]]
            if len(mine) >= DENSE * len(self.ids):
                table = np.full(len(self.ids), -1, np.int32)
                table[mine] = np.arange(len(mine))
                self.tables[term] = (table, None)
            else:
                by_doc = np.argsort(mine)
                self.tables[term] = (mine[by_doc], by_doc)
        first, by_doc = self.tables[term]
        if by_doc is None:
            return first[docs]
        at = np.minimum(np.searchsorted(first, docs), len(first) - 1)
        return np.where(first[at] == docs, by_doc[at], -1)

    def best(self, terms: list[str], weights: list[int], k: int) -> tuple[list[int], list[int], int]:
        """Documents (their places) and scores of the k best above 0, and how many documents were looked at."""
        lists = [(self.number[t], w) for t, w in zip(terms, weights, strict=True) if w > 0 and t in self.number]
        starts = [self.starts[t] for t, _ in lists]
        sizes = [self.starts[t + 1] - self.starts[t] for t, _ in lists]
        met = [np.zeros(size, bool) for size in sizes]
        best_position = [0] * len(lists)
        score, seen = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), bool)
        top = np.zeros(0, np.int64)
        read, step = 0, FIRST_STEP
        while lists:
            fresh = np.zeros(len(self.ids), bool)
            for start, size in zip(starts, sizes, strict=True):
                fresh[self.docs[start + min(read, size) : start + min(read + step, size)]] = True
            fresh = np.flatnonzero(fresh & ~seen)
            seen[fresh] = True
            for at, (term, weight) in enumerate(lists):
                place = self._places(term, fresh)
                hit = place >= 0
                place = place[hit]
                score[fresh[hit]] += weight * self.impacts[starts[at] + place]
                met[at][place] = True
            read += step
            step = read
            bound = 0
            for at, (_, weight) in enumerate(lists):
                rest = met[at][best_position[at] :]
                gap = int(rest.argmin()) if len(rest) else 0
                best_position[at] = sizes[at] if not len(rest) or rest[gap] else best_position[at] + gap
                if best_position[at] < sizes[at]:
                    bound += weight * int(self.impacts[starts[at] + best_position[at]])
            top = np.r_[top, score[fresh]]
            if len(top) > k:
                top = np.partition(top, len(top) - k)[-k:]
            if bound == 0 or (len(top) == k and bound < top.min()):
                break
        least = max(1, int(top.min())) if len(top) == k else 1
        docs = np.flatnonzero(score >= least)
        docs = docs[np.lexsort((docs, -score[docs]))][:k]
        return docs.tolist(), score[docs].tolist(), int(seen.sum())


def _searched(rows: DataFrame, k: int, n: int, total: int) -> DataFrame:
    """q, doc_id, score, looked_at: the k best of each item in each shard. Rows are sorted by shard, documents before items."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, number = None, [], None

        def made() -> Shard | None:
            if not held:
                return None
            table = pa.Table.from_batches(held).combine_chunks()
            terms, counts = table["terms"].combine_chunks(), table["values"].combine_chunks()
            return Shard(
                table["id"].to_pylist(), table["n"].to_numpy(), counts.value_lengths().to_numpy(), terms.flatten(), counts.flatten().to_numpy(), n, total
            )

        for batch in batches:
            shards, items = batch.column("shard").to_numpy(), batch.column("is_item").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((shards[1:] != shards[:-1]) | (items[1:] != items[:-1])) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if start == end:
                    continue
                run = batch.slice(start, end - start)
                if shards[start] != number:
                    number, shard, held = shards[start], None, []
                if not items[start]:
                    held.append(run)
                    continue
                if shard is None:
                    shard, held = made(), []
                if shard is None:
                    continue
                queries, ids, scores, looked = [], [], [], []
                for item in run.select(["id", "terms", "values"]).to_pylist():
                    docs, points, work = shard.best(item["terms"], item["values"], k)
                    queries += [item["id"]] * len(docs)
                    ids += [shard.ids[d] for d in docs]
                    scores += points
                    looked += [work] * len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64()), pa.array(looked, pa.int64())],
                    names=["q", "doc_id", "score", "looked_at"],
                )

    return rows.mapInArrow(search, "q bigint, doc_id bigint, score bigint, looked_at bigint")


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """q (a number per different item), item_id, term, times."""
    different = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull()).distinct()
    numbered = stored(different.withColumn("q", F.monotonically_increasing_id()), "items")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lower, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    return numbered.select("q", "item_id", F.explode(found).alias("term")).groupBy("q", "item_id", "term").agg(F.count("*").alias("times"))


def search(
    docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of every item."""
    spark = docs.sparkSession
    asked = stored(item_terms(items, item_col, item_text_col), "item-terms")
    rows = stored(counted(docs, term_filter(asked), id_col, text_col), "counted")
    n, total, postings = rows.agg(
        F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))
    ).first()
    n_shards = max(1, -(-postings // shard_postings))
    df = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(n) + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
    weighed = asked.join(df, "term").groupBy("q").agg(F.collect_list(F.struct("term", (weight * F.col("times")).alias("w"))).alias("t"))

    # Rows are dealt in turn, so shards are even whatever the ids are.
    documents = rows.where(F.size("terms") > 0).select(
        F.pmod(F.monotonically_increasing_id(), F.lit(n_shards)).cast("int").alias("shard"), F.lit(False).alias("is_item"),
        F.col("doc_id").alias("id"), "n", "terms", F.col("counts").cast("array<bigint>").alias("values"),
    )
    to_all = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard")
    queries = weighed.select(
        to_all, F.lit(True).alias("is_item"), F.col("q").alias("id"), F.lit(0).cast("bigint").alias("n"),
        F.col("t.term").alias("terms"), F.col("t.w").alias("values"),
    )
    tasks = min(n_shards, MOST_TASKS)
    dealt = documents.unionByName(queries).repartitionById(tasks, F.pmod("shard", F.lit(tasks)))
    best = _searched(dealt.sortWithinPartitions("shard", "is_item"), k, n, max(total, 1))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asked.select("q", "item_id").distinct()
    return ranked.join(names, "q").select("item_id", "rank", "doc_id", "score")
