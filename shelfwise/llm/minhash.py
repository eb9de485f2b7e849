"""Near-duplicate documents by b-bit MinHash, links confirmed on full shingle sets.

1. Every text's set of ``WIDTH``-word shingles gives ``HASHES`` minima. Bands of ``ROWS`` minima give bucket keys;
   of each minimum only the ``BITS`` low bits are kept, packed into words.
2. Texts with equal sets are one node (the smallest id), so copies cost nothing further.
3. Nodes that share a bucket are candidates (a pair at the threshold is missed once in 10^7). Inside a bucket the
   similarity is estimated from the counts of equal low bits, less what equals by chance, and pairs more than
   five standard deviations below the threshold are dropped. A bucket returns a forest, not its pairs.
4. What these forests connect is compared exactly, set against set, in blocks of bounded size, again returning
   forests. Buckets above ``BUCKET_BLOCK`` nodes and groups above ``SET_BLOCK`` shingles are cut into blocks
   and compared block by block, so no group of copies is ever one task's work, and none is capped.

Edge cases: a null or empty text has an empty set and links with nothing; one with fewer words than
``WIDTH`` has its whole sequence as its only shingle; a null id has no component and is kept; repeated rows
are copies; rows that share an id but not the text have the smallest id of their own text's links; an
empty table gives an empty result; extra columns are ignored, or kept by ``without_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import parts, stored
from shelfwise.llm.graph import components

WIDTH = 4
#: A link has at least so many hundredths of the union in the intersection.
PERCENT = 80
ROWS = 5
BANDS = 40
HASHES = ROWS * BANDS
BITS = 4
WORDS = -(-HASHES * BITS // 64)
BUCKET_BLOCK = 2048
SET_BLOCK = 2**18

_rng = np.random.default_rng(20240229)
FACTORS = _rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
TERMS = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
NIBBLES = np.uint64(0x1111111111111111)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of a text's distinct shingles, sorted. Only A-Z are lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    runs = zip(*[words[i:] for i in range(width)], strict=False) if len(words) >= width else [words]
    found = set(map(xxhash.xxh3_64_intdigest, map(b" ".join, runs)))
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def minima(hashes: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, 2**32 - 1, np.uint32)
    halves = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    for at in range(0, len(halves), 512):
        np.minimum(low, (halves[at : at + 512, None] * FACTORS + TERMS).min(0), out=low)
    return low


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima, sixteen to a word."""
    bits = np.zeros(WORDS * 16, np.uint64)
    bits[:HASHES] = low & np.uint32(15)
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(BITS)
    return (bits.reshape(WORDS, 16) << shifts).sum(1, dtype=np.uint64)


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of one signature to many: equal groups of low bits, corrected for chance collisions."""
    apart = one ^ many
    apart |= apart >> np.uint64(2)
    apart |= apart >> np.uint64(1)
    equal = 1 - np.bitwise_count(apart & NIBBLES).sum(1) / HASHES
    return (equal - 2.0**-BITS) / (1 - 2.0**-BITS)


def least_estimate(percent: int) -> float:
    at = percent / 100
    equal = at + (1 - at) * 2.0**-BITS
    return at - 5 * float(np.sqrt(equal * (1 - equal) / HASHES)) / (1 - 2.0**-BITS)


class Forest:
    """Union of places 0..n-1; the root is the least place."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def _links(nodes: np.ndarray, forest: Forest) -> tuple[list[int], list[int]]:
    roots = [forest.root(i) for i in range(len(nodes))]
    moved = [i for i, r in enumerate(roots) if r != i]
    return [int(nodes[i]) for i in moved], [int(nodes[roots[i]]) for i in moved]


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(start, end - start)
            if end < batch.num_rows:
                yield pa.Table.from_batches([*held, part])
                held = []
            else:
                held.append(part)
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def _edges(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, set_id (digest of the set), signature, bands (bucket keys); the last three null without words."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(source):
            counts, sets, signatures, bands = [], [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingles(text, width)
                counts.append(len(hashes))
                if not len(hashes):
                    sets.append(None), signatures.append(None), bands.append(None)
                    continue
                low = minima(hashes)
                sets.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                signatures.append(packed(low).tobytes())
                rows = low.reshape(BANDS, ROWS)
                bands.append([xxhash.xxh3_64_intdigest(rows[i].tobytes(), seed=i) - 2**63 for i in range(BANDS)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(sets, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_id", "signature", "bands"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(batches, "doc_id bigint, n_shingles bigint, set_id binary, signature binary, bands array<bigint>")


def likely_links(nodes: DataFrame, percent: int = PERCENT, block: int = BUCKET_BLOCK) -> DataFrame:
    """a, b: forests of the nodes that share a bucket and look similar enough. ``nodes``: node, signature, bands."""
    placed = nodes.select("node", F.explode("bands").alias("key"))
    buckets = placed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("most"), F.bit_xor(F.xxhash64("node")).alias("mix")
    )
    # Buckets with the same members are looked at once.
    once = buckets.where(F.col("n") > 1).groupBy("n", "least", "most", "mix").agg(F.min("key").alias("key")).select("key", "n")
    n_blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("node"), n_blocks.cast("bigint")).cast("int")
    # A row meets its own block once and every other block once: pair (i, j) with i <= j.
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    rows = (
        placed.join(once, "key")
        .withColumn("n_blocks", n_blocks)
        .withColumn("mine", mine)
        .withColumn("other", other)
        .select("node", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine")
        .join(nodes.select("node", "signature"), "node")
    )
    least = least_estimate(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["key", "i", "j"]):
            if group.num_rows < 2:
                continue
            group = group.sort_by("node")
            nodes_, signatures = group["node"].to_numpy(), np.frombuffer(b"".join(group["signature"].to_pylist()), "<u8").reshape(-1, WORDS)
            forest = Forest(len(nodes_))
            for at in range(len(nodes_) - 1):
                for hit in np.flatnonzero(estimate(signatures[at], signatures[at + 1 :]) >= least):
                    forest.join(at, at + 1 + int(hit))
            yield _edges(*_links(nodes_, forest))

    spread = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return spread.select("key", "i", "j", "node", "signature").mapInArrow(compare, "a bigint, b bigint").distinct()


def linked(sets: list[np.ndarray], n_first: int, percent: int, forest: Forest) -> None:
    """Joins all pairs of sets that reach the threshold; with ``n_first`` > 0 only pairs across that place."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    values, who = flat[order], owner[order]
    heads = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    lengths = np.diff(np.r_[heads, len(values)])
    run = np.empty(len(flat), np.int64)
    run[order] = np.repeat(np.arange(len(heads)), lengths)
    starts = np.cumsum(np.r_[0, sizes[:-1]])
    for at in range(n_first or len(sets)):
        mine = run[starts[at] : starts[at] + sizes[at]]
        mine = mine[lengths[mine] > 1]
        if not len(mine):
            continue
        span = lengths[mine]
        places = np.repeat(heads[mine] - np.r_[0, np.cumsum(span)[:-1]], span) + np.arange(span.sum())
        common = np.bincount(who[places], minlength=len(sets))
        from_ = n_first or at + 1
        inter = common[from_:]
        union = sizes[at] + sizes[from_:] - inter
        for hit in np.flatnonzero(100 * inter >= percent * union):
            forest.join(at, from_ + int(hit))


def confirmed_links(docs: DataFrame, groups: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = SET_BLOCK) -> DataFrame:
    """a, b: forests of exact links inside each group. ``docs``: doc_id, text; ``groups``: node, component, n_shingles."""
    sized = groups.groupBy("component").agg(F.sum("n_shingles").alias("total"))
    n_blocks = F.ceil(F.col("total") / block).cast("int")
    mine = F.pmod(F.xxhash64("node"), n_blocks.cast("bigint")).cast("int")
    rows = stored(
        groups.join(sized, "component").select("node", "component", n_blocks.alias("n_blocks"), mine.alias("mine")), "groups"
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            made = [shingles(t, width).tobytes() for t in batch.column("text").to_pylist()]
            names = ["node", "component", "n_blocks", "mine"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(made, pa.binary())], names=[*names, "set"])

    # The ids grow with the corpus, so they are merged with the texts at every size, never broadcast.
    texts = docs.join(rows.hint("merge"), docs["doc_id"] == rows["node"]).select("node", "component", "n_blocks", "mine", "text")
    full = texts.mapInArrow(sets, "node bigint, component bigint, n_blocks int, mine int, set binary")
    met = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "component", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "set"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["component", "i", "j"]):
            if group.num_rows < 2:
                continue
            group = group.sort_by([("mine", "ascending"), ("node", "ascending")])
            of, nodes_ = group["mine"].to_numpy(), group["node"].to_numpy()
            across = int((of == of[0]).sum()) % len(of)  # all in one block: 0, every pair
            forest = Forest(len(nodes_))
            linked([np.frombuffer(s, np.uint64) for s in group["set"].to_pylist()], across, percent, forest)
            yield _edges(*_links(nodes_, forest))

    spread = met.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return spread.mapInArrow(compare, "a bigint, b bigint").distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(sketches(slim, width=width), "sketches")
    of_set = rows.where(F.col("set_id").isNotNull() & F.col("doc_id").isNotNull()).groupBy("set_id")
    first = F.min_by(F.struct("signature", "bands", "n_shingles"), "doc_id").alias("own")
    nodes = stored(of_set.agg(F.min("doc_id").alias("node"), first).select("set_id", "node", "own.*"), "nodes")
    likely = components(likely_links(nodes, percent))
    sizes = nodes.groupBy("node").agg(F.sum("n_shingles").alias("n_shingles"))
    groups = stored(likely.join(sizes, "node"), "likely")
    found = components(confirmed_links(slim, groups, width, percent))
    named = nodes.select("set_id", "node").join(found, "node", "left").select("set_id", F.coalesce("component", "node").alias("component"))
    with_words = rows.where(F.col("set_id").isNotNull() & F.col("doc_id").isNotNull()).join(named, "set_id")
    alone = rows.where(F.col("set_id").isNull() | F.col("doc_id").isNull()).withColumn("component", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", F.col("component").alias("component_id")]
    return with_words.select(*columns).unionByName(alone.select(*columns)).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id, once. Rows without id all stay."""
    kept = classes(docs, id_col, text_col, width, percent).where("kept").groupBy("doc_id").agg(F.count("*").alias("n"))
    kept = stored(kept, "kept").withColumnRenamed("doc_id", id_col).hint("merge")
    with_id = docs.where(F.col(id_col).isNotNull())
    single = with_id.join(kept.where("n = 1"), id_col, "left_semi")
    repeated = with_id.join(kept.where("n > 1"), id_col, "left_semi").dropDuplicates([id_col])  # usually none
    return single.unionByName(repeated).select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
