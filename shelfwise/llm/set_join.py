"""Near-duplicate classes by an exact Jaccard join of shingle sets over a token-group matrix.

Texts with equal sets are one node, so copies cost nothing further. Sets that overlap enough to link differ in few shingles:
of a set ``q`` and one at least as large, at most ``misses(q)`` shingles of ``q`` are missing in the other. So:

1. **Kin.** Nodes with the same lowest or highest shingle are compared exactly, in chunks of about ``CHUNK`` shingles. Where a
   key fills several chunks, only one node of each linked piece goes on to the next level, so a large group of near copies
   is connected in passes over a falling number of nodes, never pair by pair.
2. **Leaders.** Of the nodes that share a frequent token, the one with the smallest share of tokens of its own leads. Nodes
   that must look the token up are compared with its leader, one pair each: copies that were each edited
   elsewhere link to what they were made from rather than to one another.
3. **Groups.** Linked nodes form groups of their own; the others are grouped by lowest shingle and size. Groups have bounded
   chunks too. The matrix (token, group) holds the union of each group's tokens, with its smallest and
   largest set. Small sets give all shingles as tokens, larger ones those in the lowest part of the hash range.
   Nodes that look up a frequent token and the holders of what they look up form the crowd, with groups of its own: by full sets
   most of it is ruled out, and the rest is grouped by the most frequent looked-up token, so that texts from one source lie together.
4. **Queries.** Any ``misses + 1`` tokens of a node must lead to each of its partners, so the rarest are looked up in the matrix,
   first which classes or buckets of nodes without kin hold them, then which of their groups. The rarest token that two partners share is also
   among the rarest ``spare + 1`` of the larger one, so the matrix holds only those. A node whose own tokens
   occur nowhere else looks up nothing. The few nodes with too few tokens look up their whole sets.
5. **Bound.** A group is opened only if the query's tokens that its union lacks are few enough; then the tokens that it shares with
   each member are counted. Of small sets these are all shingles, so their links are known here.
6. **Verification.** Larger queries that may link to some member meet the group again, both with full sets from the texts. Every
   member is counted inside the task and only links that connect classes leave it: rows grow with the queries' groups,
   not with the pairs of a large group of texts that are nearly, but not quite, alike.

Tables that no later step reads are removed at once, so the disk holds the tokens twice or three times at most.

Edge cases: a null or empty text has an empty set and links with nothing; one with fewer words than the width has its
whole sequence as its only shingle; a null id has no class; repeated rows are copies; an id that comes with several
texts links to what any of them links to, where their sets differ in size; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import discard, parts, stored
from shelfwise.llm.graph import components
from shelfwise.llm.minhash import Forest, linked, shingles

WIDTH = 5
#: A link has at least so many hundredths of the union in the intersection.
PERCENT = 80
#: Shingles of a chunk or group; each member counts for MEMBER more.
CHUNK = 2**17
MEMBER = 64
#: Sets up to this size have all shingles as tokens, others those whose hash is below 2^(64 - TOKEN_BITS).
SMALL = 256
TOKEN_BITS = 2
#: Average members of a group of nodes without kin.
GROUP = 64
#: Queries that one task's index of a group answers.
QUERIES = 1024
#: Tokens of more nodes than these have a leader.
LEAD_FROM = 16

_LINKS = "a bigint, b bigint"


def least_common(sizes: Column | np.ndarray | int, percent: int):
    """Shingles that two sets of this total size must have in common."""
    return -((-percent * sizes) // (100 + percent))


def _misses(size: Column, percent: int) -> Column:
    return F.floor(size * (100 - percent) / (100 + percent)).cast("int")


def _spare(size: Column, percent: int) -> Column:
    """Shingles of a set that a linked one of at most its size may lack."""
    return F.floor(size * (100 - percent) / 100).cast("int")


def sketches(docs: DataFrame, width: int, small: int, token_bits: int) -> DataFrame:
    """doc_id, n_shingles, set_id, low, high (end hashes), tokens; the last four null without words."""
    limit = np.uint64(2 ** (64 - token_bits) - 1)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(source):
            counts, sets, lows, highs, tokens = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingles(text, width)
                counts.append(len(hashes))
                if not len(hashes):
                    sets.append(None), lows.append(None), highs.append(None), tokens.append(None)
                    continue
                whole = hashes.view(np.int64)
                sets.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                lows.append(whole[0])
                highs.append(whole[-1])
                tokens.append(whole if len(hashes) <= small else whole[: np.searchsorted(hashes, limit, "right")])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts, pa.int32()), pa.array(sets, pa.binary()),
                    pa.array(lows, pa.int64()), pa.array(highs, pa.int64()), pa.array(tokens, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_id", "low", "high", "tokens"],
            )

    return docs.mapInArrow(batches, "doc_id bigint, n_shingles int, set_id binary, low bigint, high bigint, tokens array<bigint>")


def full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """The columns of ``nodes`` (node and others) with ``set``, the full hashes of the node's texts."""
    names = nodes.columns

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(source):
            made = [shingles(t, width).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(made, pa.binary())], names=[*names, "set"])

    # Nodes grow with the corpus, so they are merged with the texts at every size, never broadcast.
    texts = docs.join(nodes.hint("merge"), docs["doc_id"] == nodes["node"]).select(*names, "text")
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return texts.mapInArrow(batches, f"{layout}, set binary")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        if not batch.num_rows:
            continue
        change = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[start] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _chunks(rows: DataFrame, key: str, chunk: int, level: int) -> DataFrame:
    """Adds ``chunks`` (how many the key has) and ``chunk``; drops keys of one node."""
    sized = rows.groupBy(key).agg(F.count("*").alias("n"), F.sum(F.col("size") + MEMBER).alias("total")).where("n > 1")
    counted = sized.select(key, F.ceil(F.col("total") / chunk).cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64("node", F.lit(level)), F.col("chunks").cast("bigint")).cast("int")
    return rows.join(counted, key).withColumn("chunk", mine)


def kin_links(docs: DataFrame, nodes: DataFrame, width: int, percent: int, chunk: int = CHUNK) -> list[DataFrame]:
    """Stored tables (a, b) of exact links between nodes that share their lowest or highest shingle."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["key", "chunk"]):
            group = group.sort_by("node")
            names = group["node"].to_numpy()
            forest = Forest(len(names))
            linked([np.frombuffer(s, np.uint64) for s in group["set"].to_pylist()], 0, percent, forest)
            roots = names[[forest.root(i) for i in range(len(names))]]
            moved = np.flatnonzero(roots != names)
            key = group["key"].to_numpy()[moved]
            yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(roots[moved]), pa.array(key)], names=["a", "b", "key"])

    ends = F.explode(F.array_distinct(F.array("low", "high"))).alias("key")
    open_ = nodes.select("node", "size", ends)
    found, level = [], 0
    while True:
        groups = stored(_chunks(open_, "key", chunk, level), "kin")
        if groups.isEmpty():
            return found
        sets = full_sets(docs, groups.select("node", "key", "chunk"), width).repartition("key", "chunk")
        found.append(stored(sets.sortWithinPartitions("key", "chunk").mapInArrow(compare, f"{_LINKS}, key bigint"), "kin-links"))
        wide = groups.where("chunks > 1")
        moved = found[-1].select(F.col("a").alias("node"), "key").distinct()
        open_ = stored(wide.join(moved, ["node", "key"], "left_anti").select("node", "size", "key"), "kin-next")
        before, after = wide.count(), open_.count()
        # Keys whose nodes hardly link are no groups of copies; the matrix finds the rest.
        if 2 * after > before:
            return found
        level += 1


def _whole(percent: int, small: int) -> Column:
    """Whether a node's tokens are all shingles, of each of its larger partners too."""
    return 100 * F.col("size") <= percent * small


def _is_low(token: Column, token_bits: int) -> Column:
    return (token >= 0) & (token < 2 ** (64 - token_bits)) if token_bits else F.lit(True)


def reached(nodes: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """``nodes`` (node, size, n_tokens) with ``reach``, the size of the largest set, up to its own, that a node may link to as the larger.

    Tokens of one node alone are missing in every other: with ``u`` of them at most ``size - u`` shingles are common."""
    n_shared = shared.groupBy("node", "size").agg(F.count("*").alias("n_shared"))
    alone = F.col("n_tokens") - F.coalesce("n_shared", F.lit(0))
    reach = F.floor((100 + percent) * (F.col("size") - alone) / percent) - F.col("size")
    return nodes.join(n_shared, ["node", "size"], "left").withColumn("reach", F.least("size", reach).cast("int")).drop("n_shared", "n_tokens")


def crowd(lookups: DataFrame, shared: DataFrame, wide: DataFrame) -> DataFrame:
    """node, size, home of all nodes that hold a token which a node of ``wide`` looks up; ``home`` is the node's most frequent one of these tokens.

    A node holds what it looks up, so those of ``wide`` and all that they may find are in it."""
    sought = lookups.join(wide, "node", "left_semi").select("token").distinct()
    home = F.max_by("token", F.struct("df", "token")).alias("home")
    found = shared.join(sought, "token", "left_semi").groupBy("node", "size").agg(home, F.max("holds").alias("holds"))
    return found.where("holds").drop("holds")


def alone_by_full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """node, size, alone of ``nodes`` (node, size): how many shingles of the full set no other of these nodes has.

    It is 0 for an id with several sets of one size, which are not told apart."""
    sets = full_sets(docs, nodes.select("node").distinct(), width).where(F.length("set") > 0)
    sets = stored(sets.withColumn("size", (F.length("set") / 8).cast("int")), "crowd-sets")
    mark = F.xxhash64("set")
    single = sets.groupBy("node", "size").agg((F.min(mark) == F.max(mark)).alias("single"))
    ends = [f(c).alias(f"{name}_{c}") for c in ("node", "size") for name, f in (("min", F.min), ("max", F.max))]
    of_token = sets.mapInArrow(_spread, "node bigint, size int, token bigint").groupBy("token").agg(*ends)
    own = of_token.where("min_node = max_node AND min_size = max_size").groupBy(F.col("min_node").alias("node"), F.col("min_size").alias("size"))
    found = single.join(own.agg(F.count("*").alias("n")), ["node", "size"], "left")
    found = stored(found.select("node", "size", F.when(F.col("single"), F.coalesce("n", F.lit(0))).otherwise(0).alias("alone")), "alone")
    discard(sets)
    return found


def crowd_groups(docs: DataFrame, groups: DataFrame, members: DataFrame, width: int, percent: int, chunk: int = CHUNK) -> DataFrame:
    """``groups`` of the ``members`` (node, size, home) of the crowd alone, with ``asks``, whether a node may link to any in it as the smaller.

    Kin lie together, the others by their homes; ``reach`` is that within the crowd, by full sets."""
    alone = alone_by_full_sets(docs, members, width)
    reach = F.floor((100 + percent) * (F.col("size") - F.col("alone")) / percent) - F.col("size")
    rows = groups.drop("family", "group").join(members, ["node", "size"]).join(alone, ["node", "size"])
    rows = rows.withColumn("reach", F.least("reach", reach).cast("int")).withColumn("asks", F.col("alone") <= _misses(F.col("size"), percent))
    rows = rows.join(rows.groupBy("class").agg((F.count("*") > 1).alias("kin")), "class")
    family = F.when(F.col("kin"), F.xxhash64(F.lit("crowd kin"), "class")).otherwise(F.xxhash64(F.lit("crowd home"), "home"))
    return _in_chunks(rows.withColumn("family", family), chunk, "asks")


def _in_chunks(rows: DataFrame, chunk: int, *more: str) -> DataFrame:
    """node, size, reach, class, family, group: families in chunks of about ``chunk`` shingles."""
    counted = rows.groupBy("family").agg(F.ceil(F.sum(F.col("size") + MEMBER) / chunk).alias("chunks"))
    mine = F.pmod(F.xxhash64("node"), F.col("chunks"))
    return rows.join(counted, "family").select("node", "size", "reach", "class", "family", F.xxhash64("family", mine).alias("group"), *more)


def grouped(nodes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """node, size, reach, class, family, group: families are kin by class, the others by lowest shingle and size; groups are their chunks."""
    alone = F.count("*").over(Window.partitionBy("class"))
    sizes = nodes.groupBy("class").agg((F.count("*") > 1).alias("kin"))
    n_alone = sizes.where("NOT kin").count()
    bucket = F.pmod(F.xxhash64("low", F.floor(F.log2(F.col("size")) * 4)), F.lit(max(1, n_alone // GROUP)))
    family = F.when(F.col("kin"), F.xxhash64("class")).otherwise(F.xxhash64(F.lit("alone"), bucket))
    return _in_chunks(nodes.join(sizes, "class").withColumn("family", family), chunk)


def ranked_tokens(nodes: DataFrame, percent: int, small: int, token_bits: int) -> DataFrame:
    """node, size, token, df, usable, n_usable of the tokens that several nodes have, with ``asks`` (one of the rarest, that the node
    must look up) and ``holds`` (one of the rarest, by which smaller partners find the node).

    Both follow one order of all tokens. Sets that a node may be asked for by all tokens and by low ones hold the rarest of either."""
    tokens = nodes.select("node", "size", F.explode("tokens").alias("token"))
    df = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    # Most tokens are of one node only; what else is known of a node is joined to the few that are left.
    known = nodes.groupBy("node", "size").agg(
        F.max("n_usable").alias("n_usable"), F.max(F.size("tokens")).alias("n_tokens"), (F.count("*") > 1).alias("twins")
    )
    common = tokens.join(df, "token").join(known, ["node", "size"])
    common = common.withColumn("usable", _whole(percent, small) | _is_low(F.col("token"), token_bits))
    of_node = Window.partitionBy("node", "size")
    order = of_node.orderBy("df", "token")
    is_usable = F.col("usable").cast("int")
    place = F.sum(is_usable).over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("n_usable") - F.sum(is_usable).over(of_node)
    place_of_all = F.row_number().over(order) + F.col("n_tokens") - F.count("*").over(of_node)
    placed = common.withColumn("place", place).withColumn("place_of_all", place_of_all)
    most = _spare(F.col("size"), percent) + 1
    # Sets of one id and size are told apart nowhere below, so all of their tokens count.
    asks = F.col("usable") & (F.col("twins") | (F.col("place") <= _misses(F.col("size"), percent) + 1))
    holds = F.col("twins") | (F.col("usable") & (F.col("place") <= most)) | ((F.col("size") <= small) & (F.col("place_of_all") <= most))
    return placed.select("node", "size", "token", "df", "usable", "n_usable", asks.alias("asks"), holds.alias("holds"))


def led(lookups: DataFrame, shared: DataFrame, named: DataFrame, percent: int, lead_from: int = LEAD_FROM) -> DataFrame:
    """q, s: looking-up nodes with the leaders of their frequent tokens, of another class and a fitting size."""
    often = shared.where(F.col("df") > lead_from)
    own = shared.where("usable").groupBy("node", "size").agg(F.count("*").alias("n_shared"))
    central = (F.col("n_usable") - F.coalesce("n_shared", F.lit(0))) / F.col("size")
    leader = F.min_by(F.struct("node", "size"), F.struct(central.alias("own"), F.col("node").alias("n"))).alias("leader")
    leaders = often.join(own, ["node", "size"], "left").groupBy("token").agg(leader).select("token", F.col("leader.node").alias("s"), F.col("leader.size").alias("s_size"))
    fits = F.least("size", "s_size") * 100 >= F.greatest("size", "s_size") * percent
    met = lookups.join(leaders, "token").where((F.col("node") != F.col("s")) & fits).select(F.col("node").alias("q"), "s").distinct()
    of = named.select("node", "class")
    return (
        met.join(of.select(F.col("node").alias("q"), F.col("class").alias("c")), "q")
        .join(of.select(F.col("node").alias("s"), F.col("class").alias("d")), "s")
        .where("c <> d")
        .select("q", "s")
    )


def candidates(lookups: DataFrame, tokens: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Stored node, group: queries and the groups with other classes that hold one of their looked-up tokens and a set that reaches their size."""
    # Sets that can link to none as the larger one are in no group's union.
    of = groups.where(F.col("reach") * 100 >= F.col("size") * percent).select("node", "size", "reach", "class", "family", "group")
    held = [("least", F.min, "size"), ("most", F.max, "reach"), ("first", F.min, "class"), ("last", F.max, "class")]
    matrix = tokens.select("node", "size", "token").join(of, ["node", "size"]).groupBy("token", "family", "group")
    matrix = stored(matrix.agg(*(f(of_member).alias(name) for name, f, of_member in held)), "matrix")
    asked = lookups.join(groups.select("node", F.col("class").alias("own")).distinct(), "node")
    fits = (F.col("most") >= F.col("size")) & (F.col("least") * percent <= F.col("size") * 100)
    fits &= (F.col("first") != F.col("own")) | (F.col("last") != F.col("own"))
    # Which families first: a class of many groups that a token's own class is never fans out, and nodes without kin are met by
    # the bucket, not one by one, so a token of many such nodes makes no row for each two of them.
    by_family = matrix.groupBy("token", "family").agg(*(f(name).alias(name) for name, f, _ in held))
    families = asked.join(by_family, "token").where(fits).select("node", "size", "own", "token", "family")
    found = stored(families.join(matrix, ["token", "family"]).where(fits).select("node", "group").distinct(), "asked")
    discard(matrix)
    return found


def _dealt(groups: DataFrame, asked: DataFrame, percent: int, queries: int = QUERIES) -> DataFrame:
    """node, size, class, group, piece, is_query: the asked groups' members, and their queries in pieces of about ``queries``.

    Members are repeated for each piece: so many queries outweigh the members of a group, which are bound by its chunk."""
    pieces = asked.groupBy("group").agg(F.ceil(F.count("*") / queries).cast("int").alias("pieces"))
    piece = F.pmod(F.xxhash64("node", "group"), F.col("pieces")).cast("int")
    of = groups.select("node", "size", "class").distinct()
    asking = asked.join(pieces, "group").withColumn("piece", piece).join(of, "node").withColumn("is_query", F.lit(True))
    # Sets that can link to none as the larger one are members of no group.
    can = groups.where(F.col("reach") * 100 >= F.col("size") * percent).join(pieces, "group")
    members = can.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("is_query", F.lit(False))
    columns = ["node", "size", "class", "group", "piece", "is_query"]
    return members.select(*columns).unionByName(asking.select(*columns))


def _compared(rows: DataFrame, percent: int, small: int, token_bits: int) -> DataFrame:
    """node, other, group: links of queries (``rows`` with ``tokens``) and members, no more than connect their classes; ``other`` is null
    where tokens cannot tell whether the query links to any in the group."""
    limit = 2 ** (64 - token_bits)

    def low(tokens: np.ndarray) -> np.ndarray:
        return tokens[(tokens >= 0) & (tokens.astype(np.uint64) < np.uint64(limit))] if token_bits else tokens

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, index, joined = None, [], None, {}
        for run in _pieces(batches):
            key = (run.column("group")[0].as_py(), run.column("piece")[0].as_py())
            if key != number:
                number, held, index, joined = key, [], None, {}
            if not run.column("is_query")[0].as_py():
                held.append(run)
                continue
            if not held:
                continue
            index = index or _Index(held, low)
            for part in parts([run]):
                found = index.pairs(part, percent, small, low)
                sure = found.column("sure").to_numpy(zero_copy_only=False)
                maybe = np.unique(found.column("q").to_numpy()[~sure])
                links = _connecting(found.filter(found.column("sure")), joined)
                nodes = pa.array([*(q for q, _ in links), *maybe.tolist()], pa.int64())
                others = pa.array([*(s for _, s in links), *[None] * len(maybe)], pa.int64())
                yield pa.RecordBatch.from_arrays([nodes, others, pa.array([key[0]] * len(nodes), pa.int64())], names=["node", "other", "group"])

    dealt = rows.repartition("group", "piece").sortWithinPartitions("group", "piece", "is_query")
    return dealt.mapInArrow(compare, "node bigint, other bigint, group bigint")


def _connecting(pairs: pa.RecordBatch, joined: dict[int, int]) -> list[tuple[int, int]]:
    """q, s of the linked pairs that connect classes which ``joined``, the links so far, leaves apart."""

    def root(i: int) -> int:
        while (up := joined.get(i, i)) != i:
            joined[i] = joined.get(up, up)
            i = up
        return i

    links = []
    for q, s, c, d in zip(*(pairs.column(n).to_pylist() for n in ("q", "s", "q_class", "s_class")), strict=True):
        c, d = root(c), root(d)
        if c != d:
            joined[max(c, d)] = min(c, d)
            links.append((q, s))
    return links


def opened(nodes: DataFrame, groups: DataFrame, asked: DataFrame, percent: int, small: int, token_bits: int) -> DataFrame:
    """node, other, group by tokens: links of small sets; with a null ``other`` the groups in which a larger one may have a link."""
    sets = nodes.select("node", "size", "tokens")
    return _compared(_dealt(groups, asked, percent).join(sets, ["node", "size"]), percent, small, token_bits)


def confirmed(docs: DataFrame, groups: DataFrame, asked: DataFrame, width: int, percent: int) -> DataFrame:
    """Stored a, b: links of the queries ``asked`` (node, group) with their groups' members, by full sets.

    A query meets a group once, whatever the number of members that are nearly like it."""
    rows = _dealt(groups, asked, percent)
    sets = full_sets(docs, rows.select("node").distinct(), width).where(F.length("set") > 0)
    sets = stored(sets.select("node", (F.length("set") / 8).cast("int").alias("size"), F.col("set").alias("tokens")), "full-sets")
    # With whole sets as tokens, counts are exact at every size.
    compared = _compared(rows.drop("size").join(sets.hint("merge"), "node"), percent, 2**31, 0)
    found = stored(compared.select(F.col("node").alias("a"), F.col("other").alias("b")), "full-links")
    discard(sets)
    return found


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of one group's piece and one kind of row."""
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("group", "piece", "is_query")]
        change = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start < end:
                yield batch.slice(start, end - start)


def _arrays(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """Token lists, or full sets as bytes."""
    if pa.types.is_binary(column.type):
        return [np.frombuffer(s, np.int64) for s in column.to_pylist()]
    return [np.array(t, np.int64) for t in column.to_pylist()]


class _Index:
    """A group: its members' tokens by token, their union, sizes and classes."""

    def __init__(self, held: list[pa.RecordBatch], low):
        table = pa.Table.from_batches(held)
        self.names, self.sizes, self.classes = (table[c].to_numpy() for c in ("node", "size", "class"))
        sets = _arrays(table["tokens"])
        self.n_all, self.n_low = np.array([len(s) for s in sets]), np.array([len(low(s)) for s in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], np.repeat(np.arange(len(sets)), self.n_all)[order]
        self.union, self.heads = np.unique(self.flat, return_index=True)
        self.ends = np.r_[self.heads[1:], len(self.flat)]

    def pairs(self, run: pa.RecordBatch, percent: int, small: int, low) -> pa.RecordBatch:
        columns = [*(run.column(c).to_pylist() for c in ("node", "size", "class")), _arrays(run.column("tokens"))]
        out: list[tuple[np.ndarray, ...]] = []
        for node, size, class_, mine in zip(*columns, strict=True):
            whole = 100 * size <= percent * small
            mine = mine if whole else low(mine)
            fits = (self.sizes >= size) & (self.sizes * percent <= size * 100) & (self.classes != class_)
            if not fits.any():
                continue
            at = np.searchsorted(self.union, mine)
            held = at < len(self.union)
            held[held] = self.union[at[held]] == mine[held]
            # The bound: what the union lacks, no member has.
            if len(mine) - held.sum() > size - least_common(size + self.sizes[fits].min(), percent):
                continue
            at = at[held]
            span = self.ends[at] - self.heads[at]
            places = np.repeat(self.heads[at] - np.cumsum(span) + span, span) + np.arange(span.sum())
            common = np.bincount(self.owner[places], minlength=len(self.names))
            need = least_common(size + self.sizes, percent)
            theirs = self.n_all if whole else self.n_low
            hit = np.flatnonzero(fits & (len(mine) - common <= size - need) & (theirs - common <= self.sizes - need))
            out.append((np.full(len(hit), node), self.names[hit], np.full(len(hit), class_), self.classes[hit], np.full(len(hit), whole)))
        joined = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, bool)]
        kinds = [pa.int64()] * 4 + [pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(joined, kinds, strict=True)], names=["q", "s", "q_class", "s_class", "sure"]
        )


def verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """a, b of the pairs (q, s) that link, by their full sets."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            one, two = ([np.frombuffer(s, np.uint64) for s in batch.column(c).to_pylist()] for c in ("set", "other"))
            links = []
            for x, y in zip(one, two, strict=True):
                inter = len(np.intersect1d(x, y, assume_unique=True))
                links.append(100 * inter >= percent * (len(x) + len(y) - inter))
            kept = batch.filter(pa.array(links, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("q"), kept.column("s")], names=["a", "b"])

    pairs = pairs.select("q", "s").distinct()
    involved = pairs.select(F.explode(F.array("q", "s")).alias("node")).distinct()
    sets = stored(full_sets(docs, involved, width), "pair-sets")
    first = pairs.join(sets.hint("merge"), pairs["q"] == sets["node"]).select("q", "s", "set")
    other = sets.select(F.col("node").alias("s"), F.col("set").alias("other"))
    found = stored(first.join(other.hint("merge"), "s").select("q", "s", "set", "other").mapInArrow(exact, _LINKS), "pair-links")
    discard(sets)
    return found


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, size, token of each shingle in ``set``."""
    for batch in parts(batches):
        sets = [np.frombuffer(s, np.int64) for s in batch.column("set").to_pylist()]
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node").take(pa.array(rows)), batch.column("size").take(pa.array(rows)), pa.array(flat)], names=["node", "size", "token"]
        )


def _whole_lookups(docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Look-ups of nodes with too few tokens by all their shingles, and those shingles where other nodes have them."""

    all_ = full_sets(docs, nodes.select("node", "size"), width).mapInArrow(_spread, "node bigint, size int, token bigint")
    short = nodes.where("short").select("node", "size")
    mine = stored(full_sets(docs, short, width).mapInArrow(_spread, "node bigint, size int, token bigint"), "short-tokens")
    return mine, stored(all_.join(mine.select("token").distinct(), "token", "left_semi").select("node", "size", "token"), "short-matrix")


def _named(nodes: DataFrame, links: list[DataFrame]) -> DataFrame:
    """``nodes`` with ``class``, the least node that links lead to."""
    if not links:
        return nodes.withColumn("class", F.col("node"))
    found = components(reduce(DataFrame.unionByName, [x.select("a", "b") for x in links]))
    return nodes.join(found, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component")


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT,
    chunk: int = CHUNK, small: int = SMALL, token_bits: int = TOKEN_BITS,
) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    whole_rows = stored(sketches(slim, width, small, token_bits), "set-sketches")
    has_set = F.col("set_id").isNotNull() & F.col("doc_id").isNotNull()
    of_set = whole_rows.where(has_set).groupBy("set_id").agg(
        F.min("doc_id").alias("node"), F.any_value("n_shingles").alias("size"), F.any_value("low").alias("low"),
        F.any_value("high").alias("high"), F.any_value("tokens").alias("tokens"),
    )
    n_usable = F.when(_whole(percent, small), F.size("tokens")).otherwise(F.size(F.filter("tokens", lambda t: _is_low(t, token_bits))))
    nodes = stored(
        of_set.withColumn("n_usable", n_usable).withColumn("short", F.col("n_usable") <= _misses(F.col("size"), percent)), "set-nodes"
    )
    rows = stored(whole_rows.select("doc_id", "n_shingles", "set_id"), "set-rows")
    discard(whole_rows)
    named = rows.where(has_set)
    # An id with several texts links their nodes.
    by_id = named.select("doc_id", "set_id").join(nodes.select("set_id", "node"), "set_id").groupBy("doc_id")
    same_id = by_id.agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("a", "b")
    links = [stored(same_id, "same-id"), *kin_links(slim, nodes, width, percent, chunk)]

    shared = stored(ranked_tokens(nodes, percent, small, token_bits), "shared-tokens")
    lookups = shared.where("asks").select("node", "size", "token")
    sized = stored(reached(nodes.select("node", "size", "low", F.size("tokens").alias("n_tokens")), shared, percent), "set-sizes")
    to_leaders = stored(led(lookups, shared, _named(sized, links), percent), "to-leaders")
    if not to_leaders.isEmpty():
        links.append(verified(slim, to_leaders, width, percent))
    groups = stored(grouped(_named(sized, links), chunk), "set-groups")
    held = shared.where("holds")
    wide = stored(shared.where(F.col("asks") & (F.col("df") > LEAD_FROM)).select("node").distinct(), "wide")
    asked, crowded = candidates(lookups.join(wide, "node", "left_anti"), held, groups, percent), None
    if not wide.isEmpty():
        members = stored(crowd(lookups, shared, wide), "crowd")
        crowded = stored(crowd_groups(slim, groups, members, width, percent, chunk), "crowd-groups")
        asking = crowded.join(wide, "node", "left_semi").where("asks").select("node", "size").distinct()
        crowded = crowded.drop("asks")
        asked = asked.unionByName(candidates(lookups.join(asking, ["node", "size"]), held, crowded, percent))
    discard(shared)
    if not nodes.where("short").isEmpty():
        whole = _whole_lookups(slim, nodes, width, percent)
        asked = asked.unionByName(candidates(*whole, groups, percent)).distinct()
        discard(*whole)
    groups = groups if crowded is None else groups.unionByName(crowded)
    met = stored(opened(nodes, groups, asked, percent, small, token_bits), "met")
    of_sets = stored(nodes.select("set_id", "node"), "set-names")
    discard(nodes)
    links.append(met.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    unsure = met.where("other IS NULL").select("node", "group").distinct()
    if not unsure.isEmpty():
        links.append(confirmed(slim, groups, unsure, width, percent))
    found = _named(of_sets, links).select("set_id", "class")
    columns = ["doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles")]
    with_words = named.join(found, "set_id").select(*columns, F.col("class").alias("component_id"))
    without = rows.where(F.col("set_id").isNull() | F.col("doc_id").isNull())
    return with_words.unionByName(without.select(*columns, F.col("doc_id").alias("component_id")))
