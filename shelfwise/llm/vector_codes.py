"""Product quantization of vectors in whole numbers, nearest entries found in Walsh-Hadamard order.

A vector's components become ``floor(SCALE * x)`` and are cut into ``PARTS`` equal consecutive parts; each part is coded
by the nearest of at most ``ENTRIES`` codebook entries. Codebooks start as the parts of the vectors of the smallest ids
and are re-centred ``ROUNDS`` times.

Nearest entries are exact and need no floating point. Parts and entries are padded with zeros to ``n``, a power of
two, and go through the whole-number Walsh-Hadamard transform, which multiplies every squared distance by ``n``.
Its rows stand in sequency order (by changes of sign), where the first few carry most of the difference, so
squared differences are added up in that order and an entry is given up once its sum passes the whole distance of the
entry that looked nearest after ``LEAD`` rows.

Only codebooks (``PARTS * ENTRIES`` rows) and one sum per entry and position come to the driver, whatever the table's
size; vectors stay where they are stored.

Edge cases: a null vector, or one with a null or non-finite component, is dropped; shorter vectors count as padded with
zeros to the longest length, rounded up to a multiple of ``PARTS``; components beyond ``LIMIT`` after scaling count as
``LIMIT``, which keeps all sums inside 64 bits; ties go to the lower entry; repeated rows are coded each; null ids
are coded, and become entries only after all others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LIMIT = 2**22
LEAD = 4
BLOCK = 1024
#: Equal labels are summed and joined in so many shares, so that a frequent label is not one task's.
LABEL_SHARES = 32


def sequency(n: int) -> np.ndarray:
    """Rows of the butterfly's transform (n a power of two) by number of sign changes: bit-reversed Gray codes."""
    bits = n.bit_length() - 1
    at = np.arange(n)
    gray = at ^ (at >> 1)
    out = np.zeros(n, np.int64)
    for i in range(bits):
        out |= ((gray >> i) & 1) << (bits - 1 - i)
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of whole-number rows, zero-padded to a power of two, in sequency order."""
    n = 1 << max(rows.shape[1] - 1, 0).bit_length()
    out = np.zeros((len(rows), n), np.int64)
    out[:, : rows.shape[1]] = rows
    half = 1
    while half < n:
        pairs = out.reshape(len(rows), n // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), n)
        half *= 2
    return out[:, sequency(n)]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry (lowest index on ties) and squared distance of each point, both given transformed; and the
    number of squared differences that were computed."""
    n = points.shape[1]
    lead = min(LEAD, n)
    partial = np.zeros((len(points), len(entries)), np.int64)
    for i in range(lead):
        apart = points[:, i, None] - entries[None, :, i]
        partial += apart * apart
    bound = ((points - entries[partial.argmin(1)]) ** 2).sum(1)
    point, entry = np.nonzero(partial <= bound[:, None])
    sums = partial[point, entry]
    work = partial.size * lead + points.size
    for i in range(lead, n):
        apart = points[point, i] - entries[entry, i]
        sums += apart * apart
        work += len(sums)
        open_ = sums <= bound[point]
        if not open_.all():
            point, entry, sums = point[open_], entry[open_], sums[open_]
    # Points in order, entries ascending inside a point; every point still has the entry of its bound.
    heads = np.flatnonzero(np.r_[True, point[1:] != point[:-1]])
    least = np.minimum.reduceat(sums, heads)
    hits = np.flatnonzero(sums == np.repeat(least, np.diff(np.r_[heads, len(sums)])))
    first = hits[np.r_[True, point[hits][1:] != point[hits][:-1]]]
    return entry[first], least // n, work


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, whole (array<int>) of the rows that are kept."""
    value = F.col(vector_col).cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(value, lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x * SCALE))).cast("int"))
    rows = vectors.where(F.col(vector_col).isNotNull() & ~bad)
    return rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), scaled.alias("whole"))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their vectors as rows of ``PARTS * width`` numbers."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            column = part.column("whole")
            lengths = column.value_lengths().to_numpy()
            flat = column.flatten().to_numpy()
            rows = np.zeros((part.num_rows, PARTS * width), np.int64)
            rows[np.repeat(np.arange(len(rows)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
            yield part, rows


def _re_centred(whole: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks with every used entry at the floor of its parts' mean."""
    parts, size, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned = [transform(book) for book in books]
        total, count = np.zeros((parts, size, width), np.int64), np.zeros((parts, size), np.int64)
        for _, rows in _blocks(batches, width):
            for p in range(parts):
                mine = rows[:, p * width : (p + 1) * width]
                code = nearest(transform(mine), turned[p])[0]
                np.add.at(total[p], code, mine)
                count[p] += np.bincount(code, minlength=size)
        part, entry = np.nonzero(count)
        values = np.c_[count[part, entry], total[part, entry]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(part * size + entry, width + 1), pa.int32()),
                pa.array(np.tile(np.arange(width + 1), len(part)), pa.int32()),
                pa.array(values.ravel(), pa.int64()),
            ],
            names=["entry", "place", "value"],
        )

    shares = whole.select("whole").mapInArrow(sums, "entry int, place int, value bigint")
    found = np.zeros((parts * size, width + 1), np.int64)
    for row in shares.groupBy("entry", "place").agg(F.sum("value").alias("value")).collect():
        found[row.entry, row.place] = row.value
    count = found[:, :1]
    moved = np.where(count > 0, found[:, 1:] // np.maximum(count, 1), books.reshape(parts * size, width))
    return moved.reshape(parts, size, width)


def fit(whole: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> np.ndarray:
    """Codebooks (part, entry, position) after ``rounds`` rounds. ``whole`` is read once a round: give it stored."""
    longest = whole.agg(F.max(F.size("whole"))).first()[0] or 0
    width = max(1, -(-longest // PARTS))
    first = whole.orderBy(F.asc_nulls_last("id"), "whole").select("whole").limit(entries).collect()
    rows = np.zeros((len(first), PARTS * width), np.int64)
    for at, row in enumerate(first):
        rows[at, : len(row.whole)] = row.whole
    books = np.ascontiguousarray(rows.reshape(len(first), PARTS, width).transpose(1, 0, 2))
    for _ in range(rounds if len(first) else 0):
        books = _re_centred(whole, books)
    return books


def encode(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """id, label, codes (array<int>, one entry a part), error (squared distances summed over parts)."""
    width = books.shape[2]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned = [transform(book) for book in books]
        for part, rows in _blocks(batches, width):
            found = [nearest(transform(rows[:, p * width : (p + 1) * width]), turned[p])[:2] for p in range(PARTS)]
            codes = np.stack([code for code, _ in found], axis=1).astype(np.int32)
            error = sum(distance for _, distance in found)
            offsets = pa.array(np.arange(0, PARTS * len(rows) + 1, PARTS), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), lists, pa.array(error, pa.int64())], names=["id", "label", "codes", "error"]
            )

    label = whole.schema["label"].dataType.simpleString()
    return whole.mapInArrow(coded, f"id bigint, label {label}, codes array<int>, error bigint")


def decode(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """id, whole: the vector of entries that a code stands for."""
    literal = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in book]) for book in books])
    return codes.select("id", F.flatten(F.transform("codes", lambda c, p: literal[p][c])).alias("whole"))


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, shares: int = LABEL_SHARES) -> DataFrame:
    """Adds ``label_error``, the error summed over equal labels, nulls together."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    each = sums.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("s"))
    share = F.pmod(F.xxhash64("id", "codes"), F.lit(shares)).cast("int")
    rows = coded.withColumn("share", share)
    return rows.join(each, F.col("label").eqNullSafe(F.col("of")) & (F.col("share") == F.col("s"))).drop("of", "s", "share")


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept row."""
    whole = stored(whole_vectors(vectors, id_col, vector_col, label_col), "whole")
    books = fit(whole)
    if not books.shape[1]:
        coded = whole.select("id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("bigint").alias("error"))
    else:
        coded = stored(encode(whole, books), "codes")
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return with_label_error(coded).select(
        F.col("id").alias("vec_id"), F.array_join(digits, "").alias("code"), "error", "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )
