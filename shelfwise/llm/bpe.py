"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

The merges come from a rank file (base64 token, rank). The library's BPE model works on text, so
each byte of a piece is mapped to one printable character before it; offsets count bytes. A text is cut at single blanks between two non-blank characters, where
every match of the pattern ends too, and each distinct chunk is encoded once and kept in a bounded
cache. Decoding reverses the byte table per token and joins bytes, so a character that is split
over tokens comes back whole; a lone part of one becomes U+FFFD in ``decoded text`` only.

Edge cases: a null or empty text gives no tokens; special-token strings in a text are ordinary
text; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import parts

RANKS = "byte_bpe_50k.tiktoken"
#: Chunks kept per Python worker before the cache starts anew.
CACHE = 150_000
#: Single blanks between non-blanks.
CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_characters() -> list[str]:
    """A printable character for every byte: itself where printable, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The two parts whose merge made each token, in rank order.

    A token's parts are what merging its bytes by lower ranks leaves.
    """
    out = []
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        if len(token) > 1:
            parts = [bytes([b]) for b in token]
            while len(parts) > 2:
                joins = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:], strict=False)]
                at = min(range(len(joins)), key=joins.__getitem__)
                if joins[at] >= rank:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2:
                out.append((parts[0], parts[1]))
    return out


class Codec:
    """Encodes and decodes with one rank file."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        from tokenizers import models

        ranks = read_ranks(ranks_path)
        chars = byte_characters()
        self.to_chars = {b: c for b, c in enumerate(chars)}
        shown = lambda token: "".join(chars[b] for b in token)
        self.model = models.BPE(
            vocab={shown(t): r for t, r in ranks.items()}, merges=[(shown(a), shown(b)) for a, b in merges_of(ranks)]
        )
        self.pieces = regex.compile(pattern).findall
        back = {c: b for b, c in enumerate(chars)}
        size = max(ranks.values()) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            self.token_bytes[rank] = bytes(back[c] for c in shown(token))
        self.cache: dict[str, list[int]] = {}

    def _shown(self, piece: str) -> str:
        return piece.encode("utf-8", "replace").decode("latin-1").translate(self.to_chars)

    def _chunk(self, chunk: str) -> list[int]:
        ids = [t.id for piece in self.pieces(chunk) for t in self.model.tokenize(self._shown(piece))]
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        first, *rest = CUT.split(text)
        cache = self.cache
        found = [cache.get(" " + word) for word in rest]
        ids = cache.get(first) or self._chunk(first) if first else []
        for i, got in enumerate(found):
            if got is None:
                found[i] = self._chunk(" " + rest[i])
        return [*ids, *chain.from_iterable(found)]

    def encode_with_offsets(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first byte, end byte) of each token."""
        out, at = [], 0
        for token in chain.from_iterable(self.model.tokenize(self._shown(piece)) for piece in self.pieces(text)):
            end = at + len(self.token_bytes[token.id])
            out.append((token.id, at, end))
            at = end
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, ids (array of int), decoded (binary): one row per document."""
    where = vocabulary or default_vocabulary()

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*where)
        for batch in parts(source):
            ids = [own.encode(text or "") for text in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    pa.array([own.decode_bytes(x) for x in ids], pa.binary()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(batches, "doc_id bigint, ids array<int>, decoded binary")


def encode_with_offsets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, ids, ends: where each token ends in the text's UTF-8 bytes; it starts where the one before it ends."""
    where = vocabulary or default_vocabulary()

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*where)
        lengths = np.array([len(token) for token in own.token_bytes], np.int64)
        for batch in parts(source):
            ids = [own.encode(text or "") for text in batch.column("text").to_pylist()]
            heads = np.cumsum([0, *map(len, ids)])
            flat = np.fromiter(chain.from_iterable(ids), np.int32, heads[-1])
            ends = np.cumsum(lengths[flat])
            before = np.r_[0, ends][heads[:-1]]
            at = pa.array(heads, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(at, pa.array(flat)),
                    pa.ListArray.from_arrays(at, pa.array(ends - np.repeat(before, np.diff(heads)), pa.int64())),
                ],
                names=["doc_id", "ids", "ends"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(batches, "doc_id bigint, ids array<int>, ends array<bigint>")


def decode(encoded: DataFrame, ids_col: str = "ids", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """``encoded`` with text: the ids decoded, parts of characters as U+FFFD. A null list gives null."""
    where = vocabulary or default_vocabulary()

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        own = codec(*where)
        return ids.map(lambda x: None if x is None else own.decode(x))

    return encoded.withColumn("text", text(F.col(ids_col)))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ``encode`` reduced inside the task."""
    where = vocabulary or default_vocabulary()

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*where)
        for batch in parts(source):
            counts, coded, back = [], [], []
            for text in batch.column("text").to_pylist():
                ids = own.encode(text or "")
                counts.append(len(ids))
                coded.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                back.append(hashlib.sha256(own.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded), pa.array(back)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(batches, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
