"""Regular-expression search over names by an index of their trigrams.

The literal parts of a pattern name trigrams that every match must hold.  Only rows that the posting table lists under all
of them are compared with the pattern, so a search reads a few lists and rows instead of every name.  A pattern
without a literal of three characters, or one that is read differently by different engines, is searched by a scan;
the result is the same.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

try:
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # Python before 3.11
    import sre_constants as sre
    import sre_parse

SIZE = 3
#: More alternatives than these are searched by a scan.
MOST = 64
#: Escapes that mean a literal in one engine and something else in another.
UNCLEAR = re.compile(r"\\[0-9vahHRXNQEGZzekpPcxuU]|\(\?[a-zA-Z-]*[a-zA-Z]|&&|\[[^\]]*\[")

Needs = list[frozenset[str]]


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + SIZE] for i in range(len(text) - SIZE + 1))


def _both(a: Needs, b: Needs) -> Needs:
    """Alternatives of a sequence: each of one with each of the other; the first alone where that are too many."""
    return [x | y for x in a for y in b] if len(a) * len(b) <= MOST else a


def _needs(parsed) -> Needs:
    """Alternatives, each the trigrams that a match must hold; [empty set] says nothing."""
    found: Needs = [frozenset()]
    run = ""

    def close() -> None:
        nonlocal found, run
        found, run = _both(found, [trigrams(run)]), ""

    for kind, value in parsed:
        if kind is sre.LITERAL:
            run += chr(value)
            continue
        if kind is sre.AT:  # between characters
            continue
        if kind is sre.SUBPATTERN and not value[1] and not value[2] and all(k is sre.LITERAL for k, _ in value[3]):
            run += "".join(chr(v) for _, v in value[3])
            continue
        close()
        if kind is sre.SUBPATTERN:
            found = _both(found, _needs(value[3]))
        elif kind is sre.BRANCH:
            options = [need for option in value[1] for need in _needs(option)]
            found = _both(found, options if len(options) <= MOST else [frozenset()])
        elif kind is sre.MAX_REPEAT and value[0] >= 1 or kind is sre.MIN_REPEAT and value[0] >= 1:
            found = _both(found, _needs(value[2]))
    close()
    return found


def needed(pattern: str) -> Needs | None:
    """Alternatives of trigrams, one of which every match holds whole; None where the pattern promises nothing."""
    if UNCLEAR.search(pattern):
        return None
    try:
        parsed = sre_parse.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return None
    if parsed.state.flags & (re.IGNORECASE | re.VERBOSE):
        return None
    found = _needs(parsed)
    return None if any(not need for need in found) else sorted(set(found), key=sorted)


def postings(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """trigram, id: every different trigram of every text."""
    last = F.char_length(text_col) - SIZE
    starts = F.when(last >= 0, F.sequence(F.lit(1), last + 1)).otherwise(F.array().cast("array<int>"))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(text_col, i, F.lit(SIZE))))
    return rows.where(F.col(text_col).isNotNull()).select(F.explode(grams).alias("trigram"), F.col(id_col).alias("id"))


def save(posted: DataFrame, path: str) -> None:
    """Sorted by trigram, so that the list of one is in few row groups."""
    posted.repartitionByRange("trigram").sortWithinPartitions("trigram", "id").write.mode("overwrite").parquet(path)


def candidates(posted: DataFrame, needs: Needs) -> DataFrame:
    """id of the rows that hold all trigrams of one of the alternatives."""
    wanted = sorted(frozenset().union(*needs))
    lists = posted.where(F.col("trigram").isin(wanted))
    holds = lists.groupBy("id").agg(F.collect_set("trigram").alias("held"))
    each = [F.size(F.array_intersect("held", F.array(*[F.lit(t) for t in sorted(need)]))) == len(need) for need in needs]
    return holds.where(reduce(lambda a, b: a | b, each)).select("id")


def search(rows: DataFrame, posted: DataFrame, pattern: str, id_col: str, text_col: str) -> DataFrame:
    """The rows whose text matches ``pattern``."""
    needs = needed(pattern)
    if needs is not None:
        found = candidates(posted, needs).withColumnRenamed("id", id_col)
        rows = rows.join(found, id_col, "left_semi")
    return rows.where(F.regexp_like(text_col, F.lit(pattern)))
