"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by kind in every whole text. The hash of each candidate's secret part is
counted over the corpus: in how many repositories (different texts: equal ones are copies of one) and with how many
owners (sources) it occurs. A secret that several owners share is an example; one that stays with a single owner looks
live, however often that owner repeats it. The three base kinds are always reported, the other kinds only where they
look live. A private key reaches from its header through the text of the key to the END line; its secret is the text
of the key, since all keys of a type have the same header.

Positions count code points; the end is exclusive. Edge cases: a null text counts as empty; a null
owner is an owner of its own; repeated rows are scanned each; documents without candidates have
zero counts and the digest of the empty string; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

#: Kind -> pattern, in the order of kinds at one start. The secret part is the last group.
BASE = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
MORE = {
    "issued": r"(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|[sr]k_live_)[A-Za-z0-9_-]{16,}",
    "login": r"[a-z]{2,12}://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._~!$*+-]{3,128}@",
    "private": r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----",
    "random": r"[A-Za-z0-9+/_-]{32,}",
}
KINDS = BASE | MORE
#: A private key after its header: its last line, a run that only key text has, and the first place that is not key text.
KEY_END = r"\A-----END [A-Z ]{0,32}PRIVATE KEY-----"
KEY_RUN = r"[A-Za-z0-9+/=]{16}"
NO_KEY = r"""[^A-Za-z0-9+/=\s"']|(?<![A-Za-z0-9+/=])(?![A-Za-z0-9+/=]{16})[A-Za-z0-9+/=]"""
NOT_SECRET = r"-----(?:BEGIN|END) [A-Z ]{0,32}PRIVATE KEY-----|\\[nr]|[^A-Za-z0-9+/=]"
MIN_ASSIGNED = 6
#: A candidate looks live up to so many owners, and from so many different characters.
LIVE_OWNERS = 1
LIVE_CHARACTERS = 8


def _key(after: Column) -> Column:
    """What follows a header as its key: through the END line or, if that is missing, the leading runs of key text."""
    body = F.substring_index(after, "-----", 1)
    end = F.regexp_extract(F.substring(after, F.char_length(body) + 1, F.lit(64)), KEY_END, 0)
    # Written-out line ends become blanks of the same length.
    plain = F.regexp_replace(body, r"\\[nr]", "  ")
    stop = F.regexp_instr(plain, F.lit(NO_KEY))
    runs = F.when(stop > 0, F.substring(plain, F.lit(1), stop - 1)).otherwise(plain)
    length = F.char_length(F.regexp_replace(runs, r"""(?<![\s"'])[\s"']+\z""", ""))
    return F.when(~body.rlike(KEY_RUN), "").when(end != "", F.concat(body, end)).otherwise(F.substring(body, F.lit(1), length))


def _found(text: Column, kind: str) -> Column:
    pattern = KINDS[kind]
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.transform(between, F.char_length)
    if kind == "private":
        after = F.slice(between, 2, F.size(between))
        matches = F.zip_with(matches, after, lambda head, rest: F.concat(head, _key(rest)))
        left = F.transform(after, lambda rest: F.char_length(rest) - F.char_length(_key(rest)))
        lengths = F.concat(F.slice(lengths, 1, 1), left)
    return F.when(
        text.rlike(pattern),
        F.struct(
            F.lit(kind).alias("kind"),
            F.lit(list(KINDS).index(kind)).alias("place"),
            matches.alias("matches"),
            lengths.alias("gaps"),
        ),
    )


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """row, doc_id, owner, repository, found: one row per document, candidates of all kinds as texts and the lengths between."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("o"), F.col(owner_col)), F.lit("")).alias("owner"),
        F.md5(text).alias("repository"),
        F.filter(F.array(*[_found(text, kind) for kind in KINDS]), lambda x: x.isNotNull()).alias("found"),
    )


def spans(found: DataFrame) -> DataFrame:
    """row, doc_id, owner, repository, kind, place, start, end, secret: one row per candidate that passes its rule."""
    kinds = found.where(F.size("found") > 0).select("row", "doc_id", "owner", "repository", F.explode("found").alias("f"))
    each = kinds.select(
        "row", "doc_id", "owner", "repository", "f.kind", "f.place", F.posexplode(F.arrays_zip("f.matches", "f.gaps")).alias("i", "m")
    ).where(F.col("m.matches").isNotNull())
    order = Window.partitionBy("row", "kind").orderBy("i")
    length = F.char_length("m.matches")
    placed = each.select(
        "*",
        (F.sum(F.col("m.gaps") + length).over(order)).alias("end"),
        length.alias("length"),
        F.col("m.matches").alias("match"),
    )
    key = F.regexp_replace("match", NOT_SECRET, "")
    secret = (
        F.when(F.col("kind") == "assign", F.regexp_extract("match", KINDS["assign"], 2))
        .when((F.col("kind") == "private") & (key != ""), key)
        .otherwise(F.col("match"))
    )
    mixed = F.col("match").rlike("[a-z]") & F.col("match").rlike("[A-Z]") & F.col("match").rlike("[0-9]")
    passes = (
        F.when(F.col("kind") == "assign", F.char_length("secret") >= MIN_ASSIGNED)
        .when(F.col("kind") == "random", mixed)
        .otherwise(True)
    )
    return placed.withColumn("secret", secret).where(passes).select(
        "row", "doc_id", "owner", "repository", "kind", "place", (F.col("end") - F.col("length")).alias("start"), "end", "secret"
    )


def ownership(seen: DataFrame) -> DataFrame:
    """secret_hash, n_repositories, n_owners over the whole corpus."""
    pairs = seen.groupBy("secret_hash", "owner", "repository").agg(F.count("*").alias("times"))
    return pairs.groupBy("secret_hash").agg(
        F.count_distinct("repository").alias("n_repositories"), F.count_distinct("owner").alias("n_owners")
    )


def judged(found: DataFrame) -> DataFrame:
    """spans with secret_hash, n_repositories, n_owners, live."""
    seen = spans(found).withColumn("secret_hash", F.sha2(F.col("secret"), 256))
    varied = F.size(F.array_distinct(F.split("secret", ""))) >= LIVE_CHARACTERS
    return seen.join(ownership(seen), "secret_hash").withColumn(
        "live",
        (F.col("n_owners") <= LIVE_OWNERS)
        & ((F.col("kind").isin("private", "login")) | varied),
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """One row per document: counts of the base kinds, their digest, all spans, and how many look live or are examples."""
    found = stored(candidates(docs, id_col, text_col, owner_col), "secrets")
    kept = judged(found).where(F.col("kind").isin(*BASE) | F.col("live"))
    label = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    listed = kept.groupBy("row").agg(
        *[F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in BASE],
        F.sort_array(F.collect_list(F.struct("start", "place", label.alias("label")))).alias("spans"),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_example"),
    )
    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    joined = lambda c: F.coalesce(F.array_join(F.transform(c, lambda s: s["label"]), ","), F.lit(""))
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("bigint").alias(name)
    return found.select("row", "doc_id").join(listed, "row", "left").select(
        "doc_id",
        *[zero(f"n_{kind}") for kind in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        zero("n_live"),
        zero("n_example"),
    )
