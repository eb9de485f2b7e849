"""Column expressions.  All of them stay in the JVM; there is no Python UDF here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with producers and readers of the log and the queue.
RATING_PREFIX = "PRODUCT_RATING_PREFIX:"
FIELD_SEPARATOR = "|"
QUEUE_SEPARATOR = ":"
MILLIS_FROM = 100_000_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(c: Column | str) -> Column:
    """Rating times arrive in seconds or, from the web form, in milliseconds."""
    c = col(c)
    return F.when(c > MILLIS_FROM, F.floor(c / F.lit(1000))).otherwise(c).cast("bigint")


def time_bucket(epoch: Column | str, pattern: str = "yyyyMM") -> Column:
    """Integer calendar bucket of an epoch second; ``yyyyMM`` is year-month."""
    time = F.timestamp_seconds(col(epoch))
    if pattern == "yyyyMM":  # the same number without formatting text
        return F.year(time) * 100 + F.month(time)
    return F.date_format(time, pattern).cast("int")


def half_score(ui_score: Column | str) -> Column:
    """Ten-point form score -> five-point rating, two decimals."""
    return F.round(col(ui_score) / F.lit(2.0), 2)


def log10_count(n: Column | str) -> Column:
    """Base-10 log of a counter that starts at one."""
    return F.log10(F.greatest(col(n), F.lit(1)).cast("double"))


def cooccurrence_score(together: Column | str, count1: Column | str, count2: Column | str) -> Column:
    """together / sqrt(count1 * count2), the product taken in double."""
    return col(together) / F.sqrt(col(count1).cast("double") * col(count2).cast("double"))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(col(a), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two dense arrays; NULL when either has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def tags_to_text(tags: Column | str) -> Column:
    return F.translate(col(tags), FIELD_SEPARATOR, " ")


def tokens(text: Column | str) -> Column:
    """Lower-cased whitespace tokens; trailing blanks give no token."""
    return F.split(F.regexp_replace(F.lower(col(text)), r"\s+$", ""), r"\s")


def queue_entry(product: Column | str, score: Column | str) -> Column:
    return F.concat_ws(QUEUE_SEPARATOR, col(product).cast("string"), col(score).cast("string"))


def queue_product(entry: Column | str) -> Column:
    return F.trim(F.split_part(col(entry), F.lit(QUEUE_SEPARATOR), F.lit(1))).try_cast("bigint")


def queue_score(entry: Column | str) -> Column:
    return F.trim(F.split_part(col(entry), F.lit(QUEUE_SEPARATOR), F.lit(2))).try_cast("double")


def log_line(user: Column | str, product: Column | str, score: Column | str, epoch: Column | str) -> Column:
    """The line a rating leaves in the application log."""
    fields = [col(c).cast("string") for c in (user, product, score, epoch)]
    return F.concat(F.lit(RATING_PREFIX), F.concat_ws(FIELD_SEPARATOR, *fields))


def repair_charset(query: Column | str) -> Column:
    """UTF-8 text that was decoded as Latin-1."""
    return F.decode(F.encode(col(query), "ISO-8859-1"), "UTF-8")


def user_id(username: Column | str) -> Column:
    """32-bit wrapping 31-fold over the UTF-16 units of the name, as a signed int."""
    units = F.hex(F.encode(col(username), "UTF-16BE"))
    n_units = (F.length(units) / F.lit(4)).cast("int")
    positions = F.when(n_units > 0, F.sequence(F.lit(0), n_units - 1)).otherwise(
        F.array().cast("array<int>")
    )
    folded = F.aggregate(
        positions,
        F.lit(0).cast("bigint"),
        lambda acc, i: F.pmod(
            acc * 31 + F.conv(F.substring(units, i * 4 + 1, F.lit(4)), 16, 10).cast("bigint"),
            F.lit(2**32).cast("bigint"),
        ),
    )
    return F.when(folded >= 2**31, folded - 2**32).otherwise(folded).cast("int")
