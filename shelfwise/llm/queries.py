"""The dealt operators as registered queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import bpe, hamming, langid, licences, minhash, mixing, pii, secret_scan, spotsigs, toxicity
from shelfwise.llm.common import documents
from shelfwise.sources.bindings import table


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of every document."""
    return licences.scan(documents(spark, sf_dir))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return minhash.classes(documents(spark, sf_dir))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(documents(spark, sf_dir))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; sources are owners, documents repositories."""
    return secret_scan.scan(documents(spark, sf_dir))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    line, mixed = mixing.mix(documents(spark, sf_dir))
    return mixing.taken(line, mixed)


def op6_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest codes of every hundredth vector among all."""
    return hamming.top_k(table(spark, sf_dir, "embeddings"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.scan(documents(spark, sf_dir))


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and its likeness to an edited copy and to the next document."""
    return spotsigs.fingerprints(documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's token ids and of what they decode to."""
    return bpe.digests(documents(spark, sf_dir))


QUERIES = {
    "op1_licences": op1_licences,
    "op2_minhash": op2_minhash,
    "op3_language": op3_language,
    "op4_secrets": op4_secrets,
    "op5_source_mix": op5_source_mix,
    "op6_hamming": op6_hamming,
    "op7_pii": op7_pii,
    "op8_spotsigs": op8_spotsigs,
    "op9_toxicity": op9_toxicity,
    "op10_byte_bpe": op10_byte_bpe,
}


def _secrets_sql() -> str:
    """The scan in SQL, kind by kind: gaps and matches alternate, so ends are running sums. A private key is its header and
    the key text that leads the gap after it."""
    quoted = {kind: pattern.replace("'", "''") for kind, pattern in secret_scan.KINDS.items()}
    apart = r"""[ \t\n\x0B\f\r"'']"""
    end = secret_scan.KEY_END.replace(r"\A", "^")
    body, plain = "split_part(g, '-----', 1)", r"regexp_replace(split_part(g, '-----', 1), '\\[nr]', '  ', 'g')"
    last = f"regexp_extract(substring(g, length({body}) + 1, 64), '{end}', 0)"
    runs = f"regexp_extract({plain}, '^(?:{apart}*[A-Za-z0-9+/=]{{16,}})*', 0)"
    key = (
        f"CASE WHEN NOT regexp_matches({body}, '{secret_scan.KEY_RUN}') THEN '' WHEN {last} <> '' THEN {body} || {last} "
        f"ELSE substring({body}, 1, length({runs})) END"
    )
    each = "\nUNION ALL\n".join(
        f"SELECT row, doc_id, owner, repository, '{kind}' AS kind, {place} AS place, "
        f"regexp_extract_all(text, '{pattern}') AS heads, string_split_regex(text, '{pattern}') AS between "
        f"FROM docs WHERE regexp_matches(text, '{pattern}')"
        for place, (kind, pattern) in enumerate(quoted.items())
    )
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, coalesce('o' || source, '') AS owner,
    md5(coalesce(text, '')) AS repository FROM documents),
found AS ({each}),
kinds AS (
  SELECT *, list_transform(between[2:], lambda g: CASE WHEN kind = 'private' THEN {key} ELSE '' END) AS keys FROM found),
each AS (
  SELECT row, doc_id, owner, repository, kind, place, i, heads[i] || keys[i] AS match,
    length(between[i]) - CASE WHEN i > 1 THEN length(keys[i - 1]) ELSE 0 END AS gap
  FROM (SELECT *, unnest(range(1, len(heads) + 1)) AS i FROM kinds)),
placed AS (
  SELECT *, CAST(sum(gap + length(match)) OVER (PARTITION BY row, kind ORDER BY i) AS BIGINT) AS stop,
    CASE WHEN kind = 'assign' THEN regexp_extract(match, '{quoted["assign"]}', 2)
      WHEN kind = 'private' THEN coalesce(nullif(regexp_replace(match, '{secret_scan.NOT_SECRET}', '', 'g'), ''), match)
      ELSE match END AS secret
  FROM each),
passed AS (
  SELECT *, stop - length(match) AS start FROM placed
  WHERE CASE kind WHEN 'assign' THEN length(secret) >= {secret_scan.MIN_ASSIGNED}
    WHEN 'random' THEN regexp_matches(match, '[a-z]') AND regexp_matches(match, '[A-Z]') AND regexp_matches(match, '[0-9]')
    ELSE true END),
owned AS (
  SELECT secret, count(DISTINCT repository) AS n_repositories, count(DISTINCT owner) AS n_owners FROM passed GROUP BY secret),
judged AS (
  SELECT p.*, kind || ':' || start || ':' || stop AS label,
    n_owners <= {secret_scan.LIVE_OWNERS}
      AND (kind IN ('private', 'login') OR len(list_distinct(string_split(secret, ''))) >= {secret_scan.LIVE_CHARACTERS}) AS live
  FROM passed p JOIN owned USING (secret)),
listed AS (
  SELECT row, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access, count_if(kind = 'hex') AS n_hex,
    string_agg(label, ',' ORDER BY start, place) FILTER (place < {len(secret_scan.BASE)}) AS base,
    string_agg(label, ',' ORDER BY start, place) AS spans, count_if(live) AS n_live, count_if(NOT live) AS n_example
  FROM judged WHERE place < {len(secret_scan.BASE)} OR live GROUP BY row)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  CAST(coalesce(n_live, 0) AS BIGINT) AS n_live, CAST(coalesce(n_example, 0) AS BIGINT) AS n_example
FROM docs LEFT JOIN listed USING (row)
"""


SQL = {
    "op2_minhash": """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
runs AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM worded),
copies AS (SELECT min(doc_id) AS node, s FROM (SELECT doc_id, list_sort(s) AS s FROM runs) WHERE len(s) > 0 GROUP BY s),
parts AS (SELECT node, len(s) AS n, md5_number(unnest(s)) AS shingle FROM copies),
common AS (
  SELECT a.node AS a, b.node AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS inter
  FROM parts a JOIN parts b ON a.shingle = b.shingle AND a.node < b.node GROUP BY a.node, b.node),
links AS (
  SELECT a, b FROM common WHERE 100 * inter >= 80 * (n - inter)
  UNION SELECT b, a FROM common WHERE 100 * inter >= 80 * (n - inter)),
reached AS (
  SELECT node AS a, node AS b FROM copies
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
named AS (SELECT a AS node, min(b) AS component_id FROM reached GROUP BY a),
of_set AS (SELECT c.s, n.component_id FROM copies c JOIN named n USING (node))
SELECT r.doc_id, CAST(len(r.s) AS BIGINT) AS n_shingles, coalesce(o.component_id, r.doc_id) AS component_id,
  r.doc_id = coalesce(o.component_id, r.doc_id) AS kept
FROM runs r LEFT JOIN of_set o ON list_sort(r.s) = o.s
""",
    "op4_secrets": _secrets_sql(),
    "op5_source_mix": """
WITH sized AS (
  SELECT doc_id, coalesce('0' || source, '1') AS skey,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix') AS turn
  FROM documents),
per AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY skey),
weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY skey) - 1) % 3 + 1)::INT] AS weight FROM per),
leveled AS (
  SELECT *, source_size * 3.0::DOUBLE / weight AS full_at,
    CAST(sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER w, 0) AS DOUBLE)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM weighed
  WINDOW w AS (ORDER BY source_size * 3.0::DOUBLE / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
common AS (SELECT arg_min(level, full_at) AS level FROM leveled WHERE full_at > level),
goals AS (
  SELECT skey, source_size, least(source_size * 3.0::DOUBLE, coalesce(c.level * weight, source_size * 3.0::DOUBLE)) AS target
  FROM leveled l LEFT JOIN common c ON true),
line AS (
  SELECT s.doc_id, s.skey, s.size, g.source_size, g.target, CAST(floor(g.target + 0.5) AS BIGINT) AS need,
    CAST(coalesce(sum(s.size) OVER (PARTITION BY s.skey ORDER BY s.turn, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN goals g USING (skey))
SELECT doc_id, size, source_size, target,
  CAST(greatest(least(start + size, need) - start, 0)
     + greatest(least(start + source_size + size, need) - start - source_size, 0)
     + greatest(least(start + 2 * source_size + size, need) - start - 2 * source_size, 0) AS BIGINT) AS taken
FROM line
""",
    "op6_hamming": """
WITH coded AS (
  SELECT vec_id, list_transform(embedding, lambda x: coalesce(x > 0, false)) AS bits FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0),
apart AS (
  SELECT q.vec_id AS query_id, x.vec_id AS neighbour_id,
    CAST(list_sum(list_transform(list_zip(q.bits, x.bits), lambda p: CAST(p[1] <> p[2] AS INT))) AS INT) AS distance
  FROM coded q JOIN coded x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INT) AS rank FROM apart)
SELECT query_id, rank, neighbour_id, distance FROM ranked WHERE rank <= 10
""",
}
