"""The dealt operators on ranked search, set joins and vector codes as registered queries, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import ranked_search, set_join, vector_codes
from shelfwise.llm.common import documents
from shelfwise.sources.bindings import table


def op11_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document by links at 0.8 of five-word shingles."""
    return set_join.classes(documents(spark, sf_dir))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code, error and codebook digest of every vector."""
    return vector_codes.codes(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op11_best_position": op11_best_position,
    "op12_token_groups": op12_token_groups,
    "op13_vector_codes": op13_vector_codes,
}


def _vector_codes_sql() -> str:
    """Rounds written out one after the other; every distance is computed."""
    last = vector_codes.ROUNDS
    steps = []
    for r in range(last + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT row, part, min(struct_pack(d := d, entry := entry)) AS best
  FROM (SELECT x.row, x.part, b.entry,
          list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts x JOIN book{r} b ON x.part = b.part)
  GROUP BY row, part)""")
        if r < last:
            steps.append(f"""
mean{r} AS (
  SELECT part, entry, list(m ORDER BY place) AS v FROM (
    SELECT n.part, n.best.entry AS entry, i AS place, CAST(floor(sum(x.v[i])::DOUBLE / count(*)) AS BIGINT) AS m
    FROM near{r} n JOIN parts x ON n.row = x.row AND n.part = x.part, (SELECT unnest(range(1, (SELECT width + 1 FROM size))) AS i)
    GROUP BY n.part, n.best.entry, i)
  GROUP BY part, entry),
book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN mean{r} m ON b.part = m.part AND b.entry = m.entry)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * x::DOUBLE) AS BIGINT))) AS row,
    vec_id, label, list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * x::DOUBLE) AS BIGINT)) AS whole
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT CAST(max(len(whole)) // {vector_codes.PARTS} AS BIGINT) AS width FROM kept),
parts AS MATERIALIZED (
  SELECT row, p AS part, whole[p * width + 1:(p + 1) * width] AS v
  FROM kept, size, (SELECT unnest(range({vector_codes.PARTS})) AS p)),
book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, v FROM parts WHERE row <= {vector_codes.ENTRIES}),{",".join(steps)},
coded AS (
  SELECT row, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{last} GROUP BY row),
digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row), digest
"""


SQL = {
    "op11_best_position": """
WITH worded AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents),
totals AS (SELECT count_if(len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_all FROM worded),
counted AS (
  SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(t) AS term FROM worded) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term),
asked AS (
  SELECT item_id, q, term, count(*) AS times FROM (
    SELECT item_id, q, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT *, row_number() OVER () AS q FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)))
  GROUP BY item_id, q, term),
scored AS (
  SELECT a.item_id, a.q, c.row, d.doc_id,
    CAST(sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (100 - 75 + (75 * len(d.t) * n_docs) // n_all)))) AS BIGINT) AS score
  FROM asked a JOIN weights w USING (term) JOIN counted c USING (term) JOIN worded d USING (row), totals
  GROUP BY a.item_id, a.q, c.row, d.doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
    "op12_token_groups": """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
runs AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
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
SELECT r.doc_id, CAST(len(r.s) AS BIGINT) AS n_shingles, coalesce(o.component_id, r.doc_id) AS component_id
FROM runs r LEFT JOIN of_set o ON list_sort(r.s) = o.s
""",
    "op13_vector_codes": _vector_codes_sql(),
}
