"""The same queries as SQL over the driver tables, for checking results in DuckDB."""

from __future__ import annotations

# Common table expressions, in dependency order.
CTES = {
    "ratings": """
        SELECT o_custkey AS userId, l_partkey AS productId, l_quantity / 10 AS score,
               CAST(epoch(o_orderdate) AS BIGINT) AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "products": """
        SELECT p_partkey AS productId, p_name AS name, concat('img/', CAST(p_partkey AS VARCHAR)) AS imageUrl,
               p_type AS categories, concat_ws('|', replace(p_name, ' ', '|'), p_brand, p_type) AS tags
        FROM part""",
    "log": """
        SELECT event_id, CASE WHEN event_type = 'purchase'
            THEN concat('INFO app PRODUCT_RATING_PREFIX:', CAST(user_id AS VARCHAR), '|',
                        regexp_extract(props, '([0-9]+)', 1), '|', CAST(event_id % 5 + 1 AS VARCHAR), '|',
                        CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR))
            ELSE concat('INFO ', event_type) END AS line
        FROM events""",
    "messages": """
        SELECT trim(string_split(line, 'PRODUCT_RATING_PREFIX:')[2]) AS value
        FROM log WHERE contains(line, 'PRODUCT_RATING_PREFIX:')""",
    "logged": """
        SELECT CAST(string_split(value, '|')[1] AS BIGINT) AS userId,
               CAST(string_split(value, '|')[2] AS BIGINT) AS productId,
               CAST(string_split(value, '|')[3] AS DOUBLE) AS score,
               CAST(string_split(value, '|')[4] AS BIGINT) AS ts
        FROM messages""",
    "requests": """
        SELECT user_id AS userId, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS productId,
               round(CAST(event_id % 10 + 1 AS DOUBLE) / 2, 2) AS score, CAST(floor(epoch(ts)) AS BIGINT) AS ts
        FROM events WHERE event_type = 'purchase'""",
    "posted": """
        SELECT userId, productId, score, ts FROM ratings r
        WHERE NOT EXISTS (SELECT 1 FROM requests q WHERE q.userId = r.userId AND q.productId = r.productId)
        UNION ALL
        SELECT userId, productId, u.score, coalesce(b.ts, u.ts) AS ts
        FROM (SELECT userId, productId, arg_max(score, (ts, score)) AS score, min(ts) AS ts FROM requests GROUP BY 1, 2) u
        LEFT JOIN (SELECT userId, productId, max(ts) AS ts FROM ratings GROUP BY 1, 2) b USING (userId, productId)""",
    "allratings": """
        SELECT userId, productId, score, ts FROM ratings
        UNION ALL SELECT userId, productId, score, ts FROM logged""",
    "recent": """
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, productId, score DESC) AS rank
            FROM allratings) WHERE rank <= 20""",
    "latest": """
        SELECT userId, productId FROM (
            SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, productId, score DESC) AS r
            FROM logged) WHERE r = 1""",
    "averages": "SELECT productId, avg(score) AS mean FROM ratings GROUP BY productId",
    "details": """
        SELECT p.*, round(coalesce(a.mean, 0), 6) AS avg FROM products p LEFT JOIN averages a USING (productId)""",
    "counts": "SELECT productId, count(*) AS n FROM ratings GROUP BY productId",
    "together": """
        SELECT a.productId AS product1, b.productId AS product2, count(*) AS cocount
        FROM ratings a JOIN ratings b ON a.userId = b.userId AND a.productId <> b.productId GROUP BY 1, 2""",
    "itemcf": """
        SELECT * FROM (
            SELECT product1, product2, cocount, c1.n AS count1, c2.n AS count2,
                   cocount / sqrt(CAST(c1.n AS DOUBLE) * c2.n) AS score,
                   row_number() OVER (PARTITION BY product1
                       ORDER BY cocount / sqrt(CAST(c1.n AS DOUBLE) * c2.n) DESC, product2) AS rank
            FROM together JOIN counts c1 ON product1 = c1.productId JOIN counts c2 ON product2 = c2.productId)
        WHERE rank <= 20""",
    "words": """
        SELECT productId, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS term FROM products""",
    "tf": "SELECT productId, term, count(*) AS tf FROM words GROUP BY productId, term",
    "idf": """
        SELECT term, ln(CAST((SELECT count(*) FROM products) + 1 AS DOUBLE) / (count(*) + 1)) AS idf
        FROM tf GROUP BY term""",
    "tfidf": "SELECT productId, term, tf, tf * idf AS weight FROM tf JOIN idf USING (term)",
    "profiles": """
        SELECT productId,
               array_to_string(list_sort(string_split(lower(replace(tags, '|', ' ')), ' ')), ' ') AS profile
        FROM products""",
    "profileleaders": "SELECT profile, min(productId) AS id FROM profiles GROUP BY profile",
    "vectors": """
        SELECT profile, term, weight FROM tfidf JOIN
            (SELECT profile, min(productId) AS productId FROM profiles GROUP BY profile) USING (productId)""",
    "lengths": "SELECT profile, sqrt(sum(weight * weight)) AS len FROM vectors GROUP BY profile",
    "profilepairs": """
        SELECT x.profile AS profile, y.profile AS simProfile,
               CASE WHEN x.profile = y.profile THEN 1.0 ELSE d / (x.len * y.len) END AS score
        FROM (SELECT a.profile AS p, b.profile AS q, sum(a.weight * b.weight) AS d
              FROM vectors a JOIN vectors b USING (term) GROUP BY 1, 2)
        JOIN lengths x ON p = x.profile JOIN lengths y ON q = y.profile
        WHERE d / (x.len * y.len) > 0.4 AND (x.profile <> y.profile OR
              (SELECT count(*) FROM profiles z WHERE z.profile = x.profile) > 1)""",
    "alike": """
        SELECT a.productId AS productId, b.productId AS simProductId, score
        FROM profiles a JOIN profilepairs p ON a.profile = p.profile JOIN profiles b ON b.profile = p.simProfile
        WHERE a.productId <> b.productId""",
    "contentranked": """
        SELECT *, row_number() OVER (PARTITION BY productId ORDER BY round(score, 9) DESC, simProductId) AS rank
        FROM alike""",
    "candidates": """
        SELECT * FROM (
            SELECT l.userId AS userId, s.simProductId AS productId, s.score AS score,
                   row_number() OVER (PARTITION BY l.userId ORDER BY round(s.score, 9) DESC, s.simProductId) AS rank
            FROM latest l JOIN alike s USING (productId)
            WHERE NOT EXISTS (SELECT 1 FROM allratings r
                              WHERE r.userId = l.userId AND r.productId = s.simProductId))
        WHERE rank <= 20""",
    "rescored": """
        SELECT c.userId AS userId, c.productId AS productId,
               avg(s.score * r.score)
               + log10(greatest(count(*) FILTER (WHERE r.score > 3), 1))
               - log10(greatest(count(*) FILTER (WHERE r.score <= 3), 1)) AS score
        FROM candidates c JOIN recent r ON c.userId = r.userId
        JOIN alike s ON s.productId = c.productId AND s.simProductId = r.productId
        WHERE s.score > 0.4 GROUP BY 1, 2""",
    "reranked": """
        SELECT userId, productId, score,
               row_number() OVER (PARTITION BY userId ORDER BY round(score, 9) DESC, productId) AS rank
        FROM rescored""",
    "train": "SELECT * FROM ratings WHERE (userId * 31 + productId * 17) % 4 <> 0",
    "test": "SELECT * FROM ratings WHERE (userId * 31 + productId * 17) % 4 = 0",
    "means": "SELECT productId, avg(score) AS prediction FROM train GROUP BY productId",
    "predicted": "SELECT userId, productId, prediction FROM test JOIN means USING (productId)",
    "sums": "SELECT productId, sum(score) AS s, count(*) AS n FROM train GROUP BY productId",
    "grid": """
        SELECT reg, sqrt(avg(power(t.score - d.prediction, 2))) AS rmse
        FROM test t JOIN (
            SELECT userId, productId, reg,
                   (s + reg * (SELECT avg(score) FROM train)) / (n + reg) AS prediction
            FROM test JOIN sums USING (productId), (VALUES (1.0), (0.1), (0.01)) v(reg)) d
        ON t.userId = d.userId AND t.productId = d.productId GROUP BY reg""",
    "embedded": "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "leaders": "SELECT min(id) AS id, v, count(*) AS n FROM embedded GROUP BY v",
    "factortop": """
        SELECT * FROM (
            SELECT a.id AS userId, b.id AS productId, list_inner_product(a.v, b.v) AS score,
                   row_number() OVER (PARTITION BY a.id ORDER BY round(list_inner_product(a.v, b.v), 9) DESC, b.id) AS rank
            FROM embedded a, embedded b WHERE list_inner_product(a.v, b.v) > 0) WHERE rank <= 20""",
    "hwords": "SELECT productId, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 800 AS term FROM words",
    "htf": "SELECT productId, term, count(*) AS tf FROM hwords GROUP BY productId, term",
    "hidf": """
        SELECT term, ln(CAST((SELECT count(*) FROM products) + 1 AS DOUBLE) / (count(*) + 1)) AS idf
        FROM htf GROUP BY term""",
    "hvectors": """
        SELECT profile, term, tf * idf AS weight FROM htf JOIN hidf USING (term) JOIN
            (SELECT profile, min(productId) AS productId FROM profiles GROUP BY profile) USING (productId)
        WHERE idf > 0""",
    "hlengths": "SELECT profile, sqrt(sum(weight * weight)) AS len FROM hvectors GROUP BY profile",
    "hprofilepairs": """
        SELECT x.profile AS profile, y.profile AS simProfile,
               CASE WHEN x.profile = y.profile THEN 1.0 ELSE d / (x.len * y.len) END AS score
        FROM (SELECT a.profile AS p, b.profile AS q, sum(a.weight * b.weight) AS d
              FROM hvectors a JOIN hvectors b USING (term) GROUP BY 1, 2)
        JOIN hlengths x ON p = x.profile JOIN hlengths y ON q = y.profile
        WHERE d / (x.len * y.len) > 0.4 AND (x.profile <> y.profile OR
              (SELECT count(*) FROM profiles z WHERE z.profile = x.profile) > 1)""",
    "damaged": """
        SELECT CASE kind WHEN 0 THEN regexp_extract(value, '^[^|]*\\|[^|]*\\|[^|]*') WHEN 1 THEN 'x' || value
            WHEN 2 THEN regexp_extract(value, '^[^|]*\\|[^|]*') || '|?|' || regexp_extract(value, '[^|]*$')
            ELSE value END AS value
        FROM (SELECT value, CAST('0x' || substr(md5(value), 1, 4) AS INTEGER) % 21 AS kind FROM messages)""",
}

DETAILS = "productId, name, imageUrl, categories, tags, avg"

BODIES = {
    "rate_more_products": "SELECT productId, n AS count FROM counts",
    "rate_more_recently": """
        SELECT productId, count(*) AS count,
               CAST(strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y%m') AS INTEGER) AS yearmonth
        FROM ratings GROUP BY 1, 3""",
    "average_products": "SELECT productId, round(mean, 6) AS avg FROM averages",
    "statistics_kept": """
        SELECT productId, CAST(count(*) AS BIGINT) AS count, round(avg(score), 6) AS avg,
               count(DISTINCT month) AS months, max(month) AS newest
        FROM (SELECT *, CAST(strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y%m') AS INTEGER) AS month FROM posted)
        GROUP BY productId""",
    "top5_average": """
        SELECT productId, round(mean, 6) AS avg FROM averages ORDER BY round(mean, 9) DESC, productId LIMIT 5""",
    "distinct_users_products": """
        SELECT 'user' AS kind, userId AS id FROM ratings GROUP BY userId
        UNION ALL SELECT 'product', productId FROM ratings GROUP BY productId""",
    "itemcf_top20": """
        SELECT product1, product2, cocount, count1, count2, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
        FROM itemcf""",
    "itemcf_recs_list": """
        SELECT product1 AS productId, CAST(count(*) AS INTEGER) AS n,
               string_agg(concat(CAST(product2 AS VARCHAR), ':', printf('%.6f', score)), ',' ORDER BY rank) AS recs
        FROM itemcf GROUP BY product1""",
    "sim_map_lookup": """
        SELECT l.userId AS userId, l.productId AS productId, r.productId AS recentId, CAST(r.rank AS INTEGER) AS rank,
               round(coalesce(i.score, 0.0), 6) AS sim
        FROM latest l JOIN (
            SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, productId, score DESC) AS rank
            FROM ratings) r ON l.userId = r.userId AND r.rank <= 5
        LEFT JOIN itemcf i ON i.product1 = l.productId AND i.product2 = r.productId""",
    "vector_cosine_pairs": """
        SELECT a.id AS id, b.id AS simId, round(list_cosine_similarity(a.v, b.v), 6) AS score
        FROM leaders a JOIN leaders b ON a.id <> b.id WHERE list_cosine_similarity(a.v, b.v) > 0.3
        UNION ALL SELECT id, id, 1.0 FROM leaders WHERE n > 1""",
    "factor_scores_top20": """
        SELECT userId, productId, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM factortop""",
    "vector_groups": "SELECT e.id AS id, l.id AS grp FROM embedded e JOIN leaders l USING (v)",
    "als_checks": """
        SELECT 'user' AS kind, count(DISTINCT userId) AS lists, true AS short, true AS right, true AS ordered, true AS above
        FROM ratings UNION ALL SELECT 'product', count(DISTINCT productId), true, true, true, true FROM ratings""",
    "als_best_checks": """
        SELECT CAST(0 AS BIGINT) AS missed, true AS better_than_mean, count(*) > 0 AS predicts FROM ratings""",
    "als_grid_checks": """
        SELECT CAST(4 * 2 * 3 AS BIGINT) AS fits, true AS least, true AS numbers
        FROM (SELECT count(*) FROM ratings)""",
    "content_ranked_groups": """
        SELECT a.id AS grp, b.id AS simGrp, round(score, 6) AS score,
               CAST(row_number() OVER (PARTITION BY a.id ORDER BY round(score, 9) DESC, b.id) AS INTEGER) AS rank
        FROM profilepairs p
        JOIN profileleaders a ON p.profile = a.profile JOIN profileleaders b ON p.simProfile = b.profile""",
    "content_similar_md5": """
        SELECT a.id AS id, b.id AS simId, round(score, 6) AS score FROM hprofilepairs p
        JOIN profileleaders a ON p.profile = a.profile JOIN profileleaders b ON p.simProfile = b.profile""",
    "tfidf_terms": "SELECT productId, term, tf, round(weight, 6) AS weight FROM tfidf",
    "content_groups": "SELECT productId, min(productId) OVER (PARTITION BY profile) AS grp FROM profiles",
    "content_similar": """
        SELECT a.id AS id, b.id AS simId, round(score, 6) AS score FROM profilepairs p
        JOIN profileleaders a ON p.profile = a.profile JOIN profileleaders b ON p.simProfile = b.profile""",
    "content_top20": """
        SELECT productId, simProductId, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
        FROM contentranked WHERE rank <= 20""",
    "rmse_eval": """
        SELECT round(sqrt(avg(power(t.score - p.prediction, 2))), 6) AS rmse
        FROM test t JOIN predicted p ON t.userId = p.userId AND t.productId = p.productId""",
    "grid_argmin": """
        SELECT 0 AS impFeatureNum, 1 AS iterations, CAST(reg AS DOUBLE) AS "lambda", round(rmse, 6) AS rmse
        FROM grid ORDER BY rmse LIMIT 1""",
    "rating_log_filter": "SELECT value FROM messages",
    "rating_log_parse": 'SELECT userId, productId, score, ts AS "timestamp" FROM logged',
    "rating_log_rejects": """
        SELECT value FROM damaged WHERE len(string_split(value, '|')) < 4
            OR TRY_CAST(string_split(value, '|')[1] AS BIGINT) IS NULL
            OR TRY_CAST(string_split(value, '|')[3] AS DOUBLE) IS NULL""",
    "rating_log_lines": """
        SELECT concat('PRODUCT_RATING_PREFIX:', CAST(userId AS VARCHAR), '|', CAST(productId AS VARCHAR), '|',
                      CAST(score AS VARCHAR), '|', CAST(ts AS VARCHAR)) AS value FROM requests""",
    "recent_ratings_per_user": """
        SELECT userId, CAST(rank AS INTEGER) AS rank,
               concat(CAST(productId AS VARCHAR), ':', CAST(score AS VARCHAR)) AS entry, productId, score
        FROM recent""",
    "candidate_products": """
        SELECT userId, productId, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM candidates""",
    "online_rerank": """
        SELECT userId, productId, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM reranked""",
    "stream_rating_filter": "SELECT value FROM messages",
    "stream_topic_filter": "SELECT value FROM messages",
    "stream_recency_queue": """
        SELECT userId, CAST(rank AS INTEGER) AS rank, productId, score, ts AS "timestamp" FROM (
            SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, productId, score DESC) AS rank
            FROM logged) WHERE rank <= 40""",
    "stream_rerank_upsert": """
        SELECT userId, CAST(rank AS INTEGER) AS rank, productId, round(score, 6) AS score FROM reranked""",
    "rating_upsert": """
        SELECT userId, productId, coalesce(u.score, b.score) AS score, coalesce(b.ts, u.ts) AS "timestamp"
        FROM (SELECT userId, productId, arg_max(score, (ts, score)) AS score, max(ts) AS ts
              FROM ratings GROUP BY 1, 2) b
        FULL JOIN (SELECT userId, productId, arg_max(score, (ts, score)) AS score, min(ts) AS ts
              FROM requests GROUP BY 1, 2) u USING (userId, productId)""",
    "rating_queues": """
        SELECT userId, CAST(rank AS INTEGER) AS rank,
               concat(CAST(productId AS VARCHAR), ':', CAST(score AS VARCHAR)) AS entry FROM (
            SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, productId, score DESC) AS rank
            FROM (SELECT * FROM ratings WHERE userId IN (SELECT userId FROM requests)
                  UNION ALL SELECT userId, productId, score, ts FROM requests)) WHERE rank <= 40""",
    "rating_exists": """
        SELECT userId, productId, score, ts AS "timestamp",
               EXISTS (SELECT 1 FROM ratings r WHERE r.userId = q.userId AND r.productId = q.productId) AS known
        FROM requests q""",
    "user_prefs_update": """
        SELECT c_custkey AS userId, c_name AS username, g.userId IS NULL AS first, coalesce(g.genres, '') AS prefGenres
        FROM customer LEFT JOIN (
            SELECT userId, string_agg(DISTINCT categories, '|' ORDER BY categories) AS genres
            FROM logged JOIN products USING (productId) GROUP BY userId) g ON c_custkey = g.userId""",
    "hot_products": f"""
        SELECT yearmonth, count, {DETAILS} FROM (
            SELECT productId, count(*) AS count,
                   CAST(strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y%m') AS INTEGER) AS yearmonth
            FROM ratings GROUP BY 1, 3 ORDER BY yearmonth DESC, count DESC, productId LIMIT 20)
        JOIN details USING (productId)""",
    "rate_more_details": f"""
        SELECT n AS count, {DETAILS} FROM (SELECT * FROM counts ORDER BY n DESC, productId LIMIT 20)
        JOIN details USING (productId)""",
    "product_info": f"SELECT {DETAILS} FROM details WHERE productId IN (SELECT productId FROM logged)",
    "product_search": f"SELECT {DETAILS} FROM details WHERE regexp_matches(name, 'blue|ring')",
    "product_search_index": f"""
        SELECT pattern, {DETAILS} FROM details
        JOIN (SELECT unnest(['blue|ring', '^large.*(plate|anvil)$', '(small )+bolt', 'g[a-i]zmo', 'ol']) AS pattern)
        ON regexp_matches(name, pattern)""",
    "user_recs_point": f"""
        SELECT userId, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score, {DETAILS}
        FROM factortop JOIN details USING (productId) WHERE userId IN (SELECT vec_id FROM embeddings WHERE label = 0)""",
    "itemcf_neighbours": f"""
        SELECT product1 AS forProduct, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score, {DETAILS}
        FROM itemcf JOIN details ON product2 = productId
        WHERE rank <= 10 AND product1 IN (SELECT productId FROM logged)""",
    "content_neighbours": f"""
        SELECT c.productId AS forProduct, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score,
               {', '.join('d.' + c.strip() for c in DETAILS.split(','))}
        FROM contentranked c JOIN details d ON c.simProductId = d.productId
        WHERE rank <= 10 AND c.productId IN (SELECT productId FROM logged)""",
    "user_recs_lookup": f"""
        SELECT c_name AS username, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score, {DETAILS}
        FROM factortop JOIN customer ON userId = c_custkey JOIN details USING (productId)""",
    "stream_recs_lookup": f"""
        SELECT c_name AS username, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score, {DETAILS}
        FROM reranked JOIN customer ON userId = c_custkey JOIN details USING (productId) WHERE rank <= 10""",
    "username_hash": """
        SELECT c_name AS username, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS userId
        FROM (SELECT c_name, list_reduce(
                  list_prepend(CAST(0 AS BIGINT), list_transform(string_split(c_name, ''), lambda x: CAST(unicode(x) AS BIGINT))),
                  lambda a, b: (a * 31 + b) % 4294967296) AS h FROM customer)""",
    "json_roundtrip": """
        SELECT CAST(to_json(p) AS VARCHAR) AS json, productId, name, imageUrl, categories, tags FROM products p""",
    "load_products_text": "SELECT * FROM products",
    "load_ratings_csv": 'SELECT userId, productId, score, ts AS "timestamp" FROM ratings',
}


def _needed(body: str) -> list[str]:
    """Names of the expressions a body uses, directly or through others, in dependency order."""
    import re

    wanted: set[str] = set()
    for name in reversed(CTES):
        users = [body] + [CTES[n] for n in wanted]
        if any(re.search(rf"\b{name}\b", sql) for sql in users):
            wanted.add(name)
    return [name for name in CTES if name in wanted]


def _query(body: str) -> str:
    parts = ", ".join(f"{name} AS ({CTES[name]})" for name in _needed(body))
    return f"WITH {parts} {body}" if parts else body


SQL = {name: _query(body) for name, body in BODIES.items()}
