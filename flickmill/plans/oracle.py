"""DuckDB twins of the registered queries (correctness oracle).

Shared CTEs mirror the adapters in ``flickmill.sources.adapters``; every
computed column carries the same alias as on the Spark side.
"""

from __future__ import annotations

RATINGS = """
ratings AS (
  SELECT uid, mid, score, "timestamp" FROM (
    SELECT CAST(o_custkey AS INTEGER) AS uid, CAST(l_partkey AS INTEGER) AS mid,
           CAST(ceil(l_quantity / 5.0) / 2.0 AS DOUBLE) AS score,
           CAST(floor(epoch(o_orderdate)) AS INTEGER) AS "timestamp",
           row_number() OVER (PARTITION BY o_custkey, l_partkey
             ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn_
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t
  WHERE rn_ = 1)"""

MOVIES = """
movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name, p_name AS descri,
         CAST(p_size AS VARCHAR) AS timelong, coalesce(s.issue, '') AS issue,
         '' AS shoot, '' AS language,
         concat_ws('|', p_type, p_brand, replace(p_name, ' ', '|')) AS genres,
         '' AS actors, '' AS directors
  FROM part LEFT JOIN (SELECT l_partkey, strftime(min(l_shipdate), '%Y-%m-%d') AS issue
                       FROM lineitem GROUP BY l_partkey) s ON s.l_partkey = p_partkey)"""

TAGS = """
tags AS (
  SELECT CAST(user_id AS INTEGER) AS uid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         event_type AS tag, CAST(floor(epoch(ts)) AS INTEGER) AS "timestamp"
  FROM events)"""

AVERAGES = """
averages AS (SELECT mid, round(avg(score), 6) AS "avg" FROM ratings GROUP BY mid)"""

RECENT = """
recent AS (
  SELECT * FROM (
    SELECT uid, mid, score, "timestamp",
           CAST(row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid ASC) AS INTEGER) AS rank
    FROM ratings) t WHERE rank <= 20)"""

# TF-IDF over the content columns, exact terms; cosine of every pair sharing
# a term, rounded to 9 places then cut.
CONTENT_SIMS = """
items AS (SELECT CAST(p_partkey AS INTEGER) AS mid,
                 concat_ws('|', p_type, p_brand, replace(p_name, ' ', '|')) AS genres FROM part),
toks AS (SELECT mid, unnest(string_split_regex(lower(replace(genres, '|', ' ')), '\\s')) AS term FROM items),
tf AS (SELECT mid, term, CAST(count(*) AS DOUBLE) AS tf FROM toks GROUP BY mid, term),
ndocs AS (SELECT count(*) AS n FROM items),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT tf.mid, tf.term, tf.tf * ln((ndocs.n + 1.0) / (dfs.df + 1.0)) AS w
      FROM tf JOIN dfs USING (term) CROSS JOIN ndocs),
nw AS (SELECT * FROM w WHERE w <> 0),
norms AS (SELECT mid, sqrt(sum(w * w)) AS norm FROM nw GROUP BY mid),
dots AS (SELECT a.mid AS m1, b.mid AS m2, sum(a.w * b.w) AS d
         FROM nw a JOIN nw b ON a.term = b.term AND a.mid <> b.mid GROUP BY a.mid, b.mid),
sims AS (SELECT m1, m2, round(d / (n1.norm * n2.norm), 9) AS sim
         FROM dots JOIN norms n1 ON n1.mid = m1 JOIN norms n2 ON n2.mid = m2)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


SQL: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    SQL[name] = sql.strip()


# ---- 2.1 sources ----------------------------------------------------------
register("load_movies", with_(MOVIES) + "SELECT * FROM movies")
register("load_tags", with_(TAGS) + "SELECT uid, mid, tag, \"timestamp\" FROM tags")
register("load_ratings", with_(RATINGS) + "SELECT uid, mid, score, \"timestamp\" FROM ratings")
register("read_table", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
register("parse_rating_events", """
SELECT CAST(user_id AS INTEGER) AS uid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
       CAST(ceil(least(value, 50.0) / 5.0) / 2.0 AS DOUBLE) AS score,
       CAST(floor(epoch(ts)) AS INTEGER) AS "timestamp", event_id
FROM events""")
register("extract_rating_log", """
SELECT concat_ws('|', CAST(user_id AS VARCHAR), json_extract_string(props, '$.k'),
                 CAST(CAST(ceil(least(value, 50.0) / 5.0) / 2.0 AS DOUBLE) AS VARCHAR),
                 CAST(CAST(floor(epoch(ts)) AS INTEGER) AS VARCHAR)) AS value, event_id
FROM events WHERE event_type = 'purchase'""")
register("parse_recent_list", with_(RATINGS, RECENT) + "SELECT uid, rank, mid, score FROM recent")

# ---- 2.3 projections ------------------------------------------------------
register("ratings_triplets", with_(RATINGS) + "SELECT uid, mid, score FROM ratings")
register("content_input", """
SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name,
       replace(concat_ws('|', p_type, p_brand, replace(p_name, ' ', '|')), '|', ' ') AS genres
FROM part""")
register("lookup_by_key", with_(RATINGS) + """
SELECT r.* FROM ratings r WHERE r.uid IN
  (SELECT CAST(c_custkey AS INTEGER) FROM customer WHERE c_mktsegment = 'BUILDING')""")
register("tags_of_movie", with_(TAGS) + """
SELECT t.* FROM tags t WHERE t.mid IN (SELECT CAST(p_partkey AS INTEGER) FROM part WHERE p_size > 40)""")
register("tags_of_user_movie", with_(TAGS, RATINGS) + """
SELECT t.* FROM tags t WHERE EXISTS (SELECT 1 FROM ratings r WHERE r.uid = t.uid AND r.mid = t.mid)""")
register("key_exists", with_(RATINGS) + """
SELECT CAST(p_partkey AS INTEGER) AS mid,
       EXISTS (SELECT 1 FROM ratings r WHERE r.mid = CAST(p_partkey AS INTEGER)) AS "exists"
FROM part""")
register("ratings_of_user", with_(RATINGS) + """
SELECT r.* FROM ratings r WHERE r.uid IN
  (SELECT CAST(c_custkey AS INTEGER) FROM customer WHERE c_nationkey = 7)""")

# ---- 2.4 joins ------------------------------------------------------------
register("movies_with_tags", with_(MOVIES, TAGS) + """
SELECT m.*, t.tags FROM movies m LEFT JOIN
  (SELECT mid, array_to_string(list_sort(list_distinct(list(tag))), '|') AS tags
   FROM tags GROUP BY mid) t USING (mid)""")
register("movies_with_avg", with_(MOVIES, RATINGS, AVERAGES) + """
SELECT m.*, coalesce(a."avg", 0.0) AS score FROM movies m LEFT JOIN averages a USING (mid)""")
register("my_rated_movies", with_(MOVIES, RATINGS) + """
SELECT r.uid, r.mid, r.score, m.name, m.genres FROM ratings r JOIN movies m USING (mid)""")
register("movies_for_recs", with_(MOVIES, RATINGS) + """
SELECT r.rank, m.mid, m.name, m.issue FROM
  (SELECT mid, CAST(row_number() OVER (ORDER BY cnt DESC, mid) AS INTEGER) AS rank
   FROM (SELECT mid, count(*) AS cnt FROM ratings GROUP BY mid)) r
JOIN movies m USING (mid) WHERE r.rank <= 10""")

# ---- 2.5 aggregations -----------------------------------------------------
register("tags_per_movie", with_(TAGS) + """
SELECT mid, array_to_string(list_sort(list_distinct(list(tag))), '|') AS tags FROM tags GROUP BY mid""")
register("distinct_users", with_(RATINGS) + "SELECT DISTINCT uid FROM ratings")
register("distinct_movies", with_(RATINGS) + "SELECT DISTINCT mid FROM ratings")
register("rating_histogram", with_(RATINGS) + """
SELECT uid, CAST(floor(score / 0.5 + 0.5) AS INTEGER) AS bucket, count(*) AS n
FROM ratings GROUP BY 1, 2""")
register("rate_more_movies", with_(RATINGS) + "SELECT mid, count(*) AS count FROM ratings GROUP BY mid")
register("rate_more_recently", with_(RATINGS) + """
SELECT CAST(strftime(to_timestamp("timestamp"), '%Y%m') AS INTEGER) AS yeahmonth, mid, count(*) AS count
FROM ratings GROUP BY 1, 2""")
register("average_movies", with_(RATINGS, AVERAGES) + "SELECT mid, \"avg\" FROM averages")
register("genres_top_movies", with_(MOVIES, RATINGS, AVERAGES) + """
SELECT genres, mid, score, rank FROM (
  SELECT g.genres, g.mid, a."avg" AS score,
         CAST(row_number() OVER (PARTITION BY g.genres ORDER BY a."avg" DESC, g.mid) AS INTEGER) AS rank
  FROM (SELECT DISTINCT mid, unnest(string_split(genres, '|')) AS genres FROM movies) g
  JOIN averages a USING (mid) WHERE g.genres <> '') t WHERE rank <= 10""")

# ---- 2.6 ranking ----------------------------------------------------------
register("recent_k_ratings", with_(RATINGS, RECENT) + "SELECT uid, rank, mid, score, \"timestamp\" FROM recent")
register("hot_movies", with_(RATINGS) + """
SELECT yeahmonth, mid, count FROM (
  SELECT CAST(strftime(to_timestamp("timestamp"), '%Y%m') AS INTEGER) AS yeahmonth, mid, count(*) AS count
  FROM ratings GROUP BY 1, 2) ORDER BY yeahmonth DESC, count DESC, mid LIMIT 10""")
register("most_rated_movies", with_(RATINGS) + """
SELECT mid, count(*) AS count FROM ratings GROUP BY mid ORDER BY count DESC, mid LIMIT 10""")
register("newest_movies", with_(MOVIES) + """
SELECT mid, name, issue FROM movies ORDER BY issue DESC NULLS LAST, mid LIMIT 10""")
register("top_in_genre", with_(MOVIES, RATINGS, AVERAGES) + """
SELECT genres, mid, score, rank FROM (
  SELECT g.genres, g.mid, a."avg" AS score,
         CAST(row_number() OVER (PARTITION BY g.genres ORDER BY a."avg" DESC, g.mid) AS INTEGER) AS rank
  FROM (SELECT DISTINCT mid, unnest(string_split(genres, '|')) AS genres FROM movies) g
  JOIN averages a USING (mid) WHERE g.genres <> '') t
WHERE rank <= 5 AND genres IN ('ECONOMY', 'PROMO')""")

# ---- 2.8 scalar functions -------------------------------------------------
register("scalar_functions", """
SELECT uid, username,
       CAST(CASE WHEN h_ >= 2147483648 THEN h_ - 4294967296 ELSE h_ END AS INTEGER) AS name_uid,
       half, bucket, lg
FROM (
  SELECT CAST(c_custkey AS INTEGER) AS uid, c_name AS username,
         list_reduce(list_transform(string_split(c_name, ''), lambda x: CAST(ascii(x) AS BIGINT)),
                     lambda h, x: (h * 31 + x) % 4294967296, CAST(0 AS BIGINT)) AS h_,
         CAST(round(CAST(CAST(c_acctbal / 2.0 AS VARCHAR) AS DECIMAL(38, 12)), 2) AS DOUBLE) AS half,
         CAST(floor((abs(c_acctbal) % 5.0) / 0.5 + 0.5) AS INTEGER) AS bucket,
         log10(greatest(c_nationkey, 1)) AS lg
  FROM customer) t""")
register("text_functions", """
SELECT CAST(p_partkey AS INTEGER) AS mid,
       string_split(p_name, ' ')[1] AS first_word,
       replace(concat_ws('|', p_type, p_brand, replace(p_name, ' ', '|')), '|', ' ') AS blanks,
       len(string_split_regex(lower(replace(concat_ws('|', p_type, p_brand, replace(p_name, ' ', '|')), '|', ' ')), '\\s')) AS n_tokens,
       concat_ws('|', p_brand, p_type) AS appended,
       len(string_split(concat_ws(',', p_type, p_brand), ',')) AS n_prefs
FROM part""")

# ---- 2.9 content model (exact terms) ---------------------------------------
register("term_frequency", with_(CONTENT_SIMS) + "SELECT mid, term, tf FROM tf")
register("document_frequency", with_(CONTENT_SIMS) + """
SELECT term, df, round(ln((n + 1.0) / (df + 1.0)), 6) AS idf FROM dfs CROSS JOIN ndocs""")
register("tfidf", with_(CONTENT_SIMS) + "SELECT mid, term, round(w, 6) AS w FROM w")
register("vector_norms", with_(CONTENT_SIMS) + "SELECT mid, round(norm, 6) AS norm FROM norms")
register("item_similarity_content", with_(CONTENT_SIMS) + "SELECT m1, m2, sim FROM sims WHERE sim > 0.6")
register("similar_items_all", with_(CONTENT_SIMS) + """
SELECT m1, CAST(row_number() OVER (PARTITION BY m1 ORDER BY sim DESC, m2) AS INTEGER) AS rank, m2, sim
FROM sims WHERE sim > 0.6""")

# ---- online scoring (batch twin of the streaming job) ---------------------
ONLINE = """
anchors AS (SELECT uid, mid AS anchor FROM recent WHERE rank = 1),
cands AS (
  SELECT * FROM (
    SELECT a.uid, a.anchor, s.m2 AS mid, s.sim,
           CAST(row_number() OVER (PARTITION BY a.uid, a.anchor ORDER BY s.sim DESC, s.m2) AS INTEGER) AS rank
    FROM anchors a JOIN sims s ON s.m1 = a.anchor AND s.sim > 0.6
    WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.uid = a.uid AND r.mid = s.m2)) t
  WHERE rank <= 20),
scored AS (
  SELECT c.uid, c.mid,
         round(avg(s.sim * r.score)
               + log10(greatest(count(*) FILTER (WHERE r.score > 3), 1))
               - log10(greatest(count(*) FILTER (WHERE r.score <= 3), 1)), 6) AS score
  FROM cands c JOIN recent r ON r.uid = c.uid
  JOIN sims s ON s.m1 = c.mid AND s.m2 = r.mid AND s.sim > 0.7
  GROUP BY c.uid, c.mid)"""
register("unseen_similar", with_(RATINGS, RECENT, CONTENT_SIMS, ONLINE) +
         "SELECT uid, anchor, rank, mid, sim FROM cands")
register("stream_priority", with_(RATINGS, RECENT, CONTENT_SIMS, ONLINE) +
         "SELECT uid, mid, score FROM scored")
register("stream_recs_batch", with_(RATINGS, RECENT, CONTENT_SIMS, ONLINE) + """
SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS rank,
       mid, score FROM scored""")

# ---- latent similarity ------------------------------------------------------
LATENT = """
latent AS (
  SELECT m1, m2, sim FROM (
    SELECT CAST(a.vec_id AS INTEGER) AS m1, CAST(b.vec_id AS INTEGER) AS m2,
           round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
                 / (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])))
                    * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))), 9) AS sim
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) t
  WHERE sim > 0.2)"""
register("item_similarity_latent", with_(LATENT) + "SELECT m1, m2, sim FROM latent")

# ---- blending ---------------------------------------------------------------
GENRE_TOP = """
genre_top AS (
  SELECT genres, mid, score, rank FROM (
    SELECT g.genres, g.mid, a."avg" AS score,
           CAST(row_number() OVER (PARTITION BY g.genres ORDER BY a."avg" DESC, g.mid) AS INTEGER) AS rank
    FROM (SELECT DISTINCT mid, unnest(string_split(genres, '|')) AS genres FROM movies) g
    JOIN averages a USING (mid) WHERE g.genres <> '') t WHERE rank <= 10)"""
USERS = """
users AS (
  SELECT CAST(c_custkey AS INTEGER) AS uid, c_name AS username, false AS first,
         CAST(0 AS BIGINT) AS "timestamp",
         [(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'])[(c_custkey % 6) + 1]] AS prefGenres
  FROM customer)"""
COLD = """
cold AS (
  SELECT u.uid, t.rank, t.mid, t.score
  FROM users u JOIN genre_top t ON t.genres = string_split(u.prefGenres[1], ' ')[1]
  WHERE t.rank <= 10)"""
STREAM = """
stream AS (SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS rank,
                  mid, score FROM scored)"""
LIKE_LISTS = """
m_fld AS (SELECT mid, 'name' AS field, p_name AS body FROM items JOIN part ON p_partkey = mid
          UNION ALL SELECT mid, 'genres' AS field, genres AS body FROM items),
m_toks AS (SELECT field, mid, unnest(regexp_split_to_array(lower(body), '[^\\p{L}\\p{N}]+')) AS term FROM m_fld),
m_post AS (SELECT field, mid, term, count(*) AS tf FROM m_toks WHERE term <> '' GROUP BY ALL),
m_lens AS (SELECT field, mid, count(*) FILTER (WHERE term <> '') AS dl FROM m_toks GROUP BY ALL),
m_avgdl AS (SELECT field, avg(dl) AS avgdl FROM m_lens GROUP BY field),
m_st AS (SELECT field, term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM m_post, ndocs GROUP BY field, term, n),
m_seeds AS (SELECT DISTINCT anchor AS mid FROM anchors),
m_terms AS (SELECT qid, term FROM (
  SELECT t.mid AS qid, t.term, row_number() OVER (PARTITION BY t.mid ORDER BY round(t.tf * i.idf, 9) DESC, t.term) AS r
  FROM (SELECT mid, term, sum(tf) AS tf FROM m_post JOIN m_seeds USING (mid) GROUP BY mid, term) t
  JOIN (SELECT term, max(idf) AS idf FROM m_st GROUP BY term) i USING (term)) x WHERE r <= 25),
m_hits AS (
  SELECT q.qid, p.field, p.mid, sum(s.idf * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / a.avgdl))) AS s
  FROM m_terms q JOIN m_post p USING (term) JOIN m_st s ON s.field = p.field AND s.term = p.term
  JOIN m_lens l ON l.field = p.field AND l.mid = p.mid JOIN m_avgdl a ON a.field = p.field
  WHERE p.mid <> q.qid GROUP BY q.qid, p.field, p.mid),
like_lists AS (
  SELECT qid, mid, score FROM (
    SELECT qid, mid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, mid) AS r
    FROM (SELECT qid, mid, round(max(s), 9) AS score FROM m_hits GROUP BY qid, mid) b) t WHERE r <= 10)"""
HYBRID = """
lists AS (
  SELECT uid, mid, score, 0 AS src FROM (
    SELECT a.uid, s.m2 AS mid, s.sim AS score,
           row_number() OVER (PARTITION BY a.uid ORDER BY s.sim DESC, s.m2) AS r
    FROM anchors a JOIN sims s ON s.m1 = a.anchor AND s.sim > 0.6) x WHERE r <= 10
  UNION ALL
  SELECT a.uid, m.mid, m.score, 1 AS src FROM anchors a JOIN like_lists m ON m.qid = a.anchor
  UNION ALL
  SELECT uid, mid, score, 2 AS src FROM stream WHERE rank <= 10),
weighted AS (
  SELECT uid, mid, round(score * CASE src WHEN 0 THEN 0.3 WHEN 1 THEN 0.3 ELSE 0.4 END, 6) AS score, src
  FROM lists),
hybrid AS (
  SELECT * FROM (
    SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid, src) AS INTEGER) AS rank,
           mid, score, src FROM weighted) t WHERE rank <= 10)"""
ALL_ONLINE = (RATINGS, RECENT, CONTENT_SIMS, ONLINE, STREAM)
register("cold_start_recs", with_(MOVIES, RATINGS, AVERAGES, GENRE_TOP, USERS, COLD) +
         "SELECT uid, rank, mid, score FROM cold")
register("hybrid_recs", with_(*ALL_ONLINE, LIKE_LISTS, HYBRID) + "SELECT uid, rank, mid, score, src FROM hybrid")
register("guess_recs", with_(*ALL_ONLINE, LIKE_LISTS, HYBRID, MOVIES, AVERAGES, GENRE_TOP, USERS, COLD) + """
SELECT uid, rank, mid, score FROM hybrid
UNION ALL
SELECT uid, rank, mid, score FROM cold WHERE uid NOT IN (SELECT uid FROM hybrid)""")
register("wish_recs", with_(*ALL_ONLINE, MOVIES, AVERAGES, GENRE_TOP, USERS, COLD) + """
SELECT uid, rank, mid, score FROM stream WHERE rank <= 10
UNION ALL
SELECT uid, rank, mid, score FROM cold WHERE uid NOT IN (SELECT uid FROM stream)""")

# ---- maintenance ------------------------------------------------------------
CHANGES = """
changes AS (
  SELECT CAST(user_id AS INTEGER) AS uid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         CAST(round(CAST(CAST(CAST(ceil(least(value, 50.0) / 5.0) AS DOUBLE) / 2.0 AS VARCHAR) AS DECIMAL(38, 12)), 2) AS DOUBLE) AS score,
         CAST(floor(epoch(ts)) AS INTEGER) AS "timestamp", event_id
  FROM events),
last_change AS (
  SELECT uid, mid, score, "timestamp" FROM (
    SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY "timestamp" DESC, event_id DESC) AS rn_
    FROM changes) t WHERE rn_ = 1)"""
register("merge_ratings", with_(RATINGS, CHANGES) + """
SELECT coalesce(o.uid, n.uid) AS uid, coalesce(o.mid, n.mid) AS mid,
       coalesce(n.score, o.score) AS score, coalesce(o."timestamp", n."timestamp") AS "timestamp"
FROM ratings o FULL OUTER JOIN last_change n ON o.uid = n.uid AND o.mid = n.mid""")
register("delete_by_key", with_(RATINGS) + """
SELECT * FROM ratings WHERE uid NOT IN
  (SELECT CAST(c_custkey AS INTEGER) FROM customer WHERE c_nationkey = 3)""")
register("append_tags", with_(TAGS) + """,
cutoff AS (SELECT CAST(epoch(TIMESTAMP '2024-01-15 00:00:00') AS INTEGER) AS c),
old AS (SELECT mid, array_to_string(list_sort(list_distinct(list(tag))), '|') AS tags
        FROM tags, cutoff WHERE "timestamp" < c GROUP BY mid),
new AS (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
               string_agg(event_type, '|' ORDER BY floor(epoch(ts)), event_id) AS added
        FROM events, cutoff WHERE floor(epoch(ts)) >= c GROUP BY 1),
docs AS (SELECT CAST(p_partkey AS INTEGER) AS mid FROM part)
SELECT d.mid, CASE WHEN concat_ws('|', o.tags, n.added) = '' THEN NULL ELSE concat_ws('|', o.tags, n.added) END AS tags
FROM docs d LEFT JOIN old o USING (mid) LEFT JOIN new n USING (mid)""")
register("insert_users_if_absent", with_(USERS) + """,
names AS (
  SELECT printf('Customer#%09d', user_id) AS username, CAST(floor(epoch(ts)) AS INTEGER) AS ts FROM events
  UNION ALL
  SELECT 'guest' || CAST(user_id AS VARCHAR), CAST(floor(epoch(ts)) AS INTEGER) FROM events),
fresh AS (SELECT username, min(ts) AS ts FROM names WHERE username NOT IN (SELECT username FROM users)
          GROUP BY username)
SELECT uid, username, first, "timestamp", array_to_string(prefGenres, '|') AS prefs FROM users
UNION ALL
SELECT CAST(CASE WHEN h_ >= 2147483648 THEN h_ - 4294967296 ELSE h_ END AS INTEGER), username, true,
       CAST(ts AS BIGINT), '' FROM (
  SELECT username, ts,
         list_reduce(list_transform(string_split(username, ''), lambda x: CAST(ascii(x) AS BIGINT)),
                     lambda h, x: (h * 31 + x) % 4294967296, CAST(0 AS BIGINT)) AS h_
  FROM fresh) t""")
register("merge_preferences", with_(USERS) + """,
prefs AS (
  SELECT printf('Customer#%09d', e.user_id) AS username, p.p_type || ',' || p.p_brand AS genres,
         floor(epoch(e.ts)) AS ts, e.event_id
  FROM events e JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
  WHERE e.event_type = 'signup'),
added AS (SELECT username, string_agg(genres, ',' ORDER BY ts, event_id) AS g FROM prefs GROUP BY username)
SELECT u.uid, u.username, CASE WHEN a.g IS NULL THEN u.first ELSE false END AS first, u."timestamp",
       CASE WHEN a.g IS NULL THEN array_to_string(u.prefGenres, '|')
            ELSE array_to_string(list_concat(u.prefGenres, string_split(a.g, ',')), '|') END AS prefs
FROM users u LEFT JOIN added a USING (username)""")

# ---- search -----------------------------------------------------------------
INDEX = """
docs AS (SELECT CAST(doc_id AS INTEGER) AS mid, regexp_extract(text, '^\\s*(\\S+(\\s+\\S+){0,4})', 1) AS name,
                text AS descri FROM documents),
fld AS (SELECT mid, 'name' AS field, name AS body FROM docs
        UNION ALL SELECT mid, 'descri' AS field, descri AS body FROM docs),
toks AS (SELECT field, mid, unnest(regexp_split_to_array(lower(body), '[^\\p{L}\\p{N}]+')) AS term FROM fld),
post AS (SELECT field, mid, term, count(*) AS tf FROM toks WHERE term <> '' GROUP BY ALL),
lens AS (SELECT field, mid, count(*) FILTER (WHERE term <> '') AS dl FROM toks GROUP BY ALL),
avgdl AS (SELECT field, avg(dl) AS avgdl FROM lens GROUP BY field),
ndoc AS (SELECT count(*) AS n FROM docs),
st AS (SELECT field, term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf
       FROM post, ndoc GROUP BY field, term, n)"""
BM25 = """
hits AS (
  SELECT q.qid, p.field, p.mid,
         sum(s.idf * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / a.avgdl))) AS s
  FROM qterms q JOIN post p USING (term) JOIN st s ON s.field = p.field AND s.term = p.term
  JOIN lens l ON l.field = p.field AND l.mid = p.mid JOIN avgdl a ON a.field = p.field
  GROUP BY q.qid, p.field, p.mid),
best AS (SELECT qid, mid, round(max(s), 9) AS score FROM hits GROUP BY qid, mid)"""
register("text_search", with_(INDEX) + """,
queries AS (SELECT CAST(item_id AS INTEGER) AS qid, text FROM benchmark),
qterms AS (SELECT DISTINCT qid, term FROM
           (SELECT qid, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term FROM queries)
           WHERE term <> ''),""" + BM25 + """
SELECT qid, rank, mid, round(score, 6) AS score FROM (
  SELECT qid, mid, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, mid) AS INTEGER) AS rank
  FROM best) t WHERE rank <= 100""")
register("more_like_this", with_(INDEX) + """,
tfall AS (SELECT mid, term, sum(tf) AS tf FROM post GROUP BY mid, term),
idfall AS (SELECT term, max(idf) AS idf FROM st GROUP BY term),
seedw AS (SELECT t.mid AS qid, t.term, round(t.tf * i.idf, 9) AS w FROM tfall t JOIN idfall i USING (term)),
qterms AS (SELECT qid, term FROM (
  SELECT qid, term, row_number() OVER (PARTITION BY qid ORDER BY w DESC, term) AS r FROM seedw) x WHERE r <= 25),""" + BM25 + """
SELECT qid, rank, mid, round(score, 6) AS score FROM (
  SELECT qid, mid, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, mid) AS INTEGER) AS rank
  FROM best WHERE mid <> qid) t WHERE rank <= 10""")
register("fuzzy_genre_search", """
WITH items AS (SELECT CAST(p_partkey AS INTEGER) AS mid,
                      concat_ws('|', p_type, p_brand, replace(p_name, ' ', '|')) AS genres FROM part),
gt AS (SELECT DISTINCT mid, token FROM
       (SELECT mid, unnest(regexp_split_to_array(lower(genres), '[^\\p{L}\\p{N}]+')) AS token FROM items)
       WHERE token <> ''),
voc AS (SELECT token, count(*) AS df FROM gt GROUP BY token),
nd AS (SELECT count(*) AS n FROM items),
terms AS (SELECT DISTINCT p_type AS qid, lower(substring(p_type, 1, length(p_type) - 1)) AS term FROM part),
m AS (SELECT qid, term, token, levenshtein(term, token) AS dist FROM terms CROSS JOIN voc
      WHERE levenshtein(term, token) <= CASE WHEN length(term) <= 2 THEN 0 WHEN length(term) <= 5 THEN 1 ELSE 2 END),
sc AS (SELECT m.qid, g.mid,
              round(max(ln(1 + (nd.n - v.df + 0.5) / (v.df + 0.5)) * (1 - m.dist / length(m.term))), 9) AS score
       FROM m JOIN voc v USING (token) JOIN gt g USING (token) CROSS JOIN nd GROUP BY m.qid, g.mid)
SELECT qid, rank, mid, round(score, 6) AS score FROM (
  SELECT qid, mid, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, mid) AS INTEGER) AS rank
  FROM sc) t WHERE rank <= 100""")

# ---- model-side keys with a SQL form -------------------------------------------
register("rmse", with_(RATINGS, AVERAGES) + """
SELECT round(sqrt(avg(pow(r.score - a."avg", 2))), 6) AS rmse FROM ratings r JOIN averages a USING (mid)""")
register("user_top_n", with_(RATINGS) + """
SELECT * FROM (SELECT uid, mid, score,
  CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS rank FROM ratings) t
WHERE rank <= 20""")
USER_TOP = """
top AS (SELECT * FROM (SELECT uid, mid, score,
          CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS rank FROM ratings) t
        WHERE rank <= 20)"""
register("recs_to_lists", with_(RATINGS) + "," + USER_TOP + """
SELECT uid, CAST(count(*) AS INTEGER) AS n,
       string_agg(CAST(mid AS VARCHAR) || ':' || CAST(CAST(round(score * 1000) AS BIGINT) AS VARCHAR), ',' ORDER BY rank) AS recs
FROM top GROUP BY uid""")
register("recs_top_n", with_(RATINGS) + "," + USER_TOP + """
SELECT uid, rank, mid, score FROM top WHERE rank <= 5""")
register("movie_cf_recs", with_(LATENT) + """
SELECT key, mid, score, rank FROM (
  SELECT m1 AS key, m2 AS mid, sim AS score,
         CAST(row_number() OVER (PARTITION BY m1 ORDER BY sim DESC, m2) AS INTEGER) AS rank
  FROM latent) t WHERE rank <= 5""")
register("user_cf_recs", with_(*ALL_ONLINE) + "SELECT uid, mid, score, rank FROM stream WHERE rank <= 5")
register("hits_to_recs", with_(INDEX) + """,
queries AS (SELECT CAST(item_id AS INTEGER) AS qid, text FROM benchmark),
qterms AS (SELECT DISTINCT qid, term FROM
           (SELECT qid, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term FROM queries)
           WHERE term <> ''),""" + BM25 + """
SELECT qid, rank, mid, round(score, 6) AS score FROM (
  SELECT qid, mid, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, mid) AS INTEGER) AS rank
  FROM best) t WHERE rank <= 20""")
register("rating_stream", SQL["parse_rating_events"])
register("bridge_stream", """
SELECT concat_ws('|', CAST(user_id AS VARCHAR), json_extract_string(props, '$.k'),
                 CAST(CAST(ceil(least(value, 50.0) / 5.0) / 2.0 AS DOUBLE) AS VARCHAR),
                 CAST(CAST(floor(epoch(ts)) AS INTEGER) AS VARCHAR)) AS value
FROM events WHERE event_type = 'purchase'""")
register("recent_state", """
SELECT uid, rank, mid, score FROM (
  SELECT CAST(user_id AS INTEGER) AS uid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         CAST(ceil(least(value, 50.0) / 5.0) / 2.0 AS DOUBLE) AS score,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)) DESC, event_id DESC) AS INTEGER) AS rank
  FROM events) t WHERE rank <= 20""")
STREAM_LISTS = """,
ev AS (SELECT CAST(user_id AS INTEGER) AS uid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
              CAST(ceil(least(value, 50.0) / 5.0) / 2.0 AS DOUBLE) AS score,
              CAST(floor(epoch(ts)) AS INTEGER) AS "timestamp", event_id AS seq, day(ts) AS day FROM events),
hist AS (SELECT uid, mid, score, "timestamp", -1 AS seq FROM ratings WHERE uid IN (SELECT uid FROM ev)
         UNION ALL SELECT uid, mid, score, "timestamp", seq FROM ev),
recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, seq DESC, mid) AS rank
                          FROM hist) t WHERE rank <= 20),
anchors AS (SELECT uid, mid AS anchor FROM (
              SELECT *, row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, seq DESC, mid) AS rn FROM ev) t
            WHERE rn = 1),
seen AS (SELECT DISTINCT uid, mid FROM hist),
cands AS (
  SELECT * FROM (
    SELECT a.uid, s.m2 AS mid, s.sim,
           row_number() OVER (PARTITION BY a.uid ORDER BY s.sim DESC, s.m2) AS rank
    FROM anchors a JOIN sims s ON s.m1 = a.anchor AND s.sim > greatest(0.6, {cut})
    WHERE NOT EXISTS (SELECT 1 FROM seen r WHERE r.uid = a.uid AND r.mid = s.m2)) t
  WHERE rank <= 20),
scored AS (
  SELECT a.uid, a.mid,
         round(avg(s.sim * r.score)
               + log10(greatest(count(*) FILTER (WHERE r.score > 3), 1))
               - log10(greatest(count(*) FILTER (WHERE r.score <= 3), 1)), 6) AS score
  FROM cands a JOIN recent r ON r.uid = a.uid
  JOIN sims s ON s.m1 = a.mid AND s.m2 = r.mid AND s.sim > greatest(0.7, {cut})
  GROUP BY a.uid, a.mid)
SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS rank, mid, score
FROM scored"""
register("stream_recs", with_(RATINGS, CONTENT_SIMS) + STREAM_LISTS.format(cut="0.0"))
register("stream_offsets", SQL["stream_recs"])
# users with an event in the second half were scored with the table cut at 0.75
register("similarity_refresh", with_(RATINGS, CONTENT_SIMS) + STREAM_LISTS.format(
    cut="CASE WHEN (SELECT max(day) FROM ev WHERE ev.uid = a.uid) >= 16 THEN 0.75 ELSE 0.0 END"))
register("write_table", with_(RATINGS) + "SELECT mid, count(*) AS count FROM ratings GROUP BY mid")
register("drop_and_load", with_(MOVIES) + "SELECT * FROM movies")
register("upsert_user_recs", with_(*ALL_ONLINE, MOVIES, AVERAGES, GENRE_TOP, USERS, COLD) + """
SELECT uid, rank, mid, score FROM stream WHERE rank <= 10
UNION ALL
SELECT uid, rank, mid, score FROM cold WHERE uid NOT IN (SELECT uid FROM stream)""")
register("search_docs", with_(MOVIES, TAGS) + """
SELECT m.mid, m.name, m.genres, t.tags FROM movies m LEFT JOIN
  (SELECT mid, array_to_string(list_sort(list_distinct(list(tag))), '|') AS tags
   FROM tags GROUP BY mid) t USING (mid)""")
register("vector_functions", """
WITH v AS (SELECT CAST(vec_id AS INTEGER) AS mid, CAST(embedding AS DOUBLE[]) AS f FROM embeddings)
SELECT a.mid, round(list_dot_product(a.f, b.f), 6) AS dot, round(sqrt(list_dot_product(a.f, a.f)), 6) AS norm,
       round(list_dot_product(a.f, b.f) / (sqrt(list_dot_product(a.f, a.f)) * sqrt(list_dot_product(b.f, b.f))), 6) AS cosine
FROM v a JOIN v b ON b.mid = a.mid + 1""")
register("split_ratings", with_(RATINGS) + """
SELECT uid, mid, score, "timestamp",
       CASE WHEN CAST('0x' || substring(md5(concat_ws(':', uid, mid, 7)), 1, 7) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS part
FROM ratings""")
GRID = """
parts AS (SELECT *, CAST('0x' || substring(md5(concat_ws(':', uid, mid, 7)), 1, 7) AS BIGINT) % 100 < 80 AS train FROM ratings),
sums AS (SELECT mid, sum(score) AS s, count(*) AS n FROM parts WHERE train GROUP BY mid),
grid AS (
  SELECT damping, round(sqrt(avg(pow(p.score - (coalesce(s, 0.0) + damping * overall) / (coalesce(n, 0) + damping), 2))), 6) AS rmse
  FROM parts p LEFT JOIN sums USING (mid), (SELECT avg(score) AS overall FROM parts WHERE train) o,
       (SELECT unnest([0.01, 0.1, 1.0])::DOUBLE AS damping) d
  WHERE NOT train GROUP BY damping)"""
register("best_params_report", with_(RATINGS, GRID) + "SELECT damping, rmse FROM grid")
register("best_damping", with_(RATINGS, GRID) + "SELECT damping, rmse FROM grid ORDER BY rmse, damping LIMIT 1")
register("positive_scores", with_(RATINGS, AVERAGES) + """
SELECT mid, pred FROM (SELECT mid, round("avg" - (SELECT round(avg(score), 6) FROM ratings), 6) AS pred FROM averages) t WHERE pred > 0""")
register("user_item_grid", """
SELECT CAST(a.vec_id AS INTEGER) AS uid, CAST(b.vec_id AS INTEGER) AS mid,
       round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS pred
FROM embeddings a CROSS JOIN embeddings b""")
register("predict_given", with_(RATINGS) + """
SELECT r.uid, r.mid, round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS pred
FROM ratings r JOIN embeddings a ON a.vec_id = r.uid JOIN embeddings b ON b.vec_id = r.mid""")
