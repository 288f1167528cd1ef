"""The registered queries again, as SQL over the same driver tables."""

from __future__ import annotations

from itertools import combinations

# Views of FIXTURES.md, and the scorer on top of them.
VIEWS = """
WITH ev AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
latest AS (SELECT max(ts) AS t FROM events),
sizes AS (SELECT user_id, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY user_id),
event_objects AS (
  SELECT 'ev-' || user_id AS uri, CASE WHEN user_id % 4 = 0 THEN 'deu' ELSE 'eng' END AS lang,
    n AS total_article_count, last_ts AS event_date FROM sizes),
popular AS (
  SELECT e.* FROM event_objects e, latest WHERE lang = 'eng' AND total_article_count >= 3 AND event_date >= t - INTERVAL 24 HOUR
  ORDER BY total_article_count DESC, uri LIMIT 30),
breaking AS (
  SELECT e.* FROM event_objects e, latest WHERE lang = 'eng' AND total_article_count >= 3 AND event_date >= t - INTERVAL 6 HOUR
  ORDER BY event_date DESC, uri LIMIT 20),
all_articles AS (
  SELECT CAST(event_id AS VARCHAR) AS id, event_id, 'ev-' || user_id AS event_uri, ts AS published_at,
    ts AS collected_at, event_type || ' ' || user_id AS title,
    'https://src' || (user_id % 20) || '.example.com/' || event_id AS url,
    'src' || (user_id % 20) AS source_name,
    CASE WHEN user_id % 10 <> 0 THEN 1 + (user_id * 7919) % 1000000 END AS source_importance,
    CASE WHEN event_type = 'error' THEN -least(value / 500, 1.0::DOUBLE) ELSE least(value / 500, 1.0::DOUBLE) END AS sentiment,
    sizes.n AS total_articles_in_event,
    ['c/' || k, 'c/' || ((k + user_id) % 100), 't/' || event_type] AS uris
  FROM ev JOIN sizes USING (user_id)),
articles AS (SELECT * FROM all_articles),
trending AS (
  SELECT 'c/' || k AS uri, round(sum(value), 4) AS score, max(ts) AS updated_at FROM ev WHERE k % 3 = 0 GROUP BY k),
entity AS (
  SELECT id, greatest(coalesce(max(score), 0.0::DOUBLE), 0.0::DOUBLE) AS entity_hot_score
  FROM (SELECT id, unnest(uris) AS uri FROM articles) LEFT JOIN trending USING (uri) GROUP BY id),
raw AS (
  SELECT a.*, entity_hot_score,
    ln(1 + total_articles_in_event::DOUBLE) + 0.3::DOUBLE * ln(1 + entity_hot_score) AS hot_score_v2,
    greatest(least((1000001 - coalesce(source_importance, 1000001)) / 1000000.0::DOUBLE, 1.0::DOUBLE), 0.0::DOUBLE) AS rep_norm,
    abs(sentiment) * CASE WHEN sentiment < 0 THEN 1.25::DOUBLE ELSE 1.0::DOUBLE END AS sent_score_v2,
    list_has_any(uris, ['c/3', 'c/7', 't/error']) AS is_routine_topic,
    list_has_any(uris, ['c/5', 't/signup']) AS is_category_topic,
    exp(-((epoch_us(t) - epoch_us(published_at)) / 3600000000.0::DOUBLE) / 6) AS freshness_score
  FROM articles a JOIN entity USING (id), latest),
ext AS (
  SELECT min(hot_score_v2) AS h0, max(hot_score_v2) AS h1, min(sent_score_v2) AS s0, max(sent_score_v2) AS s1,
    min(entity_hot_score) AS e0, max(entity_hot_score) AS e1 FROM raw),
norms AS (
  SELECT raw.*,
    CASE WHEN h0 = h1 THEN 0.5::DOUBLE ELSE (hot_score_v2 - h0) / (h1 - h0) END AS hot_norm_raw,
    CASE WHEN s0 = s1 THEN 0.5::DOUBLE ELSE (sent_score_v2 - s0) / (s1 - s0) END AS sent_norm,
    CASE WHEN e0 = e1 THEN 0.5::DOUBLE ELSE (entity_hot_score - e0) / (e1 - e0) END AS concept_hot_norm,
    freshness_score >= 0.8::DOUBLE AS is_breaking_news
  FROM raw, ext),
flags AS (
  SELECT *, is_routine_topic AND NOT is_breaking_news AS is_suppressed,
    is_category_topic AND NOT is_routine_topic AS is_downweighted FROM norms),
damped AS (
  SELECT *, hot_norm_raw * CASE WHEN is_suppressed THEN 0.3::DOUBLE WHEN is_downweighted THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS hot_norm
  FROM flags),
scored AS (
  SELECT *, rep_norm AS rep_score_v2,
    round(hot_norm * 0.35::DOUBLE + rep_norm * 0.25::DOUBLE + concept_hot_norm * 0.2::DOUBLE
      + freshness_score * 0.15::DOUBLE + sent_norm * 0.05::DOUBLE, 6) AS final_score_v2,
    CAST(published_at + INTERVAL 8 HOUR - INTERVAL 6 HOUR AS DATE) AS logical_date,
    CASE WHEN is_routine_topic AND NOT is_breaking_news THEN '常规话题(非爆点)'
      WHEN is_routine_topic AND is_breaking_news THEN '常规话题(爆点)'
      WHEN is_category_topic THEN '领域话题' ELSE '其他话题' END AS topic_category
  FROM damped),
recent AS (SELECT scored.* FROM scored, latest WHERE published_at >= t - INTERVAL 24 HOUR),
picked AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY logical_date, event_uri ORDER BY final_score_v2 DESC, id) AS rn FROM scored)
  WHERE rn <= 2),
report AS (
  SELECT CAST(logical_date AS VARCHAR) AS logical_date,
    row_number() OVER (PARTITION BY logical_date ORDER BY final_score_v2 DESC, id) AS rank,
    round(CAST(final_score_v2 AS DECIMAL(18, 6)), 4)::DOUBLE AS score, source_name AS source, title, url,
    regexp_replace(strftime(published_at + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S.%f'), '[.]000000$', '') || '+08:00' AS "publishedAt",
    event_uri AS "eventId", id
  FROM picked),
catalogue AS (
  SELECT ts AS modified_at, event_id,
    strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day,
    CASE WHEN user_id % 2 = 0 THEN 'summary_' || strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') || '_'
        || CASE WHEN user_id % 3 = 0 THEN 'manual' ELSE 'scheduled' END || '_' || strftime(ts, '%H-%M-%S') || '.json'
      WHEN user_id % 4 = 1 THEN strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d_%H-%M-%S') || '_daily_briefing.md'
      ELSE strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') || '_notes_' || event_id || '.md' END AS name
  FROM events),
files AS (SELECT *, '/exports/' || name AS path FROM catalogue),
marked AS (
  SELECT *, contains(text, 'token') OR contains(text, 'cookie') OR contains(text, 'License') AS has_conflict,
    contains(text, 'secret') OR contains(text, 'MIT') AS has_bang, contains(text, 'password') AS has_insider FROM documents),
topics AS (
  SELECT doc_id, lang, source, CAST(i AS BIGINT) AS card_no,
    trim(CASE WHEN i = 1 THEN 'A ' || translate(text, chr(13) || chr(10), '  ') || ' Z'
      ELSE 'item ' || i || ' ' || CASE WHEN doc_id % 5 = 0 THEN '见选题 2。' ELSE '' END END) AS content
  FROM documents, range(1, 12) r(i) WHERE i <= doc_id % 12),
cards AS (
  SELECT doc_id AS name, card_no, CASE WHEN doc_id % 3 = 0 THEN '#' || lang || ' #' || source ELSE '' END AS tags,
    'T' || card_no || ' ' || lang AS title, 'S' || (doc_id % 7) AS subtitle, content,
    CASE WHEN doc_id % 3 = 0 THEN 'none' ELSE 'why ' || card_no END AS angle,
    '2024-01-' || lpad(CAST(1 + card_no % 28 AS VARCHAR), 2, '0') AS date, source || '.example.com' AS source,
    CASE WHEN doc_id % 3 = 2 THEN 'none' ELSE 'https://www.' || source || '.example.com/' || doc_id END AS source_url,
    source || '.example.com' AS source_domain
  FROM topics)
"""

STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
REPORT = 'logical_date, rank, score, source, title, url, "publishedAt", "eventId", id'
FLAG_COUNTS = """count(*) AS {total}, count(*) FILTER (is_routine_topic) AS routine_topic_articles,
  count(*) FILTER (is_category_topic) AS category_topic_articles, count(*) FILTER (is_breaking_news) AS breaking_news_articles,
  count(*) FILTER (is_suppressed) AS suppressed_articles, count(*) FILTER (is_downweighted) AS downweighted_articles,
  round(count(*) FILTER (is_suppressed) * 100.0::DOUBLE / count(*), 2) AS suppression_rate,
  round(count(*) FILTER (is_downweighted) * 100.0::DOUBLE / count(*), 2) AS downweight_rate"""
BAND_COUNT, BAND_BITS, SIG_BITS = 10, 6, 60


def rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def stamp(column: str, name: str | None = None) -> str:
    return f"{STAMP.format(column)} AS {name or column}"


def view_of(body: str) -> str:
    return f"{VIEWS} {body}"


# The articles of a daily run: the newest two of each selected event.
SELECTED = """articles AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_uri ORDER BY published_at DESC, id) AS nth FROM all_articles
    WHERE event_uri IN (SELECT uri FROM popular UNION SELECT uri FROM breaking)) WHERE nth <= 2),
"""


def signature_views(source: str, key: str, text: str) -> str:
    """CTEs ``sigs`` (key, sig) and ``near`` (key, sig, earliest)."""
    bits = " + ".join(
        f"CASE WHEN 2 * sum((h >> {b}) & 1) > count(h) THEN {1 << b} ELSE 0 END" for b in range(SIG_BITS))
    stretches = [((1 << BAND_BITS) - 1) << (BAND_BITS * b) for b in range(BAND_COUNT)]
    masks = ", ".join(str(sum(c)) for c in combinations(stretches, 8))
    return f"""
words AS (
  SELECT {key}, unnest(list_filter(string_split_regex(lower({text}), '[ \\t\\r\\n]+'), lambda x: x <> '')) AS w FROM {source}),
hashed AS (SELECT {key}, CAST('0x' || substr(md5(w), 1, 15) AS BIGINT) AS h FROM words),
sigs AS (
  SELECT s.{key}, CAST(coalesce(g.sig, 0) AS BIGINT) AS sig FROM {source} s LEFT JOIN
    (SELECT {key}, {bits} AS sig FROM hashed GROUP BY {key}) g USING ({key})),
masked AS (
  SELECT sig, min({key}) AS first, unnest([{masks}]) AS m FROM sigs GROUP BY sig),
lowest AS (SELECT m, sig & m AS v, min(first) AS low FROM masked GROUP BY m, sig & m),
best AS (
  SELECT masked.sig, min(low) AS earliest FROM masked JOIN lowest ON masked.m = lowest.m AND (masked.sig & masked.m) = lowest.v
  GROUP BY masked.sig),
near AS (SELECT {key}, sig, earliest FROM sigs JOIN best USING (sig))"""


def similar_views(source: str, key: str, text: str) -> str:
    """CTE ``near_sets`` (key, earliest): all pairs of word sets compared."""
    return f"""
word_sets AS (
  SELECT {key}, list_sort(list_distinct(list_filter(string_split_regex(lower({text}), '[ \\t\\r\\n]+'), lambda x: x <> ''))) AS w FROM {source}),
folded AS (SELECT w, min({key}) AS first FROM word_sets GROUP BY w),
pairs AS (
  SELECT a.w AS w, min(b.first) AS earliest FROM folded a JOIN folded b
    ON 5 * len(b.w) >= 4 * len(a.w) AND 5 * len(a.w) >= 4 * len(b.w)
      AND 9 * len(list_intersect(a.w, b.w)) >= 4 * (len(a.w) + len(b.w)) GROUP BY a.w),
near_sets AS (SELECT {key}, earliest FROM word_sets JOIN pairs USING (w))"""


def title_url_views() -> str:
    return """
pg AS (
  SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^https?://(www[.])?', ''), '#.*$', ''),
      '[?&](utm_[a-z]+|ref)=[^&]*', '', 'g'), '/+$', '') AS norm FROM pages),
firsts AS (SELECT min(page_id) AS page_id FROM pg GROUP BY norm)"""


ORACLE: dict[str, str] = {
    "score_articles": view_of(
        "SELECT id, " + rounded("entity_hot_score", "hot_score_v2", "rep_score_v2", "sent_score_v2", "hot_norm_raw", "hot_norm",
                                "rep_norm", "sent_norm", "concept_hot_norm", "freshness_score", "final_score_v2")
        + ", is_routine_topic, is_category_topic, is_breaking_news, is_suppressed, is_downweighted FROM scored"),
    "entity_hot_score": view_of("SELECT id, " + rounded("entity_hot_score") + " FROM entity"),
    "hot_score": view_of("SELECT id, total_articles_in_event, " + rounded("hot_score_v2") + " FROM raw"),
    "authority_score": view_of("SELECT id, " + rounded("rep_norm") + " FROM raw"),
    "sentiment_score": view_of("SELECT id, " + rounded("sent_score_v2") + " FROM raw"),
    "freshness_score": view_of("SELECT id, " + rounded("freshness_score") + " FROM raw"),
    "minmax_normalize": view_of("SELECT id, " + rounded("hot_norm_raw", "sent_norm", "concept_hot_norm") + " FROM norms"),
    "minmax_constant_batch": view_of(
        "SELECT id, 0.5::DOUBLE AS hot_norm_raw, 0.5::DOUBLE AS sent_norm, 0.5::DOUBLE AS concept_hot_norm FROM articles"),
    "topic_flags": view_of("SELECT id, is_routine_topic, is_category_topic FROM raw"),
    "topic_damping": view_of("SELECT id, is_suppressed, is_downweighted, " + rounded("hot_norm_raw", "hot_norm") + " FROM scored"),
    "unscorable_rows": view_of("SELECT id, event_uri FROM articles WHERE source_importance IS NULL"),
    "topic_vector_similarity": """
WITH pos AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
topic AS (SELECT i, avg(x) AS y FROM pos WHERE label = 0 GROUP BY i)
SELECT vec_id, round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 6) AS similarity FROM pos JOIN topic USING (i) GROUP BY vec_id""",
    "legacy_score": """
WITH pos AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
topic AS (SELECT i, avg(x) AS y FROM pos WHERE label = 0 GROUP BY i),
sims AS (SELECT vec_id, sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))) AS similarity FROM pos JOIN topic USING (i) GROUP BY vec_id),
latest AS (SELECT max(ts) AS t FROM events),
s AS (SELECT event_id, 0.4::DOUBLE * (value / 500) + 0.4::DOUBLE * similarity
    + 0.2::DOUBLE * exp(-((epoch_us(t) - epoch_us(ts)) / 3600000000.0::DOUBLE) / 24) AS score
  FROM events JOIN sims ON event_id % (SELECT count(*) FROM embeddings) = vec_id, latest)
SELECT event_id, round(score, 6) AS score FROM s WHERE score > 0.2""",
    "daily_report": view_of(f"SELECT {REPORT} FROM report WHERE logical_date = '2024-01-10'"),
    "daily_report_all_days": view_of(f"SELECT {REPORT} FROM report"),
    "daily_report_top_k": view_of(f"SELECT {REPORT} FROM report WHERE rank <= 100"),
    "report_order": view_of("SELECT row_number() OVER (ORDER BY final_score_v2 DESC, id) AS rank, id, final_score_v2 FROM scored"),
    "report_json": view_of("""
SELECT '2024-02-01T00:00:00.000000+00:00' AS "reportGeneratedAt", logical_date AS "reportForDate",
  count(*) OVER (PARTITION BY logical_date) AS "articleCount", rank, score, r.source, title, url, "publishedAt", "eventId", md5(text) AS body_md5
FROM report r LEFT JOIN documents ON CAST(id AS BIGINT) % (SELECT count(*) FROM documents) = doc_id"""),
    "report_json_top_k": view_of("""
SELECT '2024-02-01T00:00:00.000000+00:00' AS "reportGeneratedAt", logical_date AS "reportForDate",
  count(*) OVER (PARTITION BY logical_date) AS "articleCount", rank, score, source, title, url, "publishedAt", "eventId"
FROM report WHERE rank <= 100"""),
    "report_line_count": view_of("""
SELECT logical_date, count(*) + 2 AS n_lines, count(*) + 1 AS last_line, count(*) - 1 AS n_commas, count(*) AS n_articles
FROM report GROUP BY logical_date"""),
    "report_article_count": view_of("SELECT logical_date, count(*) AS article_count FROM report GROUP BY logical_date"),
    "logical_date_counts": """
SELECT CAST(CAST(ts + INTERVAL 2 HOUR AS DATE) AS VARCHAR) AS logical_date, count(*) AS n FROM events GROUP BY 1""",
    "prev_logical_date": """
SELECT event_id, strftime(ts + INTERVAL 8 HOUR - INTERVAL 1 DAY, '%Y-%m-%d') AS prev_date,
  strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS bj_time FROM events""",
    "logical_day_rows": view_of(
        "SELECT id, " + stamp("published_at") + " FROM articles WHERE CAST(published_at + INTERVAL 8 HOUR - INTERVAL 8 HOUR AS DATE) = DATE '2024-01-10'"),
    "parsed_publish_times": view_of("""
SELECT id, strftime(CASE WHEN event_id % 7 <= 3 THEN date_trunc('second', published_at)
    WHEN event_id % 7 = 4 THEN date_trunc('day', published_at) ELSE TIMESTAMP '2024-02-01 00:00:00' END, '%Y-%m-%d %H:%M:%S.%f') AS published_at,
  event_id % 7 >= 5 AS published_at_imputed FROM articles"""),
    "flatten_articles": view_of("""
SELECT id, title, url, round(sentiment, 6) AS sentiment, source_name, coalesce(source_importance, -1) AS source_importance, event_uri,
  CAST(0 AS BIGINT) AS total_articles_in_event,
  CASE WHEN event_id % 7 = 6 THEN 'none' ELSE array_to_string(uris, ',') END AS uris FROM articles"""),
    "concept_uri_sets": view_of("""
SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'c/' || k || ',t/' || event_type WHEN 2 THEN 'c/' || k
  WHEN 3 THEN 't/' || event_type WHEN 5 THEN 'c/' || k ELSE '' END AS uris FROM ev"""),
    "trending_items": view_of("""
SELECT 'c/' || k AS uri, 'org' AS type, sum(CASE WHEN event_id % 3 = 2 THEN 2 ELSE 1 END)::BIGINT AS n,
  max(event_id)::DOUBLE AS max_score FROM ev GROUP BY k"""),
    "select_popular_events": view_of("SELECT uri, total_article_count, " + stamp("event_date") + " FROM popular"),
    "select_breaking_events": view_of("SELECT uri, total_article_count, " + stamp("event_date") + " FROM breaking"),
    "merge_event_paths": view_of("""
SELECT uri, 'popular' AS path FROM popular UNION ALL
SELECT uri, 'breaking' AS path FROM breaking WHERE uri NOT IN (SELECT uri FROM popular)"""),
    "merge_counters": view_of("""
, u AS (SELECT uri FROM popular UNION ALL SELECT uri FROM breaking)
SELECT count(*) AS n_before, count(DISTINCT uri) AS n_after, count(*) - count(DISTINCT uri) AS n_removed FROM u"""),
    "latest_articles_per_event": view_of("""
SELECT event_uri, id, total_articles_in_event FROM (
  SELECT *, row_number() OVER (PARTITION BY event_uri ORDER BY published_at DESC, id) AS rn FROM articles WHERE total_articles_in_event >= 3)
WHERE rn <= 3"""),
    "source_whitelist": """
SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src3', 'src5', 'src7')""",
    "top_trending_by_type": view_of("""
, t AS (SELECT uri, ['person', 'org', 'loc', 'wiki'][CAST(regexp_extract(uri, '([0-9]+)', 1) AS INTEGER) % 4 + 1] AS type, score FROM trending)
SELECT uri, type, round(score, 6) AS score FROM t WHERE type <> 'wiki' ORDER BY score DESC, uri LIMIT 20"""),
    "insert_ignore": view_of("SELECT id, title FROM articles WHERE published_at >= TIMESTAMP '2024-01-15'"),
    "upsert_latest": view_of("""
, parts AS (SELECT 'c/' || k AS uri, value AS score, ts AS updated_at FROM ev)
SELECT uri, round(score, 6) AS score, strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') AS updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY uri ORDER BY updated_at DESC, score DESC) AS rn FROM parts) WHERE rn = 1"""),
    "unscored_queue": view_of(
        "SELECT id, event_uri FROM articles WHERE published_at >= TIMESTAMP '2024-01-15' AND source_importance IS NOT NULL"),
    "raw_without_summary": "SELECT CAST(event_id AS VARCHAR) AS id FROM events WHERE event_type = 'view'",
    "scored_view": view_of("""
SELECT id, title, CASE WHEN published_at < TIMESTAMP '2024-01-15' THEN final_score_v2 ELSE -1.0::DOUBLE END AS final_score_v2,
  is_suppressed AND published_at < TIMESTAMP '2024-01-15' AS is_suppressed FROM scored"""),
    "split_rejects": view_of(
        "SELECT url, CASE WHEN split_part(title, ' ', 1) IN ('signup', 'error') THEN 'rejected' ELSE 'kept' END AS fate FROM articles"),
    "delete_by_date": view_of(
        "SELECT id, " + stamp("collected_at") + " FROM articles WHERE CAST(collected_at AS DATE) <> DATE '2024-01-10'"),
    "preview_delete": view_of(
        "SELECT id, " + stamp("collected_at") + " FROM articles WHERE CAST(collected_at AS DATE) = DATE '2024-01-10'"),
    "truncate_requeues_all": "SELECT count(*) AS n_rows FROM events",
    "unify_sources": view_of("""
SELECT id, title, url, source_name AS source, 'none' AS lang, CAST(-1 AS BIGINT) AS body_length FROM articles UNION ALL
SELECT 'd' || doc_id, 'none', 'none', source, lang, length(text) FROM documents UNION ALL
SELECT 'p' || page_id, 'none', url, 'none', 'none', length(html) FROM pages"""),
    "column_check": view_of("""
, c AS (SELECT count(*) AS total, count(*) FILTER (published_at < TIMESTAMP '2024-01-15') AS n FROM articles)
SELECT unnest(['is_breaking_news', 'is_category_topic', 'is_downweighted', 'is_routine_topic', 'is_suppressed']) AS column_name,
  'boolean' AS data_type, 'false' AS column_default, false AS is_nullable, n AS n_values, total - n AS n_null FROM c"""),
    "declared_columns": view_of("""
, c AS (SELECT count(*) AS n, count(*) FILTER (is_downweighted) AS d FROM scored)
SELECT file, column_name, column_default, is_nullable, CASE WHEN file = 'lacks' AND column_name = 'is_breaking_news' THEN 0
    WHEN file = 'nullable' AND column_name = 'is_downweighted' THEN d ELSE n END AS n_values,
  CASE WHEN file = 'lacks' AND column_name = 'is_breaking_news' THEN n WHEN file = 'nullable' AND column_name = 'is_downweighted' THEN n - d ELSE 0 END AS n_null,
  difference
FROM c, (VALUES
  ('lacks', 'is_suppressed', 'false', false, 'as declared'), ('lacks', 'is_downweighted', 'false', false, 'as declared'),
  ('lacks', 'is_breaking_news', 'none', true, 'missing'),
  ('other', 'is_suppressed', 'true', false, 'default true instead of false'), ('other', 'is_downweighted', 'false', false, 'as declared'),
  ('other', 'is_breaking_news', 'false', false, 'as declared'),
  ('nullable', 'is_suppressed', 'false', false, 'as declared'), ('nullable', 'is_downweighted', 'false', true, 'required False instead of True'),
  ('nullable', 'is_breaking_news', 'false', false, 'as declared')) v(file, column_name, column_default, is_nullable, difference)"""),
    "added_column": view_of("SELECT id, " + ", ".join(
        f"published_at >= TIMESTAMP '2024-01-15' AND {flag} AS {flag}" for flag in (
            "is_routine_topic", "is_category_topic", "is_breaking_news", "is_suppressed", "is_downweighted")) + " FROM scored"),
    "observed_metrics": view_of("""
, doc AS (SELECT doc_id % 12 AS last, strlen('From ' || doc_id || ':' || chr(10) || text) AS prompt_bytes FROM documents)
SELECT (SELECT count(*) FROM scored) AS n_candidates, count(*) AS n_prompts, sum(prompt_bytes)::BIGINT AS prompt_bytes,
  CAST(ceil(sum(prompt_bytes) / 4.0) AS BIGINT) AS token_estimate, count(*) AS n_briefings, sum(last)::BIGINT AS n_cards,
  sum(CASE WHEN last < 10 THEN (14 - last) // 5 ELSE 0 END)::BIGINT AS retries, false AS is_complete,
  (SELECT count(*) FROM scored WHERE logical_date <> DATE '2024-01-10') > 0 AS fallback_used, true AS schema_validated, false AS dry_run
FROM doc"""),
    "latest_raw_rows": "SELECT event_id, left(event_type, 4) AS title_snip, " + stamp("ts", "published_at")
                       + " FROM events ORDER BY event_id DESC LIMIT 3",
    "latest_summaries": "SELECT doc_id, left(text, 40) AS snip FROM documents ORDER BY doc_id DESC LIMIT 5",
    "suppression_monitor": view_of("SELECT " + FLAG_COUNTS.format(total="total_articles_24h") + " FROM recent"),
    "suppression_summary": view_of("""
SELECT count(*) AS total_articles, count(*) FILTER (is_suppressed) AS suppressed_count,
  count(*) FILTER (is_downweighted) AS downweighted_count,
  round(count(*) FILTER (is_suppressed) * 100.0::DOUBLE / count(*), 2) AS suppression_rate FROM recent"""),
    "suppression_stats": view_of("""
SELECT count(*) AS total, count(*) FILTER (is_suppressed) AS suppressed, count(*) FILTER (is_downweighted) AS downweighted,
  count(*) FILTER (is_routine_topic AND is_breaking_news) AS breaking_exempted,
  round(count(*) FILTER (is_suppressed) * 100.0::DOUBLE / count(*), 2) AS suppressed_pct,
  round(count(*) FILTER (is_downweighted) * 100.0::DOUBLE / count(*), 2) AS downweighted_pct FROM scored"""),
    "score_column_stats": view_of(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(min({c}), 6) AS min_value, round(max({c}), 6) AS max_value, round(avg({c}), 6) AS avg_value FROM scored"
        for c in ("hot_score_v2", "sent_score_v2", "entity_hot_score", "final_score_v2"))),
    "score_distribution": view_of("""
SELECT count(*) AS total_records, count(*) FILTER (final_score_v2 >= 0.6::DOUBLE) AS high_score_records,
  round(avg(final_score_v2), 6) AS avg_score FROM recent WHERE final_score_v2 IS NOT NULL"""),
    "topic_class_distribution": view_of("""
SELECT topic_category, count(*) AS article_count, round(avg(final_score_v2), 6) AS avg_final_score, round(avg(hot_norm), 6) AS avg_hot_norm
FROM recent GROUP BY topic_category"""),
    "suppression_trend_daily": view_of(
        "SELECT CAST(logical_date AS VARCHAR) AS logical_date, " + FLAG_COUNTS.format(total="total_articles")
        + " FROM scored GROUP BY scored.logical_date"),
    "suppression_by_source": view_of(
        "SELECT source_name, " + FLAG_COUNTS.format(total="total_articles") + " FROM scored GROUP BY source_name"),
    "damping_effect": view_of("""
SELECT topic_category, count(*) AS article_count, round(avg(hot_norm_raw), 6) AS avg_before, round(avg(hot_norm), 6) AS avg_after,
  round(avg(hot_norm_raw - hot_norm), 6) AS avg_loss FROM scored GROUP BY topic_category"""),
    "quality_by_treatment": view_of("""
SELECT CASE WHEN is_suppressed THEN 'suppressed' WHEN is_downweighted THEN 'downweighted' ELSE 'untouched' END AS treatment,
  count(*) AS article_count, round(avg(rep_norm), 6) AS avg_authority, round(avg(final_score_v2), 6) AS avg_final_score,
  count(*) FILTER (final_score_v2 >= 0.6::DOUBLE) AS high_score_records FROM scored GROUP BY 1"""),
    "affected_articles": view_of(
        "SELECT id, source_name, " + stamp("published_at") + """, round(hot_norm, 6) AS hot_norm, final_score_v2, is_routine_topic,
  is_breaking_news, is_suppressed, is_downweighted FROM recent r WHERE is_suppressed OR is_downweighted ORDER BY r.published_at DESC, id LIMIT 20"""),
    "top_articles": view_of(
        "SELECT id, left(title, 50) AS title_snippet, " + stamp("published_at")
        + ", final_score_v2 FROM scored ORDER BY final_score_v2 DESC, id LIMIT 5"),
    "top_concepts": view_of(
        "SELECT uri, round(score, 6) AS score, " + stamp("updated_at") + " FROM trending tr ORDER BY tr.score DESC, uri LIMIT 10"),
    "run_metrics": """
SELECT count(*) AS n_candidates, count(*) FILTER (lang = 'en') AS n_cards, count(*) FILTER (lang = 'en') >= 10 AS is_complete,
  false AS dry_run, false AS fallback_used, '' AS last_error, true AS schema_validated FROM documents""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("events", "documents", "pages", "embeddings")),
    "exact_dedup": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)",
    "simhash_signatures": "WITH " + signature_views("documents", "doc_id", "text") + " SELECT doc_id, sig FROM sigs",
    "near_dup_simhash": "WITH " + signature_views("documents", "doc_id", "text")
                        + " SELECT doc_id, earliest, earliest < doc_id AS is_repeat FROM near",
    "url_dedup": "WITH " + title_url_views() + " SELECT page_id, url FROM pages WHERE page_id IN (SELECT page_id FROM firsts)",
    "similar_documents": "WITH " + similar_views("documents", "doc_id", "text")
                         + " SELECT doc_id, earliest, earliest < doc_id AS is_repeat FROM near_sets",
    "similar_title_url": "WITH " + title_url_views() + """,
both_texts AS (SELECT page_id, title || ' ' || regexp_replace(url, '[/:?#=&._-]+', ' ', 'g') AS text FROM pg),"""
                         + similar_views("both_texts", "page_id", "text")
                         + " SELECT page_id, earliest, earliest < page_id AS is_repeat FROM near_sets",
    "url_or_title_dedup": "WITH " + title_url_views() + "," + similar_views("pg", "page_id", "title")
                          + " SELECT page_id FROM near_sets WHERE earliest = page_id AND page_id IN (SELECT page_id FROM firsts)",
    "richest_per_group": """
SELECT event, doc_id, n FROM (SELECT source || '/' || lang AS event, doc_id, length(text) AS n,
    row_number() OVER (PARTITION BY source, lang ORDER BY length(text) DESC, doc_id) AS rn FROM documents) WHERE rn = 1""",
    "keyword_filter_exception": view_of(
        "SELECT doc_id, has_conflict, has_bang, has_insider FROM marked WHERE NOT has_conflict OR has_bang OR has_insider"),
    "card_picks": view_of("""
, one AS (SELECT * FROM (SELECT source || '/' || lang AS event_uri, doc_id AS id, has_bang, n_chars % 1000 AS score,
    row_number() OVER (PARTITION BY source, lang ORDER BY length(text) DESC, doc_id) AS rn FROM marked) WHERE rn = 1),
ranked AS (SELECT row_number() OVER (ORDER BY has_bang DESC, score DESC, id) AS pick_no, event_uri, id, has_bang FROM one)
SELECT * FROM ranked WHERE pick_no <= 10"""),
    "truncate_and_cap": view_of("""
SELECT id, substr(text, 1, 800) AS body, final_score_v2
FROM recent LEFT JOIN documents ON CAST(id AS BIGINT) % (SELECT count(*) FROM documents) = doc_id
ORDER BY final_score_v2 DESC, id LIMIT 60"""),
    "candidate_window": view_of("SELECT id, final_score_v2 FROM recent"),
    "score_threshold": view_of("SELECT id, final_score_v2 FROM scored WHERE final_score_v2 > 0.6::DOUBLE"),
    "picks_by_index": """
WITH d AS (SELECT source, doc_id, doc_id // 20 AS position FROM documents)
SELECT source, CASE position WHEN 4 THEN 0 WHEN 0 THEN 1 ELSE 2 END::BIGINT AS pick_pos, doc_id FROM d WHERE position IN (4, 0, 2)""",
    "card_parse": view_of(
        "SELECT name, card_no, tags, title, subtitle, content, angle, date, source, source_url, source_domain FROM cards"),
    "card_cleanup": view_of("""
SELECT name, card_no, left(title, 8) AS title, left(subtitle, 12) AS subtitle, least(length(content), 200)::BIGINT AS content_length,
  CASE WHEN tags = '' THEN '#新闻 #时政' ELSE tags END AS tags FROM cards"""),
    "card_quality_gate": view_of("""
SELECT name, count(*) AS n_cards, count(*) FILTER (tags <> '') AS n_valid, count(*) FILTER (tags <> '') >= 5 AS is_enough
FROM cards GROUP BY name"""),
    "card_completeness": view_of("""
, l AS (SELECT doc_id AS name, greatest(doc_id % 12, CASE WHEN doc_id % 5 = 0 AND doc_id % 12 >= 2 THEN 2 ELSE 0 END) AS last_topic FROM documents)
SELECT name, last_topic, last_topic + 1 + 5 * b AS first_no, least(last_topic + 5 + 5 * b, 10) AS last_no
FROM l, range(0, 2) r(b) WHERE last_topic < 10 AND last_topic + 1 + 5 * b <= 10"""),
    "clip_fields": """
SELECT doc_id, substr(text, 1, 8) AS title, substr(text, 1, 12) AS subtitle, substr(text, 1, 200) AS summary,
  strlen(text) AS n_bytes FROM documents""",
    "summary_points": """
SELECT doc_id, array_to_string(list_slice(list_filter(list_transform(string_split(replace(replace(text, '.', '；'), '；', '。'), '。'),
  lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(12288))), lambda x: x <> ''), 1, 3), '|') AS points FROM documents""",
    "hashtag_fix": """
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 9 <> 8 THEN list_slice([lang, '#' || source, source, '#a', 'b', '#c', 'd'], 1, doc_id % 8) END AS part, doc_id % 10 = 3 AS ok,
  CASE WHEN doc_id % 10 = 3 THEN ['#' || lang, '#' || source, '#x'] ELSE part END AS tags FROM documents),
m AS (SELECT doc_id, ok, tags, list_transform(tags, lambda x: CASE WHEN starts_with(x, '#') THEN x ELSE '#' || x END) AS marked FROM t)
SELECT doc_id, ok AS is_valid, array_to_string(CASE WHEN tags IS NULL THEN ['#新闻', '#时政']
  WHEN len(marked) < 2 THEN list_concat(marked, ['#新闻', '#时政']) ELSE list_slice(marked, 1, 5) END, ' ') AS tags FROM m""",
    "prompt_text": """
SELECT 'doc' || doc_id AS name, md5('From doc' || doc_id || ':' || chr(10) || '---' || chr(10) || text || chr(10) || '---' || chr(10)) AS prompt_md5,
  strlen(text) AS input_bytes FROM documents""",
    "card_local_fields": view_of("""
SELECT id, CAST(CAST(published_at + INTERVAL 2 HOUR AS DATE) AS VARCHAR) AS date, source_name || ' – ' || url AS source FROM articles"""),
    "url_domain": """
SELECT page_id, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1), '^www[.]', '') AS domain FROM pages""",
    "digest_concat": """
SELECT lang AS digest, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS position, CAST(doc_id AS VARCHAR) AS name,
  md5('# Report: ' || doc_id || chr(10) || chr(10) || text || chr(10) || chr(10) || '---' || chr(10) || chr(10)) AS block_md5 FROM documents""",
    "latest_file_by_strategy": view_of("""
, r AS (SELECT * FROM files WHERE starts_with(name, 'summary_')),
b AS (SELECT * FROM files WHERE ends_with(name, '.md')),
newest AS (SELECT path FROM r ORDER BY modified_at DESC, name DESC LIMIT 1)
SELECT 'by_ds' AS choice, coalesce((SELECT path FROM r WHERE starts_with(name, 'summary_2024-01-10_') ORDER BY modified_at DESC, name DESC LIMIT 1), 'none') AS path UNION ALL
SELECT 'by_ds_absent', 'none' UNION ALL
SELECT 'by_ds_then_latest', (SELECT path FROM newest) UNION ALL
SELECT 'latest_any', (SELECT path FROM newest) UNION ALL
SELECT 'within_48h', (SELECT path FROM newest) UNION ALL
SELECT 'briefing_latest', (SELECT path FROM b ORDER BY modified_at DESC, name DESC LIMIT 1) UNION ALL
SELECT 'briefing_daily', (SELECT path FROM b WHERE starts_with(name, '2024-01-10_') ORDER BY ends_with(name, '_daily_briefing.md') DESC, modified_at DESC, name DESC LIMIT 1)"""),
    "briefings_of_day": view_of(
        "SELECT name, " + stamp("modified_at") + " FROM files WHERE ends_with(name, '.md') AND starts_with(name, '2024-01-10_')"),
    "ingest_landed_files": view_of("""
, p AS (SELECT id, title, source_name, CASE WHEN event_id % 7 <= 3 THEN date_trunc('second', published_at)
    WHEN event_id % 7 = 4 THEN date_trunc('day', published_at) ELSE TIMESTAMP '2024-02-01 00:00:00' END AS pub,
  event_id % 7 >= 5 AS published_at_imputed FROM articles)
SELECT id, title, source_name, strftime(pub, '%Y-%m-%d %H:%M:%S.%f') AS published_at,
  CAST(CAST(pub + INTERVAL 2 HOUR AS DATE) AS VARCHAR) AS logical_date, published_at_imputed FROM p"""),
    "incremental_ingest": view_of("""
SELECT id, event_uri, CAST(CAST(CASE WHEN event_id % 7 <= 3 THEN published_at WHEN event_id % 7 = 4 THEN date_trunc('day', published_at)
  ELSE TIMESTAMP '2024-02-01 00:00:00' END + INTERVAL 2 HOUR AS DATE) AS VARCHAR) AS logical_date FROM articles"""),
    "read_landed_events": view_of("""
SELECT 'ev-' || user_id AS uri, CASE WHEN user_id % 4 = 0 THEN 'deu' ELSE 'eng' END AS lang, n AS total_article_count,
  strftime(date_trunc('second', last_ts), '%Y-%m-%d %H:%M:%S.%f') AS event_date FROM sizes WHERE user_id % 20 IN (1, 2)"""),
    "read_landed_trending": view_of("""
SELECT 'c/' || k AS uri, round(max(value), 6) AS score, '2024-02-01 00:00:00.000000' AS updated_at FROM ev GROUP BY k"""),
    "report_sink": view_of("""
SELECT 'summary_' || logical_date || run || '.json' AS name, rank, "eventId", url
FROM report, (VALUES ('_manual_10-00-00'), ('_scheduled_22-00-00')) runs(run)"""),
    "report_found": view_of("""
, n AS (SELECT count(*) AS n FROM report WHERE logical_date = '2024-01-10')
SELECT rank + 1 AS line_no, 'summary_2024-01-10_scheduled_22-00-00.json' AS name, "eventId", rank FROM report WHERE logical_date = '2024-01-10' UNION ALL
SELECT 1, 'summary_2024-01-10_scheduled_22-00-00.json', NULL, NULL UNION ALL
SELECT n + 2, 'summary_2024-01-10_scheduled_22-00-00.json', NULL, NULL FROM n"""),
    "landed_rejects": view_of("""
SELECT k || ' line' AS kind, '{"uri": "broken ' || doc_id AS value FROM documents, (VALUES ('article'), ('event'), ('trending')) kinds(k) UNION ALL
SELECT 'event', uri FROM event_objects UNION ALL
SELECT 'trending', uri FROM (SELECT uri FROM trending ORDER BY trending.score DESC, uri LIMIT 200)"""),
    "batch_queue": view_of("""
SELECT id, 'second' AS batch, CAST(CAST(published_at + INTERVAL 2 HOUR AS DATE) AS VARCHAR) AS logical_date
FROM articles WHERE published_at >= TIMESTAMP '2024-01-15'"""),
    "resumed_scoring": view_of(
        "SELECT id, final_score_v2, is_suppressed, CAST(logical_date AS VARCHAR) AS logical_date FROM scored"),
    "replayed_batch": """
SELECT table_name, n_rows, pass FROM (
  SELECT 'articles' AS table_name, count(*) AS n_rows FROM events UNION ALL SELECT 'rejects', count(*) FROM documents), (VALUES (1), (2)) p(pass)""",
    "insert_by_keys": view_of("SELECT id, title FROM articles WHERE published_at >= TIMESTAMP '2024-01-15'"),
    "first_of_batch": view_of("SELECT id, title FROM articles"),
    "schema_check": """
SELECT c AS column_name, (SELECT count(*) FROM events) AS n
FROM (VALUES ('body'), ('published_at'), ('collected_at'), ('source_importance'), ('total_articles_in_event'), ('concepts'),
  ('published_at_imputed'), ('logical_date')) v(c)""",
    "now_prev_date": """
WITH d AS (SELECT max(CAST(ts + INTERVAL 8 HOUR AS DATE)) - INTERVAL 1 DAY AS d FROM events)
SELECT strftime(d, '%Y-%m-%d') AS prev_date, count(*) AS n FROM events, d WHERE CAST(ts + INTERVAL 8 HOUR AS DATE) = d GROUP BY 1""",
    "briefing_sink": """
SELECT strftime(TIMESTAMP '2024-01-02 06:00:00' + to_seconds(doc_id), '%Y-%m-%d_%H-%M-%S') || '_daily_briefing.md' AS file_name,
  md5(text) AS text_md5 FROM documents""",
    "digest_index": """
WITH b AS (SELECT lang AS digest, doc_id, strlen('# Report: ' || doc_id || chr(10) || chr(10) || text || chr(10) || chr(10) || '---' || chr(10) || chr(10)) AS size
  FROM documents)
SELECT digest, row_number() OVER w AS position, CAST(doc_id AS VARCHAR) AS name,
  CAST(coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset", size
FROM b WINDOW w AS (PARTITION BY digest ORDER BY doc_id)""",
    "keyword_lists": """
WITH k AS (SELECT DISTINCT doc_id % 3 AS kind, string_split(text, ' ')[-1] AS word FROM documents WHERE string_split(text, ' ')[-1] <> ''),
hits AS (SELECT doc_id, kind FROM documents JOIN k ON contains(text, word) GROUP BY doc_id, kind)
SELECT doc_id, coalesce(bool_or(kind = 0), false) AS has_conflict, coalesce(bool_or(kind = 1), false) AS has_bang,
  coalesce(bool_or(kind = 2), false) AS has_insider
FROM documents LEFT JOIN hits USING (doc_id) GROUP BY doc_id""",
    "cutoff_settings": """
SELECT setting, CAST(CAST(ts + INTERVAL 8 HOUR - to_hours(hour) AS DATE) AS VARCHAR) AS logical_date, count(*) AS n
FROM events, (VALUES ('0', 0), ('8', 8), ('23', 23), ('25', 6), ('-1', 6), ('x', 6), ('', 6)) s(setting, hour) GROUP BY 1, 2""",
    "daily_append": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, '## ' || event_type || ' ' || event_id AS text FROM events",
    "stage_sink": view_of("SELECT id, event_uri, final_score_v2 FROM scored WHERE logical_date = DATE '2024-01-10'"),
    "digest_sink": """
WITH d AS (SELECT lang AS digest, string_agg('# Report: ' || doc_id || chr(10) || chr(10) || text || chr(10) || chr(10) || '---' || chr(10) || chr(10), ''
    ORDER BY doc_id) AS t FROM documents GROUP BY lang),
l AS (SELECT digest, string_split(left(t, length(t) - 1), chr(10)) AS lines FROM d)
SELECT digest, unnest(range(1, len(lines) + 1)) AS line_no, md5(unnest(lines)) AS line_md5 FROM l""",
    "table_versions": """
SELECT count(*) FILTER (CAST(ts AS DATE) <> DATE '2024-01-10') AS n_rows, 1 AS version FROM events UNION ALL SELECT 0, 2""",
    "replaced_dates": view_of("""
SELECT id, CASE WHEN logical_date = DATE '2024-01-10' THEN 0.0::DOUBLE ELSE final_score_v2 END AS final_score_v2,
  CAST(logical_date AS VARCHAR) AS logical_date FROM scored"""),
    "daily_pipeline": VIEWS.replace("articles AS (SELECT * FROM all_articles),\n", SELECTED) + """
SELECT id, event_uri, total_articles_in_event, round(entity_hot_score, 6) AS entity_hot_score, round(hot_norm, 6) AS hot_norm,
  final_score_v2, is_suppressed, is_downweighted, CAST(logical_date AS VARCHAR) AS logical_date FROM scored""",
    "file_names": """
SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d_%H-%M-%S') || '_daily_briefing.md' AS briefing,
  'summary_' || strftime(ts + INTERVAL 8 HOUR - INTERVAL 1 DAY, '%Y-%m-%d') || '_manual_' || strftime(ts, '%H-%M-%S') || '.json' AS report FROM events""",
}
# The state of several runs gives what the whole history gives.
ORACLE |= {state: ORACLE[whole] for state, whole in (
    ("state_trend", "suppression_trend_daily"), ("state_by_source", "suppression_by_source"), ("state_effect", "damping_effect"),
    ("state_quality", "quality_by_treatment"))}
