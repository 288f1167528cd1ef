"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# A word is a run of ASCII letters, digits and characters above ASCII, in lower case for A-Z.
_WORDS = r"""list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

ORACLE["op6_decontamination"] = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
     windows AS (
         SELECT item_id, least(len(w), 13) AS n,
                array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
         FROM items, LATERAL (SELECT unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i)
         WHERE len(w) > 0),
     docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
     lengths AS (SELECT DISTINCT n FROM windows),
     places AS (
         SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
         FROM docs, lengths, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
     hits AS (SELECT doc_id, n, i, item_id FROM places JOIN windows USING (n, win)),
     words_hit AS (
         SELECT doc_id, count(DISTINCT k) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, n, i FROM hits))
         GROUP BY 1),
     items_hit AS (
         SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
         FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""


# The rules of the scan as RE2 patterns: kind, pattern, group whose length counts, least length.
_SECRETS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
     r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
    ("github", "gh[opsu]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", "xox[abps]-[A-Za-z0-9-]{10,}", 0, 1),
    # A key with its END line; of one without, the scan also finds headers and base64 lines, which RE2 cannot say.
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+)*-----END [A-Z ]*PRIVATE KEY-----)?", 0, 1),
]


def _secret_part(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT rid, {rank} AS rank, '{kind}' AS kind, start, start + size AS "end"
    FROM (SELECT rid, k, length(m) AS size, length(v) AS value,
                 sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY k) - length(m) AS start
          FROM (SELECT rid, unnest(m) AS m, unnest(v) AS v, unnest(g[: len(m)]) AS g, unnest(range(len(m))) AS k
                FROM (SELECT rid, regexp_extract_all(text, '{pattern}', 0) AS m, regexp_extract_all(text, '{pattern}', {group}) AS v,
                             string_split_regex(text, '{pattern}') AS g
                      FROM docs)))
    WHERE value >= {least}"""


ORACLE["op3_secrets"] = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
     spans AS ({" UNION ALL ".join(_secret_part(k, *rule) for k, rule in enumerate(_SECRETS))}),
     joined AS (
         SELECT rid,
                count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                count(*) FILTER (kind = 'hex') AS n_hex,
                string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST("end" AS BIGINT), ',' ORDER BY start, rank)
                    FILTER (rank < 3) AS base,
                string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST("end" AS BIGINT), ',' ORDER BY start, rank) AS spans
         FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (rid)
"""

ORACLE["sentencepiece_round_trip"] = "SELECT doc_id, sha256(text) AS text_sha256 FROM documents"

# DuckDB gives SHA-1 in hexadecimal; base32 is read off the bits.
ORACLE["op2_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
     bits AS (
         SELECT DISTINCT hex, array_to_string(list_transform(range(1, 41), lambda i: right(
                    '000' || bin(CAST(instr('0123456789abcdef', hex[i]) - 1 AS UTINYINT)), 4)), '') AS b
         FROM p),
     digests AS (
         SELECT hex, array_to_string(list_transform(range(0, 32), lambda k:
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(0, 5), lambda j:
                        CAST(b[k * 5 + j + 1] AS INTEGER) * CAST(pow(2, 4 - j) AS INTEGER)))::INTEGER]), '') AS payload_digest
         FROM bits),
     firsts AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN digests USING (hex) JOIN firsts USING (hex)
"""

ORACLE["op8_embeddings"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
     links AS (
         SELECT a.vec_id AS u, b.vec_id AS w FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
     reach AS (
         SELECT vec_id AS node, vec_id AS seen FROM v
         UNION
         SELECT r.node, l.w FROM reach AS r JOIN links AS l ON r.seen = l.u),
     least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
     degree AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON vec_id = node LEFT JOIN degree ON vec_id = u
"""

ORACLE["op11_infilling"] = r"""
WITH t AS (
         SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                sha256('1:' || doc_id) AS h
         FROM documents),
     d AS (
         SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                          OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                     WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
         FROM t),
     p AS (
         SELECT doc_id, text, n, form, array_to_string(u[1 : least(x, y)], '') AS a,
                array_to_string(u[least(x, y) + 1 : greatest(x, y)], '') AS b, array_to_string(u[greatest(x, y) + 1 : n], '') AS c
         FROM d)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(b) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
                        ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


def _values(strict: bool, terms: str) -> str:
    return ", ".join(f"('{t}', {str(strict).lower()})" for t in terms.split())


ORACLE["op13_urls"] = rf"""
WITH rules(host_end, path_start, verdict) AS (VALUES
         ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
     terms(term, strict) AS (VALUES
         {_values(True, "bestiality casino escorts jackpot pills porn slots viagra xxx")},
         {_values(False, "adult bet bonus cheap discount farm free hot loan lucky poker sex spam win")}),
     u AS (
         SELECT row_number() OVER () AS rid, page_id, coalesce(url, '') AS url,
                translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
         FROM pages),
     p AS (
         SELECT *, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
     h AS (
         SELECT rid, page_id, low, regexp_extract(rest, '^[^/?#]*') AS raw_host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
         FROM p),
     k AS (
         SELECT rid, page_id, low, path, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
         FROM h),
     ruled AS (
         SELECT rid, arg_max(host_end || path_start, length(host_end || path_start)) AS rule,
                arg_max(verdict, length(host_end || path_start)) AS verdict
         FROM k JOIN rules ON (host = host_end OR ends_with(host, '.' || host_end)) AND starts_with(path, path_start)
         GROUP BY rid),
     hits AS (
         SELECT rid, strict, term, len(list_filter(range(1, length(low) - length(term) + 2), lambda i:
                    substr(low, i, length(term)) = term
                    AND NOT regexp_matches(substr('.' || low || '.', i, 1), '[a-z0-9]|[^\x00-\x7F]')
                    AND NOT regexp_matches(substr('.' || low || '.', i + length(term) + 1, 1), '[a-z0-9]|[^\x00-\x7F]'))) AS n
         FROM k JOIN terms ON contains(low, term)),
     weights AS (
         SELECT rid, count(*) FILTER (strict AND n > 0) AS n_strict, count(*) FILTER (NOT strict AND n > 0) AS n_soft,
                CAST(sum(n) AS BIGINT) AS n_hits
         FROM hits GROUP BY rid)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(n_strict, 0) AS n_strict, coalesce(n_soft, 0) AS n_soft, coalesce(n_hits, 0) AS n_hits
FROM k LEFT JOIN ruled USING (rid) LEFT JOIN weights USING (rid)
"""

# The same contracts over rows that link and revisit, which the given tables lack.
ORACLE["warc_revisits"] = ORACLE["op2_warc"].replace("FROM pages)", """FROM (
    SELECT page_id, html FROM pages UNION ALL SELECT page_id + 1000000, html FROM pages WHERE page_id % 3 = 0 UNION ALL
    SELECT page_id + 2000000, NULL FROM pages WHERE page_id % 50 = 0))""")
ORACLE["embedding_links"] = ORACLE["op8_embeddings"].replace(
    "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings", """SELECT vec_id + times * 1000000 AS vec_id, label + more AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * (1 + turn * ((i - 1) % 3 - 1))) AS e
     FROM embeddings, (VALUES (0.0::DOUBLE, 0, 0), (0.1::DOUBLE, 1, 0), (0.3::DOUBLE, 2, 0), (0.0::DOUBLE, 3, 1000)) f(turn, times, more)""")
