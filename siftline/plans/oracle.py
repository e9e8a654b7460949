"""DuckDB SQL equal in meaning to each catalogue query (the correctness
oracle). Written independently of the Spark operators: windows and CASE
expressions over the same derived relations."""

from __future__ import annotations

# --- derived relations (same definitions as plans.fixtures) -----------------

FEED_ITEMS = """
fi AS (
  SELECT event_id AS seq, ts, CAST(day(CAST(ts AS date)) AS bigint) AS sweep_id,
         date_trunc('day', ts) + CASE WHEN day(ts) % 3 = 2 THEN INTERVAL 13 HOUR ELSE INTERVAL 7 HOUR END AS sweep_ts,
         event_type AS source,
         CASE WHEN event_id % 97 = 0 OR day(ts) = 9 OR (day(ts) = 4 AND event_type = 'error' AND event_id % 3 <> 0)
              THEN '  '
              ELSE event_type || ' by user ' || CAST(user_id AS varchar)
                   || CASE WHEN event_id % 41 = 0 THEN ' (License)' ELSE '' END END AS title,
         CASE WHEN event_id % 89 = 0 THEN ''
              WHEN event_id % 83 = 0 THEN 'ftp://Ex.org/u/' || CAST(user_id AS varchar)
              WHEN event_id % 43 = 0 THEN 'https://Spam-Farm.example/' || CAST(user_id AS varchar)
              ELSE 'https://Ex.org/u/' || CAST(user_id AS varchar) || '/' || event_type
                   || CASE event_id % 3 WHEN 0 THEN '/' WHEN 1 THEN '' ELSE '//' END END AS url,
         CASE WHEN event_id % 7 = 0 OR (day(ts) = 6 AND event_type = 'view' AND event_id % 2 = 0) THEN ''
              ELSE 'k ' || regexp_extract(props, '([0-9]+)', 1) END AS summary,
         CAST(CASE WHEN day(ts) = 30 THEN 1
                   ELSE 1 + CAST(regexp_extract(props, '([0-9]+)', 1) AS int) % 5 END AS int) AS score,
         CASE event_id % 4 WHEN 0 THEN 'RED' WHEN 1 THEN 'ORANGE' WHEN 2 THEN 'YELLOW' ELSE 'GREY' END AS tier
  FROM events
),
fr AS (
  SELECT *, source AS source_type, 'ai_research' AS domain,
         substr(sha256(rtrim(lower(trim(url)), '/')), 1, 16) AS item_id
  FROM fi
)"""

CHECKED = FEED_ITEMS + """,
hard AS (
  SELECT *, CASE WHEN trim(title) = '' THEN 'empty_title'
                 WHEN trim(url) = '' THEN 'empty_url'
                 WHEN NOT starts_with(url, 'http') THEN 'malformed_url' END AS hard_reason
  FROM fr
),
chk AS (
  SELECT *, COALESCE(hard_reason,
           CASE WHEN row_number() OVER (PARTITION BY sweep_id, source_type, item_id, hard_reason IS NULL
                                        ORDER BY seq) > 1 THEN 'duplicate_in_batch' END,
           'valid') AS reason
  FROM hard
),
chk2 AS (
  SELECT *, (reason = 'valid' AND trim(summary) = '') AS empty_summary FROM chk
),
valid AS (SELECT * FROM chk2 WHERE reason = 'valid'),
dd AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sweep_id, item_id ORDER BY seq) AS rn_d FROM valid)
  WHERE rn_d = 1
)"""

REPORT = CHECKED + """,
rep AS (
  SELECT sweep_id, source_type,
         CAST(count(*) AS bigint) AS total,
         CAST(count(*) FILTER (WHERE reason = 'valid') AS bigint) AS valid,
         CAST(count(*) FILTER (WHERE reason = 'empty_title') AS bigint) AS empty_title,
         CAST(count(*) FILTER (WHERE reason = 'empty_url') AS bigint) AS empty_url,
         CAST(count(*) FILTER (WHERE reason = 'malformed_url') AS bigint) AS malformed_url,
         CAST(count(*) FILTER (WHERE reason = 'duplicate_in_batch') AS bigint) AS duplicate_in_batch,
         CAST(count(*) FILTER (WHERE empty_summary) AS bigint) AS empty_summary
  FROM chk2 GROUP BY sweep_id, source_type
)"""

# noise settings: skip sites SPAM-farm, cheap-pills; patterns LICENSE,
# tion.*sch (the invalid "[unclosed" is skipped)
CURATED = CHECKED + """,
noise AS (
  SELECT * FROM dd
  WHERE NOT (contains(lower(url), 'spam-farm') OR contains(lower(url), 'cheap-pills'))
    AND NOT regexp_matches(lower(title || ' ' || summary), '(license)|(tion.*sch)', 'i')
),
win AS (
  SELECT *, min(sweep_ts) OVER (PARTITION BY item_id) AS first_seen FROM noise
),
cur AS (
  SELECT * FROM win
  WHERE sweep_ts = first_seen OR first_seen <= sweep_ts - INTERVAL 48 HOURS
)"""

PAGE_ITEMS = """
pi AS (
  SELECT page_id AS seq, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, url, html,
         regexp_extract(url, '^https?://([^/?#]+)', 1) AS source,
         substring(trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[[:space:]]+', ' ', 'g')), 1, 400) AS summary
  FROM pages
)"""


def _with(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["validate_items"] = _with(CHECKED, """
SELECT sweep_id, seq, source_type, item_id, reason, empty_summary FROM chk2""")

ORACLE["validate_report"] = _with(REPORT, "SELECT * FROM rep")

ORACLE["quality_warnings"] = _with(REPORT + """,
srcs AS (SELECT * FROM (VALUES ('click', 0), ('error', 1), ('purchase', 2), ('signup', 3),
                               ('view', 4), ('rss', 5)) AS t(source_type, ord)),
grid AS (SELECT s.sweep_id, c.source_type, CAST(c.ord AS bigint) AS ord
         FROM (SELECT DISTINCT sweep_id FROM fi) s CROSS JOIN srcs c),
r AS (
  SELECT g.sweep_id, g.ord, g.source_type, COALESCE(total, 0) AS total, COALESCE(valid, 0) AS valid,
         COALESCE(empty_summary, 0) AS empty_summary, COALESCE(malformed_url, 0) AS malformed_url
  FROM grid g LEFT JOIN rep USING (sweep_id, source_type)
),
w AS (
  SELECT sweep_id, ord, source_type,
    CASE WHEN total = 0 THEN '[' || source_type || '] returned 0 items'
         WHEN 2 * valid < total THEN '[' || source_type || '] ' || CAST(valid AS varchar) || '/' || CAST(total AS varchar)
              || ' items valid (' || CAST(CAST(round_even(CAST(valid AS double) / total * 100.0, 0) AS bigint) AS varchar) || '%)'
         WHEN 10 * empty_summary > 3 * total OR malformed_url > 0 THEN
              '[' || source_type || '] quality issues: ' ||
              concat_ws(', ', CASE WHEN 10 * empty_summary > 3 * total THEN CAST(empty_summary AS varchar) || ' missing summaries' END,
                              CASE WHEN malformed_url > 0 THEN CAST(malformed_url AS varchar) || ' malformed URLs' END)
    END AS warning
  FROM r
  UNION ALL
  SELECT sweep_id, CAST(1000000 AS bigint), CAST(NULL AS varchar),
         '0 items fetched from all sources -- check config and network.'
  FROM r GROUP BY sweep_id HAVING sum(valid) = 0
)""", """
SELECT * FROM w WHERE warning IS NOT NULL""")

ORACLE["dedup_batch"] = _with(CHECKED, """
SELECT sweep_id, item_id, seq, source, url, title FROM dd""")

ORACLE["noise_filter"] = _with(PAGE_ITEMS, """
SELECT seq, url, title,
       (contains(lower(url), 'spam-farm') OR contains(lower(url), 'cheap-pills')) AS blocked_site,
       regexp_matches(lower(title || ' ' || summary), '(license)|(tion.*sch)', 'i') AS noise_match,
       NOT (contains(lower(url), 'spam-farm') OR contains(lower(url), 'cheap-pills'))
         AND NOT regexp_matches(lower(title || ' ' || summary), '(license)|(tion.*sch)', 'i') AS kept
FROM pi""")

ORACLE["dedup_window"] = _with(CHECKED + """,
w AS (SELECT *, min(sweep_ts) OVER (PARTITION BY item_id) AS fs FROM dd)""", """
SELECT sweep_id, item_id, seq, strftime(fs, '%Y-%m-%d %H:%M:%S.%f') AS first_seen,
       (sweep_ts = fs OR fs <= sweep_ts - INTERVAL 48 HOURS) AS kept
FROM w""")

ORACLE["curated_items"] = _with(CURATED, """
SELECT sweep_id, seq, item_id, domain, source, title, url FROM cur""")

# --- state folds -------------------------------------------------------------

FETCH_LOG = """
fl AS (
  SELECT event_id AS seq, ts, 'rss:' || CAST(user_id AS varchar) AS feed_id,
         'https://feeds.example/' || CAST(user_id AS varchar) || '/' || event_type AS feed_url,
         event_type NOT IN ('error', 'view') AS ok,
         CAST(500 + CAST(regexp_extract(props, '([0-9]+)', 1) AS int) % 5 AS int) AS status_code,
         'failed: ' || event_type AS error,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS int) AS item_count
  FROM events
),
flw AS (SELECT *, max(CASE WHEN ok THEN ts END) OVER (PARTITION BY feed_id) AS last_ok FROM fl),
fh AS (
  SELECT feed_id, arg_min(feed_url, ts) AS feed_url,
         CAST(count(*) AS bigint) AS total_fetches,
         CAST(sum(CASE WHEN ok THEN item_count ELSE 0 END) AS bigint) AS total_items,
         max(ts) FILTER (WHERE ok) AS last_success,
         max(ts) FILTER (WHERE NOT ok) AS last_failure,
         CAST(arg_max(status_code, ts) FILTER (WHERE NOT ok) AS bigint) AS last_status_code,
         arg_max(error, ts) FILTER (WHERE NOT ok) AS last_error,
         CAST(count(*) FILTER (WHERE NOT ok AND (last_ok IS NULL OR ts > last_ok)) AS bigint) AS consecutive_failures
  FROM flw GROUP BY feed_id
)"""

ORACLE["feed_health"] = _with(FETCH_LOG, """
SELECT feed_id, feed_url, total_fetches, total_items,
       strftime(last_success, '%Y-%m-%d %H:%M:%S.%f') AS last_success,
       strftime(last_failure, '%Y-%m-%d %H:%M:%S.%f') AS last_failure,
       last_status_code, last_error, consecutive_failures,
       CAST(CASE WHEN total_fetches > 0 THEN round_even(CAST(total_items AS double) / total_fetches, 0) ELSE 0 END AS bigint) AS avg_items,
       CASE WHEN consecutive_failures >= 3 THEN 'DEAD' WHEN consecutive_failures > 0 THEN 'WARN' ELSE 'LIVE' END AS status,
       CASE WHEN consecutive_failures = 0 THEN 'OK' ELSE 'FAILING (' || CAST(consecutive_failures AS varchar) || 'x)' END AS health
FROM fh""")

ORACLE["sick_feeds"] = _with(FETCH_LOG, """
SELECT feed_id, consecutive_failures, last_error, last_status_code FROM fh WHERE consecutive_failures >= 3""")

SQ_BODY = """
SELECT source, total_scored, scored_3plus, scored_4plus,
       CASE WHEN total_scored > 0 THEN (200 * scored_3plus + total_scored) // (2 * total_scored) ELSE 0 END AS signal_pct,
       CASE WHEN total_scored > 0 THEN (200 * scored_4plus + total_scored) // (2 * total_scored) ELSE 0 END AS premium_pct,
       CASE WHEN sp >= 30 THEN 'GREEN' WHEN sp >= 15 THEN 'YELLOW' WHEN sp > 0 THEN 'ORANGE' ELSE 'RED' END AS band,
       CAST(sp * 20 // 100 AS bigint) AS bar_fill
FROM (SELECT *, CASE WHEN total_scored > 0 THEN (200 * scored_3plus + total_scored) // (2 * total_scored) ELSE 0 END AS sp
      FROM sq)"""

SCORED = CURATED + """,
sq AS (
  SELECT source, CAST(count(*) AS bigint) AS total_scored,
         CAST(count(*) FILTER (WHERE score >= 3) AS bigint) AS scored_3plus,
         CAST(count(*) FILTER (WHERE score >= 4) AS bigint) AS scored_4plus
  FROM cur GROUP BY source
),
seen AS (
  SELECT item_id, url, title, substring(summary, 1, 500) AS summary, source, domain, '' AS published,
         sweep_ts AS first_seen
  FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY sweep_ts, seq) AS rn_s FROM cur)
  WHERE rn_s = 1
),
latest AS (
  SELECT item_id, score, tier, summary AS reason
  FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY sweep_ts DESC, seq DESC) AS rn_l FROM cur)
  WHERE rn_l = 1
),
curr AS (
  SELECT s.item_id, s.title, s.first_seen, CAST(l.score AS bigint) AS llm_score, l.tier, l.reason AS llm_reason
  FROM seen s JOIN latest l USING (item_id)
)"""

ORACLE["source_quality"] = _with(SCORED, SQ_BODY)
ORACLE["source_quality_incremental"] = _with(SCORED, SQ_BODY)

ORACLE["items_seen_fold"] = _with(SCORED, """
SELECT item_id, url, title, summary, source, domain, published,
       strftime(first_seen, '%Y-%m-%d %H:%M:%S.%f') AS first_seen FROM seen""")

ORACLE["items_current"] = _with(SCORED, """
SELECT item_id, title, strftime(first_seen, '%Y-%m-%d %H:%M:%S.%f') AS first_seen, llm_score, tier, llm_reason
FROM curr""")

ORACLE["lifetime_stats"] = _with(SCORED, """
SELECT CAST((SELECT count(*) FROM seen) AS bigint) AS items_seen,
       CAST((SELECT count(*) FROM seen WHERE first_seen > (SELECT max(ts) FROM fi) - INTERVAL 24 HOURS) AS bigint) AS last_24h,
       CAST((SELECT count(DISTINCT sweep_id) FROM fi) AS bigint) AS digests,
       CAST((SELECT count(*) FROM curr WHERE tier = 'RED') AS bigint) AS red_caught,
       CAST((SELECT count(*) FROM curr WHERE tier = 'ORANGE') AS bigint) AS orange_caught""")

# --- scoring ------------------------------------------------------------------

DOC_BATCHED = """
di AS (
  SELECT d.doc_id AS seq, 'https://docs.example/' || CAST(d.doc_id AS varchar) AS url,
         split_part(d.text, chr(10), 1) AS title, d.text AS summary,
         d.source AS source, d.lang AS domain,
         CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 4 WHEN l.quality = 1 THEN 3
              WHEN l.toxic = 0 THEN 2 WHEN l.toxic = 1 THEN 1 END AS label_score,
         l.quality
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
db AS (
  SELECT *, CAST(0 AS bigint) AS sweep_id, CAST(rn // 40 AS bigint) AS batch, CAST(rn % 40 AS bigint) AS idx
  FROM (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS rn FROM di)
),
lab AS (
  SELECT sweep_id, batch, idx, CAST(label_score AS bigint) AS score,
         CASE WHEN label_score >= 4 THEN 'ORANGE' WHEN label_score = 3 THEN 'YELLOW' END AS tier,
         CASE WHEN quality = 1 THEN 'quality' END AS why
  FROM db WHERE label_score IS NOT NULL
)"""

ORACLE["score_batches"] = _with(DOC_BATCHED, "SELECT seq, sweep_id, batch, idx FROM db")

ORACLE["score_prompts"] = _with(DOC_BATCHED, """
SELECT sweep_id, batch, CAST(count(*) AS bigint) AS n_items,
       string_agg(CAST(idx AS varchar) || '. [' || domain || '] ' || title || ' | ' || substring(summary, 1, 200),
                  chr(10) ORDER BY idx) AS prompt
FROM db GROUP BY sweep_id, batch""")

ORACLE["parse_scores"] = _with(DOC_BATCHED, "SELECT * FROM lab WHERE batch % 7 <> 6")

ORACLE["apply_scores"] = _with(DOC_BATCHED, """
SELECT db.seq, db.sweep_id, db.batch, db.idx,
       CAST(CASE WHEN db.batch % 7 = 6 THEN 2 WHEN lab.score IS NOT NULL THEN lab.score ELSE 2 END AS bigint) AS score,
       CASE WHEN db.batch % 7 = 6 THEN 'YELLOW' WHEN lab.score IS NOT NULL THEN COALESCE(lab.tier, 'YELLOW') ELSE 'YELLOW' END AS tier,
       CASE WHEN db.batch % 7 = 6 THEN 'scoring failed' WHEN lab.score IS NOT NULL THEN COALESCE(lab.why, '') ELSE 'unscored' END AS reason
FROM db LEFT JOIN lab USING (sweep_id, batch, idx)""")


def _profile_sql() -> str:
    head = """Reader: an analyst of retail event streams
Works on:
1. Tracking signups
2. Cleaning error feeds

Scores:
5 RED: needs action soon
4 ORANGE: worth a full read
3 YELLOW: good background
2: mostly beside the point
1: of no use

Domains:
"""
    tail = """

Always 1:
- Duplicate clickstreams

Answer with JSON only, an array of objects with the fields "idx", "score", "tier" and "why".
High scores are rare."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    return f"""
WITH kw AS (SELECT n_regionkey, list(n_name ORDER BY n_nationkey) AS keywords FROM nation GROUP BY n_regionkey),
dom AS (
  SELECT r_regionkey AS ord,
         '  ' || lower(r_name) || ' (weight ' || CAST((10 - r_regionkey) / 10.0 AS double)::varchar || '): '
           || array_to_string(list_slice(COALESCE(keywords, []), 1, 5), ', ') AS line
  FROM region LEFT JOIN kw ON r_regionkey = n_regionkey
)
SELECT {q(head)} || string_agg(line, chr(10) ORDER BY ord) || {q(tail)} AS prompt
FROM dom"""


ORACLE["profile_prompt"] = _profile_sql()

# --- budgets and logs ---------------------------------------------------------

BUDGETS = SCORED + """,
surf AS (SELECT * FROM cur WHERE score >= 3 AND tier IN ('RED', 'ORANGE', 'YELLOW')),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY sweep_id, tier ORDER BY seq) AS bigint) AS rank FROM surf),
shown AS (
  SELECT * FROM ranked
  WHERE rank <= CASE tier WHEN 'RED' THEN 3 WHEN 'ORANGE' THEN 8 WHEN 'YELLOW' THEN 15 END
),
funnel AS (
  SELECT s.sweep_id, s.sweep_ts,
         CAST(COALESCE((SELECT count(*) FROM valid v WHERE v.sweep_id = s.sweep_id), 0) AS bigint) AS items_fetched,
         CAST(COALESCE((SELECT count(*) FROM cur c WHERE c.sweep_id = s.sweep_id), 0) AS bigint) AS items_after_dedup,
         CAST(COALESCE((SELECT count(*) FROM cur c WHERE c.sweep_id = s.sweep_id), 0) AS bigint) AS items_scored,
         CAST(COALESCE((SELECT count(*) FROM surf x WHERE x.sweep_id = s.sweep_id), 0) AS bigint) AS items_surfaced,
         CAST(COALESCE((SELECT count(*) FROM surf x WHERE x.sweep_id = s.sweep_id AND tier = 'RED'), 0) AS bigint) AS red_count,
         CAST(COALESCE((SELECT count(*) FROM surf x WHERE x.sweep_id = s.sweep_id AND tier = 'ORANGE'), 0) AS bigint) AS orange_count,
         CAST(COALESCE((SELECT count(*) FROM surf x WHERE x.sweep_id = s.sweep_id AND tier = 'YELLOW'), 0) AS bigint) AS yellow_count,
         CAST(COALESCE((SELECT count(*) FROM shown x WHERE x.sweep_id = s.sweep_id), 0) AS bigint) AS items_shown
  FROM (SELECT sweep_id, min(sweep_ts) AS sweep_ts FROM fi GROUP BY sweep_id) s
),
dlog AS (
  SELECT sweep_id, strftime(sweep_ts, '%Y-%m-%d %H:%M:%S.%f') AS sweep_ts,
         CASE WHEN hour(sweep_ts) < 10 THEN 'full' ELSE 'light' END AS sweep_type,
         items_fetched, items_after_dedup, items_scored, items_surfaced, red_count, orange_count, yellow_count,
         'digests/' || strftime(sweep_ts, '%Y-%m-%d_%H%M') || '.md' AS filepath
  FROM funnel
)"""

ORACLE["tier_budget"] = _with(BUDGETS, "SELECT sweep_id, tier, seq, item_id, title, rank FROM shown")

ORACLE["tier_counts"] = _with(BUDGETS, """
SELECT sweep_id, red_count, orange_count, yellow_count, items_surfaced, items_shown FROM funnel
WHERE items_surfaced > 0""")

ORACLE["sweep_funnel"] = _with(BUDGETS, """
SELECT sweep_id, items_fetched, items_after_dedup, items_scored, items_surfaced, red_count, orange_count,
       yellow_count, items_shown FROM funnel""")

ORACLE["digest_log"] = _with(BUDGETS, "SELECT * FROM dlog")

ORACLE["digest_history"] = _with(BUDGETS, """
SELECT sweep_id, sweep_type, items_fetched, items_surfaced, red_count, orange_count, yellow_count,
       CAST(CASE WHEN items_fetched > 0 THEN round_even((1.0 - CAST(items_surfaced AS double) / items_fetched) * 100.0, 0) ELSE 0 END AS bigint) AS noise_pct
FROM dlog ORDER BY sweep_id DESC LIMIT 10""")

# --- scalar functions -----------------------------------------------------------

ORACLE["item_id"] = """
WITH v AS (
  SELECT page_id, CAST(0 AS bigint) AS variant, url FROM pages
  UNION ALL SELECT page_id, CAST(1 AS bigint), upper(url) || '/' FROM pages
  UNION ALL SELECT page_id, CAST(2 AS bigint), '  ' || url || '//' FROM pages
)
SELECT page_id, variant, url, substr(sha256(rtrim(lower(trim(url)), '/')), 1, 16) AS item_id FROM v"""

STRIP = "trim(regexp_replace(regexp_replace({x}, '<[^>]+>', '', 'g'), '[[:space:]]+', ' ', 'g'))"
COLLAPSE = "trim(regexp_replace({x}, '[[:space:]]+', ' ', 'g'))"
PYSTRIP = "regexp_replace({x}, '^[[:space:]]+|[[:space:]]+$', '', 'g')"

ORACLE["strip_html"] = f"""
SELECT page_id, substring({STRIP.format(x='html')}, 1, 400) AS summary,
       CAST(length({STRIP.format(x='html')}) AS bigint) AS text_len
FROM pages"""

ORACLE["parse_date"] = """
WITH r AS (
  SELECT o_orderkey, o_orderdate, o_orderkey % 11 AS k,
         CASE o_orderkey % 11
           WHEN 0 THEN strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S') || ' +0000'
           WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
           WHEN 2 THEN ''
           WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 4 THEN strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S') || ' GMT'
           WHEN 5 THEN strftime(o_orderdate, '%a, %d %b %y %H:%M:%S') || ' GMT'
           WHEN 6 THEN strftime(o_orderdate, '%-d %B %Y %H:%M')
           WHEN 7 THEN strftime(o_orderdate, '%a, %d-%b-%Y %H:%M:%S') || ' GMT'
           WHEN 8 THEN strftime(o_orderdate, '%d %b %Y')
           WHEN 9 THEN strftime(o_orderdate, '%b %d, %Y %H:%M:%S')
           ELSE '31 Feb ' || strftime(o_orderdate, '%Y %H:%M:%S') END AS raw
  FROM orders
)
SELECT o_orderkey, raw,
       CASE WHEN k IN (0, 4, 5, 6, 7, 9) THEN strftime(o_orderdate, '%Y-%m-%d') ELSE substring(raw, 1, 10) END AS published,
       CASE WHEN NOT contains(raw, 'T') AND k IN (0, 4, 5, 6, 7, 9) THEN strftime(o_orderdate, '%Y-%m-%d')
            ELSE substring(raw, 1, 10) END AS published_compat
FROM r"""

ORACLE["keyword_match"] = """
SELECT seq, matched FROM (
  SELECT doc_id AS seq,
         concat_ws('|', CASE WHEN contains(lower(text), 'that it') THEN 'that it' END,
                        CASE WHEN contains(lower(text), 'license') THEN 'license' END,
                        CASE WHEN contains(lower(text), 'nicht') THEN 'nicht' END) AS matched
  FROM documents)
WHERE matched <> ''"""

ORACLE["corpus_search"] = """
SELECT doc_id, lang,
       concat_ws('|', CASE WHEN contains(lower(text), 'that it') THEN 'that it' END,
                      CASE WHEN contains(lower(text), 'license') THEN 'license' END,
                      CASE WHEN contains(lower(text), 'nicht') THEN 'nicht' END) AS matched
FROM documents
WHERE (contains(lower(text), 'that it') OR contains(lower(text), 'license') OR contains(lower(text), 'nicht'))
  AND lang IN ('en', 'de')
ORDER BY doc_id DESC LIMIT 50"""

ORACLE["corpus_search_indexed"] = ORACLE["corpus_search"]

ORACLE["keyword_match_many"] = """
WITH w AS (SELECT string_split(lower(COALESCE(text, '')), ' ') AS ws FROM benchmark),
k AS (SELECT DISTINCT unnest(list_transform(range(1, greatest(len(ws), 2)), lambda i: array_to_string(ws[i:i + 1], ' '))) AS keyword FROM w)
SELECT doc_id AS seq, CAST(count(*) AS bigint) AS n_matched, string_agg(keyword, '|' ORDER BY keyword) AS matched
FROM documents JOIN k ON contains(lower(text), keyword)
GROUP BY doc_id"""

ORACLE["sweep_type_of"] = """
SELECT event_id, CASE WHEN hour(ts) < 10 THEN 'full' ELSE 'light' END AS sweep_type,
       CASE WHEN hour(ts) < 10 THEN 'Morning' ELSE 'Midday/Evening' END AS sweep_label
FROM events"""

ORACLE["sweep_gating"] = """
WITH f AS (
  SELECT event_id,
         CASE event_type WHEN 'click' THEN 'arxiv' WHEN 'view' THEN 'hackernews' WHEN 'signup' THEN 'rss'
                         WHEN 'purchase' THEN 'serp' WHEN 'error' THEN 'podcast' END AS source_type,
         CASE WHEN hour(ts) < 10 THEN 'full' ELSE 'light' END AS sweep_type
  FROM events
)
SELECT event_id, source_type, sweep_type,
       CASE WHEN source_type = 'podcast' THEN CASE WHEN event_id % 2 = 0 THEN 'disabled' ELSE 'unknown' END
            WHEN sweep_type = 'light' AND source_type = 'serp' THEN CASE WHEN event_id % 2 = 0 THEN 'skipped' ELSE 'empty' END
            ELSE 'fetch' END AS action,
       CASE source_type WHEN 'arxiv' THEN 'core_tech' WHEN 'rss' THEN 'ai_tools' ELSE 'ai_research' END AS domain
FROM f"""

# --- parsers (bodies built from the tables; parse = projection) ----------------

ORACLE["rss_items"] = _with(PAGE_ITEMS, f"""
SELECT fetch_seq, pos, title, url, summary, source, published FROM (
  SELECT CAST(seq // 10 AS bigint) AS fetch_seq,
         CAST(row_number() OVER (PARTITION BY seq // 10 ORDER BY seq) - 1 AS bigint) AS pos,
         {PYSTRIP.format(x='title')} AS title, url,
         substring({STRIP.format(x='html')}, 1, 400) AS summary,
         'rss:pages-' || CAST(seq // 10 AS varchar) AS source,
         strftime(DATE '2024-01-01' + CAST(seq % 365 AS integer), '%Y-%m-%d') AS published
  FROM pi)
WHERE title <> ''""")

DOCS = """
dj AS (
  SELECT doc_id AS seq, 'https://docs.example/' || CAST(doc_id AS varchar) AS url,
         split_part(text, chr(10), 1) AS title, text
  FROM documents
)"""

ORACLE["atom_items"] = _with(DOCS, f"""
SELECT fetch_seq, pos, title, url, summary, source, published FROM (
  SELECT CAST(seq // 10 AS bigint) AS fetch_seq,
         CAST(row_number() OVER (PARTITION BY seq // 10 ORDER BY seq) - 1 AS bigint) AS pos,
         {PYSTRIP.format(x='title')} AS title, url,
         substring({STRIP.format(x='text')}, 1, 400) AS summary,
         'rss:docs-' || CAST(seq // 10 AS varchar) AS source,
         strftime(DATE '2024-01-01' + CAST(seq % 365 AS integer), '%Y-%m-%d') AS published
  FROM dj)
WHERE title <> ''""")

ORACLE["arxiv_items"] = _with(DOCS, f"""
SELECT CAST(seq // 10 AS bigint) AS fetch_seq,
       CAST(row_number() OVER (PARTITION BY seq // 10 ORDER BY seq) - 1 AS bigint) AS pos,
       {COLLAPSE.format(x='title')} AS title, url,
       substring({COLLAPSE.format(x='text')}, 1, 500) AS summary,
       'arxiv' AS source,
       strftime(DATE '2024-01-01' + CAST(seq % 365 AS integer), '%Y-%m-%d') AS published
FROM dj""")

HN = FEED_ITEMS + """,
hits AS (
  SELECT sweep_id, seq, seq // 10 AS query_seq,
         COALESCE(NULLIF(CASE WHEN seq % 13 = 0 THEN NULL ELSE url END, ''),
                  'https://news.ycombinator.com/item?id=' || CAST(seq AS varchar)) AS url_f,
         CAST(COALESCE(CASE WHEN seq % 11 = 0 THEN NULL ELSE score * 20 END, 0) AS bigint) AS points,
         title, seq % 50 AS nc, strftime(ts, '%Y-%m-%d') AS published,
         min(source) OVER (PARTITION BY sweep_id, seq // 10) AS query
  FROM fi
),
srch AS (
  SELECT sweep_id, CAST(seq AS varchar) AS object_id, url_f AS url, title,
         CAST(points AS varchar) || ' points, ' || CAST(nc AS varchar) || ' comments on HN' AS summary,
         CASE query WHEN 'click' THEN 'ui' WHEN 'purchase' THEN 'commerce' WHEN 'error' THEN 'ops'
                    ELSE 'ai_research' END AS domain,
         published
  FROM (SELECT *, row_number() OVER (PARTITION BY sweep_id, url_f ORDER BY query_seq, seq) AS rn_u FROM hits)
  WHERE rn_u = 1 AND points >= 50
),
cands AS (
  SELECT sweep_id, CAST(rank AS bigint) AS rank, CAST(seq AS bigint) AS id, title,
         CASE WHEN seq % 4 = 1 THEN 'https://story.example/' || CAST(seq % 100 AS varchar)
              ELSE COALESCE(NULLIF(CASE WHEN seq % 13 = 0 THEN NULL ELSE url END, ''),
                            'https://news.ycombinator.com/item?id=' || CAST(seq AS varchar)) END AS url,
         CAST(score * 20 AS bigint) AS points, seq % 5 = 0 AS is_job
  FROM (SELECT *, row_number() OVER (PARTITION BY sweep_id ORDER BY seq) AS rank FROM fi)
  WHERE rank <= 50
),
topf AS (
  SELECT * FROM cands
  WHERE NOT is_job AND points >= 50 AND (contains(lower(title), 'purchase') OR contains(lower(title), 'user 1'))
)"""

TOP_OUT = """
SELECT sweep_id, rank, id, title, url, CAST(points AS varchar) || ' points on HN' AS summary,
       'ai_research' AS domain, '' AS published,
       concat_ws('|', CASE WHEN contains(lower(title), 'purchase') THEN 'purchase' END,
                      CASE WHEN contains(lower(title), 'user 1') THEN 'user 1' END) AS matched_keywords
FROM (SELECT *, row_number() OVER (PARTITION BY sweep_id, url ORDER BY rank) AS rn_t FROM {src})
WHERE rn_t = 1"""

ORACLE["hn_search_items"] = _with(HN, "SELECT * FROM srch")

ORACLE["hn_top_items"] = _with(HN, TOP_OUT.format(src="topf"))

ORACLE["hn_combined"] = _with(HN + """,
topu AS (SELECT * FROM topf t WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.sweep_id = t.sweep_id AND h.url_f = t.url)),
topk AS (""" + TOP_OUT.format(src="topu") + ")", """
SELECT sweep_id, 'search' AS kind, object_id AS item_key, url, title, summary, domain FROM srch
UNION ALL
SELECT sweep_id, 'top', CAST(id AS varchar), url, title, summary, domain FROM topk""")

ORACLE["serp_items"] = _with(PAGE_ITEMS + """,
placed AS (
  SELECT seq // 10 AS query_seq, CASE WHEN seq % 10 < 5 THEN 0 ELSE 1 END AS sec, seq, url, title, html,
         CASE WHEN seq % 3 = 0 THEN NULL ELSE strftime(DATE '2024-01-01' + CAST(seq % 365 AS integer), '%b %d, %Y') END AS d
  FROM pi
  UNION ALL
  SELECT seq // 10 - 1, 1, seq, url, title, html,
         CASE WHEN seq % 3 = 0 THEN NULL ELSE strftime(DATE '2024-01-01' + CAST(seq % 365 AS integer), '%b %d, %Y') END
  FROM pi WHERE seq % 10 < 5 AND seq // 10 >= 1
),
ordered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_seq ORDER BY sec, seq) - 1 AS bigint) AS pos FROM placed
)""", """
SELECT CAST(query_seq AS bigint) AS query_seq, pos, url, title, substring(html, 1, 400) AS summary,
       COALESCE(d, '') AS published
FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY query_seq, pos) AS rn_u FROM ordered)
WHERE rn_u = 1 AND NOT contains(url, 'SPAM-farm') AND NOT contains(url, 'cheap-pills')""")

# --- digest text ----------------------------------------------------------------

_REP_ONLY = REPORT[len(CHECKED):]
_CUR_ONLY = CURATED[len(CHECKED):]
_SCORED_ONLY = SCORED[len(CURATED):]
_BUDGET_ONLY = BUDGETS[len(SCORED):]
_WARN = ORACLE["quality_warnings"]
_WARN_ONLY = _WARN[_WARN.index(",\nsrcs AS ("):_WARN.index("\nSELECT * FROM w WHERE warning IS NOT NULL")]

DIGEST = CHECKED + _REP_ONLY + _WARN_ONLY + _CUR_ONLY + _SCORED_ONLY + _BUDGET_ONLY + "," + FETCH_LOG + """,
sw AS (SELECT sweep_id, min(sweep_ts) AS sweep_ts,
              CASE WHEN hour(min(sweep_ts)) < 10 THEN 'full' ELSE 'light' END AS sweep_type
       FROM fi GROUP BY sweep_id),
asf AS (
  SELECT sw.sweep_id, f.*, max(CASE WHEN f.ok THEN f.ts END) OVER (PARTITION BY sw.sweep_id, f.feed_id) AS lok
  FROM sw JOIN fl f ON CAST(day(CAST(f.ts AS date)) AS bigint) <= sw.sweep_id
),
sick AS (
  SELECT sweep_id, feed_id,
         count(*) FILTER (WHERE NOT ok AND (lok IS NULL OR ts > lok)) AS cf,
         arg_max(error, ts) FILTER (WHERE NOT ok) AS le,
         arg_max(status_code, ts) FILTER (WHERE NOT ok) AS lc
  FROM asf GROUP BY sweep_id, feed_id
  HAVING count(*) FILTER (WHERE NOT ok AND (lok IS NULL OR ts > lok)) >= 3
),
sqa AS (
  SELECT sw.sweep_id, c.source, count(*) AS total_scored, count(*) FILTER (WHERE c.score >= 3) AS s3
  FROM sw JOIN cur c ON c.sweep_id <= sw.sweep_id GROUP BY sw.sweep_id, c.source
),
tot AS (
  SELECT sw.sweep_id, sw.sweep_type, count(x.seq) AS n,
         count(x.seq) FILTER (WHERE x.tier = 'RED') AS r, count(x.seq) FILTER (WHERE x.tier = 'ORANGE') AS o,
         count(x.seq) FILTER (WHERE x.tier = 'YELLOW') AS y
  FROM sw LEFT JOIN shown x USING (sweep_id) GROUP BY sw.sweep_id, sw.sweep_type
),
ws AS (SELECT * FROM w WHERE warning IS NOT NULL),
tl AS (SELECT *, CASE tier WHEN 'RED' THEN 0 WHEN 'ORANGE' THEN 1 ELSE 2 END AS t,
              CASE tier WHEN 'RED' THEN 'RED (act on this)' WHEN 'ORANGE' THEN 'ORANGE (shapes your model)'
                        ELSE 'YELLOW (context)' END AS lab
       FROM shown),
lines AS (
  SELECT sweep_id, 0 AS k1, 0 AS k2, 0 AS k3, 0 AS k4,
         '# Digest | ' || strftime(sweep_ts, '%Y-%m-%d') || ' ' ||
         CASE sweep_type WHEN 'full' THEN 'Morning' WHEN 'light' THEN 'Midday/Evening' ELSE sweep_type END
         || strftime(sweep_ts, ' (%H:%M)') AS line
  FROM sw
  UNION ALL SELECT sweep_id, 0, 0, 0, 1, '' FROM sw
  UNION ALL SELECT DISTINCT sweep_id, 1, 0, 0, 0, '## FEED HEALTH' FROM sick
  UNION ALL SELECT DISTINCT sweep_id, 1, 2, 0, 0, '' FROM sick
  UNION ALL SELECT sweep_id, 1, 1, dense_rank() OVER (PARTITION BY sweep_id ORDER BY feed_id), 0,
                   '- **' || feed_id || '** -- ' || CAST(cf AS varchar) || ' consecutive failures. Last error: '
                   || COALESCE(le, 'unknown') || ' (HTTP ' || COALESCE(CAST(lc AS varchar), '?') || ')'
            FROM sick
  UNION ALL SELECT DISTINCT sweep_id, 2, 0, 0, 0, '## EXTRACTION QUALITY' FROM ws
  UNION ALL SELECT DISTINCT sweep_id, 2, 2, 0, 0, '' FROM ws
  UNION ALL SELECT sweep_id, 2, 1, ord, 0, '- ' || warning FROM ws
  UNION ALL SELECT DISTINCT sweep_id, 3, t, 0, 0, '## ' || lab FROM tl
  UNION ALL SELECT DISTINCT sweep_id, 3, t, 0, 1, '' FROM tl
  UNION ALL SELECT sweep_id, 3, t, rank, 0,
                   '- **[' || title || '](' || url || ')** `' || source || '` `' || domain || '`' FROM tl
  UNION ALL SELECT sweep_id, 3, t, rank, 1, '  ' || summary FROM tl WHERE summary <> ''
  UNION ALL SELECT sweep_id, 3, t, rank, 2, '' FROM tl
  UNION ALL SELECT sweep_id, 3, 0, 0, 0, '*Nothing above noise threshold. Clean day.*' FROM tot WHERE n = 0
  UNION ALL SELECT sweep_id, 3, 0, 0, 1, '' FROM tot WHERE n = 0
  UNION ALL SELECT sweep_id, 4, 0, 0, 0, '---' FROM tot
  UNION ALL SELECT sweep_id, 4, 0, 0, 1, '*' || CAST(n AS varchar) || ' items surfaced from ' || sweep_type
                   || ' sweep. RED: ' || CAST(r AS varchar) || ', ORANGE: ' || CAST(o AS varchar)
                   || ', YELLOW: ' || CAST(y AS varchar) || '*' FROM tot
  UNION ALL SELECT sweep_id, 4, 0, 0, 2, '' FROM tot
  UNION ALL SELECT DISTINCT sweep_id, 5, 0, 0, 0, '### Source Signal Rates' FROM sqa
  UNION ALL SELECT DISTINCT sweep_id, 5, 2, 0, 0, '' FROM sqa
  UNION ALL SELECT sweep_id, 5, 1,
                   row_number() OVER (PARTITION BY sweep_id ORDER BY (200 * s3 + total_scored) // (2 * total_scored) DESC, source),
                   0, '- `' || source || '` signal: ' || CAST((200 * s3 + total_scored) // (2 * total_scored) AS varchar)
                   || '% (' || CAST(s3 AS varchar) || '/' || CAST(total_scored AS varchar) || ')'
            FROM sqa WHERE total_scored >= 5
)"""

ORACLE["digest_lines"] = _with(DIGEST, """
SELECT sweep_id, CAST(count(*) AS bigint) AS n_lines, string_agg(line, chr(10) ORDER BY k1, k2, k3, k4) AS digest
FROM lines GROUP BY sweep_id""")

ORACLE["digest_files"] = f"""
SELECT sweep_id, CASE WHEN sweep_id % 3 = 2 THEN '1300' ELSE '0700' END AS hour, digest FROM ({ORACLE["digest_lines"]})"""

ORACLE["sources_only_items"] = _with(CURATED, """
SELECT sweep_id, seq, domain, source, title,
       CAST(sum(CASE WHEN first THEN 1 ELSE 0 END) OVER (PARTITION BY sweep_id) AS bigint) AS n_new
FROM (SELECT *, sweep_ts = min(sweep_ts) OVER (PARTITION BY item_id) AS first FROM cur)""")

# --- streaming: the stream must equal the batch query -------------------------

ORACLE["stream_equals_batch"] = ORACLE["curated_items"]
ORACLE["stream_dedup"] = ORACLE["dedup_window"]
ORACLE["stream_feed_health"] = ORACLE["feed_health"]
ORACLE["stream_source_quality"] = ORACLE["source_quality"]


# --- whole sweeps ---------------------------------------------------------------

ORACLE["sweep_run_log"] = _with(CHECKED + """,
noise AS (
  SELECT * FROM dd
  WHERE NOT (contains(lower(url), 'spam-farm') OR contains(lower(url), 'cheap-pills'))
    AND NOT regexp_matches(lower(title || ' ' || summary), '(license)|(tion.*sch)', 'i')
),
kept AS (
  SELECT * FROM (SELECT *, min(sweep_ts) OVER (PARTITION BY item_id) AS first_seen FROM noise)
  WHERE sweep_ts = first_seen OR first_seen <= sweep_ts - INTERVAL 48 HOURS
),
marked AS (
  SELECT *, '[ai_research] ' || title || ' | ' || substring(summary, 1, 200) AS line,
         ((row_number() OVER (PARTITION BY sweep_id ORDER BY seq) - 1) // 40) % 4 = 3 AS failed FROM kept
),
scored AS (
  SELECT sweep_id, seq, item_id, source, failed,
         CAST(CASE WHEN failed THEN 2 WHEN contains(lower(line), 'user 1') THEN 4
                   WHEN contains(lower(line), 'purchase') OR contains(lower(line), 'signup') THEN 3 ELSE 1 END AS bigint) AS score
  FROM marked
)""", """
SELECT sweep_id, seq, item_id, source, score,
       CASE score WHEN 4 THEN 'ORANGE' WHEN 3 THEN 'YELLOW' WHEN 2 THEN 'YELLOW' ELSE 'GREY' END AS tier,
       CASE WHEN failed THEN 'scoring failed' WHEN score > 1 THEN 'keyword match' ELSE 'no match' END AS reason,
       CAST(count(*) OVER (PARTITION BY source) AS bigint) AS total_scored
FROM scored""")

# the store knows an item by the first sweep of the run that met it first; runs: odd, even, again, sweep 2 without a source
ORACLE["sweep_run_log_all"] = _with(CHECKED + """,
noise AS (
  SELECT *, sweep_id IN (5, 6, 9, 10, 11) AS again FROM dd
  WHERE NOT (contains(lower(url), 'spam-farm') OR contains(lower(url), 'cheap-pills'))
    AND NOT regexp_matches(lower(title || ' ' || summary), '(license)|(tion.*sch)', 'i')
),
odd AS (SELECT item_id, min(sweep_ts) AS f, min(sweep_id) AS s FROM noise WHERE sweep_id % 2 = 1 GROUP BY item_id),
even AS (SELECT item_id, min(sweep_ts) AS f, min(sweep_id) AS s FROM noise WHERE sweep_id % 2 = 0 GROUP BY item_id),
met AS (
  SELECT * FROM odd UNION ALL SELECT * FROM even WHERE item_id NOT IN (SELECT item_id FROM odd)
),
stayed AS (SELECT * FROM met WHERE s NOT IN (5, 6, 9, 10, 11)),
anew AS (SELECT item_id, min(sweep_ts) AS f, min(sweep_id) AS s FROM noise WHERE again GROUP BY item_id),
last_met AS (
  SELECT * FROM stayed UNION ALL SELECT * FROM anew WHERE item_id NOT IN (SELECT item_id FROM stayed)
),
known AS (
  SELECT n.*, CASE WHEN again THEN least(a.f, COALESCE(st.f, a.f))
                   WHEN n.sweep_id = 2 THEN least(n.sweep_ts, COALESCE(l.f, n.sweep_ts))
                   WHEN n.sweep_id % 2 = 1 THEN o.f ELSE least(e.f, COALESCE(o.f, e.f)) END AS first_seen
  FROM noise n
  LEFT JOIN odd o ON o.item_id = n.item_id
  LEFT JOIN even e ON e.item_id = n.item_id
  LEFT JOIN anew a ON a.item_id = n.item_id
  LEFT JOIN stayed st ON st.item_id = n.item_id
  LEFT JOIN last_met l ON l.item_id = n.item_id AND l.s <> 2
  WHERE NOT (n.sweep_id = 2 AND n.source = 'click')
),
kept AS (
  SELECT * FROM known WHERE sweep_ts = first_seen OR first_seen <= sweep_ts - INTERVAL 48 HOURS
),
marked AS (
  SELECT *, '[ai_research] ' || title || ' | ' || substring(summary, 1, 200) AS line FROM kept
),
scored AS (
  SELECT sweep_id, seq, item_id, source,
         CAST(CASE WHEN contains(lower(line), 'user 1') THEN 4
                   WHEN contains(lower(line), 'purchase') OR contains(lower(line), 'signup') THEN 3 ELSE 1 END AS bigint) AS score
  FROM marked
)""", """
SELECT sweep_id, seq, item_id, source, score,
       CASE score WHEN 4 THEN 'ORANGE' WHEN 3 THEN 'YELLOW' ELSE 'GREY' END AS tier,
       CASE WHEN score > 1 THEN 'keyword match' ELSE 'no match' END AS reason,
       CAST(count(*) OVER (PARTITION BY source) AS bigint) AS total_scored
FROM scored""")

ORACLE["raw_sweep_items"] = _with(HN + ",\n" + PAGE_ITEMS.strip() + """,
kinds AS (SELECT DISTINCT sweep_id, hour(sweep_ts) < 10 AS is_full FROM fi),
seen_hits AS (SELECT h.* FROM hits h JOIN kinds k USING (sweep_id) WHERE k.is_full),
hn_search AS (
  SELECT sweep_id, url_f AS url, title, CASE query WHEN 'click' THEN 'ui' ELSE 'ai_research' END AS domain
  FROM (SELECT *, row_number() OVER (PARTITION BY sweep_id, url_f ORDER BY query_seq, seq) AS rn_u FROM seen_hits)
  WHERE rn_u = 1 AND points >= 60
),
hn_top AS (
  SELECT sweep_id, url, title, 'ai_research' AS domain FROM (
    SELECT t.*, row_number() OVER (PARTITION BY t.sweep_id, t.url ORDER BY rank) AS rn_t
    FROM cands t JOIN kinds k USING (sweep_id)
    WHERE t.rank <= CASE WHEN k.is_full THEN 30 ELSE 15 END AND NOT is_job AND points >= 60
      AND (contains(lower(title), 'purchase') OR contains(lower(title), 'user 1'))
      AND NOT EXISTS (SELECT 1 FROM seen_hits h WHERE h.sweep_id = t.sweep_id AND h.url_f = t.url))
  WHERE rn_t = 1
),
rss AS (
  SELECT CAST((seq // 10) % 30 + 1 AS bigint) AS sweep_id, url, trim(title) AS title,
         'rss:pages-' || CAST(seq // 10 AS varchar) AS source FROM pi
  WHERE trim(title) <> ''
),
serp_rows AS (
  SELECT seq // 10 AS q, CASE WHEN seq % 10 < 5 THEN 0 ELSE 1 END AS sec, seq, url, title FROM pi
  UNION ALL
  SELECT seq // 10 - 1, 1, seq, url, title FROM pi WHERE seq % 10 < 5 AND seq >= 10
),
serp AS (
  SELECT sweep_id, url, title FROM (
    SELECT CAST(q % 30 + 1 AS bigint) AS sweep_id, url, title,
           row_number() OVER (PARTITION BY q % 30 + 1, url ORDER BY q, sec, seq) AS rn_w FROM serp_rows)
  WHERE rn_w = 1 AND NOT (contains(url, 'SPAM-farm') OR contains(url, 'cheap-pills'))
)""", """
SELECT sweep_id, 'hackernews' AS source_type, url, title, 'hackernews' AS source, domain FROM hn_search
UNION ALL SELECT sweep_id, 'hackernews', url, title, 'hackernews', domain FROM hn_top
UNION ALL SELECT sweep_id, 'rss', url, title, source, 'ai_research' FROM rss JOIN kinds USING (sweep_id)
UNION ALL SELECT sweep_id, 'serp', url, title, 'serp', 'ai_research' FROM serp JOIN kinds USING (sweep_id) WHERE is_full""")
