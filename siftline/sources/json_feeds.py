"""Hacker News and web-search payloads -> items (S4, S5, S6, D3, D4, F4,
F5, F10, P6, P7).

The raw-URL "seen" rules are first-wins dedups by arrival order inside one
sweep's fetch of a source; they use the same aggregate-and-join pattern as
the item dedup, keyed by (sweep, url) and spread by position.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_DOMAIN, DEFAULT_MIN_POINTS, HN_HITS_PER_QUERY, TOP_STORY_CAP
from ..functions.keywords import contains_any_raw
from ..operators.keyword_match import containing
from ..functions.text import blank_to_empty, points_text, truncate, url_or_discussion
from ..operators.ordering import keep_first

HIT = "struct<url:string,objectID:string,points:bigint,title:string,num_comments:bigint,created_at:string>"
HN_SEARCH_SCHEMA = f"hits array<{HIT}>"
HN_ITEM_SCHEMA = "type string, title string, url string, id bigint, score bigint"
SERP_RESULT = "struct<link:string,title:string,snippet:string,date:string>"
SERP_SCHEMA = f"news_results array<{SERP_RESULT}>, organic_results array<{SERP_RESULT}>"


def _order() -> F.Column:
    """Query, then place in its response, as one long; too many to fit is an
    error."""
    q, pos = F.col("query_seq"), F.col("pos")
    fits = (pos < (1 << 20)) & (q >= 0) & (q < (1 << 42))
    return F.when(fits, q * F.lit(1 << 20) + pos).otherwise(
        F.raise_error(F.lit("query_seq or position beyond 42 and 20 bits")).cast("bigint"))


def _term_domain(query_col, terms: Mapping[str, str | None], default: str) -> F.Column:
    expr = F.lit(default)
    for q, d in terms.items():
        expr = F.when(query_col == q, F.lit(d or default)).otherwise(expr)
    return expr


def hn_search_hits(raw: DataFrame, terms: Mapping[str, str | None] | None = None,
                   default_domain: str = DEFAULT_DOMAIN, max_hits: int = HN_HITS_PER_QUERY) -> DataFrame:
    """The hits of every search response, in arrival order
    (``query_seq``, ``pos``), with the URL fallback and null -> 0/"" (Q7).
    ``raw``: ``sweep_id, query_seq, query, body``; empty queries skipped. A
    query asks for ``max_hits`` (W3), and further ones are not read."""
    r = raw.where(F.coalesce(F.col("query"), F.lit("")) != "")
    dom = _term_domain(F.col("query"), terms or {}, default_domain) if terms is not None \
        else (F.coalesce(F.col("domain"), F.lit(default_domain)) if "domain" in raw.columns
              else F.lit(default_domain))
    ex = r.select("sweep_id", "query_seq", dom.alias("domain"),
                  F.posexplode(F.from_json("body", HN_SEARCH_SCHEMA)["hits"]).alias("pos", "_h")).where(F.col("pos") < max_hits)
    pts = F.coalesce(F.col("_h.points"), F.lit(0))
    return ex.select(
        "sweep_id", "query_seq", F.col("pos").cast("bigint").alias("pos"), "domain",
        F.col("_h.objectID").alias("object_id"),
        url_or_discussion(F.col("_h.url"), F.col("_h.objectID")).alias("url"),
        pts.alias("points"), blank_to_empty(F.col("_h.title")).alias("title"),
        points_text(pts, F.coalesce(F.col("_h.num_comments"), F.lit(0))).alias("summary"),
        F.substring(blank_to_empty(F.col("_h.created_at")), 1, 10).alias("published"))


def hn_search_items(hits: DataFrame, min_points: int = DEFAULT_MIN_POINTS) -> DataFrame:
    """Search items (S4): a hit marks its raw URL seen *before* the points
    test, so a low-point hit hides the same URL in later hits (D3); then
    points >= min_points (F5)."""
    hits = hits.withColumn("_order", _order())
    first = keep_first(hits, ["sweep_id", "url"], "_order").drop("_order")
    return first.where(F.col("points") >= min_points).withColumn("source", F.lit("hackernews"))


def hn_top_stories(top: DataFrame, stories: DataFrame, top_n: int, sweep_type: str = "full") -> DataFrame:
    """Ranked candidates (S5): the top list is cut to min(n, 50) *before*
    any filter (n halved on light sweeps); stories are joined by id.
    ``top``: ``sweep_id, rank, id`` and, for sweeps of both kinds,
    ``sweep_type``; ``stories``: ``sweep_id, id, body``.
    A story that could not be fetched (no body) is skipped."""
    kind = F.col("sweep_type") if "sweep_type" in top.columns else F.lit(sweep_type)
    n = F.when(kind == "full", F.lit(top_n)).otherwise(F.lit(top_n // 2))
    ranked = top.where(F.col("rank") <= F.least(n, F.lit(TOP_STORY_CAP))).select("sweep_id", "rank", "id")
    parsed = stories.select("sweep_id", "id", F.from_json("body", HN_ITEM_SCHEMA).alias("_s"))
    j = ranked.join(parsed, ["sweep_id", "id"])
    pts = F.coalesce(F.col("_s.score"), F.lit(0))
    return j.where(F.col("_s").isNotNull()).select(
        "sweep_id", F.col("rank").cast("bigint").alias("rank"), F.col("id").cast("bigint").alias("id"),
        blank_to_empty(F.col("_s.type")).alias("type"), blank_to_empty(F.col("_s.title")).alias("title"),
        url_or_discussion(F.col("_s.url"), F.col("id")).alias("url"), pts.alias("points"))


def hn_top_items(cands: DataFrame, keywords: Iterable[str], min_points: int = DEFAULT_MIN_POINTS,
                 seen_urls: DataFrame | None = None) -> DataFrame:
    """Top stories kept (S5, F10, F5, P8, D3): type ``story``, points >=
    min_points, lower(title) contains any keyword of any domain; a URL
    already seen by the search phase (any hit, kept or not) is skipped;
    among kept stories the first by rank wins. Domain is always the
    default one (Q9); ``matched_keywords`` is exposed as an extra."""
    kws = list(keywords)
    c = cands
    if seen_urls is not None:
        c = c.join(seen_urls.select("sweep_id", "url").distinct(), ["sweep_id", "url"], "left_anti")
    kept = containing(c.where((F.col("type") == "story") & (F.col("points") >= min_points)), "title", kws, "matched_keywords")
    kept = keep_first(kept, ["sweep_id", "url"], "rank")
    return kept.select("sweep_id", "rank", "id", "title", "url",
                       points_text(F.col("points")).alias("summary"),
                       F.lit(DEFAULT_DOMAIN).alias("domain"), F.lit("").alias("published"),
                       F.lit("hackernews").alias("source"), "matched_keywords")


def hn_items(hits: DataFrame, cands: DataFrame, keywords: Iterable[str],
             min_points: int = DEFAULT_MIN_POINTS) -> DataFrame:
    """Search and top-story items of a sweep together (S4, S5, D3): what
    ``hn_search_items`` and ``hn_top_items`` keep, in one shuffle. Per (sweep,
    raw URL) the first row wins, hits before stories, and a hit hides a URL
    whatever its points; a story only counts if it passes its own tests. Rows
    are told apart by ``kind``; ``pos`` of a story is its rank less one."""
    kws = list(keywords)
    cols = ["sweep_id", "kind", "query_seq", "pos", "domain", "item_key", "url", "points", "title", "summary", "published"]
    search = hits.select("sweep_id", F.lit("search").alias("kind"), "query_seq", "pos", "domain",
                         F.col("object_id").alias("item_key"), "url", "points", "title", "summary", "published")
    top = containing(cands.where((F.col("type") == "story") & (F.col("points") >= min_points)), "title", kws).select(
        "sweep_id", F.lit("top").alias("kind"), F.lit(1 << 41).alias("query_seq"), (F.col("rank") - 1).alias("pos"),
        F.lit(DEFAULT_DOMAIN).alias("domain"), F.col("id").cast("string").alias("item_key"), "url", "points", "title",
        points_text(F.col("points")).alias("summary"), F.lit("").alias("published"))
    rows = search.select(cols).unionByName(top.select(cols)).withColumn("_order", _order())
    first = rows.groupBy("sweep_id", "url").agg(F.min_by(F.struct(
        *[c for c in cols if c not in ("sweep_id", "url")]), "_order").alias("x"))
    return (first.select("sweep_id", "url", "x.*").where(F.col("points") >= min_points)
            .withColumn("source", F.lit("hackernews")))


def serp_results(raw: DataFrame, terms: Mapping[str, str | None] | None = None,
                 default_domain: str = DEFAULT_DOMAIN) -> DataFrame:
    """Every web-search result in arrival order: news results then organic
    results of each response (U2). ``raw``: ``sweep_id, query_seq, query,
    body``; empty queries skipped."""
    r = raw.where(F.coalesce(F.col("query"), F.lit("")) != "")
    dom = _term_domain(F.col("query"), terms or {}, default_domain) if terms is not None \
        else (F.coalesce(F.col("domain"), F.lit(default_domain)) if "domain" in raw.columns
              else F.lit(default_domain))
    doc = F.from_json("body", SERP_SCHEMA)
    both = F.concat(F.coalesce(doc["news_results"], F.array()), F.coalesce(doc["organic_results"], F.array()))
    ex = r.select("sweep_id", "query_seq", dom.alias("domain"), F.posexplode(both).alias("pos", "_r"))
    return ex.select(
        "sweep_id", "query_seq", F.col("pos").cast("bigint").alias("pos"), "domain",
        blank_to_empty(F.col("_r.link")).alias("url"), blank_to_empty(F.col("_r.title")).alias("title"),
        truncate(blank_to_empty(F.col("_r.snippet")), 400).alias("summary"),
        blank_to_empty(F.col("_r.date")).alias("published"))


def serp_items(results: DataFrame, skip_domains: Iterable[str]) -> DataFrame:
    """Web-search items (S6): first copy of each raw link across the
    sweep's queries (an empty link dedups too) (D4), *then* the
    case-sensitive skip-domain test on the raw link (F4)."""
    r = results.withColumn("_order", _order())
    first = keep_first(r, ["sweep_id", "url"], "_order").drop("_order")
    return first.where(~contains_any_raw(F.col("url"), list(skip_domains))) \
        .withColumn("source", F.lit("serp"))
