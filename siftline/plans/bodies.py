"""Raw payloads generated from the driver's tables, landed as RAW_FETCH
rows, so the parsers run on data that grows with the tables. Parsing must
give back the fields the bodies were built from; the oracle is a plain
projection of the same relation.

Each body groups a bounded number of rows (10 per feed body or response),
so ``collect_list`` never gathers an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import xml_escape
from . import fixtures as fx

PER_BODY = 10


def _join_sorted(order: Column, piece: Column) -> Column:
    """Concatenate ``piece`` of a (bounded) group in ``order``."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), piece.alias("p")))),
                                    lambda x: x["p"]), "")


def _tag(name: str, text: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), xml_escape(text), F.lit(f"</{name}>"))


def pub_day(seq: Column) -> Column:
    """A publication day per row: 2024-01-01 + (seq mod 365) days."""
    return F.date_add(F.lit("2024-01-01").cast("date"), (seq % 365).cast("int"))


def rss_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS 2.0 feeds of page items, ten per body, RFC-822 dates."""
    p = fx.page_items(spark, sf_dir)
    date = F.concat(F.date_format(pub_day(F.col("seq")), "EEE, dd MMM yyyy"), F.lit(" 08:30:00 GMT"))
    item = F.concat(F.lit("<item>"), _tag("title", F.col("title")), _tag("link", F.col("url")),
                    _tag("description", F.col("html")), _tag("pubDate", date), F.lit("</item>"))
    g = F.floor(F.col("seq") / PER_BODY).cast("bigint")
    return p.groupBy(g.alias("fetch_seq")).agg(
        F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>pages</title>'),
                 _join_sorted(F.col("seq"), item), F.lit("</channel></rss>")).alias("body")
    ).select(F.lit(0).cast("bigint").alias("sweep_id"), "fetch_seq",
             F.concat(F.lit("pages-"), F.col("fetch_seq").cast("string")).alias("feed_name"),
             F.lit("web").alias("domain"), "body")


def atom_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atom feeds of whole documents, ten per body, ISO dates."""
    d = fx.doc_items(spark, sf_dir)
    date = F.concat(F.date_format(pub_day(F.col("seq")), "yyyy-MM-dd"), F.lit("T12:00:00Z"))
    entry = F.concat(F.lit("<entry>"), _tag("title", F.col("title")),
                     F.concat(F.lit('<link href="'), xml_escape(F.col("url")), F.lit('"/>')),
                     _tag("id", F.col("url")), _tag("summary", F.col("text")), _tag("published", date),
                     F.lit("</entry>"))
    g = F.floor(F.col("seq") / PER_BODY).cast("bigint")
    return d.groupBy(g.alias("fetch_seq")).agg(
        F.concat(F.lit('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>docs</title>'),
                 _join_sorted(F.col("seq"), entry), F.lit("</feed>")).alias("body")
    ).select(F.lit(0).cast("bigint").alias("sweep_id"), "fetch_seq",
             F.concat(F.lit("docs-"), F.col("fetch_seq").cast("string")).alias("feed_name"),
             F.lit("docs").alias("domain"), "body")


def arxiv_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """arXiv-style Atom responses of whole documents, ten per response."""
    d = fx.doc_items(spark, sf_dir)
    date = F.concat(F.date_format(pub_day(F.col("seq")), "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    entry = F.concat(F.lit("<entry>"), _tag("id", F.col("url")), _tag("published", date),
                     _tag("title", F.col("title")), _tag("summary", F.col("text")), F.lit("</entry>"))
    g = F.floor(F.col("seq") / PER_BODY).cast("bigint")
    return d.groupBy(g.alias("fetch_seq")).agg(
        F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), _join_sorted(F.col("seq"), entry),
                 F.lit("</feed>")).alias("body")
    ).select(F.lit(0).cast("bigint").alias("sweep_id"), "fetch_seq", F.lit("papers").alias("domain"), "body")


def hn_search_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search responses of feed items: ten hits per response; the query is
    the item's source; some urls and points are null."""
    f = fx.feed_items(spark, sf_dir)
    s = F.col("seq")
    hit = F.struct(
        F.when(s % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("url")).alias("url"),
        s.cast("string").alias("objectID"),
        F.when(s % 11 == 0, F.lit(None).cast("bigint")).otherwise(F.col("score") * 20).cast("bigint").alias("points"),
        F.col("title").alias("title"), (s % 50).cast("bigint").alias("num_comments"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"))
    g = F.floor(s / PER_BODY).cast("bigint")
    return f.groupBy("sweep_id", g.alias("query_seq")).agg(
        F.min("source").alias("query"),
        F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct(s.alias("o"), hit.alias("h")))),
                                       lambda x: x["h"]).alias("hits"))).alias("body"))


def hn_top_lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Top-story list per sweep (rank = arrival order, one row per story)
    and one item body per story; every fifth item is a job, not a story;
    every fourth has a URL that no search hit has."""
    f = fx.feed_items(spark, sf_dir)
    s = F.col("seq")
    from ..operators.ordering import positions
    top = positions(f.select("sweep_id", "seq"), ["sweep_id"], ["seq"], "_p").select(
        "sweep_id", F.col("seq").alias("id"), (F.col("_p") + 1).alias("rank"))
    body = F.to_json(F.struct(
        F.when(s % 5 == 0, F.lit("job")).otherwise(F.lit("story")).alias("type"),
        F.col("title").alias("title"),
        F.when(s % 4 == 1, F.concat(F.lit("https://story.example/"), (s % 100).cast("string")))
        .when(s % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("url")).alias("url"),
        s.alias("id"), (F.col("score") * 20).cast("bigint").alias("score")))
    stories = f.select("sweep_id", s.alias("id"), body.alias("body"))
    return top, stories


def serp_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web-search responses of page items: response r has pages 10r..10r+4
    as news and 10r+5..10r+14 as organic results, so organic results repeat
    in the next response's news (cross-query duplicates)."""
    p = fx.page_items(spark, sf_dir)
    s = F.col("seq")
    r = F.floor(s / PER_BODY).cast("bigint")
    named = p.select("seq", F.col("url").alias("link"), "title", F.col("html").alias("snippet"),
                     F.when(s % 3 == 0, F.lit(None).cast("string"))
                     .otherwise(F.date_format(pub_day(s), "MMM dd, yyyy")).alias("date"))
    res = F.struct("link", "title", "snippet", "date")
    # (response, section 0 = news / 1 = organic) each page belongs to
    homes = F.array(
        F.struct(r.alias("q"), F.when(s % 10 < 5, F.lit(0)).otherwise(F.lit(1)).alias("sec")),
        F.struct((r - 1).alias("q"), F.lit(1).alias("sec")))
    placed = (named.select("seq", res.alias("res"), F.explode(homes).alias("h"))
              .where((F.col("h.q") >= 0) & ((F.col("h.q") == r) | (F.col("seq") % 10 < 5)))
              .select("seq", "res", F.col("h.q").alias("query_seq"), F.col("h.sec").alias("sec")))

    def section(k):
        return F.transform(F.array_sort(F.collect_list(F.when(F.col("sec") == k, F.struct(
            F.col("seq").alias("o"), F.col("res").alias("r"))))), lambda x: x["r"])
    return placed.groupBy("query_seq").agg(
        F.to_json(F.struct(section(0).alias("news_results"), section(1).alias("organic_results"))).alias("body")
    ).select(F.lit(0).cast("bigint").alias("sweep_id"), "query_seq",
             F.concat(F.lit("q"), F.col("query_seq").cast("string")).alias("query"), "body")


def raw_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payloads (RAW_FETCH) of all sweeps: the search responses of each
    sweep, and the page feeds and web searches dealt over the sweeps. Sweeps
    are full and light in turn (``feed_items``)."""
    times = fx.feed_items(spark, sf_dir).groupBy("sweep_id").agg(F.min("sweep_ts").alias("sweep_ts"))
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, source: str, seq: str, feed: Column, query: Column) -> DataFrame:
        return df.select("sweep_id", F.lit(source).alias("source_type"), feed.alias("feed_name"), none.alias("feed_url"),
                         query.alias("query"), none.alias("domain"), F.col(seq).cast("bigint").alias("fetch_seq"),
                         F.lit(None).cast("int").alias("status_code"), none.alias("error"), "body")
    dealt = (F.col("n") % 30 + 1).cast("bigint")
    rss = rss_bodies(spark, sf_dir).drop("sweep_id").withColumn("n", F.col("fetch_seq")).withColumn("sweep_id", dealt)
    serp = serp_bodies(spark, sf_dir).drop("sweep_id").withColumn("n", F.col("query_seq")).withColumn("sweep_id", dealt)
    every = (rows(hn_search_bodies(spark, sf_dir), "hackernews", "query_seq", none, F.col("query"))
             .unionByName(rows(rss, "rss", "fetch_seq", F.col("feed_name"), none))
             .unionByName(rows(serp, "serp", "query_seq", none, F.col("query"))))
    from ..functions.dates import sweep_type_of
    return every.join(times, "sweep_id").withColumn("sweep_type", sweep_type_of(F.col("sweep_ts")))
