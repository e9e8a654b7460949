"""Relations derived from the driver's tables (feed_items, fetch_log,
page_items, doc_items). Each is a plain projection, so its work grows with
the tables; the same derivations are written in SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_DOMAIN
from ..functions.ids import item_id as item_id_expr

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (read once per session and folder; a frame is a lazy
    plan, so this only saves listing and plan round trips)."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _TABLES[key]


def _k(props: Column) -> Column:
    return F.regexp_extract(props, "([0-9]+)", 1)


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty, repetitive items; one sweep per day, every third one light. Some
    hit the noise settings; sweep 9 has no valid item, sweep 30 none of note,
    and sources fall short of valid titles (4) and of summaries (6)."""
    e = table(spark, sf_dir, "events")
    eid, kind = F.col("event_id"), F.col("event_type")
    k = _k(F.col("props"))
    user = F.col("user_id").cast("string")
    ts = F.col("ts").cast("timestamp")
    day = F.dayofmonth(ts)
    blank = (eid % 97 == 0) | (day == 9) | ((day == 4) & (kind == "error") & (eid % 3 != 0))
    title = F.when(blank, F.lit("  ")).otherwise(
        F.concat(kind, F.lit(" by user "), user, F.when(eid % 41 == 0, F.lit(" (License)")).otherwise(F.lit(""))))
    tail = F.when(eid % 3 == 0, F.lit("/")).when(eid % 3 == 1, F.lit("")).otherwise(F.lit("//"))
    url = (F.when(eid % 89 == 0, F.lit(""))
           .when(eid % 83 == 0, F.concat(F.lit("ftp://Ex.org/u/"), user))
           .when(eid % 43 == 0, F.concat(F.lit("https://Spam-Farm.example/"), user))
           .otherwise(F.concat(F.lit("https://Ex.org/u/"), user, F.lit("/"), kind, tail)))
    summary = F.when((eid % 7 == 0) | ((day == 6) & (kind == "view") & (eid % 2 == 0)), F.lit("")).otherwise(
        F.concat(F.lit("k "), k))
    score = F.when(day == 30, F.lit(1)).otherwise(F.lit(1) + k.cast("int") % 5).cast("int")
    tier = (F.when(eid % 4 == 0, F.lit("RED")).when(eid % 4 == 1, F.lit("ORANGE"))
            .when(eid % 4 == 2, F.lit("YELLOW")).otherwise(F.lit("GREY")))
    start = F.date_trunc("day", ts) + F.when(day % 3 == 2, F.expr("INTERVAL 13 HOURS")).otherwise(F.expr("INTERVAL 7 HOURS"))
    return e.select(
        eid.alias("seq"), ts.alias("ts"), day.cast("bigint").alias("sweep_id"), start.alias("sweep_ts"),
        kind.alias("source"), title.alias("title"), url.alias("url"),
        summary.alias("summary"), score.alias("score"), tier.alias("tier"))


def feed_item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """feed_items in the ITEM layout (source doubles as source type)."""
    f = feed_items(spark, sf_dir)
    return f.select(
        "sweep_id", "sweep_ts", F.col("source").alias("source_type"), "seq",
        item_id_expr(F.col("url")).alias("item_id"), "title", "url", "summary", "source",
        F.lit(DEFAULT_DOMAIN).alias("domain"), F.lit("").alias("published"),
        "score", "tier", "ts")


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch attempts per feed."""
    e = table(spark, sf_dir, "events")
    k = _k(F.col("props")).cast("int")
    user = F.col("user_id").cast("string")
    return e.select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("rss:"), user).alias("feed_id"),
        F.concat(F.lit("https://feeds.example/"), user, F.lit("/"), F.col("event_type")).alias("feed_url"),
        (~F.col("event_type").isin("error", "view")).alias("ok"),
        (F.lit(500) + k % 5).cast("int").alias("status_code"),
        F.concat(F.lit("failed: "), F.col("event_type")).alias("error"),
        k.alias("item_count"))


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with real markup."""
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.col("page_id").alias("seq"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        "url", "html",
        F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("source"))


def doc_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of whole documents: the first line is the title."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("https://docs.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("summary"),
        F.col("source"), F.col("lang").alias("domain"), F.col("text"))


def labelled_doc_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document items with partly missing scores (unlabelled = absent from
    responses); labels only, no text."""
    q, t = F.col("quality"), F.col("toxic")
    label_score = (F.when((q == 1) & (t == 0), F.lit(4)).when(q == 1, F.lit(3))
                   .when(t == 0, F.lit(2)).when(t == 1, F.lit(1)))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq")).join(
        table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "seq"), "seq", "left").select(
        "seq", label_score.alias("label_score"), q.alias("quality"), t.alias("toxic"))
