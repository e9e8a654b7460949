"""RSS 2.0, Atom and arXiv payloads -> items.

Raw payloads are landed rows (``RAW_FETCH``: ``body`` plus sweep and feed
columns). One ``from_xml`` with an explicit schema parses each body inside
the scan stage; ``posexplode`` yields the entries with their position, so
arrival order is kept without any shuffle.

Limits of the built-in parser, stated once: nested markup inside a text
element comes back as inner XML (the original keeps only the text before the
first child), and of an ``item`` that holds another one only the fields before
that one are found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.text import collapse_ws, strip_html, truncate, ustrip

# Fixed value: the Atom namespace URI.
ATOM_NS = "http://www.w3.org/2005/Atom"

_TXT = "array<string>"
RSS_ITEM = f"struct<title:{_TXT},link:{_TXT},description:{_TXT},pubDate:{_TXT}>"
ATOM_ENTRY = (f"struct<title:{_TXT},link:array<struct<_href:string>>,summary:{_TXT},content:{_TXT},"
              f"published:{_TXT},updated:{_TXT},id:{_TXT}>")
# Repeated tags are arrays: the original takes the first occurrence, a
# scalar field would keep the last. The root tag name is not part of it.
FEED_SCHEMA = (f"_xmlns string, channel struct<item:array<{RSS_ITEM}>>, item array<{RSS_ITEM}>, "
               f"entry array<{ATOM_ENTRY}>, _corrupt_record string")

ITEM_TAG = r"<item[\s/>]"

# a prefixed Atom root: <P:feed ...> with P bound to the Atom namespace
_PREFIXED_ROOT = r"<([A-Za-z_][\w.\-]*):feed[\s>/]"


def _first(arr) -> Column:
    return F.element_at(arr, 1)


def parse_feed_xml(raw: DataFrame, body: str = "body") -> DataFrame:
    """Add ``_doc`` (parsed struct), ``_rss_ok`` and ``_atom_ok``.

    RSS items count only when the root has no default namespace (an RSS 1.0
    ``rdf:RDF`` document with a default namespace gives none, as in the
    original); an RSS 2.0 root that merely declares ``xmlns:atom`` for a
    self link still counts. Atom entries count when the root is in the Atom
    namespace, by default namespace or as ``<P:feed>`` with P bound to it
    (then P's tags are rewritten to plain ones).
    A malformed body parses to null: zero items, the fetch still succeeds.

    The schema finds items in the root and in its channel. Where a body has more
    ``item`` tags than that (deeper ones, or several channels), its items are cut
    out, put into one channel and parsed again as ``_deep``; bodies whose tags may
    be in a namespace of an inner element, or stand in character data, are not cut.
    """
    b = F.col(body)
    root_prefix = F.regexp_extract(b, _PREFIXED_ROOT, 1)
    declared = F.instr(b, F.concat(F.lit("xmlns:"), root_prefix, F.lit(f'="{ATOM_NS}"'))) > 0
    prefix = F.when((root_prefix != "") & declared, root_prefix).otherwise(F.lit(""))
    norm = F.when(prefix != "", F.regexp_replace(b, F.concat(F.lit("<(/?)"), prefix, F.lit(":")),
                                                 F.lit("<$1"))).otherwise(b)
    out = (raw.withColumn("_prefix", prefix)
           .withColumn("_doc", F.from_xml(norm, FEED_SCHEMA))
           .withColumn("_rss_ok", F.col("_doc._xmlns").isNull() & (F.col("_prefix") == ""))
           .withColumn("_atom_ok", (F.col("_doc._xmlns") == ATOM_NS) | (F.col("_prefix") != "")))
    found = sum((F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) for c in ("_doc.item", "_doc.channel.item")), F.lit(0))
    plain = F.regexp_replace(b, r"(?s)<!--.*?-->", "")
    deeper = (F.col("_doc").isNotNull() & F.col("_doc._corrupt_record").isNull() & F.col("_rss_ok") & (F.regexp_count(plain, F.lit(ITEM_TAG)) > found)
              & ~b.rlike(r"\sxmlns\s*=") & ~b.rlike(r"(?s)<!\[CDATA\[(?:(?!\]\]>).)*</?item[\s/>]"))
    pieces = F.slice(F.split(F.concat(F.lit(" "), plain), f"(?={ITEM_TAG})"), 2, 1 << 30)      # each from one item tag to the next
    whole = F.transform(pieces, lambda x: F.when(x.rlike(r"</item\s*>"), F.regexp_extract(x, r"(?s)^.*?</item\s*>", 0))
                        .when(x.rlike(r"^<item[^>]*/>"), F.lit("")).otherwise(F.concat(x, F.lit("</item>"))))
    one = F.concat(F.lit("<rss><channel>"), F.array_join(whole, ""), F.lit("</channel></rss>"))
    return out.withColumn("_deep", F.from_xml(F.when(deeper, one), FEED_SCHEMA))


def _first_nonblank(*cols) -> Column:
    out = F.lit("")
    for c in reversed(cols):
        v = ustrip(F.coalesce(c, F.lit("")))
        out = F.when(v != "", v).otherwise(out)
    return out


_ENTRY = "struct<part:int,title:string,url:string,summary:string,pub:string>"


def feed_items(raw: DataFrame, keep=("sweep_id", "fetch_seq", "feed_name", "domain"),
               kinds=("rss", "atom"), atom_compat: bool = False, date_compat: bool = False) -> DataFrame:
    """RSS items then Atom entries of each body, in document order (S1, S2,
    U1). Each body is parsed once; both kinds come out of one posexplode.

    RSS (``part`` 0): title, link, description, pubDate, each stripped.
    Atom (``part`` 1): title text, first link's href, summary (else
    content), published (else updated); ``atom_compat=True`` reproduces the
    original's element-truthiness quirk (a text-only summary loses to
    content, published always loses to updated). Untitled entries are
    skipped; summary = strip_html(text)[:400]; source = ``rss:<feed>``.
    """
    p = parse_feed_xml(raw)
    parts = []
    if "rss" in kinds:
        rss = F.coalesce("_deep.channel.item", F.concat(F.coalesce("_doc.channel.item", F.array().cast(f"array<{RSS_ITEM}>")),
                                                       F.coalesce("_doc.item", F.array().cast(f"array<{RSS_ITEM}>"))))
        parts.append(F.when(F.col("_rss_ok"), F.transform(rss, lambda x: F.struct(
            F.lit(0).alias("part"), _first(x["title"]).alias("title"), _first(x["link"]).alias("url"),
            _first(x["description"]).alias("summary"), _first(x["pubDate"]).alias("pub")))))
    if "atom" in kinds:
        def entry(e):
            if atom_compat:
                summ, pub = _first(e["content"]), _first(e["updated"])
            else:
                summ = _first_nonblank(_first(e["summary"]), _first(e["content"]))
                pub = _first_nonblank(_first(e["published"]), _first(e["updated"]))
            return F.struct(F.lit(1).alias("part"), _first(e["title"]).alias("title"),
                            _first(e["link"])["_href"].alias("url"), summ.alias("summary"), pub.alias("pub"))
        parts.append(F.when(F.col("_atom_ok"), F.transform(F.col("_doc.entry"), entry)))
    allp = F.concat(*[F.coalesce(x.cast(f"array<{_ENTRY}>"), F.array().cast(f"array<{_ENTRY}>"))
                      for x in parts])
    ex = p.select(*keep, F.posexplode(allp).alias("pos", "_e"))
    title = ustrip(F.coalesce(F.col("_e.title"), F.lit("")))
    return ex.select(
        *keep, F.col("_e.part").alias("part"), F.col("pos").cast("bigint").alias("pos"),
        title.alias("title"), ustrip(F.coalesce(F.col("_e.url"), F.lit(""))).alias("url"),
        truncate(strip_html(ustrip(F.coalesce(F.col("_e.summary"), F.lit("")))), 400).alias("summary"),
        F.concat(F.lit("rss:"), F.col("feed_name")).alias("source"),
        parse_date(ustrip(F.coalesce(F.col("_e.pub"), F.lit(""))), compat=date_compat).alias("published"),
    ).where(F.col("title") != "")


def rss_items(raw: DataFrame, keep=("sweep_id", "fetch_seq", "feed_name", "domain"),
              date_compat: bool = False) -> DataFrame:
    return feed_items(raw, keep, ("rss",), date_compat=date_compat)


def atom_items(raw: DataFrame, keep=("sweep_id", "fetch_seq", "feed_name", "domain"),
               atom_compat: bool = False, date_compat: bool = False) -> DataFrame:
    return feed_items(raw, keep, ("atom",), atom_compat=atom_compat, date_compat=date_compat)


def arxiv_items(raw: DataFrame, keep=("sweep_id", "fetch_seq", "domain")) -> DataFrame:
    """arXiv Atom entries (S3): title and summary white-space collapsed,
    summary[:500], url = ``id`` stripped, published[:10], source ``arxiv``.
    Entries without a title are skipped; missing fields read as empty."""
    p = parse_feed_xml(raw)
    ex = p.select(*keep, F.posexplode(F.when(F.col("_atom_ok"), F.col("_doc.entry"))).alias("pos", "_e"))
    t = _first("_e.title")
    return ex.where(t.isNotNull()).select(
        *keep, F.col("pos").cast("bigint").alias("pos"),
        collapse_ws(t).alias("title"),
        ustrip(F.coalesce(_first("_e.id"), F.lit(""))).alias("url"),
        truncate(collapse_ws(F.coalesce(_first("_e.summary"), F.lit(""))), 500).alias("summary"),
        F.lit("arxiv").alias("source"),
        F.substring(F.coalesce(_first("_e.published"), F.lit("")), 1, 10).alias("published"))


def fetch_log_rows(raw: DataFrame, count: bool = True) -> DataFrame:
    """One fetch-log row per RSS fetch (K2): success with the number of
    items parsed (a malformed body is a success with 0), or the failure's
    status code (0 for non-HTTP errors) and message. Without ``count`` no body
    is parsed and a success has no number yet; whoever parses the items adds
    it."""
    p = parse_feed_xml(raw) if count else raw

    def titled(arr) -> Column:
        return F.size(F.filter(F.coalesce(arr, F.array()),
                               lambda x: ustrip(F.coalesce(F.element_at(x["title"], 1), F.lit(""))) != ""))
    n = F.lit(None).cast("int") if not count else (
        F.coalesce(F.when(F.col("_rss_ok"), titled(F.col("_doc.channel.item")) + titled(F.col("_doc.item"))), F.lit(0))
        + F.coalesce(F.when(F.col("_atom_ok"), titled(F.col("_doc.entry"))), F.lit(0)))
    ok = F.col("error").isNull()
    sweep = [F.col("sweep_id")] if "sweep_id" in raw.columns else []
    return p.select(
        *sweep, F.concat(F.lit("rss:"), F.col("feed_name")).alias("feed_id"), F.col("feed_url"),
        F.col("sweep_ts").alias("ts"), F.col("fetch_seq").alias("seq"), ok.alias("ok"),
        F.when(ok, F.lit(None)).otherwise(F.coalesce("status_code", F.lit(0))).cast("int").alias("status_code"),
        F.col("error"), F.when(ok, n).otherwise(F.lit(0)).cast("int").alias("item_count"))
