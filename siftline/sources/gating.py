"""Which sources run in a sweep (S8, P13, J7) and the source registry.

Gating rules, per source type and sweep type:
* ``enabled: false`` -> skipped, no warning;
* light sweep and ``sweep: full`` on the web-search source -> skipped, no
  warning (only that source honours the flag);
* web search on a light sweep with ``sweep`` unset -> called, returns
  nothing (so its validation warns "returned 0 items");
* otherwise fetched, also if the config does not name the source. The domain
  defaults to the configured default. A source type that neither the config
  nor the registry knows is ``unknown``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_DOMAIN, CurationConfig, SourceConfig

SEARCH_SOURCE = "serp"


def by_name(values: Mapping[str, object], name: Column, kind: str) -> Column:
    """The value of a row's ``name``, as a chain of literals: config is small,
    so a row needs no join to read it. Null where the name has none."""
    out = F.lit(None).cast(kind)
    for k, v in values.items():
        out = F.when(name == k, F.lit(v).cast(kind)).otherwise(out)
    return out


def gate(fetches: DataFrame, sources: Sequence[SourceConfig], default_domain: str = DEFAULT_DOMAIN) -> DataFrame:
    """Add ``action`` (fetch / skipped / disabled / empty / unknown) and the
    resolved ``domain`` to rows with ``source_type`` and ``sweep_type``. A
    projection: payloads are neither joined nor moved."""
    name, light = F.col("source_type"), F.col("sweep_type") == "light"
    serp = name == SEARCH_SOURCE
    sweep = by_name({s.name: s.sweep for s in sources}, name, "string")
    action = (F.when(~name.isin(*{*REGISTRY, *(s.name for s in sources)}), F.lit("unknown"))
              .when(~by_name({s.name: bool(s.enabled) for s in sources if not s.enabled}, name, "boolean").isNull(), F.lit("disabled"))
              .when(light & (sweep == "full") & serp, F.lit("skipped"))
              .when(light & serp & sweep.isNull(), F.lit("empty"))
              .otherwise(F.lit("fetch")))
    own = [F.col("domain")] if "domain" in fetches.columns else []
    domain = F.coalesce(*own, by_name({s.name: s.domain for s in sources}, name, "string"), F.lit(default_domain))
    return fetches.withColumn("action", action).withColumn("domain", domain)


def key_domain(keys: Sequence[tuple[str, str, str]], name: Column, key: Column) -> Column:
    """The configured domain of a feed or search term (source type, key,
    domain; the first of a key counts), looked up in one map literal."""
    table = {f"{t}\x1f{k}": d for t, k, d in reversed(keys)}
    if not table:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x).cast("string") for kv in table.items() for x in kv]), F.concat_ws("\x1f", name, key))


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a relation whose size the planner knows, so
    that it joins by broadcast only if they are few."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    return spark.createDataFrame(pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kinds)],
                                                      schema=kinds))


def called_sweeps(sweeps: DataFrame, source: str, sources: Sequence[SourceConfig]) -> DataFrame:
    """The sweeps (with ``sweep_type``) in which one source is fetched: the
    rules of ``gate`` for one name, as a filter."""
    cfg = next((s for s in sources if s.name == source), SourceConfig(source))
    if not cfg.enabled:
        return sweeps.where(F.lit(False))
    if source == SEARCH_SOURCE and cfg.sweep in (None, "full"):
        return sweeps.where(F.col("sweep_type") != "light")
    return sweeps


# ------------------------------------------------------------ source plug-ins

@dataclass(frozen=True)
class Landed:
    """What a parser gets: its source's live payload rows (RAW_FETCH with the
    resolved domain), the settings, the sweeps (sweep_id, sweep_ts,
    sweep_type) in which the source is called, and, for the top list, its
    ranked ids and story bodies where there are any."""
    rows: DataFrame
    cfg: CurationConfig
    sweeps: DataFrame
    hn_top: DataFrame | None = None
    hn_stories: DataFrame | None = None


#: name -> parser of landed rows to item rows: sweep_id, fetch_seq, part, pos,
#: title, url, summary, source, domain, published. The order is the registry's.
Parser = Callable[[Landed], DataFrame]
REGISTRY: dict[str, Parser] = {}
ITEM = ("sweep_id", "fetch_seq", "part", "pos", "title", "url", "summary", "source", "domain", "published")


def register(name: str, parser: Parser) -> None:
    """Add a source type, or replace its parser. New ones come last."""
    REGISTRY[name] = parser


def _arxiv(x: Landed) -> DataFrame:
    from .xml_feeds import arxiv_items
    return arxiv_items(x.rows, ("sweep_id", "fetch_seq", "domain")).withColumn("part", F.lit(0))


def _rss(x: Landed) -> DataFrame:
    from .xml_feeds import feed_items
    return feed_items(x.rows, ("sweep_id", "fetch_seq", "feed_name", "domain"))


def _hackernews(x: Landed) -> DataFrame:
    from . import json_feeds as jf
    full = x.rows.where(F.col("sweep_type") == "full").withColumnRenamed("fetch_seq", "query_seq")
    hits = jf.hn_search_hits(full)
    if x.hn_top is None or x.hn_stories is None:
        return (jf.hn_search_items(hits, x.cfg.min_points).withColumnRenamed("query_seq", "fetch_seq")
                .withColumn("part", F.lit(0)))
    top = x.hn_top.select("sweep_id", "rank", "id").join(x.sweeps.select("sweep_id", "sweep_type"), "sweep_id")
    cands = jf.hn_top_stories(top, x.hn_stories, x.cfg.top_n)
    items = jf.hn_items(hits, cands, x.cfg.keywords, x.cfg.min_points)
    last = F.lit((1 << 32) - 1)      # stories come after all queries
    return items.withColumn("fetch_seq", F.when(F.col("kind") == "top", last).otherwise(F.col("query_seq"))) \
        .withColumn("part", F.lit(0))


def _serp(x: Landed) -> DataFrame:
    from . import json_feeds as jf
    found = jf.serp_results(x.rows.withColumnRenamed("fetch_seq", "query_seq"))
    return (jf.serp_items(found, x.cfg.skip_domains).withColumnRenamed("query_seq", "fetch_seq")
            .withColumn("part", F.lit(0)))


for _name, _parser in (("arxiv", _arxiv), ("hackernews", _hackernews), ("rss", _rss), ("serp", _serp)):
    register(_name, _parser)
