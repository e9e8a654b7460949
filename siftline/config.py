"""Curation settings.

The settings live on the driver as a frozen dataclass; operators turn the
parts they need into literals (patterns, budgets) or into small config
tables (domains, feeds, search terms) that are joined by broadcast. The
config tables are bounded by what a person writes into a config file, not
by data volume.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

# Fixed values that must equal the reference's defaults.
DEFAULT_DOMAIN = "ai_research"
DEFAULT_MIN_SCORE = 3
DEFAULT_BATCH_SIZE = 40
DEFAULT_WINDOW_HOURS = 48
DEFAULT_MIN_POINTS = 50
DEFAULT_TOP_N = 100
TOP_STORY_CAP = 50
HN_HITS_PER_QUERY = 10
SERP_RESULTS_PER_QUERY = 5         # asked for by a fetcher; all results of a response are read
ARXIV_MAX_RESULTS = 50
ARXIV_MAX_KEYWORDS = 10
PROMPT_KEYWORDS_PER_DOMAIN = 5
SICK_FEED_THRESHOLD = 3
QUALITY_FOOTER_MIN_SCORED = 5
TIERS = ("RED", "ORANGE", "YELLOW")
# Registry order of the source types: it decides which copy of an item wins.
SOURCE_ORDER = ("arxiv", "hackernews", "rss", "serp")
ARXIV_CATEGORIES = ("cs.AI", "cs.CL", "cs.CV", "cs.LG")
SWEEP_LABELS = {"full": "Morning", "light": "Midday/Evening"}


# This package's own wording for a scorer; both are settings.
SCORE_SCALE = ((5, "RED", "needs action soon"), (4, "ORANGE", "worth a full read"), (3, "YELLOW", "good background"),
               (2, "", "mostly beside the point"), (1, "", "of no use"))
REPLY_NOTES = ('Answer with JSON only, an array of objects with the fields "idx", "score", "tier" and "why".',
               "High scores are rare.")


@dataclass(frozen=True)
class SourceConfig:
    name: str
    enabled: bool = True
    sweep: str | None = None          # "full" = only on full sweeps
    domain: str | None = None


@dataclass(frozen=True)
class DomainConfig:
    name: str
    weight: float = 1.0
    keywords: tuple[str, ...] = ()
    arxiv_categories: tuple[str, ...] = ()


@dataclass(frozen=True)
class ArxivConfig:
    keywords: tuple[str, ...] = ()
    categories: tuple[str, ...] = ARXIV_CATEGORIES
    max_results: int = ARXIV_MAX_RESULTS
    domain: str = DEFAULT_DOMAIN


@dataclass(frozen=True)
class CurationConfig:
    skip_domains: tuple[str, ...] = ()
    skip_patterns: tuple[str, ...] = ()
    dedup_window_hours: int = DEFAULT_WINDOW_HOURS
    min_score: int = DEFAULT_MIN_SCORE
    batch_size: int = DEFAULT_BATCH_SIZE
    model: str = ""                     # passed to the injected scorer (X3)
    tier_budgets: tuple[tuple[str, int], ...] = (("RED", 3), ("ORANGE", 8), ("YELLOW", 15))
    keywords: tuple[str, ...] = ()
    min_points: int = DEFAULT_MIN_POINTS
    top_n: int = DEFAULT_TOP_N
    default_domain: str = DEFAULT_DOMAIN
    sources: tuple[SourceConfig, ...] = ()
    # (source type, feed name or query, domain): per-feed / per-term domains
    source_keys: tuple[tuple[str, str, str | None], ...] = ()
    description: str = "a researcher"
    projects: tuple[str, ...] = ()
    noise_notes: tuple[str, ...] = ()
    orient_prompt: str = ""
    domains: tuple[DomainConfig, ...] = ()
    arxiv: ArxivConfig = ArxivConfig()
    digest_dir: str = ""                # unset: beside the logs
    # what a scorer is told: the meaning of each score, and how to answer
    score_scale: tuple[tuple[int, str, str], ...] = SCORE_SCALE
    reply_notes: tuple[str, ...] = REPLY_NOTES

    def __post_init__(self):
        for tier, budget in self.tier_budgets:
            if budget < 0:
                raise ValueError(f"negative budget for tier {tier}")
        if self.batch_size <= 0:
            raise ValueError("batch_size must be positive")

    @property
    def budgets(self) -> dict[str, int]:
        return dict(self.tier_budgets)

    def enabled_sources(self) -> list[SourceConfig]:
        return [s for s in self.sources if s.enabled]


def arxiv_request(cfg: CurationConfig, sweep_type: str) -> dict[str, Any]:
    """What a fetcher asks the paper listing for: the search expression and
    the number of results. Without own keywords those of the source's domain
    are used (and its categories, if the source has none); a light sweep asks
    for half."""
    ax = cfg.arxiv
    own = next((d for d in cfg.domains if d.name == ax.domain), DomainConfig(ax.domain))
    words = ax.keywords or own.keywords
    cats = ax.categories or (() if ax.keywords else own.arxiv_categories)
    search = " AND ".join(f"({' OR '.join(part)})" for part in (
        [f'all:"{w}"' for w in words[:ARXIV_MAX_KEYWORDS]], [f"cat:{c}" for c in cats]))
    return {"search_query": search, "max_results": ax.max_results // (2 if sweep_type == "light" else 1)}


REQUIRED_SECTIONS = ("profile", "sources", "domains")


def from_mapping(cfg: dict[str, Any]) -> CurationConfig:
    """Build settings from a parsed YAML mapping (same layout as the
    reference's config file)."""
    missing = [k for k in REQUIRED_SECTIONS if k not in cfg]
    if missing:
        raise ValueError("config missing required sections: " + ", ".join(missing))
    nf = cfg.get("noise_filters") or {}
    sc = cfg.get("scoring") or {}
    prof = cfg.get("profile") or {}
    srcs = cfg.get("sources") or {}
    domains = cfg.get("domains") or {}
    kws: list[str] = []
    for d in domains.values():
        kws.extend((d or {}).get("keywords", []) or [])
    sources = tuple(
        SourceConfig(name=name, enabled=(srcs.get(name) or {}).get("enabled", True),
                     sweep=(srcs.get(name) or {}).get("sweep"),
                     domain=(srcs.get(name) or {}).get("domain"))
        for name in dict.fromkeys((*SOURCE_ORDER, *srcs)))      # a source that is not named is enabled
    ax = srcs.get("arxiv") or {}
    hn = srcs.get("hackernews") or {}
    keys = ([("rss", f.get("name", ""), f.get("domain")) for f in (srcs.get("rss") or {}).get("feeds", []) or []]
            + [("hackernews", t.get("query", ""), t.get("domain")) for t in hn.get("search_terms", []) or []]
            + [("serp", q.get("query", ""), q.get("domain"))
               for q in (srcs.get("serp") or {}).get("queries", []) or []])
    return CurationConfig(
        skip_domains=tuple(nf.get("skip_domains", []) or []),
        skip_patterns=tuple(nf.get("skip_patterns", []) or []),
        dedup_window_hours=int(nf.get("dedup_window_hours", DEFAULT_WINDOW_HOURS)),
        min_score=int(sc.get("min_score", DEFAULT_MIN_SCORE)),
        batch_size=int(sc.get("batch_size", DEFAULT_BATCH_SIZE)),
        model=str(sc.get("model", "") or ""),
        tier_budgets=tuple((sc.get("tier_budgets") or {}).items()),
        keywords=tuple(kws),
        min_points=int(hn.get("min_points", DEFAULT_MIN_POINTS)),
        top_n=int(hn.get("top_n", DEFAULT_TOP_N)),
        sources=sources,
        source_keys=tuple({(t, k): (t, k, d) for t, k, d in reversed(keys)}.values())[::-1],    # the first of a name
        domains=tuple(DomainConfig(str(n), float((d or {}).get("weight", 1.0)), tuple((d or {}).get("keywords", []) or []),
                                   tuple((d or {}).get("arxiv_categories", []) or [])) for n, d in domains.items()),
        arxiv=ArxivConfig(tuple(ax.get("keywords", []) or []), tuple(ax.get("categories", ARXIV_CATEGORIES) or []),
                          int(ax.get("max_results", ARXIV_MAX_RESULTS)), ax.get("domain", DEFAULT_DOMAIN)),
        digest_dir=str((cfg.get("output") or {}).get("digest_dir") or ""),
        description=prof.get("description", "a researcher"),
        projects=tuple(prof.get("projects", []) or []),
        noise_notes=tuple(prof.get("noise_patterns", []) or []),
        orient_prompt=cfg.get("orient_prompt", "") or "",
    )


def load_yaml(path: str) -> CurationConfig:
    try:
        import yaml  # optional dependency
    except ImportError as e:  # pragma: no cover - depends on the image
        raise RuntimeError("pyyaml is not installed; build CurationConfig directly") from e
    with open(path) as f:
        return from_mapping(yaml.safe_load(f) or {})


# Settings used by the query catalogue on the driver's tables.
FIXTURE_CONFIG = CurationConfig(
    skip_domains=("SPAM-farm", "cheap-pills"),
    skip_patterns=("LICENSE", "tion.*sch", "[unclosed"),
    dedup_window_hours=48,
    min_score=3,
    batch_size=40,
    tier_budgets=(("RED", 3), ("ORANGE", 8), ("YELLOW", 15)),
    keywords=("that it", "License", "nicht"),
    sources=(SourceConfig("click"), SourceConfig("error"), SourceConfig("purchase"),
             SourceConfig("signup"), SourceConfig("view"), SourceConfig("rss")),
    description="an analyst of retail event streams",
    projects=("Tracking signups", "Cleaning error feeds"),
    noise_notes=("Duplicate clickstreams",),
)
