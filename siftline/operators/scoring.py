"""Batch scoring as a table job.

items -> numbered batches -> one prompt row per batch -> scorer (the only
Python step, ``mapInPandas`` over prompt rows) -> response rows -> parsed
scores -> left join back to the items with the fallbacks.

The scorer is injected: a function from an iterator of pandas frames
(``sweep_id, batch, n_items, prompt``) to an iterator of frames
(``sweep_id, batch, response``). Responses are non-deterministic in real
use, so a pipeline writes them once to the score log and reads them back
instead of letting a lazy plan call the model again.
"""

from __future__ import annotations

from typing import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PROMPT_KEYWORDS_PER_DOMAIN, REPLY_NOTES, SCORE_SCALE, CurationConfig
from .ordering import positions

# Fixed fallback values (score, tier, reason) that must equal the original's.
NO_KEY = (3, "YELLOW", "unscored -- no API key")
FAILED = (2, "YELLOW", "scoring failed")
MISSING = (2, "YELLOW", "unscored")
DEFAULT_TIER = "YELLOW"

SCORE_SCHEMA = "array<struct<idx:int,score:int,tier:string,why:string>>"
RESPONSE_SCHEMA = "sweep_id bigint, batch bigint, response string, prompt_hash string, error string"
ATTEMPTS = 3        # of one run for one prompt, fixed by the original


def number_batches(items: DataFrame, batch_size: int, group: Sequence[str] = ("sweep_id",),
                   order: Sequence[str] = ("seq",)) -> DataFrame:
    """Consecutive groups of ``batch_size`` in arrival order (W4): adds
    ``batch`` and ``idx`` (restarting at 0 in each batch). Positions come
    from blocks of the order value, so one huge sweep is not one task."""
    rn = positions(items, list(group), list(order), "_rn")
    return (rn.withColumn("batch", F.floor(F.col("_rn") / batch_size).cast("bigint"))
            .withColumn("idx", (F.col("_rn") % batch_size).cast("bigint")).drop("_rn"))


def item_line(idx="idx", domain="domain", title="title", summary="summary") -> Column:
    """``idx. [domain] title | summary[:200]``."""
    return F.concat(F.col(idx).cast("string"), F.lit(". ["), F.coalesce(F.col(domain), F.lit("")),
                    F.lit("] "), F.coalesce(F.col(title), F.lit("")), F.lit(" | "),
                    F.substring(F.coalesce(F.col(summary), F.lit("")), 1, 200))


def batch_prompts(batched: DataFrame, group: Sequence[str] = ("sweep_id",)) -> DataFrame:
    """One prompt per batch (M2): item lines joined by newlines in idx
    order. A batch holds at most ``batch_size`` lines, so the collected
    list is bounded."""
    lines = F.array_sort(F.collect_list(F.struct(F.col("idx"), item_line().alias("line"))))
    return batched.groupBy(*group, "batch").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("prompt"))


def extract_json_array(text: Column) -> Column:
    """From the first ``[{"`` (else the first ``[``) through the last ``]``;
    empty string when there is none."""
    obj = F.regexp_extract(text, r'(?s)(\[\{".*\])', 1)
    any_ = F.regexp_extract(text, r"(?s)(\[.*\])", 1)
    return F.when(F.instr(text, '[{"') > 0, obj).otherwise(any_)


def parse_responses(responses: DataFrame, group: Sequence[str] = ("sweep_id",)) -> tuple[DataFrame, DataFrame]:
    """Response rows -> (batch status, parsed elements) (M3): status rows
    ``(group, batch, ok)`` and element rows ``(group, batch, idx, score,
    tier, why)``.

    ``ok`` is false for the whole batch when no JSON array is found, it
    does not parse, or an element lacks ``idx``. Repeated idx: the last
    element wins. An empty array is a success with no scores.
    """
    js = extract_json_array(F.coalesce(F.col("response"), F.lit("")))
    parsed = responses.select(*group, "batch", F.from_json(F.nullif(js, F.lit("")), SCORE_SCHEMA).alias("_a"))
    status = parsed.select(*group, "batch",
                           (F.col("_a").isNotNull()
                            & F.coalesce(F.forall("_a", lambda x: x["idx"].isNotNull()), F.lit(True))
                            ).alias("ok"))
    elems = (parsed.select(*group, "batch", F.posexplode("_a").alias("_pos", "_e"))
             .where(F.col("_e.idx").isNotNull())
             .groupBy(*group, "batch", F.col("_e.idx").cast("bigint").alias("idx"))
             .agg(F.max_by("_e", "_pos").alias("_e"))
             .select(*group, "batch", "idx", F.col("_e.score").cast("bigint").alias("score"),
                     F.col("_e.tier").alias("tier"), F.col("_e.why").alias("why")))
    return status, elems


def apply_scores(batched: DataFrame, responses: DataFrame | None,
                 group: Sequence[str] = ("sweep_id",)) -> DataFrame:
    """Scores for every batched item (M4, M5, J2): left join on
    (batch, idx); absent -> (2, YELLOW, unscored); present without tier or
    why -> YELLOW / ''; failed batch -> (2, YELLOW, scoring failed); no
    scorer at all (``responses is None``) -> (3, YELLOW, unscored -- no API
    key). A winning element without a score fails its batch."""
    if responses is None:
        return batched.withColumn("score", F.lit(NO_KEY[0]).cast("bigint")) \
            .withColumn("tier", F.lit(NO_KEY[1])).withColumn("reason", F.lit(NO_KEY[2]))
    keys = [*group, "batch"]
    js = extract_json_array(F.coalesce(F.col("response"), F.lit("")))
    answers = responses.select(*keys, F.from_json(F.nullif(js, F.lit("")), SCORE_SCHEMA).alias("_a"))
    j = batched.join(answers, keys, "left")
    # the last element of an idx; an answer has about as many elements as its batch has items
    hit = F.try_element_at(F.filter("_a", lambda x: x["idx"] == F.col("idx")), F.lit(-1))
    j = j.withColumn("_hit", hit)
    whole = F.col("_a").isNotNull() & F.coalesce(F.forall("_a", lambda x: x["idx"].isNotNull()), F.lit(True))
    scoreless = F.col("_hit").isNotNull() & F.col("_hit.score").isNull()
    ok = whole & ~F.max(scoreless).over(Window.partitionBy(*keys))      # a batch is a bounded group
    j = j.withColumn("_ok", ok)
    failed, present = ~F.coalesce(F.col("_ok"), F.lit(False)), F.col("_hit").isNotNull()
    return j.select(
        *[c for c in batched.columns],
        F.when(failed, F.lit(FAILED[0])).when(present, F.col("_hit.score")).otherwise(F.lit(MISSING[0]))
        .cast("bigint").alias("score"),
        F.when(failed, F.lit(FAILED[1])).when(present, F.coalesce("_hit.tier", F.lit(DEFAULT_TIER)))
        .otherwise(F.lit(MISSING[1])).alias("tier"),
        F.when(failed, F.lit(FAILED[2])).when(present, F.coalesce("_hit.why", F.lit("")))
        .otherwise(F.lit(MISSING[2])).alias("reason"))


Scorer = Callable[[Iterator[pd.DataFrame]], Iterable[pd.DataFrame]]


def usable_answer(response: Column, n_items: Column) -> Column:
    """Whether an attempt succeeded (M3): there is a JSON array, every element
    has an idx, and none that counts (the last of an idx that the batch has)
    lacks its score."""
    a = F.from_json(F.nullif(extract_json_array(F.coalesce(response, F.lit(""))), F.lit("")), SCORE_SCHEMA)
    last = F.transform(a, lambda x, i: F.struct(x["idx"].alias("idx"), i.alias("at")))
    scoreless = F.exists(F.transform(a, lambda x, i: x["score"].isNull() & (x["idx"] >= 0) & (x["idx"] < n_items)
                                     & ~F.exists(last, lambda y: (y["idx"] == x["idx"]) & (y["at"] > i))), lambda bad: bad)
    return a.isNotNull() & F.coalesce(F.forall(a, lambda x: x["idx"].isNotNull()), F.lit(True)) & ~F.coalesce(scoreless, F.lit(True))


def run_scorer(prompts: DataFrame, scorer: Scorer, system_prompt: str = "", model: str = "") -> DataFrame:
    """Call the injected scorer once on prompt rows (M6, X3): the only
    JVM<->Python step, Arrow-batched by ``mapInPandas``. A scorer takes the
    batches, and optionally the system prompt and the model name from the
    config. Materialise the result (score log) before reuse: a model is not
    deterministic.

    A failure stays its own: if the scorer raises on a frame, its rows are asked
    one at a time, and a row that raises alone gives a null response with the
    error. Answers for batches that were not asked are left out; a batch that is
    answered twice has two rows, one that is not answered has none."""
    n = _arity(scorer)
    extra = (system_prompt, model)[:max(0, min(n, 3) - 1)]

    def _ask(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = dict(zip(zip(pdf["sweep_id"], pdf["batch"]), pdf["prompt_hash"]))
        got = [r[["sweep_id", "batch", "response"]] for r in scorer(iter([pdf.drop(columns="prompt_hash")]), *extra)]
        out = pd.concat(got) if got else pd.DataFrame(columns=["sweep_id", "batch", "response"])
        out = out[[k in hashes for k in zip(out["sweep_id"], out["batch"])]].copy()
        out["prompt_hash"] = [hashes[k] for k in zip(out["sweep_id"], out["batch"])]
        out["error"] = None
        return out

    def _call(batches):
        for pdf in batches:
            try:
                out = _ask(pdf)
            except Exception:
                out = None
            if out is not None:
                yield out
                continue
            for k in range(len(pdf)):
                one = pdf.iloc[k:k + 1]
                try:
                    yield _ask(one)
                except Exception as e:
                    yield one[["sweep_id", "batch", "prompt_hash"]].assign(response=None, error=f"{type(e).__name__}: {e}")
    return prompts.select("sweep_id", "batch", "n_items", "prompt", prompt_hash(system_prompt, model).alias("prompt_hash")) \
        .mapInPandas(_call, RESPONSE_SCHEMA)


def prompt_hash(system_prompt: str = "", model: str = "") -> Column:
    """What was asked, of whom: answers are kept under this."""
    return F.sha2(F.concat_ws("\x1f", F.lit(model), F.lit(system_prompt), F.col("prompt")), 256)


def _arity(fn) -> int:
    import inspect
    try:
        return len(inspect.signature(fn).parameters)
    except (TypeError, ValueError):
        return 1


def keyword_scorer(keywords: Sequence[str], strong: Sequence[str] = ()) -> Scorer:
    """Deterministic stand-in for a model: per prompt line, score 4 when a
    strong keyword occurs, 3 for any keyword, else 1; answers with a JSON
    array after a line of prose, as models do."""
    kws = [k.lower() for k in keywords]
    strong_l = [k.lower() for k in strong]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json
        for pdf in batches:
            out = []
            for prompt in pdf["prompt"].fillna(""):
                rows = []
                for line in prompt.split("\n"):
                    head, _, rest = line.partition(". ")
                    if not head.isdigit():
                        continue
                    low = rest.lower()
                    s = 4 if any(k in low for k in strong_l) else 3 if any(k in low for k in kws) else 1
                    tier = {4: "ORANGE", 3: "YELLOW"}.get(s, "GREY")
                    rows.append({"idx": int(head), "score": s, "tier": tier, "why": "keyword match" if s > 1 else "no match"})
                out.append("Scores:\n" + json.dumps(rows))
            yield pd.DataFrame({"sweep_id": pdf["sweep_id"], "batch": pdf["batch"], "response": out})
    return score


def domain_line(per_domain: int = PROMPT_KEYWORDS_PER_DOMAIN) -> Column:
    """``  name (weight w): kw1, kw2`` with the first ``per_domain``
    keywords; weight 1.0 when unset (M1)."""
    return F.concat(F.lit("  "), F.col("domain"), F.lit(" (weight "),
                    F.coalesce(F.col("weight"), F.lit(1.0)).cast("string"), F.lit("): "),
                    F.array_join(F.slice(F.col("keywords"), 1, per_domain), ", "))


def prompt_parts(description: str, projects: Sequence[str], noise_notes: Sequence[str],
                 scale: Sequence[tuple[int, str, str]] = SCORE_SCALE,
                 reply: Sequence[str] = REPLY_NOTES) -> tuple[str, str]:
    """The text before and after the domain lines of a profile prompt (M1)."""
    head = [f"Reader: {description}", "Works on:", *[f"{i}. {p}" for i, p in enumerate(projects, 1)],
            "", "Scores:", *[f"{n}{f' {tier}' if tier else ''}: {meaning}" for n, tier, meaning in scale],
            "", "Domains:"]
    tail = ["", "Always 1:", *[f"- {n}" for n in noise_notes]] if noise_notes else []
    return "\n".join(head) + "\n", "\n" + "\n".join([*tail, "", *reply])


def config_prompt(cfg: CurationConfig) -> str:
    """The system prompt of a config (M1): what ``profile_prompt`` makes of a
    table of domains, for the few of one config."""
    head, tail = prompt_parts(cfg.description, cfg.projects, cfg.noise_notes, cfg.score_scale, cfg.reply_notes)
    return head + "\n".join(f"  {d.name} (weight {float(d.weight)}): {', '.join(d.keywords[:PROMPT_KEYWORDS_PER_DOMAIN])}"
                            for d in cfg.domains) + tail


def profile_prompt(domains: DataFrame, description: str, projects: Sequence[str],
                   noise_notes: Sequence[str], profile_cols: Sequence[str] = (),
                   scale: Sequence[tuple[int, str, str]] = SCORE_SCALE, reply: Sequence[str] = REPLY_NOTES) -> DataFrame:
    """System prompt per profile (M1): reader, numbered projects, score
    scale, domains with weights and keywords, noise notes when any, reply
    format. ``domains``: (``*profile_cols``, ord, domain, weight double,
    keywords array); one output row per profile. Domains per profile are
    config-sized, so the collected list is small."""
    head, tail = prompt_parts(description, projects, noise_notes, scale, reply)
    lines = domains.select(*profile_cols, "ord", domain_line().alias("line"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))),
                                    lambda x: x["line"]), "\n")
    return lines.groupBy(*profile_cols).agg(F.concat(F.lit(head), body, F.lit(tail)).alias("prompt"))
