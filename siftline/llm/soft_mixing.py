"""Operator 9: mixing a corpus to target domain weights by soft membership.

A classifier learned from the table of labels gives each document a posterior
over the domains ``high`` (quality 1), ``low`` (quality 0) and ``toxic`` (toxic
1, whatever the quality). Documents get nonnegative rates such that the
expected tokens of each domain, sum of rate * tokens * posterior, match the
target shares of the corpus's tokens. The rates minimise

    1/2 sum over domains of (total - target)^2 / share
        + ridge/2 * sum over documents of token share * (rate - 1)^2

(share: the domain's expected share at rate 1) over rates >= 0 by projected
gradient: each round is one aggregation over the documents to three sums, and
each document then moves by its own posterior alone. The ridge keeps rates near
1 where the targets leave a choice.

The classifier is naive Bayes over the distinct words of a document, hashed to
``buckets``; marks are words apart from letters and digits. It is fitted on
half of at most ``labelled_rows`` labelled documents (those with the least hash
of their id). Words that ``low`` or ``toxic`` documents have clearly more often
than others tell a domain; they count where they are and where they are not,
and a document without them is most likely ``high``. How far the words' sum is
trusted (a factor between 0 and 1) is chosen by the likelihood of the other
half, so posteriors stay soft.

All of it is DataFrame operations. Broadcast are the sampled ids (at most
``labelled_rows``) and the weights (at most ``buckets`` rows). To the driver go
class counts, the likelihoods of the factors, and three sums a round.

Defined cases: a null or empty text has no tokens, and its posterior is the
prior. Null labels count as 0. Of repeated labels of an id, the least quality
and the greatest toxicity count; labels without an id or document do not.
Without labels the posterior is 1/3 each. Rows of equal id and text get one
rate; a null id is an id like others. Without any token all rates are 1. An
empty table gives an empty result; extra columns are not read by ``mix_rates``
and are kept by ``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as cm

DOMAINS = ("high", "low", "toxic")
SMOOTH = 10.0          # average documents a domain's word counts start with
SIGNIFICANT = 5.0      # standard deviations above the average that make a word tell a domain
FACTORS = (1.0, 0.5, 0.25, 0.1, 0.05, 0.02, 0.01)


def features(docs: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, h, n_tokens, bucket): the distinct words of each row, and a row
    of bucket -1 for the row itself. A token is a run of letters and digits or
    a run of marks, within white space."""
    text = F.lower(F.coalesce(F.col("text"), F.lit("")))
    clean = F.trim(F.regexp_replace(text, r"([^\p{L}\p{N}\s]+)", " $1 "), F.lit(" \t\n\x0b\f\r"))
    words = F.split(clean, r"\s+")         # used twice, evaluated once
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("h"),
                       F.when(clean == "", F.lit(0)).otherwise(F.size(words)).cast("bigint").alias("n_tokens"),
                       F.array_distinct(words).alias("words"))
    rows = rows.withColumn("word", F.explode(F.when(F.col("n_tokens") == 0, F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), "words"))))
    return rows.select("doc_id", "h", "n_tokens", F.when(F.col("word") == "", -1).otherwise(
        F.pmod(F.xxhash64("word"), F.lit(buckets))).cast("int").alias("bucket"))


def _labelled(labels: DataFrame, labelled_rows: int) -> DataFrame:
    """(doc_id, domain, fold) of the sampled labelled documents."""
    one = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
           .agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")))
    domain = F.when(F.col("t") > 0, "toxic").when(F.col("q") > 0, "high").otherwise("low")
    return (one.select("doc_id", domain.alias("domain"), (F.crc32(F.col("doc_id").cast("string")) % 2).alias("fold"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows))


def _sums(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """A row for each (doc_id, h): its tokens and each domain's sum of word
    weights; rows that are repeated count once."""
    joined = rows.join(F.broadcast(weights), "bucket", "left")          # at most ``buckets`` rows
    sums = [F.coalesce(F.sum(f"w_{d}"), F.lit(0.0)).alias(f"s_{d}") for d in DOMAINS]
    out = joined.groupBy("doc_id", "h").agg(F.max("n_tokens").alias("n_tokens"),
                                            F.sum((F.col("bucket") == -1).cast("long")).alias("k"), *sums)
    # k rows of the table have this id and text
    return out.withColumns({f"s_{d}": F.col(f"s_{d}") / F.col("k") for d in DOMAINS})


def _posterior(factor: float, prior: dict[str, float]) -> dict[str, Column]:
    score = {d: F.lit(math.log(prior[d])) + F.lit(factor) * F.col(f"s_{d}") for d in DOMAINS}
    top = F.greatest(*score.values())
    e = {d: F.exp(s - top) for d, s in score.items()}
    total = sum(list(e.values())[1:], list(e.values())[0])
    return {d: x / total for d, x in e.items()}


def posteriors(docs: DataFrame, labels: DataFrame, buckets: int = 1 << 14, labelled_rows: int = 20_000) -> DataFrame:
    """(doc_id, h, n_tokens, p_high, p_low, p_toxic) for each distinct row of
    ``docs`` (doc_id, text)."""
    ids = cm.staged(_labelled(labels, labelled_rows), "mix-labels")
    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    seen = cm.staged(features(picked, buckets).join(F.broadcast(ids), "doc_id").distinct(), "mix-features")

    fold = seen.where("fold = 0")
    n = {r.domain: r.n for r in fold.where("bucket = -1").groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(n.values())
    prior = {d: (n.get(d, 0) + 1) / (total + len(DOMAINS)) for d in DOMAINS}
    counts = [F.sum((F.col("domain") == d).cast("long")).alias(f"c_{d}") for d in DOMAINS]
    weights = fold.where("bucket >= 0").groupBy("bucket").agg(*counts)
    every = sum([F.col(f"c_{d}") for d in DOMAINS[1:]], F.col(f"c_{DOMAINS[0]}"))
    # a word's share of a domain's documents against its share of all; a domain starts with ``SMOOTH`` average documents
    share = (every + 0.5) / F.lit(total + 1.0)
    in_domain = {d: (F.col(f"c_{d}") + F.lit(SMOOTH) * share) / F.lit(n.get(d, 0) + SMOOTH) for d in DOMAINS}
    tells = [F.col(f"c_{d}") - F.lit(float(n.get(d, 0))) * share
             >= F.lit(SIGNIFICANT) * F.sqrt(F.lit(float(n.get(d, 0))) * share * (1 - share) + 1.0) for d in DOMAINS[1:]]
    with_word = {d: F.log(x / share) for d, x in in_domain.items()}
    without = {d: F.log((1 - x) / (1 - share)) for d, x in in_domain.items()}
    told = weights.where(tells[0] | tells[1]).select(
        "bucket", *[(with_word[d] - without[d]).alias(f"w_{d}") for d in DOMAINS], *[without[d].alias(f"o_{d}") for d in DOMAINS])
    # a row without any of the words has the sum of what their absence says; each word in it then makes up the difference
    none = told.agg(*[F.coalesce(F.sum(f"o_{d}"), F.lit(0.0)).alias(f"w_{d}") for d in DOMAINS])
    weights = cm.staged(told.select("bucket", *[f"w_{d}" for d in DOMAINS]).unionByName(
        none.select(F.lit(-1).alias("bucket"), *[f"w_{d}" for d in DOMAINS])), "mix-weights")

    other = seen.where("fold = 1")
    held = _sums(other, weights).join(other.where("bucket = -1").select("doc_id", "domain").distinct(), "doc_id")
    likely = []
    for f in FACTORS:
        p = _posterior(f, prior)
        own = p[DOMAINS[0]]
        for d in DOMAINS[1:]:
            own = F.when(F.col("domain") == d, p[d]).otherwise(own)
        likely.append(F.sum(F.log(F.greatest(own, F.lit(1e-12)))))
    fit = held.agg(*[x.alias(f"f{k}") for k, x in enumerate(likely)]).first()
    factor = max(zip([x if x is not None else 0.0 for x in fit], FACTORS))[1]

    p = _posterior(factor, prior)
    return _sums(features(docs, buckets), weights).select(
        "doc_id", "h", "n_tokens", *[p[d].alias(f"p_{d}") for d in DOMAINS])


def fit_rates(members: DataFrame, targets: dict[str, float], ridge: float = 1e-3, tolerance: float = 1e-4,
              rounds: int = 100, stage_every: int = 10, trace: list | None = None) -> DataFrame:
    """``members`` (n_tokens, p_*; and others) with the column ``rate``. Each
    round's domain totals, as shares of all tokens, are added to ``trace``."""
    p = [F.col(f"p_{d}") for d in DOMAINS]
    share = F.col("n_tokens")
    first = members.agg(F.sum(share).alias("n"), *[F.sum(share * x).alias(f"t{k}") for k, x in enumerate(p)]).first()
    rows = members.withColumn("rate", F.lit(1.0))
    if not first or not first["n"]:
        return rows
    tokens = float(first["n"])
    want = [targets[d] / sum(targets.values()) for d in DOMAINS]
    have = [max(float(first[f"t{k}"]) / tokens, 1e-9) for k in range(len(p))]
    # divided by the shares, the matrix of the posteriors' products has row sums of 1, so no eigenvalue is larger
    step = 1.0 / (1.0 + ridge)
    sums = [F.sum(share * F.col("rate") * x).alias(f"t{k}") for k, x in enumerate(p)]
    for k in range(1, rounds + 1):
        got = rows.agg(*sums).first()
        off = [float(got[i]) / tokens - w for i, w in enumerate(want)]
        if trace is not None:
            trace.append([o + w for o, w in zip(off, want)])
        if max(map(abs, off)) < tolerance:
            break
        pull = [F.lit(step * o / h) * x for o, h, x in zip(off, have, p)]
        pull = sum(pull[1:], pull[0])
        rows = rows.withColumn("rate", F.greatest(
            F.lit(0.0), F.col("rate") * (1 - step * ridge) + F.lit(step * ridge) - pull))
        if k % stage_every == 0:
            rows = cm.staged(rows, "mix-rates")
    return rows


#: shares of the corpus's tokens; where soft posteriors cannot reach them, rates give the nearest totals
TARGETS = {"high": 0.77, "low": 0.18, "toxic": 0.05}


def mix_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS,
              trace: list | None = None) -> DataFrame:
    """doc_id, h (hash of the text), n_tokens, p_high, p_low, p_toxic, rate and
    copies, the whole number of copies a document gets: its rate, rounded up or
    down by a hash of its id so that the rates hold on average."""
    members = cm.staged(posteriors(docs, labels), "mix-posteriors")
    rows = fit_rates(members, targets, trace=trace)
    chance = F.pmod(F.xxhash64("doc_id", "h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    whole = F.floor("rate")
    return rows.withColumn("copies", (whole + (chance < F.col("rate") - whole).cast("int")).cast("int"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """``docs`` with each document as often as its copies say."""
    rates = mix_rates(docs, labels, targets).select(F.col("doc_id").alias("_mix_id"), F.col("h").alias("_mix_h"),
                                                    F.col("copies").alias("_mix_copies")).where("_mix_copies > 0")
    joined = docs.withColumn("_mix_text", F.xxhash64("text")).join(
        rates, F.col("doc_id").cast("bigint").eqNullSafe(F.col("_mix_id")) & (F.col("_mix_text") == F.col("_mix_h")))
    return (joined.withColumn("_mix_n", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
            .select(*[docs[c] for c in docs.columns]))
