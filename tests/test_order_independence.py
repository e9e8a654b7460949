"""Shuffled and repartitioned inputs give the same results."""

from pyspark.sql import functions as F

from siftline.config import FIXTURE_CONFIG as CFG
from siftline.operators import curate as cur
from siftline.operators import folds as fl
from siftline.operators import validate as val
from siftline.plans import fixtures as fx

from fixture_paths import SMOKE


def _variants(df):
    return [df, df.repartition(7), df.orderBy(F.rand(3)).repartition(3, "seq"), df.coalesce(1)]


def test_curation_and_report_ignore_input_order(spark):
    rows = fx.feed_item_rows(spark, SMOKE)
    outs, reps = [], []
    for v in _variants(rows):
        outs.append(sorted((r.sweep_id, r.seq) for r in
                           cur.curate(v, CFG.skip_domains, CFG.skip_patterns, 48).collect()))
        reps.append(sorted(tuple(r) for r in val.report_from_items(v).collect()))
    assert all(o == outs[0] for o in outs) and outs[0]
    assert all(r == reps[0] for r in reps)


def test_feed_health_ignores_input_order(spark):
    log = fx.fetch_log(spark, SMOKE)
    outs = [sorted(tuple(r) for r in fl.feed_health_view(fl.feed_health_delta(v)).collect())
            for v in _variants(log)]
    assert all(o == outs[0] for o in outs)
