"""Tier budgets and batch numbering edges."""

from pyspark.sql import functions as F

from siftline.operators import reports as rp
from siftline.operators import scoring as sc


def test_budgets(spark):
    rows = [(1, i, "RED" if i % 3 == 0 else "ORANGE" if i % 3 == 1 else "BLUE", 3 + i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "sweep_id long, seq long, tier string, score long")
    surf = rp.surfaced(df, 3, ("RED", "ORANGE", "BLUE"))
    shown = rp.apply_budgets(surf, {"RED": 2, "ORANGE": 0, "GREEN": 5})
    got = sorted((r.tier, r.seq) for r in shown.collect())
    assert [s for t, s in got if t == "RED"] == [0, 3]      # first N by arrival, not by score
    assert not [s for t, s in got if t == "ORANGE"]          # budget 0 shows none
    assert len([s for t, s in got if t == "BLUE"]) == 10     # no budget: unlimited


def test_default_surfacing_ignores_unknown_tier(spark):
    df = spark.createDataFrame([(1, 1, "GREY", 5), (1, 2, "RED", 2), (1, 3, "RED", 3)],
                               "sweep_id long, seq long, tier string, score long")
    assert [r.seq for r in rp.surfaced(df, 3).collect()] == [3]


def test_batches_0_40_41(spark):
    for n, want in [(0, []), (40, [40]), (41, [40, 1])]:
        df = spark.range(n).select(F.lit(1).cast("long").alias("sweep_id"), F.col("id").alias("seq"))
        b = sc.number_batches(df, 40)
        sizes = [r["count"] for r in b.groupBy("batch").count().orderBy("batch").collect()]
        assert sizes == want
        if n:
            assert sorted((r.batch, r.idx) for r in b.collect()) == [(i // 40, i % 40) for i in range(n)]


def test_positions_across_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("sweep_id"), F.col("id").alias("seq"))
    from siftline.operators.ordering import positions
    got = {(r.sweep_id, r.seq): r.rn for r in positions(df, ["sweep_id"], ["seq"]).collect()}
    for s in range(3):
        seqs = sorted(q for (g, q) in got if g == s)
        assert [got[(s, q)] for q in seqs] == list(range(len(seqs)))


def test_positions_do_not_depend_on_partitioning(spark):
    """Positions must be a function of the data only: two executions over
    differently partitioned inputs give the same numbering (a join of the
    two would otherwise pair different rows)."""
    from siftline.operators.ordering import positions
    base = spark.range(5000).select((F.col("id") % 2).alias("sweep_id"), (F.col("id") * 7919 % 100003).alias("seq"))
    a = positions(base.repartition(7), ["sweep_id"], ["seq"], "a")
    b = positions(base.repartition(3, "seq"), ["sweep_id"], ["seq"], "b")
    j = a.join(b, ["sweep_id", "seq"])
    assert j.count() == 5000 and j.where("a != b").count() == 0
    per = {r.sweep_id: sorted(r.ps) for r in a.groupBy("sweep_id").agg(F.collect_list("a").alias("ps")).collect()}
    assert all(v == list(range(len(v))) for v in per.values())
