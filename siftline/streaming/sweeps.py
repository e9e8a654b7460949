"""Sweeps as micro-batches.

A landing folder receives the raw rows of each sweep as it happens, in any
number of files; a file-source stream picks them up (``maxFilesPerTrigger``
decides how many files one micro-batch takes). A sweep may be spread over
several micro-batches, and sweeps may come late or out of order: every sink
ends in the batch result. All state lives in the stream checkpoint or in tables
under the shared folder, each micro-batch in partitions of its own, so a lost
executor or a restarted query replays from the checkpoint with the same results.

* T1 ``curate_stream``: a micro-batch's rows are added to its sweeps, and these
  sweeps and all later ones are curated anew against the seen-store.
* T2 ``dedup_stream``: a micro-batch emits keep or suppress for its rows, by a
  bucketed table of first sightings, and corrects what late rows prove wrong.
* T3 ``feed_health_stream``: a micro-batch's rows are added to its sweeps, whose
  deltas are made anew; the state folds the deltas.
* T4 ``source_quality_stream``: streaming aggregation, complete mode.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import curate as cur
from ..operators import folds as fl
from ..plans.sweep_run import record_seen, since_window
from ..sinks.logs import LogStore
from ..sinks.seen import FirstSeen


def land(df: DataFrame, path: str, unit: str, files: int = 3) -> None:
    """Write ``df`` to the landing folder, each value of ``unit`` in up to
    ``files`` files."""
    df.repartition(files).write.mode("append").partitionBy(unit).parquet(path)


def _read(spark: SparkSession, path: str, schema, per_trigger: int) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
            .parquet(path))


def _run(stream: DataFrame, body, checkpoint: str, mode: str = "append"):
    q = (stream.writeStream.outputMode(mode).foreachBatch(body).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _add(batch: DataFrame, epoch: int, path: str) -> list:
    """Add a micro-batch's rows to ``path``, by sweep and epoch (a replayed
    epoch replaces its own); the sweeps it touched, a handful of ids."""
    (batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("sweep_id", "epoch").parquet(path))
    return sorted(r.sweep_id for r in batch.select("sweep_id").distinct().collect())


def _rows(spark: SparkSession, path: str, schema, sweeps: list) -> DataFrame:
    """All rows added so far of ``sweeps``, read by partition."""
    return (spark.read.schema(schema).parquet(path).where(F.col("sweep_id").isin(sweeps))
            .select(*schema.fieldNames()))


def curate_stream(spark: SparkSession, landing: str, schema, store: LogStore, checkpoint: str, skip_domains,
                  skip_patterns, window_hours: int = 48, per_trigger: int = 4):
    """Curated items go to the store's ``curated`` log. Late rows of a
    sweep may change what later sweeps keep, so these are curated again; in
    order, that is the last sweep only."""
    raw = store.path("raw")

    def body(batch: DataFrame, epoch: int) -> None:
        touched = _add(batch, epoch, raw)
        if not touched:
            return
        times = spark.read.schema(schema).parquet(raw).select("sweep_id", "sweep_ts")
        start = times.where(F.col("sweep_id").isin(touched)).agg(F.min("sweep_ts")).first()[0]
        again = sorted(r.sweep_id for r in times.where(F.col("sweep_ts") >= F.lit(start)).select("sweep_id")
                       .distinct().collect())
        rows, run = _rows(spark, raw, schema, again), store.begin()
        kept = cur.curate(rows, skip_domains, skip_patterns, window_hours,
                          prior_first=run.seen_before(spark, rows, again, since_window(rows, again, window_hours)))
        record_seen(run.replace(spark, kept, "curated", again), run, spark, again)
        run.commit(spark)
    return _run(_read(spark, landing, schema, per_trigger), body, checkpoint)


DECISION = "sweep_id bigint, item_id string, seq bigint, sweep_ts timestamp, first_seen timestamp, kept boolean"
SLOTS = 32           # folders of the emitted decisions, by item


def dedup_stream(spark: SparkSession, landing: str, schema, out: str, checkpoint: str, window_hours: int = 48,
                 per_trigger: int = 4):
    """Each micro-batch decides its own rows and emits them.

    First sightings are kept in bucketed generations (``sinks.seen``), never
    refreshed and kept for ever; a micro-batch reads the buckets that may hold its
    items and adds a generation of what it learnt. A row is kept iff it is its
    item's first sighting or at least ``window_hours`` after it. Where rows come
    late and move an item's first sighting back, what was emitted for that item
    before is emitted again as it is now; ``dedup_emitted`` reads the last word.
    The state after each epoch is a small file of its own, so a replayed epoch
    starts from the state before it and writes the same again."""
    index = FirstSeen(f"{out}/first")

    def body(batch: DataFrame, epoch: int) -> None:
        gens = _state(spark, out, epoch - 1)
        rows = batch.select("sweep_id", "item_id", "seq", F.col("sweep_ts").cast("timestamp").alias("sweep_ts"))
        known = index.lookup(spark, gens, rows).groupBy("item_id").agg(F.min("first_seen").alias("known"))
        own = rows.groupBy("item_id").agg(F.min("sweep_ts").alias("own")).join(known, "item_id", "left")
        path = f"{out}/items/epoch={epoch}"          # of each item: what was known, and the sighting now
        own.withColumn("first_seen", F.least("own", "known")).write.mode("overwrite").parquet(path)
        items = spark.read.schema("item_id string, own timestamp, known timestamp, first_seen timestamp").parquet(path)
        earlier = items.where(F.col("own") < F.col("known"))
        decided = rows.join(items.select("item_id", "first_seen"), "item_id")
        slots = [r.slot for r in earlier.select(_slot().alias("slot")).distinct().collect()]
        if slots:
            past = (_emitted(spark, out).where(F.col("slot").isin(slots) & (F.col("epoch") < epoch))
                    .select(*rows.columns).distinct().join(earlier.select("item_id", "first_seen"), "item_id"))
            decided = decided.unionByName(past)
        (decided.select(*[c.split()[0] for c in DECISION.split(", ")[:-1]],
                        cur.window_keep("sweep_ts", "first_seen", window_hours).alias("kept"),
                        _slot().alias("slot"), F.lit(epoch).alias("epoch")).hint("rebalance", "slot")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot", "epoch")
         .parquet(f"{out}/decisions"))
        new = items.where(F.col("known").isNull() | (F.col("own") < F.col("known")))
        _put_state(spark, out, epoch, index.add(spark, gens, new.select(
            "item_id", "first_seen", F.lit(str(epoch)).alias("tag"))))
    return _run(_read(spark, landing, schema, per_trigger), body, checkpoint)


def _slot() -> F.Column:
    return F.pmod(F.xxhash64("item_id"), F.lit(SLOTS)).cast("int")


def _emitted(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(f"{DECISION}, slot int, epoch bigint").parquet(f"{out}/decisions")


def _state_path(out: str, epoch: int) -> str:
    return f"{out}/state/{epoch:012d}"


def _state(spark: SparkSession, out: str, epoch: int) -> list[dict]:
    """The generations after ``epoch``; none before the first."""
    if epoch < 0:
        return []
    return json.loads(spark.read.text(_state_path(out, epoch), wholetext=True).first().value)


def _put_state(spark: SparkSession, out: str, epoch: int, gens: list[dict]) -> None:
    spark.range(1).select(F.lit(json.dumps(gens)).alias("value")).coalesce(1).write.mode("overwrite").text(_state_path(out, epoch))


def dedup_emitted(spark: SparkSession, out: str) -> DataFrame:
    """sweep_id, item_id, seq, first_seen, kept: the last decision emitted for
    each row."""
    return (_emitted(spark, out).groupBy("sweep_id", "item_id", "seq")
            .agg(F.max_by(F.struct("first_seen", "kept"), "epoch").alias("_d"))
            .select("sweep_id", "item_id", "seq", "_d.first_seen", "_d.kept"))


def feed_health_stream(spark: SparkSession, landing: str, schema, store: LogStore, checkpoint: str,
                       per_trigger: int = 4):
    """The store's ``feed_delta`` has a row a feed and sweep, made from
    all rows of the sweep so far; ``folds.fold_feed_deltas`` is the state."""
    raw = store.path("raw")

    def body(batch: DataFrame, epoch: int) -> None:
        if touched := _add(batch, epoch, raw):
            delta = fl.feed_health_delta(_rows(spark, raw, schema, touched), ("feed_id", "sweep_id"))
            store.replace(spark, delta, "feed_delta", touched)
    return _run(_read(spark, landing, schema, per_trigger), body, checkpoint)


def source_quality_stream(spark: SparkSession, landing: str, schema, snapshot: str, checkpoint: str,
                          per_trigger: int = 4):
    """T4: running counts per source, complete output written per epoch."""
    def body(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(snapshot)
    return _run(fl.source_quality_counts(_read(spark, landing, schema, per_trigger)), body, checkpoint, "complete")
