"""Recorded payloads as a stream, into curated sweeps."""

import json
import os

import pytest

from siftline.config import CurationConfig
from siftline.operators import curate as cur
from siftline.plans.sweep_run import items_from_raw
from siftline.sources.landing import Payloads

RSS = "<rss><channel><item><title>{0}</title><link>https://a.example/{0}</link></item></channel></rss>"


def _land(path, source, feed, name, rows):
    os.makedirs(f"{path}/{source}/{feed}", exist_ok=True)
    with open(f"{path}/{source}/{feed}/{name}.jsonl", "w") as f:
        for sweep, title in rows:
            f.write(json.dumps({"sweep_id": sweep, "sweep_ts": f"2024-01-0{sweep} 07:00:00", "sweep_type": "full",
                                "feed_name": feed, "fetch_seq": 0, "body": RSS.format(title)}) + "\n")


def _stream(spark, path, ck, got):
    def body(batch, epoch):
        items, _ = items_from_raw(batch, CurationConfig(), spark)
        got.append(sorted((r.sweep_id, r.title) for r in cur.curate(items, (), ()).collect()))
    q = (spark.readStream.format("payloads").option("path", path).option("files_a_partition", 1).load()
         .writeStream.foreachBatch(body).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()


def test_a_stream_reads_what_is_new(spark, tmpdir_path):
    spark.dataSource.register(Payloads)
    path, got = f"{tmpdir_path}/landing", []
    _land(path, "rss", "one", "0001", [(1, "a"), (1, "b")])
    _land(path, "rss", "two", "0001", [(1, "c")])
    _stream(spark, path, f"{tmpdir_path}/ck", got)
    _land(path, "rss", "one", "0002", [(2, "d")])
    _land(path, "rss", "three", "0001", [(2, "e")])
    _stream(spark, path, f"{tmpdir_path}/ck", got)
    seen = [x for g in got for x in g]
    assert sorted(seen) == [(1, "a"), (1, "b"), (1, "c"), (2, "d"), (2, "e")]
    whole = spark.read.format("payloads").option("path", path).load()
    assert whole.count() == 5 and {r.source_type for r in whole.collect()} == {"rss"}
    assert spark.read.format("payloads").option("path", f"{tmpdir_path}/none").load().count() == 0


def test_a_broken_line_names_its_file(spark, tmpdir_path):
    spark.dataSource.register(Payloads)
    os.makedirs(f"{tmpdir_path}/l/rss/one")
    with open(f"{tmpdir_path}/l/rss/one/1.jsonl", "w") as f:
        f.write('{"sweep_id": 1}\n{"sweep')
    with pytest.raises(Exception, match="1.jsonl, line 2"):
        spark.read.format("payloads").option("path", f"{tmpdir_path}/l").load().collect()
