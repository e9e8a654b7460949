"""Append-only logs under a shared folder (K1-K5), made whole by a manifest.

Every log is parquet, partitioned by the sweep that its rows belong to and the run
that wrote them. Nothing is ever overwritten: a run writes partitions of its own,
and one small file, the manifest, says for each log and sweep which run counts.
Readers read the manifest first and then only the partitions it names, and a run
writes it last, for all its logs at once. So readers see whole runs only: of a
run that breaks off between two logs they see nothing, and the next run of its
sweeps starts from what was there before. A lost executor only reruns tasks of a
write. What a commit replaces is deleted by the commit after it, so that frames
planned on the state before still find their files.

Manifests are numbered and put in place by renaming, which fails if another
writer was first: one writer at a time is meant, two do not go unnoticed.

Tables (items, feed health, source quality, digests) are folds over these logs
(``operators.folds``), kept as one delta a sweep: late and rerun sweeps count. The
first sightings among the items seen are kept by ``sinks.seen`` as well; its
generations are part of the manifest.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .seen import FirstSeen

SCHEMAS = {
    # first_seen_date partitions let the 48 h window read only recent dates
    "items_seen": ("item_id string, url string, title string, summary string, source string, "
                   "domain string, published string, first_seen timestamp, first_seen_date date, "
                   "sweep_id bigint"),
    "curated": ("sweep_id bigint, sweep_ts timestamp, source_type string, seq bigint, item_id string, "
                "title string, url string, summary string, source string, domain string, published string"),
    "items": ("sweep_id bigint, sweep_ts timestamp, source_type string, seq bigint, item_id string, "
              "title string, url string, summary string, source string, domain string, published string"),
    # a model's answers, by what was asked, each attempt with its outcome
    "responses": ("sweep_id bigint, batch bigint, prompt_hash string, response string, error string, attempt int, "
                  "usable boolean"),
    "score_log": ("sweep_id bigint, sweep_ts timestamp, source_type string, seq bigint, item_id string, "
                  "title string, url string, summary string, source string, domain string, published string, "
                  "batch bigint, idx bigint, score bigint, tier string, reason string"),
    "fetch_log": ("feed_id string, feed_url string, ts timestamp, seq bigint, ok boolean, "
                  "status_code int, error string, item_count int, sweep_id bigint"),
    "digest_log": ("sweep_id bigint, sweep_ts string, sweep_type string, items_fetched bigint, "
                   "items_after_dedup bigint, items_scored bigint, items_surfaced bigint, red_count bigint, "
                   "orange_count bigint, yellow_count bigint, filepath string"),
    "digests": "sweep_id bigint, n_lines bigint, digest string",
    "warnings": "sweep_id bigint, ord bigint, source_type string, warning string",
    # what each sweep adds to the folded state
    "feed_delta": ("feed_id string, sweep_id bigint, feed_url string, "
                   "first_key struct<ts:timestamp,seq:bigint,feed_url:string>, "
                   "total_fetches bigint, total_items bigint, last_success timestamp, last_failure timestamp, "
                   "last_status_code bigint, last_error string, "
                   "last_failure_key struct<ts:timestamp,seq:bigint,status_code:int,error:string>, "
                   "has_success boolean, failures bigint, consecutive_failures bigint"),
    "quality_delta": "source string, sweep_id bigint, total_scored bigint, scored_3plus bigint, scored_4plus bigint",
}
PARTITIONS = {
    "items_seen": ("first_seen_date", "sweep_id"),
    "items": ("sweep_id",), "curated": ("sweep_id",), "responses": ("sweep_id",), "score_log": ("sweep_id",), "fetch_log": ("sweep_id",),
    "digest_log": ("sweep_id",), "digests": ("sweep_id",), "warnings": ("sweep_id",),
    "feed_delta": ("sweep_id",), "quality_delta": ("sweep_id",),
}


KEPT = 64           # checkpoints a log, for states as of earlier sweeps


def _versions(own: dict[str, list[str]], upto: int) -> str:
    """Which runs count for the sweeps up to one."""
    pairs = sorted((int(s), sorted(runs)) for s, runs in own.items() if int(s) <= upto)
    return hashlib.sha256(json.dumps(pairs).encode()).hexdigest()


def _cols(schema: str) -> list[str]:
    """Top-level column names of a DDL schema (struct fields use ','
    without a space, columns ', ')."""
    return [c.split()[0] for c in schema.split(", ")]


@dataclass
class Run:
    """What an open run has written so far, by log and sweep."""
    id: str
    logs: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    seen: list[dict] | None = None
    checkpoints: dict[str, dict] = field(default_factory=dict)


@dataclass(frozen=True)
class LogStore:
    """Logs under ``root`` (a folder every executor can reach). ``begin`` gives
    a store whose writes count from its ``commit`` on, and which reads its own
    writes; a store without a run commits each write by itself."""
    root: str
    run: Run | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _fs(self, spark: SparkSession, path: str):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p

    # ----------------------------------------------------------------- manifest

    def _manifest(self, spark: SparkSession) -> tuple[int, dict]:
        """The last manifest's number and content: runs by log and sweep, the
        generations of first sightings, and what the next commit deletes."""
        fs, folder = self._fs(spark, self.path("_manifest"))
        last = max((int(f.getPath().getName()[:-5]) for f in (fs.listStatus(folder) if fs.exists(folder) else [])
                    if f.getPath().getName().endswith(".json")), default=0)
        if not last:
            return 0, {"logs": {}, "seen": [], "gone": [], "checkpoints": {}}
        stream = fs.open(self._fs(spark, f"{self.path('_manifest')}/{last:012d}.json")[1])
        try:
            return last, json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _live(self, spark: SparkSession) -> dict:
        """The manifest as this store sees it: with its own run's writes."""
        state = self._manifest(spark)[1]
        for name, sweeps in (self.run.logs if self.run else {}).items():
            state["logs"].setdefault(name, {}).update(sweeps)
        if self.run and self.run.seen is not None:
            state["seen"] = self.run.seen
        return state

    def begin(self) -> "LogStore":
        return LogStore(self.root, Run(f"r{uuid.uuid4().hex[:12]}"))

    def commit(self, spark: SparkSession) -> None:
        """Make the run's writes count, all at once."""
        self._commit(spark, self.run.logs, self.run.seen, self.run.checkpoints)

    def _commit(self, spark: SparkSession, logs: dict, seen: list[dict] | None = None, checkpoints: dict | None = None) -> None:
        number, state = self._manifest(spark)
        gone = []
        for name, sweeps in logs.items():
            own = state["logs"].setdefault(name, {})
            for sweep, runs in sweeps.items():
                gone += [[name, sweep, r] for r in own.get(sweep, []) if r not in runs]
                own[sweep] = runs
        for name in {*state["checkpoints"], *(checkpoints or {})}:
            own = state["logs"].get(name, {})
            held = [*state["checkpoints"].get(name, []), *([checkpoints[name]] if name in (checkpoints or {}) else [])]
            good = [c for c in held if c["key"] == _versions(own, c["upto"])][-KEPT:]
            gone += [["_checkpoints", c["id"], ""] for c in held if c not in good]
            state["checkpoints"][name] = good
        if seen is not None:
            gone += [["_seen", g["id"], ""] for g in state["seen"] if g not in seen]
            state["seen"] = seen
        for name, sweep, run in state["gone"]:
            depth = "/*" * (len(PARTITIONS.get(name, "1")) - 1)
            patterns = [f"{self.path(name)}{depth}/sweep_id={sweep}/run={run}"] if run else [
                f"{self.path(name)}/{sweep}"] if name == "_checkpoints" else [
                f"{self.path(name)}/{kind}/gen={sweep}" for kind in ("pairs", "filters")]
            for pattern in patterns:
                fs, p = self._fs(spark, pattern)
                for f in fs.globStatus(p) or []:
                    fs.delete(f.getPath(), True)
        state["gone"] = gone
        fs, draft = self._fs(spark, f"{self.path('_manifest')}/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(json.dumps(state).encode())
        out.close()
        target = self._fs(spark, f"{self.path('_manifest')}/{number + 1:012d}.json")[1]
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise RuntimeError(f"another writer committed to {self.root}")
        if number > 1:
            fs.delete(self._fs(spark, f"{self.path('_manifest')}/{number - 1:012d}.json")[1], False)

    # --------------------------------------------------------------------- logs

    def exists(self, spark: SparkSession, name: str) -> bool:
        return bool(self._live(spark)["logs"].get(name))

    def read(self, spark: SparkSession, name: str, sweeps: Sequence[int] | None = None) -> DataFrame:
        """A log, or its rows of ``sweeps``: the partitions that count."""
        schema = SCHEMAS[name]
        own = self._live(spark)["logs"].get(name, {})
        live = {f"sweep_id={s}/run={r}" for s, runs in own.items() for r in runs if sweeps is None or int(s) in set(sweeps)}
        ids = "*" if sweeps is None else "{" + ",".join(str(int(s)) for s in sweeps or [-1]) + "}"
        depth = "/*" * (len(PARTITIONS[name]) - 1)
        fs, pattern = self._fs(spark, f"{self.path(name)}{depth}/sweep_id={ids}/run=*")
        paths = [f.getPath().toString() for f in (fs.globStatus(pattern) or [] if live else [])]
        paths = [p for p in paths if "/".join(p.split("/")[-2:]) in live]
        if not paths:
            return spark.createDataFrame([], schema)
        return (spark.read.schema(schema).option("basePath", self.path(name)).parquet(*paths)
                .select(*_cols(schema)))

    def read_between(self, spark: SparkSession, name: str, first: int, last: int) -> DataFrame:
        """A log's rows of the sweeps from ``first`` to ``last``, whoever ran them."""
        own = self._live(spark)["logs"].get(name, {})
        return self.read(spark, name, [int(s) for s in own if first <= int(s) <= last])

    def _write(self, df: DataFrame, name: str, run: str) -> None:
        """Rows are dealt by sweep before they are written, a sweep to as many
        tasks as its size asks for, so a partition gets few files."""
        (df.select(*_cols(SCHEMAS[name])).withColumn("run", F.lit(run)).hint("rebalance", "sweep_id").write.mode("append")
         .partitionBy(*PARTITIONS[name], "run").parquet(self.path(name)))

    def replace(self, spark: SparkSession, df: DataFrame, name: str, sweeps: Sequence[int]) -> DataFrame:
        """Make ``df`` the rows of ``sweeps`` in a log, also where it has none,
        and read them back: cuts lineage, and fixes what is not deterministic."""
        run = self.run.id if self.run else f"r{uuid.uuid4().hex[:12]}"
        self._write(df, name, run)
        entries = {str(int(s)): [run] for s in sweeps}
        if self.run:
            self.run.logs.setdefault(name, {}).update(entries)
        else:
            self._commit(spark, {name: entries})
        return self.read(spark, name, sweeps)

    def append(self, spark: SparkSession, df: DataFrame, name: str, sweeps: Sequence[int]) -> None:
        """Add rows of ``sweeps`` to those a log has. They count at once, also
        if the run breaks off: for facts, such as a model's answers."""
        run = f"r{uuid.uuid4().hex[:12]}"
        self._write(df, name, run)
        own = self._manifest(spark)[1]["logs"].get(name, {})
        self._commit(spark, {name: {str(int(s)): [*own.get(str(int(s)), []), run] for s in sweeps}})

    # ---------------------------------------------------------------- checkpoints

    def deltas(self, spark: SparkSession, name: str, upto: int | None = None) -> DataFrame:
        """What the state as of sweep ``upto`` (of now) folds from: the latest
        checkpoint before it, as one delta a key, and the deltas after that one.
        A checkpoint holds only while the sweeps it covers are those, and of the
        runs, that it was made of: a late or rerun sweep ends it and all later
        ones, and the state folds from what is left."""
        return self._deltas(spark, name, upto)[0]

    def _deltas(self, spark: SparkSession, name: str, upto: int | None) -> tuple[DataFrame, list[int]]:
        state = self._live(spark)
        own = state["logs"].get(name, {})
        good = [c for c in state["checkpoints"].get(name, []) if (upto is None or c["upto"] <= upto)
                and c["key"] == _versions(own, c["upto"])]
        last = max(good, key=lambda c: c["upto"], default=None)
        sweeps = sorted(int(s) for s in own if (last is None or int(s) > last["upto"]) and (upto is None or int(s) <= upto))
        rows = self.read(spark, name, sweeps)
        if last is not None:
            rows = spark.read.schema(SCHEMAS[name]).parquet(f"{self.path('_checkpoints')}/{last['id']}").select(
                *_cols(SCHEMAS[name])).unionByName(rows)
        return rows, sweeps

    def checkpoint(self, spark: SparkSession, name: str, fold, every: int = 32) -> None:
        """Within a run: fold a log's deltas into a checkpoint where ``every``
        sweeps or more came since the last one."""
        rows, sweeps = self._deltas(spark, name, None)
        if len(sweeps) < every:
            return
        made = {"id": f"{name}-{self.run.id}", "upto": sweeps[-1]}
        made["key"] = _versions(self._live(spark)["logs"][name], sweeps[-1])
        (fold(rows).withColumn("sweep_id", F.lit(sweeps[-1]).cast("bigint")).select(*_cols(SCHEMAS[name]))
         .write.parquet(f"{self.path('_checkpoints')}/{made['id']}"))
        self.run.checkpoints[name] = made

    # ---------------------------------------------------------- first sightings

    def seen_before(self, spark: SparkSession, items: DataFrame, sweeps: Sequence[int], since: Column | None = None) -> DataFrame:
        """item_id, first_seen of the items at hand as other sweeps than
        ``sweeps`` recorded them (after ``since``), read by ``sinks.seen``."""
        state = self._live(spark)
        found = FirstSeen(self.path("_seen")).lookup(spark, state["seen"], items, self._dead(state), since)
        mine = [str(int(s)) for s in sweeps]
        found = found.where(~F.substring_index("tag", ":", 1).isin(mine))
        return found.groupBy("item_id").agg(F.min("first_seen").alias("first_seen"))

    def _dead(self, state: dict) -> list[str]:
        """Tags (sweep:run) of the generations that no longer count."""
        live = {f"{s}:{r}" for s, runs in state["logs"].get("items_seen", {}).items() for r in runs}
        return sorted({t for g in state["seen"] for t in g["tags"]} - live)

    def record(self, spark: SparkSession, rows: DataFrame, sweeps: Sequence[int]) -> DataFrame:
        """Write the items seen of ``sweeps`` and their first sightings."""
        kept = self.replace(spark, rows, "items_seen", sweeps)
        state = self._live(spark)
        run = state["logs"]["items_seen"][str(int(sweeps[0]))][0]
        dead = self._dead(state)
        pairs = kept.select("item_id", "first_seen", F.concat_ws(":", F.col("sweep_id").cast("string"), F.lit(run)).alias("tag"))
        gens = FirstSeen(self.path("_seen")).add(spark, state["seen"], pairs, dead)
        held = {g["id"]: g["tags"] for g in state["seen"]}
        tags = sorted({t for g in state["seen"] for t in g["tags"]} | {f"{int(s)}:{run}" for s in sweeps})
        gens = [{**g, "tags": held.get(g["id"]) or [t for t in tags if t not in dead]} for g in gens]
        if self.run:
            self.run.seen = gens
        else:
            self._commit(spark, {}, gens)
        return kept


def digest_files(digests: DataFrame, path: str) -> DataFrame:
    """One markdown file a sweep (K5), ``<path>/YYYY-MM-DD_HHMM.md``, written
    by the tasks that hold the digests (``sweep_id, sweep_ts, digest``); the
    result lists them. A file is moved into place whole."""
    from ..functions.dates import digest_name

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs
        store, folder = pafs.FileSystem.from_uri(path) if "://" in path else (
            pafs.LocalFileSystem(), path.removeprefix("file:"))
        store.create_dir(folder, recursive=True)
        for b in batches:
            for name, text in zip(b.column("name").to_pylist(), b.column("digest").to_pylist()):
                part = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}"
                with store.open_output_stream(part) as f:
                    f.write((text or "").encode())
                store.move(part, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([b.column("sweep_id"), b.column("name")], names=["sweep_id", "name"])
    return digests.select("sweep_id", digest_name(F.col("sweep_ts")).alias("name"), "digest").mapInArrow(
        write, "sweep_id bigint, name string")
