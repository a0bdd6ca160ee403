"""Tables of a live job that survive retries, restarts and lost checkpoints.

Each micro-batch writes every table to a folder of its own, named by the run
(the query id, which a new checkpoint changes) and the batch, and then one
commit record: the batch's number over all runs, row counts, and the next
offset of each source partition. Readers see committed batches only, so

* a retried batch overwrites its own folders, and is skipped once committed;
* a new run never touches an older run's folders;
* the last record says where a new run has to start: no row lost or doubled.

Records are created under a new name each and never change; of two jobs that
write to one folder, the second one to commit a number fails.

The keyed snapshot (K5) is written every ``snapshot_every`` batches, from the
one before and the batches since. The commit record points to it, so it is
replaced at once or not at all, and users past their expiry leave it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpulse.functions import constants as C
from txpulse.streaming.processors import RFM_SEED

#: Columns of each table, by the kind of row of the live stream that goes there.
TABLES = {
    "segment": (
        "segments",
        "user_id int, partition int, seq long, type string, sum double, event_time long, segment string, r_minutes double, "
        "f long, m double, first_ts long",
    ),
    "alert": (
        "alerts",
        "user_id int, event_time long, seq long, type string, sum double, avg_check_5min double, message string",
    ),
    "late": ("late", "user_id int, partition int, seq long, type string, sum double, event_time long, reason string"),
    "expired": ("expired", "user_id int, event_time long"),
    "reject": ("quarantine", "partition int, seq long, reason string, malformed boolean, raw string"),
}
SCHEMAS = dict(TABLES.values())

#: Kinds of which every record of the source leaves exactly one row.
RECORD_KINDS = ("segment", "late", "reject")

COMMIT = (
    "number long, run_id string, batch_id long, offsets map<string,long>, rows map<string,long>, max_time long, snapshot long"
)
CURRENT = (
    "user_id int, first_ts long, last_ts long, last_partition int, last_seq long, f long, m double, r_minutes double, "
    "segment string, expires_at long"
)


class SharedFiles:
    """The few file operations of commit records, on any store that Spark reads."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        at, fs = self._at(path)
        return fs.exists(at)

    def names(self, path: str) -> list[str]:
        at, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def text(self, path: str) -> str:
        at, fs = self._at(path)
        stream = fs.open(at)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Writes a new file that appears whole; fails if there is one already."""
        folder, name = path.rsplit("/", 1)
        draft, fs = self._at(f"{folder}/.{name}.{uuid.uuid4().hex[:8]}")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        rename = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf)
        context.rename(fs.makeQualified(draft), fs.makeQualified(self._at(path)[0]), rename)

    def delete(self, path: str) -> None:
        at, fs = self._at(path)
        fs.delete(at, True)


class LiveTables:
    """The tables, commit records and keyed snapshot under ``root``."""

    def __init__(self, spark: SparkSession, root: str, snapshot_every: int = 16, ttl_ms: int = C.SNAPSHOT_TTL_MS):
        self.spark, self.root = spark, root.rstrip("/")
        self.snapshot_every, self.ttl_ms = snapshot_every, ttl_ms
        self.files = SharedFiles(spark)

    # commit records

    def last(self) -> dict | None:
        """The newest commit record."""
        names = [n for n in self.files.names(f"{self.root}/commits") if n.endswith(".json") and not n.startswith(".")]
        return json.loads(self.files.text(f"{self.root}/commits/{names[-1]}")) if names else None

    def commits(self) -> DataFrame:
        if self.last() is None:
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).json(f"{self.root}/commits")

    def _folder(self, table: str, run_id: str, batch_id: int) -> str:
        return f"{self.root}/{table}/run_id={run_id}/batch_id={batch_id}"

    # reading

    def read(self, table: str, after: int = 0) -> DataFrame:
        """A table's committed rows, of commits numbered over ``after``."""
        schema = SCHEMAS[table]
        if not self.files.exists(f"{self.root}/{table}"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, run_id string, batch_id long").parquet(f"{self.root}/{table}")
        done = self.commits().where(F.col("number") > after).select("run_id", "batch_id")
        return rows.join(done, ["run_id", "batch_id"], "left_semi").drop("run_id", "batch_id")

    def transactions(self) -> DataFrame:
        """Every clean transaction, late ones included."""
        columns = ("user_id", "partition", "seq", "type", "sum", "event_time")
        return self.read("segments").select(*columns).unionByName(self.read("late").select(*columns))

    def _newest(self, number: int, segments: DataFrame) -> DataFrame:
        """The snapshot of commit ``number`` (0: none) brought up to date with ``segments``."""
        rows = segments.select(
            "user_id", "first_ts", F.col("event_time").alias("last_ts"), F.col("partition").alias("last_partition"),
            F.col("seq").alias("last_seq"), "f", "m", "r_minutes", "segment", (F.col("event_time") + self.ttl_ms).alias("expires_at"),
        )
        if number:
            rows = rows.unionByName(self.spark.read.schema(CURRENT).parquet(f"{self.root}/current/number={number}"))
        order = F.struct("last_ts", "last_partition", "last_seq")
        newest = F.max_by(F.struct(*[c for c in rows.columns if c != "user_id"]), order)
        return rows.groupBy("user_id").agg(newest.alias("s")).select("user_id", "s.*")

    def current(self, as_of: int | None = None) -> DataFrame:
        """Each live user's newest state; expired are those idle for ``ttl_ms`` at ``as_of`` (default: the newest time)."""
        last = self.last()
        if last is None:
            return self.spark.createDataFrame([], CURRENT)
        rows = self._newest(last["snapshot"], self.read("segments", after=last["snapshot"]))
        return rows.where(F.col("expires_at") > (last["max_time"] if as_of is None else as_of))

    # writing

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` writer: tables, then the snapshot when it is due, then the commit record."""
        run_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        self.commit_batch(batch, run_id, batch_id)

    def commit_batch(
        self, batch: DataFrame, run_id: str, batch_id: int, before: Callable[[int, int], None] | None = None
    ) -> None:
        """``before`` writes what belongs to the commit, given its number and the newest time."""
        last = self.last() or {"number": 0, "offsets": {}, "max_time": None, "snapshot": 0, "run_id": None}
        if last["run_id"] == run_id and last["batch_id"] >= batch_id:
            return  # committed before a restart
        kinds = {r["kind"]: r for r in batch.groupBy("kind").agg(F.count("*").alias("n"), F.max("event_time").alias("t")).collect()}
        for kind in kinds:
            table, schema = TABLES[kind]
            columns = [c.split()[0] for c in schema.split(", ")]
            batch.where(F.col("kind") == kind).select(*columns).write.mode("overwrite").parquet(self._folder(table, run_id, batch_id))
        ends = batch.where(F.col("kind").isin(*RECORD_KINDS)).groupBy("partition").agg((F.max("seq") + 1).alias("next"))
        offsets = last["offsets"] | {str(r["partition"]): r["next"] for r in ends.collect()}  # one a source partition
        times = [t for t in (last["max_time"], *(r["t"] for r in kinds.values())) if t is not None]
        record = {
            "number": last["number"] + 1, "run_id": run_id, "batch_id": batch_id, "offsets": offsets,
            "rows": {k: r["n"] for k, r in kinds.items()}, "max_time": max(times, default=None), "snapshot": last["snapshot"],
        }
        due = record["number"] - last["snapshot"] >= self.snapshot_every
        if due:
            columns = [c.split()[0] for c in SCHEMAS["segments"].split(", ")]
            since = self.read("segments", after=last["snapshot"]).unionByName(batch.where("kind = 'segment'").select(*columns))
            live = self._newest(last["snapshot"], since).where(F.col("expires_at") > F.lit(record["max_time"]))
            live.write.mode("overwrite").parquet(f"{self.root}/current/number={record['number']}")
            record["snapshot"] = record["number"]
        if before is not None:
            before(record["number"], record["max_time"])
        self.files.create(f"{self.root}/commits/{record['number']:012d}.json", json.dumps(record))
        if due:  # the snapshot before this one stays for readers that began with it
            for name in self.files.names(f"{self.root}/current"):
                if int(name.partition("=")[2]) < last["snapshot"]:
                    self.files.delete(f"{self.root}/current/{name}")

    # restoring

    def seed(self, window_ms: int, delay_ms: int) -> DataFrame:
        """Initial state of a new run (``RFM_SEED``): epoch marks and trailing windows as of the last commit.

        Marks come from the keyed snapshot. Entries are the committed rows that
        the state would still hold, which is back to the user's last row or the
        watermark, whichever is older, less the window; commits that end before
        any live user's are not read. Users whose expiry was reported stay out.
        """
        last = self.last()
        if last is None:
            return self.spark.createDataFrame([], RFM_SEED)
        gone = self.read("expired").select("user_id", F.col("event_time").alias("last_ts"))
        heads = self.current().join(gone, ["user_id", "last_ts"], "left_anti")
        nothing = F.lit(None)
        marks = heads.select(
            "user_id", F.lit(True).alias("is_header"), F.col("last_ts").alias("event_time"), F.col("last_seq").alias("seq"),
            nothing.cast("double").alias("sum"), nothing.cast("string").alias("type"), "first_ts",
            F.col("last_partition").alias("partition"),
        )
        oldest = last["max_time"] - self.ttl_ms - delay_ms - window_ms
        begun = self.commits().where(F.col("max_time") < oldest).agg(F.max("number")).first()[0] or 0
        horizon = F.least("last_ts", F.lit(last["max_time"] - delay_ms)) - window_ms
        kept = self.read("segments", after=begun).join(heads.select("user_id", "last_ts"), "user_id")
        entries = kept.where(F.col("event_time") >= horizon).select(
            "user_id", F.lit(False).alias("is_header"), "event_time", "seq", "sum", "type",
            nothing.cast("long").alias("first_ts"), "partition",
        )
        # written: the new run reads it as it is now, however often its first batch is tried
        path = f"{self.root}/seeds/number={last['number']}"
        marks.unionByName(entries).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(RFM_SEED).parquet(path)
