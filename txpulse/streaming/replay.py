"""Replay the generated events through the streaming queries, in time order.

The wire records (Kafka-shaped, same damage as the batch queries) are
written to a folder as consecutive time slices, one write job per slice, so
file modification times follow event time. Inside a slice the files are
split by Kafka partition (hash of the user), so each user's rows of a slice
are in one file, like one Kafka partition. The file stream source then feeds
the files oldest first with ``availableNow``; every user sees its rows in
time order across micro-batches, and the result must equal the batch query.

The order rests on file modification times: on a store whose timestamps are
coarser than the time between two slice copies, feed a Kafka topic instead.
This is a test and replay harness, not the production source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txpulse.functions import constants as C
from txpulse.operators.rfm import SCALED_RULES, RfmRules
from txpulse.schemas import KAFKA_RECORD
from txpulse.session import scratch_path
from txpulse.plans.restore import split_time
from txpulse.sources.events import events_transactions, orders_transactions
from txpulse.sources.ingest import judged_transactions, parse_transactions
from txpulse.streaming.app import (
    alerts_stream,
    live_metrics,
    live_stream,
    restore_seed,
    restored_offsets,
    segments_stream,
    start,
)
from txpulse.sources.kafka import from_offsets, transactions_as_kafka
from txpulse.streaming.export import exported_state
from txpulse.streaming.sinks import BatchFanout, parquet_table_writer
from txpulse.streaming.table_state import TableState
from txpulse.streaming.tables import RECORD_KINDS, LiveTables, SharedFiles

DAY_MS = 86_400_000


def write_wire_slices(
    spark: SparkSession,
    tx: DataFrame,
    slice_ms: int = 5 * DAY_MS,
    corrupt: bool = False,
    partitions: int | None = None,
    path: str | None = None,
    keyed: bool = True,
) -> str:
    """Append the Kafka-shaped records to ``path`` as time slices; returns the folder.

    The wire is encoded once into a staging table partitioned by slice; each
    slice is then copied on its own, oldest first (partition pruning reads
    only that slice), so file times follow event time.
    """
    path = path or scratch_path(spark, "wire")
    partitions = partitions or spark.sparkContext.defaultParallelism
    staging = scratch_path(spark, "wire-staging")
    wire = transactions_as_kafka(tx, corrupt=corrupt, partitions=partitions if keyed else 8, keyed=keyed)
    ms = "unix_millis(timestamp)"
    # one shuffle: each staged file holds whole Kafka partitions of one slice
    (
        wire.withColumn("_slice", F.expr(f"({ms} - pmod({ms}, {slice_ms})) div {slice_ms}"))
        .repartition(partitions, "partition")
        .write.partitionBy("_slice")
        .parquet(staging)
    )
    staged = spark.read.parquet(staging)
    for k in _partition_values(spark, staging, "_slice"):  # a handful of time slices, each a distributed copy, no shuffle
        staged.where(F.col("_slice") == k).drop("_slice").write.mode("append").parquet(path)
    return path


def _exists(spark: SparkSession, folder: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _partition_values(spark: SparkSession, folder: str, column: str) -> list[int]:
    """Values of a partition column, from the folder names (a metadata listing, no job)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = f"{column}="
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def wire_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The slices, oldest files first, by default as many a batch as a slice has."""
    files_per_batch = files_per_batch or spark.sparkContext.defaultParallelism
    return spark.readStream.schema(KAFKA_RECORD).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(
    spark: SparkSession, events: DataFrame, name: str, out: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Process everything available, write it under ``out``; return what ``out`` holds."""
    out = out or scratch_path(spark, f"{name}-out")
    q = start(
        events,
        BatchFanout([parquet_table_writer(out)], name=name),
        checkpoint=checkpoint or scratch_path(spark, f"{name}-ckpt"),
        name=f"{name}_{abs(hash(out)) % 10**8}",
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    if not _exists(spark, out):  # nothing was available
        return spark.createDataFrame([], events.schema)
    return spark.read.schema(events.schema).parquet(out).select(*events.columns)


def replay_alerts(
    spark: SparkSession,
    tx: DataFrame,
    window_ms: int = C.ANOMALY_WINDOW_MS,
    factor: float = C.ANOMALY_FACTOR,
    time_mode: str = "None",
    slice_ms: int = 5 * DAY_MS,
) -> DataFrame:
    path = write_wire_slices(spark, tx, slice_ms)
    alerts = alerts_stream(
        wire_stream(spark, path), window_ms, factor, time_mode=time_mode, watermark=f"{slice_ms // 1000} seconds"
    )
    return run_available(spark, alerts, "alerts")


def replay_segments(
    spark: SparkSession,
    tx: DataFrame,
    rules: RfmRules = RfmRules(),
    time_mode: str = "None",
    slice_ms: int = 5 * DAY_MS,
    seed: DataFrame | None = None,
) -> DataFrame:
    path = write_wire_slices(spark, tx, slice_ms)
    segments = segments_stream(
        wire_stream(spark, path), rules, time_mode=time_mode, watermark=f"{slice_ms // 1000} seconds", seed=seed
    )
    return run_available(spark, segments, "segments")


def replay_restored(spark: SparkSession, tx: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    """Stream half of the time, lose the checkpoint, seed a new query from the transactions table, go on."""
    t = split_time(tx)
    path = write_wire_slices(spark, tx.where(F.col("event_time") < t))
    first = run_available(spark, segments_stream(wire_stream(spark, path), rules), "segments")
    clean = run_available(spark, parse_transactions(wire_stream(spark, path))[0], "transactions")
    seed = restore_seed(clean, rules, as_of=t)
    second = replay_segments(spark, tx.where(F.col("event_time") >= t), rules, seed=seed)
    return first.unionByName(second)


def replay_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver query: 24-hour alerts over the replayed events."""
    return replay_alerts(spark, events_transactions(spark, sf_dir), window_ms=C.RFM_WINDOW_MS)


def replay_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver query: scaled-threshold segments over the replayed events."""
    return replay_segments(spark, events_transactions(spark, sf_dir), SCALED_RULES)


#: Rows of a slice may come in any order, so a replay admits rows that are late by a slice.
SLICE_MS = 5 * DAY_MS


def run_live(
    spark: SparkSession,
    wire: str,
    tables: LiveTables,
    checkpoint: str,
    rules: RfmRules = RfmRules(),
    seed: DataFrame | None = None,
    offsets: dict[int, int] | None = None,
    files_per_batch: int | None = None,
) -> list[dict]:
    """The live query over everything available on ``wire``, into ``tables``; the observed metrics of its batches."""
    source = from_offsets(wire_stream(spark, wire, files_per_batch), offsets or {})
    q = start(
        live_stream(source, rules, delay_ms=SLICE_MS, seed=seed),
        BatchFanout([tables.write], name="live"),
        checkpoint,
        f"live_{abs(hash(checkpoint)) % 10**8}",
        {"availableNow": True},
    )
    q.awaitTermination()  # raises the query's failure
    return live_metrics(q)


class _NoCommit(SharedFiles):
    """A job that is lost after it wrote a batch's tables and before the commit record."""

    def create(self, path: str, text: str) -> None:
        raise RuntimeError("lost before the commit")


def replay_restart(spark: SparkSession, tx: DataFrame, rules: RfmRules = RfmRules()) -> LiveTables:
    """The live job dies within a batch and loses its checkpoint; a new run goes on in the same folder.

    The first run commits the first half of the time, then writes the tables
    of one more batch without its commit record. The new run starts from the
    last record: state from the tables, source from its offsets, so ``seq`` has
    to grow as the records arrive, as a topic's offsets do (see ``arrival_numbers``).
    """
    root = scratch_path(spark, "live")
    tables = LiveTables(spark, root, snapshot_every=2)
    t = split_time(tx)
    wire = write_wire_slices(spark, tx.where(F.col("event_time") < t), SLICE_MS)
    run_live(spark, wire, tables, f"{root}/checkpoint-0", rules)
    write_wire_slices(spark, tx.where(F.col("event_time") >= t), SLICE_MS, path=wire)
    dying = LiveTables(spark, root, snapshot_every=2)
    dying.files = _NoCommit(spark)
    try:
        run_live(spark, wire, dying, f"{root}/checkpoint-0", rules)
    except Exception as e:
        if "lost before the commit" not in str(e):
            raise
    seed = tables.seed(rules.window_ms, SLICE_MS)
    offsets = restored_offsets(tables)
    run_live(spark, wire, tables, f"{root}/checkpoint-1", rules, seed, offsets)
    return tables


def arrival_numbers(tx: DataFrame) -> tuple[DataFrame, Column]:
    """``tx`` with ``seq`` growing by half of the time and slice, as ``replay_restart`` writes them, and what gives ``seq`` back.

    Event ids need not follow the time; within a slice they stay in order.
    """
    t = split_time(tx)
    part = F.expr(f"2 * ((event_time - pmod(event_time, {SLICE_MS})) div {SLICE_MS}) + if(event_time >= {t}, 1, 0)")
    low, high, begun = tx.agg(F.min("seq"), F.max("seq"), F.min(part)).first()
    span = high - low + 1
    return tx.withColumn("seq", (part - begun) * F.lit(span) + (F.col("seq") - low)), F.col("seq") % F.lit(span) + low


def restart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver query: every transaction with its segment, once, across the lost run and the new one."""
    tx, seq = arrival_numbers(events_transactions(spark, sf_dir))
    tables = replay_restart(spark, tx, SCALED_RULES)
    rows = tables.read("segments").withColumn("seq", seq)
    return rows.select("user_id", "seq", "type", "sum", F.col("event_time").alias("updated_at"), "segment", "r_minutes", "f", "m")


LATE_EVERY = 23


def accounting_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver query: what became of each record - segment, late or reject - on a wire with damage and stragglers.

    Every 23rd transaction of the first half of the time comes after all others.
    """
    tx = events_transactions(spark, sf_dir)
    straggler = (F.pmod("seq", F.lit(LATE_EVERY)) == 0) & (F.col("event_time") < split_time(tx))
    tables = LiveTables(spark, scratch_path(spark, "live"))
    wire = write_wire_slices(spark, tx.where(~straggler), SLICE_MS, corrupt=True)
    run_live(spark, wire, tables, f"{tables.root}/checkpoint", SCALED_RULES)
    write_wire_slices(spark, tx.where(straggler), SLICE_MS, corrupt=True, path=wire)
    run_live(spark, wire, tables, f"{tables.root}/checkpoint", SCALED_RULES)
    kinds = [
        tables.read(name).select("seq", F.lit(kind).alias("kind"), c.alias("reason"), n.alias("f"))
        for kind, name, c, n in (
            ("segment", "segments", F.lit(None).cast("string"), F.col("f")),
            ("late", "late", F.col("reason"), F.lit(None).cast("long")),
            ("reject", "quarantine", F.col("reason"), F.lit(None).cast("long")),
        )
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def expiry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver query: the end of each activity epoch that the watermark or the user's next transaction has shown."""
    tables = LiveTables(spark, scratch_path(spark, "live"))
    wire = write_wire_slices(spark, events_transactions(spark, sf_dir), SLICE_MS)
    run_live(spark, wire, tables, f"{tables.root}/checkpoint", SCALED_RULES)
    return tables.read("expired").select("user_id", F.col("event_time").alias("last_ts"))


def current_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver query: the keyed snapshot that the live job keeps, 12 h before the last user's expiry."""
    tables = LiveTables(spark, scratch_path(spark, "live"), snapshot_every=2)
    wire = write_wire_slices(spark, events_transactions(spark, sf_dir), SLICE_MS)
    run_live(spark, wire, tables, f"{tables.root}/checkpoint", RfmRules())
    as_of = tables.last()["max_time"] + C.SNAPSHOT_TTL_MS - DAY_MS // 2
    return tables.current(as_of).select("user_id", "last_ts", "f", "m", "segment", "expires_at")


def metrics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver query: observed row counts of each micro-batch, one batch a slice of five days."""
    tx = events_transactions(spark, sf_dir)
    tables = LiveTables(spark, scratch_path(spark, "live"))
    wire, rows = scratch_path(spark, "wire"), []
    lo, hi = tx.agg(F.min("event_time"), F.max("event_time")).first()
    for k in range(lo // SLICE_MS, hi // SLICE_MS + 1):
        part = tx.where(F.expr(f"(event_time - pmod(event_time, {SLICE_MS})) div {SLICE_MS}") == k)
        write_wire_slices(spark, part, SLICE_MS, corrupt=True, path=wire)
        for m in run_live(spark, wire, tables, f"{tables.root}/checkpoint", SCALED_RULES, files_per_batch=1 << 20):
            if not any(m[kind] for kind in RECORD_KINDS):  # a batch that only moved the watermark
                continue
            rows.append((k, m["segment"], m["late"], m["reject"], m["credit"], m["deposit"], m["max_time"]))
    shape = "slice long, n_segment long, n_late long, n_reject long, n_credit long, n_deposit long, max_time long"
    return spark.createDataFrame(rows, shape)  # one row a micro-batch


#: Years of orders, in which many of a customer's rows share one day.
UNKEYED_RULES = RfmRules(window_ms=365 * DAY_MS, retention_ms=365 * DAY_MS, recency="gap")


def unkeyed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver query: orders on a topic that is not keyed by user; ties go by (partition, offset)."""
    tx = orders_transactions(spark, sf_dir)
    t = split_time(tx)
    tables = LiveTables(spark, scratch_path(spark, "live"))
    wire = scratch_path(spark, "wire")
    for part in (tx.where(F.col("event_time") < t), tx.where(F.col("event_time") >= t)):
        write_wire_slices(spark, part, 10_000 * DAY_MS, path=wire, keyed=False)
        run_live(spark, wire, tables, f"{tables.root}/checkpoint", UNKEYED_RULES, files_per_batch=1 << 20)
    return tables.read("segments").select("user_id", "partition", "seq", "event_time", "f", "m", "r_minutes")


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver query: epoch marks and window entries read out of the stream's state store."""
    wire = write_wire_slices(spark, events_transactions(spark, sf_dir))
    checkpoint = scratch_path(spark, "segments-ckpt")
    run_available(spark, segments_stream(wire_stream(spark, wire), SCALED_RULES), "segments", checkpoint=checkpoint)
    marks, entries = exported_state(spark, checkpoint, SCALED_RULES.window_ms)
    return entries.join(marks, "user_id").select("user_id", "event_time", "seq", "units", "deposit", "first_ts", "last_ts")


#: Of every three transactions one goes to this user; a bucket is a quarter of a day.
HOT_USER, HOT_EVERY, HOT_BUCKET_MS = 1, 3, DAY_MS // 4


def hot_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, a third of them one user's."""
    hot = F.pmod("seq", F.lit(HOT_EVERY)) == 0
    return events_transactions(spark, sf_dir).withColumn("user_id", F.when(hot, F.lit(HOT_USER)).otherwise(F.col("user_id")))


def hot_user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver query: segments with the state in a table, so that one user's batch is many tasks' work."""
    tables = LiveTables(spark, scratch_path(spark, "live"))
    wire = write_wire_slices(spark, hot_transactions(spark, sf_dir), 2 * SLICE_MS)
    q = start(
        judged_transactions(wire_stream(spark, wire)),
        BatchFanout([TableState(tables, SCALED_RULES, HOT_BUCKET_MS).write], name="table-state"),
        f"{tables.root}/checkpoint",
        f"table_state_{abs(hash(tables.root)) % 10**8}",
        {"availableNow": True},
    )
    q.awaitTermination()
    rows = tables.read("segments").withColumnRenamed("event_time", "updated_at")
    return rows.select("user_id", "seq", "segment", "r_minutes", "f", "m", "updated_at")
