"""Streaming queries (T1-T11): Kafka-shaped stream -> keyed state -> sinks.

``alerts_stream`` and ``segments_stream`` are one operator each. The live job
is one query for everything: one scan of the topic, one state and one
checkpoint, so alerts, segments, late rows and quarantine cover the same
offsets, and a ``BatchFanout`` writes them from one persisted micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txpulse.functions import constants as C
from txpulse.functions.columns import is_type
from txpulse.operators.rfm import RfmRules, rfm_detail
from txpulse.operators.snapshot import live_entries, live_headers, snapshot_from_detail
from txpulse.schemas import ALERT, SEGMENT
from txpulse.sources.ingest import judged_transactions, parse_transactions
from txpulse.session import checkpoint_root as checkpoint_root_of
from txpulse.sources.kafka import ALERTS_TOPIC, INPUT_TOPIC, SEGMENTS_TOPIC, from_offsets, kafka_offsets, kafka_stream
from txpulse.streaming.processors import LIVE, RFM_SEED, AnomalyProcessor, LiveProcessor, RfmProcessor, ShardProcessor
from txpulse.streaming.sinks import BatchFanout, console_writer, kafka_writer, where_writer
from txpulse.streaming.tables import TABLES, LiveTables

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TIME_MODES = ("None", "EventTime", "ProcessingTime")


def use_rocksdb(spark: SparkSession) -> None:
    """transformWithState keeps its state in RocksDB; commit a change log per
    batch rather than a full snapshot (snapshots are taken in the background)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "") != ROCKSDB:
        spark.conf.set(key, ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


#: Keys of a stream's state; a checkpoint's first run fixes them.
SHARDS = 1024


def _sharded(rows: DataFrame) -> DataFrame:
    """Rows with the shard of their user, the key of the state (see ``ShardProcessor``)."""
    return rows.withColumn("shard", F.pmod(F.hash("user_id"), F.lit(SHARDS)))


def _seeds(seed: DataFrame | None):
    return _sharded(seed).groupBy("shard") if seed is not None else None


def _keyed(kafka_df: DataFrame, time_mode: str, watermark: str | None) -> DataFrame:
    if time_mode not in TIME_MODES:
        raise ValueError(f"time_mode must be one of {TIME_MODES}")
    clean, _ = parse_transactions(kafka_df)
    if time_mode == "EventTime":
        if not watermark:
            # rows behind the watermark are dropped; how late rows may come is the caller's to say
            raise ValueError("EventTime mode needs a watermark, e.g. '1 hour'")
        clean = clean.withColumn("event_ts", F.timestamp_millis("event_time")).withWatermark("event_ts", watermark)
    return clean


def alerts_stream(
    kafka_df: DataFrame,
    window_ms: int = C.ANOMALY_WINDOW_MS,
    factor: float = C.ANOMALY_FACTOR,
    time_mode: str = "None",
    watermark: str | None = None,
) -> DataFrame:
    """Streaming alerts (T1) with ALERT schema; EventTime mode expires idle users."""
    use_rocksdb(kafka_df.sparkSession)
    ttl = window_ms if time_mode == "ProcessingTime" else None
    proc = AnomalyProcessor(window_ms, factor, timers=time_mode == "EventTime", ttl_ms=ttl)
    return (
        _sharded(_keyed(kafka_df, time_mode, watermark))
        .groupBy("shard")
        .transformWithStateInPandas(ShardProcessor(proc), ALERT, "Append", time_mode)
    )


def segments_stream(
    kafka_df: DataFrame,
    rules: RfmRules = RfmRules(),
    time_mode: str = "None",
    watermark: str | None = None,
    seed: DataFrame | None = None,
) -> DataFrame:
    """Streaming RFM segments (T2); ``seed`` (see ``seed_frame``) restores state (S3, T5)."""
    use_rocksdb(kafka_df.sparkSession)
    ttl = rules.retention_ms if time_mode == "ProcessingTime" else None
    proc = RfmProcessor(rules, timers=time_mode == "EventTime", ttl_ms=ttl)
    return (
        _sharded(_keyed(kafka_df, time_mode, watermark))
        .groupBy("shard")
        .transformWithStateInPandas(ShardProcessor(proc), SEGMENT, "Append", time_mode, initialState=_seeds(seed))
    )


def rejects_stream(kafka_df: DataFrame) -> DataFrame:
    """Quarantined records (D4) of a Kafka-shaped stream: stateless, append only."""
    return parse_transactions(kafka_df)[1]


def seed_frame(headers: DataFrame, entries: DataFrame) -> DataFrame:
    """Snapshot headers + entries as one initial-state frame for ``RfmProcessor``."""
    h = headers.select(
        F.col("user_id").cast("int"),
        F.lit(True).alias("is_header"),
        F.col("last_ts").alias("event_time"),
        F.col("last_seq").alias("seq"),
        F.lit(None).cast("double").alias("sum"),
        F.lit(None).cast("string").alias("type"),
        "first_ts",
        F.lit(0).alias("partition"),
    )
    e = entries.select(
        F.col("user_id").cast("int"),
        F.lit(False).alias("is_header"),
        "event_time",
        "seq",
        "sum",
        "type",
        F.lit(None).cast("long").alias("first_ts"),
        F.lit(0).alias("partition"),
    )
    out = h.unionByName(e)
    assert [f.name for f in out.schema] == [c.split()[0] for c in RFM_SEED.split(", ")]
    return out


def restore_seed(transactions: DataFrame, rules: RfmRules = RfmRules(), as_of: int | None = None) -> DataFrame:
    """Initial state (S3, T5) from the table of clean transactions that the live job appends.

    The batch operator works out each user's epoch start and trailing window,
    so a lost checkpoint loses nothing; users expired at ``as_of`` stay out.
    """
    headers, entries = snapshot_from_detail(rfm_detail(transactions, rules))
    return seed_frame(live_headers(headers, as_of), live_entries(entries, as_of))


def _timed_by_clock(events: DataFrame) -> bool:
    return ", ProcessingTime," in events._jdf.queryExecution().logical().toString()


def start(
    events: DataFrame,
    sink: BatchFanout,
    checkpoint: str,
    name: str,
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start one named query; ``trigger`` e.g. {"availableNow": True} or {"processingTime": "10 seconds"}.

    The state store has one partition per shuffle partition, fixed by the
    checkpoint's first run; it is set here explicitly (default: the cluster's
    parallelism) rather than inherited from whatever the session holds. A
    restarted query keeps the count recorded in its checkpoint.
    """
    spark = events.sparkSession
    if trigger and trigger.get("availableNow") and _timed_by_clock(events):
        # its timers ask for one more batch for ever, so such a query never ends by itself
        raise ValueError("ProcessingTime mode needs a processingTime trigger")
    key = "spark.sql.shuffle.partitions"
    n = state_partitions or spark.sparkContext.defaultParallelism
    writer = events.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if trigger:
        writer = writer.trigger(**trigger)
    previous = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        return writer.start()  # the query runs on a copy of the session taken here
    finally:
        spark.conf.set(key, previous)


class ProgressLog(StreamingQueryListener):
    """Per-batch metrics of every query (T11): rows in, batch time, state size.

    Keeps the most recent entries only; the driver never accumulates history.
    """

    def __init__(self, keep: int = 512):
        from collections import deque

        self.events: deque[dict] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators[0] if p.stateOperators else None
        self.events.append(
            {
                "name": p.name,
                "batch_id": p.batchId,
                "input_rows": p.numInputRows,
                "batch_ms": p.durationMs.get("triggerExecution"),
                "state_rows": state.numRowsTotal if state else None,
                "state_commit_ms": state.commitTimeMs if state else None,
            }
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_all(spark: SparkSession, queries: list[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Block until every query has ended (T7). If one fails, the others are stopped and its failure is raised."""
    while True:
        failed = next((q for q in queries if not q.isActive and q.exception() is not None), None)
        if failed is not None:
            for q in queries:
                if q.isActive:
                    q.stop()  # waits for the running batch to end
            raise failed.exception()
        active = [q for q in queries if q.isActive]
        if not active:
            return
        active[0].awaitTermination(poll_seconds)


#: How late rows may come, and how far ahead of its record a time may lie, unless the caller says otherwise.
LIVE_DELAY_MS = 3_600_000
LIVE_AHEAD_MS = 86_400_000


def live_stream(
    kafka_df: DataFrame,
    rules: RfmRules = RfmRules(),
    anomaly_window_ms: int = C.ANOMALY_WINDOW_MS,
    delay_ms: int = LIVE_DELAY_MS,
    ahead_ms: int | None = LIVE_AHEAD_MS,
    seed: DataFrame | None = None,
) -> DataFrame:
    """All rows of the live job, by ``kind`` (see ``LiveProcessor``; ``reject``: quarantined records).

    Expiry is by event time: a user's state goes once the watermark, the newest
    time less ``delay_ms``, passes the retention, however long the job stood
    still. Rows behind the watermark come out as ``late``. Every record of the
    source leaves exactly one ``segment``, ``late`` or ``reject`` row. Row counts
    by kind are observed under the name ``live`` (K4, A8, T11).
    """
    use_rocksdb(kafka_df.sparkSession)
    judged = judged_transactions(kafka_df, ahead_ms)
    columns = ("user_id", "type", "sum", "event_time", "seq", "partition")
    clean = judged.where(F.col("reason").isNull())
    timed = clean.withColumn("ts", F.timestamp_millis("event_time")).withWatermark("ts", f"{delay_ms} milliseconds")
    out = (
        _sharded(timed.select(*columns))  # without the time column nothing is dropped on the way to the operator
        .groupBy("shard")
        .transformWithStateInPandas(
            ShardProcessor(LiveProcessor(rules, anomaly_window_ms)),
            ", ".join(f"{c} {t}" for c, t in LIVE.items()),
            "Append",
            "EventTime",
            initialState=_seeds(seed),
        )
    )
    rejects = judged.where(F.col("reason").isNotNull()).select(
        F.lit("reject").alias("kind"), "partition", "seq", "reason", "malformed", "raw"
    )
    rows = out.unionByName(rejects, allowMissingColumns=True)
    counted = [F.count_if(F.col("kind") == k).alias(k) for k in TABLES]
    kinds = [F.count_if((F.col("kind") == "segment") & is_type("type", t)).alias(t.lower()) for t in (C.CREDIT, C.DEPOSIT)]
    return rows.observe("live", *counted, *kinds, F.max("event_time").alias("max_time"))


def live_metrics(query: StreamingQuery) -> list[dict]:
    """Observed counts of the recent batches that had rows."""
    seen = [(p.batchId, p.observedMetrics.get("live")) for p in query.recentProgress]
    return [{"batch_id": b, **m.asDict()} for b, m in seen if m is not None and any(m[k] for k in TABLES)]


def start_live(
    spark: SparkSession,
    bootstrap_servers: str,
    input_topic: str = INPUT_TOPIC,
    alerts_topic: str = ALERTS_TOPIC,
    segments_topic: str = SEGMENTS_TOPIC,
    root: str | None = None,
    trigger: dict | None = None,
    console_rows: int = 0,
    max_offsets_per_trigger: int | None = None,
    state_partitions: int | None = None,
    delay_ms: int = LIVE_DELAY_MS,
    restore: bool = False,
    topic_partitions: int | None = None,
    sample_rows: int = 10,
    rules: RfmRules = RfmRules(),
) -> StreamingQuery:
    """The live query: Kafka in, alerts and segments to Kafka, tables (``LiveTables`` under ``root``), console echo.

    A new job starts at the newest offsets. With ``restore``, and a lost
    checkpoint, it goes on from the last commit record: the state from the
    tables, the topic from the record's offsets.
    """
    if state_partitions is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("state_partitions is fixed by the first start; set it on a cluster")
    root = root or f"{checkpoint_root_of(spark)}/live"
    tables = LiveTables(spark, root)
    seed, offsets = None, {}
    if restore:
        offsets = restored_offsets(tables)
        seed = tables.seed(rules.window_ms, delay_ms)
    source = kafka_stream(
        spark, bootstrap_servers, input_topic,
        starting_offsets=kafka_offsets(input_topic, offsets, topic_partitions) if offsets else "latest",
        max_offsets_per_trigger=max_offsets_per_trigger,
    )
    writers = [
        where_writer("kind = 'alert'", ("user_id", *C.ALERT_FIELDS[:-1]), kafka_writer(bootstrap_servers, alerts_topic, C.ALERT_FIELDS)),
        where_writer(
            "kind = 'segment'", ("user_id", "f", "m", "r_minutes", "segment", "event_time"),
            lambda b, i: kafka_writer(bootstrap_servers, segments_topic, C.SEGMENT_FIELDS)(
                b.withColumnRenamed("event_time", "updated_at"), i
            ),
        ),
    ]
    if console_rows:
        writers.append(console_writer(console_rows))
    sink = BatchFanout([*writers, tables.write], name="live", sample_rows=sample_rows, per_key=sample_rows > 0)
    # a restored job is a new run: its checkpoint lies beside the lost one's place
    run = (tables.last() or {"number": 0})["number"] if restore else 0
    events = live_stream(from_offsets(source, offsets), rules, delay_ms=delay_ms, seed=seed)
    return start(events, sink, f"{root}/checkpoint-{run}", "live", trigger, state_partitions)


def restored_offsets(tables: LiveTables) -> dict[int, int]:
    """The next offset of each source partition after the last commit."""
    last = tables.last()
    return {int(p): n for p, n in (last or {"offsets": {}})["offsets"].items()}


def main(argv: list[str] | None = None) -> None:
    import argparse

    from txpulse.session import build_session

    ap = argparse.ArgumentParser(description="Live anomaly alerts and RFM segments from Kafka")
    ap.add_argument("--bootstrap-servers", required=True)
    ap.add_argument("--input-topic", default=INPUT_TOPIC)
    ap.add_argument("--alerts-topic", default=ALERTS_TOPIC)
    ap.add_argument("--segments-topic", default=SEGMENTS_TOPIC)
    ap.add_argument("--root", default=None, help="shared folder of the tables and checkpoint; default: under spark.checkpoint.dir")
    ap.add_argument("--trigger-seconds", type=int, default=10, help="0 = as fast as possible")
    ap.add_argument("--console-rows", type=int, default=0)
    ap.add_argument("--max-offsets-per-trigger", type=int, default=None)
    ap.add_argument("--state-partitions", type=int, default=None, help="fixed at the first start; needed on a cluster")
    ap.add_argument("--delay-seconds", type=int, default=LIVE_DELAY_MS // 1000, help="how late rows may come before they go to the table of late rows")
    ap.add_argument("--restore", action="store_true", help="go on from the tables' last commit, with a new checkpoint")
    ap.add_argument("--topic-partitions", type=int, default=None, help="partitions of the input topic, needed with --restore")
    ap.add_argument("--sample-rows", type=int, default=10, help="rows and busiest users logged a batch; 0: none")
    a = ap.parse_args(argv)
    spark = build_session()
    spark.streams.addListener(ProgressLog())
    query = start_live(
        spark,
        a.bootstrap_servers,
        a.input_topic,
        a.alerts_topic,
        a.segments_topic,
        a.root,
        {"processingTime": f"{a.trigger_seconds} seconds"} if a.trigger_seconds else None,
        a.console_rows,
        a.max_offsets_per_trigger,
        a.state_partitions,
        a.delay_seconds * 1000,
        a.restore,
        a.topic_partitions,
        a.sample_rows,
    )
    run_all(spark, [query])


if __name__ == "__main__":
    main()
