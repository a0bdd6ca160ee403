"""The live job: one query, committed tables, restore from offsets, expiry, metrics, supervision."""

import json
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_stream import same
from txpulse.functions import constants as C
from txpulse.operators.rfm import SCALED_RULES, RfmRules, rfm_segments
from txpulse.session import scratch_path
from txpulse.sources.events import events_transactions
from txpulse.sources.kafka import from_offsets, kafka_offsets, transactions_as_kafka
from txpulse.streaming.app import alerts_stream, live_stream, run_all, segments_stream, start
from txpulse.streaming.export import state_seed
from txpulse.streaming.replay import SLICE_MS, replay_restart, run_available, run_live, wire_stream, write_wire_slices
from txpulse.streaming.sinks import BatchFanout
from txpulse.streaming.tables import LiveTables, SharedFiles

DAY = 86_400_000
ROW = (
    "kind string, user_id int, partition int, seq long, type string, sum double, event_time long, avg_check_5min double, "
    "message string, segment string, r_minutes double, f long, m double, first_ts long, reason string, malformed boolean, raw string"
)


def segment(user, seq, t, partition=0):
    return ("segment", user, partition, seq, "Deposit", 1.0, t, None, None, "VIP", 0.0, 1, 1.0, t, None, None, None)


def reject(seq, partition=0):
    return ("reject", None, partition, seq, None, None, None, None, None, None, None, None, None, None, "null_sum", True, "{}")


def rows(spark, *items):
    return spark.createDataFrame(list(items), ROW)


@pytest.fixture
def tables(spark):
    return LiveTables(spark, scratch_path(spark, "live-test"), snapshot_every=2, ttl_ms=100)


def test_a_record_is_created_once(spark):
    files, path = SharedFiles(spark), scratch_path(spark, "files")
    files.create(f"{path}/a.json", "é1")
    with pytest.raises(Exception, match="exists"):
        files.create(f"{path}/a.json", "2")
    assert files.text(f"{path}/a.json") == "é1"
    assert files.names(f"{path}/nowhere") == []


def test_batches_are_seen_once_committed(spark, tables):
    assert tables.last() is None and tables.read("segments").count() == 0 and tables.current().count() == 0
    tables.commit_batch(rows(spark, segment(1, 0, 10), reject(1), segment(2, 7, 20, partition=3)), "run-a", 0)
    assert tables.last()["offsets"] == {"0": 2, "3": 8}
    tables.commit_batch(rows(spark, segment(1, 0, 10)), "run-a", 0)  # tried again after its commit: skipped
    assert tables.read("segments").count() == 2 and tables.read("quarantine").count() == 1
    # a batch whose commit never came is not seen, and its second try replaces it
    rows(spark, segment(9, 9, 9)).select("user_id", "partition", "seq").write.parquet(f"{tables.root}/segments/run_id=run-a/batch_id=1")
    assert tables.read("segments").count() == 2
    tables.commit_batch(rows(spark, segment(1, 2, 30)), "run-a", 1)
    assert sorted(r.seq for r in tables.read("segments").collect()) == [0, 2, 7]
    # a new run begins with batch 0 again, beside the old one
    tables.commit_batch(rows(spark, segment(2, 8, 40, partition=3)), "run-b", 0)
    assert sorted(r.seq for r in tables.read("segments").collect()) == [0, 2, 7, 8]
    assert tables.last()["number"] == 3 and tables.last()["offsets"] == {"0": 3, "3": 9}
    assert {r.number: r.rows for r in tables.commits().collect()} == {1: {"segment": 2, "reject": 1}, 2: {"segment": 1}, 3: {"segment": 1}}


def test_of_two_jobs_on_one_folder_the_second_fails(spark, tables):
    other = LiveTables(spark, tables.root)
    first = other.last  # both saw the folder before either committed
    tables.commit_batch(rows(spark, segment(1, 0, 10)), "run-a", 0)
    other.last = lambda: None
    with pytest.raises(Exception, match="exists"):
        other.commit_batch(rows(spark, segment(1, 0, 10)), "run-b", 0)
    other.last = first
    assert tables.read("segments").count() == 1


def test_the_snapshot_follows_live_users(spark, tables):
    def users():
        return {(r.user_id, r.last_ts) for r in tables.current().collect()}

    tables.commit_batch(rows(spark, segment(1, 0, 10), segment(2, 1, 20)), "r", 0)
    assert tables.last()["snapshot"] == 0 and users() == {(1, 10), (2, 20)}
    tables.commit_batch(rows(spark, segment(1, 2, 50)), "r", 1)
    assert tables.last()["snapshot"] == 2 and users() == {(1, 50), (2, 20)}
    tables.commit_batch(rows(spark, segment(3, 3, 140)), "r", 2)  # user 2 is idle for over 100
    assert users() == {(1, 50), (3, 140)}
    tables.commit_batch(rows(spark, segment(3, 4, 141)), "r", 3)
    stored = tables.spark.read.parquet(f"{tables.root}/current/number=4")
    assert {r.user_id for r in stored.collect()} == {1, 3}  # the expired user left the table
    for k in range(4, 8):
        tables.commit_batch(rows(spark, segment(3, k + 1, 141 + k)), "r", k)
    assert SharedFiles(spark).names(f"{tables.root}/current") == ["number=6", "number=8"]
    assert users() == {(1, 50), (3, 148)}


def test_the_seed_holds_what_the_state_would(spark, tables):
    tables.commit_batch(rows(spark, segment(1, 0, 10), segment(1, 1, 25), segment(2, 2, 30)), "r", 0)
    tables.commit_batch(rows(spark, segment(1, 3, 40), ("expired", 2, *[None] * 4, 30, *[None] * 10)), "r", 1)
    seed = [tuple(r[:4]) for r in tables.seed(window_ms=15, delay_ms=0).collect()]
    assert sorted(seed) == [(1, False, 25, 1), (1, False, 40, 3), (1, True, 40, 3)]
    assert (1, False, 10, 0) in {tuple(r[:4]) for r in tables.seed(window_ms=15, delay_ms=20).collect()}


def test_offsets_of_a_topic():
    assert json.loads(kafka_offsets("t", {0: 5, 2: 7}, 4)) == {"t": {"0": 5, "1": -2, "2": 7, "3": -2}}
    with pytest.raises(ValueError):
        kafka_offsets("t", {0: 5})


def test_from_offsets_keeps_what_is_new(spark):
    df = spark.createDataFrame([(0, 4), (0, 5), (1, 1), (2, 0)], "partition int, offset long")
    assert sorted(map(tuple, from_offsets(df, {0: 5, 2: 1}).collect())) == [(0, 5), (1, 1)]
    assert from_offsets(df, {}) is df


def test_restart_on_the_same_folder(spark):
    tx = events_transactions(spark, SF_SMALL)
    tables = replay_restart(spark, tx, SCALED_RULES)
    got = tables.read("segments").withColumnRenamed("event_time", "updated_at")
    same(got.select("user_id", "seq", "segment", "r_minutes", "f", "m", "updated_at"), rfm_segments(tx, SCALED_RULES))
    keep = ["user_id", "seq", "type", "sum", "event_time"]
    same(tables.transactions().select(*keep), tx.select(*keep))
    # both runs left folders, and the batch that died one more than was committed
    runs = SharedFiles(spark).names(f"{tables.root}/segments")
    folders = sum(len(SharedFiles(spark).names(f"{tables.root}/segments/{r}")) for r in runs)
    assert len(runs) == 2 and folders == tables.commits().where("rows['segment'] > 0").count() + 1


def test_a_restarted_checkpoint_goes_on(spark):
    tx = events_transactions(spark, SF_SMALL)
    t = tx.agg(F.percentile("event_time", 0.5).cast("long")).first()[0]
    tables = LiveTables(spark, scratch_path(spark, "live"))
    wire = write_wire_slices(spark, tx.where(F.col("event_time") < t), SLICE_MS)
    run_live(spark, wire, tables, f"{tables.root}/checkpoint", SCALED_RULES)
    n = tables.last()["number"]
    run_live(spark, wire, tables, f"{tables.root}/checkpoint", SCALED_RULES)
    assert tables.last()["number"] == n  # nothing new: no batch, no commit
    write_wire_slices(spark, tx.where(F.col("event_time") >= t), SLICE_MS, path=wire)
    run_live(spark, wire, tables, f"{tables.root}/checkpoint", SCALED_RULES)
    got = tables.read("segments").withColumnRenamed("event_time", "updated_at")
    same(got.select("user_id", "seq", "segment", "r_minutes", "f", "m", "updated_at"), rfm_segments(tx, SCALED_RULES))


def test_a_new_query_takes_over_exported_state(spark):
    tx = events_transactions(spark, SF_SMALL)
    rules = RfmRules(recency="gap")
    t = tx.agg(F.percentile("event_time", 0.5).cast("long")).first()[0]
    checkpoint = scratch_path(spark, "old")
    wire = write_wire_slices(spark, tx.where(F.col("event_time") < t))
    run_available(spark, segments_stream(wire_stream(spark, wire), rules), "segments", checkpoint=checkpoint)
    seed = state_seed(spark, checkpoint, rules.window_ms)
    path = scratch_path(spark, "seed")
    seed.write.parquet(path)
    rest = write_wire_slices(spark, tx.where(F.col("event_time") >= t))
    resumed = run_available(spark, segments_stream(wire_stream(spark, rest), rules, seed=spark.read.schema(seed.schema).parquet(path)), "segments")
    same(resumed, rfm_segments(tx, rules).where(F.col("updated_at") >= t))


def test_a_time_far_ahead_is_quarantined(spark):
    tx = events_transactions(spark, SF_SMALL)
    ahead = F.when(F.col("seq") == 5, F.col("event_time") + 400 * DAY).otherwise(F.col("event_time"))
    wire = transactions_as_kafka(tx.withColumn("event_time", ahead))
    late = F.when(F.col("offset") == 5, F.timestamp_millis(F.unix_millis("timestamp") - 400 * DAY)).otherwise(F.col("timestamp"))
    path = scratch_path(spark, "wire")
    wire.withColumn("timestamp", late).write.parquet(path)
    tables = LiveTables(spark, scratch_path(spark, "live"))
    run_live(spark, path, tables, f"{tables.root}/checkpoint", SCALED_RULES)
    assert [(r.seq, r.reason) for r in tables.read("quarantine").collect()] == [(5, "event_time_ahead")]
    assert tables.last()["max_time"] < tx.agg(F.max("event_time")).first()[0] + DAY


def test_one_failing_query_stops_the_others(spark):
    path = write_wire_slices(spark, events_transactions(spark, SF_SMALL))

    def fail(batch, batch_id):
        raise RuntimeError("broken writer")

    good = start(
        alerts_stream(wire_stream(spark, path)), BatchFanout([], name="good"), scratch_path(spark, "good"), "good",
        {"processingTime": "1 second"}, state_partitions=2,
    )
    bad = start(
        segments_stream(wire_stream(spark, path)), BatchFanout([fail], name="bad"), scratch_path(spark, "bad"), "bad",
        {"processingTime": "1 second"}, state_partitions=2,
    )
    with pytest.raises(Exception, match="broken writer"):
        run_all(spark, [good, bad], poll_seconds=0.2)
    assert not good.isActive and good.exception() is None
    spark.streams.resetTerminated()


def test_an_empty_batch_reaches_no_writer(spark):
    calls = []
    sink = BatchFanout([lambda b, i: calls.append(i)])
    empty = spark.createDataFrame([], "user_id int")
    sink(empty, 0)
    assert calls == [] and sink.last_metrics["rows"] == 0


def test_processing_time_mode_ends(spark):
    path = write_wire_slices(spark, events_transactions(spark, SF_SMALL).limit(20))
    with pytest.raises(ValueError, match="ProcessingTime"):
        start(
            alerts_stream(wire_stream(spark, path), time_mode="ProcessingTime"), BatchFanout([]), scratch_path(spark, "ck"), "p",
            {"availableNow": True},
        )
    batches = []
    q = start(
        alerts_stream(wire_stream(spark, path), time_mode="ProcessingTime"), BatchFanout([lambda b, i: batches.append(i)]),
        scratch_path(spark, "ck"), "p", {"processingTime": "1 second"},
    )
    until = time.time() + 20
    while q.isActive and len(q.recentProgress) < 4 and time.time() < until:
        time.sleep(0.5)
    q.stop()
    assert q.exception() is None and len(batches) <= 1  # the time-outs' empty batches write nothing


def test_live_needs_nested_windows(spark):
    stream = wire_stream(spark, write_wire_slices(spark, events_transactions(spark, SF_SMALL)))
    with pytest.raises(ValueError):
        live_stream(stream, anomaly_window_ms=C.RFM_WINDOW_MS * 2)


def test_a_hot_users_batch_is_many_tasks(spark):
    from txpulse.operators.windows import BUCKET, TimeSplit
    from txpulse.streaming.replay import HOT_BUCKET_MS, HOT_USER, hot_transactions

    tx = hot_transactions(spark, SF_SMALL)
    hot = tx.where(F.col("user_id") == HOT_USER)
    assert hot.count() >= tx.count() // 3
    split = TimeSplit(C.RFM_WINDOW_MS, HOT_BUCKET_MS).split(hot, "event_time")
    sizes = [r["count"] for r in split.groupBy(BUCKET).count().collect()]
    assert len(sizes) > 50 and max(sizes) < hot.count() // 10


def test_table_state_goes_on_after_a_lost_batch(spark):
    from txpulse.sources.ingest import judged_transactions
    from txpulse.streaming.table_state import TableState

    tx = events_transactions(spark, SF_SMALL)
    lo, hi = tx.agg(F.min("event_time"), F.max("event_time")).first()
    tables = LiveTables(spark, scratch_path(spark, "live"))
    sink = TableState(tables, SCALED_RULES)
    third = (hi - lo) // 3 + 1
    parts = [judged_transactions(transactions_as_kafka(tx.where(F.expr(f"(event_time - {lo}) div {third}") == k), corrupt=True)) for k in range(3)]
    sink.write_batch(parts[0], "run-a", 0)
    create, tables.files.create = tables.files.create, None  # the second batch dies at its commit
    with pytest.raises(TypeError):
        sink.write_batch(parts[1], "run-a", 1)
    tables.files.create = create
    sink.write_batch(parts[1], "run-a", 1)
    sink.write_batch(parts[1], "run-a", 1)  # tried again after its commit
    sink.write_batch(parts[2], "run-b", 0)  # a new run
    from txpulse.sources.ingest import parse_transactions

    clean, rejects = parse_transactions(transactions_as_kafka(tx, corrupt=True))
    got = tables.read("segments").withColumnRenamed("event_time", "updated_at")
    same(got.select("user_id", "seq", "segment", "r_minutes", "f", "m", "updated_at"), rfm_segments(clean, SCALED_RULES))
    assert tables.read("quarantine").count() == rejects.count()
    assert SharedFiles(spark).names(f"{tables.root}/state") == ["number=2", "number=3"]
