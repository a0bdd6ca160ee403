"""Streaming equals batch; restart from checkpoint and re-seed equal an uninterrupted run."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_compare import _rows
from txpulse.functions import constants as C
from txpulse.operators.anomaly import anomaly_alerts
from txpulse.operators.rfm import SCALED_RULES, RfmRules, rfm_detail, rfm_segments
from txpulse.operators.snapshot import snapshot_from_detail
from txpulse.plans.restore import split_time
from txpulse.session import scratch_path
from txpulse.sources.events import events_transactions
from txpulse.streaming.app import segments_stream, seed_frame
from txpulse.streaming.replay import (
    replay_alerts,
    replay_segments,
    run_available,
    wire_stream,
    write_wire_slices,
)
from txpulse.streaming.sinks import BatchFanout
from vectors import ANOMALY, RFM, frame

DAY = 86_400_000


def same(a, b):
    ra = sorted(_rows(a.columns, a.collect()), key=repr)
    rb = sorted(_rows(b.columns, b.collect()), key=repr)
    assert sorted(a.columns) == sorted(b.columns)
    assert ra == rb


def test_stream_equals_batch_on_vectors(spark):
    tx = frame(spark, ANOMALY)
    same(replay_alerts(spark, tx, slice_ms=60_000), anomaly_alerts(tx))
    tx = frame(spark, RFM)
    same(replay_segments(spark, tx, slice_ms=DAY // 2), rfm_segments(tx))


@pytest.mark.parametrize("time_mode", ["None", "EventTime"])
def test_stream_equals_batch_on_events(spark, time_mode):
    tx = events_transactions(spark, SF_SMALL)
    same(replay_alerts(spark, tx, window_ms=C.RFM_WINDOW_MS, time_mode=time_mode), anomaly_alerts(tx, C.RFM_WINDOW_MS))
    same(replay_segments(spark, tx, SCALED_RULES, time_mode=time_mode), rfm_segments(tx, SCALED_RULES))


@pytest.mark.parametrize("time_mode", ["None", "EventTime"])
def test_stream_equals_batch_across_idle_gaps(spark, time_mode):
    # every user idle for longer than the retention: state expires (EventTime
    # timers) and must still agree with the batch epochs
    tx = events_transactions(spark, SF_SMALL)
    stretched = tx.withColumn(
        "event_time", F.col("event_time") + (F.col("seq") % 3) * F.lit(3 * DAY) + F.expr("seq div 97") * F.lit(2 * DAY)
    )
    rules = RfmRules(retention_ms=DAY, recency="gap")
    same(
        replay_segments(spark, stretched, rules, time_mode=time_mode, slice_ms=6 * DAY),
        rfm_segments(stretched, rules),
    )


def test_restart_from_checkpoint_continues(spark):
    tx = events_transactions(spark, SF_SMALL)
    t = split_time(tx)
    path = write_wire_slices(spark, tx.where(F.col("event_time") < t))
    out, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    first = run_available(spark, segments_stream(wire_stream(spark, path), SCALED_RULES), "seg", out, ckpt)
    n_first = first.count()
    write_wire_slices(spark, tx.where(F.col("event_time") >= t), path=path)
    both = run_available(spark, segments_stream(wire_stream(spark, path), SCALED_RULES), "seg", out, ckpt)
    assert 0 < n_first < both.count()
    same(both, rfm_segments(tx, SCALED_RULES))


def test_reseed_from_snapshot(spark):
    tx = events_transactions(spark, SF_SMALL)
    rules = RfmRules(recency="gap")
    t = split_time(tx)
    headers, entries = snapshot_from_detail(rfm_detail(tx.where(F.col("event_time") < t), rules))
    rest = tx.where(F.col("event_time") >= t)
    resumed = replay_segments(spark, rest, rules, seed=seed_frame(headers, entries))
    expected = rfm_segments(tx, rules).where(F.col("updated_at") >= t)
    same(resumed, expected)


def test_fanout_runs_each_writer_once_per_batch(spark):
    calls = []
    tx = frame(spark, RFM)
    path = write_wire_slices(spark, tx, slice_ms=DAY // 2)
    sink = BatchFanout(
        [lambda b, i: calls.append(("a", i, b.count())), lambda b, i: calls.append(("b", i, b.count()))],
        name="t",
    )
    q = (
        segments_stream(wire_stream(spark, path, files_per_batch=1), RfmRules())
        .writeStream.option("checkpointLocation", scratch_path(spark, "ck"))
        .foreachBatch(sink)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    batches = sorted({i for _, i, _ in calls})
    assert len(batches) > 1
    for i in batches:
        assert [w for w, j, _ in calls if j == i] == ["a", "b"]
    assert sum(n for w, _, n in calls if w == "a") == len(RFM)
    assert sum(m["rows"] for m in sink.history) == len(RFM)  # observed counts match what was written


def test_reseed_with_event_time_timers(spark):
    tx = events_transactions(spark, SF_SMALL)
    rules = RfmRules(retention_ms=DAY, recency="gap")
    t = split_time(tx)
    headers, entries = snapshot_from_detail(rfm_detail(tx.where(F.col("event_time") < t), rules))
    rest = tx.where(F.col("event_time") >= t)
    resumed = replay_segments(spark, rest, rules, time_mode="EventTime", seed=seed_frame(headers, entries))
    same(resumed, rfm_segments(tx, rules).where(F.col("updated_at") >= t))


def test_stream_quarantine_equals_batch_rejects(spark):
    from txpulse.sources.ingest import parse_transactions
    from txpulse.sources.kafka import transactions_as_kafka
    from txpulse.streaming.app import rejects_stream

    tx = events_transactions(spark, SF_SMALL)
    path = write_wire_slices(spark, tx, corrupt=True)
    got = run_available(spark, rejects_stream(wire_stream(spark, path)), "quarantine")
    want = parse_transactions(transactions_as_kafka(tx, corrupt=True))[1]
    cols = ["offset", "reason", "malformed", "raw"]
    same(got.select(*cols), want.select(*cols))


def test_stream_typed_ingest_equals_batch(spark):
    from txpulse.sources.ingest import parse_typed_transactions
    from txpulse.sources.kafka import transactions_as_kafka

    tx = events_transactions(spark, SF_SMALL)
    path = write_wire_slices(spark, tx, corrupt=True)
    got = run_available(spark, parse_typed_transactions(wire_stream(spark, path))[0], "typed")
    want = parse_typed_transactions(transactions_as_kafka(tx, corrupt=True))[0]
    cols = ["offset", "user_id", "type", "sum"]
    same(got.select(*cols), want.select(*cols))
