"""Keyed snapshot: newest state per user wins, expired users drop out, writes are idempotent."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from txpulse.functions import constants as C
from txpulse.operators.rfm import RfmRules, rfm_detail, rfm_latest
from txpulse.operators.snapshot import live_entries, live_headers, merge_snapshot, snapshot_from_detail
from txpulse.plans.restore import split_time
from txpulse.session import scratch_path
from txpulse.sources.events import events_transactions
from txpulse.streaming.sinks import latest_per_user, parquet_table_writer


def test_merge_equals_snapshot_of_whole_run(spark):
    tx = events_transactions(spark, SF_SMALL)
    rules = RfmRules()
    t = split_time(tx)
    h1, e1 = snapshot_from_detail(rfm_detail(tx.where(F.col("event_time") < t), rules))
    # second half seeded from the first snapshot, as a resumed run would be
    d2 = rfm_detail(tx.where(F.col("event_time") >= t), rules, seed_headers=h1, seed_entries=e1)
    h2, e2 = snapshot_from_detail(d2)
    heads, ents = merge_snapshot(h1, e1, h2, e2)
    full_h, full_e = snapshot_from_detail(rfm_detail(tx, rules))
    key = ["user_id", "last_ts", "last_seq", "first_ts", "f", "m", "segment", "expires_at"]
    assert sorted(map(tuple, heads.select(*key).collect())) == sorted(map(tuple, full_h.select(*key).collect()))
    ekey = ["user_id", "event_time", "seq"]
    assert sorted(map(tuple, ents.select(*ekey).collect())) == sorted(map(tuple, full_e.select(*ekey).collect()))
    # merging the same batch again changes nothing
    again_h, _ = merge_snapshot(heads, ents, h2, e2)
    assert again_h.count() == heads.count()


def test_expiry_is_a_filter(spark):
    tx = events_transactions(spark, SF_SMALL)
    h, e = snapshot_from_detail(rfm_detail(tx))
    last = h.agg(F.max("last_ts")).first()[0]
    as_of = last + C.SNAPSHOT_TTL_MS - 1
    live = live_headers(h, as_of)
    assert 0 < live.count() < h.count()
    kept = {r["user_id"] for r in live.collect()}
    assert {r["user_id"] for r in live_entries(e, as_of).collect()} == kept


def test_latest_per_user_of_the_segments_table(spark):
    tx = events_transactions(spark, SF_SMALL)
    detail = rfm_detail(tx)
    rows = detail.select("user_id", "seq", "segment", "r_minutes", "f", "m", F.col("event_time").alias("updated_at"))
    t = split_time(tx)
    path = scratch_path(spark, "segments")
    write = parquet_table_writer(path)
    write(rows.where(F.col("updated_at") < t), 0)
    write(rows.where(F.col("updated_at") >= t), 1)
    write(rows.where(F.col("updated_at") >= t), 1)  # a retried batch rewrites its own folder
    want = {r["user_id"]: (r["event_time"], r["f"], r["segment"]) for r in rfm_latest(detail).collect()}
    table = spark.read.schema(rows.schema).parquet(path)
    assert {r["user_id"]: (r["last_ts"], r["f"], r["segment"]) for r in latest_per_user(table).collect()} == want
    # another user's clock, far ahead, expires nobody: expiry is each user's own
    write(rows.limit(1).withColumns({"user_id": F.lit(-1), "updated_at": F.col("updated_at") + 8 * 86_400_000}), 2)
    snap = {r["user_id"]: r["expires_at"] for r in latest_per_user(spark.read.schema(rows.schema).parquet(path)).collect()}
    assert set(snap) == set(want) | {-1}
    assert all(snap[u] == want[u][0] + C.SNAPSHOT_TTL_MS for u in want)


def test_resume_from_snapshot_with_narrow_buckets(spark):
    tx = events_transactions(spark, SF_SMALL)
    rules = RfmRules(recency="gap")
    t = split_time(tx)
    narrow = 6 * 3_600_000  # 6 h buckets for a 24 h window
    h, e = snapshot_from_detail(rfm_detail(tx.where(F.col("event_time") < t), rules, bucket_ms=narrow))
    from txpulse.operators.rfm import rfm_segments

    resumed = rfm_segments(
        tx.where(F.col("event_time") >= t), rules, bucket_ms=narrow, seed_headers=h, seed_entries=e
    )
    full = rfm_segments(tx, rules, bucket_ms=narrow).where(F.col("updated_at") >= t)
    assert sorted(map(tuple, resumed.collect()), key=repr) == sorted(map(tuple, full.collect()), key=repr)
