"""Split run: compute to a split time, persist the snapshot, resume from it.

The snapshot is written as parquet under the shared checkpoint folder and
read back, so the resumed run depends on the written tables only (no lineage
back into the first half). Its output must equal the uninterrupted run's
rows at or after the split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpulse.operators.rfm import RfmRules, rfm_detail, rfm_segments
from txpulse.operators.snapshot import entries_of, headers_of, live_entries, live_headers, merge_snapshot, snapshot_rows
from txpulse.session import scratch_path


def write_snapshot(spark: SparkSession, detail: DataFrame, name: str = "rfm-snapshot"):
    """Write the snapshot rows once; return (headers, entries) read back from storage."""
    path = scratch_path(spark, name)
    snapshot_rows(detail).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    return headers_of(rows), entries_of(rows)


def split_time(tx: DataFrame) -> int:
    lo, hi = tx.agg(F.min("event_time"), F.max("event_time")).first()
    return (lo + hi) // 2


def split_and_upsert(spark: SparkSession, tx: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    """Headers after the split run's second snapshot is upserted into the first (K5)."""
    t_split = split_time(tx)
    old = write_snapshot(spark, rfm_detail(tx.where(F.col("event_time") < t_split), rules))
    live = [live(part, t_split) for live, part in zip((live_headers, live_entries), old, strict=True)]
    second = rfm_detail(
        tx.where(F.col("event_time") >= t_split), rules, seed_headers=live[0], seed_entries=live[1]
    )
    # a user whose last row is a seed row keeps the header of the first half
    new = write_snapshot(spark, second.withColumn("is_last", F.col("is_last") & F.col("_emit")))
    headers, _ = merge_snapshot(*old, *new)
    return headers.select("user_id", "last_ts", "last_seq", "first_ts", "f", "m", "segment", "expires_at")


def split_and_resume(spark: SparkSession, tx: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    t_split = split_time(tx)
    first = rfm_detail(tx.where(F.col("event_time") < t_split), rules)
    headers, entries = write_snapshot(spark, first)
    headers = live_headers(headers, t_split)
    entries = live_entries(entries, t_split)
    second = tx.where(F.col("event_time") >= t_split)
    return rfm_segments(second, rules, seed_headers=headers, seed_entries=entries)
