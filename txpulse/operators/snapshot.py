"""Keyed RFM snapshot with expiry (K5, A9, T5) and restore (S3).

The reference mirrors each user's state to a key-value store with a 7-day
expiry and restores from it. Here the snapshot is two tables written to the
shared checkpoint folder:

* headers: one row per user (first_ts, last_ts, f, m, ..., expires_at);
* entries: one row per buffered transaction of the trailing window.

Entries are rows, not an array column, so no user's buffer is ever gathered
into one value. ``merge_snapshot`` upserts a new snapshot into an old one
(newest ``last_ts`` per user wins, expired users drop out), idempotently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txpulse.functions import constants as C


SNAPSHOT_COLUMNS = (
    "user_id", "event_time", "seq", "sum", "type", "first_ts", "f", "m", "r_minutes", "segment", "is_last", "in_tail",
    "user_last_ts",
)


def snapshot_rows(detail: DataFrame) -> DataFrame:
    """The rows a snapshot needs - each user's last row and trailing window - in one table.

    Written once, it yields both views below without recomputing the detail.
    """
    return detail.where(F.col("is_last") | F.col("in_tail")).select(*SNAPSHOT_COLUMNS)


def headers_of(rows: DataFrame, ttl_ms: int = C.SNAPSHOT_TTL_MS) -> DataFrame:
    """One header per user; ``written_at`` is the event time of the write, so expiry is replayable."""
    return rows.where(F.col("is_last")).select(
        "user_id",
        "first_ts",
        F.col("event_time").alias("last_ts"),
        F.col("seq").alias("last_seq"),
        "f",
        "m",
        "r_minutes",
        "segment",
        F.col("event_time").alias("written_at"),
        (F.col("event_time") + F.lit(ttl_ms)).alias("expires_at"),
    )


def entries_of(rows: DataFrame, ttl_ms: int = C.SNAPSHOT_TTL_MS) -> DataFrame:
    """Trailing-window entries; each carries its user's expiry, so liveness is a filter."""
    return rows.where(F.col("in_tail")).select(
        "user_id", "event_time", "seq", "sum", "type", (F.col("user_last_ts") + F.lit(ttl_ms)).alias("expires_at")
    )


def snapshot_from_detail(detail: DataFrame, ttl_ms: int = C.SNAPSHOT_TTL_MS) -> tuple[DataFrame, DataFrame]:
    """(headers, entries) of the state after each user's last transaction."""
    rows = snapshot_rows(detail)
    return headers_of(rows, ttl_ms), entries_of(rows, ttl_ms)


def live_headers(headers: DataFrame, as_of: int | None) -> DataFrame:
    """Headers not yet expired at ``as_of`` (epoch ms); all when None."""
    if as_of is None:
        return headers
    return headers.where(F.col("expires_at") > F.lit(as_of))


def live_entries(entries: DataFrame, as_of: int | None) -> DataFrame:
    """Entries of users whose snapshot has not expired at ``as_of``."""
    if as_of is None:
        return entries
    return entries.where(F.col("expires_at") > F.lit(as_of))


def merge_snapshot(
    old_headers: DataFrame,
    old_entries: DataFrame,
    new_headers: DataFrame,
    new_entries: DataFrame,
    as_of: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Upsert: per user the header with the newest (last_ts, last_seq) wins.

    A user's entries come from the same side as the winning header. Re-running
    the same batch gives the same result (the newest header is unchanged).
    """
    tagged = old_headers.withColumn("_side", F.lit(0)).unionByName(new_headers.withColumn("_side", F.lit(1)))
    whole = F.struct(*[c for c in tagged.columns if c != "user_id"])
    newest = F.max_by(whole, F.struct("last_ts", "last_seq", "_side"))
    heads = live_headers(tagged.groupBy("user_id").agg(newest.alias("_w")).select("user_id", "_w.*"), as_of)
    ents = old_entries.withColumn("_side", F.lit(0)).unionByName(new_entries.withColumn("_side", F.lit(1)))
    ents = ents.join(heads.select("user_id", "_side"), on=["user_id", "_side"], how="left_semi").drop("_side")
    return heads.drop("_side"), ents
