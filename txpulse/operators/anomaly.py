"""Anomaly alerts, batch form.

For each transaction: the mean amount of the same user's transactions in the
trailing ``window_ms`` (all types, the row itself and later rows excluded).
An alert is a Credit whose amount is at least ``factor`` times a positive mean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txpulse.functions import constants as C
from txpulse.functions.columns import alert_message, anomaly_condition, mean_from_units, to_units
from txpulse.operators.windows import BUCKET, COPY, TimeSplit, bucket_width, hot_groups, time_bucket, width_for_hottest

MEASURES = {"prior_n": None, "prior_units": "units"}  # None counts rows


def rolling_avg_check(
    tx: DataFrame,
    window_ms: int = C.ANOMALY_WINDOW_MS,
    bucket_ms: int | str | None = "auto",
) -> DataFrame:
    """Per transaction: prior_n, prior_units and avg_check_5min over the trailing window.

    Output: user_id, event_time, seq, type, sum, units, prior_n, prior_units,
    avg_check_5min (0.0 when the window is empty). A row without a user or a
    time has no window: it is kept, with nulls.
    """
    if bucket_ms == "auto":
        width = bucket_width(window_ms)
        counts = tx.groupBy("user_id", time_bucket("event_time", width).alias("_b")).agg(F.count("*").alias("n"))
        hot, hottest = hot_groups(counts.where("_b IS NOT NULL"), "user_id", "n")
        if hottest is None:
            return rolling_avg_check(tx, window_ms, width)
        hot = hot.checkpoint()
        narrow = width_for_hottest(hottest, window_ms)
        rest = rolling_avg_check(tx.join(hot, "user_id", "left_anti"), window_ms, width)
        return rest.unionByName(rolling_avg_check(tx.join(hot, "user_id", "left_semi"), window_ms, narrow))
    rows = tx.select("user_id", "type", "sum", "event_time", "seq", to_units("sum").alias("units"))
    width = bucket_width(window_ms, bucket_ms)
    split = TimeSplit(window_ms, width)
    totals = split.totals("user_id", "seq", include_current=False, measures=MEASURES)
    stats = (
        split.split(rows, "event_time")
        .select(*rows.columns, BUCKET, COPY, *[c.alias(n) for n, c in totals.items()])
        .where(~F.col(COPY))
    )
    if split.narrow:
        # whole buckets between the frame's two ends, from a small summary on the same keys
        summary = rows.groupBy("user_id", time_bucket("event_time", width).alias(BUCKET)).agg(
            *split.bucket_sums(MEASURES)
        )
        between = split.between("user_id", MEASURES)
        summary = summary.select("user_id", BUCKET, *[c.alias(f"_between_{n}") for n, c in between.items()])
        stats = stats.join(summary.hint("merge"), on=["user_id", BUCKET], how="left").select(
            *rows.columns, *[(F.col(n) + F.col(f"_between_{n}")).alias(n) for n in MEASURES]
        )
    keyed = F.col("user_id").isNotNull() & F.col("event_time").isNotNull()

    def known(c):
        return F.when(keyed, c)

    return stats.select(
        *rows.columns,
        known(F.col("prior_n")).alias("prior_n"),
        known(F.col("prior_units")).alias("prior_units"),
        known(mean_from_units(F.col("prior_units"), F.col("prior_n"))).alias("avg_check_5min"),
    )


def anomaly_alerts(
    tx: DataFrame,
    window_ms: int = C.ANOMALY_WINDOW_MS,
    factor: float = C.ANOMALY_FACTOR,
    bucket_ms: int | str | None = "auto",
) -> DataFrame:
    """Alert rows: user_id, event_time, seq, type (as sent), sum, avg_check_5min, message."""
    checked = rolling_avg_check(tx, window_ms, bucket_ms)
    hit = anomaly_condition(
        F.col("type"), F.col("units"), F.col("prior_units"), F.col("prior_n"), factor
    )
    return checked.where(hit).select(
        "user_id",
        "event_time",
        "seq",
        "type",
        "sum",
        "avg_check_5min",
        F.lit(alert_message(factor)).alias("message"),
    )
