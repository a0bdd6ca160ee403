"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the generated tables (``events``, ``orders``) in full and
runs the library's operators over them; scalars such as a split time or an
as-of time are derived from the data with a single aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpulse.functions import constants as C
from txpulse.operators.anomaly import anomaly_alerts, rolling_avg_check
from txpulse.functions.envelope import alerts_to_kv, reparse_alert_kv, reparse_segment_kv, segments_to_kv
from txpulse.operators.rfm import SCALED_RULES, RfmRules, rfm_current, rfm_detail, rfm_segments
from txpulse.operators.snapshot import headers_of, live_headers
from txpulse.plans.restore import split_and_resume, split_and_upsert
from txpulse.sources.events import events_transactions, orders_transactions
from txpulse.sources.ingest import parse_transactions, parse_typed_transactions
from txpulse.sources.kafka import strained, transactions_as_kafka

DAY_MS = 86_400_000
YEAR_MS = 365 * DAY_MS

Query = Callable[[SparkSession, str], DataFrame]


def _wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as Kafka records, every 17th one damaged."""
    return transactions_as_kafka(events_transactions(spark, sf_dir), corrupt=True)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as they come back from undamaged Kafka records."""
    return parse_transactions(transactions_as_kafka(events_transactions(spark, sf_dir)))[0]


def q_tx_ingest(spark, sf_dir):
    return parse_transactions(_wire(spark, sf_dir))[0]


def q_tx_rejects(spark, sf_dir):
    rejects = parse_transactions(_wire(spark, sf_dir))[1]
    return rejects.select("offset", "reason", "malformed")


def q_tx_rejects_range(spark, sf_dir):
    """Rejects of a wire on which every 13th amount or time cannot be kept exactly."""
    rejects = parse_transactions(transactions_as_kafka(strained(events_transactions(spark, sf_dir))))[1]
    return rejects.select("offset", "reason", "malformed")


def q_tx_typed_ingest(spark, sf_dir):
    accepted = parse_typed_transactions(_wire(spark, sf_dir))[0]
    return accepted.select("offset", "user_id", "type", "sum")


def q_tx_typed_rejects(spark, sf_dir):
    rejects = parse_typed_transactions(_wire(spark, sf_dir))[1]
    return rejects.select("offset", "reason", "malformed")


def q_rolling_avg_check(spark, sf_dir):
    r = rolling_avg_check(events_transactions(spark, sf_dir))
    return r.select("user_id", "event_time", "seq", "prior_n", "avg_check_5min")


def q_rolling_avg_check_ties(spark, sf_dir):
    r = rolling_avg_check(orders_transactions(spark, sf_dir), window_ms=YEAR_MS)
    return r.select("user_id", "event_time", "seq", "prior_n", "avg_check_5min")


def q_anomaly_alerts(spark, sf_dir):
    return anomaly_alerts(_clean(spark, sf_dir))


def q_anomaly_alerts_24h(spark, sf_dir):
    return anomaly_alerts(events_transactions(spark, sf_dir), window_ms=C.RFM_WINDOW_MS)


def q_rfm_metrics(spark, sf_dir):
    d = rfm_detail(events_transactions(spark, sf_dir), RfmRules(recency="gap"))
    return d.select("user_id", "seq", "event_time", "f", "m", "first_ts", "prev_ts", "r_minutes")


def q_rfm_tenure(spark, sf_dir):
    """First-seen time and tenure under a 24-hour and a 7-day retention, in one pass."""
    d = rfm_detail(
        events_transactions(spark, sf_dir),
        RfmRules(retention_ms=C.RFM_WINDOW_MS),
        tenures={"first_ts_7d": C.SNAPSHOT_TTL_MS},
    )
    return d.select(
        "user_id",
        "seq",
        F.col("first_ts").alias("first_ts_24h"),
        "first_ts_7d",
        (F.col("event_time") - F.col("first_ts")).alias("tenure_24h_ms"),
        (F.col("event_time") - F.col("first_ts_7d")).alias("tenure_7d_ms"),
    )


def q_rfm_segments(spark, sf_dir):
    return rfm_segments(_clean(spark, sf_dir))


def q_rfm_segments_24h(spark, sf_dir):
    return rfm_segments(events_transactions(spark, sf_dir), RfmRules(retention_ms=C.RFM_WINDOW_MS))


def q_rfm_segments_scaled(spark, sf_dir):
    return rfm_segments(events_transactions(spark, sf_dir), SCALED_RULES)


def q_rfm_latest(spark, sf_dir):
    return rfm_current(events_transactions(spark, sf_dir), SCALED_RULES).select(
        "user_id",
        "seq",
        F.col("event_time").alias("updated_at"),
        "f",
        "m",
        "first_ts",
        "r_minutes",
        "segment",
    )


def _max_event_time(tx: DataFrame) -> int:
    return tx.agg(F.max("event_time")).first()[0]


def q_rfm_sleeping_asof(spark, sf_dir):
    """Each user as of the data's end: minutes since last, f/m over the window ending then."""
    tx = events_transactions(spark, sf_dir)
    now = rfm_current(tx, SCALED_RULES, as_of=_max_event_time(tx))
    return now.select("user_id", F.col("event_time").alias("last_ts"), "r_minutes", "f", "m", "segment")


def q_kv_retention(spark, sf_dir):
    """Snapshot headers still live 12 h before the last write's 7-day expiry."""
    tx = events_transactions(spark, sf_dir)
    as_of = _max_event_time(tx) + C.SNAPSHOT_TTL_MS - DAY_MS // 2
    rows = rfm_current(tx, RfmRules()).withColumn("is_last", F.lit(True))
    return live_headers(headers_of(rows), as_of).select("user_id", "last_ts", "f", "m", "segment", "expires_at")


def q_snapshot_upsert(spark, sf_dir):
    """Snapshot of the first half of the time, upserted with that of the resumed second half."""
    return split_and_upsert(spark, events_transactions(spark, sf_dir), SCALED_RULES)


def q_state_restore(spark, sf_dir):
    """Run to a split time, snapshot, then resume from the snapshot only."""
    return split_and_resume(spark, events_transactions(spark, sf_dir), SCALED_RULES)


def q_alerts_kv(spark, sf_dir):
    kv = alerts_to_kv(anomaly_alerts(events_transactions(spark, sf_dir), window_ms=C.RFM_WINDOW_MS))
    return reparse_alert_kv(kv)


def q_segments_kv(spark, sf_dir):
    kv = segments_to_kv(rfm_segments(events_transactions(spark, sf_dir), SCALED_RULES))
    return reparse_segment_kv(kv)


def q_batch_observe_counts(spark, sf_dir):
    """Per user and day (one replayed micro-batch per day): row and type counts."""
    tx = _clean(spark, sf_dir)
    return tx.groupBy("user_id", F.expr(f"event_time div {DAY_MS}").alias("batch_day")).agg(
        F.count(F.lit(1)).alias("n_tx"),
        F.count(F.when(F.lower("type") == "credit", 1)).alias("n_credit"),
        F.count(F.when(F.lower("type") == "deposit", 1)).alias("n_deposit"),
    )


def q_stream_anomaly(spark, sf_dir):
    from txpulse.streaming.replay import replay_anomaly

    return replay_anomaly(spark, sf_dir)


def q_stream_rfm(spark, sf_dir):
    from txpulse.streaming.replay import replay_rfm

    return replay_rfm(spark, sf_dir)


def q_stream_restore(spark, sf_dir):
    """Stream half of the time, lose every checkpoint, resume from the transaction table."""
    from txpulse.streaming.replay import replay_restored

    return replay_restored(spark, events_transactions(spark, sf_dir), SCALED_RULES)


def _replay(name: str) -> Query:
    def query(spark, sf_dir):
        from txpulse.streaming import replay

        return getattr(replay, name)(spark, sf_dir)

    return query


QUERIES: dict[str, Query] = {
    "tx_ingest": q_tx_ingest,
    "tx_rejects": q_tx_rejects,
    "tx_rejects_range": q_tx_rejects_range,
    "tx_typed_ingest": q_tx_typed_ingest,
    "tx_typed_rejects": q_tx_typed_rejects,
    "rolling_avg_check": q_rolling_avg_check,
    "rolling_avg_check_ties": q_rolling_avg_check_ties,
    "anomaly_alerts": q_anomaly_alerts,
    "anomaly_alerts_24h": q_anomaly_alerts_24h,
    "rfm_metrics": q_rfm_metrics,
    "rfm_tenure": q_rfm_tenure,
    "rfm_segments": q_rfm_segments,
    "rfm_segments_24h": q_rfm_segments_24h,
    "rfm_segments_scaled": q_rfm_segments_scaled,
    "rfm_latest": q_rfm_latest,
    "rfm_sleeping_asof": q_rfm_sleeping_asof,
    "kv_retention": q_kv_retention,
    "snapshot_upsert": q_snapshot_upsert,
    "state_restore": q_state_restore,
    "alerts_kv": q_alerts_kv,
    "segments_kv": q_segments_kv,
    "batch_observe_counts": q_batch_observe_counts,
    "stream_anomaly": q_stream_anomaly,
    "stream_rfm": q_stream_rfm,
    "stream_restore": q_stream_restore,
    "live_restart": _replay("restart_rows"),
    "live_accounting": _replay("accounting_rows"),
    "live_expiry": _replay("expiry_rows"),
    "live_current": _replay("current_rows"),
    "live_batch_metrics": _replay("metrics_rows"),
    "live_unkeyed": _replay("unkeyed_rows"),
    "live_hot_user": _replay("hot_user_rows"),
    "state_export": _replay("export_rows"),
}
