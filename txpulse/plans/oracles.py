"""DuckDB SQL oracles, one per registered query, over the same parquet tables.

Written independently of the Spark plans: plain RANGE frames where the data
has no ties on (user, ms), a brute-force self join where it has (orders),
and LAG + running epoch numbers for tenure. Epoch milliseconds truncate the
microseconds (``epoch_us(ts) // 1000``), like the Spark side.
"""

from __future__ import annotations

class C:
    """The rules' values, written out anew: a wrong one in the engine must not pass here too."""

    CREDIT, DEPOSIT = "Credit", "Deposit"
    ANOMALY_FACTOR = 3
    ALERT_MESSAGE = "Credit >= 3 * avg_check_5min"
    ANOMALY_WINDOW_MS = 300_000
    RFM_WINDOW_MS = 86_400_000
    SNAPSHOT_TTL_MS = 604_800_000
    NEWCOMER_MS = 300_000
    VIP_MIN_M, VIP_MIN_F = 10_000, 5
    ACTIVE_MIN_M, ACTIVE_MIN_F = 1_000, 1
    SLEEPING_MIN_R_MINUTES = 30
    SEGMENT_NEWCOMER, SEGMENT_VIP, SEGMENT_ACTIVE = "Новичок", "VIP", "Активный"
    SEGMENT_SLEEPING, SEGMENT_STANDARD = "Спящий", "Стандартный"
    ALERT_FIELDS = ("avg_check_5min", "event_time", "message", "sum", "type", "user_id")
    SEGMENT_FIELDS = ("f", "m", "r_minutes", "segment", "updated_at", "user_id")


DAY_MS = 86_400_000
YEAR_MS = 365 * DAY_MS

TX = f"""
tx AS (
  SELECT CAST(user_id AS INTEGER) AS user_id,
         CASE WHEN event_type IN ('purchase', 'error') THEN '{C.CREDIT}' ELSE '{C.DEPOSIT}' END AS type,
         value AS "sum",
         epoch_us(ts) // 1000 AS event_time,
         event_id AS seq
  FROM events)"""

# The wire damages every 17th event; kinds 0-5 are rejected, kind 6 arrives
# with a lower-cased type and an extra key, and is accepted.
CLEAN = """
clean AS (
  SELECT user_id,
         CASE WHEN seq % 17 = 0 AND (seq // 17) % 7 = 6 THEN lower(type) ELSE type END AS type,
         "sum", event_time, seq
  FROM tx
  WHERE NOT (seq % 17 = 0 AND (seq // 17) % 7 < 6))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _prior(src: str, window_ms: int) -> str:
    return f"""
prior AS (
  SELECT s.*, CAST(round(s."sum" * 100) AS BIGINT) AS cents,
         COUNT(*) OVER w AS prior_n,
         COALESCE(SUM(CAST(round(s."sum" * 100) AS BIGINT)) OVER w, 0) AS prior_cents
  FROM {src} s
  WINDOW w AS (PARTITION BY user_id ORDER BY event_time
               RANGE BETWEEN {window_ms} PRECEDING AND 1 PRECEDING))"""


AVG = "CASE WHEN prior_n > 0 THEN CAST(prior_cents AS DOUBLE) / CAST(prior_n * 100 AS DOUBLE) ELSE 0.0::DOUBLE END"


def _alerts(src: str, window_ms: int, factor: int = C.ANOMALY_FACTOR) -> str:
    return _with(TX, CLEAN, _prior(src, window_ms)) + f"""
SELECT user_id, event_time, seq, type, "sum", {AVG} AS avg_check_5min,
       '{C.ALERT_MESSAGE}' AS message
FROM prior
WHERE lower(type) = 'credit' AND prior_n > 0 AND prior_cents > 0
  AND cents * prior_n >= {factor} * prior_cents"""


def _rfm_ctes(
    src: str,
    retention_ms: int,
    recency: str,
    vip_min_m: float = C.VIP_MIN_M,
    active_min_m: float = C.ACTIVE_MIN_M,
) -> str:
    r_expr = (
        f"CASE WHEN prev_ts IS NULL OR event_time - prev_ts >= {retention_ms} THEN 0.0::DOUBLE "
        "ELSE CAST(event_time - prev_ts AS DOUBLE) / 60000.0 END"
        if recency == "gap"
        else "0.0::DOUBLE"
    )
    return f"""
w AS (
  SELECT s.*,
         COUNT(*) OVER f24 AS f,
         COALESCE(SUM(CASE WHEN lower(type) = 'deposit' THEN CAST(round("sum" * 100) AS BIGINT) ELSE 0 END)
                  OVER f24, 0) AS m_cents,
         LAG(event_time) OVER (PARTITION BY user_id ORDER BY event_time, seq) AS prev_ts
  FROM {src} s
  WINDOW f24 AS (PARTITION BY user_id ORDER BY event_time
                 RANGE BETWEEN {C.RFM_WINDOW_MS} PRECEDING AND CURRENT ROW)),
e AS (
  SELECT *, SUM(CASE WHEN prev_ts IS NULL OR event_time - prev_ts >= {retention_ms} THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY event_time, seq
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch
  FROM w),
g AS (
  SELECT *, MIN(event_time) OVER (PARTITION BY user_id, epoch) AS first_ts,
         {r_expr} AS r_minutes
  FROM e),
seg AS (
  SELECT *,
         CASE WHEN event_time - first_ts < {C.NEWCOMER_MS} THEN '{C.SEGMENT_NEWCOMER}'
              WHEN m_cents > {vip_min_m * 100} AND f > {C.VIP_MIN_F} THEN '{C.SEGMENT_VIP}'
              WHEN m_cents > {active_min_m * 100} AND f > {C.ACTIVE_MIN_F} THEN '{C.SEGMENT_ACTIVE}'
              WHEN r_minutes > {C.SLEEPING_MIN_R_MINUTES} THEN '{C.SEGMENT_SLEEPING}'
              ELSE '{C.SEGMENT_STANDARD}' END AS segment,
         CAST(m_cents AS DOUBLE) / 100.0 AS m
  FROM g)"""


SEGMENT_COLS = "user_id, seq, segment, r_minutes, f, m, event_time AS updated_at"
SCALED = dict(retention_ms=C.RFM_WINDOW_MS, recency="gap", vip_min_m=300, active_min_m=100)


def _scaled() -> str:
    return _with(TX, CLEAN, _rfm_ctes("tx", **SCALED))


ORACLES: dict[str, str] = {
    "tx_ingest": _with(TX, CLEAN) + "SELECT user_id, type, \"sum\", event_time, seq FROM clean",
    "tx_rejects_range": _with(TX)
    + """
SELECT seq AS "offset",
       CASE (seq // 13) % 5 WHEN 0 THEN 'sum_out_of_range' WHEN 1 THEN 'sum_too_fine'
            ELSE 'event_time_out_of_range' END AS reason,
       false AS malformed
FROM tx WHERE seq % 13 = 0 AND (seq // 13) % 5 < 3""",
    "tx_rejects": _with(TX)
    + """
SELECT seq AS "offset",
       CASE (seq // 17) % 7 WHEN 2 THEN 'null_sum' WHEN 3 THEN 'null_sum'
            WHEN 4 THEN 'null_event_time' ELSE 'null_user_id' END AS reason,
       (seq // 17) % 7 IN (0, 3, 4, 5) AS malformed
FROM tx WHERE seq % 17 = 0 AND (seq // 17) % 7 < 6""",
    "tx_typed_ingest": _with(TX)
    + """
SELECT seq AS "offset", user_id, type, CAST("sum" AS DECIMAL(18, 2)) AS "sum"
FROM tx WHERE NOT (seq % 17 = 0 AND (seq // 17) % 7 IN (0, 1, 2, 5, 6))""",
    "tx_typed_rejects": _with(TX)
    + """
SELECT seq AS "offset",
       CASE (seq // 17) % 7 WHEN 2 THEN 'null_sum' WHEN 6 THEN 'bad_type' ELSE 'null_user_id' END AS reason,
       (seq // 17) % 7 IN (0, 5) AS malformed
FROM tx WHERE seq % 17 = 0 AND (seq // 17) % 7 IN (0, 1, 2, 5, 6)""",
    "rolling_avg_check": _with(TX, _prior("tx", C.ANOMALY_WINDOW_MS))
    + f"SELECT user_id, event_time, seq, prior_n, {AVG} AS avg_check_5min FROM prior",
    "rolling_avg_check_ties": f"""
WITH o AS (
  SELECT CAST(o_custkey AS INTEGER) AS user_id, epoch_us(o_orderdate) // 1000 AS event_time,
         o_orderkey AS seq, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders),
p AS (
  SELECT a.user_id, a.event_time, a.seq, COUNT(b.seq) AS prior_n, COALESCE(SUM(b.cents), 0) AS prior_cents
  FROM o a LEFT JOIN o b
    ON a.user_id = b.user_id AND b.event_time >= a.event_time - {YEAR_MS}
   AND (b.event_time < a.event_time OR (b.event_time = a.event_time AND b.seq < a.seq))
  GROUP BY a.user_id, a.event_time, a.seq)
SELECT user_id, event_time, seq, prior_n, {AVG} AS avg_check_5min FROM p""",
    "anomaly_alerts": _alerts("tx", C.ANOMALY_WINDOW_MS),
    "anomaly_alerts_24h": _alerts("tx", C.RFM_WINDOW_MS),
    "rfm_metrics": _with(TX, _rfm_ctes("tx", C.SNAPSHOT_TTL_MS, "gap"))
    + "SELECT user_id, seq, event_time, f, m, first_ts, prev_ts, r_minutes FROM seg",
    "rfm_tenure": _with(TX, _rfm_ctes("tx", C.RFM_WINDOW_MS, "reference"))
    + f""",
e7 AS (
  SELECT *, SUM(CASE WHEN prev_ts IS NULL OR event_time - prev_ts >= {C.SNAPSHOT_TTL_MS} THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY event_time, seq
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch7
  FROM seg),
g7 AS (SELECT *, MIN(event_time) OVER (PARTITION BY user_id, epoch7) AS first_ts_7d FROM e7)
SELECT user_id, seq, first_ts AS first_ts_24h, first_ts_7d,
       event_time - first_ts AS tenure_24h_ms, event_time - first_ts_7d AS tenure_7d_ms
FROM g7""",
    "rfm_segments": _with(TX, _rfm_ctes("tx", C.SNAPSHOT_TTL_MS, "reference"))
    + f"SELECT {SEGMENT_COLS} FROM seg",
    "rfm_segments_24h": _with(TX, _rfm_ctes("tx", C.RFM_WINDOW_MS, "reference"))
    + f"SELECT {SEGMENT_COLS} FROM seg",
    "rfm_segments_scaled": _scaled() + f"SELECT {SEGMENT_COLS} FROM seg",
    "rfm_latest": _scaled()
    + """
SELECT user_id, seq, event_time AS updated_at, f, m, first_ts, r_minutes, segment
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time DESC, seq DESC) AS rn FROM seg)
WHERE rn = 1""",
    "rfm_sleeping_asof": _scaled()
    + f""",
at_end AS (SELECT max(event_time) AS t FROM tx),
last AS (
  SELECT user_id, event_time AS last_ts, first_ts
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time DESC, seq DESC) AS rn FROM seg)
  WHERE rn = 1),
win AS (
  SELECT user_id, COUNT(*) AS f,
         SUM(CASE WHEN lower(type) = 'deposit' THEN CAST(round("sum" * 100) AS BIGINT) ELSE 0 END) AS m_cents
  FROM tx, at_end WHERE event_time >= at_end.t - {C.RFM_WINDOW_MS} GROUP BY user_id),
j AS (
  SELECT l.user_id, l.last_ts, l.first_ts, COALESCE(w.f, 0) AS f, COALESCE(w.m_cents, 0) AS m_cents,
         CAST(at_end.t - l.last_ts AS DOUBLE) / 60000.0 AS r_minutes, at_end.t AS t
  FROM last l CROSS JOIN at_end LEFT JOIN win w ON l.user_id = w.user_id)
SELECT user_id, last_ts, r_minutes, f, CAST(m_cents AS DOUBLE) / 100.0 AS m,
       CASE WHEN t - first_ts < {C.NEWCOMER_MS} THEN '{C.SEGMENT_NEWCOMER}'
            WHEN m_cents > 30000 AND f > {C.VIP_MIN_F} THEN '{C.SEGMENT_VIP}'
            WHEN m_cents > 10000 AND f > {C.ACTIVE_MIN_F} THEN '{C.SEGMENT_ACTIVE}'
            WHEN r_minutes > {C.SLEEPING_MIN_R_MINUTES} THEN '{C.SEGMENT_SLEEPING}'
            ELSE '{C.SEGMENT_STANDARD}' END AS segment
FROM j""",
    "kv_retention": _with(TX, _rfm_ctes("tx", C.SNAPSHOT_TTL_MS, "reference"))
    + f"""
SELECT user_id, event_time AS last_ts, f, m, segment, event_time + {C.SNAPSHOT_TTL_MS} AS expires_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time DESC, seq DESC) AS rn FROM seg)
WHERE rn = 1
  AND event_time + {C.SNAPSHOT_TTL_MS} > (SELECT max(event_time) FROM tx) + {C.SNAPSHOT_TTL_MS - DAY_MS // 2}""",
    "snapshot_upsert": _scaled()
    + f"""
SELECT user_id, event_time AS last_ts, seq AS last_seq, first_ts, f, m, segment,
       event_time + {C.SNAPSHOT_TTL_MS} AS expires_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time DESC, seq DESC) AS rn FROM seg)
WHERE rn = 1""",
    "state_restore": _scaled()
    + f"""
SELECT {SEGMENT_COLS} FROM seg
WHERE event_time >= (SELECT (min(event_time) + max(event_time)) // 2 FROM tx)""",
    "alerts_kv": _alerts("tx", C.RFM_WINDOW_MS).replace(
        "SELECT user_id, event_time, seq, type,",
        f"SELECT CAST(user_id AS VARCHAR) AS key, '{','.join(C.ALERT_FIELDS)}' AS json_keys, user_id, event_time, type,",
    ),
    "segments_kv": _scaled()
    + f"""
SELECT CAST(user_id AS VARCHAR) AS key, '{','.join(C.SEGMENT_FIELDS)}' AS json_keys,
       f, m, r_minutes, segment, event_time AS updated_at, user_id
FROM seg""",
    "batch_observe_counts": _with(TX)
    + f"""
SELECT user_id, event_time // {DAY_MS} AS batch_day, COUNT(*) AS n_tx,
       COUNT(CASE WHEN lower(type) = 'credit' THEN 1 END) AS n_credit,
       COUNT(CASE WHEN lower(type) = 'deposit' THEN 1 END) AS n_deposit
FROM tx GROUP BY user_id, event_time // {DAY_MS}""",
}

# The streaming replays must equal the batch answers.
ORACLES["stream_anomaly"] = ORACLES["anomaly_alerts_24h"]
ORACLES["stream_rfm"] = ORACLES["rfm_segments_scaled"]
ORACLES["stream_restore"] = ORACLES["rfm_segments_scaled"]


# The live job's tables (replayed in slices of five days; watermark five days behind the newest time).
SLICE_MS = 5 * DAY_MS
REASONS = """
CASE (seq // 17) % 7 WHEN 2 THEN 'null_sum' WHEN 3 THEN 'null_sum'
     WHEN 4 THEN 'null_event_time' ELSE 'null_user_id' END"""
ORACLES["live_restart"] = _scaled() + """
SELECT user_id, seq, type, "sum", event_time AS updated_at, segment, r_minutes, f, m FROM seg"""
ORACLES["live_accounting"] = _with(TX, CLEAN) + f"""
, mid AS (SELECT (min(event_time) + max(event_time)) // 2 AS t FROM tx),
judged AS (SELECT c.*, seq % 23 = 0 AND event_time < mid.t AS late FROM clean c, mid)
SELECT seq, 'segment' AS kind, CAST(NULL AS VARCHAR) AS reason,
       COUNT(*) OVER (PARTITION BY user_id ORDER BY event_time RANGE BETWEEN {C.RFM_WINDOW_MS} PRECEDING AND CURRENT ROW) AS f
FROM judged WHERE NOT late
UNION ALL SELECT seq, 'late', 'behind_watermark', NULL FROM judged WHERE late
UNION ALL SELECT seq, 'reject', {REASONS}, NULL FROM tx WHERE seq % 17 = 0 AND (seq // 17) % 7 < 6"""
ORACLES["live_expiry"] = _with(TX) + f"""
SELECT user_id, event_time AS last_ts
FROM (SELECT *, LEAD(event_time) OVER (PARTITION BY user_id ORDER BY event_time, seq) AS next_ts FROM tx)
WHERE next_ts - event_time >= {C.RFM_WINDOW_MS}
   OR (next_ts IS NULL AND event_time + {C.RFM_WINDOW_MS} < (SELECT max(event_time) FROM tx) - {SLICE_MS})"""
ORACLES["live_current"] = ORACLES["kv_retention"]
ORACLES["live_batch_metrics"] = _with(TX) + f"""
, t AS (SELECT *, seq % 17 = 0 AND (seq // 17) % 7 < 6 AS bad, event_time // {SLICE_MS} AS slice FROM tx)
SELECT slice, COUNT(*) FILTER (NOT bad) AS n_segment, CAST(0 AS BIGINT) AS n_late, COUNT(*) FILTER (bad) AS n_reject,
       COUNT(*) FILTER (NOT bad AND type = '{C.CREDIT}') AS n_credit,
       COUNT(*) FILTER (NOT bad AND type = '{C.DEPOSIT}') AS n_deposit,
       MAX(event_time) FILTER (NOT bad) AS max_time
FROM t GROUP BY slice"""
ORACLES["live_unkeyed"] = f"""
WITH o AS (
  SELECT CAST(o_custkey AS INTEGER) AS user_id, epoch_us(o_orderdate) // 1000 AS event_time,
         CAST(7 - o_orderkey % 8 AS INTEGER) AS part, o_orderkey AS seq,
         CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS cents
  FROM orders),
p AS (
  SELECT a.user_id, a.part, a.seq, a.event_time, COUNT(*) AS f, SUM(b.cents) AS cents,
         MAX(b.event_time) FILTER (b.part <> a.part OR b.seq <> a.seq) AS prev_ts
  FROM o a JOIN o b
    ON a.user_id = b.user_id AND b.event_time >= a.event_time - {YEAR_MS}
   AND (b.event_time, b.part, b.seq) <= (a.event_time, a.part, a.seq)
  GROUP BY a.user_id, a.part, a.seq, a.event_time)
SELECT user_id, part AS "partition", seq, event_time, f, CAST(cents AS DOUBLE) / 100.0 AS m,
       CASE WHEN prev_ts IS NULL OR event_time - prev_ts >= {YEAR_MS} THEN 0.0::DOUBLE
            ELSE CAST(event_time - prev_ts AS DOUBLE) / 60000.0 END AS r_minutes
FROM p"""
ORACLES["state_export"] = _scaled() + f"""
, last AS (
  SELECT user_id, event_time AS last_ts, first_ts
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time DESC, seq DESC) AS rn FROM seg)
  WHERE rn = 1)
SELECT s.user_id, s.event_time, s.seq, CAST(round(s."sum" * 100) AS BIGINT) * 100 AS units,
       lower(s.type) = 'deposit' AS deposit, l.first_ts, l.last_ts
FROM seg s JOIN last l ON s.user_id = l.user_id WHERE s.event_time >= l.last_ts - {C.RFM_WINDOW_MS}"""

# One user has a third of the rows, so rows may share a millisecond: those after a row in seq order are taken off its frame.
ORACLES["live_hot_user"] = _with(
    TX, "hot AS (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 1 ELSE user_id END AS user_id) FROM tx)", _rfm_ctes("hot", **SCALED)
) + f"""
, exact AS (
  SELECT user_id, seq, event_time, first_ts, r_minutes, f - COUNT(*) OVER later AS f,
         m_cents - COALESCE(SUM(CASE WHEN lower(type) = 'deposit' THEN CAST(round("sum" * 100) AS BIGINT) ELSE 0 END) OVER later, 0) AS m_cents
  FROM seg
  WINDOW later AS (PARTITION BY user_id, event_time ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT user_id, seq, event_time AS updated_at, r_minutes, f, CAST(m_cents AS DOUBLE) / 100.0 AS m,
       CASE WHEN event_time - first_ts < {C.NEWCOMER_MS} THEN '{C.SEGMENT_NEWCOMER}'
            WHEN m_cents > 30000 AND f > {C.VIP_MIN_F} THEN '{C.SEGMENT_VIP}'
            WHEN m_cents > 10000 AND f > {C.ACTIVE_MIN_F} THEN '{C.SEGMENT_ACTIVE}'
            WHEN r_minutes > {C.SLEEPING_MIN_R_MINUTES} THEN '{C.SEGMENT_SLEEPING}'
            ELSE '{C.SEGMENT_STANDARD}' END AS segment
FROM exact"""
