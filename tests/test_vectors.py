"""Boundary vectors for the anomaly rule, the trailing windows and the segment CASE."""

import pytest
from pyspark.sql import functions as F

from txpulse.functions import constants as C
from txpulse.operators.anomaly import anomaly_alerts, rolling_avg_check
from txpulse.operators.rfm import RfmRules, rfm_detail, rfm_segments
from vectors import ANOMALY, BASE, RFM, frame, shuffled


def _by_seq(df, *cols):
    return {r["seq"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("bucket_ms", [None, 300_000, 10 * 300_000])
def test_anomaly_vectors(spark, bucket_ms):
    tx = shuffled(frame(spark, ANOMALY))
    got = _by_seq(rolling_avg_check(tx, bucket_ms=bucket_ms), "prior_n", "avg_check_5min")
    for _, _, seq, _, _, n, avg, _ in ANOMALY:
        assert got[seq][0] == n, seq
        assert got[seq][1] == pytest.approx(avg, abs=1e-9), seq
    alerts = anomaly_alerts(tx, bucket_ms=bucket_ms).collect()
    assert sorted(a["seq"] for a in alerts) == [s for (_, _, s, *_, hit) in ANOMALY if hit]
    kept = {a["seq"]: a for a in alerts}
    assert kept[3]["type"] == "cReDiT"  # letter case of the input is kept
    assert kept[3]["message"] == C.ALERT_MESSAGE


@pytest.mark.parametrize("bucket_ms", [None, C.RFM_WINDOW_MS, 3 * C.RFM_WINDOW_MS])
def test_rfm_vectors(spark, bucket_ms):
    tx = shuffled(frame(spark, RFM))
    got = _by_seq(rfm_segments(tx, bucket_ms=bucket_ms), "f", "m", "segment", "r_minutes")
    for _, _, seq, _, _, f, m, seg in RFM:
        assert got[seq][:3] == (f, m, seg), seq
        assert got[seq][3] == 0.0  # reference recency is always zero


def test_newcomer_boundary_and_retention(spark):
    rows = [
        (5, 0, 1, "Credit", 1.0),
        (5, 299_999, 2, "Credit", 1.0),
        (5, 300_000, 3, "Credit", 1.0),
        (5, 300_000 + C.RFM_WINDOW_MS, 4, "Credit", 1.0),  # idle exactly 24 h
    ]
    tx = frame(spark, [r + (0, 0.0, "") for r in rows])
    d7 = _by_seq(rfm_detail(tx), "first_ts")
    d24 = _by_seq(rfm_detail(tx, RfmRules(retention_ms=C.RFM_WINDOW_MS)), "first_ts")
    assert [d7[s][0] - BASE for s in (1, 2, 3, 4)] == [0, 0, 0, 0]
    assert [d24[s][0] - BASE for s in (1, 2, 3)] == [0, 0, 0]
    assert d24[4][0] - BASE == 300_000 + C.RFM_WINDOW_MS  # a gap >= retention starts a new epoch
    seg = _by_seq(rfm_segments(tx), "segment")
    assert [seg[s][0] for s in (1, 2, 3)] == ["Новичок", "Новичок", "Стандартный"]


def test_gap_recency_makes_sleeping_reachable(spark):
    rows = [(7, 0, 1, "Credit", 1.0), (7, 600_000, 2, "Credit", 1.0), (7, 600_000 + 1_800_001, 3, "Credit", 1.0)]
    tx = frame(spark, [r + (0, 0.0, "") for r in rows])
    got = _by_seq(rfm_segments(tx, RfmRules(recency="gap")), "segment", "r_minutes")
    assert got[3] == ("Спящий", 1_800_001 / 60000.0)
    assert got[2] == ("Стандартный", 10.0)


def test_ties_follow_seq(spark):
    # three rows in one ms: each sees only the earlier seqs
    rows = [(9, 0, s, "Deposit", float(s)) for s in (3, 1, 2)] + [(9, 10, 4, "Credit", 100.0)]
    tx = frame(spark, [r + (0, 0.0, "") for r in rows])
    got = _by_seq(rolling_avg_check(tx), "prior_n")
    assert {s: v[0] for s, v in got.items()} == {1: 0, 2: 1, 3: 2, 4: 3}
    f = _by_seq(rfm_detail(tx), "f")
    assert {s: v[0] for s, v in f.items()} == {1: 1, 2: 2, 3: 3, 4: 4}


def test_latest_row_per_user_is_flagged_once(spark):
    tx = frame(spark, RFM)
    d = rfm_detail(tx)
    last = d.where("is_last").select("user_id", "seq").collect()
    assert sorted((r["user_id"], r["seq"]) for r in last) == [(1, 8), (2, 12)]
    tail = d.where(F.col("in_tail") & (F.col("user_id") == 1)).select("seq").collect()
    assert sorted(r["seq"] for r in tail) == [2, 3, 4, 5, 6, 7, 8]


def test_gap_recency_resets_with_the_epoch(spark):
    day = C.RFM_WINDOW_MS
    rows = [(8, 0, 1, "Credit", 1.0), (8, 3 * day, 2, "Credit", 1.0), (8, 3 * day + 60_000, 3, "Credit", 1.0)]
    tx = frame(spark, [r + (0, 0.0, "") for r in rows])
    rules = RfmRules(retention_ms=day, recency="gap")
    got = _by_seq(rfm_segments(tx, rules), "r_minutes", "segment")
    assert got[2] == (0.0, "Новичок")  # idle past retention: new epoch, no stored previous row
    assert got[3] == (1.0, "Новичок")


@pytest.mark.parametrize("bucket_ms", [None, 60_000])
def test_rows_without_user_or_time_are_kept_with_nulls(spark, bucket_ms):
    tx = frame(spark, ANOMALY)
    extra = spark.createDataFrame(
        [(None, "Credit", 5.0, BASE, 100), (1, "Credit", 5.0, None, 101)],
        "user_id int, type string, sum double, event_time long, seq long",
    )
    both = tx.unionByName(extra)
    got = {r["seq"]: (r["prior_n"], r["avg_check_5min"]) for r in rolling_avg_check(both, bucket_ms=bucket_ms).collect()}
    assert got[100] == (None, None) and got[101] == (None, None)
    clean = {r["seq"]: (r["prior_n"], r["avg_check_5min"]) for r in rolling_avg_check(tx, bucket_ms=bucket_ms).collect()}
    assert {s: v for s, v in got.items() if s < 100} == clean
    seg = {r["seq"]: (r["f"], r["segment"]) for r in rfm_segments(both, bucket_ms=bucket_ms and 6 * 3_600_000).collect()}
    assert seg[100] == (None, None) and seg[101] == (None, None)
    assert len(seg) == len(ANOMALY) + 2
