"""Amounts and times at the edges: batch and stream agree, and one bad record fails nothing."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_processor_model import MemoryState
from txpulse.functions import constants as C
from txpulse.operators.anomaly import anomaly_alerts, rolling_avg_check
from txpulse.operators.rfm import RfmRules, rfm_segments
from txpulse.sources.ingest import parse_transactions
from txpulse.sources.kafka import transactions_as_kafka
from txpulse.streaming.app import alerts_stream
from txpulse.streaming.processors import AnomalyProcessor, RfmProcessor

ROWS = [
    (1, "Deposit", 0.004, 1000, 1), (1, "Credit", 0.02, 2000, 2),
    (2, "Deposit", 0.125, 1000, 3), (2, "Credit", 0.375, 2000, 4),
    (3, "Deposit", 0.01, 1000, 5), (3, "Credit", 0.0299, 2000, 6),
    (4, "Deposit", 1e9, 1000, 7), (4, "Credit", 1e9, 2000, 8),
]
SCHEMA = "user_id int, type string, sum double, event_time long, seq long"


def frame_of(idx):
    rows = [ROWS[i] for i in idx]
    return pd.DataFrame(
        {"user_id": np.array([r[0] for r in rows], "int32"), "type": [r[1] for r in rows], "sum": [r[2] for r in rows],
         "event_time": np.array([r[3] for r in rows], "int64"), "seq": np.array([r[4] for r in rows], "int64")}
    )


def processor(make):
    p = make()
    p.state, p.handle = MemoryState(), None
    return p


def test_sub_cent_amounts_alert_alike(spark):
    got = {r.user_id: r.avg_check_5min for r in anomaly_alerts(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert got == {1: 0.004, 2: 0.125}
    streamed = {}
    for u in range(4):
        for out in processor(AnomalyProcessor).handleInputRows((u + 1,), iter([frame_of([2 * u, 2 * u + 1])]), None):
            streamed.update(zip(out["user_id"].tolist(), out["avg_check_5min"].tolist()))
    assert streamed == got


def test_bad_records_are_rejected_and_fail_nothing(spark):
    values = [
        ('{"user_id":1,"type":"Deposit","sum":1e20,"event_time":1}', "sum_out_of_range"),
        ('{"user_id":1,"type":"Deposit","sum":"NaN","event_time":1}', "sum_out_of_range"),
        ('{"user_id":1,"type":"Deposit","sum":1e9,"event_time":1}', None),
        ('{"user_id":1,"type":"Deposit","sum":1000000000.5,"event_time":1}', "sum_out_of_range"),
        ('{"user_id":1,"type":"Deposit","sum":-1e300,"event_time":1}', "sum_out_of_range"),
        ('{"user_id":1,"type":"Deposit","sum":0.00001,"event_time":1}', "sum_too_fine"),
        ('{"user_id":1,"type":"Deposit","sum":123456789.1234,"event_time":1}', None),
        ('{"user_id":1,"type":"Deposit","sum":0.30000000000000004,"event_time":1}', None),
        ('{"user_id":1,"type":"Deposit","sum":1,"event_time":9223372036854775807}', "event_time_out_of_range"),
        ('{"user_id":1,"type":"Deposit","sum":1,"event_time":-9223372036854775808}', "event_time_out_of_range"),
        ('{"user_id":1,"type":"Deposit","sum":1,"event_time":253402300799999}', None),
    ]
    like = transactions_as_kafka(spark.createDataFrame(ROWS[:1], SCHEMA)).drop("value", "offset")
    records = spark.createDataFrame([(i, bytearray(v.encode())) for i, (v, _) in enumerate(values)], "offset long, value binary").crossJoin(like)
    clean, rejects = parse_transactions(records)
    assert {r.offset: r.reason for r in rejects.collect()} == {i: why for i, (_, why) in enumerate(values) if why}
    assert {r.seq for r in clean.collect()} == {i for i, (_, why) in enumerate(values) if not why}
    assert rolling_avg_check(clean).count() == rfm_segments(clean).count() == 4


def test_operators_survive_an_unchecked_amount(spark):
    tx = spark.createDataFrame([(1, "Deposit", 1e20, 1, 1), (1, "Deposit", 2.0, 2, 2), (1, "Deposit", float("nan"), 3, 3)], SCHEMA)
    assert rolling_avg_check(tx).count() == 3
    with pytest.raises(ValueError, match="out of range"):
        bad = frame_of([0]).assign(sum=1e20)
        list(processor(RfmProcessor).handleInputRows((1,), iter([bad]), None))


def test_a_late_row_has_no_negative_gap():
    p = processor(lambda: RfmProcessor(RfmRules(recency="gap")))
    hour = 3_600_000
    day = frame_of([0]).assign(event_time=np.array([100 * hour]))
    list(p.handleInputRows((1,), iter([day]), None))
    list(p.handleInputRows((1,), iter([day.assign(event_time=130 * hour)]), None))
    late = next(p.handleInputRows((1,), iter([day.assign(event_time=98 * hour)]), None))
    assert late["r_minutes"].tolist() == [0.0] and late["f"].tolist() == [1]
    inside = next(p.handleInputRows((1,), iter([day.assign(event_time=120 * hour)]), None))
    assert inside["r_minutes"].tolist()[0] >= 0.0
    assert p.last == p.state.get()[11] == 130 * hour  # the last time seen stays


def test_event_time_needs_a_watermark(spark):
    stream = transactions_as_kafka(spark.createDataFrame(ROWS, SCHEMA))
    with pytest.raises(ValueError, match="watermark"):
        alerts_stream(stream, time_mode="EventTime")


def test_units_round_half_away_from_zero_in_both_forms(spark):
    from txpulse.functions.columns import to_units
    from txpulse.streaming.processors import _units

    x = [0.00005, 0.00015, -0.00005, -0.00015, 12.34, 0.29, 1e9, -1e9]
    got = [r.u for r in spark.createDataFrame([(v,) for v in x], "x double").select(to_units("x").alias("u")).collect()]
    assert got == _units(np.array(x)).tolist() and C.UNITS == 10_000
    assert spark.range(1).select(to_units(F.lit(1e300)).alias("u")).first().u is None
