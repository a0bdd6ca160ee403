"""Scale properties: hot users are split, results do not depend on the split,
and the plans keep one shuffle on the big side with pruned scans."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_compare import _rows
from txpulse.functions import constants as C
from txpulse.operators.anomaly import rolling_avg_check
from txpulse.operators.rfm import SCALED_RULES, RfmRules, rfm_detail
from txpulse.operators.windows import BUCKET, COPY, TimeSplit, bucket_width, time_bucket
from txpulse.sources.events import events_transactions

DAY = 86_400_000


def _hot(spark):
    """A third of all rows moved onto one user (seq keeps them distinct)."""
    tx = events_transactions(spark, SF_SMALL)
    return tx.withColumn("user_id", F.when(F.col("seq") % 3 == 0, F.lit(424242)).otherwise(F.col("user_id")))


def _set(df):
    return sorted(_rows(df.columns, df.collect()), key=repr)


def test_hot_user_is_spread_over_buckets(spark):
    tx = _hot(spark)
    width = bucket_width(C.RFM_WINDOW_MS, DAY)
    framed = TimeSplit(C.RFM_WINDOW_MS, width).split(tx, "event_time")
    groups = framed.where(F.col("user_id") == 424242).select(BUCKET).distinct().count()
    assert groups >= 25  # ~30 days of data -> one task group per day, not one for the user
    assert framed.count() / tx.count() <= 2.0
    # narrow: hourly buckets for a 24 h window, still two rows per input row
    narrow = TimeSplit(C.RFM_WINDOW_MS, 3_600_000).split(tx, "event_time")
    hot = narrow.where((F.col("user_id") == 424242) & ~F.col(COPY)).select(BUCKET).distinct().count()
    assert hot >= 300
    assert narrow.count() == 2 * tx.count()


@pytest.mark.parametrize("bucket_ms", [C.RFM_WINDOW_MS, 3 * DAY])
def test_results_do_not_depend_on_bucket_width(spark, bucket_ms):
    tx = _hot(spark)
    wide = 40 * DAY  # one bucket holds everything: the plain per-user window
    rules = RfmRules(recency="gap")  # 7-day retention: buckets of 1 to 7 days are allowed
    cols = ("user_id", "seq", "f", "m_units", "first_ts", "prev_ts", "is_last", "in_tail")
    a = rfm_detail(tx, rules, bucket_ms=bucket_ms).select(*cols)
    b = rfm_detail(tx, rules, bucket_ms=rules.retention_ms).select(*cols)
    assert _set(a) == _set(b)
    r1 = rolling_avg_check(tx, bucket_ms=300_000).select("seq", "prior_n", "prior_units")
    r2 = rolling_avg_check(tx, bucket_ms=wide).select("seq", "prior_n", "prior_units")
    assert _set(r1) == _set(r2)


def test_bucket_arithmetic_is_floor_division(spark):
    df = spark.createDataFrame([(-1,), (0,), (299_999,), (300_000,), (-300_000,), (-300_001,)], "t long")
    got = [r[0] for r in df.select(time_bucket("t", 300_000)).collect()]
    assert got == [-1, 0, 0, 1, -1, -2]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_frames_plan_one_exchange_and_pruned_scan(spark):
    tx = events_transactions(spark, SF_SMALL)
    plan = _plan(rolling_avg_check(tx))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in (
        rolling_avg_check(tx)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    )
    assert "props" not in plan


def _exchange_inputs(df):
    """Input column lists of every Exchange in the formatted plan."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    sections = text.split("\n\n")
    return [sec for sec in sections if sec.split("\n", 1)[0].strip().startswith("(") and " Exchange" in sec.split("\n", 1)[0]]


def test_rfm_big_side_is_shuffled_once(spark):
    tx = events_transactions(spark, SF_SMALL)
    ex = _exchange_inputs(rfm_detail(tx, SCALED_RULES))
    big = [sec for sec in ex if "dep_units" in sec]  # only the transaction rows carry amounts
    assert len(big) == 1, big
    assert "hashpartitioning(user_id" in big[0] and "_bucket" in big[0]
    assert not any("BroadcastExchange" in sec for sec in ex)


@pytest.mark.parametrize("bucket_ms", [60_000, 3_600_000, "auto"])
def test_narrow_and_auto_buckets_agree(spark, bucket_ms):
    tx = _hot(spark)
    wide = 40 * DAY
    r1 = rolling_avg_check(tx, bucket_ms=bucket_ms).select("seq", "prior_n", "prior_units")
    r2 = rolling_avg_check(tx, bucket_ms=wide).select("seq", "prior_n", "prior_units")
    assert _set(r1) == _set(r2)
    rules = RfmRules(recency="gap")
    cols = ("user_id", "seq", "f", "m_units", "first_ts", "prev_ts", "is_last", "in_tail")
    narrow = 6 * 3_600_000 if bucket_ms != "auto" else "auto"  # 6 h < the 24 h window
    a = rfm_detail(tx, rules, bucket_ms=narrow).select(*cols)
    b = rfm_detail(tx, rules, bucket_ms=rules.retention_ms).select(*cols)
    assert _set(a) == _set(b)


def test_auto_width_narrows_for_a_hot_user(spark):
    from txpulse.operators.windows import auto_bucket_width

    tx = _hot(spark)
    plain = auto_bucket_width(tx, "user_id", "event_time", C.RFM_WINDOW_MS, target_rows=10_000)
    hot = auto_bucket_width(tx, "user_id", "event_time", C.RFM_WINDOW_MS, target_rows=30)
    assert plain == 4 * C.RFM_WINDOW_MS  # nothing is hot enough: the default
    assert C.RFM_WINDOW_MS <= hot < plain


def test_width_for_hottest_rules():
    from txpulse.operators.windows import width_for_hottest

    w = C.RFM_WINDOW_MS
    default = bucket_width(w)  # 4 days
    assert width_for_hottest(None, w) == default
    assert width_for_hottest(1000, w) == default
    # hot, but a width of at least W still fits the target
    mid = width_for_hottest(8_000_000, w, target_rows=4_000_000)
    assert w <= mid < default
    # very hot: narrower than the window, and a divisor of it
    tiny = width_for_hottest(10**10, w, target_rows=4_000_000)
    assert tiny < w and w % tiny == 0 and tiny >= 1000


@pytest.mark.parametrize("kind, target", [("rfm", 30), ("alerts", 8)])
def test_only_hot_users_are_split_more(spark, monkeypatch, kind, target):
    from txpulse.operators import windows

    tx = _hot(spark)
    if kind == "rfm":
        cols = ("user_id", "seq", "f", "m_units", "first_ts", "prev_ts", "r_minutes", "segment", "is_last", "in_tail")
        run = lambda: _set(rfm_detail(tx, RfmRules(recency="gap")).select(*cols))
    else:
        run = lambda: _set(rolling_avg_check(tx).select("seq", "prior_n", "prior_units"))
    plain, parts, split = run(), [], TimeSplit.split

    def watched(self, df, time_col):
        parts.append((self.width, {r[0] for r in df.select("user_id").distinct().collect()}))
        return split(self, df, time_col)

    monkeypatch.setattr(windows, "TARGET_ROWS", target)
    monkeypatch.setattr(TimeSplit, "split", watched)
    assert run() == plain
    (wide, others), (narrow, users) = parts
    assert 424242 in users and not others & users and len(others) > len(users) and narrow < wide


def test_rows_without_a_time_are_many_tasks(spark):
    rows = spark.range(5000).selectExpr("cast(null as int) user_id", "'Credit' type", "1.0D sum", "cast(null as long) event_time", "id seq")
    for width in (DAY, 3_600_000):
        framed = TimeSplit(C.RFM_WINDOW_MS, bucket_width(C.RFM_WINDOW_MS, width)).split(rows, "event_time")
        assert framed.where(~F.col(COPY)).count() == 5000 and framed.select(BUCKET).distinct().count() > 1000
    assert rolling_avg_check(rows).where("prior_n IS NULL").count() == rfm_detail(rows).where("f IS NULL").count() == 5000


def test_current_state_equals_the_last_row_of_the_detail(spark):
    from txpulse.operators.rfm import rfm_current, rfm_latest

    tx = _hot(spark)
    tx = tx.union(tx.limit(200).withColumn("seq", F.col("seq") + 10**9))  # ties on the last time, too
    cols = ("user_id", "seq", "event_time", "f", "m_units", "m", "first_ts", "r_minutes", "segment")
    for rules in (RfmRules(), RfmRules(recency="gap"), RfmRules(retention_ms=C.RFM_WINDOW_MS, recency="gap", vip_min_m=300)):
        assert _set(rfm_current(tx, rules).select(*cols)) == _set(rfm_latest(rfm_detail(tx, rules)).select(*cols))
    plan = rfm_current(tx)._jdf.queryExecution().executedPlan().toString()
    assert "seq" not in " ".join(x for x in plan.split("\n") if "Window" in x)
