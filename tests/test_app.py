"""Query wiring: two named queries at once, progress listener, console echo,
and results that do not depend on the shuffle partition count."""

import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from txpulse.functions import constants as C
from txpulse.operators.rfm import SCALED_RULES, rfm_segments
from txpulse.session import scratch_path
from txpulse.sources.events import events_transactions
from txpulse.streaming.app import ProgressLog, alerts_stream, run_all, segments_stream, start
from txpulse.streaming.replay import wire_stream, write_wire_slices
from txpulse.streaming.sinks import BatchFanout, console_writer, parquet_table_writer
from vectors import RFM, frame


def test_two_named_queries_and_progress(spark):
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        path = write_wire_slices(spark, frame(spark, RFM), slice_ms=C.RFM_WINDOW_MS // 2)
        outs = {n: scratch_path(spark, n) for n in ("a", "s")}
        qa = start(
            alerts_stream(wire_stream(spark, path)),
            BatchFanout([parquet_table_writer(outs["a"]), console_writer(5)], name="a"),
            scratch_path(spark, "cka"),
            "alerts-test",
            {"availableNow": True},
            state_partitions=2,
        )
        qs = start(
            segments_stream(wire_stream(spark, path)),
            BatchFanout([parquet_table_writer(outs["s"])], name="s"),
            scratch_path(spark, "cks"),
            "segments-test",
            {"availableNow": True},
            state_partitions=3,
        )
        run_all(spark, [qa, qs])  # returns once one of them ends
        qa.awaitTermination()
        qs.awaitTermination()
        assert spark.read.parquet(outs["s"]).count() == len(RFM)
        time.sleep(1)  # listener events arrive asynchronously
        names = {e["name"] for e in listener.events}
        assert {"alerts-test", "segments-test"} <= names
        assert sum(e["input_rows"] for e in listener.events if e["name"] == "segments-test") == len(RFM)
    finally:
        spark.streams.removeListener(listener)
        spark.streams.resetTerminated()


def test_shuffle_partitions_do_not_change_results(spark):
    tx = events_transactions(spark, SF_SMALL)
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    try:
        results = []
        for n in ("1", "7"):
            spark.conf.set(key, n)
            df = rfm_segments(tx.orderBy(F.rand(int(n))), SCALED_RULES)
            results.append(sorted(map(tuple, df.collect()), key=repr))
        assert results[0] == results[1]
    finally:
        spark.conf.set(key, old)


def test_kafka_paths_fail_with_a_clear_message_without_the_connector(spark):
    import pytest

    from txpulse.sources.kafka import kafka_stream
    from txpulse.streaming.sinks import kafka_writer

    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        pytest.skip("the Kafka connector is installed here")
    except Exception as e:
        if "skip" in type(e).__name__.lower():
            raise
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        kafka_stream(spark, "localhost:1", "t")
    batch = spark.createDataFrame([(1, "Credit", 2.0)], "user_id int, type string, sum double")
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        kafka_writer("localhost:1", "alerts", ("sum", "type", "user_id"))(batch, 0)
