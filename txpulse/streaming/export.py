"""State read out of a stopped query's checkpoint, through Spark's state data source (T5, S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpulse.functions import constants as C


def _variable(spark: SparkSession, checkpoint: str, operator: int, name: str) -> DataFrame:
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
    return reader.option("stateVarName", name).load()


def exported_state(spark: SparkSession, checkpoint: str, window_ms: int, operator: int = 0) -> tuple[DataFrame, DataFrame]:
    """(marks, entries) of every user: user_id, first_ts, last_ts; and user_id, event_time, partition, seq, units, deposit.

    The checkpoint's last committed batch is read in place, a task for each
    state partition; neither the query's input nor its output is. Entries are
    those of the user's trailing window, from the shards' heads and the buckets.
    """
    heads = _variable(spark, checkpoint, operator, "heads").select("value.*")
    buckets = _variable(spark, checkpoint, operator, "buckets").select("user_map_key.user_id", "user_map_value.*")
    names = ("ts", "part", "seq", "units", "deposit")
    held = heads.select(F.inline(F.arrays_zip(F.col("owner").alias("user_id"), *names)))
    each = held.unionByName(buckets.select("user_id", F.inline(F.arrays_zip(*names))))
    marks = heads.select(F.inline(F.arrays_zip("user_id", "first_ts", "last_ts"))).where(F.col("last_ts").isNotNull())
    entries = each.join(marks.select("user_id", "last_ts"), "user_id").where(F.col("ts") >= F.col("last_ts") - window_ms)
    return marks, entries.select("user_id", F.col("ts").alias("event_time"), F.col("part").alias("partition"), "seq", "units", "deposit")


def state_seed(spark: SparkSession, checkpoint: str, window_ms: int, operator: int = 0) -> DataFrame:
    """The exported state as the initial state (``RFM_SEED``) of a new query."""
    marks, entries = exported_state(spark, checkpoint, window_ms, operator)
    nothing = F.lit(None)
    return marks.select(
        "user_id", F.lit(True).alias("is_header"), F.col("last_ts").alias("event_time"), F.lit(0).cast("long").alias("seq"),
        nothing.cast("double").alias("sum"), nothing.cast("string").alias("type"), "first_ts", F.lit(0).alias("partition"),
    ).unionByName(
        entries.select(
            "user_id", F.lit(False).alias("is_header"), "event_time", "seq", (F.col("units") / F.lit(float(C.UNITS))).alias("sum"),
            F.when(F.col("deposit"), F.lit(C.DEPOSIT)).otherwise(F.lit(C.CREDIT)).alias("type"),
            nothing.cast("long").alias("first_ts"), "partition",
        )
    )
