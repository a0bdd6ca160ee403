"""Transactions derived from the generated tables.

``events``  -> transactions: user_id, type, sum, event_time (epoch ms), seq.
``orders``  -> transactions with ties on (user, ms), to exercise the tie rule.

Only the needed columns are selected, so the parquet scan reads just those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpulse.functions import constants as C
from txpulse.functions.columns import epoch_millis

# Which event types count as a Credit (everything else is a Deposit).
CREDIT_EVENT_TYPES = ("purchase", "error")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    ts_type = ev.schema["ts"].dataType
    return ev.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.when(F.col("event_type").isin(*CREDIT_EVENT_TYPES), F.lit(C.CREDIT))
        .otherwise(F.lit(C.DEPOSIT))
        .alias("type"),
        F.col("value").alias("sum"),
        epoch_millis(ts_type, F.col("ts")).alias("event_time"),
        F.col("event_id").alias("seq"),
    )


def orders_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions: many customers have several orders on one date."""
    o = read_table(spark, sf_dir, "orders")
    ts_type = o.schema["o_orderdate"].dataType
    return o.select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(C.CREDIT))
        .otherwise(F.lit(C.DEPOSIT))
        .alias("type"),
        F.col("o_totalprice").alias("sum"),
        epoch_millis(ts_type, F.col("o_orderdate")).alias("event_time"),
        F.col("o_orderkey").alias("seq"),
    )
