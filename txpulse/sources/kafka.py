"""Kafka source (S1) and Kafka-shaped frames built from the generated tables.

No Kafka connector ships with this environment, so the live source is a thin
options function; everything downstream takes any DataFrame of the Kafka
record shape (``key, value, topic, partition, offset, timestamp,
timestampType``), batch or streaming.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpulse.functions import constants as C

# Default topic names.
INPUT_TOPIC = "user-transactions"
ALERTS_TOPIC = "alerts"
SEGMENTS_TOPIC = "user-segments"

# Deterministic corruption of the wire records, for the quarantine checks:
# every 17th event (event_id % 17 == 0) is damaged in one of these ways,
# chosen by (event_id div 17) % 7.
CORRUPT_EVERY = 17
CORRUPT_KINDS = (
    "not_json",  # 0: the value is not JSON at all
    "no_user_id",  # 1: user_id key missing
    "no_sum",  # 2: sum key missing
    "sum_as_string",  # 3: "sum":"12.34" (a string is not a double)
    "fractional_event_time",  # 4: "event_time":<ms>.5 (not a long)
    "user_id_overflow",  # 5: user_id beyond int range
    "lowercase_type_extra_key",  # 6: type lower-cased, unknown key added (still valid)
)


# Every 13th event that ``strained`` changes, by (event_id div 13) % 5.
STRAIN_EVERY = 13
STRAINS = (
    "sum_out_of_range",  # 0: 1e20
    "sum_too_fine",  # 1: the amount plus a millionth
    "event_time_out_of_range",  # 2: the greatest long
    "",  # 3: an amount of four decimals, kept
    "",  # 4: the greatest amount that is kept
)


def strained(tx: DataFrame) -> DataFrame:
    """Transactions of which every 13th has an amount or time at or past what is kept exactly."""
    kind = F.when(F.pmod("seq", F.lit(STRAIN_EVERY)) == 0, F.pmod(F.expr(f"seq div {STRAIN_EVERY}"), F.lit(len(STRAINS))))
    amount = (
        F.when(kind == 0, F.lit(1e20)).when(kind == 1, F.col("sum") + 1e-6)
        .when(kind == 3, F.lit(0.0004)).when(kind == 4, F.lit(1e9)).otherwise(F.col("sum"))
    )
    time = F.when(kind == 2, F.lit(2**63 - 1)).otherwise(F.col("event_time"))
    return tx.withColumns({"sum": amount, "event_time": time})


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = INPUT_TOPIC,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming scan of one topic; needs the spark-sql-kafka package."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    try:
        return reader.load()
    except Exception as e:  # connector missing: say what to add
        raise_if_no_connector(e)
        raise


EARLIEST = -2  # Kafka's name for a partition's first offset


def kafka_offsets(topic: str, offsets: dict[int, int], partitions: int | None = None) -> str:
    """``startingOffsets`` for a topic of ``partitions`` partitions; one without an offset starts at its beginning."""
    if partitions is None:
        raise ValueError("startingOffsets needs the topic's number of partitions")
    return json.dumps({topic: {str(p): offsets.get(p, EARLIEST) for p in range(partitions)}})


def from_offsets(kafka_df: DataFrame, offsets: dict[int, int]) -> DataFrame:
    """Records at or after the given offset of their partition; partitions without one are whole.

    For a source that starts by itself at ``startingOffsets`` this keeps all;
    for any other Kafka-shaped frame it is the same start. ``offsets`` has one
    entry a source partition.
    """
    if not offsets:
        return kafka_df
    start = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])
    return kafka_df.where(F.col("offset") >= F.coalesce(F.try_element_at(start, F.col("partition")), F.lit(0)))


CONNECTOR_HINT = (
    "the Kafka connector is not on the classpath; add the spark-sql-kafka-0-10 package "
    "matching this Spark and Scala version to spark.jars.packages"
)


def raise_if_no_connector(e: Exception) -> None:
    text = str(e)
    if "DATA_SOURCE_NOT_FOUND" in text or "Failed to find data source: kafka" in text:
        raise RuntimeError(CONNECTOR_HINT) from e


def transactions_as_kafka(
    tx: DataFrame, topic: str = INPUT_TOPIC, partitions: int = 8, corrupt: bool = False, keyed: bool = True
) -> DataFrame:
    """Kafka-shaped records carrying transactions as JSON values.

    The key is the user id, so one user's records share a partition and
    ``offset`` orders them (``seq`` becomes the offset). With ``corrupt``,
    every 17th record is damaged as listed in ``CORRUPT_KINDS``. Without
    ``keyed`` a user's records are dealt over all partitions, against the order
    of their offsets.
    """
    u, t, s, e = (F.col(c) for c in ("user_id", "type", "sum", "event_time"))
    valid = F.to_json(F.struct(u.alias("user_id"), t.alias("type"), s.alias("sum"), e.alias("event_time")))
    value = valid
    if corrupt:
        kind = F.pmod(F.expr(f"seq div {CORRUPT_EVERY}"), F.lit(len(CORRUPT_KINDS)))
        sum_txt = s.cast("string")
        variants = [
            F.lit("not json"),
            F.to_json(F.struct(t.alias("type"), s.alias("sum"), e.alias("event_time"))),
            F.to_json(F.struct(u.alias("user_id"), t.alias("type"), e.alias("event_time"))),
            F.to_json(F.struct(u.alias("user_id"), t.alias("type"), sum_txt.alias("sum"), e.alias("event_time"))),
            F.to_json(
                F.struct(u.alias("user_id"), t.alias("type"), s.alias("sum"), (e + F.lit(0.5)).alias("event_time"))
            ),
            F.to_json(
                F.struct(
                    (u.cast("long") + F.lit(99_999_999_999)).alias("user_id"),
                    t.alias("type"),
                    s.alias("sum"),
                    e.alias("event_time"),
                )
            ),
            F.to_json(
                F.struct(
                    u.alias("user_id"),
                    F.lower(t).alias("type"),
                    s.alias("sum"),
                    e.alias("event_time"),
                    F.lit(9).alias("extra"),
                )
            ),
        ]
        damaged = F.when(kind == 0, variants[0])
        for i, variant in enumerate(variants[1:], start=1):
            damaged = damaged.when(kind == i, variant)
        value = F.when(F.pmod(F.col("seq"), F.lit(CORRUPT_EVERY)) == 0, damaged).otherwise(valid)
    return tx.select(
        u.cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.pmod(F.hash(u), F.lit(partitions)) if keyed else partitions - 1 - F.pmod("seq", F.lit(partitions)))
        .cast("int")
        .alias("partition"),
        F.col("seq").alias("offset"),
        # the record's own time; a producer's clock is not the event's
        F.timestamp_millis(F.when(e.between(C.MIN_TIME_MS, C.MAX_TIME_MS), e)).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
