"""Declared schemas: wire format, typed ingest, output events, snapshot."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

CORRUPT_COLUMN = "_corrupt_record"

# JSON value of an input record. Names are dropped right after parsing, so they
# are not declared: from_json then never materialises them.
TRANSACTION_JSON = StructType(
    [
        StructField("user_id", IntegerType()),
        StructField("type", StringType()),
        StructField("sum", DoubleType()),
        StructField("event_time", LongType()),
        StructField(CORRUPT_COLUMN, StringType()),
    ]
)

# Strict typed record of the plain consumer: exact amount, closed type domain.
TYPED_TRANSACTION_JSON = StructType(
    [
        StructField("user_id", IntegerType()),
        StructField("firstname", StringType()),
        StructField("lastname", StringType()),
        StructField("type", StringType()),
        # parsed wide, then checked to fit decimal(18,2) exactly (no silent rounding)
        StructField("sum", DecimalType(38, 10)),
        StructField(CORRUPT_COLUMN, StringType()),
    ]
)

# Shape of a Kafka source row (public Spark Kafka source).
KAFKA_RECORD = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

# Clean transactions after ingest; seq orders a user's rows that share a ms.
TRANSACTION = StructType(
    [
        StructField("user_id", IntegerType()),
        StructField("type", StringType()),
        StructField("sum", DoubleType()),
        StructField("event_time", LongType()),
        StructField("seq", LongType()),
    ]
)

ALERT = StructType(
    [
        StructField("user_id", IntegerType()),
        StructField("event_time", LongType()),
        StructField("seq", LongType()),
        StructField("type", StringType()),
        StructField("sum", DoubleType()),
        StructField("avg_check_5min", DoubleType()),
        StructField("message", StringType()),
    ]
)

SEGMENT = StructType(
    [
        StructField("user_id", IntegerType()),
        StructField("seq", LongType()),
        StructField("segment", StringType()),
        StructField("r_minutes", DoubleType()),
        StructField("f", LongType()),
        StructField("m", DoubleType()),
        StructField("updated_at", LongType()),
    ]
)

# Keyed snapshot of RFM state: one header row per user ...
SNAPSHOT_HEADER = StructType(
    [
        StructField("user_id", IntegerType()),
        StructField("first_ts", LongType()),
        StructField("last_ts", LongType()),
        StructField("last_seq", LongType()),
        StructField("f", LongType()),
        StructField("m", DoubleType()),
        StructField("r_minutes", DoubleType()),
        StructField("segment", StringType()),
        StructField("written_at", LongType()),
        StructField("expires_at", LongType()),
    ]
)

# ... and one row per buffered entry (the trailing window), never an array.
SNAPSHOT_ENTRY = StructType(
    [
        StructField("user_id", IntegerType()),
        StructField("event_time", LongType()),
        StructField("seq", LongType()),
        StructField("sum", DoubleType()),
        StructField("type", StringType()),
        StructField("expires_at", LongType()),
    ]
)
