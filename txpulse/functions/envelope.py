"""Key/value envelope of output events.

key = user_id as a string; value = JSON of the event's fields in the fixed
key order (the reference's bean order). Null fields are omitted by to_json.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from txpulse.functions import constants as C

ALERT_VALUE = StructType(
    [
        StructField("avg_check_5min", DoubleType()),
        StructField("event_time", LongType()),
        StructField("message", StringType()),
        StructField("sum", DoubleType()),
        StructField("type", StringType()),
        StructField("user_id", IntegerType()),
    ]
)

SEGMENT_VALUE = StructType(
    [
        StructField("f", LongType()),
        StructField("m", DoubleType()),
        StructField("r_minutes", DoubleType()),
        StructField("segment", StringType()),
        StructField("updated_at", LongType()),
        StructField("user_id", IntegerType()),
    ]
)


def to_kv(events: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(f) for f in fields])).alias("value"),
    )


def alerts_to_kv(alerts: DataFrame) -> DataFrame:
    return to_kv(alerts, C.ALERT_FIELDS)


def segments_to_kv(segments: DataFrame) -> DataFrame:
    return to_kv(segments, C.SEGMENT_FIELDS)


def _reparse(kv: DataFrame, schema: StructType) -> DataFrame:
    """Parse the value back; also report its key order, for round-trip checks."""
    return kv.select(
        "key",
        F.array_join(F.json_object_keys("value"), ",").alias("json_keys"),
        F.inline(F.array(F.from_json("value", schema))),
    )


def reparse_alert_kv(kv: DataFrame) -> DataFrame:
    return _reparse(kv, ALERT_VALUE)


def reparse_segment_kv(kv: DataFrame) -> DataFrame:
    return _reparse(kv, SEGMENT_VALUE)
