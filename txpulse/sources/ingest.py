"""Ingest: Kafka-shaped records -> clean transactions + quarantined rejects.

``parse_transactions`` (S1, P1-P5, D4) follows the stream job's reading:
PERMISSIVE JSON, types compared case-insensitively later, unknown keys ignored.
Unlike the reference, a row whose ``sum`` or ``event_time`` is missing is
quarantined instead of failing the query, and so is one whose amount or time
is out of range or whose amount is finer than the exact unit.

``parse_typed_transactions`` (S2) is the plain consumer's strict reading:
exact ``decimal(18,2)`` amount (more digits are rejected, never rounded) and
a closed, case-sensitive type domain.

Both parse the JSON once: the parsed struct is produced by a generator
(``inline``), so the optimizer cannot copy the parse into the row filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from txpulse.functions import constants as C
from txpulse.functions.columns import amount_fault
from txpulse.schemas import CORRUPT_COLUMN, TRANSACTION_JSON, TYPED_TRANSACTION_JSON

JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}

# The closed type domain of the strict reading.
TYPE_DOMAIN = (C.DEPOSIT, C.CREDIT)
AMOUNT = DecimalType(18, 2)


def _parse(df: DataFrame, schema) -> DataFrame:
    raw = F.col("value").cast("string")
    parsed = F.from_json(raw, schema, JSON_OPTIONS)
    # one-element array + inline: the struct is generated once per row
    return df.select(
        "partition",
        "offset",
        "timestamp",
        raw.alias("raw"),
        F.inline(F.array(parsed)),
    )


def _first_failure(checks: list[tuple[Column, str]]) -> Column:
    out = None
    for bad, reason in checks:
        out = F.when(bad, F.lit(reason)) if out is None else out.when(bad, F.lit(reason))
    return out


CLEAN = ("user_id", "type", "sum", "event_time", "seq")
REJECT = ("partition", "offset", "reason", "malformed", "raw")


def judged_transactions(kafka_df: DataFrame, max_ahead_ms: int | None = None) -> DataFrame:
    """Every record once, parsed, with the ``reason`` why it is rejected (null: clean).

    With ``max_ahead_ms`` a time further ahead of the record's own timestamp is
    a reason too: one such row would move a stream's watermark past all others.
    """
    p = _parse(kafka_df, TRANSACTION_JSON)
    missing = _first_failure(
        [
            (F.col("raw").isNull(), "null_value"),
            (F.col("user_id").isNull(), "null_user_id"),
            (F.col("sum").isNull(), "null_sum"),
            (F.col("event_time").isNull(), "null_event_time"),
        ]
    )
    times = [(~F.col("event_time").between(C.MIN_TIME_MS, C.MAX_TIME_MS), "event_time_out_of_range")]
    if max_ahead_ms is not None:
        times.append((F.col("event_time") > F.unix_millis("timestamp") + F.lit(max_ahead_ms), "event_time_ahead"))
    reason = F.coalesce(missing, amount_fault("sum"), _first_failure(times))
    return p.select(
        "user_id", "type", "sum", "event_time", F.col("offset").alias("seq"),
        "partition", "offset", reason.alias("reason"), F.col(CORRUPT_COLUMN).isNotNull().alias("malformed"), "raw",
    )


def parse_transactions(kafka_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects). clean: user_id, type, sum, event_time, seq (= offset).

    ``offset`` orders a user's records when the topic is keyed by user (one
    partition per user), which is what the tie rule needs.
    """
    rows = judged_transactions(kafka_df)
    return rows.where(F.col("reason").isNull()).select(*CLEAN), rows.where(F.col("reason").isNotNull()).select(*REJECT)


def parse_typed_transactions(kafka_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) under the strict reading; sum is decimal(18,2)."""
    p = _parse(kafka_df, TYPED_TRANSACTION_JSON)
    exact = F.col("sum").try_cast(AMOUNT)  # null when it overflows decimal(18,2)
    reason = _first_failure(
        [
            (F.col("raw").isNull(), "null_value"),
            (F.col("user_id").isNull(), "null_user_id"),
            (~F.coalesce(F.col("type").isin(*TYPE_DOMAIN), F.lit(False)), "bad_type"),
            (F.col("sum").isNull(), "null_sum"),
            (F.coalesce(exact != F.col("sum"), F.lit(True)), "bad_sum_precision"),
        ]
    )
    p = p.withColumn("reason", reason)
    accepted = p.where(F.col("reason").isNull()).select(
        "partition", "offset", "user_id", "firstname", "lastname", "type", exact.alias("sum")
    )
    rejects = p.where(F.col("reason").isNotNull()).select(
        "partition",
        "offset",
        "reason",
        F.col(CORRUPT_COLUMN).isNotNull().alias("malformed"),
        "raw",
    )
    return accepted, rejects
