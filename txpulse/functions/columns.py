"""Column builders shared by the batch and the streaming forms.

All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from txpulse.functions import constants as C


def is_type(col: Column | str, name: str) -> Column:
    """Case-insensitive type test; null type is false, never null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.lower(c) == F.lit(name.lower()), F.lit(False))


def to_units(col: Column | str) -> Column:
    """Amount as an exact integer number of units of 1/UNITS; window sums are done on these.

    Half a unit rounds away from zero, here and in the streaming form. Null if
    it is no number or too large for a long, so one bad row fails no job.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * F.lit(C.UNITS)).try_cast("long")


def amount_fault(col: Column | str) -> Column:
    """Why an amount cannot be kept exactly: ``sum_out_of_range``, ``sum_too_fine``, else null."""
    c = F.col(col) if isinstance(col, str) else col
    scaled = c * F.lit(float(C.UNITS))
    # a double of a few digits is off its decimal value by some units in the last place
    slack = F.greatest(F.lit(1e-6), F.abs(scaled) * F.lit(2.0**-50))
    return F.when(F.isnan(c) | (F.abs(c) > F.lit(C.MAX_AMOUNT)), F.lit("sum_out_of_range")).when(
        F.abs(scaled - F.round(scaled)) > slack, F.lit("sum_too_fine")
    )


def epoch_millis(df_field_type, col: Column) -> Column:
    """Epoch milliseconds of a timestamp column, flooring finer digits.

    TIMESTAMP_NTZ is read as UTC wall time from its date and time fields, so
    the result does not depend on the session time zone.
    """
    if isinstance(df_field_type, TimestampNTZType):
        return (
            F.unix_date(col.cast("date")).cast("long") * F.lit(86_400_000)
            + F.hour(col).cast("long") * F.lit(3_600_000)
            + F.minute(col).cast("long") * F.lit(60_000)
            + (F.date_part(F.lit("SECOND"), col) * F.lit(1000)).cast("long")
        )
    if isinstance(df_field_type, TimestampType):
        return F.unix_millis(col)
    return col.cast("long")


def mean_from_units(total_units: Column, n: Column) -> Column:
    """Mean amount from a total in units and a count, one rounding; 0.0 when n = 0."""
    return F.when(n > 0, total_units.cast("double") / (n * F.lit(C.UNITS)).cast("double")).otherwise(
        F.lit(0.0)
    )


def anomaly_condition(
    type_col: Column, sum_units: Column, prior_units: Column, prior_n: Column, factor: float
) -> Column:
    """Credit AND mean > 0 AND sum >= factor * mean, in exact integer arithmetic.

    ``sum >= f * total / n`` with n > 0 is ``sum * n >= f * total``.
    """
    return (
        is_type(type_col, C.CREDIT)
        & (prior_n > 0)
        & (prior_units > 0)
        & (
            sum_units.cast("decimal(20,0)") * prior_n.cast("decimal(12,0)")
            >= F.lit(Decimal(str(factor))) * prior_units.cast("decimal(20,0)")
        )
    )


def alert_message(factor: float) -> str:
    if factor == C.ANOMALY_FACTOR:
        return C.ALERT_MESSAGE
    return f"Credit >= {factor:g} * avg_check_5min"
