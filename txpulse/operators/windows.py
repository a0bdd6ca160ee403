"""Trailing event-time frames per key, exact under ties, split by time.

A row's trailing frame is every row of the same key with
``event_time >= t - W`` that comes before it in ``(event_time, seq)`` order
(optionally the row itself). Three properties drive the design:

* **O(n) frames.** Frame totals are built from running totals over frames
  that start at UNBOUNDED PRECEDING, which Spark evaluates incrementally (a
  sliding ``rangeBetween(-W, -1)`` frame is re-aggregated from its buffer
  whenever rows leave it). Totals are integer units, so differences are exact.

* **No key is one task.** Rows are partitioned by ``(key, bucket)`` with
  ``bucket = floor(event_time / B)``. Copies of rows (never emitted) bring
  each bucket what its frames need from earlier buckets:

  - *wide* (``B >= W``): a row that a later bucket's frames reach is copied
    into that bucket (a *halo*; at most one copy, a ``W / B`` share of rows).
    Total = rows seen so far - rows older than ``t - W``.
  - *narrow* (``B < W``, ``B`` divides ``W``): every row is copied once, its
    time shifted by ``+W``, into bucket ``own + W / B``. Total = rows of this
    bucket seen so far + shifted copies with shifted time ``>= t`` (the part
    of bucket ``b - W/B`` still in the frame) + the whole buckets in between,
    which come from a small per-(key, bucket) summary. A hot key then splits
    into tasks of ``2B`` of its data, for any ``B`` down to a second.

* **Sizing.** ``bucket_ms`` picks ``B``; ``"auto"`` keeps the default for
  all keys but those with a (key, default bucket) group above ``TARGET_ROWS``,
  found with one map-side-combined aggregate. Only those hot keys' rows take a
  narrower ``B``; everyone else's are neither copied more nor split further.

Rows without a time are in no frame; they are dealt over many buckets of
their own, not one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_MS = 86_400_000

#: Rows that a (key, bucket) task should hold at most, about.
TARGET_ROWS = 4_000_000
#: Buckets far before all others, for rows without a time.
TIMELESS, TIMELESS_BUCKETS = -(2**40), 4096

BUCKET = "_bucket"
COPY = "_copy"  # a copy of a row from an earlier bucket: in frames, never emitted
ORD = "_ord"  # order time inside a bucket (shifted by +W for narrow copies)


def _measure(v: Column | str | None) -> Column:
    """A measure: None counts rows, a string names a column."""
    if v is None:
        return F.lit(1).cast("long")
    return F.col(v) if isinstance(v, str) else v


def largest_divisor_at_most(n: int, cap: int) -> int:
    """Largest divisor of ``n`` not above ``cap`` (at least 1)."""
    best = 1
    i = 1
    while i * i <= n:
        if n % i == 0:
            for d in (i, n // i):
                if best < d <= cap:
                    best = d
        i += 1
    return best


def bucket_width(window_ms: int, bucket_ms: int | None = None, max_ms: int | None = None) -> int:
    """Bucket width B (at most ``max_ms`` when given).

    Default: the larger of 4 W and one day, so at most a quarter of the rows
    are copied while a bucket still holds little of a long history. A width
    below W is snapped down to a divisor of W (the narrow split needs one).
    """
    width = bucket_ms or max(4 * window_ms, DAY_MS)
    if max_ms is not None:
        width = min(width, max_ms)
    if width <= 0:
        raise ValueError(f"bucket width must be positive, got {width}")
    if width < window_ms:
        width = largest_divisor_at_most(window_ms, width)
    return int(width)


def time_bucket(time_col: str, width: int) -> Column:
    """floor(time / width) in exact integer arithmetic."""
    return _floor_div(time_col, width)


def _floor_div(expr_sql: str, width: int) -> Column:
    return F.expr(f"(({expr_sql}) - pmod({expr_sql}, {width})) div {width}")


def width_for_hottest(
    hottest: int | None,
    window_ms: int,
    max_ms: int | None = None,
    target_rows: int | None = None,
    min_ms: int = 1000,
) -> int:
    """Bucket width given the row count of the hottest (key, default bucket) group.

    Ordinary data keeps the default; a hot key gets narrower buckets (wide: a
    task holds about rate * (B + W) rows; narrow: about 2 * rate * B).
    """
    target_rows = target_rows or TARGET_ROWS
    width = bucket_width(window_ms, None, max_ms)
    if not hottest or hottest <= target_rows:
        return width
    rate = hottest / width  # rows per ms in the hottest bucket
    wide = target_rows / rate - window_ms
    if wide >= window_ms:
        return int(min(width, wide))
    narrow = max(min_ms, int(target_rows / (2 * rate)))
    return bucket_width(window_ms, min(narrow, window_ms - 1), max_ms)


def auto_bucket_width(
    df: DataFrame,
    key: str,
    time_col: str,
    window_ms: int,
    max_ms: int | None = None,
    target_rows: int | None = None,
    min_ms: int = 1000,
) -> int:
    """One width for all keys, whose hottest (key, bucket) task holds about ``target_rows`` rows.

    One aggregate over (key, default bucket) - combined map-side, one scalar
    to the driver.
    """
    width = bucket_width(window_ms, None, max_ms)
    hottest = (
        df.where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
        .groupBy(key, time_bucket(time_col, width).alias("_b")).count().agg(F.max("count")).first()[0]
    )
    return width_for_hottest(hottest, window_ms, max_ms, target_rows, min_ms)


def hot_groups(counts: DataFrame, key: str, n: str) -> tuple[DataFrame, int | None]:
    """(keys with a group above TARGET_ROWS, the largest group or None) of per-(key, bucket) counts."""
    over = counts.where(F.col(key).isNotNull() & (F.col(n) > F.lit(TARGET_ROWS)))
    return over.select(key).distinct(), over.agg(F.max(n)).first()[0]


class TimeSplit:
    """How rows are split by time for trailing frames of width ``window_ms``."""

    def __init__(self, window_ms: int, width: int):
        self.window_ms = int(window_ms)
        self.width = int(width)
        self.narrow = self.width < self.window_ms
        if self.narrow and self.window_ms % self.width:
            raise ValueError("a narrow bucket width must divide the window")
        self.k = self.window_ms // self.width if self.narrow else 0

    def split(self, df: DataFrame, time_col: str) -> DataFrame:
        """Add BUCKET, COPY and ORD; copies bring earlier rows to later buckets."""
        w, t = self.window_ms, F.col(time_col)
        own = time_bucket(time_col, self.width)
        if self.narrow:
            out = df.select("*", own.alias("_own"), F.explode(F.array(F.lit(False), F.lit(True))).alias(COPY))
            bucket = F.when(F.col(COPY), F.col("_own") + self.k).otherwise(F.col("_own"))
            return out.where(F.col("_own").isNotNull() | ~F.col(COPY)).select(
                *df.columns,
                F.coalesce(bucket, self._timeless(df)).alias(BUCKET),
                COPY,
                F.when(F.col(COPY), t + F.lit(w)).otherwise(t).alias(ORD),
            )
        reach = _floor_div(f"{time_col} + {w}", self.width)
        # explode_outer: a row without a time keeps one (bucket-less) own copy
        out = df.select("*", own.alias("_own"), F.explode_outer(F.sequence(own, reach)).alias(BUCKET))
        copy = F.coalesce(F.col(BUCKET) != F.col("_own"), F.lit(False))
        bucket = F.coalesce(F.col(BUCKET), self._timeless(df))
        return out.select(*df.columns, bucket.alias(BUCKET), copy.alias(COPY), t.alias(ORD))

    @staticmethod
    def _timeless(df: DataFrame) -> Column:
        return F.lit(TIMELESS) - F.pmod(F.xxhash64(*df.columns), F.lit(TIMELESS_BUCKETS))

    def _part(self, key: str):
        return Window.partitionBy(key, BUCKET)

    def totals(
        self, key: str, seq_col: str, include_current: bool, measures: dict[str, Column | str | None]
    ) -> dict[str, Column]:
        """In-partition frame totals per row; a measure of None counts rows.

        For the narrow split, add ``between`` from the summary.
        """
        zero = F.lit(0).cast("long")
        part = self._part(key)
        upto = Window.currentRow if include_current else -1
        seen = part.orderBy(ORD, seq_col).rowsBetween(Window.unboundedPreceding, upto)
        out = {}
        if not self.narrow:
            older = part.orderBy(ORD).rangeBetween(Window.unboundedPreceding, -(self.window_ms + 1))
            for name, v in measures.items():
                v = _measure(v)
                out[name] = F.coalesce(F.sum(v).over(seen), zero) - F.coalesce(F.sum(v).over(older), zero)
            return out
        before = part.orderBy(ORD).rangeBetween(Window.unboundedPreceding, -1)
        copy = F.col(COPY)
        for name, v in measures.items():
            v = _measure(v)
            own_v = F.when(~copy, v).otherwise(zero)
            far_v = F.when(copy, v).otherwise(zero)
            out[name] = (
                F.coalesce(F.sum(own_v).over(seen), zero)
                + F.coalesce(F.sum(far_v).over(part), zero)
                - F.coalesce(F.sum(far_v).over(before), zero)
            )
        return out

    def bucket_sums(self, measures: dict[str, Column | str | None]) -> list[Column]:
        """Aggregates for the per-(key, bucket) summary (narrow split only)."""
        if not self.narrow:
            return []
        return [
            F.sum(_measure(v)).alias(f"_T_{name}") for name, v in measures.items()
        ]

    def between(self, key: str, measures: dict[str, Column | str | None], bucket_col: str = BUCKET) -> dict[str, Column]:
        """Per summary row: totals of the whole buckets strictly between b - W/B and b."""
        zero = F.lit(0).cast("long")
        if not self.narrow or self.k <= 1:
            return {name: zero for name in measures}
        span = Window.partitionBy(key).orderBy(bucket_col).rangeBetween(-(self.k - 1), -1)
        return {name: F.coalesce(F.sum(f"_T_{name}").over(span), zero) for name in measures}

    def previous_own(self, key: str, time_col: str, seq_col: str) -> Column:
        """Event time of the previous own (non-copy) row in the bucket, else null."""
        w = self._part(key).orderBy(ORD, seq_col).rowsBetween(Window.unboundedPreceding, -1)
        return F.last(F.when(~F.col(COPY), F.col(time_col)), ignorenulls=True).over(w)

    def last_own(self, key: str, seq_col: str) -> Column:
        """True for the bucket's last own row in (time, seq) order."""
        part = self._part(key)
        run = part.orderBy(ORD, seq_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        own = F.when(~F.col(COPY), F.lit(1)).otherwise(F.lit(0))
        return F.sum(own).over(run) == F.sum(own).over(part)
