"""RFM segmentation, batch form.

Per transaction, over the same user's trailing ``window_ms`` (row included):
``f`` = count of all types, ``m`` = sum of Deposits; ``first_ts`` = start of
the user's activity epoch (a new epoch begins after an idle gap of at least
``retention_ms``, when the reference's stored state would have expired);
``r_minutes`` per ``recency``; then the ordered segment CASE.

Plan: one shuffle on ``(user_id, bucket)`` for the frames (see ``windows``),
plus a per-(user, bucket) summary - one row per user-bucket, small - that
carries state across buckets: the epoch start, the previous bucket's last
event, and the user's last event. The summary is joined back on the same
``(user_id, bucket)`` keys, so the big side keeps its partitioning.

Seeding (S3): ``seed_headers`` / ``seed_entries`` (a snapshot written by
``rfm_snapshot``) take part in frames and epochs but are never emitted.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txpulse.functions import constants as C
from txpulse.functions.columns import is_type, to_units
from txpulse.operators.windows import BUCKET, COPY, TimeSplit, bucket_width, hot_groups, time_bucket, width_for_hottest
from txpulse.session import checkpoint_root

RECENCY_MODES = ("reference", "gap")

# frame totals: f counts every row, m_units sums Deposit units
MEASURES = {"f": None, "m_units": "dep_units"}


@dataclass(frozen=True)
class RfmRules:
    """Windows and thresholds; defaults are the reference's.

    ``recency="reference"`` keeps the reference's r_minutes, which is always
    0.0 (the last-seen mark is moved before recency is taken, so "sleeping"
    never fires); ``"gap"`` uses the time since the user's previous
    transaction within the activity epoch (0.0 on an epoch's first row).
    """

    window_ms: int = C.RFM_WINDOW_MS
    retention_ms: int = C.SNAPSHOT_TTL_MS
    newcomer_ms: int = C.NEWCOMER_MS
    vip_min_m: float = C.VIP_MIN_M
    vip_min_f: int = C.VIP_MIN_F
    active_min_m: float = C.ACTIVE_MIN_M
    active_min_f: int = C.ACTIVE_MIN_F
    sleeping_min_r_minutes: float = C.SLEEPING_MIN_R_MINUTES
    recency: str = "reference"

    def __post_init__(self):
        if self.recency not in RECENCY_MODES:
            raise ValueError(f"recency must be one of {RECENCY_MODES}")
        if self.retention_ms < self.window_ms:
            raise ValueError("retention_ms must be at least window_ms")

    def with_(self, **kw) -> RfmRules:
        return replace(self, **kw)


# Thresholds used by the scaled query set: reachable on the generated data.
SCALED_RULES = RfmRules(
    retention_ms=C.RFM_WINDOW_MS, vip_min_m=300, active_min_m=100, recency="gap"
)


def segment_label(rules: RfmRules, tenure_ms: Column, f: Column, m_units: Column, r_minutes: Column) -> Column:
    """The ordered segment CASE, strict inequalities, m compared in units."""
    return (
        F.when(tenure_ms < F.lit(rules.newcomer_ms), F.lit(C.SEGMENT_NEWCOMER))
        .when((m_units > F.lit(rules.vip_min_m * C.UNITS)) & (f > F.lit(rules.vip_min_f)), F.lit(C.SEGMENT_VIP))
        .when(
            (m_units > F.lit(rules.active_min_m * C.UNITS)) & (f > F.lit(rules.active_min_f)),
            F.lit(C.SEGMENT_ACTIVE),
        )
        .when(r_minutes > F.lit(float(rules.sleeping_min_r_minutes)), F.lit(C.SEGMENT_SLEEPING))
        .otherwise(F.lit(C.SEGMENT_STANDARD))
    )


def _rows(tx: DataFrame, seed_entries: DataFrame | None) -> DataFrame:
    cols = [
        F.col("user_id").cast("int").alias("user_id"),
        "type",
        "sum",
        "event_time",
        "seq",
    ]
    rows = tx.select(*cols, F.lit(True).alias("_emit"))
    if seed_entries is not None:
        rows = rows.unionByName(seed_entries.select(*cols, F.lit(False).alias("_emit")))
    return rows.select(
        "*",
        to_units("sum").alias("units"),
        F.when(is_type("type", C.DEPOSIT), to_units("sum")).otherwise(F.lit(0).cast("long")).alias("dep_units"),
    )


def _summary_agg(rows: DataFrame, seed_headers: DataFrame | None, width: int) -> DataFrame:
    """Per (user, bucket): first emitted time, last time, seeded flag, row count
    and the frame measures' totals. Plain aggregates: combined map-side."""
    zero = F.lit(0).cast("long")
    src = rows.select(
        "user_id",
        time_bucket("event_time", width).alias("_sb"),
        F.when(F.col("_emit"), F.col("event_time")).alias("_lo"),
        F.col("event_time").alias("_hi"),
        F.lit(False).alias("_seeded"),
        F.lit(1).cast("long").alias("_v_f"),
        F.col("dep_units").alias("_v_m_units"),
    )
    if seed_headers is not None:
        src = src.unionByName(
            seed_headers.select(
                F.col("user_id").cast("int").alias("user_id"),
                time_bucket("last_ts", width).alias("_sb"),
                F.col("first_ts").alias("_lo"),
                F.col("last_ts").alias("_hi"),
                F.lit(True).alias("_seeded"),
                zero.alias("_v_f"),
                zero.alias("_v_m_units"),
            )
        )
    return src.groupBy("user_id", "_sb").agg(
        F.min("_lo").alias("_lo"),
        F.max("_hi").alias("_hi"),
        F.max("_seeded").alias("_seeded"),
        *[F.sum(f"_v_{name}").alias(f"_T_{name}") for name in MEASURES],
    )


def _summary(
    agg: DataFrame, split: TimeSplit, rules: RfmRules, tenures: dict[str, int] | None = None
) -> DataFrame:
    """One row per (user, bucket): epoch start, previous event, user's last event,
    and (narrow split) the frame totals of the whole buckets in between."""
    by_time = Window.partitionBy("user_id").orderBy("_sb")
    prev_ts = F.lag("_hi").over(by_time)

    def epoch_first(retention_ms: int) -> Column:
        # B <= retention: a gap that long can only fall between buckets
        starts = F.col("_seeded") | prev_ts.isNull() | (F.col("_lo") - prev_ts >= F.lit(retention_ms))
        return F.last(F.when(starts, F.col("_lo")), ignorenulls=True).over(
            by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )

    user_last = F.max("_hi").over(Window.partitionBy("user_id"))
    between = split.between("user_id", MEASURES, bucket_col="_sb")
    return agg.select(
        "user_id",
        F.col("_sb").alias(BUCKET),
        prev_ts.alias("_prev_bucket_ts"),
        epoch_first(rules.retention_ms).alias("first_ts"),
        *[epoch_first(ms).alias(name) for name, ms in (tenures or {}).items()],
        user_last.alias("_user_last"),
        (F.col("_hi") == user_last).alias("_last_bucket"),
        *[c.alias(f"_between_{n}") for n, c in between.items()],
    )


def rfm_detail(
    tx: DataFrame,
    rules: RfmRules = RfmRules(),
    bucket_ms: int | str | None = "auto",
    seed_headers: DataFrame | None = None,
    seed_entries: DataFrame | None = None,
    tenures: dict[str, int] | None = None,
) -> DataFrame:
    """Every row (seed rows included, ``_emit`` false) with its RFM values.

    Columns: user_id, type, sum, event_time, seq, _emit, units, dep_units,
    f, m_units, m, first_ts, prev_ts, r_minutes, segment, is_last, in_tail,
    user_last_ts, and one first-seen column per entry of ``tenures``
    (name -> another retention), computed in the same pass.
    """
    rows = _rows(tx, seed_entries)
    max_ms = min([rules.retention_ms, *(tenures or {}).values()])
    if any(ms < rules.window_ms for ms in (tenures or {}).values()):
        raise ValueError("every retention must be at least the window")
    if bucket_ms == "auto":
        # the sizing pass is the summary aggregate itself, at the default width:
        # written to the shared checkpoint folder and reused unless there are
        # hot users, whose rows alone are then split more narrowly
        checkpoint_root(rows.sparkSession)
        default = bucket_width(rules.window_ms, None, max_ms=max_ms)
        agg = _summary_agg(rows, seed_headers, default).checkpoint()
        hot, hottest = hot_groups(agg.where("_sb IS NOT NULL"), "user_id", "_T_f")
        if hottest is not None:
            hot = hot.checkpoint()
            narrow = width_for_hottest(hottest, rules.window_ms, max_ms=max_ms)

            def part(how: str, width: int) -> DataFrame:
                seeds = [s if s is None else s.join(hot, "user_id", how) for s in (seed_headers, seed_entries)]
                return rfm_detail(tx.join(hot, "user_id", how), rules, width, *seeds, tenures)

            return part("left_anti", default).unionByName(part("left_semi", narrow))
        width = default
    else:
        width = bucket_width(rules.window_ms, bucket_ms, max_ms=max_ms)
        agg = _summary_agg(rows, seed_headers, width)
    split = TimeSplit(rules.window_ms, width)
    totals = split.totals("user_id", "seq", include_current=True, measures=MEASURES)
    stats = (
        split.split(rows, "event_time")
        .select(
            *rows.columns,
            BUCKET,
            COPY,
            *[c.alias(f"_in_{n}") for n, c in totals.items()],
            split.previous_own("user_id", "event_time", "seq").alias("_prev_in"),
            split.last_own("user_id", "seq").alias("_last_in_bucket"),
        )
        .where(~F.col(COPY))
    )
    # Sort-merge on the frame's own partitioning and order: only the small
    # summary side moves; the plan does not depend on a size estimate.
    summary = _summary(agg, split, rules, tenures).hint("merge")
    # left: a row without a user or a time has no bucket summary; it is kept, with nulls
    joined = stats.join(summary, on=["user_id", BUCKET], how="left").select(
        "*", *[(F.col(f"_in_{n}") + F.col(f"_between_{n}")).alias(n) for n in MEASURES]
    )
    prev_ts = F.coalesce(F.col("_prev_in"), F.col("_prev_bucket_ts"))
    if rules.recency == "gap":
        # recency resets with the activity epoch: an epoch's first row has no
        # stored previous transaction (the state expired), as in the stream
        gap = F.col("event_time") - prev_ts
        r_minutes = (
            F.when(prev_ts.isNull() | (gap >= F.lit(rules.retention_ms)), F.lit(0.0))
            .otherwise(gap / F.lit(60000.0))
        )
    else:
        r_minutes = F.lit(0.0)
    last = F.col("_user_last")
    keyed = F.col("user_id").isNotNull() & F.col("event_time").isNotNull()

    def known(c):
        return F.when(keyed, c)

    return joined.select(
        *rows.columns,
        known(F.col("f")).alias("f"),
        known(F.col("m_units")).alias("m_units"),
        known(F.col("m_units") / F.lit(float(C.UNITS))).alias("m"),
        "first_ts",
        prev_ts.alias("prev_ts"),
        known(r_minutes).alias("r_minutes"),
        known(
            segment_label(rules, F.col("event_time") - F.col("first_ts"), F.col("f"), F.col("m_units"), r_minutes)
        ).alias("segment"),
        # the last row, in (event_time, seq) order, of the user's last bucket
        F.coalesce(F.col("_last_bucket") & F.col("_last_in_bucket"), F.lit(False)).alias("is_last"),
        F.coalesce(F.col("event_time") >= last - F.lit(rules.window_ms), F.lit(False)).alias("in_tail"),
        last.alias("user_last_ts"),
        *(tenures or {}),
    )


def rfm_segments(
    tx: DataFrame,
    rules: RfmRules = RfmRules(),
    bucket_ms: int | str | None = "auto",
    seed_headers: DataFrame | None = None,
    seed_entries: DataFrame | None = None,
) -> DataFrame:
    """One segment event per transaction: user_id, seq, segment, r_minutes, f, m, updated_at."""
    d = rfm_detail(tx, rules, bucket_ms, seed_headers, seed_entries)
    return d.where(F.col("_emit")).select(
        "user_id",
        "seq",
        "segment",
        "r_minutes",
        "f",
        "m",
        F.col("event_time").alias("updated_at"),
    )


def rfm_latest(detail: DataFrame) -> DataFrame:
    """The state after each user's last transaction (what the KV snapshot holds).

    The last row is flagged inside ``rfm_detail`` from the per-bucket summary,
    so this is a filter: no extra shuffle, no per-user sort.
    """
    return detail.where(F.col("is_last"))


def rfm_current(tx: DataFrame, rules: RfmRules = RfmRules(), as_of: int | None = None) -> DataFrame:
    """Each user's state after the last transaction, or at ``as_of`` (epoch ms): one row per user.

    Columns: user_id, seq, event_time (of the last row), f, m_units, m,
    first_ts, prev_ts, r_minutes, segment. Equals the last row of
    ``rfm_detail``, without a window over the transactions: the last time and
    the epoch start come from the per-(user, bucket) summary, and one
    conditional aggregate over the rows that follow gives the rest. Where the
    per-user table is small enough to be broadcast, that aggregate is combined
    map-side and no transaction is shuffled. With ``as_of``, the frame ends
    there and recency is the time since the last transaction.
    """
    rows = _rows(tx, None).where("user_id IS NOT NULL AND event_time IS NOT NULL")
    width = bucket_width(rules.window_ms, None, max_ms=rules.retention_ms)
    summary = _summary(_summary_agg(rows, None, width), TimeSplit(rules.window_ms, width), rules)
    users = summary.where("_last_bucket").select("user_id", "first_ts", F.col("_user_last").alias("last_ts"))
    time, last = F.col("event_time"), F.col("last_ts")
    inside = time >= (last if as_of is None else F.lit(as_of)) - F.lit(rules.window_ms)
    per_user = (
        rows.join(users, "user_id")
        .where(time > last - F.lit(rules.retention_ms))  # an older previous row is of another epoch
        .groupBy("user_id", "first_ts", "last_ts")
        .agg(
            F.count_if(inside).alias("f"),
            F.coalesce(F.sum(F.when(inside, F.col("dep_units"))), F.lit(0).cast("long")).alias("m_units"),
            F.max(F.when(time == last, F.col("seq"))).alias("seq"),
            F.when(F.count_if(time == last) > 1, last).otherwise(F.max(F.when(time < last, time))).alias("prev_ts"),
        )
    )
    if as_of is not None:
        r_minutes = (F.lit(as_of) - last) / F.lit(60000.0)
    elif rules.recency == "gap":
        r_minutes = F.coalesce((last - F.col("prev_ts")) / F.lit(60000.0), F.lit(0.0))
    else:
        r_minutes = F.lit(0.0)
    tenure = (last if as_of is None else F.lit(as_of)) - F.col("first_ts")
    return per_user.select(
        "user_id", "seq", last.alias("event_time"), "f", "m_units",
        (F.col("m_units") / F.lit(float(C.UNITS))).alias("m"), "first_ts", "prev_ts",
        r_minutes.alias("r_minutes"),
        segment_label(rules, tenure, F.col("f"), F.col("m_units"), r_minutes).alias("segment"),
    )
