"""Keyed stateful processors (T1-T4) for ``transformWithStateInPandas``.

A user's trailing window is kept in time buckets. One head row holds the epoch
marks, the newest entries and, for each older bucket, its count and sums; the
older entries themselves are one map row a bucket. A micro-batch reads the head
and only those buckets in which a frame of its rows begins or a row falls: a
whole bucket in between counts by its sums. A batch of a user with a million
entries so touches a few per cent of them, and a small user is one head row.

Each micro-batch's rows for a user are sorted by (event_time, partition, seq)
and merged with the entries; frame totals come from prefix sums and
``searchsorted``, so a batch costs O(n log n) vectorised work.

A call of the operator costs some milliseconds whatever it does (state reads and
writes, timers, an Arrow batch out), so a stream is not keyed by user but by
shard: ``ShardProcessor`` judges a shard's users in one call, holds their heads
in one state row and sets one timer for the first of them to expire.

Semantics equal the batch operators: a row sees the entries before it in
that order that are within the window. Entries are dropped once they are
older than ``min(newest, watermark) - window``: no row the watermark still
admits can reach them. In EventTime mode a timer clears an idle user's state.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from txpulse.functions import constants as C
from txpulse.functions.columns import alert_message
from txpulse.operators.rfm import RfmRules

log = logging.getLogger("txpulse.state")

# a user whose trailing window holds more entries than this is logged (hot key)
WARN_ENTRIES = 1_000_000

# buckets a window is cut into, and entries that a head row holds before its
# older buckets move to the map (a bucket is never split)
BUCKETS = 64
HEAD_ENTRIES = 1024

ENTRIES = "ts array<long>, part array<int>, seq array<long>, units array<long>, deposit array<boolean>"
# timer_at: the expiry timer currently armed (EventTime mode), so moving it
# costs one delete and one register, not a listing of the key's timers
HEAD_STATE = (
    f"{ENTRIES}, b_id array<long>, b_n array<long>, b_last array<long>, b_units array<long>, b_deposits array<long>, "
    "first_ts long, last_ts long, timer_at long"
)
_KINDS = ("int64", "int32", "int64", "int64", "bool")
_NO_HEAD = ((),) * 10 + (None, None, None)

# Columns of the initial-state frame for the RFM processor (snapshot rows).
RFM_SEED = "user_id int, is_header boolean, event_time long, seq long, sum double, type string, first_ts long, partition int"


def _units(x: np.ndarray) -> np.ndarray:
    """Like ``to_units``: half a unit away from zero. What no ingest lets through ends the batch, not the sums."""
    scaled = x.astype("float64") * float(C.UNITS)
    if not (np.abs(scaled) <= C.MAX_AMOUNT * C.UNITS).all():
        raise ValueError("an amount is out of range; quarantine it before the operator")
    return (np.sign(scaled) * np.floor(np.abs(scaled) + 0.5)).astype("int64")


def _is_type(types, name: str) -> np.ndarray:
    want = name.lower()
    return np.fromiter((t is not None and t.lower() == want for t in types), dtype=bool, count=len(types))


class _Rows:
    """A user's rows of one micro-batch as numpy arrays, sorted by (event_time, partition, seq).

    Per-user groups are small; plain arrays avoid pandas' per-call overhead.
    """

    __slots__ = ("user_id", "ts", "part", "seq", "sum", "type", "n")

    def __init__(self, frames: Iterator[pd.DataFrame]):
        frames = list(frames)
        df = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        part = df["partition"].to_numpy("int32") if "partition" in df else np.zeros(len(df), "int32")
        self.ts, self.part, self.seq = df["event_time"].to_numpy("int64"), part, df["seq"].to_numpy("int64")
        self.sum = df["sum"].to_numpy("float64")
        self.type = df["type"].to_numpy(dtype=object)
        self.user_id = df["user_id"].to_numpy().astype("int32")
        self.take(np.lexsort((self.seq, self.part, self.ts, self.user_id)))

    def users(self) -> Iterator[_Rows]:
        """Each user's rows."""
        at = [0, *(np.flatnonzero(np.diff(self.user_id)) + 1).tolist(), self.n]
        for a, b in zip(at, at[1:]):
            one = _Rows.__new__(_Rows)
            for name in ("user_id", "ts", "part", "seq", "sum", "type"):
                setattr(one, name, getattr(self, name)[a:b])
            one.n = b - a
            if one.n:
                yield one

    def take(self, index: np.ndarray) -> None:
        for name in ("user_id", "ts", "part", "seq", "sum", "type"):
            setattr(self, name, getattr(self, name)[index])
        self.n = len(self.ts)

    def split_late(self, watermark: int | None) -> dict | None:
        """Takes out the rows at or behind the watermark, if any."""
        if watermark is None or watermark <= 0 or self.n == 0 or self.ts[0] > watermark:
            return None
        late = self.ts <= watermark
        out = {
            "user_id": self.user_id[late], "partition": self.part[late], "seq": self.seq[late], "type": self.type[late],
            "sum": self.sum[late], "event_time": self.ts[late],
            "reason": np.full(int(late.sum()), "behind_watermark", dtype=object),
        }
        self.take(~late)
        return out

    def entries(self) -> tuple[np.ndarray, ...]:
        return self.ts, self.part, self.seq, _units(self.sum), _is_type(self.type, C.DEPOSIT)


class _BufferWatch:
    """Logs a hot key when its buffer first passes WARN_ENTRIES, then at each 10x."""

    def __init__(self, name: str):
        self.name = name
        self.next_warn = WARN_ENTRIES

    def check(self, key, n: int) -> None:
        if n >= self.next_warn:
            log.warning("%s: key %s holds %d window entries in state", self.name, key, n)
            while self.next_warn <= n:
                self.next_warn *= 10


def _prefix(v: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(v, dtype="int64")])


class _Frames:
    """Stored entries, whole buckets as one entry each, and new rows in one order; totals before each new row."""

    def __init__(self, entries, whole, is_new: np.ndarray):
        ts, part, seq, units, deposit = entries
        b_ts, b_n, b_last, b_units, b_deposits = whole
        k = len(b_ts)
        at = np.concatenate([b_ts, ts])
        order = np.lexsort((np.concatenate([np.zeros(k, "int64"), seq]), np.concatenate([np.full(k, -1, "int32"), part]), at))
        self.ts = at[order]
        self.last = np.concatenate([b_last, ts])[order]
        self.pos = np.flatnonzero(np.concatenate([np.zeros(k, bool), is_new])[order])
        self.count = _prefix(np.concatenate([b_n, np.ones(len(ts), "int64")])[order])
        self.units = _prefix(np.concatenate([b_units, units])[order])
        self.deposits = _prefix(np.concatenate([b_deposits, np.where(deposit, units, 0)])[order])

    def before(self, name: str, window_ms: int) -> np.ndarray:
        total = getattr(self, name)
        return total[self.pos] - total[np.searchsorted(self.ts, self.ts[self.pos] - window_ms, side="left")]

    def own(self, name: str) -> np.ndarray:
        total = getattr(self, name)
        return total[self.pos + 1] - total[self.pos]


class WindowProcessor(StatefulProcessor):
    """A user's bucketed trailing window, epoch marks and expiry timer; subclasses judge the rows."""

    #: Longest window, other windows asked for, and idle time after which the state goes.
    window_ms: int
    windows: tuple[int, ...] = ()
    idle_ms: int

    def __init__(self, name: str, timers: bool, ttl_ms: int | None):
        self.name = name
        self.timers = timers
        self.ttl_ms = ttl_ms  # ProcessingTime mode: idle expiry by wall clock, like the reference
        self.watch = _BufferWatch(name)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("head", HEAD_STATE, self.ttl_ms)
        self.buckets = handle.getMapState("buckets", "bucket long", ENTRIES, self.ttl_ms)

    @property
    def width(self) -> int:
        return max(1, self.window_ms // BUCKETS)

    def judge(self, key, b: _Rows, timer_values) -> Iterator[dict[str, np.ndarray]]:
        """Judges a user's rows and keeps the state; yields the rows that come out, by column."""
        raise NotImplementedError

    def gone(self, key) -> Iterator[dict[str, np.ndarray]]:
        """Drops an expired user's state; yields the rows that come out."""
        self._clear()  # nothing is emitted
        return iter([])

    def frame(self, parts: list[dict[str, np.ndarray]]) -> pd.DataFrame:
        """Rows of ``judge`` or ``gone`` as the operator emits them."""
        return pd.DataFrame({c: np.concatenate([p[c] for p in parts]) for c in parts[0]})

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        for part in self.judge(key, _Rows(rows), timerValues):
            yield self.frame([part])

    def _watermark(self, timer_values) -> int | None:
        # the watermark exists only in EventTime mode (the mode that sets timers)
        return timer_values.getCurrentWatermarkInMs() if self.timers and timer_values is not None else None

    def _merge(self, rows: _Rows) -> _Frames:
        """Reads what the rows' frames need; keeps it for ``_store``."""
        head = self.state.get() or _NO_HEAD
        self.first, self.last, self.timer_at = head[10:]
        stored = [np.asarray(x, "int64") for x in head[5:10]]
        loaded: dict[int, tuple[np.ndarray, ...]] = {}
        if len(stored[0]):
            asked = [rows.ts // self.width] + [(rows.ts - w) // self.width for w in (self.window_ms, *self.windows)]
            for b in np.intersect1d(np.concatenate(asked), stored[0]).tolist():
                loaded[b] = self._arrays(self.buckets.getValue((b,)))
        out = ~np.isin(stored[0], list(loaded)) if loaded else np.ones(len(stored[0]), bool)
        new = rows.entries()
        parts = [self._arrays(head[:5]), *loaded.values(), new]
        entries = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
        is_new = np.zeros(len(entries[0]), bool)
        is_new[len(is_new) - rows.n :] = True
        self._held, self._is_new, self._stored, self._loaded = entries, is_new, stored, loaded
        return _Frames(entries, [stored[0][out] * self.width, *(x[out] for x in stored[1:])], is_new)

    @staticmethod
    def _arrays(lists) -> tuple[np.ndarray, ...]:
        return tuple(np.asarray(x, dtype=k) for x, k in zip(lists, _KINDS, strict=True))

    def _store(self, key, newest: int, watermark: int | None) -> None:
        """Writes the head, the buckets that gained rows or filled up, and removes those behind the horizon.

        The horizon is ``newest - W``, or ``watermark - W`` when a watermark
        lags behind, so a late row the watermark still admits sees its whole
        window (entries older than that can be in no admitted row's frame).
        """
        horizon = (min(newest, watermark) if watermark is not None and watermark >= 0 else newest) - self.window_ms
        stored = {b: row for b, *row in zip(*(x.tolist() for x in self._stored), strict=True)}
        for b in [b for b, (_, last, *_) in stored.items() if last < horizon]:
            self.buckets.removeKey((b,))
            del stored[b]
        bucket = self._held[0] // self.width
        kept = self._held[0] >= horizon
        if stored:
            known = np.isin(bucket, list(stored))
            for b in np.unique(bucket[known & self._is_new]).tolist():
                stored[b] = self._write(b, bucket == b)
            kept &= ~known
        if kept.sum() > HEAD_ENTRIES:
            newest_bucket = bucket[kept].max()
            for b in np.unique(bucket[kept & (bucket < newest_bucket)]).tolist():
                stored[b] = self._write(b, kept & (bucket == b))
            kept &= bucket == newest_bucket
        order = np.lexsort((self._held[2][kept], self._held[1][kept], self._held[0][kept]))
        ids = sorted(stored)
        summary = [ids, *([stored[b][i] for b in ids] for i in range(4))]
        self.watch.check(key, int(kept.sum()) + sum(summary[1]))
        if self.timers:
            self.timer_at = self._move_timer(self.last + self.idle_ms)
        self.state.update((*(x[kept][order].tolist() for x in self._held), *summary, self.first, self.last, self.timer_at))

    def _write(self, b: int, rows: np.ndarray) -> tuple[int, int, int, int]:
        ts, part, seq, units, deposit = (x[rows] for x in self._held)
        order = np.lexsort((seq, part, ts))
        self.buckets.updateValue((b,), tuple(x[order].tolist() for x in (ts, part, seq, units, deposit)))
        return len(ts), int(ts.max()), int(units.sum()), int(units[deposit].sum())

    def _move_timer(self, new: int) -> int:
        if self.timer_at != new:
            if self.timer_at is not None:
                self.handle.deleteTimer(self.timer_at)
            self.handle.registerTimer(new)
        return new

    def _clear(self) -> None:
        self.buckets.clear()  # before the head, which names them
        self.state.clear()

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        for part in self.gone(key):
            yield self.frame([part])

    def close(self) -> None:
        pass


class AnomalyProcessor(WindowProcessor):
    """Alerts: Credit with sum >= factor * mean of the prior window (all types)."""

    def __init__(
        self,
        window_ms: int = C.ANOMALY_WINDOW_MS,
        factor: float = C.ANOMALY_FACTOR,
        timers: bool = False,
        ttl_ms: int | None = None,
    ):
        super().__init__("anomaly", timers, ttl_ms)
        self.window_ms = window_ms
        self.idle_ms = window_ms + 1
        self.factor = factor

    def judge(self, key, b: _Rows, timer_values) -> Iterator[dict[str, np.ndarray]]:
        frames = self._merge(b)
        newest = int(frames.last[-1])
        self.last = newest
        self._store(key, newest, self._watermark(timer_values))
        yield from _alerts(b, frames, self.window_ms, self.factor)


def _alerts(b: _Rows, frames: _Frames, window_ms: int, factor: float) -> Iterator[dict[str, np.ndarray]]:
    n, total = frames.before("count", window_ms), frames.before("units", window_ms)
    hit = _is_type(b.type, C.CREDIT) & (n > 0) & (total > 0) & (frames.own("units") * n >= factor * total)
    if hit.any():
        yield {
            "user_id": b.user_id[hit],
            "event_time": b.ts[hit],
            "seq": b.seq[hit],
            "type": b.type[hit],
            "sum": b.sum[hit],
            "avg_check_5min": total[hit] / (n[hit] * C.UNITS).astype("float64"),
            "message": np.full(int(hit.sum()), alert_message(factor), dtype=object),
        }


class RfmProcessor(WindowProcessor):
    """One segment event per transaction; state = window entries + epoch marks."""

    def __init__(self, rules: RfmRules = RfmRules(), timers: bool = False, ttl_ms: int | None = None):
        super().__init__("rfm", timers, ttl_ms)
        self.rules = rules
        self.window_ms = rules.window_ms
        self.idle_ms = rules.retention_ms

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        heads = initialState[initialState["is_header"].astype(bool)]
        ents = initialState[~initialState["is_header"].astype(bool)]
        mark = (int(heads["first_ts"].iloc[-1]), int(heads["event_time"].iloc[-1])) if len(heads) else None
        self.seed(key, _Rows(iter([ents])), mark)

    def seed(self, key, entries: _Rows, mark: tuple[int, int] | None) -> None:
        """Takes over a user's entries and (first_ts, last_ts), which may come in several calls."""
        self._merge(entries)
        if mark is not None:
            self.first, self.last = mark
        if self.last is None:  # entries whose header has not come yet
            order = np.lexsort((self._held[2], self._held[1], self._held[0]))
            self.state.update((*(x[order].tolist() for x in self._held), *((),) * 5, None, None, None))
            return
        # a restored user expires like any other after a full retention idle
        self._store(key, self.last, None)

    def judge(self, key, b: _Rows, timer_values) -> Iterator[dict[str, np.ndarray]]:
        self._drop_headless()
        frames = self._merge(b)
        judged = self._judge(b, frames)
        self._store(key, int(frames.last[-1]), self._watermark(timer_values))
        yield {c: judged[c] for c in ("user_id", "seq", "segment", "r_minutes", "f", "m", "updated_at")}

    def _drop_headless(self) -> None:
        """Seeded entries without a header are no epoch to go on with."""
        head = self.state.get()
        if head is not None and head[11] is None:
            self.state.clear()

    def _judge(self, b: _Rows, frames: _Frames) -> dict[str, np.ndarray]:
        """Every row's values; moves the epoch marks on. ``ended``: the epoch that the row closes, by its last time."""
        r, new_ts, pos = self.rules, b.ts, frames.pos
        first0, last0 = self.first, self.last
        f = frames.before("count", r.window_ms) + 1
        deposits = frames.before("deposits", r.window_ms) + frames.own("deposits")

        # previous transaction: the one before in merged order, else the stored last
        # unless that one is later (a late row); a late row inside the stored
        # epoch belongs to it
        stored = last0 is not None
        prev = frames.last[np.maximum(pos - 1, 0)]
        if stored:
            prev = np.where(pos == 0, np.minimum(last0, new_ts), prev)
        has_prev = (pos > 0) | (np.full(b.n, stored) & (new_ts >= (last0 if stored else 0)))
        gap = np.where(has_prev, new_ts - prev, 0)
        inside = np.full(b.n, stored and first0 is not None) & (new_ts >= (first0 or 0)) & (pos == 0)
        starts = np.where(has_prev, gap >= r.retention_ms, ~inside)
        # first_ts: the latest epoch start at or before each row, else the stored one
        idx = np.maximum.accumulate(np.where(starts, np.arange(b.n), -1))
        first = np.where(idx >= 0, new_ts[np.maximum(idx, 0)], first0 if first0 is not None else 0)

        r_minutes = np.where(starts, 0.0, gap / 60000.0) if r.recency == "gap" else np.zeros(b.n)
        segment = np.select(
            [
                new_ts - first < r.newcomer_ms,
                (deposits > r.vip_min_m * C.UNITS) & (f > r.vip_min_f),
                (deposits > r.active_min_m * C.UNITS) & (f > r.active_min_f),
                r_minutes > r.sleeping_min_r_minutes,
            ],
            [C.SEGMENT_NEWCOMER, C.SEGMENT_VIP, C.SEGMENT_ACTIVE, C.SEGMENT_SLEEPING],
            default=C.SEGMENT_STANDARD,
        )
        newest = int(frames.last[-1])
        self.first, self.last = int(first[-1]), newest if last0 is None else max(newest, last0)
        return {
            "user_id": b.user_id,
            "seq": b.seq,
            "segment": segment,
            "r_minutes": r_minutes.astype("float64"),
            "f": f.astype("int64"),
            "m": deposits / float(C.UNITS),
            "updated_at": new_ts,
            "first_ts": first.astype("int64"),
            "ended": np.where(starts & has_prev, prev, -(2**63)),
        }


class LiveProcessor(RfmProcessor):
    """Alerts, segments, late rows and expiries of a user from one window (LIVE schema).

    ``segment``: one row per transaction with its own values; ``alert``: one
    more for each that is an anomaly; ``late``: a transaction at or behind the
    watermark, which no state can judge any more; ``expired``: the end of an
    activity epoch, when a timer fires or a transaction opens the next one.
    Each record so leaves exactly one ``segment`` or ``late`` row.
    """

    def __init__(
        self,
        rules: RfmRules = RfmRules(),
        anomaly_window_ms: int = C.ANOMALY_WINDOW_MS,
        factor: float = C.ANOMALY_FACTOR,
        timers: bool = True,
    ):
        if anomaly_window_ms > rules.window_ms:
            raise ValueError("the anomaly window must lie within the segment window")
        super().__init__(rules, timers)
        self.name = "live"
        self.windows = (anomaly_window_ms,)
        self.factor = factor

    def judge(self, key, b: _Rows, timer_values) -> Iterator[dict[str, np.ndarray]]:
        self._drop_headless()
        watermark = self._watermark(timer_values)
        late = b.split_late(watermark)
        if late is not None:
            yield {"kind": "late", **late}
        if not b.n:
            return
        frames = self._merge(b)
        judged = self._judge(b, frames)
        self._store(key, int(frames.last[-1]), watermark)
        ended = judged.pop("ended")
        event_time = judged.pop("updated_at")
        yield {"kind": "segment", **judged, "event_time": event_time, "partition": b.part, "type": b.type, "sum": b.sum}
        for alerts in _alerts(b, frames, self.windows[0], self.factor):
            yield {"kind": "alert", **alerts}
        ended = ended[ended != -(2**63)]
        if len(ended):
            yield {"kind": "expired", "user_id": b.user_id[: len(ended)], "event_time": ended}

    def gone(self, key) -> Iterator[dict[str, np.ndarray]]:
        head = self.state.get()
        self._clear()
        if head is not None and head[11] is not None:
            yield {"kind": "expired", "user_id": np.array([key[0]], "int32"), "event_time": np.array([head[11]], "int64")}

    def frame(self, parts: list[dict[str, np.ndarray]]) -> pd.DataFrame:
        """Rows with all columns of LIVE, missing ones null."""
        counts = [len(p["user_id"]) for p in parts]
        out = {"kind": np.repeat(np.array([p["kind"] for p in parts], dtype=object), counts)}
        for c in list(LIVE)[1:]:
            values = np.full(sum(counts), None, dtype=object)
            at = 0
            for p, n in zip(parts, counts, strict=True):
                if c in p:
                    values[at : at + n] = p[c]
                at += n
            out[c] = values
        return pd.DataFrame(out, dtype=object)


LIVE = {
    "kind": "string", "user_id": "int", "partition": "int", "seq": "long", "type": "string", "sum": "double",
    "event_time": "long", "avg_check_5min": "double", "message": "string", "segment": "string", "r_minutes": "double",
    "f": "long", "m": "double", "first_ts": "long", "reason": "string",
}

#: The heads of a shard's users: one value a user (n, b: entries and buckets of it), then the entries and bucket
#: summaries of all users in that order. ``owner``: whose entry it is; ``seen``: wall clock of the last write.
SHARD_STATE = (
    f"user_id array<int>, first_ts array<long>, last_ts array<long>, expires_at array<long>, seen array<long>, n array<int>, "
    f"b array<int>, owner array<int>, {ENTRIES}, b_id array<long>, b_n array<long>, b_last array<long>, b_units array<long>, "
    "b_deposits array<long>, timer_at long"
)


class _Head:
    """A user's head within its shard, as the user's processor sees it."""

    def __init__(self, heads: dict[int, tuple], user: int):
        self.heads, self.user = heads, user

    def get(self) -> tuple | None:
        return self.heads.get(self.user)

    def update(self, value: tuple) -> None:
        self.heads[self.user] = value

    def clear(self) -> None:
        self.heads.pop(self.user, None)


class _Buckets:
    """A user's rows of the shard's bucket map."""

    def __init__(self, rows, user: int, heads: dict[int, tuple]):
        self.rows, self.user, self.heads = rows, user, heads

    def getValue(self, key):
        return self.rows.getValue((self.user, *key))

    def updateValue(self, key, value) -> None:
        self.rows.updateValue((self.user, *key), value)

    def removeKey(self, key) -> None:
        self.rows.removeKey((self.user, *key))

    def clear(self) -> None:
        for b in self.heads[self.user][5] if self.user in self.heads else ():  # those that the head names
            self.removeKey((b,))


class _NoTimers:
    """The shard has the timer; a head only says when it would be."""

    def deleteTimer(self, at: int) -> None:
        pass

    def registerTimer(self, at: int) -> None:
        pass


class ShardProcessor(StatefulProcessor):
    """A ``WindowProcessor`` for each user of a shard, with one state read, one write and one frame out a micro-batch.

    The rows' users are judged one after the other by the same code as if each
    were a key of its own. Buckets stay one map row each, so a user too large
    for a head moves no more state than before.
    """

    def __init__(self, user: WindowProcessor):
        self.user = user

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.heads = handle.getValueState("heads", SHARD_STATE, self.user.ttl_ms)
        self.buckets = handle.getMapState("buckets", "user_id int, bucket long", ENTRIES, self.user.ttl_ms)
        self.user.handle = _NoTimers()

    def _load(self, now: int | None) -> None:
        """Reads the shard's heads; of users whose time to live has passed at ``now`` (wall clock) nothing is kept."""
        self.held: dict[int, tuple] = {}
        self.seen: dict[int, int] = {}
        self.timer_at = None
        state = self.heads.get()
        if state is None:
            return
        users, first, last, expires, seen, n, b = state[:7]
        entries, summary, self.timer_at = state[8:13], state[13:18], state[18]
        i = j = 0
        for k, user in enumerate(users):
            i0, j0 = i, j
            i, j = i + n[k], j + b[k]
            head = (*(x[i0:i] for x in entries), *(x[j0:j] for x in summary), first[k], last[k], expires[k])
            if now is not None and seen[k] + self.user.ttl_ms <= now:
                continue  # its buckets have the same time to live
            self.held[user], self.seen[user] = head, seen[k]

    def _save(self, fired: int | None = None) -> None:
        """Writes the heads; moves the timer to the first user's expiry. ``fired``: a timer that the caller removes."""
        due = min((h[12] for h in self.held.values() if h[12] is not None), default=None) if self.user.timers else None
        if due != self.timer_at:
            if self.timer_at is not None and self.timer_at != fired:
                self.handle.deleteTimer(self.timer_at)
            if due is not None:
                self.handle.registerTimer(due)
        if not self.held:
            self.heads.clear()
            return
        users, heads = list(self.held), list(self.held.values())
        counts = [len(h[0]) for h in heads]
        owner = np.repeat(np.array(users, "int32"), counts).tolist()
        flat = [[v for h in heads for v in h[c]] for c in range(10)]
        marks = [[h[c] for h in heads] for c in (10, 11, 12)]
        seen = [self.seen.get(u, 0) for u in users]
        self.heads.update((users, *marks, seen, counts, [len(h[5]) for h in heads], owner, *flat, due))

    def _as(self, user: int) -> WindowProcessor:
        self.user.state = _Head(self.held, user)
        self.user.buckets = _Buckets(self.buckets, user, self.held)
        return self.user

    def _now(self, timer_values) -> int | None:
        return timer_values.getCurrentProcessingTimeInMs() if self.user.ttl_ms is not None else None

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        """A shard's users, whose rows may be spread over several calls."""
        now = self._now(timerValues)
        self._load(now)
        header = initialState["is_header"].to_numpy(dtype=bool)
        marks = initialState[header]
        marks = {
            u: (int(a), int(b))
            for u, a, b in zip(marks["user_id"].to_numpy().tolist(), marks["first_ts"].tolist(), marks["event_time"].tolist(), strict=True)
        }
        nothing = _Rows(iter([initialState[:0]]))
        entries = {int(b.user_id[0]): b for b in _Rows(iter([initialState[~header]])).users()}
        for user in (marks | entries).keys():
            self._as(user).seed((user,), entries.get(user, nothing), marks.get(user))
            self.seen[user] = now or 0
        self._save()

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        now = self._now(timerValues)
        self._load(now)
        parts = []
        for b in _Rows(rows).users():
            user = int(b.user_id[0])
            parts += self._as(user).judge((user,), b, timerValues)
            self.seen[user] = now or 0
        self._save()
        if parts:
            yield self.user.frame(parts)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._load(self._now(timerValues))
        fired, watermark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        parts = []
        for user, head in list(self.held.items()):
            if head[12] is not None and (head[12] < watermark or head[12] <= fired):
                parts += self._as(user).gone((user,))
        self._save(fired)
        if parts:
            yield self.user.frame(parts)

    def close(self) -> None:
        self.user.close()
