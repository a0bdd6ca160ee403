"""The streaming processors against the brute-force model, without Spark.

Random rows are cut into time-ordered micro-batches (each user's rows arrive
in order across batches; any order inside one) and fed through the
processors with an in-memory state, as transformWithState would.
"""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from test_property import R, W1, W2, model, rows_strategy
from txpulse.operators.rfm import RfmRules
from txpulse.streaming.processors import AnomalyProcessor, RfmProcessor


class MemoryState:
    def __init__(self):
        self.v = None

    def get(self):
        return self.v

    def update(self, v):
        self.v = tuple(v)

    def exists(self):
        return self.v is not None

    def clear(self):
        self.v = None


def _feed(make, rows, cuts, seed):
    """Run one processor per user over the batches; collect all output rows."""
    procs, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1], i))
    bounds = sorted(set(min(c, len(order)) for c in cuts)) + [len(order)]
    rng = np.random.default_rng(seed)
    start = 0
    for end in bounds:
        batch = [order[j] for j in range(start, end)]
        start = end
        by_user = {}
        for i in batch:
            by_user.setdefault(rows[i][0], []).append(i)
        for u, idx in by_user.items():
            idx = list(rng.permutation(idx))  # any order inside a micro-batch
            p = procs.get(u)
            if p is None:
                p = procs[u] = make()
                p.state = MemoryState()
                p.handle = None
            df = pd.DataFrame(
                {
                    "user_id": np.array([u] * len(idx), dtype="int32"),
                    "type": [rows[i][2] for i in idx],
                    "sum": [rows[i][3] / 100.0 for i in idx],
                    "event_time": np.array([rows[i][1] for i in idx], dtype="int64"),
                    "seq": np.array(idx, dtype="int64"),
                }
            )
            for frame in p.handleInputRows((u,), iter([df]), None):
                out.append(frame)
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame()


@settings(max_examples=200, deadline=None)
@given(rows=rows_strategy, cuts=st.lists(st.integers(0, 40), max_size=5), seed=st.integers(0, 9))
def test_processors_match_model(rows, cuts, seed):
    expect = model([(u, t, i, ty, c) for i, (u, t, ty, c) in enumerate(rows)])

    # thresholds scaled to the test's millisecond range, so every label occurs
    rules = RfmRules(
        window_ms=W2, retention_ms=R, recency="gap", newcomer_ms=30, vip_min_m=20, vip_min_f=3,
        active_min_m=5, active_min_f=1, sleeping_min_r_minutes=0.0005,
    )
    seg = _feed(lambda: RfmProcessor(rules), rows, cuts, seed)
    assert sorted(seg["seq"]) == sorted(expect)
    for r in seg.itertuples(index=False):
        _, _, f, m, first, prev, _ = expect[r.seq]
        t = rows[r.seq][1]
        assert (r.f, round(r.m * 100)) == (f, m), r
        gap = 0.0 if prev is None or t - prev >= R else (t - prev) / 60000.0
        assert r.r_minutes == gap, r
        if t - first < rules.newcomer_ms:
            label = "Новичок"
        elif m > rules.vip_min_m * 100 and f > rules.vip_min_f:
            label = "VIP"
        elif m > rules.active_min_m * 100 and f > rules.active_min_f:
            label = "Активный"
        elif gap > rules.sleeping_min_r_minutes:
            label = "Спящий"
        else:
            label = "Стандартный"
        assert r.segment == label, (r, label)

    alerts = _feed(lambda: AnomalyProcessor(window_ms=W1, factor=3), rows, cuts, seed)
    want = set()
    for i, (u, t, ty, c) in enumerate(rows):
        n, total = expect[i][0], expect[i][1]
        if ty is not None and ty.lower() == "credit" and n > 0 and total > 0 and c * n >= 3 * total:
            want.add(i)
    got = set(alerts["seq"]) if len(alerts) else set()
    assert got == want


class _Timers:
    def __init__(self, wm):
        self.wm = wm

    def getCurrentWatermarkInMs(self):
        return self.wm


class _Handle:
    def __init__(self):
        self.timers = set()

    def listTimers(self):
        return iter(sorted(self.timers))

    def deleteTimer(self, t):
        self.timers.discard(t)

    def registerTimer(self, t):
        self.timers.add(t)


def test_late_row_within_the_watermark_sees_its_whole_window():
    p = AnomalyProcessor(window_ms=150, factor=3, timers=True)  # EventTime mode
    p.state, p.handle = MemoryState(), _Handle()

    def rows(*items):
        return iter([pd.DataFrame({
            "user_id": np.array([1] * len(items), dtype="int32"),
            "type": [t for t, _, _, _ in items],
            "sum": [s for _, s, _, _ in items],
            "event_time": np.array([e for _, _, e, _ in items], dtype="int64"),
            "seq": np.array([q for _, _, _, q in items], dtype="int64"),
        })])

    list(p.handleInputRows((1,), rows(("Deposit", 10.0, 1000, 1), ("Deposit", 10.0, 1200, 3)), _Timers(0)))
    # a Credit at 1100 arrives late; the watermark (1060) still admits it, and
    # its window [950, 1100) holds the entry at 1000, although 1000 < newest - W
    out = list(p.handleInputRows((1,), rows(("Credit", 30.0, 1100, 2)), _Timers(1060)))
    assert len(out) == 1 and out[0]["avg_check_5min"].tolist() == [10.0]

    assert p.handle.timers == {1200 + 150 + 1}  # one expiry timer, moved forward


def test_without_a_watermark_the_buffer_stays_bounded():
    p = AnomalyProcessor(window_ms=150, factor=3)  # None mode
    p.state, p.handle = MemoryState(), None
    for k in range(20):
        df = pd.DataFrame({"user_id": np.array([1], "int32"), "type": ["Deposit"], "sum": [1.0],
                           "event_time": np.array([k * 100], "int64"), "seq": np.array([k], "int64")})
        list(p.handleInputRows((1,), iter([df]), _Timers(0)))
    assert len(p.state.get()[0]) == 2  # entries within 150 ms of the newest only


def test_hot_key_buffer_is_reported_once_per_tenfold(caplog, monkeypatch):
    import txpulse.streaming.processors as P

    monkeypatch.setattr(P, "WARN_ENTRIES", 5)
    p = AnomalyProcessor(window_ms=10_000, factor=3)
    p.state, p.handle = MemoryState(), None
    with caplog.at_level("WARNING", logger="txpulse.state"):
        for k in range(60):
            df = pd.DataFrame({"user_id": np.array([1], "int32"), "type": ["Deposit"], "sum": [1.0],
                               "event_time": np.array([k], "int64"), "seq": np.array([k], "int64")})
            list(p.handleInputRows((1,), iter([df]), None))
    warnings = [r for r in caplog.records if "window entries" in r.getMessage()]
    assert len(warnings) == 2  # at 5 and at 50 entries
