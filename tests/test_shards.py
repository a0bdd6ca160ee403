"""A shard of users is one call of the operator: one state read, one write, one frame and one timer."""

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo

import txpulse.streaming.processors as P
from test_bucketed_state import MemoryMap, _table
from test_processor_model import MemoryState, _Handle, _Timers
from txpulse.operators.rfm import RfmRules

DAY = 86_400_000


class _Store(_Handle):
    def __init__(self):
        super().__init__()
        self.reads = self.writes = 0
        store = self

        class Counted(MemoryState):
            def get(self):
                store.reads += 1
                return super().get()

            def update(self, v):
                store.writes += 1
                super().update(v)

        self.value, self.map = Counted(), MemoryMap()

    def getValueState(self, name, schema, ttl_ms=None):
        return self.value

    def getMapState(self, name, key, schema, ttl_ms=None):
        return self.map


def _shard(make):
    p, store = P.ShardProcessor(make()), _Store()
    p.init(store)
    return p, store


def _rows(users, per_user, start, seq0, seed):
    rng = np.random.default_rng(seed)
    n = users * per_user
    return pd.DataFrame({
        "user_id": np.repeat(np.arange(users, dtype="int32"), per_user), "type": rng.choice(["Credit", "Deposit"], n),
        "sum": rng.integers(1, 50_000, n) / 100, "event_time": start + rng.integers(0, 3 * DAY, n),
        "partition": np.zeros(n, "int32"), "seq": np.arange(seq0, seq0 + n),
    }).sample(frac=1, random_state=seed)


def _batches():
    return [_rows(40, 60, DAY * (1 + 3 * k), 10_000 * k, k) for k in range(4)]


def test_a_shard_gives_what_its_users_give(monkeypatch):
    monkeypatch.setattr(P, "HEAD_ENTRIES", 10)  # most users have buckets
    for make in (lambda: P.LiveProcessor(RfmRules(), DAY), lambda: P.RfmProcessor(RfmRules()), lambda: P.AnomalyProcessor(DAY, 1.5)):
        one, store = _shard(make)
        alone, want, got = {}, [], []
        for k, batch in enumerate(_batches()):
            mark = _Timers(DAY * 3 * k)  # some rows are late
            got += list(one.handleInputRows((0,), iter([batch[:700], batch[700:]]), mark))
            for u, rows in batch.groupby("user_id"):
                if u not in alone:
                    alone[u] = make()
                    alone[u].state, alone[u].buckets, alone[u].handle = MemoryState(), MemoryMap(), _Handle()
                want += list(alone[u].handleInputRows((u,), iter([rows]), mark))
        assert store.map.rows
        assert {u: len(p.buckets.rows) for u, p in alone.items() if p.buckets.rows} == pd.Series([u for u, _ in store.map.rows]).value_counts().to_dict()
        assert _table(pd.concat(got).astype(object)) == _table(pd.concat(want).astype(object))
        assert len(got) <= 4 and (store.reads, store.writes) == (4, 4)


def test_a_shard_has_one_timer_and_drops_only_the_expired():
    p, store = _shard(lambda: P.LiveProcessor(RfmRules(retention_ms=DAY)))
    for u, t in ((1, 10), (2, 20), (3, 20), (4, 500)):
        rows = pd.DataFrame({"user_id": np.array([u], "int32"), "type": "Deposit", "sum": 1.0, "event_time": [t], "seq": [u]})
        list(p.handleInputRows((0,), iter([rows]), _Timers(0)))
    assert store.timers == {DAY + 10}
    out = pd.concat(p.handleExpiredTimer((0,), _Timers(DAY + 21), ExpiredTimerInfo(DAY + 10)))
    store.deleteTimer(DAY + 10)  # Spark does
    assert sorted(zip(out.user_id, out.event_time)) == [(1, 10), (2, 20), (3, 20)] and set(out.kind) == {"expired"}
    assert store.timers == {DAY + 500} and store.value.get()[0] == [4]
    list(p.handleExpiredTimer((0,), _Timers(DAY + 501), ExpiredTimerInfo(DAY + 500)))
    assert store.value.get() is None


def test_a_seed_in_pieces_is_the_seed():
    seed = pd.DataFrame({
        "user_id": np.array([1, 1, 1, 2, 2, 3], "int32"), "is_header": [False, False, True, True, False, False],
        "event_time": [100, 200, 200, 300, 300, 50], "seq": [1, 2, 2, 3, 3, 9], "sum": [1.0, 2.0, np.nan, np.nan, 4.0, 8.0],
        "type": ["Deposit", "Deposit", None, None, "Credit", "Deposit"], "first_ts": [np.nan, np.nan, 7.0, 8.0, np.nan, np.nan],
        "partition": np.zeros(6, "int32"),
    })
    new = pd.DataFrame({"user_id": np.array([1, 2, 3], "int32"), "type": "Deposit", "sum": 1.0, "event_time": [400, 400, 400], "seq": [11, 12, 13]})
    results = []
    for cuts in ([0, 6], [0, 1, 4, 6], [0, 1, 2, 3, 4, 5, 6]):
        p, _ = _shard(lambda: P.RfmProcessor(RfmRules()))
        for a, b in zip(cuts, cuts[1:]):
            p.handleInitialState((0,), seed[a:b], _Timers(0))
        results.append(pd.concat(p.handleInputRows((0,), iter([new]), None)).f.tolist())
    assert results == [[3, 2, 1]] * 3  # user 3 has no header: its entry is no epoch to go on with


def test_a_restart_loses_no_row_when_event_ids_are_not_in_time_order(spark, tmp_path):
    from txpulse.streaming.replay import restart_rows

    rng = np.random.default_rng(5)
    n = 400
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(rng.integers(0, 30 * DAY, n)), unit="ms")
    ids = rng.permutation(n) + 7
    events = pd.DataFrame({
        "event_id": ids, "ts": ts, "user_id": rng.integers(0, 20, n), "event_type": rng.choice(["click", "purchase"], n),
        "value": rng.integers(1, 50_000, n) / 100, "props": "{}",
    })
    rows = spark.createDataFrame(events)
    rows.selectExpr("event_id", "cast(ts as timestamp_ntz) ts", "user_id", "event_type", "value", "props").write.parquet(str(tmp_path / "events.parquet"))
    got = restart_rows(spark, str(tmp_path)).select("seq", "updated_at").collect()
    want = sorted(zip(ids.tolist(), (ts.astype("datetime64[ms]").astype("int64")).tolist()))
    assert sorted((r.seq, r.updated_at) for r in got) == want
