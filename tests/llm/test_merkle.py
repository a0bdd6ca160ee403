"""Merkle manifest: the log's positions, proofs, tampering and odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from fixtures_llm import ROWS, frame
from txpulse.llm import merkle as M


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_levels(nodes, levels=None):
    out = [nodes]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        row = out[-1]
        out.append([H("".join(row[i : i + 3])) for i in range(0, len(row), 3)])
    return out


@pytest.mark.parametrize("m", [1, 2, 3, 4, 5, 8, 9, 10, 17, 26, 27, 28, 53, 54, 55, 80, 81])
def test_positions_follow_from_sizes(m):
    for levels in {M.height(m), 5}:
        rows = plain_levels([H(str(i)) for i in range(m)], levels)
        log = M.append_log(rows[0], levels)
        assert sorted(log) == sorted(d for r in rows for d in r)
        for k, row in enumerate(rows):
            for i, d in enumerate(row):
                assert log[M.position(k, i, m, levels)] == d
        for j, d in enumerate(log):  # a node stands after its children
            k, i = next((k, i) for k, r in enumerate(rows) for i, x in enumerate(r) if x == d and M.position(k, i, m, levels) == j)
            if k:
                assert all(log.index(c) < j for c in rows[k - 1][3 * i : 3 * i + 3])
        for i, steps in enumerate(M.paths(log, m, levels)):
            d = rows[0][i]
            for left, right in steps:
                d = H(left + d + right)
            assert d == rows[-1][0] == log[-1]


def plain_manifest(rows):
    """{leaf: (subroot, root, siblings)} of (id, source, leaf)."""
    by = {}
    for i, s, leaf in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        by.setdefault(s, []).append(leaf)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_levels(by[s]) for s in order}
    top = plain_levels([trees[s][-1][0] for s in order])

    def siblings(levels, i):
        out = ""
        for row in levels[:-1]:
            out += "".join(d for j, d in enumerate(row) if j // 3 == i // 3 and j != i)
            i //= 3
        return out

    out = []
    for n, s in enumerate(order):
        for i, leaf in enumerate(by[s]):
            out.append((leaf, trees[s][-1][0], top[-1][0], H(siblings(trees[s], i) + siblings(top, n))))
    return out


def proofs(m):
    got = m.proofs.select("*", M.proof_digest(F.col("path")).alias("proof"), M.fold(F.col("leaf"), F.col("path")).alias("folded")).collect()
    assert all(r.folded == r.root for r in got)
    return got


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 1)
    monkeypatch.setattr(M, "BLOCK", 3)


def test_leaf_of_a_row(spark):
    df = spark.createDataFrame([(7, "é\n", None), (None, "", "x")], "a long, b string, c string")
    got = [r[0] for r in df.select(M.leaf_digest([F.col(c) for c in "abc"])).collect()]
    assert got == [H("1:73:é\n-"), H("-0:1:x")]


def test_odd_rows(odd, none):
    m = M.manifest(odd, ["doc_id", "source", "lang", "text"])
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    want = plain_manifest([(i, s, H(part(i) + part(s) + part(lang) + part(t))) for i, t, lang, s in ROWS])
    assert sorted((r.leaf, r.subroot, r.root, r.proof) for r in proofs(m)) == sorted(want)
    empty = M.manifest(none, ["doc_id", "source", "text"])
    assert empty.proofs.count() == 0 and sum(x.count() for x in empty.logs + empty.top_logs) == 0


@pytest.mark.parametrize("n", [1, 3, 4, 9, 10, 27, 28, 40, 82])
def test_rounds_of_small_builders(small_blocks, n):
    level = digests = [H(str(i)) for i in range(n)]
    while True:  # blocks of three: up to five rounds
        logs = [M.append_log(level[i : i + 3], M._levels(len(level))) for i in range(0, len(level), 3)]
        level = [log[-1] for log in logs]
        if len(level) == 1:
            break
    assert level == plain_levels(digests)[-1]


def test_more_than_one_block(spark):
    """Two rounds at the real block size: one source over BLOCK rows, others below, equal ids and rows."""
    n = M.BLOCK * 2 + 5
    docs = spark.range(n).select(
        F.when(F.col("id") % 50 == 0, F.lit(50)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 40 == 0, F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).when(F.col("id") % 41 != 0, F.lit("hot")).alias("source"),
        F.when(F.col("id") % 50 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"),
    )
    m = M.manifest(docs.repartition(5), ["doc_id", "source", "text"], carry={"t": F.upper("text")})
    rows = [(r.doc_id, r.source, r.leaf) for r in docs.withColumn("leaf", M.leaf_digest([F.col(c) for c in docs.columns])).collect()]
    got = proofs(m)
    assert len(m.logs) == 2 and all(r.t == "SAME" or r.t == str(r.doc_id) for r in got)
    assert sorted((r.leaf, r.subroot, r.root, r.proof) for r in got) == sorted(plain_manifest(rows))


def test_change_shows(spark):
    docs = frame(spark, [(i, f"text {i}", "en", "a") for i in range(10)])
    m = M.manifest(docs, ["doc_id", "text"], carry={"t": M.leaf_digest([F.col("doc_id"), F.translate("text", "4", "5")])})
    got = m.proofs.withColumn("ok", M.fold(F.col("t"), F.col("path")) == F.col("root")).collect()
    assert {r.doc_id for r in got if not r.ok} == {4}
