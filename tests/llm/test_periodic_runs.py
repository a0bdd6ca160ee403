"""Periodic runs against a plain scan of every lag, and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fixtures_llm import LONG, ROWS, frame
from txpulse.llm import periodic_runs as P
from txpulse.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_runs(words):
    """Every maximal stretch, its smallest period found by trying each."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q) and not any(all(words[x] == words[x + p] for x in range(i, i + size - p)) for p in range(1, q)):
                found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def wanted(doc_id, text):
    words = planted(doc_id, text)
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(collapsed(words, runs)),
    )


def repetitive(rng, n, k):
    out = []
    while len(out) < n:
        block = [rng.randrange(k) for _ in range(rng.randrange(1, 9))]
        out += block * rng.randrange(1, 9) + block[: rng.randrange(len(block) + 1)]
    return out[:n]


@pytest.mark.parametrize("k", [1, 2, 3, 6])
def test_scan_equals_every_lag(k):
    rng = random.Random(k)
    for _ in range(150):
        codes = repetitive(rng, rng.randrange(0, 90), k)
        assert P.lag_scan(np.array(codes, np.int64)) == plain_runs(codes)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=70), max_size=5))
def test_segments_lose_no_run(texts):
    flat = np.array([x for t in texts for x in t], np.int64)
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    got = set()
    for a, b in P.surviving_segments(flat, first):
        got |= {(a + s, size, q) for s, size, q in P.lag_scan(flat[a:b])}
    assert got == {(int(f) + s, size, q) for f, t in zip(first, texts) for s, size, q in plain_runs(t)}


def test_rare_words_split_again_and_again():
    # x is common over all but rare once y has split the text
    words = ["x", "a", "y"] * 3 + ["a", "b"] * 4 + ["x"]
    codes = np.unique(words, return_inverse=True)[1]
    assert [(a, b) for a, b in P.surviving_segments(codes, np.array([0, len(words)]))] == [(9, 17)]


def test_long_texts_take_little_time():
    rng = random.Random(5)
    for codes in ([0] * 40_000, [0, 1, 1] * 13_000, repetitive(rng, 40_000, 2)):
        runs = P.lag_scan(np.array(codes, np.int64))
        assert runs and all(codes[i] == codes[i + q] for s, size, q in runs for i in range(s, s + size - q))
    assert P.lag_scan(np.array([0, 1, 1] * 13_000)) == [(0, 39_000, 3)]


def test_odd_rows(spark, odd, none):
    got = {}
    for r in P.periodic_runs(odd).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    want = {}
    for i, text, *_ in ROWS:
        words = WORD.findall(text or "")
        runs = [] if text == LONG else plain_runs(words)
        want.setdefault(i, []).append((len(words), runs, collapsed(words, runs)))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}
    assert P.periodic_runs(none).count() == 0
    assert P.run_digests(P.periodic_runs(none)).count() == 0


def test_words_are_exact(spark):
    rows = [(1, "a " * 6, "", ""), (2, "A a " * 3, "", ""), (3, "é é " * 7, "", ""), (4, "x\x1cy x\x0by " * 6, "", ""), (5, "\t a\r\nb " * 4, "", "")]
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in P.periodic_runs(frame(spark, rows)).collect()}
    assert got == {
        1: ([(0, 6, 1)], "a"), 2: ([], "A a A a A a"), 3: ([(0, 7, 1)], "é é"),
        4: ([(0, 18, 3)], "x\x1cy x y"), 5: ([(0, 8, 2)], "a b"),
    }


def test_query_equals_plain_scan(spark, texts):
    got = QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r) for r in got if len((texts[r.doc_id] or "").split()) < 1500) == sorted(
        wanted(i, t) for i, t in texts.items() if len((t or "").split()) < 1500
    )
    assert len(got) == len(texts)
