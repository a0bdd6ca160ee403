"""Periodic runs of words, by recursive frequency splitting and a lag scan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txpulse.llm.common import slices
from txpulse.llm.tokens import SPACED, text_bytes

#: A run holds its period this many times at least, and has this many words.
LEAST_TIMES = 4
LEAST_WORDS = 6

_ODD = np.uint64(0x9E3779B97F4A7C15)

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def surviving_segments(codes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of words that can hold runs; ``first`` are the bounds of the texts.

    Within a run each word occurs LEAST_TIMES times or more, so a word that is
    rarer in its segment is in no run of it: it splits the segment. The parts
    are counted anew until no part loses a word. All texts go level by level
    together.
    """
    bounds = np.stack([first[:-1], first[1:]], axis=1)
    bounds = bounds[bounds[:, 1] - bounds[:, 0] >= LEAST_WORDS]
    while len(bounds):
        size = bounds[:, 1] - bounds[:, 0]
        segment = np.repeat(np.arange(len(bounds)), size)
        at = np.arange(int(size.sum())) + np.repeat(bounds[:, 0] - (np.cumsum(size) - size), size)
        key = segment * (int(codes.max()) + 1) + codes[at]
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        often = times[which] >= LEAST_TIMES
        whole = np.logical_and.reduceat(often, np.cumsum(size) - size)
        for a, b in bounds[whole].tolist():
            yield a, b
        often &= ~whole[segment]
        apart = segment[1:] != segment[:-1]
        begin, end = often.copy(), often.copy()
        begin[1:] &= ~often[:-1] | apart
        end[:-1] &= ~often[1:] | apart
        begins, ends = np.flatnonzero(begin), np.flatnonzero(end)
        keep = ends - begins + 1 >= LEAST_WORDS
        bounds = np.stack([at[begins[keep]], at[ends[keep]] + 1], axis=1)


def _inside(found: dict[int, np.ndarray], q: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether [a, b) lies in a run already found whose period divides q."""
    out = np.zeros(len(a), bool)
    for p, spans in found.items():
        if q % p == 0:  # runs of one period ascend, and overlap by less than it
            nth = np.searchsorted(spans[:, 0], a, side="right") - 1
            out |= (nth >= 0) & (b <= spans[nth, 1])
    return out


def lag_scan(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a segment, by start, then period.

    Words of a run with period q agree q apart over 3q places or more, so they
    hold two whole blocks of q words, beginning at multiples of q, that agree
    with what follows q later. Each lag looks at those blocks only, by prefix
    hashes, and then word by word where they agree: n/q looks for lag q. A
    block within a run whose period divides q has no smallest period q.
    """
    n = len(codes)
    if n < LEAST_WORDS:
        return []
    powers = np.cumprod(np.full(n + 1, _ODD, dtype=np.uint64))
    ahead = np.zeros(n + 1, np.uint64)
    # sum of (code + 1) * ODD**(i + 1): a block's sum shifted by q is the next block's sum
    ahead[1:] = np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[:n], dtype=np.uint64)
    found: dict[int, np.ndarray] = {}
    for q in range(1, n // LEAST_TIMES + 1):
        p = np.arange(0, n - 3 * q + 1, q)
        low, high = ahead[p], ahead[p + 2 * q]
        agree = (high - low) * powers[q - 1] == ahead[p + 3 * q] - ahead[p + q]
        p = p[agree]
        if len(p):
            p = p[~_inside(found, q, p, p + 3 * q)]
        if not len(p):
            continue
        # neighbouring blocks form one stretch, which ends within q words of them
        cut = np.flatnonzero(np.diff(p) > q)
        own = []
        for a, b in zip(p[np.concatenate(([0], cut + 1))].tolist(), p[np.concatenate((cut, [len(p) - 1]))].tolist(), strict=True):
            a, b = max(0, a - q), min(n - q, b + 3 * q)
            same = np.zeros(b - a + 2, np.int8)
            same[1:-1] = codes[a:b] == codes[a + q : b + q]
            turn = np.diff(same)
            for s, e in zip((np.flatnonzero(turn == 1) + a).tolist(), (np.flatnonzero(turn == -1) + a).tolist(), strict=True):
                if e - s + q >= max(LEAST_WORDS, LEAST_TIMES * q) and (not own or own[-1][0] < s):
                    own.append((s, e + q))
        if own:
            spans = np.array(own)
            spans = spans[~_inside(found, q, spans[:, 0], spans[:, 1])]
            if len(spans):
                found[q] = spans
    return sorted((s, e - s, q) for q, spans in found.items() for s, e in spans.tolist())


def _word_codes(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Bytes of all words in a row, each word's offset, its number among the distinct ones, and each text's first word."""
    buf, at = text_bytes(texts)
    inside = SPACED[buf]
    new = np.zeros(len(buf) + 1, bool)
    new[:-1] = inside
    new[1:-1] &= ~inside[:-1]
    cuts = at[:-1][at[:-1] < len(buf)]
    new[cuts] = inside[cuts]  # a text begins anew
    starts = np.flatnonzero(new)
    first = np.searchsorted(starts, at)
    packed = buf[inside]
    offsets = np.concatenate((np.cumsum(inside) - inside, [len(packed)]))[np.append(starts, len(buf))].astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    codes = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return packed, offsets, codes, first


def _joined(packed: np.ndarray, offsets: np.ndarray, kept: np.ndarray, first: np.ndarray) -> pa.Array:
    """Each text's kept words with one space between them."""
    size = (np.diff(offsets) + 1)[kept]
    total = np.concatenate(([0], np.cumsum(size)))
    begin, out = offsets[:-1][kept], np.full(int(total[-1]), 0x20, np.uint8)
    where = np.arange(int(total[-1])) - np.repeat(total[:-1], size)
    letters = where < np.repeat(size - 1, size)
    out[letters] = packed[(np.repeat(begin, size) + where)[letters]]
    upto = total[np.concatenate(([0], np.cumsum(kept)))[first]]
    raw = [out[a : b - 1].tobytes() if b > a else b"" for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
    return pa.array(raw, pa.binary()).cast(pa.string())


def _scan(id_col: str, text_col: str):
    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, text_col):
                packed, offsets, codes, first = _word_codes(texts)
                n = np.diff(first)
                runs: list[list[tuple[int, int, int]]] = [[] for _ in n]
                drops = np.zeros(len(codes) + 1, np.int64)
                for a, b in surviving_segments(codes, first):
                    text = int(np.searchsorted(first, a, side="right")) - 1
                    for s, size, q in lag_scan(codes[a:b]):
                        runs[text].append((int(a - first[text]) + s, size, q))
                        drops[a + s + q] += 1
                        drops[a + s + size] -= 1
                kept = np.cumsum(drops)[:-1] == 0
                found = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in sorted(x, key=lambda r: (r[0], r[2]))] for x in runs]
                yield pa.RecordBatch.from_pydict(
                    {
                        id_col: part.column(part.schema.get_field_index(id_col)),
                        "n_words": pa.array(n, pa.int64()),
                        "runs": pa.array(found, pa.list_(RUN)),
                        "collapsed": _joined(packed, offsets, kept, first),
                    }
                )

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, runs (start, length, period by start, then period), collapsed.

    Words are stretches without ASCII white space, compared as they are. A run
    is a stretch of words with smallest period q, of max(6, 4q) words or more,
    that no neighbouring word extends. ``collapsed`` are the words with one
    space between them, each run cut to its first q words.

    There is no shuffle: every row is judged in its own task. A null text
    counts as empty: no words, no runs, an empty ``collapsed``; an empty text
    likewise. Very long texts are handled whole: a slice of rows holds 2 MiB of
    text or one longer text, lags take about n log n looks, and memory is a
    small multiple of the text. Repeated rows and ids give one row each, a null
    id stays null. Other columns are not read, whatever their names; an empty
    table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shape = f"`{id_col}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(id_col, text_col).mapInArrow(_scan(id_col, text_col), shape)


def with_planted_runs(text: Column, doc_id: Column) -> Column:
    """Texts of which every tenth (by its id's checksum) turns periodic from some word on.

    Let h = crc32(decimal id) and g = h div 10. If 10 divides h, then from word
    a = g % n on the words repeat the p = 1 + (n - a) div (3 + g % 8) first ones.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def planted(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, F.greatest(n, F.lit(1)))
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        block = F.slice(words, (a + 1).cast("int"), p.cast("int"))
        again = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
        return F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), again), F.lit(1), n.cast("int"))

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    changed = F.transform(F.array(words), lambda w: F.concat_ws(" ", planted(w)))[0]
    return F.when(F.pmod(h, F.lit(10)) == 0, changed).otherwise(text)


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of each document's runs: their number, the longest one, and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.floor(1000 * F.col("best.n") / -F.col("best.q")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
