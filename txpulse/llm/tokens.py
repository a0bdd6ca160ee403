"""Words and word hashes of many texts at once, as numpy arrays over their bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_MULT = _rng.integers(1, 2**63, 64, dtype=np.uint64) | U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)

#: Bytes that belong to words: all but ASCII white space, or letters, digits and non-ASCII.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and each text's offset (one more at the end)."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word (a bijection)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(n, _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


#: Lead bytes and second bytes (from, to) in UTF-8 of scripts written without spaces:
#: Thai and Lao, Myanmar, Khmer, kana, Han; and the marks that end their sentences.
UNSPACED = ((0xE0, 0xB8, 0xBB), (0xE1, 0x80, 0x82), (0xE1, 0x9E, 0x9F), (0xE3, 0x81, 0x83), (0xE3, 0x90, 0xBF))
HAN = (0xE4, 0xE9)
STOPS = ("。", "！", "？", "；", "：", "、", "，")


def _at(buf: np.ndarray, i: int) -> np.ndarray:
    """The byte ``i`` places on, zero past the end."""
    return np.concatenate((buf[i:], np.zeros(i, np.uint8)))


def unspaced_letters(buf: np.ndarray) -> np.ndarray:
    """Where a character of a script without spaces begins (all take three bytes)."""
    second = _at(buf, 1)
    out = (buf >= HAN[0]) & (buf <= HAN[1])
    for lead, low, high in UNSPACED:
        out |= (buf == lead) & (second >= low) & (second <= high)
    return out


def unspaced_stops(buf: np.ndarray) -> np.ndarray:
    """Where a stop of those scripts begins."""
    out = np.zeros(len(buf), bool)
    if (buf >= 0xE3).any():
        for mark in STOPS:
            a, b, c = mark.encode()
            out |= (buf == a) & (_at(buf, 1) == b) & (_at(buf, 2) == c)
    return out


def words(texts: pa.Array, inside: np.ndarray = SPACED, unspaced: bool = False) -> tuple[np.ndarray, ...]:
    """(hashes, starts, ends, first): every word's hash and byte range, A-Z lower-cased,
    and the number of each text's first word (one more at the end).

    With ``unspaced`` each character of a script without spaces is a word, and its stops are none.
    """
    buf, at = text_bytes(texts)
    is_in = inside[buf]
    single = np.zeros(len(buf), bool)
    if unspaced and (buf >= 0xE0).any():
        single = unspaced_letters(buf)
        for i in np.flatnonzero(unspaced_stops(buf)).tolist():
            is_in[i : i + 3] = False
    before, after = np.zeros(len(buf), bool), np.zeros(len(buf), bool)
    before[1:], after[:-1] = is_in[:-1], is_in[1:]
    if single.any():
        alone = np.flatnonzero(single)
        before[alone] = False
        after[alone[alone > 0] - 1] = False
        last = alone + 2
        after[last] = False
        before[last[last + 1 < len(buf)] + 1] = False
    cuts = at[:-1][at[:-1] < len(buf)]
    before[cuts] = False
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(is_in & ~before)
    ends = np.flatnonzero(is_in & ~after) + 1
    first = np.searchsorted(starts, at)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, first
    size = ends - starts
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    where = np.arange(int(size.sum())) - np.repeat(begin, size)
    term = _BYTE[LOWER[buf[is_in]]] * _power_table(int(size.max()))[where]
    return mix(np.add.reduceat(term, begin) + size.astype(np.uint64)), starts, ends, first


def runs(hashes: np.ndarray, k: int, offsets: tuple[int, ...] | None = None) -> np.ndarray:
    """A hash of each k words in a row (or of those at ``offsets`` only), by first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, o in enumerate(range(k) if offsets is None else offsets):
        out += mix(hashes[o : o + n] * _MULT[j % 64] + U64(j))
    return mix(out + U64(k))


def shingle_sets(hashes: np.ndarray, first: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; a shorter text is one shingle."""
    grams = runs(hashes, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        else:
            out.append(runs(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def weighed_shingles(hashes: np.ndarray, first: np.ndarray, k: int, weights: np.ndarray):
    """(set, weights) of each text as in ``shingle_sets``, a shingle weighing what its words do (integers)."""
    grams, total = runs(hashes, k), np.concatenate(([0], np.cumsum(weights)))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            s, at = np.unique(grams[a : b - k + 1], return_index=True)
            out.append((s, total[a + at + k] - total[a + at]))
        else:
            s = runs(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64)
            out.append((s, np.full(len(s), total[b] - total[a])))
    return out
