"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txpulse.llm.common import slices
from txpulse.llm.tokens import ALNUM, runs, words

#: A document is contaminated where WINDOW words in a row of an item (all words of a
#: shorter item) agree with it word by word in the share MATCH of positions.
WINDOW, MATCH = 13, 0.8
#: Items of fewer words are no passage and are not searched.
MIN_WORDS = 5
#: Most masks of one window.
MASKS = 8
#: Bytes of benchmark text that are searched for in one pass over the documents.
BLOCK_BYTES = 1 << 22
#: Most bits of the first look at a hash, and how many places there are for each hash otherwise.
FILTER_BITS, FILTER_PLACES = 22, 64
#: Hits that are laid out at once.
HITS = 1 << 20


def allowed(window: int) -> int:
    """Substituted words that a window may have."""
    return window - int(np.ceil(window * MATCH - 1e-9))


@cache
def seed_masks(window: int) -> tuple[tuple[int, ...], ...]:
    """Fixed masks, each the positions that are compared, as heavy as MASKS masks allow.

    Wherever the allowed substitutions lie in a window, one mask at one place
    in it touches none of them. Found greedily, heaviest masks first.
    """
    wrong = [set(c) for c in combinations(range(window), allowed(window))]
    for weight in range(window, 0, -1):
        # heavier masks leave more hits out; of equal weight, the one that settles most cases is next
        options = {}
        for span in range(weight, window + 1):
            for inner in combinations(range(1, span - 1), weight - 2) if weight > 1 else [()] if span == 1 else []:
                mask = (0, *inner, span - 1) if weight > 1 else (0,)
                hit = frozenset(
                    i for i, w in enumerate(wrong) if any(not w & {p + m for m in mask} for p in range(window - span + 1))
                )
                if hit:
                    options[mask] = hit
        left, chosen = set(range(len(wrong))), []
        while left and len(chosen) < MASKS and options:
            mask = max(options, key=lambda m: (len(options[m] & left), -m[-1], m))
            if not options[mask] & left:
                break
            chosen.append(mask)
            left -= options[mask]
        if not left:
            return tuple(sorted(chosen))
    return ((0,),)


class Seeds:
    """Word hashes of a block of items and the hashes of all their masked places."""

    def __init__(self, items: list[tuple[object, str]]):
        texts = pc.utf8_lower(pa.array([t for _, t in items], pa.large_string()))
        hashes, _, _, first = words(texts, ALNUM, unspaced=True)
        self.ids, self.words, self.window = [], [], []
        found: dict[tuple[int, ...], list] = {}
        for (item_id, _), a, b in zip(items, first[:-1], first[1:], strict=True):
            if b - a < MIN_WORDS:
                continue
            window, own = min(WINDOW, b - a), hashes[a:b]
            for mask in seed_masks(int(window)):
                h = runs(own, mask[-1] + 1, mask)
                found.setdefault(mask, []).append((h, np.full(len(h), len(self.ids)), np.arange(len(h))))
            self.ids.append(item_id)
            self.words.append(own)
            self.window.append(int(window))
        self.masks = []
        for mask, parts in found.items():
            h, item, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            bits = min(FILTER_BITS, max(1, FILTER_PLACES * len(h) - 1).bit_length())  # every worker holds them
            look = np.zeros(1 << bits, bool)
            look[(h >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.masks.append((mask, h[order], item[order], place[order], look))

    def overlaps(self, hashes: np.ndarray, first: np.ndarray):
        """(document, item, first word, words, agreeing words) of each item's best verified overlap."""
        found: list[np.ndarray] = []
        longest = max((len(w) for w in self.words), default=0)
        span = len(hashes) + longest + 1  # a hit is one number: document, item, place of the item's first word
        for mask, seeds, item, place, look in self.masks:
            h = runs(hashes, mask[-1] + 1, mask)
            at = np.flatnonzero(look[(h >> np.uint64(65 - len(look).bit_length())).astype(np.int64)])
            low, high = np.searchsorted(seeds, h[at]), np.searchsorted(seeds, h[at], side="right")
            every = high - low
            at, low, every = at[every > 0], low[every > 0], every[every > 0]
            # many equal words give many hits of few places: they are thinned out as they come
            parts = np.cumsum(every) // HITS
            for k in np.unique(parts).tolist():
                a, b = np.searchsorted(parts, k), np.searchsorted(parts, k, side="right")
                n, here = every[a:b], np.repeat(at[a:b], every[a:b])
                seed = np.repeat(low[a:b], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                doc = np.searchsorted(first, here, side="right") - 1
                inside = here + mask[-1] < first[doc + 1]  # no mask lies across two documents
                hits = (doc * len(self.ids) + item[seed]) * span + (here - place[seed] + longest)
                found.append(np.unique(hits[inside]))
                if len(found) > 8:
                    found = [np.unique(np.concatenate(found))]
        if not found:
            return
        pair, start = np.divmod(np.unique(np.concatenate(found)), span)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, i, start in zip(*(x.tolist() for x in np.divmod(pair, len(self.ids))), (start - longest).tolist(), strict=True):
            own, window = self.words[i], self.window[i]
            low, high = max(start, first[doc]), min(start + len(own), first[doc + 1])
            if high - low < window:
                continue
            same = own[low - start : high - start] == hashes[low:high]
            total = np.concatenate(([0], np.cumsum(same)))
            good = np.flatnonzero(total[window:] - total[:-window] >= window - allowed(window))
            if len(good):
                a, b = int(good[0]), int(good[-1]) + window
                n = int(total[b] - total[a])
                if n > best.get((doc, i), (0, 0, 0))[2]:
                    best[doc, i] = (int(low + a - first[doc]), b - a, n)
        for (doc, i), (start, n, agree) in best.items():
            yield doc, i, start, n, agree


def doc_words(texts: pa.Array):
    hashes, _, _, first = words(pc.utf8_lower(texts), ALNUM, unspaced=True)
    return hashes, first


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """The seeds of the benchmark, about BLOCK_BYTES of its text at a time."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_BYTES))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        yield Seeds(sorted(((r["id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r)))


def contaminated_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item_id, start_word, n_words, n_same): each document's best overlap with each item it contains.

    Words are runs of letters and digits in lower case; in scripts without spaces
    each character is one. Masks that ignore some
    positions are hashed at every place of the items and of the documents; on
    equal hashes the two are laid side by side and compared word by word. An
    overlap counts if WINDOW words in a row (or the whole shorter item) agree
    in MATCH of their positions, so single words may be replaced. n_words and
    n_same span the first to the last such window.

    The benchmark is a stated query set: blocks of BLOCK_BYTES go to all tasks,
    one pass over the documents for each, and no document leaves its task.
    Null and empty texts, and items under MIN_WORDS words, overlap with
    nothing; null ids are kept; repeated documents or items give repeated
    rows. Very long texts are searched whole, and hits laid out HITS at a time,
    so equal words take no more memory than others. Other columns are not read,
    whatever their names. An empty table on either side gives no rows.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = [src.schema["id"].dataType, benchmark.schema[item_id_col].dataType]
    schema = f"id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, start_word long, n_words long, n_same long"
    out = None
    for seeds in benchmark_blocks(benchmark, item_id_col, item_text_col):
        part = src.mapInArrow(_search(src.sparkSession.sparkContext.broadcast(seeds), schema), schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id", id_col)


def _search(shared, schema: str):
    def run(batches):
        seeds = shared.value
        for batch in batches:
            for part, texts in slices(batch, "text"):
                ids = part.column("id")
                rows = list(seeds.overlaps(*doc_words(texts)))
                if rows:
                    doc, item, start, n, same = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_pydict(
                        {"id": ids.take(pa.array(doc)), "item_id": pa.array([seeds.ids[i] for i in item]),
                         "start_word": pa.array(start, pa.int64()), "n_words": pa.array(n, pa.int64()), "n_same": pa.array(same, pa.int64())}
                    )

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents, with all columns, that contain no item (see ``contaminated_spans``)."""
    for seeds in benchmark_blocks(benchmark, item_id_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(seeds)
        docs = docs.where(~F.arrow_udf(_contains(shared), "boolean")(F.col(text_col)))
    return docs


def _contains(shared):
    def hits(column: pa.Array) -> pa.Array:
        found, before = np.zeros(len(column), bool), 0
        for _, own in slices(pa.RecordBatch.from_pydict({"text": column}), "text"):
            found[[before + r[0] for r in shared.value.overlaps(*doc_words(own))]] = True
            before += len(own)
        return pa.array(found)

    return hits
