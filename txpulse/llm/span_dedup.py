"""Substring dedup by sliding spans of consecutive sentences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txpulse.llm.common import fresh, slices, written
from txpulse.llm.tokens import ALNUM, mix, runs, text_bytes, unspaced_stops, words

#: A span is the shortest run of at least so many sentences and words.
SENTENCES, WORDS = 3, 25
#: From this word of a sentence on, it may also end at a word (one in CUT) that the hash of it and
#: the words before it, AHEAD in all, picks; at the MOST-th word it ends.
LONG, CUT, AHEAD, MOST = 8, 4, 4, 64

_END = np.zeros(256, dtype=np.int64)
_END[[ord(c) for c in ".!?;:\n"]] = 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD1342543DE82EF95)


def _geometric(factor: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, factor, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _span_hashes(hashes: np.ndarray, head: np.ndarray, tail: np.ndarray, odd: np.uint64) -> np.ndarray:
    """Polynomial hash of the words from head to tail."""
    inverse = np.uint64(pow(int(odd), -1, 1 << 64))
    power, back = _geometric(odd, len(hashes)), _geometric(inverse, len(hashes))
    summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ odd) * power, dtype=np.uint64)))
    return mix((summed[tail + 1] - summed[head]) * back[head] + (tail - head).astype(np.uint64))


def spans(texts: pa.Array):
    """(doc, hash, second hash, words, start, end) of every span; start and end are bytes of the text.

    A span reaches from its first sentence's first word to the next sentence
    after its last one (or to the end of the text).
    """
    hashes, starts, ends, first = words(texts, ALNUM, unspaced=True)
    buf, at = text_bytes(texts)
    if not len(hashes):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    total = np.concatenate(([0], np.cumsum(_END[buf] + unspaced_stops(buf))))
    following = np.append(starts[1:], len(buf))
    stop = total[following] > total[ends]
    stop[first[1:][np.diff(first) > 0] - 1] = True
    # words since the last stop, to end long sentences where a word says so
    number = np.arange(len(hashes))
    begin = np.maximum.accumulate(np.where(np.concatenate(([True], stop[:-1])), number, 0))
    picked = np.zeros(len(hashes), bool)
    picked[AHEAD - 1 :] = runs(hashes, AHEAD) % np.uint64(CUT) == 0
    stop |= (number - begin >= LONG) & picked
    begin = np.maximum.accumulate(np.where(np.concatenate(([True], stop[:-1])), number, 0))
    stop |= (number - begin) % MOST == MOST - 1
    last = np.flatnonzero(stop)  # last word of each sentence
    head = np.concatenate(([0], last[:-1] + 1))
    owner = doc[head]
    final = np.searchsorted(owner, owner, side="right") - 1  # last sentence of the same text
    to = np.maximum(np.arange(len(head)) + SENTENCES - 1, np.searchsorted(last, head + WORDS - 1))
    own = np.flatnonzero(to <= final)
    head, to, owner, final = head[own], to[own], owner[own], final[own]
    tail = last[to]
    h, other = (_span_hashes(hashes, head, tail, odd) for odd in (_ODD, _OTHER))
    end = np.where(to < final, starts[np.minimum(tail + 1, len(starts) - 1)], at[owner + 1])
    return owner, h, other, tail - head + 1, starts[head] - at[owner], end - at[owner]


def _emit(batches):
    """Every span; ``again`` marks one that repeats an earlier span of the same text."""
    for batch in batches:
        for part, texts in slices(batch, "text"):
            owner, h, other, n, start, end = spans(texts)
            order = np.lexsort((start, other, h, owner))
            again = np.zeros(len(h), bool)
            again[order[1:]] = np.logical_and.reduce([x[order][1:] == x[order][:-1] for x in (h, other, owner)])
            yield pa.RecordBatch.from_pydict(
                {"id": part.column("id").take(pa.array(owner)), "hash": pa.array(h.astype(np.int64)), "other": pa.array(other.astype(np.int64)), "words": pa.array(n, pa.int32()),
                 "start": pa.array(start, pa.int64()), "stop": pa.array(end, pa.int64()), "again": pa.array(again)}
            )


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first_id, start, stop, n_spans): the passages that are not the first of their kind.

    A sentence ends at . ! ? ; : or a line end, and a long one also at words
    picked by the hash of the words up to them, so that text without marks has
    sentences too; in scripts without spaces each character is a word and their
    own marks end sentences. Every run of consecutive sentences (at least
    SENTENCES of them and WORDS words) is hashed by its words in lower case, to
    128 bits. Of equal spans the one in the document
    with the smallest id, and there the earliest, is the first; all others go.
    Overlapping spans that go are one passage, in bytes start to stop of the
    text; first_id is the smallest id that has the first of one of its spans.

    Span hashes meet once, as a map-side combined count and least id, and only
    what repeats is joined back; a passage in most documents stays dealt over
    many tasks. Null or empty texts and texts shorter than a span have no
    passage. A null id is first only among null ids; rows that repeat an id are
    one document and do not repeat each other. Very long texts are read whole,
    one at a time. Other columns are not read, whatever their names. An empty
    table gives no rows.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    found = src.mapInArrow(_emit, f"id {kind}, hash long, other long, words int, start long, stop long, again boolean")
    # a span that repeats within its text needs no other document
    least = found.groupBy("hash", "other", "words").agg(
        F.min("id").alias("first_id"), F.count("*").alias("n")
    ).where("n > 1").drop("n")
    later = found.join(least, ["hash", "other", "words"]).where(F.col("again") | ~F.col("id").eqNullSafe(F.col("first_id")))
    later = later.select("id", "first_id", "start", "stop")
    order = Window.partitionBy("id").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("opens", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int"))
    later = later.withColumn("passage", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        later.groupBy("id", "passage")
        .agg(F.min("first_id").alias("first_id"), F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n_spans"))
        .select(F.col("id").alias(id_col), "first_id", "start", "stop", "n_spans")
    )


def without_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of their texts (see ``repeated_passages``)."""
    cuts = repeated_passages(docs, id_col, text_col).groupBy(F.col(id_col).alias("cut_id")).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("cuts")
    )
    cuts = written(cuts, "cuts")
    at, cut_id = fresh(docs, "cuts"), fresh(docs, "cut_id")
    cuts = cuts.select(F.col("cut_id").alias(cut_id), F.col("cuts").alias(at))

    @F.pandas_udf("string")
    def cut(texts, places):
        import pandas as pd

        def one(text, spots):
            if text is None or spots is None:
                return text
            raw, out, k = text.encode(), [], 0
            for s in spots:
                out.append(raw[k : s["start"]])
                k = s["stop"]
            return b"".join([*out, raw[k:]]).decode()

        return pd.Series([one(t, p) for t, p in zip(texts, places, strict=True)], dtype=object)

    joined = docs.join(cuts, F.col(id_col).eqNullSafe(F.col(cut_id)), "left")
    return joined.withColumn(text_col, cut(F.col(text_col), F.col(at))).select(*docs.columns)
