"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txpulse.llm.common import fresh

#: Most frequent n-grams of a profile; a document's own list is as long.
RANKS = 400
#: About so many labelled documents of each language are learned from.
TRAIN_ROWS = 5000
#: Code points handled at once.
PIECE = 1 << 20
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter or a mark on one."""
    return np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(sys.maxunicode + 1)])


@cache
def _plain_letters() -> np.ndarray:
    """Whether a code point is a letter by itself."""
    return np.array([unicodedata.category(chr(i))[0] == "L" for i in range(sys.maxunicode + 1)])


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted n-grams (1 to 3 code points, 21 bits each) of the whole text and their counts.

    Lower case, everything but letters as one space, no n-gram across a space.
    """
    letter = _letters()
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    tail = np.array([0, 32], dtype=np.uint64)
    lowered = text.lower()
    for i in range(0, len(lowered) + 1, PIECE):
        piece = lowered[i : i + PIECE] + (" " if i + PIECE > len(lowered) else "")
        code = np.frombuffer(piece.encode("utf-32-le", "replace"), dtype=np.uint32)
        code = np.where(letter[code], code, 32).astype(np.uint64)
        space = code == 32
        double = space.copy()
        double[1:] &= space[:-1]
        double[:1] &= tail[1] == 32
        code = code[~double]
        line = np.concatenate((tail, code))
        one = code[code != 32]
        two = (line[1:-1] << np.uint64(21) | line[2:])
        three = (line[:-2] << np.uint64(42) | line[1:-1] << np.uint64(21) | line[2:])[(line[1:-1] != 32) & (line[:-2] != 0)]
        k, n = np.unique(np.concatenate((one, two, three)), return_counts=True)
        if len(keys):
            k, back = np.unique(np.concatenate((keys, k)), return_inverse=True)
            n = np.bincount(back, weights=np.concatenate((counts, n))).astype(np.int64)
        keys, counts, tail = k, n, line[-2:]
    return keys, counts


def ranked(keys: np.ndarray, counts: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams in order of rank, ties by code point."""
    return keys[np.argsort(-counts, kind="stable")[:ranks]]


def _train(batches):
    for batch in batches:
        held: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(gram_counts(text))
            if len(held[lang]) >= 256:
                held[lang] = [_merge(held[lang])]
        for lang, parts in held.items():
            k, n = _merge(parts)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * len(k), pa.string()), "gram": pa.array(k.astype(np.int64)), "n": pa.array(n, pa.int64())}
            )


def _merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
    k, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return k, np.bincount(back, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def learn_profiles(labelled: DataFrame, ranks: int = RANKS, train_rows: int = TRAIN_ROWS) -> dict[str, list[int]]:
    """The ranked n-grams of every label in ``labelled`` (id, lang, text); ``ranks`` numbers a label at most."""
    labelled = labelled.where("lang is not null and text is not null")
    # one row a label, as few as the profiles that every task gets
    per = labelled.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(train_rows) / F.count("*")).alias("share"))
    chosen = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.col("share") * 1_000_000
    grams = labelled.join(F.broadcast(per), "lang").where(chosen).select("lang", "text").mapInArrow(_train, "lang string, gram long, n long")
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = grams.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    out: dict[str, list[int]] = {}
    for r in sorted(top.select("lang", "rank", "gram").collect()):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Profiles:
    """All profiles as one sparse table (gram, label, rank), sorted by n-gram."""

    def __init__(self, learned: dict[str, list[int]], ranks: int):
        self.ranks = ranks
        self.langs = sorted(learned)
        sizes = [len(learned[lang]) for lang in self.langs]
        every = np.array([g for lang in self.langs for g in learned[lang]], dtype=np.uint64)
        order = np.argsort(every, kind="stable")
        self.grams, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every))
        self.label = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
        self.rank = np.concatenate([np.zeros(0, np.int32), *(np.arange(n, dtype=np.int32) for n in sizes)])[order]

    def judge(self, text: str | None) -> tuple[str, float]:
        """(label, score): the least out-of-place distance, as a share of the greatest possible one taken from 1."""
        keys, counts = gram_counts(text or "")
        singles = keys[keys < np.uint64(1 << 21)].astype(np.int64)
        if not self.langs or not _plain_letters()[singles].any():
            return UNKNOWN, 0.0
        own = ranked(keys, counts, self.ranks)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = np.flatnonzero(self.grams[at] == own)
        low, n = self.first[at[known]], self.first[at[known] + 1] - self.first[at[known]]
        rows = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        near = self.ranks - np.abs(self.rank[rows] - np.repeat(known, n))
        distance = len(own) * self.ranks - np.bincount(self.label[rows], weights=near, minlength=len(self.langs))
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (len(own) * self.ranks))


def held_out(doc_id) -> F.Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    ranks: int = RANKS,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``docs`` with held_out, lang_pred and score (named anew where taken).

    Profiles come from the text and non-null label of documents that are not
    held out, about ``train_rows`` of each label by a hash of the id, and every
    label has one; label, source and id are not inputs of a prediction. Each whole text's own most
    frequent n-grams are compared with every profile by out-of-place distance;
    the nearest label wins, ties by code point. A text that is null or has no
    letter is ``und`` with score 0, and so is every text if nothing could be
    learned. A null id is not held out. Very long texts are counted whole, a
    piece at a time. Repeated rows are judged alike, an empty table gives no rows.
    """
    held = held_out(F.col(id_col))
    source = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), held.alias("held"))
    profiles = Profiles(learn_profiles(source.where("not held").drop("held"), ranks, train_rows), ranks)
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.pandas_udf("label string, score double")
    def judge(texts):
        import pandas as pd

        p = shared.value
        return pd.DataFrame([p.judge(t) for t in texts], columns=["label", "score"])

    found = fresh(docs, "language_found")
    names = [fresh(docs, n) for n in ("held_out", "lang_pred", "score")]
    return (
        docs.withColumn(found, judge(F.col(text_col)))
        .withColumn(names[0], held)
        .withColumn(names[1], F.col(found)["label"])
        .withColumn(names[2], F.col(found)["score"])
        .drop(found)
    )
