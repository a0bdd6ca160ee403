"""Quality classifier: ordinal cumulative-link regression on graded ratings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txpulse.llm.common import fresh, slices
from txpulse.llm.tokens import ALNUM, SPACED, mix, text_bytes, words

#: Hash slots of words, and slots of the text's looks behind them.
SLOTS, LOOKS = 1 << 17, 512
#: About so many labelled documents are fitted on.
TRAIN_ROWS = 10_000
#: Passes of the fit, its penalty, and the documents that a slot needs: 3, or one in RARE of the sample.
STEPS, PENALTY, RARE = 150, 3.0, 500
#: Grades from worst to best.
GRADES = ("toxic", "poor", "good")

_KIND = np.zeros(256, dtype=np.int64)  # 0 other marks, 1 lower, 2 upper, 3 digit, 4 non-ASCII, 5 space
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:], _KIND[~SPACED] = 1, 2, 3, 4, 5


def features(texts: pa.Array) -> list[np.ndarray]:
    """Distinct hash slots of each text: its words with and without marks, and its looks as binned shares."""
    hashes, _, _, first = words(texts)
    plain, _, _, first_plain = words(texts, ALNUM)
    buf, at = text_bytes(texts)
    slot = (mix(hashes) % np.uint64(SLOTS)).astype(np.int64)
    plain = (mix(~plain) % np.uint64(SLOTS)).astype(np.int64)
    kinds = _KIND[buf]
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    shares = np.bincount(owner * 6 + kinds, minlength=6 * (len(at) - 1)).reshape(-1, 6)
    out = []
    for i in range(len(at) - 1):
        own = slot[first[i] : first[i + 1]]
        unique = np.unique(own)
        size, n = max(1, at[i + 1] - at[i]), len(own)
        looks = [int(20 * s / size) for s in shares[i]]
        looks.append(int(20 * len(unique) / max(1, n)))
        looks.append(min(20, int(np.log2(n + 1))))
        looks.append(min(20, int((size / max(1, n)))))
        both = np.unique(np.concatenate((unique, plain[first_plain[i] : first_plain[i + 1]])))
        out.append(np.concatenate((both, SLOTS + np.arange(len(looks)) * 21 + looks)))
    return out


def _featurise(batches):
    for batch in batches:
        for part, texts in slices(batch, "text"):
            found = features(texts)
            yield pa.RecordBatch.from_pydict(
                {"id": part.column("id"), "grade": part.column("grade"), "slots": pa.array(found, pa.list_(pa.int64()))}
            )


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Ordinal:
    """P(grade > j) = sigmoid(score - cut j): one weight a slot for all grades, ordered cuts."""

    def __init__(self, weights: np.ndarray, cuts: np.ndarray):
        self.weights, self.cuts = weights, cuts

    @classmethod
    def fit(cls, rows: list[np.ndarray], grades: np.ndarray, n_grades: int, steps: int = STEPS, penalty: float = PENALTY):
        """Penalised maximum likelihood by accelerated gradient steps (Adam) on all rows."""
        held = np.bincount(np.concatenate(rows), minlength=SLOTS + LOOKS)
        rows = [r[held[r] >= max(3, len(rows) / RARE)] for r in rows]
        flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        weights, n = np.zeros(SLOTS + LOOKS), len(rows)
        share = np.array([(grades > j).mean() for j in range(n_grades - 1)]).clip(1e-6, 1 - 1e-6)
        # cuts are the first one and the logarithms of the gaps, so they stay in order
        cuts = -np.log(share / (1 - share))
        free = np.concatenate((cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))))
        moments = [[np.zeros_like(weights), np.zeros_like(weights)], [np.zeros_like(free), np.zeros_like(free)]]
        for step in range(1, steps + 1):
            gaps = np.exp(free[1:])
            cuts = free[0] + np.concatenate(([0.0], np.cumsum(gaps)))
            score = np.bincount(owner, weights[flat], minlength=n)
            above = sigmoid(score[:, None] - cuts)  # P(grade > j)
            edge = np.concatenate((np.ones((n, 1)), above, np.zeros((n, 1))), axis=1)
            p = np.maximum(edge[np.arange(n), grades] - edge[np.arange(n), grades + 1], 1e-12)
            slope = edge * (1 - edge)
            up, down = slope[np.arange(n), grades] / p, slope[np.arange(n), grades + 1] / p
            d_weights = np.bincount(flat, (up - down)[owner], minlength=len(weights)) - penalty * weights
            d_cuts = np.zeros(n_grades + 1)
            np.add.at(d_cuts, grades, -up)
            np.add.at(d_cuts, grades + 1, down)
            d_cuts = d_cuts[1:-1]
            after = np.cumsum(d_cuts[::-1])[::-1]
            d_free = np.concatenate((after[:1], after[1:] * gaps))
            for x, g, (m, v) in ((weights, d_weights, moments[0]), (free, d_free, moments[1])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) * (1 - step / (steps + 1))
        return cls(weights, free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:])))))

    def tails(self, rows: list[np.ndarray]) -> np.ndarray:
        """P(grade > j) for each row and cut."""
        score = np.array([self.weights[r].sum() for r in rows])
        return sigmoid(score.reshape(-1, 1) - self.cuts)


def grade_of(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good; null without a rating."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int = len(GRADES), train_rows: int = TRAIN_ROWS) -> Ordinal:
    """Fits on about ``train_rows`` of ``ratings`` (id, grade), chosen by a hash of the id.

    The sample is bounded, so one task fits it; only rated documents that it
    names are joined and turned into features.
    """
    rated = ratings.where("grade is not null and id is not null").dropDuplicates(["id"])
    share = min(1.0, train_rows / max(1, rated.count()))
    chosen = F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(1_000_000)) < share * 1_000_000
    sample = docs.where(chosen).join(rated.where(chosen), "id").select("id", "grade", "text")
    kind = sample.schema["id"].dataType.simpleString()
    sample = sample.mapInArrow(_featurise, f"id {kind}, grade int, slots array<long>")

    def train(rows):
        import pandas as pd

        rows = rows.sort_values("id", kind="stable")
        model = Ordinal.fit(rows["slots"].tolist(), rows["grade"].to_numpy(), n_grades)
        kept = np.flatnonzero(np.abs(model.weights) > 1e-6)
        return pd.DataFrame({"slot": np.concatenate((kept, -1 - np.arange(len(model.cuts)))), "value": np.concatenate((model.weights[kept], model.cuts))})

    out = sample.groupBy(F.lit(0).alias("all")).applyInPandas(train, "slot long, value double").toPandas()
    weights, cuts = np.zeros(SLOTS + LOOKS), np.arange(n_grades - 1, dtype=float)
    slots, values = out["slot"].to_numpy(np.int64), out["value"].to_numpy()
    weights[slots[slots >= 0]] = values[slots >= 0]
    cuts[-1 - slots[slots < 0]] = values[slots < 0]
    return Ordinal(weights, cuts)


def grade_documents(
    docs: DataFrame, ratings: DataFrame, select_from: int = 2, least: float = 0.6, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with expected_grade, tail_probability and selected (named anew where taken).

    ``ratings`` has (id, grade), grades 0, 1, 2 from worst to best. One weight
    a hashed word (and look of the text: shares of letters, digits and marks,
    repetition, length) serves all grades; ordered cuts part them. The expected
    grade is the sum of P(grade > j); tail_probability is P(grade >=
    select_from), and a document is selected from ``least`` on.

    Fitting takes about TRAIN_ROWS ratings; scoring takes every whole text.
    A null text counts as empty and is scored by its looks; repeated rows are
    scored alike; an id rated more than once counts once (any of its ratings);
    without ratings all scores are the same; an empty table gives no rows.
    """
    model = fit(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ratings)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("expected double, tail double")
    def score(column):
        import pandas as pd

        batch, tails = pa.RecordBatch.from_pydict({"text": pa.array(column, pa.string())}), []
        for _, texts in slices(batch, "text"):
            tails.append(shared.value.tails(features(texts)))
        tails = np.concatenate(tails) if tails else np.zeros((0, len(shared.value.cuts)))
        return pd.DataFrame({"expected": tails.sum(axis=1), "tail": tails[:, select_from - 1]})

    found = fresh(docs, "graded")
    names = [fresh(docs, n) for n in ("expected_grade", "tail_probability", "selected")]
    return (
        docs.withColumn(found, score(F.col(text_col)))
        .withColumn(names[0], F.col(found)["expected"])
        .withColumn(names[1], F.col(found)["tail"])
        .withColumn(names[2], F.col(found)["tail"] >= least)
        .drop(found)
    )
