"""URL filter: host and path rules, then a character language-model ratio."""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txpulse.llm.common import slices, written
from txpulse.llm.tokens import text_bytes

#: (verdict, host, path) of the stated rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Longest context in bytes (with the byte that follows, a long holds 7); weight of the next shorter context.
ORDER, PRIOR = 5, 4.0
#: One fifth of the rule-decided URLs sets the threshold, the others the counts.
FOLDS = 5
#: Score bins of the calibration, over -RANGE..RANGE nats a byte.
BINS, RANGE = 2000, 10.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path as the contract states them; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None)
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each byte with the ORDER bytes before it as one number, its own the lowest, and each text's first row.

    A text is padded by ORDER marks in front and one at its end, which is predicted too.
    """
    buf, at = text_bytes(texts)
    n = len(at) - 1
    pad = ORDER + 1
    where = np.arange(len(buf)) + np.repeat(np.arange(n) * pad + ORDER, np.diff(at))
    padded = np.full(len(buf) + n * pad, 2, dtype=np.int64)
    lower = buf.copy()
    lower[(buf >= 65) & (buf <= 90)] += 32
    padded[where] = lower
    first = at + np.arange(n + 1) * pad
    padded[first[1:] - 1] = 3
    predicted = np.ones(len(padded), bool)
    for j in range(ORDER):
        predicted[first[:-1] + j] = False
    rows = np.flatnonzero(predicted)
    grams = np.zeros(len(rows), np.int64)
    for o in range(ORDER + 1):
        grams |= padded[rows - o] << (8 * o)
    return grams, at[:-1] + np.arange(n)


def _number(batches):
    """The rows with the number of their chunk, which is small enough to be held at once."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part, _ in slices(batch, "url"):
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.full(len(part), chunk), pa.int64())], names=[*part.schema.names, "chunk"]
            )
            chunk += 1


def _count(batches):
    """The distinct grams of each chunk, and how often they occur in its allowed and blocked examples."""
    for batch in batches:
        for part, texts in slices(batch, "url"):
            chunks = part.column(part.schema.get_field_index("chunk")).to_numpy()
            kinds = np.array(part.column(part.schema.get_field_index("example")).to_pylist(), dtype=object)
            edges = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
            for a, b in pairwise(edges):
                grams, first = _grams(texts.slice(a, b - a))
                kind = np.repeat(kinds[a:b], np.diff(np.append(first, len(grams))))
                own, at = np.unique(grams, return_inverse=True)
                n = [np.bincount(at[kind == verdict], minlength=len(own)) for verdict in ("allow", "block")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), chunks[a]), pa.int64()), pa.array(own, pa.int64()), *(pa.array(x, pa.int64()) for x in n)],
                    names=["chunk", "gram", "allow", "block"],
                )


def gram_ratios(events: DataFrame) -> DataFrame:
    """(gram, ratio): the difference of the two models' log probabilities of each distinct gram's last byte.

    Counts for shorter contexts are sums of those for longer ones. A gram of one
    length meets its context and its next shorter gram, each shared by 256 grams
    at most, so no join has a hot key.
    """
    sums = [F.sum(v).alias(v) for v in ("allow", "block")]
    lengths = [written(events.groupBy("gram").agg(*sums), "grams")]
    for o in range(ORDER - 1, -1, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * (o + 1)) - 1)).alias("gram")
        lengths.insert(0, written(lengths[0].groupBy(shorter).agg(*sums), f"grams-{o}"))
    known = None
    for o, grams in enumerate(lengths):
        context = F.shiftright("gram", 8)
        after = grams.groupBy(context.alias("context")).agg(*[F.sum(v).alias(f"{v}_all") for v in ("allow", "block")])
        rows = grams.withColumn("context", context).join(after, "context")
        if known is None:
            rows = rows.withColumns({f"{v}_less": F.lit(1 / 256) for v in ("allow", "block")})
        else:
            less = known.select(F.col("gram").alias("less"), *[F.col(f"{v}_p").alias(f"{v}_less") for v in ("allow", "block")])
            rows = rows.withColumn("less", F.col("gram").bitwiseAND(F.lit((1 << 8 * o) - 1))).join(less, "less")
        known = rows.select(
            "gram", *[((F.col(v) + PRIOR * F.col(f"{v}_less")) / (F.col(f"{v}_all") + PRIOR)).alias(f"{v}_p") for v in ("allow", "block")]
        )
    return known.select("gram", (F.log("allow_p") - F.log("block_p")).alias("ratio"))


def _score(rows: pa.Table, ratios: pa.Table) -> pa.Table:
    """A chunk's rows with the length-normalised log-likelihood difference, from the ratios of its grams."""
    grams, first = _grams(rows["url"].combine_chunks().cast(pa.large_string()))
    own, at = np.unique(ratios["gram"].to_numpy(), return_index=True)
    ratio = ratios["ratio"].to_numpy()[at][np.searchsorted(own, grams)]
    score = np.add.reduceat(ratio, first) / np.diff(np.append(first, len(ratio)))
    return rows.drop_columns(["url", "chunk", "example"]).append_column("score", pa.array(score, pa.float64()))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, score), one row per URL.

    The longest rule that fits decides. The URLs that rules decide are the
    accepted and rejected examples: four fifths of them, all of these rows,
    give the byte counts of one smoothed variable-order Markov model each
    (contexts of 0 to 5 bytes). The counts are an exact table with a row for
    each distinct context and byte, so it grows with the input. Chunks of rows
    look up their distinct grams in it by a join and are scored with what they
    found. The rest sets the threshold on the difference of the two
    log-likelihoods a byte at the least balanced error. URLs without a rule are
    allowed from that threshold on.

    A null URL counts as empty; repeated rows are judged alike; a null id is
    kept. Without examples of both verdicts the threshold is 0, and equal
    models allow. Very long URLs are scored whole. Other columns are not read,
    whatever their names. An empty table gives no rows.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    found = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("found", found).select("id", "url", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(FOLDS))
    example = F.when(fold != 0, F.col("ruled"))
    rows = rows.withColumns({"held": fold == 0, "example": example})
    typed = lambda fields, more: ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in fields), more])
    rows = written(rows.mapInArrow(_number, typed(rows.schema, "chunk long")), "chunks")
    events = rows.select("chunk", "url", "example").mapInArrow(_count, "chunk long, gram long, allow long, block long")
    events = written(events, "events")
    found = events.select("chunk", "gram").join(gram_ratios(events), "gram")
    out = [f for f in rows.schema if f.name not in ("url", "chunk", "example")]
    scored = rows.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_score, typed(out, "score double"))
    scored = written(scored, "urls")
    at = F.floor((F.col("score") + RANGE) * (BINS / (2 * RANGE)))
    held = scored.where("ruled is not null and held").groupBy(
        F.greatest(F.lit(0), F.least(F.lit(BINS), at)).alias("bin"), "ruled"
    ).agg(F.count("*").alias("n")).collect()
    threshold = least_error([(r["bin"], r["ruled"], r["n"]) for r in held])
    model_verdict = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", model_verdict).alias("verdict"), "score")


def least_error(held: list[tuple[int, str, int]]) -> float:
    """The score from which on URLs are allowed: the lower edge of the bin at which
    the shares of wrong verdicts of both kinds add up to least (ties: nearest to 0)."""
    n = np.zeros((2, BINS + 1))
    for b, verdict, k in held:
        n[int(verdict == "block"), b] += k
    if not n.sum(axis=1).all():
        return 0.0
    below = np.concatenate((np.zeros((2, 1)), np.cumsum(n, axis=1)), axis=1)  # wrong if allowed rows lie below
    wrong = below[0] / below[0, -1] + 1 - below[1] / below[1, -1]
    edges = np.arange(BINS + 2) * (2 * RANGE / BINS) - RANGE
    best = np.flatnonzero(np.isclose(wrong, wrong.min()))
    return float(edges[best[np.argmin(np.abs(edges[best]))]])
