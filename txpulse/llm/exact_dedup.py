"""Exact dedup by composable polynomial fingerprints."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txpulse.llm.common import WS, fresh, kept, scope, slices, written
from txpulse.llm.tokens import SPACED, text_bytes

#: Two independent (modulus, base) pairs; a fingerprint is both remainders, 62 bits.
FIELDS = ((2_147_483_647, 1_000_003), (2_147_483_629, 19_260_817))
#: Bytes hashed as one chunk; 255 * 2**31 * CHUNK stays below 2**63.
CHUNK = 4096
#: Bytes compared at once when fingerprints are equal.
COMPARE = 1 << 16
#: Rows of one group that are compared in one run; a larger group is dealt over more runs.
RUN_ROWS = 1000

_POWERS = [np.array([pow(b, i, p) for i in range(CHUNK)], dtype=np.uint64) for p, b in FIELDS]


def combine(left: tuple[int, ...], right: tuple[int, ...], right_len: int) -> tuple[int, ...]:
    """Fingerprint of a text from those of its two parts: the left one is shifted by the right one's length."""
    return tuple(
        (a * pow(b, right_len, p) + c) % p for (p, b), a, c in zip(FIELDS, left, right, strict=True)
    )


def normalised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts with each run of white space as one space."""
    buf, at = text_bytes(texts)
    space = ~SPACED[buf]
    again = np.zeros(len(buf), bool)
    again[1:] = space[1:] & space[:-1]
    again[at[:-1][at[:-1] < len(buf)]] = False
    kept = np.concatenate(([0], np.cumsum(~again)))
    out = np.where(space, np.uint8(0x20), buf)[~again]
    return out, kept[at]


def chunk_hashes(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every chunk's two remainders, its length, and the number of chunks of each text."""
    n = np.diff(at)
    chunks = -(-n // CHUNK)
    if not chunks.sum():
        return np.zeros((0, 2), np.int64), np.zeros(0, np.int64), chunks
    nth = np.arange(int(chunks.sum())) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    begin = np.repeat(at[:-1], chunks) + nth * CHUNK
    size = np.minimum(np.repeat(at[1:], chunks) - begin, CHUNK)
    power = np.repeat(begin + size - 1, size) - np.arange(len(buf))
    wide = buf.astype(np.uint64)
    sums = [np.add.reduceat(wide * t[power], begin) % np.uint64(p) for t, (p, _) in zip(_POWERS, FIELDS, strict=True)]
    return np.stack(sums, axis=1).astype(np.int64), size, chunks


def fingerprints(buf: np.ndarray, at: np.ndarray) -> list[int]:
    """One fingerprint a text, its chunks' hashes combined from left to right."""
    sums, size, chunks = chunk_hashes(buf, at)
    sums, size, out, k = sums.tolist(), size.tolist(), [], 0
    for n in chunks.tolist():
        h = (0, 0)
        for j in range(k, k + n):
            h = combine(h, sums[j], size[j]) if j > k else tuple(sums[j])
        out.append(h[0] << 31 | h[1])
        k += n
    return out


def _prints(text: str, with_text: bool):
    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, text):
                buf, at = normalised(texts)
                raw = [buf[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                cols = {c: part.column(i) for i, c in enumerate(part.schema.names) if c != text}
                cols["fp"] = pa.array(fingerprints(buf, at), pa.int64())
                cols["n_bytes"] = pa.array(np.diff(at), pa.int64())
                cols["sha"] = pa.array([hashlib.sha256(x).hexdigest() for x in raw])
                if with_text:
                    cols["body"] = pa.array(raw, pa.binary())
                yield pa.RecordBatch.from_pydict(cols)

    return run


def same(a: bytes, b: bytes) -> bool:
    """Whether two texts are equal, compared chunk by chunk up to the first difference."""
    return len(a) == len(b) and all(a[i : i + COMPARE] == b[i : i + COMPARE] for i in range(0, len(a), COMPARE))


def _compare(batches):
    """Rows sorted by (fp, n_bytes, salt): each text takes the sha of the first equal one of its run."""
    run, leaders = None, []
    for batch in batches:
        rows = batch.to_pydict()
        leader = []
        for key, body, sha in zip(zip(rows["fp"], rows["n_bytes"], rows["salt"], strict=True), rows["body"], rows["sha"], strict=True):
            if key != run:
                run, leaders = key, []
            mine = next((s for b, s in leaders if same(b, body)), None)
            if mine is None:
                leaders.append((body, sha))
                mine = sha
            leader.append(mine)
        yield pa.RecordBatch.from_pydict(
            {"id": batch.column("id"), "fp": batch.column("fp"), "n_bytes": batch.column("n_bytes"), "sha": pa.array(leader, pa.string())}
        )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became
    one space; a null text counts as empty. Every text gets a polynomial
    fingerprint put together from the hashes of its chunks. Texts that share
    fingerprint and length with another one are compared chunk by chunk with
    the first of their run; a difference opens a new class. A group of any
    size is dealt over runs of about RUN_ROWS rows, and runs meet again by the
    digest of the text they compared equal to.

    The smallest id of a class stays; a null id stays only if the class has no
    other. Rows that repeat both id and text are one document more each, and
    exactly one of them is kept. Very long texts are hashed and compared whole,
    chunk by chunk. Extra columns are not read, whatever their names. An empty
    table gives no rows.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    keys = "id {}, fp long, n_bytes long, sha string".format(id_type)
    prints = written(src.mapInArrow(_prints("text", False), keys), "prints")
    shared = prints.groupBy("fp", "n_bytes").agg(F.count("*").alias("n")).where("n > 1")
    runs = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / RUN_ROWS).cast("long"))
    again = src.mapInArrow(_prints("text", True), keys + ", body binary")
    dealt = again.join(shared, ["fp", "n_bytes"]).withColumn("salt", runs).drop("n")
    by = ("fp", "n_bytes", "salt")
    compared = dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(_compare, keys)
    alone = prints.join(shared, ["fp", "n_bytes"], "left_anti").select("id", "fp", "n_bytes", "sha")
    each = compared.unionByName(alone).groupBy("fp", "n_bytes", "sha", "id").agg(F.count("*").alias("times"))
    each = written(each, "classes")
    classes = each.groupBy("fp", "n_bytes", "sha").agg(
        F.min("id").alias("keep_id"), F.sum("times").alias("group_size")
    )
    # one row a document again; of rows that repeat id and text the first copy stands for all
    return (
        each.join(classes, ["fp", "n_bytes", "sha"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(
            F.col("id").alias(id_col),
            "keep_id",
            F.col("group_size").cast("long").alias("group_size"),
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    A row goes when another row with an equal text has a smaller id. Rows that
    repeat id and text become one row (of differing other columns, an
    arbitrary row stays).
    """
    first = F.col(id_col).eqNullSafe(F.col("keep_id"))
    with scope(docs.sparkSession):
        groups = exact_groups(docs.select(id_col, text_col), id_col, text_col).where(~F.col("kept"))
        groups = kept(groups.select(F.col(id_col).alias("id"), F.col("text_sha256").alias("sha"), first.alias("first")), "going")
    sha, gone = fresh(docs, "sha"), fresh(docs, "gone")
    body = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WS, " ")
    going = groups.where("not first").select(F.col("id").alias(gone), F.col("sha").alias(f"{gone}_sha")).distinct()
    same = F.col(id_col).eqNullSafe(F.col(gone)) & (F.col(sha) == F.col(f"{gone}_sha"))
    left = docs.withColumn(sha, F.sha2(body, 256)).join(going, same, "left_anti")
    if not groups.where("first").isEmpty():  # the same id and text more than once
        left = left.dropDuplicates([id_col, sha])
    return left.drop(sha)
