"""Merkle manifest of a dataset, as logs of nodes in postorder.

Nodes of a tree are written in completion order: a node follows its last
child at once. An aligned builder takes ``BLOCK`` consecutive nodes of one
height and writes the log of the subtree above them; the blocks' last nodes are
the next round's nodes, until one is left. A node's place in its log follows
from subtree sizes alone, so a proof reads its siblings by position.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txpulse.llm.common import written

#: Children of a node, and levels and bottom nodes of one builder's subtree.
ARITY = 3
LEVELS = 7
BLOCK = ARITY**LEVELS

STEP = "struct<left:string,right:string>"


def node(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    k = 0
    while n > 1:
        n, k = -(-n // ARITY), k + 1
    return k


def append_log(nodes: list[str], levels: int) -> list[str]:
    """The nodes and all that stand above them, each written as soon as it is complete."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(levels + 1)]

    def put(digest: str, k: int) -> None:
        while True:
            log.append(digest)
            waiting[k].append(digest)
            if k == levels or len(waiting[k]) < ARITY:
                return
            digest, waiting[k], k = node(waiting[k]), [], k + 1

    for digest in nodes:
        put(digest, 0)
    for k in range(levels):  # the last run of a level may be short
        if waiting[k]:
            digest, waiting[k] = node(waiting[k]), []
            put(digest, k + 1)
    return log


def _complete(m: int, levels: int) -> int:
    """Nodes written once ``m`` bottom nodes and all that they complete are."""
    return sum(m // ARITY**k for k in range(levels + 1))


def position(k: int, i: int, m: int, levels: int) -> int:
    """Place of node ``i`` of level ``k`` in the log of ``m`` bottom nodes.

    A node over a whole subtree is written k places after its last bottom node;
    a short one after everything that is complete, in order of levels.
    """
    end = (i + 1) * ARITY**k
    if end <= m:
        return _complete(end - 1, levels) + k
    whole = next(j for j in range(levels + 1) if m % ARITY ** (j + 1))  # levels whose last node is whole
    return _complete(m, levels) + k - whole - 1


def paths(log: list[str], m: int, levels: int) -> list[list[tuple[str, str]]]:
    """For each bottom node: the siblings left and right of it and of each node above it, joined."""
    above: list[list[tuple[str, str]]] = [[]]
    for k in range(levels - 1, -1, -1):
        row = [log[position(k, i, m, levels)] for i in range(-(-m // ARITY**k))]
        near = [(i - i % ARITY, i) for i in range(len(row))]
        above = [[("".join(row[a:i]), "".join(row[i + 1 : a + ARITY])), *above[i // ARITY]] for a, i in near]
    return above


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]).cast("binary"), 256))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings, level by level, from left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def leaf_digest(columns: list[Column]) -> Column:
    """Digest of the values, each as byte count, colon and value (null: a dash)."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``i``, the place within ``tree`` by ``order``, and ``n``, the tree's rows.

    A range shuffle sorts all rows; each partition numbers its own, and sums of
    the partitions' counts shift them. Equal rows are told apart by a random
    number, so no tree and no row's copies need one task.
    """
    by = ["tree", *order, "salt"]
    cut = rows.withColumn("salt", F.rand(11)).repartitionByRange(*by).sortWithinPartitions(*by).drop("salt")
    placed = cut.withColumns({"part": F.spark_partition_id(), "nth": F.monotonically_increasing_id()})
    placed = written(placed, "placed")
    counts = placed.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("nth").alias("from"))
    trees = Window.partitionBy("tree")
    counts = counts.select(
        "tree", "part", "from", F.sum("rows").over(trees).alias("n"),
        (F.sum("rows").over(trees.orderBy("part")) - F.col("rows")).alias("before"),
    )
    same = F.col("p.tree").eqNullSafe(F.col("c.tree")) & (F.col("p.part") == F.col("c.part"))
    at = (F.col("before") + F.col("nth") - F.col("from")).alias("i")
    return placed.alias("p").join(counts.alias("c"), same).select("p.*", at, "n").drop("part", "nth")


def _levels(n: int) -> int:
    """Levels of each builder of a round over ``n`` nodes: all, or up to the root if one builder takes them."""
    return LEVELS if n > BLOCK else height(n)


def _build(batches):
    """Rows (tree, n, i, digest) sorted by tree and i, blocks whole: a log for each block."""
    key, held, n = None, [], 0

    def log():
        return {"tree": [key[0]], "n": [n], "block": [key[1]], "log": [append_log(held, _levels(n))]}

    for batch in batches:
        rows = batch.to_pydict()
        for tree, i, digest, size in zip(rows["tree"], rows["i"], rows["digest"], rows["n"], strict=True):
            if key != (tree, i // BLOCK):
                if held:
                    yield pa.RecordBatch.from_pydict(log(), LOG)
                key, held, n = (tree, i // BLOCK), [], size
            held.append(digest)
    if held:
        yield pa.RecordBatch.from_pydict(log(), LOG)


LOG = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("block", pa.int64()), ("log", pa.list_(pa.string()))])


def _rounds(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The logs of each round, lowest first, and the roots (tree, digest) of ``nodes`` (tree, i, n, digest)."""
    logs = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        cut = nodes.select("tree", "i", "n", "digest").withColumn("block", F.floor(F.col("i") / BLOCK))
        cut = cut.repartition("tree", "block").sortWithinPartitions("tree", "i")
        shape = "tree string, n long, block long, log array<string>"
        logs.append(written(cut.drop("block").mapInArrow(_build, shape), f"log-{len(logs)}"))
        nodes = logs[-1].select(
            "tree", F.col("block").alias("i"), F.ceil(F.col("n") / BLOCK).alias("n"), F.element_at("log", -1).alias("digest")
        )
        most = -(-most // BLOCK)
        if most <= 1:
            return logs, nodes.select("tree", "digest")


def _prove(keep: list[str], tags: list[str]):
    def run(key, rows: pa.Table, logs: pa.Table) -> pa.Table:
        """Paths of one block's nodes: siblings within its log, then the block's own path."""
        block = logs.slice(0, 1).to_pylist()[0]
        levels, first = _levels(block["n"]), block["block"] * BLOCK
        within = paths(block["log"], min(BLOCK, block["n"] - first), levels)
        steps = [[{"left": a, "right": b} for a, b in within[i - first]] + block["above"] for i in rows.column("i").to_pylist()]
        out = rows.select(keep)
        for t in tags:
            out = out.append_column(t, pa.array([block[t]] * len(steps), pa.string()))
        return out.append_column("path", pa.array(steps, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))))

    return run


def _paths(nodes: DataFrame, logs: list[DataFrame], roots: DataFrame, keep: list[str], tags: list[str]) -> DataFrame:
    """``keep`` columns, path and ``tags`` of every node; ``roots``: tree, path and tags of each tree's root."""
    top = roots.withColumn("block", F.lit(0).cast("long"))
    for k in range(len(logs) - 1, -1, -1):  # a block's nodes go on from the block's own path
        top = top.select("tree", "block", F.col("path").alias("above"), *tags)
        same = F.col("l.tree").eqNullSafe(F.col("t.tree")) & (F.col("l.block") == F.col("t.block"))
        known = logs[k].alias("l").join(top.alias("t"), same).select("l.*", "above", *tags)
        below, names = (logs[k - 1].select("tree", F.col("block").alias("i")), ["tree", "i"]) if k else (nodes, keep)
        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in below.select(*names).schema] + [f"{t} string" for t in tags]
        below = below.withColumn("block", F.floor(F.col("i") / BLOCK))
        pairs = below.groupBy("tree", "block").cogroup(known.groupBy("tree", "block"))
        top = pairs.applyInArrow(_prove(names, tags), f"{', '.join(kinds)}, path array<{STEP}>")
        if k:
            top = written(top, f"paths-{k}").withColumnRenamed("i", "block")
    return top


@dataclass
class Manifest:
    """``logs`` of the documents' rounds (tree = source), ``top_logs`` of the sources' tree, and ``proofs``."""

    logs: list[DataFrame]
    top_logs: list[DataFrame]
    proofs: DataFrame


def manifest(
    docs: DataFrame, fields: list[str], id_col: str = "doc_id", source_col: str = "source", carry: dict[str, Column] | None = None
) -> Manifest:
    """The dataset's Merkle trees; ``proofs`` has one row per document: id, ``carry`` columns, leaf, subroot, root, path.

    A document's leaf is the digest of its ``fields``. The leaves of a source
    ascend by id (a null id first, equal ids by leaf), every three nodes in a
    row have one above them, and the sources' roots, by source (null first),
    form a tree of their own up to ``root``. ``path`` has a step for each level
    from the leaf to the root: the siblings on the left and on the right.

    Texts are read once and never shuffled: what is sorted, joined and grouped
    is a few hundred bytes a document. A builder holds BLOCK nodes and their
    log, whatever the size of a source. A null text is told from an empty one;
    very long texts are hashed whole in the scan. Repeated rows are leaves of
    their own, next to each other. Other columns are not read; an empty table
    gives no logs' rows and no proofs.
    """
    carry = carry or {}
    held = {f"carry{i}": c for i, c in enumerate(carry.values())}
    leaves = docs.select(
        F.col(source_col).cast("string").alias("tree"), F.col(id_col).alias("id"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"), *[c.alias(k) for k, c in held.items()],
    )
    leaves = written(_numbered(written(leaves, "leaves"), ["id", "digest"]), "numbered")
    logs, subroots = _rounds(leaves)
    sources = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    sources = written(_numbered(sources, ["source"]), "sources")
    top_logs, top = _rounds(sources)
    end = top.select("tree", F.array().cast(f"array<{STEP}>").alias("path"), F.col("digest").alias("root"))
    tops = _paths(sources, top_logs, end, ["source", "digest"], ["root"])
    tops = written(tops.withColumnsRenamed({"source": "tree", "digest": "subroot"}), "tops")
    proofs = _paths(leaves, logs, tops, ["id", "digest", *held], ["subroot", "root"])
    proofs = proofs.select(
        F.col("id").alias(id_col), *[F.col(h).alias(c) for h, c in zip(held, carry, strict=True)],
        F.col("digest").alias("leaf"), "subroot", "root", "path",
    )
    return Manifest(logs, top_logs, proofs)
