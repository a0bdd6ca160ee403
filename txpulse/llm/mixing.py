"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txpulse.llm.common import fresh, kept, scope, written

#: Times that a document may be repeated.
EPOCHS = 3
#: Weights in the order of the sources, repeating.
WEIGHTS = (5, 2, 1)
#: Bins of virtual time up to the point where every source has its target, and the last bin.
BINS, LAST_BIN = 8192, 4 * 8192
#: Hex digits of the shuffle key that name a document's bucket: 4096 buckets a source.
BUCKET_DIGITS = 3


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source_key, rank, source_size, target): one row per source.

    Sources by code point, the null source last, take ``weights`` in turn and
    share the total of all sizes. No target is above ``epochs`` times its
    source's size; the excess goes to the others by weight. Sorted by size
    over weight the sources that stop at their limit come first, so one
    running sum finds the level at which the rest share what is left.
    """
    per = sized.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*[F.lit(w).cast("long") for w in weights])
    per = per.withColumn("rank", rank).withColumn("weight", F.get(turn, (F.col("rank") % len(weights)).cast("int")))
    most = (F.lit(epochs) * F.col("source_size")).cast("long")
    order = Window.orderBy(most.cast("double") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    per = per.select(
        "source_key", "rank", "source_size", "weight", most.alias("most"),
        (F.sum("source_size").over(every) - F.coalesce(F.sum(most).over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("heft"),
        F.row_number().over(order).alias("nth"),
    )
    full = F.col("left") * F.col("weight") > F.col("most") * F.col("heft")
    per = per.withColumn("full", full)
    level = lambda c: F.min_by(F.when(~F.col("full"), F.col(c)), F.when(~F.col("full"), F.col("nth"))).over(every)
    share = level("left").cast("double") * F.col("weight") / level("heft")
    return per.select(
        "source_key", "rank", "source_size",
        F.when(F.col("full"), F.col("most").cast("double")).otherwise(share).alias("target"),
    )


def mix_plan(
    docs: DataFrame,
    size,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """(id, source_size, size, target, taken, virtual_finish), one row per document.

    Each source's documents are shuffled by a seeded hash of the id. The e-th
    repeat of a document finishes at (e * source size + running size) / target
    of its source. All repeats of all sources are sorted by that virtual time
    and cut where the total of all sizes is reached, so every source comes to
    its target together. Running totals are two-level (bucket sums, then rows
    within a bucket), so a source with most of the rows is 4096 tasks' work.

    ``size`` is a column of longs. Null ids share one shuffle key; rows that
    repeat id and size are taken or left together; a source whose target is 0
    gives nothing (null virtual_finish). Texts are not read but by ``size``; other
    columns are not read, whatever their names. An empty table gives no rows.
    """
    plan = _plan(docs, size, id_col, source_col, weights, epochs, seed).withColumnRenamed("id", id_col)
    columns = (id_col, "size", "source_size", "target", "taken", "virtual_finish")
    return plan.select(*columns).orderBy("virtual_finish", id_col)


def _plan(docs: DataFrame, size, id_col: str, source_col: str, weights: tuple[int, ...], epochs: int, seed: str) -> DataFrame:
    """(id, source, size, source_size, target, taken, virtual_finish) of every document."""
    source = F.col(source_col)
    sized = docs.select(
        F.col(id_col).alias("id"),
        source.alias("source"),
        F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string"))).alias("source_key"),
        size.alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("key"),
    ).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sized = written(sized, "sized")
    targets = written(source_targets(sized, weights, epochs), "targets")
    budget = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    per_bucket = sized.groupBy("source_key", "bucket").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "source_key", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset")
    ).join(targets, "source_key")
    within = Window.partitionBy("source_key", "bucket").orderBy("key", "id", "size")
    rows = sized.withColumn("sum", F.sum("size").over(within)).join(offsets, ["source_key", "bucket"])
    finish = lambda e: F.when(F.col("target") > 0, (F.lit(e) * F.col("source_size") + F.col("offset") + F.col("sum")).cast("double") / F.col("target"))
    rows = written(
        rows.select(
            "id", "rank", "key", "size", "source", "source_size", "target",
            F.array(*[finish(e) for e in range(epochs)]).alias("finish"),
        ),
        "finish",
    )
    bin_of = lambda f: F.least(F.floor(f * BINS), F.lit(LAST_BIN))
    entries = rows.where("target > 0 and size > 0").select(
        "rank", "key", "id", "size", F.explode("finish").alias("at")
    )
    per_bin = entries.groupBy(bin_of(F.col("at")).alias("bin")).agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.orderBy("bin"))
    edge = per_bin.select("bin", upto.alias("upto"), "n").where(F.col("upto") > budget).orderBy("bin").first()
    if edge is None:  # the budget takes everything
        stays = lambda f: f.isNotNull()
    else:
        # only the bin in which the budget ends is sorted row by row
        order = ("at", "rank", "key", "id", "size")
        inside = entries.where(bin_of(F.col("at")) == edge["bin"])
        total = F.sum("size").over(Window.orderBy(*order)) + F.lit(edge["upto"] - edge["n"])
        last = inside.withColumn("total", total).where(F.col("total") <= budget)
        last = last.orderBy(*[F.col(c).desc() for c in order]).first()
        if last is None:
            stays = lambda f: bin_of(f) < edge["bin"]
        else:
            cut = F.struct(*[F.lit(last[c]).cast(entries.schema[c].dataType) for c in order])
            stays = lambda f: F.struct(f, "rank", "key", "id", "size") <= cut
    repeats = F.aggregate(
        F.filter("finish", lambda f: F.coalesce(stays(f), F.lit(False))), F.lit(0), lambda n, _: n + 1
    )
    rows = rows.withColumn("taken", F.col("size") * repeats).withColumn("virtual_finish", F.get("finish", F.lit(0)))
    return rows.select("id", "source", "size", "source_size", "target", "taken", "virtual_finish")


def mixed_documents(
    docs: DataFrame,
    size,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """The documents of the mix with all their columns, sorted by virtual finish time.

    Adds size, target, taken (size times repeats) and virtual_finish, named
    anew where taken; documents of which the mix takes nothing go. A row is
    known by id, source and size, so one id may stand in several sources.
    """
    names = {n: fresh(docs, n) for n in ("size", "target", "taken", "virtual_finish")}
    keys = {n: fresh(docs, f"mix_{n}") for n in ("id", "source", "size")}
    sized = docs.withColumn(names["size"], size)
    with scope(docs.sparkSession):
        plan = _plan(sized, F.col(names["size"]), id_col, source_col, weights, epochs, seed).where("taken > 0")
        plan = kept(plan.select("id", "source", "size", "target", "taken", "virtual_finish").distinct(), "plan")
    plan = plan.select(
        *[F.col(c).alias(k) for c, k in keys.items()],
        *[F.col(n).alias(names[n]) for n in ("target", "taken", "virtual_finish")],
    )
    own = (id_col, source_col, names["size"])
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(own, keys.values(), strict=True)]
    mixed = sized.join(plan, same).drop(*keys.values())
    return mixed.orderBy(names["virtual_finish"], id_col)
