"""Word n-gram Jaccard join: T-occurrence search with DivideSkip, and its components."""

from __future__ import annotations

import zlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txpulse.llm.common import fresh, kept, scope, slices, written
from txpulse.llm.graph import components
from txpulse.llm.tokens import mix, shingle_sets, weighed_shingles, words

#: Counters of the sketch of shingles, and of that of words, in blocks that are summed each by itself.
SLOT_BITS, BLOCKS = 20, 32
SLOTS = 1 << SLOT_BITS
#: Bits of the filter on texts whose sets are needed.
FILTER_BITS = 1 << 23
#: 64-bit words of a set's parity sketch at least; a larger set has at least one bit a member.
PARITY = 8
#: Rounds in which the class with most links is the query of a list, before all pairs left are.
HUB_ROUNDS = 2
#: Sets searched at once for one query set.
BLOCK_SETS = 512
#: Classes a task remembers, so as to send copies of one text once.
SEEN = 200_000


def needed(n_a: int, n_b: int, num: int, den: int) -> int:
    """Least overlap of sets of these sizes at Jaccard num/den."""
    return -(-num * (n_a + n_b) // (num + den))


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


class Rarity:
    """An order of all shingles from rare to frequent, the same in every task.

    Shingles that stand out of their sketch's noise come last, by count; the
    others in the order of their words' counts multiplied, as if words were
    independent. Any order gives whole results; this one gives short lists.
    """

    def __init__(self, counts: np.ndarray):
        shingles, word_counts = counts.reshape(2, SLOTS)
        mean = shingles.mean()
        self.excess = np.maximum(0, shingles - int(mean + 6 * np.sqrt(mean) + 3))
        self.weight = np.rint(1000 * np.log2(1 + word_counts)).astype(np.int64)

    def rarest(self, s: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
        return s[np.lexsort((s, weights, self.excess[slots(s)]))[:n]]


def class_id(s: np.ndarray) -> bytes:
    """128-bit name of a set: sums of two mixes of its members, and its size."""
    a = np.add.reduce(mix(s + np.uint64(1)), dtype=np.uint64)
    b = np.add.reduce(mix(mix(s ^ np.uint64(0x5851F42D4C957F2D)) + np.uint64(len(s))), dtype=np.uint64)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


def parity_sketch(s: np.ndarray) -> list[int]:
    """Bit i: whether an odd number of members hash to i. Sketches differ in no more bits than sets in members.

    The number of words is a power of two, so a longer sketch folds to a
    shorter one by taking its halves' exclusive or.
    """
    n_words = PARITY
    while 64 * n_words < len(s):
        n_words *= 2
    odd = np.bincount((mix(s) >> np.uint64(24)).astype(np.int64) % (64 * n_words), minlength=64 * n_words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _classes(k: int):
    """Each row's class; at its end a task adds its counts of all shingles."""

    def run(batches):
        counts, none = np.zeros((2, SLOTS), np.int32), None
        for batch in batches:
            for part, texts in slices(batch, "text"):
                hashes, _, _, first = words(texts)
                sets = shingle_sets(hashes, first, k)
                m = len(sets)
                for i, every in enumerate((np.concatenate(sets) if m else hashes, hashes)):
                    counts[i] += np.bincount(slots(every), minlength=SLOTS).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {"id": part.column("id"), "name": part.column("name"), "n": pa.array([len(s) for s in sets], pa.int64()),
                     "cid": pa.array([class_id(s) for s in sets], pa.binary()),
                     "sketch": pa.array([parity_sketch(s) for s in sets], pa.list_(pa.int64())),
                     "block": pa.nulls(m, pa.int32()), "counts": pa.nulls(m, pa.binary())}
                )
                none = part.column("id").type
        if none is not None:
            yield pa.RecordBatch.from_pydict(
                {"id": pa.nulls(2 * BLOCKS, none), "name": pa.nulls(2 * BLOCKS, pa.int64()),
                 "n": pa.nulls(2 * BLOCKS, pa.int64()), "cid": pa.nulls(2 * BLOCKS, pa.binary()),
                 "sketch": pa.nulls(2 * BLOCKS, pa.list_(pa.int64())), "block": pa.array(range(2 * BLOCKS), pa.int32()),
                 "counts": pa.array([zlib.compress(c.tobytes(), 1) for c in np.split(counts.reshape(-1), 2 * BLOCKS)], pa.binary())}
            )

    return run


def _sum_block(batches):
    """Sums the counts of each block; rows come sorted by block."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[block] = held.get(block, 0) + np.frombuffer(zlib.decompress(counts), np.int32).astype(np.int64)
    yield pa.RecordBatch.from_pydict(
        {"block": pa.array(list(held), pa.int32()), "counts": pa.array([c.tobytes() for c in held.values()], pa.binary())}
    )


class _Once:
    """Whether a task has seen a class before, among the last SEEN ones."""

    def __init__(self):
        self.held: OrderedDict[bytes, None] = OrderedDict()

    def __call__(self, cid: bytes) -> bool:
        if cid in self.held:
            self.held.move_to_end(cid)
            return False
        self.held[cid] = None
        if len(self.held) > SEEN:
            self.held.popitem(last=False)
        return True


def _prefixes(k: int, num: int, den: int, sketch):
    """Each class's rarest shingles, so many that two sets which link share one of them."""

    def run(batches):
        rarity, once = sketch.value, _Once()
        for batch in batches:
            for _, texts in slices(batch, "text"):
                keys, cids, sizes = [], [], []
                hashes, _, _, first = words(texts)
                for s, weights in weighed_shingles(hashes, first, k, rarity.weight[slots(hashes)]):
                    if not len(s) or not once(cid := class_id(s)):
                        continue
                    p = len(s) - -(-num * len(s) // den) + 1
                    keys.append(rarity.rarest(s, weights, p))
                    cids.extend([cid] * p)
                    sizes.extend([len(s)] * p)
                if keys:
                    yield pa.RecordBatch.from_pydict(
                        {"key": pa.array(np.concatenate(keys).astype(np.int64)), "cid": pa.array(cids, pa.binary()),
                         "n": pa.array(sizes, pa.int64())}
                    )

    return run


def _sets(k: int, bitmap):
    """Sets of the texts that the filter lets through; the others are not cut into shingles."""

    def run(batches):
        bits, once = bitmap.value, _Once()
        for batch in batches:
            at = batch.column("name").to_numpy().astype(np.int64) % FILTER_BITS
            through = bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
            for _, texts in slices(batch.filter(pa.array(through.astype(bool))), "text"):
                out = []
                hashes, _, _, first = words(texts)
                for s in shingle_sets(hashes, first, k):
                    if len(s) and once(cid := class_id(s)):
                        out.append((cid, s.tobytes()))
                if out:
                    cid, body = zip(*out, strict=True)
                    yield pa.RecordBatch.from_pydict({"cid": pa.array(cid, pa.binary()), "body": pa.array(body, pa.binary())})

    return run


def divide_skip(query: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[int]:
    """Which of ``sets`` reach the overlap that Jaccard num/den with ``query`` needs.

    The sets' inverted lists over the query's members are divided: the longest
    ones (fewer than the least overlap needed) are only probed by binary search
    for sets that the merge of the short ones leaves possible.
    """
    need = np.array([needed(len(query), len(s), num, den) for s in sets])
    member, owner = [], []
    for i, s in enumerate(sets):
        at = np.minimum(np.searchsorted(query, s), len(query) - 1)
        at = at[query[at] == s]
        member.append(at)
        owner.append(np.full(len(at), i))
    member, owner = np.concatenate(member), np.concatenate(owner)
    order = np.lexsort((owner, member))
    member, owner = member[order], owner[order]
    size = np.bincount(member, minlength=len(query))
    n_long = min(int(need.min()) - 1, int((size > max(8, len(sets) // 2)).sum()))
    is_long = np.zeros(len(query), bool)
    if n_long > 0:
        is_long[np.argsort(-size, kind="stable")[:n_long]] = True
    count = np.bincount(owner[~is_long[member]], minlength=len(sets))
    possible = np.flatnonzero(count + n_long >= need)
    end = np.cumsum(size)
    for q in np.flatnonzero(is_long):
        posting = owner[end[q] - size[q] : end[q]]
        at = np.minimum(np.searchsorted(posting, possible), len(posting) - 1)
        count[possible] += posting[at] == possible
    return possible[count[possible] >= need[possible]].tolist()


def _verify(num: int, den: int):
    """Rows sorted by (u, salt, role): the query's set, then its candidates'."""

    def links(u, query, cids, sets):
        if query is None or not sets:
            return
        hit = divide_skip(query, sets, num, den)
        if hit:
            yield pa.RecordBatch.from_pydict(
                {"u": pa.array([u] * len(hit), pa.binary()), "v": pa.array([cids[i] for i in hit], pa.binary())}
            )

    def run(batches):
        key, query, cids, sets = None, None, [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("u", "salt", "role", "cid", "body")]
            for u, salt, role, cid, body in zip(*cols, strict=True):
                if (u, salt) != key:
                    if key is not None:
                        yield from links(key[0], query, cids, sets)
                    key, query, cids, sets = (u, salt), None, [], []
                if role == 0:
                    query = np.frombuffer(body, np.uint64)
                    continue
                cids.append(cid)
                sets.append(np.frombuffer(body, np.uint64))
                if len(sets) >= BLOCK_SETS:
                    yield from links(u, query, cids, sets)
                    cids, sets = [], []
        if key is not None:
            yield from links(key[0], query, cids, sets)

    return run


def _alike(num: int, den: int):
    """Whether sizes and parity sketches of u and v allow a link."""
    total = F.col("n_u") + F.col("n_v")
    need = F.ceil(F.lit(num) * total / F.lit(num + den))
    n_words = F.least(F.size("sketch_u"), F.size("sketch_v"))

    def folded(side: str):
        # sizes that allow a link are less than a factor of two apart, or the fold is not needed
        x, half = F.col(f"sketch_{side}"), F.size(f"sketch_{side}") / 2
        fold = F.zip_with(F.slice(x, 1, half.cast("int")), F.slice(x, (half + 1).cast("int"), half.cast("int")), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(x) == 2 * n_words, fold).otherwise(x)

    bits = F.zip_with(folded("u"), folded("v"), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    differ = F.aggregate(bits, F.lit(0), lambda total_bits, b: total_bits + b)
    comparable = F.greatest(F.size("sketch_u"), F.size("sketch_v")) <= 2 * n_words
    return ~comparable | (differ <= total - 2 * need)


def _text_filter(names: DataFrame) -> np.ndarray:
    """Bits of the texts in ``names``: of fixed size, and full, that is without effect, at worst."""
    at = F.pmod("name", F.lit(FILTER_BITS))
    words = names.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
    ).toPandas()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint64)
    return bits


def _links(src: DataFrame, pairs: DataFrame, names: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Those of the distinct candidate pairs (u, v) that link, by their whole sets.

    ``names`` (cid, name) has the hash of one text of each class, so only texts of that hash are read for the sets.
    """
    cids = pairs.select(F.col("u").alias("cid")).union(pairs.select("v")).distinct()
    bitmap = src.sparkSession.sparkContext.broadcast(_text_filter(names.join(cids, "cid")))
    sets = src.select("text", "name").mapInArrow(_sets(k, bitmap), "cid binary, body binary").join(cids, "cid", "left_semi")
    sets = written(sets.dropDuplicates(["cid"]), "sets")
    count = pairs.groupBy("u").agg(F.ceil(F.count("*") / (BLOCK_SETS // 2)).cast("long").alias("salts"))
    pairs = pairs.join(count, "u").withColumn("salt", F.pmod(F.xxhash64("v"), "salts"))
    candidates = pairs.select("u", "salt", F.lit(1).alias("role"), F.col("v").alias("cid")).join(sets, "cid")
    queries = pairs.select("u", "salt").distinct().select("u", "salt", F.lit(0).alias("role"), F.col("u").alias("cid"))
    rows = candidates.unionByName(queries.join(sets, "cid"))
    rows = rows.repartition("u", "salt").sortWithinPartitions("u", "salt", "role")
    return rows.select("u", "salt", "role", "cid", "body").mapInArrow(_verify(num, den), "u binary, v binary")


def jaccard_components(
    docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id), one row per document.

    A document's set holds its distinct k-word shingles (64-bit hashes; words
    are runs of other characters than ASCII white space, A-Z lower-cased; a
    shorter text is one shingle). Documents link at Jaccard >= num/den;
    component_id is the least id that links reach.

    1. Equal sets are one class, so copies cost nothing further on.
    2. Count sketches of all shingles and words put shingles in order from
       rare to frequent. Two sets that link share one of their rarest ones: the
       inverted lists of those hold all candidates.
    3. The first class of each list is a query against the others. Sizes and
       parity sketches, then the T-occurrence search over the whole sets, leave
       the links, and these the components.
    4. In lists that more than one component is in, the class with most links
       so far is the next query. Then lists with the same such class are taken
       together, so that they make each pair once, and their pairs of
       different components that sizes and sketches leave are candidates. So
       every pair that can link and is not joined already is decided, and no
       pair within a component is made.

    Null and empty texts, and texts without words, have no shingles and are
    alone. A null id counts only if its component has no other. Rows that
    repeat id and text are one class, and each stays a row. Very long texts are
    read whole, one at a time. Other columns are not read, whatever their names.
    An empty table gives no rows.
    """
    out = _components(docs, k, num, den, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _components(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, cid, component_id), as ``jaccard_components`` and with the class of the document's set."""
    with scope(docs.sparkSession):
        return kept(_found(docs, k, num, den, id_col, text_col), "components")


def _found(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("name"))
    id_type = src.schema["id"].dataType.simpleString()
    with scope(spark):  # sketches of all rows and counts of all tasks go when their sums are there
        rows = written(src.mapInArrow(_classes(k), f"id {id_type}, name long, n long, cid binary, sketch array<long>, block int, counts binary"), "rows")
        classes = kept(rows.where("block is null").select("id", "n", "cid"), "classes")
        marks = rows.where("block is null and n > 0").select("cid", "n", "sketch", "name").dropDuplicates(["cid"])
        marks = kept(marks, "marks")

        blocks = rows.where("block is not null").select("block", "counts")
        blocks = blocks.repartition("block").mapInArrow(_sum_block, "block int, counts binary").collect()
    counts = np.zeros((2 * BLOCKS, SLOTS // BLOCKS), np.int64)
    for r in blocks:
        counts[r["block"]] += np.frombuffer(r["counts"], np.int64)
    sketch = spark.sparkContext.broadcast(Rarity(counts))

    keys = src.select("text").mapInArrow(_prefixes(k, num, den, sketch), "key long, cid binary, n long")
    by_key = Window.partitionBy("key").orderBy("cid")
    keys = keys.select(
        "key", "cid", "n",
        F.first("cid").over(by_key).alias("u"), F.first("n").over(by_key).alias("n_u"),
        F.lag("cid").over(by_key).alias("last"),
    )
    with scope(spark):
        shared = kept(keys.where("u != cid and last != cid").select("key", "cid", "n", "u", "n_u"), "lists")
    near = lambda a, b: F.lit(den) * F.least(a, b) >= F.lit(num) * F.greatest(a, b)
    pairs = shared.where(near("n", "n_u")).select("u", F.col("cid").alias("v")).distinct()

    def marked(pairs: DataFrame, side: str) -> DataFrame:
        return pairs.join(marks.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)

    def links(pairs: DataFrame, name: str) -> DataFrame | None:
        """The pairs that link; None if sizes and sketches leave none."""
        with scope(spark):
            with scope(spark):  # the lists' shuffles go before the sets'
                possible = kept(marked(marked(pairs, "u"), "v").where(_alike(num, den)).select("u", "v"), f"{name}-pairs")
            return None if possible.isEmpty() else kept(_links(src, possible, marks.select("cid", "name"), k, num, den), f"{name}-links")

    def mixed(lists: DataFrame, roots: DataFrame) -> DataFrame:
        """(key, cid, n, root, main): those of ``lists``, without their first class, that more than one component is in."""
        with scope(spark):
            named = lists.select("key", "cid", "n").join(roots.withColumnRenamed("u", "cid"), "cid", "left")
            named = written(named.select("key", "cid", "n", F.coalesce("root", "cid").alias("root")), "named")
            per = named.groupBy("key", "root").agg(F.count("*").alias("m")).groupBy("key").agg(
                F.count("*").alias("roots"), F.max_by("root", "m").alias("main")
            )
            return kept(named.join(per.where("roots > 1").select("key", "main"), "key"), "mixed")

    def with_hub() -> DataFrame:
        """The lists, each with the class that has most links so far: hub, n_hub, root_hub, links."""
        degree = found.select("u").union(found.select("v")).groupBy(F.col("u").alias("cid")).agg(F.count("*").alias("links"))
        ranked = lists.join(degree, "cid", "left").withColumn("links", F.coalesce("links", F.lit(0)))
        hub = ranked.groupBy("key").agg(
            F.max_by(F.struct("cid", "n", "root"), F.struct("links", "cid")).alias("h"), F.max("links").alias("links")
        )
        hub = hub.select("key", "links", F.col("h.cid").alias("hub"), F.col("h.n").alias("n_hub"), F.col("h.root").alias("root_hub"))
        return lists.join(hub, "key")

    nothing = spark.createDataFrame([], "u binary, v binary")
    found = links(pairs, "first")
    found = nothing if found is None else found
    roots = components(found)
    lists = mixed(shared, roots)
    for i in range(HUB_ROUNDS):
        pairs = with_hub().where("links > 0").where(F.col("root") != F.col("root_hub")).where(near("n", "n_hub"))
        more = links(pairs.select(F.col("hub").alias("u"), F.col("cid").alias("v")).distinct(), f"hub-{i}")
        if more is None:
            break
        found = written(found.union(more), "found")
        roots = components(found)
        lists = mixed(lists, roots)  # components only grow: a list of one stays so

    # lists of one hub hold mostly the same classes: together they make each pair once
    members = with_hub().select("hub", "cid", "n", "root").distinct()
    main = members.groupBy("hub", "root").agg(F.count("*").alias("m")).groupBy("hub").agg(F.max_by("root", "m").alias("main"))
    members = written(members.join(main, "hub").join(marks.select("cid", "sketch"), "cid"), "members")
    side = lambda s: members.select("hub", *[F.col(c).alias(f"{c}_{s}") for c in ("cid", "n", "root", "main", "sketch")])
    cross = side("u").where("root_u != main_u").join(side("v"), "hub").where(
        near("n_u", "n_v") & (F.col("root_u") != F.col("root_v"))
        & ((F.col("root_v") == F.col("main_v")) | (F.col("cid_u") < F.col("cid_v"))) & _alike(num, den)
    )
    more = links(cross.select(F.col("cid_u").alias("u"), F.col("cid_v").alias("v")).distinct(), "cross")
    if more is not None:
        roots = components(found.union(more))

    rooted = classes.where("n > 0").join(roots.withColumnRenamed("u", "cid"), "cid", "left")
    rooted = rooted.select("id", "n", "cid", F.coalesce("root", "cid").alias("root"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    out = rooted.join(least, "root").select("id", "n", "cid", "component_id")
    return out.unionByName(classes.where("n = 0").select("id", "n", "cid", F.col("id").alias("component_id")))


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: those with the least id of their component.

    Null ids stay. Rows that share this least id all stay. Of rows that share
    an id but not the set, each stays or goes by its own component.
    """
    found = _components(docs, k, num, den, id_col, text_col).where("id is not null")
    found = found.select("id", "cid", (F.col("id") != F.col("component_id")).alias("goes"))
    going = found.groupBy("id").agg(F.max("goes").alias("any"), F.min("goes").alias("all")).where("any")
    going = written(going.select("id", "all"), "going")
    gone, cid = fresh(docs, "gone"), fresh(docs, "cid")
    by_id = F.col(id_col) == F.col(gone)
    left = docs.join(going.select(F.col("id").alias(gone)), by_id, "left_anti")
    mixed = going.where("not all").select("id")
    if mixed.isEmpty():
        return left

    @F.pandas_udf("binary")
    def class_of(texts):
        import pandas as pd

        hashes, _, _, first = words(pa.array(texts.fillna(""), pa.large_string()))
        return pd.Series([class_id(s) for s in shingle_sets(hashes, first, k)], dtype=object)

    pairs = written(found.where("goes").join(mixed, "id", "left_semi").select("id", "cid").distinct(), "going-classes")
    pairs = pairs.select(F.col("id").alias(gone), F.col("cid").alias(f"{gone}_{cid}"))
    shared = docs.join(mixed.select(F.col("id").alias(gone)), by_id, "left_semi").withColumn(cid, class_of(F.col(text_col)))
    shared = shared.join(pairs, by_id & (F.col(cid) == F.col(f"{gone}_{cid}")), "left_anti").drop(cid)
    return left.unionByName(shared)
