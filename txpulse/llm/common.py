"""Helpers shared by the text operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from txpulse.session import scratch_path

#: Word and space classes of the result contracts (ASCII white space only).
WS = r"[\x20\x09-\x0D]+"
NON_WS = r"[^\x20\x09-\x0D]+"

#: Text bytes a Python worker handles at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders of the scopes that are open, innermost last.
_scopes: list[list[str]] = []


def temporary(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared one; removed with its scope, or when the application ends."""
    path = scratch_path(spark, f"llm-{name}")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    if _scopes:
        _scopes[-1].append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage and has a known size.

    The table goes with the scope that it is written in, or when the
    application ends.
    """
    path = temporary(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes the tables written within when it ends; what is read later must be written after it or ``kept``.

    The driver's garbage is collected too, so that Spark removes the shuffle
    files of the jobs that are done.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)
        gc.collect()
        spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the scope outside the present one."""
    inner = _scopes.pop() if _scopes else None
    try:
        return written(df, name)
    finally:
        if inner is not None:
            _scopes.append(inner)


def may_hold(keys: DataFrame, n: int) -> Callable[[Column], Column]:
    """Whether a long may be one of the ``n`` or so of the table's only column; it says so of all that are.

    Spark's own Bloom filter of 12 bits a key, and of 8 MB at most: one that is
    full lets more pass.
    """
    spark = keys.sparkSession
    n = max(n, 1000)
    sizes = (F.lit(x).cast("long") for x in (2 * n, min(12 * n, 1 << 26)))
    made = InternalFunction._invoke_internal_function_over_columns("bloom_filter_agg", F.col(keys.columns[0]), *sizes)
    held = written(keys.coalesce(8).agg(made.alias("filter")), "filter").scalar()
    jvm = spark._jvm.org.apache.spark.sql
    expression = jvm.classic.ExpressionUtils.expression

    def among(value: Column) -> Column:
        test = jvm.catalyst.expressions.BloomFilterMightContain(expression(held._jc), expression(value._jc))
        return type(value)(jvm.classic.ExpressionUtils.column(test))

    return among


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters (null: 0), as a long."""
    # every word takes the spaces round it along, so one mark a word is left
    marks = F.regexp_replace(text, rf"[\x20\x09-\x0D]*{NON_WS}[\x20\x09-\x0D]*", "w")
    return F.when(text.rlike(NON_WS), F.length(marks)).otherwise(0).cast("long")


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch whose texts hold about SLICE_BYTES, with the texts (null: empty)."""
    texts = batch.column(batch.schema.get_field_index(column))
    if len(texts) == 0:
        return
    if not pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)

    def part(start: int, n: int) -> tuple[pa.RecordBatch, pa.Array]:
        # a part's texts only: a copy of them all would be the largest thing a worker holds
        return batch.slice(start, n), pc.fill_null(texts.slice(start, n).cast(pa.large_string()), "")

    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > SLICE_BYTES:
            yield part(start, i - start)
            start, held = i, 0
        held += n
    yield part(start, len(texts) - start)
