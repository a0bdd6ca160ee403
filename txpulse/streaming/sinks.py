"""foreachBatch sinks.

``BatchFanout`` is the one ``foreachBatch`` function of a query: it persists
the micro-batch once and hands it to every writer, so the stateful operator
runs once per batch however many outputs there are (the reference ran its
state function once per output and per action).

Writers are idempotent per ``batch_id`` where the target allows it, so a
batch retried after a failure does not duplicate output.
"""

from __future__ import annotations

import logging
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from txpulse.functions import constants as C
from txpulse.functions.envelope import to_kv
from txpulse.sources.kafka import raise_if_no_connector

log = logging.getLogger("txpulse.sinks")

Writer = Callable[[DataFrame, int], None]


class BatchFanout:
    """Persist once, observe counts, run each writer; bounded logging only.

    An empty batch (a trigger that only moves the watermark or timers) reaches no writer.
    """

    def __init__(self, writers: list[Writer], name: str = "batch", sample_rows: int = 0, per_key: bool = False):
        self.writers = list(writers)
        self.name = name
        self.sample_rows = sample_rows
        self.per_key = per_key
        self.last_metrics: dict = {}
        self.history: deque[dict] = deque(maxlen=256)  # recent batches only

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        obs = Observation(f"{self.name}_{batch_id}")
        metrics = [F.count(F.lit(1)).alias("rows")]
        if "user_id" in batch.columns:
            metrics.append(F.approx_count_distinct("user_id").alias("users"))
        batch = batch.observe(obs, *metrics).persist()
        try:
            batch.count()  # materialises the cache and the observed metrics
            self.last_metrics = {"batch_id": batch_id, **obs.get}
            self.history.append(self.last_metrics)
            log.info("%s batch %s: %s", self.name, batch_id, self.last_metrics)
            if not self.last_metrics["rows"]:
                return
            if self.sample_rows:
                for row in batch.limit(self.sample_rows).collect():  # bounded sample
                    log.info("%s: %s", self.name, row.asDict())
            if self.per_key:  # the batch's busiest keys, bounded like the sample
                counts = batch.groupBy("user_id").agg(F.count("*").alias("n"))
                for row in counts.orderBy(F.desc("n"), "user_id").limit(max(1, self.sample_rows)).collect():
                    log.info("%s batch %s: user %s has %s rows", self.name, batch_id, row["user_id"], row["n"])
            for write in self.writers:
                write(batch, batch_id)
        finally:
            batch.unpersist()


def parquet_table_writer(path: str) -> Writer:
    """Append one folder per batch; a retried batch overwrites its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def kafka_writer(bootstrap_servers: str, topic: str, fields: tuple[str, ...]) -> Writer:
    """Key = user id, value = JSON of ``fields`` (K1, K2); at-least-once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        try:
            (
                to_kv(batch, fields)
                .write.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap_servers)
                .option("topic", topic)
                .save()
            )
        except Exception as e:
            raise_if_no_connector(e)
            raise

    return write


def console_writer(rows: int = 20) -> Writer:
    """Debug echo of at most ``rows`` rows per batch (K3)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.show(rows, truncate=False)

    return write


SNAPSHOT_VALUE = ("last_ts", "last_seq", "f", "m", "r_minutes", "segment", "expires_at")


def where_writer(condition: str, columns: tuple[str, ...], write: Writer) -> Writer:
    """Hands one part of the batch to ``write``, for several tables from one stream."""

    def part(batch: DataFrame, batch_id: int) -> None:
        write(batch.where(condition).select(*columns), batch_id)

    return part


def latest_per_user(segments: DataFrame, as_of: int | None = None, ttl_ms: int = C.SNAPSHOT_TTL_MS) -> DataFrame:
    """The keyed snapshot (K5): each user's newest row of the segments table, with its own expiry.

    A plain aggregate over what ``parquet_table_writer`` appended, combined
    map-side. A user expires ``ttl_ms`` after the user's own last write, so no
    other user's clock matters; ``as_of`` leaves out the expired ones.
    """
    rows = segments.select(
        "user_id",
        F.col("updated_at").alias("last_ts"),
        F.col("seq").alias("last_seq"),
        "f",
        "m",
        "r_minutes",
        "segment",
        (F.col("updated_at") + F.lit(ttl_ms)).alias("expires_at"),
    )
    newest = F.max_by(F.struct(*SNAPSHOT_VALUE), F.struct("last_ts", "last_seq"))
    snap = rows.groupBy("user_id").agg(newest.alias("s")).select("user_id", "s.*")
    return snap if as_of is None else snap.where(F.col("expires_at") > F.lit(as_of))
