"""Segments of a stream whose state is a table, for topics with very hot users.

A keyed state operator judges each user in one task. Here a micro-batch is
judged by the batch operator, with the live users' state read from a table as
its seed: rows are partitioned by (user, time bucket), partial sums of whole
buckets come from the per-bucket summary, and so one user's rows of a batch
are many tasks' work. The state after the batch (last rows and trailing
windows of the users in it, others' as they were) is written next to the
batch's tables and counts from the same commit record.

A batch reads and writes its users' state whole, so batches should be large
(minutes of a busy topic). For many users and small batches take
``live_stream``; both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txpulse.operators.rfm import RfmRules, rfm_detail
from txpulse.operators.snapshot import entries_of, headers_of, snapshot_rows
from txpulse.session import checkpoint_root
from txpulse.streaming.tables import LiveTables


class TableState:
    """A ``foreachBatch`` writer of judged records (``judged_transactions``) into ``tables``.

    Rows of a batch go in (event_time, seq) order. A row older than its user's
    last one sees what the state still holds, as in the keyed form. Ties between
    partitions need a ``seq`` that orders them; for a topic keyed by user the
    offset does.
    """

    def __init__(self, tables: LiveTables, rules: RfmRules = RfmRules(), bucket_ms: int | str | None = "auto"):
        self.tables, self.rules, self.bucket_ms = tables, rules, bucket_ms

    def state(self, number: int) -> DataFrame | None:
        """Last rows and trailing windows of the users live at commit ``number``."""
        path = f"{self.tables.root}/state/number={number}"
        return self.tables.spark.read.parquet(path) if self.tables.files.exists(path) else None

    def write(self, batch: DataFrame, batch_id: int) -> None:
        run_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        self.write_batch(batch, run_id, batch_id)

    def write_batch(self, batch: DataFrame, run_id: str, batch_id: int) -> None:
        last = self.tables.last()
        if last and last["run_id"] == run_id and last["batch_id"] >= batch_id:
            return
        checkpoint_root(self.tables.spark)
        clean = batch.where(F.col("reason").isNull())
        old = self.state(last["number"]) if last else None
        users = clean.select("user_id").distinct()
        seeds = [None, None]
        if old is not None:
            touched = old.join(users, "user_id", "left_semi")
            seeds = [headers_of(touched, self.tables.ttl_ms), entries_of(touched, self.tables.ttl_ms)]
        detail = rfm_detail(clean.select("user_id", "type", "sum", "event_time", "seq"), self.rules, self.bucket_ms, *seeds)
        detail = detail.checkpoint()  # the state, the segments and the counts read it
        state = snapshot_rows(detail)
        if old is not None:
            state = state.unionByName(old.join(users, "user_id", "left_anti"))
        partition = clean.select(F.col("user_id").alias("u"), F.col("seq").alias("s"), F.col("event_time").alias("t"), "partition")
        same = (F.col("user_id") == F.col("u")) & (F.col("seq") == F.col("s")) & (F.col("event_time") == F.col("t"))
        segments = detail.where("_emit").join(partition, same).select(
            F.lit("segment").alias("kind"), "user_id", "partition", "seq", "type", "sum", "event_time", "segment", "r_minutes",
            "f", "m", "first_ts",
        )
        rejects = batch.where(F.col("reason").isNotNull()).select(
            F.lit("reject").alias("kind"), "partition", "seq", "reason", "malformed", "raw"
        )
        rows = segments.unionByName(rejects, allowMissingColumns=True)

        def keep(number: int, newest: int) -> None:
            live = state.where(F.col("user_last_ts") + F.lit(self.tables.ttl_ms) > F.lit(newest))
            live.write.mode("overwrite").parquet(f"{self.tables.root}/state/number={number}")

        self.tables.commit_batch(rows, run_id, batch_id, keep)
        if last and last["number"] > 1:
            self.tables.files.delete(f"{self.tables.root}/state/number={last['number'] - 1}")
