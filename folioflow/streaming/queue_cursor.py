"""A request queue that is ordered once and consumed by a cursor under a rate cap.

:func:`rank_queue` writes the queue in its order with a rank, ``FOLDER_RANKS``
ranks a folder.  A batch then picks the next ranks: a range filter that opens only
the folders of its ranks, so neither the queue nor the earlier picks are sorted or
read again, and a batch has as many tasks as its own ranks need.

The cursor is a small log (:mod:`folioflow.sinks.state_log`), one row per batch:
the ranks it was given, the requests still owed, and the tokens left in the
bucket.  A batch that is replayed finds its own row and picks the same ranks,
whatever the clock says by then.  Tokens flow in at ``rate`` a second up to
``burst``, so no batch holds more tasks than that; woken requests beyond it are
owed and served by later batches.  :func:`serve_owed` does that for many
heartbeats at once, each a batch with its own row in the log and its own picks.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..sinks import state_log

ENTRY = "queue string, at_ms long, first_rank long, last_rank long, owed long, tokens double"
#: ranks in one folder of the ranked table
FOLDER_RANKS = 1 << 17
#: batches after which the cursor log is compacted
COMPACT_EVERY = 256
#: heartbeats that are logged and picked by one job
BEATS = 256


def rank_queue(queue: DataFrame, path: str, order: Sequence[str] = ("priority_id", "queue_id")) -> None:
    """Write ``queue`` below ``path`` in the given order, with ``rank`` from 1; each file holds a range of ranks."""
    spark = queue.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = list(order)
    queue.repartitionByRange(shards, *keys).sortWithinPartitions(*keys).withColumn(
        "_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{path}/sorted")
    placed = spark.read.parquet(f"{path}/sorted").withColumn("_shard", F.shiftright("_at", 33))
    # one row for each of the sorted partitions
    counts = placed.groupBy("_shard").agg(F.min("_at").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_shard", "_lo", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    ranked = placed.join(F.broadcast(bases), "_shard").withColumn("rank", F.col("_base") + F.col("_at") - F.col("_lo") + 1)
    foldered = ranked.drop("_shard", "_at", "_lo", "_base").withColumn("_folder", _folder(F.col("rank")))
    foldered.sortWithinPartitions("rank").write.mode("overwrite").partitionBy("_folder").parquet(f"{path}/ranked")


def _folder(rank: Column) -> Column:
    return F.floor((rank - 1) / FOLDER_RANKS).cast("int")


def ranked_queue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/ranked").drop("_folder")


def ranks_between(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """The ranks ``first`` to ``last`` of the queue; only their folders are listed and opened."""
    folders = [f"{path}/ranked/_folder={k}" for k in range((first - 1) // FOLDER_RANKS, (last - 1) // FOLDER_RANKS + 1)]
    rows = spark.read.option("basePath", f"{path}/ranked").parquet(*folders).drop("_folder")
    return rows.where(F.col("rank").between(first, last))


class QueueCursor:
    """Hands out the ranks of one queue batch by batch."""

    def __init__(self, spark: SparkSession, path: str, *, rate: float, burst: float, name: str = "queue",
                 clock: Callable[[], float] = time.time):
        if not 0 < burst or rate < 0:
            raise ValueError("a bucket needs a positive burst and a rate")
        self.spark, self.path, self.rate, self.burst, self.name, self.clock = spark, path, rate, burst, name, clock

    def _rows(self) -> DataFrame:
        return state_log.entries(self.spark, self.path, ENTRY).where(F.col("queue") == self.name)

    def take(self, batch_id: int, woken: int, size: int) -> tuple[int, int]:
        """First and last rank of the batch (last < first: none); ``size`` is the number of records in the queue."""
        rows = self._rows().where(F.col("batch_id") <= batch_id).orderBy(F.col("batch_id").desc()).limit(2).collect()
        own = [r for r in rows if r["batch_id"] == batch_id]
        if own:
            return own[0]["first_rank"], own[0]["last_rank"]
        entry = self._next(rows[0] if rows else None, woken, size)
        state_log.append(self.spark.createDataFrame([entry], ENTRY), self.path, batch_id)
        if batch_id and batch_id % COMPACT_EVERY == 0:
            state_log.compact(self.spark, self.path, ENTRY, "queue", upto=batch_id - 1)
        return entry["first_rank"], entry["last_rank"]

    def _next(self, last: Row | None, woken: int, size: int) -> Row:
        """The entry of the batch after ``last``."""
        now = int(self.clock() * 1000)
        done, owed, tokens = (last["last_rank"], last["owed"], last["tokens"]) if last else (0, 0, self.burst)
        if last:
            tokens = min(self.burst, tokens + self.rate * max(0, now - last["at_ms"]) / 1000)
        owed = min(owed + woken, size - done)        # requests beyond the end of the queue find nothing
        n = min(owed, int(tokens))
        return Row(queue=self.name, at_ms=max(now, last["at_ms"] if last else now), first_rank=done + 1, last_rank=done + n,
                   owed=owed - n, tokens=float(tokens - n))

    def beats(self, batch_id: int, size: int, most: int = BEATS) -> list[tuple[int, int, int]]:
        """``batch id, first and last rank`` of the heartbeats from ``batch_id`` on until nothing is owed, ``most`` at once.

        Heartbeats that stand in the log already are handed out again as they are.
        """
        rows = self._rows()
        out = [(r["batch_id"], r) for r in rows.where(F.col("batch_id").between(batch_id, batch_id + most - 1)).orderBy("batch_id").collect()]
        last = out[-1][1] if out else rows.where(F.col("batch_id") < batch_id).orderBy(F.col("batch_id").desc()).limit(1).first()
        at, new = out[-1][0] + 1 if out else batch_id, []
        while last and last["owed"] > 0 and len(out) + len(new) < most:
            last = self._next(last, 0, size)
            new.append((at, last))
            at += 1
        if new:
            first = new[0][0]
            state_log.append_many(self.spark.createDataFrame([(*r, k) for k, r in new], f"{ENTRY}, batch_id long").coalesce(1), self.path)
            if first and new[-1][0] // COMPACT_EVERY > (first - 1) // COMPACT_EVERY:
                state_log.compact(self.spark, self.path, ENTRY, "queue", upto=batch_id - 1)
        return [(k, r["first_rank"], r["last_rank"]) for k, r in out + new]

    def owed(self) -> int:
        row = self._rows().agg(F.max_by("owed", "batch_id")).first()
        return row[0] or 0


def pick_by_cursor(spark: SparkSession, queue_path: str, outbox: str, cursor: QueueCursor,
                   per_message: int = 1) -> Callable[[DataFrame, int], None]:
    """T1 + T2 handler for ``foreachBatch``: the batch's ranks go to ``outbox/batch_id=<id>``.

    A batch without woken messages (a heartbeat) serves what is owed.
    """
    queue = ranked_queue(spark, queue_path)
    size = queue.count()
    root = outbox.rstrip("/")
    queue.limit(0).write.mode("overwrite").parquet(f"{root}/batch_id=-1")

    def handle(batch: DataFrame, batch_id: int) -> None:
        first, last = cursor.take(batch_id, batch.count() * per_message, size)
        if last >= first:
            ranks_between(spark, queue_path, first, last).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return handle


def serve_owed(spark: SparkSession, queue_path: str, outbox: str, cursor: QueueCursor, batch_id: int, beats: int = BEATS) -> int:
    """Heartbeats from ``batch_id`` on until nothing is owed; returns the batch id after the last.

    As if :func:`pick_by_cursor` had served a batch without messages each time:
    every heartbeat takes its own tokens at its own time and its ranks go to
    ``outbox/batch_id=<id>``, but up to ``beats`` of them are written by one job.
    """
    size = ranked_queue(spark, queue_path).count()
    while taken := cursor.beats(batch_id, size, beats):
        some = [x for x in taken if x[2] >= x[1]]
        if some:
            ranks = spark.createDataFrame(some, "batch_id long, first long, last long").select(
                "batch_id", F.explode(F.sequence("first", "last")).alias("rank"))
            picked = ranks_between(spark, queue_path, some[0][1], some[-1][2]).join(ranks.hint("merge"), "rank")
            columns = [c for c in picked.columns if c not in ("rank", "batch_id")]
            picked.hint("rebalance", "batch_id").select(*columns, "rank", "batch_id").write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(outbox.rstrip("/"))
        batch_id = taken[-1][0] + 1
        if not cursor.owed():
            break
    return batch_id
