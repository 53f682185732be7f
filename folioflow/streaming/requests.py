"""Request-queue consumption as Structured Streaming.

* T1 :func:`start_request_stream` - messages in, trigger messages kept (F1),
  each micro-batch hands the woken records to a caller function
  (``foreachBatch``); the checkpoint makes a restart resume, not repeat (T5).
* T2 rate cap - ``maxFilesPerTrigger`` (file source) or
  ``maxOffsetsPerTrigger`` (Kafka) with a processing-time trigger.
* T3 :func:`wrap_messages` - body -> task envelope JSON with a stable id.
* T4 :func:`classify_messages` / :func:`dead_letter_batch` - unknown or
  undecodable messages go to a dead-letter sink, the rest to the task sink.
* T6 :func:`track_completion` - per block of a document's pages, a bitmap of
  finished pages until all are in; a block that stalls past the timeout is
  reported ``timed_out`` and its later pages ``late`` (state kept in the
  checkpoint, ``applyInPandasWithState``); :func:`document_status` sums blocks
  up, :func:`tracked_pages` reads the state of a stopped stream (T5).
* T7 :func:`retry_eligible` - attempts table: which failed calls may run again.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.filters import TRIGGER_MESSAGE, wake_messages
from ..session import ship_package
from . import shards as sh

# Fixed values of the queue contract.
TASK_NAME = "ai.pdf_request"          # task every message is routed to
MAX_TASKS_PER_SECOND = 5              # T2: per worker
MAX_ATTEMPTS = 3                      # T7: calls per request
BACKOFF_SECONDS = 1                   # T7: wait = attempts x backoff


def wrap_messages(msgs: DataFrame, body: str = "value", offset: str = "event_id",
                  task: str = TASK_NAME) -> DataFrame:
    """``{task, id, args:[body]}``; ``id`` = md5 of offset and body (the source used one constant id)."""
    mid = F.md5(F.concat_ws("|", F.col(offset).cast("string"), F.col(body)))
    env = F.struct(F.lit(task).alias("task"), mid.alias("id"), F.array(F.col(body)).alias("args"))
    return msgs.select(offset, F.to_json(env).alias("envelope"))


def classify_messages(msgs: DataFrame, trigger: str = TRIGGER_MESSAGE, body: str = "value",
                      payload: str = "body", payload_schema: str = "k int",
                      known: Sequence[str] | None = None) -> DataFrame:
    """T4: outcome per message: ``task`` or ``dead_letter`` with a reason.

    Reasons: ``empty`` (no body), ``undecodable`` (payload is not a JSON object
    whose fields fit ``payload_schema``), ``unknown`` (body is none of the
    ``known`` requests; by default the trigger alone is known).
    """
    # try_parse_json is null for text that is not JSON (from_json would give a struct of nulls)
    parsed = F.try_parse_json(F.col(payload))
    shaped = F.from_json(F.col(payload), f"{payload_schema}, _ff_corrupt string", {"columnNameOfCorruptRecord": "_ff_corrupt"})
    decoded = parsed.isNotNull() & F.ltrim(F.col(payload)).startswith("{") & shaped["_ff_corrupt"].isNull()
    reason = (F.when(F.col(body).isNull() | (F.col(body) == ""), F.lit("empty"))
               .when(F.col(payload).isNotNull() & ~decoded, F.lit("undecodable"))
               .when(~F.col(body).isin(*(known or [trigger])), F.lit("unknown")))
    return msgs.withColumn("reason", reason).withColumn(
        "outcome", F.when(F.col("reason").isNull(), F.lit("task")).otherwise(F.lit("dead_letter")))


def dead_letter_batch(batch: DataFrame, task_sink: Callable[[DataFrame], None],
                      dead_sink: Callable[[DataFrame], None], **kw) -> None:
    """T4 inside ``foreachBatch``: one pass, two sinks."""
    c = classify_messages(batch, **kw)
    task_sink(c.where(F.col("outcome") == "task"))
    dead_sink(c.where(F.col("outcome") == "dead_letter"))


def start_request_stream(spark: SparkSession, source: str, schema: str, checkpoint: str,
                         handle: Callable[[DataFrame, int], None], fmt: str = "parquet",
                         trigger: str = TRIGGER_MESSAGE, max_files_per_trigger: int | None = MAX_TASKS_PER_SECOND,
                         available_now: bool = False, processing_time: str = "1 second"):
    """T1 + T2 + T5: consume a message folder; woken messages go to ``handle(batch_df, batch_id)``.

    ``handle`` must be idempotent per ``batch_id`` (a restarted query may
    replay the last batch).  Rate cap (T2): at most ``max_files_per_trigger``
    files, or with ``fmt="kafka"`` offsets, per processing-time trigger.
    """
    reader = spark.readStream.format(fmt)
    if fmt != "kafka":                               # Kafka rows have a schema of their own
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger", max_files_per_trigger)
    woken = wake_messages(reader.load(source), trigger)
    w = woken.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def pick_next_records(queue: DataFrame, outbox: str, per_message: int = 1,
                      order: Sequence[str] = ("priority_id", "queue_id")) -> Callable[[DataFrame, int], None]:
    """T1 + O2 handler: each woken message picks the next ``per_message`` records not picked before.

    Picked records are written to ``outbox/batch_id=<id>`` (overwritten when a
    batch is replayed).  Records picked by *other* batches are excluded with a
    left anti join, so a replayed batch picks the same records again.  Only
    the number of woken messages reaches the driver.
    """
    spark, root = queue.sparkSession, outbox.rstrip("/")
    # an empty first part: reading the outbox then fails only for real reasons
    queue.limit(0).write.mode("overwrite").parquet(f"{root}/batch_id=-1")

    def handle(batch: DataFrame, batch_id: int) -> None:
        k = batch.count()
        if k == 0:
            return
        taken = spark.read.parquet(root).where(F.col("batch_id") != batch_id).select("queue_id")
        picked = queue.join(taken, "queue_id", "left_anti").orderBy(*order).limit(k * per_message)
        picked.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return handle


TRACK_OUT = "doc_id long, block int, page_no int, pages_seen int, block_pages int, num_pages int, status string"
TRACK_STATE = "pairs binary, seen binary"
BLOCK_PAGES = 4096
_OPEN, _TIMED_OUT, _COMPLETE = 0, 1, 2


def _tracker(timeout_ms: int, block_pages: int):
    """State function of one shard of blocks; its parameters are captured here so executors see them."""
    names = [c.split()[0] for c in TRACK_OUT.split(", ")]

    def track(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old, bits = sh.opened(*(state.get if state.exists else (b"", b"")))
        now = state.getCurrentProcessingTimeMs()
        rows = [] if state.hasTimedOut else [b[["doc_id", "block", "page_no", "num_pages"]].to_numpy(np.int64) for b in batches]
        doc, block, page, n = np.concatenate([np.zeros((0, 4), np.int64), *rows]).T
        pairs, was, of = sh.joined(old, doc, block)
        pairs["n"][of] = n
        at = page - 1 - block * block_pages
        real = (page >= 1) & (page <= n) & (at >= 0) & (at < block_pages)
        np.maximum.at(pairs["width"], of[real], at[real] + 1)
        seen, start = sh.widened(old, bits, pairs, was), sh.offsets(pairs)
        upto = sh.counted(seen)
        before = upto[start[1:]] - upto[start[:-1]]
        new = np.unique(start[of[real]] + at[real])
        new = new[~seen[new]]                        # a page reported again changes nothing
        seen[new] = True
        upto = sh.counted(seen)
        count = upto[start[1:]] - upto[start[:-1]]
        size = np.clip(pairs["n"].astype(np.int64) - pairs["block"].astype(np.int64) * block_pages, 0, block_pages)
        touched = np.zeros(len(pairs), bool)
        touched[of] = True
        out = []

        def emit(which: np.ndarray, count: np.ndarray, word: str, page=None) -> None:
            if len(which):
                rows = (pairs["doc"][which], pairs["block"][which], page, count, size[which], pairs["n"][which], word)
                out.append(pd.DataFrame(dict(zip(names, rows))).astype({"page_no": "Int32"}))

        owner = np.searchsorted(start, new, side="right") - 1
        rank = np.arange(len(new)) - np.searchsorted(owner, owner)
        is_late = pairs["status"][owner] == _TIMED_OUT
        late = owner[is_late]
        emit(late, before[late] + rank[is_late] + 1, "late", pairs["block"][late].astype(np.int64) * block_pages + new[is_late] - start[late] + 1)
        whole = np.flatnonzero(touched & (pairs["status"] != _COMPLETE) & (size > 0) & (count == size))
        pairs["status"][whole] = _COMPLETE
        emit(whole, count[whole], "complete")
        # a block with new pages starts to wait anew; of one that timed out the pages stay: later ones still count
        pairs["at_ms"][touched] = now + timeout_ms
        over = np.flatnonzero(~touched & (pairs["status"] == _OPEN) & (pairs["at_ms"] < now))
        pairs["status"][over] = _TIMED_OUT
        emit(over, count[over], "timed_out")
        state.update(sh.closed(pairs, seen))
        waits = pairs["at_ms"][pairs["status"] == _OPEN]
        if len(waits):
            state.setTimeoutDuration(max(1, int(waits.min()) - now))
        yield from out

    return track


def track_completion(done_pages: DataFrame, counts: DataFrame, timeout_ms: int = 190_000,
                     block_pages: int = BLOCK_PAGES, shards: int = sh.SHARDS) -> DataFrame:
    """Stateful completion per block of pages over a stream of finished pages.

    ``done_pages`` (streaming: doc_id, page_no) is joined with the static page
    counts.  State is kept per (document, block of ``block_pages`` pages) as a
    bitmap of the pages seen, so a repeated report counts once and a hot
    document is spread over its blocks; the blocks are dealt over ``shards``
    stateful groups (:mod:`folioflow.streaming.shards`), since a group costs more
    than a usual document.  Neither number may change over a restart.  A block emits ``complete`` when all its
    pages are in, or ``timed_out`` when no page arrived for ``timeout_ms`` (the
    source waited 1+2+...+19 = 190 s).  Its pages stay in the state: a page that
    comes after that is emitted as ``late`` and still counts, so the block
    completes in the end.  Output mode append; :func:`document_status` turns the
    emitted rows into one row per document, :func:`late_pages` into the late
    table.  :mod:`folioflow.streaming.completion` has the same with state that
    expires and exact timers, at a higher cost per block.
    """
    ship_package(done_pages.sparkSession)
    x = sh.paged(done_pages.select("doc_id", F.col("page_no").cast("int").alias("page_no")), counts, block_pages, shards)
    return x.groupBy("shard").applyInPandasWithState(
        _tracker(timeout_ms, block_pages), TRACK_OUT, TRACK_STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def document_status(events: DataFrame) -> DataFrame:
    """doc_id, pages_seen, num_pages, status from the rows that the tracker has written.

    ``complete`` when the complete blocks hold all pages, ``timed_out`` when a
    block timed out and has not completed since, else ``open``.
    """
    blocks = events.groupBy("doc_id", "block").agg(
        F.max("pages_seen").alias("seen"), F.max("num_pages").alias("num_pages"), F.max("block_pages").alias("size"),
        F.bool_or(F.col("status") == "complete").alias("whole"), F.bool_or(F.col("status") == "timed_out").alias("late"))
    one = blocks.groupBy("doc_id").agg(
        F.sum("seen").cast("int").alias("pages_seen"), F.max("num_pages").alias("num_pages"),
        F.sum(F.when(F.col("whole"), F.col("size")).otherwise(0)).alias("_whole"),
        F.bool_or(F.col("late") & ~F.col("whole")).alias("_late"))
    return one.select("doc_id", "pages_seen", "num_pages", F.when(F.col("_whole") == F.col("num_pages"), "complete")
                      .when(F.col("_late"), "timed_out").otherwise("open").alias("status"))


def late_pages(events: DataFrame) -> DataFrame:
    """The late table: pages that came after their block had timed out (doc_id, page_no)."""
    return events.where("status = 'late'").select("doc_id", "page_no")


def tracked_pages(spark: SparkSession, checkpoint: str, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """T5: the pages in the state of a stopped :func:`track_completion` query (doc_id, page_no), from its checkpoint."""
    ship_package(spark)

    def pages_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                pairs, bits = sh.opened(r["pairs"], r["seen"])
                of, place = sh.placed(pairs, bits)
                page = pairs["block"][of].astype(np.int64) * block_pages + place + 1
                yield pa.RecordBatch.from_arrays([pa.array(pairs["doc"][of]), pa.array(page.astype(np.int32))], ["doc_id", "page_no"])

    state = spark.read.format("statestore").option("path", checkpoint).load().select("value.groupState.pairs", "value.groupState.seen")
    return state.mapInArrow(pages_of, "doc_id long, page_no int")


@contextmanager
def drained(spark: SparkSession):
    """Lets an ``availableNow`` query with processing-time timeouts end with its input (no batches without data)."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def retry_eligible(attempts: DataFrame, now: str | _dt.datetime, max_attempts: int = MAX_ATTEMPTS,
                   backoff_s: int = BACKOFF_SECONDS, last_col: str = "last_try",
                   n_col: str = "attempts") -> Column:
    """A failed call may run again when ``attempts < max`` and ``now >= last + attempts x backoff``."""
    now_c = F.lit(str(now)).cast("timestamp")
    wait = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col(n_col) * backoff_s).cast("decimal(18,6)"))
    return (F.col(n_col) < max_attempts) & (now_c >= F.col(last_col).cast("timestamp") + wait)
