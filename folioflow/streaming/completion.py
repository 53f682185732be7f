"""Completion of documents as a stream with late pages, timers and expiring state (T6), and its audit (T5).

State is kept per (document, block of pages): a map from a word number to 64
page bits, and one value with the block's page count and status.  A block waits
``timeout_ms`` after its last page; the timer then reports ``timed_out``, but
the pages stay in the state, so a page that comes later is reported as ``late``
and still counts: the block becomes ``complete`` when the last one is in.  State
that nothing touches for ``ttl_ms`` expires.

:func:`seen_pages` and :func:`open_blocks` read the state of a stopped stream
from its checkpoint (state data source), so that a restart can plan what to
redo (A11) without the stream's input.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ship_package

BLOCK_PAGES = 4096
#: the source waited 1 + 2 + ... + 19 seconds
TIMEOUT_MS = 190_000
TTL_MS = 7 * 24 * 3600 * 1000

EVENTS = "doc_id long, block int, page_no int, pages_seen int, block_pages int, num_pages int, status string"
_WORD = 64


class PageTracker(StatefulProcessor):
    """Pages of one block: emits ``late`` pages, and ``complete`` or ``timed_out`` once each time they come true."""

    def __init__(self, timeout_ms: int, ttl_ms: int, block_pages: int):
        self.timeout_ms, self.ttl_ms, self.block_pages = timeout_ms, ttl_ms, block_pages

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.words = handle.getMapState("words", "word int", "bits bigint", ttlDurationMs=self.ttl_ms)
        self.block = handle.getValueState("block", "num_pages int, pages_seen int, status string, timer bigint", ttlDurationMs=self.ttl_ms)

    def _row(self, key, page, seen: int, n: int, status: str) -> Row:
        size = max(0, min(self.block_pages, n - int(key[1]) * self.block_pages))
        return Row(doc_id=int(key[0]), block=int(key[1]), page_no=page, pages_seen=seen, block_pages=size, num_pages=n, status=status)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802,N803
        n, seen, status, timer = self.block.get() if self.block.exists() else (0, 0, "open", None)
        first, new, out = int(key[1]) * self.block_pages, {}, []
        pages: set[int] = set()
        for r in rows:
            n = max(n, r["num_pages"])
            pages.add(r["page_no"])
        for page in sorted(pages):
            at = int(page) - 1 - first
            if not (1 <= page <= n and 0 <= at < self.block_pages):
                continue
            word, bit = at // _WORD, at % _WORD
            if word not in new:
                old = self.words.getValue((word,))[0] if self.words.containsKey((word,)) else 0
                new[word] = old % (1 << _WORD)
            if not new[word] >> bit & 1:             # a page reported again changes nothing
                new[word] |= 1 << bit
                seen += 1
                if status == "timed_out":
                    out.append(self._row(key, int(page), seen, n, "late"))
        for word, bits in new.items():
            self.words.updateValue((word,), (bits - (1 << _WORD) if bits >> _WORD - 1 else bits,))
        size = max(0, min(self.block_pages, n - first))
        if timer is not None:
            self.handle.deleteTimer(timer)
            timer = None
        if status != "complete":
            if size and seen == size:
                status = "complete"
                out.append(self._row(key, None, seen, n, status))
            elif status == "open":
                timer = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
                self.handle.registerTimer(timer)
        self.block.update((n, seen, status, timer))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802,N803
        if self.block.exists():
            n, seen, status, _ = self.block.get()
            if status == "open":
                self.block.update((n, seen, "timed_out", None))
                yield self._row(key, None, seen, n, "timed_out")

    def close(self) -> None:
        pass


def track_pages(done_pages: DataFrame, counts: DataFrame, *, timeout_ms: int = TIMEOUT_MS, ttl_ms: int = TTL_MS,
                block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Completion events (``EVENTS``) of a stream of finished pages (doc_id, page_no) against ``counts`` (doc_id, num_pages).

    A hot document is spread over its blocks.  Pages of unknown documents and
    numbers outside a document are left out.  Start it with
    :func:`state_settings` in force.
    """
    ship_package(done_pages.sparkSession)
    x = done_pages.select("doc_id", F.col("page_no").cast("int").alias("page_no")).join(
        counts.select("doc_id", F.col("num_pages").cast("int").alias("num_pages")), "doc_id", "inner")
    x = x.where("page_no BETWEEN 1 AND num_pages").withColumn("block", F.floor((F.col("page_no") - 1) / block_pages).cast("int"))
    return x.groupBy("doc_id", "block").transformWithState(
        PageTracker(timeout_ms, ttl_ms, block_pages), EVENTS, "append", "processingTime")


@contextmanager
def state_settings(spark: SparkSession, *, drain: bool = False):
    """Settings that a tracker query needs when it starts; ``drain`` lets an ``availableNow`` run end when its input does."""
    want = {"spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    if drain:
        want["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def late_pages(events: DataFrame) -> DataFrame:
    """The late table: pages that came after their block had timed out (doc_id, page_no)."""
    return events.where("status = 'late'").select("doc_id", "page_no")


def document_status(events: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, num_pages, status of every document of ``counts``: ``complete``, ``timed_out``, ``open`` (no word of some block yet)."""
    blocks = events.where("status <> 'late'").groupBy("doc_id", "block").agg(
        F.max("block_pages").alias("size"), F.bool_or(F.col("status") == "complete").alias("whole"))
    docs = blocks.groupBy("doc_id").agg(F.sum(F.when(F.col("whole"), F.col("size")).otherwise(0)).alias("done"),
                                        F.bool_or(~F.col("whole")).alias("waited"))
    return counts.select("doc_id", "num_pages").join(docs, "doc_id", "left").select(
        "doc_id", "num_pages", F.when(F.coalesce("done", F.lit(0)) == F.col("num_pages"), "complete").when(
            F.coalesce("waited", F.lit(False)), "timed_out").otherwise("open").alias("status"))


# ---- audit of a stopped stream -------------------------------------------------------------

def _state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


def open_blocks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Blocks that are not complete in the checkpoint: doc_id, block, pages_seen, num_pages, status."""
    s = _state(spark, checkpoint, "block").select("key.*", "value.value.*")     # values with an expiry are nested
    return s.where("status <> 'complete'").select("doc_id", "block", "pages_seen", "num_pages", "status")


def seen_pages(spark: SparkSession, checkpoint: str, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """All pages in the checkpoint's state (doc_id, page_no)."""
    s = _state(spark, checkpoint, "words").select(
        "key.*", F.col("user_map_key.word").alias("word"), F.col("user_map_value.value.bits").alias("bits"))
    at = F.explode(F.filter(F.sequence(F.lit(0), F.lit(_WORD - 1)), lambda i: F.call_function("getbit", F.col("bits"), i) == 1))
    return s.select("doc_id", "block", "word", at.alias("bit")).select(
        "doc_id", (F.col("block") * block_pages + F.col("word") * _WORD + F.col("bit") + 1).cast("int").alias("page_no"))
