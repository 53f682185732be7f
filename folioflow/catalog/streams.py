"""Jobs that run a stream, a page function or emit XML."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..plans import complete, merge, page_functions, split
from ..session import materialize, shared_path
from ..sources import tables as T
from ..streaming import requests as rq
from ..streaming.segments import SegmentStream
from . import job
from .pipeline import PV, SPLIT
from .records import REC, RV, non_bulk

RUN_DATE = "2024-01-20"


def _pages(spark, sf_dir):
    """The page table, numbered once for all its uses in a job."""
    return materialize(T.pages(spark, sf_dir).select("doc_id", "page_no", "barcode", "returnflag"), "pages")


class _Tracker:
    """A page log in the shared folder, read by a completion stream that can be stopped and started again."""

    def __init__(self, spark, sf_dir, timeout_ms: int):
        self.spark, self.timeout_ms = spark, timeout_ms
        name = f"ff_tracker_{uuid.uuid4().hex[:8]}"
        self.log, self.out, self.state = (shared_path(spark, "streams", name, x) for x in ("log", "blocks", "state"))
        # every batch joins the counts again
        self.counts = materialize(T.page_totals(spark, sf_dir), "page_totals")

    def report(self, pages) -> None:
        self.schema = pages.schema
        pages.write.mode("append").parquet(self.log)

    def drain(self) -> None:
        """Run over all reported pages, some files a batch, and stop."""
        stream = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 64).parquet(self.log)
        w = rq.track_completion(stream, self.counts, timeout_ms=self.timeout_ms).writeStream.format("parquet").outputMode("append")
        with rq.drained(self.spark):
            w.option("path", self.out).option("checkpointLocation", self.state).trigger(availableNow=True).start().awaitTermination()

    def events(self):
        return self.spark.read.schema(rq.TRACK_OUT).parquet(self.out)


@job("completion_tracker", """
SELECT doc_id, num_pages AS pages_seen, num_pages, 'complete' AS status FROM v_counts""", ("v_pages", "v_counts"))
def completion_tracker(spark, sf_dir):
    """Finished pages streamed in; per document a ``complete`` row once all pages are in.

    The page table is written to the shared folder as the log of finished
    pages (pages of returned items are reported twice, as after a retry) and
    read as a stream in batches of some files; state, progress and the emitted
    rows live below the shared ``spark.checkpoint.dir``.
    """
    pages = _pages(spark, sf_dir)
    t = _Tracker(spark, sf_dir, timeout_ms=190_000)
    seen = pages.select("doc_id", "page_no")
    t.report(seen.union(pages.where("returnflag = 'R'").select("doc_id", "page_no")))
    t.drain()
    return rq.document_status(t.events())


@job("late_pages", """
SELECT p.doc_id, CAST(max(page_no) AS INTEGER) AS num_pages, 'complete' AS status,
  count(*) FILTER (WHERE page_no % 2 = 0) AS late_pages
FROM v_pages p GROUP BY p.doc_id""", ("v_pages",))
def late_pages(spark, sf_dir):
    """Odd pages come in, the time-out passes, even pages come late: they go to the late table and the documents complete.

    The stream is stopped and started again between the three steps.
    """
    pages = _pages(spark, sf_dir).select("doc_id", "page_no")
    t = _Tracker(spark, sf_dir, timeout_ms=1)
    t.report(pages.where("page_no % 2 = 1"))
    t.drain()
    # a heartbeat of no document makes a batch in which open blocks time out
    t.report(spark.createDataFrame([(-1, 0)], t.schema))
    t.drain()
    t.report(pages.where("page_no % 2 = 0"))
    t.drain()
    events = t.events()
    late = rq.late_pages(events).groupBy("doc_id").agg(F.count(F.lit(1)).alias("late_pages"))
    return rq.document_status(events).join(late, "doc_id", "left").select(
        "doc_id", "num_pages", "status", F.coalesce("late_pages", F.lit(0)).alias("late_pages"))


@job("redo_from_checkpoint", """
SELECT p.doc_id, p.page_no FROM v_pages p
JOIN (SELECT doc_id, min(page_no) AS first FROM v_pages WHERE returnflag = 'R' GROUP BY doc_id) m
  ON m.doc_id = p.doc_id AND p.page_no >= m.first""", ("v_pages",))
def redo_from_checkpoint(spark, sf_dir):
    """T5 + A11: a stream that saw all pages but those of returned items stops; what to redo is read from its checkpoint."""
    pages = _pages(spark, sf_dir)
    t = _Tracker(spark, sf_dir, timeout_ms=190_000)
    t.report(pages.where("returnflag <> 'R'").select("doc_id", "page_no"))
    t.drain()
    seen = rq.tracked_pages(spark, t.state).withColumn("kind", F.lit("page"))
    return complete.redo_pages(pages, seen, "page")


@job("segments_stream", "SELECT * FROM plan", PV, SPLIT)
def segments_stream(spark, sf_dir):
    """W4 on a stream: pages come in two parts, not in page order, the stream stops in between; its segments equal the batch plan."""
    pages = _pages(spark, sf_dir).select("doc_id", "page_no", "barcode")
    folder = shared_path(spark, "streams", f"ff_segments_{uuid.uuid4().hex[:8]}")
    counts = materialize(T.page_totals(spark, sf_dir), "page_totals")
    for odd in (0, 1):
        pages.where(F.col("page_no") % 2 == odd).write.mode("append").parquet(folder + "/pages")
        SegmentStream(spark, folder, counts).drain(spark.readStream.schema(pages.schema).parquet(folder + "/pages"))
    return SegmentStream(spark, folder, counts).segments()


WS = r"[\t\n\x0B\f\r ]"
CLEAN = f"regexp_replace(COALESCE(text, ''), '^{WS}+|{WS}+$', '', 'g')"


@job("map_pages", f"""
SELECT doc_id, page_no, {CLEAN} AS text, CAST(CASE WHEN {CLEAN} = '' THEN 0 ELSE 1 END AS INTEGER) AS status,
       CAST(NULL AS VARCHAR) AS error
FROM v_page_text""", ("v_page_text",))
def map_pages(spark, sf_dir):
    """The default page function (text clean-up) over every page text, with per-page status."""
    return page_functions.map_pages(T.page_text(spark, sf_dir))


@job("map_documents", f"""
SELECT doc_id, {CLEAN} AS text, CAST(CASE WHEN {CLEAN} = '' THEN 0 ELSE 1 END AS INTEGER) AS status,
       CAST(NULL AS VARCHAR) AS error
FROM v_docs""", ("v_docs",))
def map_documents(spark, sf_dir):
    """The default document function over every whole document."""
    return page_functions.map_documents(T.docs(spark, sf_dir))


@job("manifest_xml", f"""
SELECT r.queue_id,
  '<?xml version=''1.0'' encoding=''UTF-8''?>' || chr(10) || '<FileInfo process_date="20/1/2024" profile_id="' || r.profile_id || '">' || chr(10) ||
  '    <Image id="' || r.image_id || '">' || chr(10) ||
  '        <Bookmark ID="' || CAST(r.queue_id AS VARCHAR) || '">' || chr(10) ||
  array_to_string(list_transform(range(1, c.num_pages + 1), lambda i: '            <piece path="' || r.box_number ||
     '/' || r.box_part || '/' || CAST(r.queue_id AS VARCHAR) || '_' || lpad(CAST(i AS VARCHAR), 6, '0') ||
     '.pdf"/>'), chr(10)) || chr(10) ||
  '        </Bookmark>' || chr(10) || '    </Image>' || chr(10) || '</FileInfo>' AS xml
FROM rec r JOIN v_counts c ON c.doc_id = r.queue_id WHERE NOT r.bulk""", RV + ("v_pages", "v_counts"), REC)
def manifest_xml(spark, sf_dir):
    """XML manifest per non-bulk record (``to_xml``)."""
    r = non_bulk(spark, sf_dir).select("queue_id", "profile_id", "image_id", "box_number", "box_part",
                                       F.col("queue_id").cast("string").alias("pdf_name"))
    c = T.page_totals(spark, sf_dir).withColumnRenamed("doc_id", "queue_id")
    return merge.manifest_xml(r.join(c, "queue_id", "inner"), RUN_DATE)
