"""Jobs of the bulk-split road."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes
from ..operators import filters as flt
from ..operators.ordering import adjacent_flag, first_flag, neighbours_within, ordinal_within
from ..plans import complete, merge, split
from ..sources import tables as T
from . import job

WS_END = r"'[\t\n\x0B\f\r ]+$'"
RUN_TS = "2024-01-20 12:00:00"

MARKS = """marks AS (SELECT doc_id, page_no, barcode FROM v_pages
                WHERE barcode IS NOT NULL AND length(barcode) >= 5 AND instr(barcode, 'NEU_') > 0)"""


def split_ctes(keep: str, join: str = "") -> str:
    """Oracle CTEs for W4; ``keep`` is a SQL boolean (may use the ``q`` alias from ``join``)."""
    return f"""{MARKS},
docs AS (SELECT c.doc_id, c.num_pages, {keep} AS k FROM v_counts c {join}),
nb AS (SELECT m.doc_id, m.page_no AS p, m.barcode, d.num_pages AS n, d.k,
              lag(m.page_no) OVER (PARTITION BY m.doc_id ORDER BY m.page_no) AS prev_p,
              lead(m.page_no) OVER (PARTITION BY m.doc_id ORDER BY m.page_no) AS next_p
       FROM marks m JOIN docs d ON d.doc_id = m.doc_id),
calc AS (SELECT *, COALESCE(next_p - 1, n) AS to_page,
                (COALESCE(next_p = p + 1, false) OR COALESCE(prev_p = p - 1, false)) AS adj FROM nb),
seg AS (SELECT *, LEAST(CASE WHEN k THEN p ELSE p + 1 END, to_page) AS from_page,
               (LEAST(CASE WHEN k THEN p ELSE p + 1 END, to_page) = to_page AND adj AND NOT k) AS blank FROM calc),
plan AS (
SELECT doc_id, CASE WHEN blank THEN '' ELSE regexp_replace(barcode, {WS_END}, '') END AS barcode,
       CAST(from_page AS INTEGER) AS from_page, CAST(to_page AS INTEGER) AS to_page,
       CAST(CASE WHEN blank THEN 1 WHEN k THEN from_page ELSE from_page - 1 END AS INTEGER) AS page_index
FROM seg
UNION ALL
SELECT doc_id, '', 1, CAST(p - 1 AS INTEGER), 1 FROM seg WHERE prev_p IS NULL AND p <> 1 AND NOT adj
UNION ALL
SELECT d.doc_id, '', 1, d.num_pages, 1 FROM docs d
WHERE d.num_pages > 0 AND NOT EXISTS (SELECT 1 FROM marks m WHERE m.doc_id = d.doc_id))"""


SPLIT = split_ctes("false")
SPLIT_KEEP = split_ctes("true")
SPLIT_REC = split_ctes("COALESCE(q.keep_barcode_ind, 't') = 't'", "LEFT JOIN v_queue q ON q.queue_id = c.doc_id")
PV = ("v_pages", "v_counts")


def plan_false(spark, sf_dir):
    return split.split_plan(T.pages(spark, sf_dir), keep_barcode=False, docs=T.page_totals(spark, sf_dir))


@job("split_plan", "SELECT * FROM plan", PV, SPLIT)
def split_plan(spark, sf_dir):
    """W4 (flagship) + U1: segments of every bulk scan, keep-barcode off."""
    return plan_false(spark, sf_dir)


@job("split_plan_keep", "SELECT * FROM plan", PV, SPLIT_KEEP)
def split_plan_keep(spark, sf_dir):
    """W4 with keep-barcode on."""
    return split.split_plan(T.pages(spark, sf_dir), keep_barcode=True, docs=T.page_totals(spark, sf_dir))


@job("split_plan_by_record", "SELECT * FROM plan", PV + ("v_queue",), SPLIT_REC)
def split_plan_by_record(spark, sf_dir):
    """W4 with each record's own keep-barcode flag (missing flag = keep)."""
    pages = T.pages(spark, sf_dir)
    flags = flt.decode_flags(T.queue(spark, sf_dir)).select(F.col("queue_id").alias("doc_id"), "keep_barcode")
    docs = T.page_totals(spark, sf_dir).join(flags, "doc_id", "left")
    return split.split_plan(pages, keep_barcode="keep_barcode", docs=docs)


@job("assign_pages", """
SELECT s.doc_id, s.from_page, p.page_no, CAST(p.page_no - s.from_page + 1 AS INTEGER) AS new_page_no, p.width
FROM plan s JOIN v_pages p ON p.doc_id = s.doc_id AND p.page_no BETWEEN s.from_page AND s.to_page""", PV, SPLIT)
def assign_pages(spark, sf_dir):
    """Pages of each planned segment, renumbered from 1 (range join as explode + equi join)."""
    pages = T.pages(spark, sf_dir)
    segs = split.split_plan(pages, docs=T.page_totals(spark, sf_dir))
    return split.assign_pages(segs, pages.select("doc_id", "page_no", "width")).select(
        "doc_id", "from_page", "page_no", "new_page_no", "width")


@job("valid_barcodes", """
SELECT doc_id, page_no, barcode FROM v_pages
WHERE barcode IS NOT NULL AND length(barcode) >= 5 AND instr(barcode, 'NEU_') > 0""", ("v_pages",))
def valid_barcodes(spark, sf_dir):
    """F8: barcodes that pass the length and prefix test."""
    return flt.valid_barcodes(T.pages(spark, sf_dir)).select("doc_id", "page_no", "barcode")


@job("barcodes_in_page_order", """
SELECT doc_id, page_no, barcode,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_no) AS INTEGER) AS barcode_no
FROM marks""", ("v_pages",), MARKS)
def barcodes_in_page_order(spark, sf_dir):
    """O1: valid barcodes numbered in numeric page order (distributed row number)."""
    b = split.barcode_pages(T.pages(spark, sf_dir))
    return ordinal_within(b, "doc_id", ["page_no"], name="barcode_no").select("doc_id", "page_no", "barcode",
                                                                              "barcode_no")


@job("previous_and_next", """
SELECT doc_id, page_no,
       lag(page_no) OVER w AS prev_page_no, lead(page_no) OVER w AS next_page_no,
       lag(barcode) OVER w AS prev_barcode, lead(barcode) OVER w AS next_barcode
FROM marks WINDOW w AS (PARTITION BY doc_id ORDER BY page_no)""", ("v_pages",), MARKS)
def previous_and_next(spark, sf_dir):
    """Each barcode page with its neighbours (null at both ends)."""
    b = split.barcode_pages(T.pages(spark, sf_dir))
    nb = neighbours_within(b, "doc_id", "page_no", carry=["barcode"])
    return nb.select("doc_id", "page_no", "prev_page_no", "next_page_no", "prev_barcode", "next_barcode")


@job("adjacent_barcodes", """
SELECT doc_id, page_no,
       (COALESCE(lead(page_no) OVER w = page_no + 1, false) OR COALESCE(lag(page_no) OVER w = page_no - 1, false))
         AS adjacent
FROM marks WINDOW w AS (PARTITION BY doc_id ORDER BY page_no)""", ("v_pages",), MARKS)
def adjacent_barcodes(spark, sf_dir):
    """Barcode pages next to another barcode page."""
    nb = neighbours_within(split.barcode_pages(T.pages(spark, sf_dir)), "doc_id", "page_no")
    return nb.select("doc_id", "page_no", adjacent_flag().alias("adjacent"))


@job("first_barcode", """
SELECT doc_id, page_no, (lag(page_no) OVER (PARTITION BY doc_id ORDER BY page_no) IS NULL) AS is_first
FROM marks""", ("v_pages",), MARKS)
def first_barcode(spark, sf_dir):
    """The first barcode page of each document."""
    nb = neighbours_within(split.barcode_pages(T.pages(spark, sf_dir)), "doc_id", "page_no")
    return nb.select("doc_id", "page_no", first_flag().alias("is_first"))


@job("number_pages", """
SELECT doc_id, page_no, l_linenumber, l_partkey, l_suppkey, l_quantity FROM v_pages""", ("v_pages",))
def number_pages(spark, sf_dir):
    """1-based page number inside each document (skew-safe row number)."""
    li = T.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), *T.PAGE_ORDER)
    n = ordinal_within(li, "doc_id", T.PAGE_ORDER, name="page_no")
    return n.select("doc_id", "page_no", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@job("page_counts", "SELECT doc_id, num_pages FROM v_counts", PV)
def page_counts(spark, sf_dir):
    """Pages per document."""
    return T.page_totals(spark, sf_dir)


# --- segments state, resume and requests --------------------------------------------------------------------

SEG_DONE = """done_seg AS (
SELECT s.doc_id, s.barcode, s.from_page, s.page_index,
       EXISTS (SELECT 1 FROM v_outputs o WHERE o.doc_id = s.doc_id AND o.page_no = s.from_page AND o.kind = 'pdf')
         AS is_finish
FROM plan s)"""


def _segments_with_state(spark, sf_dir):
    pages = T.pages(spark, sf_dir)
    segs = split.split_plan(pages, docs=T.page_totals(spark, sf_dir))
    pdf = T.outputs(spark, sf_dir, pages).where(F.col("kind") == "pdf") \
           .select("doc_id", F.col("page_no").alias("from_page"), F.lit(True).alias("is_finish"))
    return segs.join(pdf, ["doc_id", "from_page"], "left") \
               .withColumn("is_finish", F.coalesce("is_finish", F.lit(False)))


@job("all_segments_finished", """
SELECT doc_id AS queue_id, bool_and(is_finish) AS finished FROM done_seg GROUP BY doc_id""",
     PV + ("v_outputs",), SPLIT + ",\n" + SEG_DONE)
def all_segments_finished(spark, sf_dir):
    """A bulk record is finished when all its segments are (segment done = first page PDF exists)."""
    s = _segments_with_state(spark, sf_dir).withColumnRenamed("doc_id", "queue_id")
    return complete.all_segments_finished(s)


@job("resume_segments", """
SELECT doc_id, barcode, from_page, page_index FROM done_seg WHERE NOT is_finish""",
     PV + ("v_outputs",), SPLIT + ",\n" + SEG_DONE)
def resume_segments(spark, sf_dir):
    """Segments still to do after a restart: the plan without those whose first page is done."""
    pages = T.pages(spark, sf_dir)
    done = T.outputs(spark, sf_dir, pages).where(F.col("kind") == "pdf").select("doc_id", F.col("page_no").alias("from_page"))
    plan = split.split_plan(pages, docs=T.page_totals(spark, sf_dir))
    return complete.resume_segments(plan, done).select("doc_id", "barcode", "from_page", "page_index")


TASK_LIST = """task AS (SELECT doc_id AS queue_id, from_page // 8 AS list_no, barcode, page_index, is_finish,
  CAST(row_number() OVER (PARTITION BY doc_id, from_page // 8 ORDER BY from_page) - 1 AS INTEGER) AS task_pos FROM done_seg)"""


def _task_lists(spark, sf_dir):
    """Saved task lists as JSON: a record's segments by page, one list for every eight pages."""
    s = _segments_with_state(spark, sf_dir)
    task = F.create_map(F.col("barcode"), F.struct(F.col("page_index").alias("page_index"),
                                                   codes.bool_tf(F.col("is_finish")).alias("is_finish")))
    lists = s.groupBy(F.col("doc_id").alias("queue_id"), F.expr("from_page div 8").alias("list_no")).agg(
        F.array_sort(F.collect_list(F.struct("from_page", F.to_json(task).alias("t")))).alias("ts"))
    return lists.select("queue_id", "list_no", F.concat(F.lit("["), F.array_join(F.transform("ts", lambda x: x["t"]), ","), F.lit("]")).alias("tasks"))


@job("explode_tasks", """
SELECT queue_id, list_no, task_pos, barcode, page_index, is_finish FROM task""",
     PV + ("v_outputs",), SPLIT + ",\n" + SEG_DONE + ",\n" + TASK_LIST)
def explode_tasks(spark, sf_dir):
    """Saved task lists of several entries (JSON) back to rows in list order."""
    return codes.explode_tasks(_task_lists(spark, sf_dir), key=["queue_id", "list_no"]).select(
        "queue_id", "list_no", F.col("task_pos").cast("int").alias("task_pos"), "barcode", "page_index", "is_finish")


@job("find_task", """
SELECT queue_id, list_no, barcode, min(task_pos) AS task_pos, arg_min(page_index, task_pos) AS page_index,
  arg_min(is_finish, task_pos) AS is_finish FROM task GROUP BY queue_id, list_no, barcode""",
     PV + ("v_outputs",), SPLIT + ",\n" + SEG_DONE + ",\n" + TASK_LIST)
def find_task(spark, sf_dir):
    """The first entry of each name in its list (a blank barcode stands for several segments)."""
    tasks = codes.explode_tasks(_task_lists(spark, sf_dir), key=["queue_id", "list_no"])
    return codes.first_task(tasks, key=["queue_id", "list_no"]).select(
        "queue_id", "list_no", "barcode", F.col("task_pos").cast("int").alias("task_pos"), "page_index", "is_finish")


@job("mark_processed_payload", """
SELECT doc_id AS queue_id,
       '{"bookmark_process_queue_id":"' || CAST(doc_id AS VARCHAR) || '","processed":"true"}' AS payload
FROM done_seg GROUP BY doc_id HAVING bool_and(is_finish)""", PV + ("v_outputs",), SPLIT + ",\n" + SEG_DONE)
def mark_processed_payload(spark, sf_dir):
    """K7 + C18: request rows for finished bulk records only."""
    s = _segments_with_state(spark, sf_dir).withColumnRenamed("doc_id", "queue_id")
    return merge.mark_processed_payload(complete.all_segments_finished(s))


PIECE_SQL = f"""md5(s.barcode || '{RUN_TS}') || '_' || CAST(1000000000 + CAST(('0x' ||
       substr(md5(CAST(s.doc_id AS VARCHAR) || '|' || CAST(s.from_page AS VARCHAR)), 1, 8)) AS BIGINT) AS VARCHAR)"""


@job("split_process_payload", """
SELECT s.doc_id AS queue_id, s.from_page,
       '{"priorityID":' || CAST(COALESCE(q.priority, 3) AS VARCHAR) || ',"barcode":"' || s.barcode ||
       '","filename":"' || CAST(q.box_number AS VARCHAR) || '/' || PIECE ||
       '.pdf","source_bookmark_process_queue_id":"' || CAST(s.doc_id AS VARCHAR) || '"}' AS payload
FROM plan s JOIN v_queue q ON q.queue_id = s.doc_id""".replace("PIECE", PIECE_SQL), PV + ("v_queue",), SPLIT)
def split_process_payload(spark, sf_dir):
    """K5: one split request per segment (upload folder = scans/box; the file is the one that C8 names)."""
    segs = plan_false(spark, sf_dir)
    q = flt.decode_flags(T.queue(spark, sf_dir)).select(
        F.col("queue_id"), "priority_id", F.concat(F.lit("/scans/"), F.col("box_number")).alias("upload_dir"))
    x = segs.join(q, segs.doc_id == q.queue_id, "inner").withColumn(
        "piece_name", codes.piece_name(F.col("barcode"), F.lit(RUN_TS), F.col("doc_id"), F.col("from_page")))
    return merge.split_process_payload(x)


@job("piece_name", f"""
SELECT doc_id, from_page,
       md5(barcode || '{RUN_TS}') || '_' ||
       CAST(1000000000 + CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|' || CAST(from_page AS VARCHAR)), 1, 8))
            AS BIGINT) AS VARCHAR) AS piece_name
FROM plan""", PV, SPLIT)
def piece_name(spark, sf_dir):
    """Stable piece file name per segment (md5 of barcode + run time, digits from the key)."""
    segs = plan_false(spark, sf_dir)
    return segs.select("doc_id", "from_page",
                       codes.piece_name(F.col("barcode"), F.lit(RUN_TS), F.col("doc_id"), F.col("from_page"))
                       .alias("piece_name"))


@job("barcode_map", """
SELECT doc_id, CAST(to_json(map_from_entries(list({'k': page_no, 'v': barcode} ORDER BY page_no))) AS VARCHAR) AS barcodes
FROM marks GROUP BY doc_id""", ("v_pages",), MARKS)
def barcode_map(spark, sf_dir):
    """Page -> barcode map of each document, as JSON."""
    m = split.barcode_map(T.pages(spark, sf_dir))
    return m.select("doc_id", F.to_json("barcodes").alias("barcodes"))
