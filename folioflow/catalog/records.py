"""Jobs of the queue-record and non-bulk roads, completeness, images, merges and the folder tool."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes, paths, text
from ..operators import filters as flt
from ..operators import joins
from ..operators.ordering import ordinal_within
from ..plans import complete, images, merge, split
from ..sources import tables as T
from . import job

WS = r"[\t\n\x0B\f\r ]"

# --- records, context and routing ----------------------------------------------------------------------------

REC = f"""rec AS (
SELECT q.*, c.upload_dir, c.pkged,
       COALESCE((COALESCE(c.use_sphinx, false) AND c.sphinx_db = 0) OR c.sphinx_db = 1, false) AS have_sphinx,
       COALESCE(COALESCE(q.keep_barcode_ind, 't') = 't', false) AS keep_barcode,
       COALESCE(q.is_bulk = 't', false) AS bulk,
       COALESCE(q.deliver_searchable_pdf = 't', false) AS deliver_searchable,
       COALESCE(q.has_interactive = 't', false) AS interactive,
       CAST(COALESCE(q.priority, 3) AS INTEGER) AS priority_id
FROM v_queue q JOIN v_context c ON c.run_id = q.run_id WHERE c.upload_dir IS NOT NULL)"""
RV = ("v_queue", "v_context")


def records(spark, sf_dir):
    """Decoded queue records with their run settings."""
    return joins.with_context(flt.decode_flags(T.queue(spark, sf_dir)), T.context(spark, sf_dir))


def non_bulk(spark, sf_dir):
    return records(spark, sf_dir).where(~F.col("bulk"))


@job("read_queue", "SELECT * FROM v_queue", ("v_queue",))
def read_queue(spark, sf_dir):
    """Waiting document records in the M1 shape."""
    return T.queue(spark, sf_dir)


@job("decode_flags", """
SELECT queue_id, COALESCE(COALESCE(keep_barcode_ind, 't') = 't', false) AS keep_barcode,
       COALESCE(is_bulk = 't', false) AS bulk, COALESCE(deliver_searchable_pdf = 't', false) AS deliver_searchable,
       COALESCE(has_interactive = 't', false) AS interactive, CAST(COALESCE(priority, 3) AS INTEGER) AS priority_id
FROM v_queue""", ("v_queue",))
def decode_flags(spark, sf_dir):
    """F2 + F3: flags as booleans, missing priority = 3."""
    return flt.decode_flags(T.queue(spark, sf_dir)).select(
        "queue_id", "keep_barcode", "bulk", "deliver_searchable", "interactive", "priority_id")


@job("split_bulk", """
SELECT queue_id, CASE WHEN is_bulk = 't' THEN 'bulk' ELSE 'non_bulk' END AS road FROM v_queue""", ("v_queue",))
def split_bulk(spark, sf_dir):
    """bulk and non-bulk roads."""
    bulk, other = flt.split_bulk(T.queue(spark, sf_dir))
    return bulk.select("queue_id", F.lit("bulk").alias("road")).unionByName(
        other.select("queue_id", F.lit("non_bulk").alias("road")))


@job("next_records", """
SELECT box_number, queue_id, priority_id FROM (
  SELECT box_number, queue_id, CAST(COALESCE(priority, 3) AS INTEGER) AS priority_id,
         row_number() OVER (PARTITION BY box_number ORDER BY COALESCE(priority, 3), queue_id) AS rn
  FROM v_queue) WHERE rn = 1""", ("v_queue",))
def next_records(spark, sf_dir):
    """O2: the next record to process in each box (priority, then queue id)."""
    q = flt.decode_flags(T.queue(spark, sf_dir)).select("box_number", "queue_id", "priority_id")
    return joins.next_records(q, n=1, group="box_number")


@job("read_context", "SELECT * FROM v_context", ("v_context",))
def read_context(spark, sf_dir):
    """S3: run settings."""
    return T.context(spark, sf_dir)


@job("needs_search_file", """
SELECT run_id, COALESCE((COALESCE(use_sphinx, false) AND sphinx_db = 0) OR sphinx_db = 1, false) AS have_sphinx
FROM v_context""", ("v_context",))
def needs_search_file(spark, sf_dir):
    """whether a run wants search files."""
    c = T.context(spark, sf_dir)
    return c.select("run_id", flt.needs_search_file("use_sphinx", "sphinx_db").alias("have_sphinx"))


@job("with_context", "SELECT queue_id, run_id, upload_dir, pkged, have_sphinx FROM rec", RV, REC)
def with_context(spark, sf_dir):
    """Records with their run settings; runs without upload folder drop their records."""
    return records(spark, sf_dir).select("queue_id", "run_id", "upload_dir", "pkged", "have_sphinx")


@job("route_record", """
SELECT queue_id,
       CASE WHEN deliver_searchable AND NOT interactive THEN 'ocr' ELSE 'split' END AS route,
       (NOT (deliver_searchable AND NOT interactive) AND interactive) AS flatten,
       (NOT (deliver_searchable AND NOT interactive) AND have_sphinx) AS extract_text,
       ((deliver_searchable AND NOT interactive) OR have_sphinx) AS need_temp_image
FROM rec WHERE NOT bulk""", RV, REC)
def route_record(spark, sf_dir):
    """recognition or split road per non-bulk record."""
    return flt.route_record(non_bulk(spark, sf_dir)).select(
        "queue_id", "route", "flatten", "extract_text", "need_temp_image")


def _tf(x: str) -> str:
    return f"CASE WHEN {x} THEN 't' ELSE 'f' END"


@job("job_struct", f"""
SELECT queue_id,
  '{{"profile_id":"' || profile_id || '","image_id":"' || image_id || '","box_number":"' || box_number ||
  '","box_part":"' || box_part || '","bookmark_id":"' || CAST(queue_id AS VARCHAR) ||
  '","have_sphinx":"' || {_tf('have_sphinx')} || '","have_ocr":"' || {_tf('deliver_searchable AND NOT interactive')} ||
  '","has_interactive":"' || {_tf('interactive')} || '","pkged":"' || pkged ||
  '","pdf_name":"' || CAST(queue_id AS VARCHAR) || '"}}' AS state
FROM rec WHERE NOT bulk""", RV, REC)
def job_struct(spark, sf_dir):
    """C17 + K4 payload: saved state of each non-bulk job as JSON."""
    s = codes.job_struct(non_bulk(spark, sf_dir))
    return s.select("queue_id", codes.request_json(F.col("state")).alias("state"))


@job("page_list_payload", """
SELECT r.queue_id,
  '{"bookmark_process_queue_id":"' || CAST(r.queue_id AS VARCHAR) || '","pages":[' ||
  array_to_string(list_transform(range(1, c.num_pages + 1), lambda i: '{"path":"' || r.box_number || '/' || r.box_part ||
     '/' || CAST(r.queue_id AS VARCHAR) || '_' || lpad(CAST(i AS VARCHAR), 6, '0') || '.pdf","version":"' ||
     CAST(i AS VARCHAR) || '"}'), ',') || ']}' AS payload
FROM rec r JOIN v_counts c ON c.doc_id = r.queue_id WHERE NOT r.bulk""", RV + ("v_pages", "v_counts"), REC)
def page_list_payload(spark, sf_dir):
    """A7 + K6: ordered page list request per non-bulk record."""
    r = non_bulk(spark, sf_dir).select("queue_id", "box_number", "box_part",
                                       F.col("queue_id").cast("string").alias("pdf_name"))
    c = T.page_totals(spark, sf_dir).withColumnRenamed("doc_id", "queue_id")
    return merge.add_pages_payload(r.join(c, "queue_id", "inner"))


# --- completeness and resume ---------------------------------------------------------------------------------

KIND_COUNTS = """kc AS (SELECT doc_id, count_if(kind = 'thumbs') AS n_thumbs, count_if(kind = 'png') AS n_png,
              count_if(kind = 'xml') AS n_xml, count_if(kind = 'pdf') AS n_pdf, count_if(kind = 'txt') AS n_txt,
              count_if(kind IN ('source', 'state', 'manifest')) AS n_main_extra
       FROM v_outputs GROUP BY doc_id)"""
A2_DOCS = """a2docs AS (
SELECT r.queue_id AS doc_id, c.num_pages, (r.deliver_searchable AND NOT r.interactive) AS have_ocr, r.have_sphinx
FROM rec r JOIN v_counts c ON c.doc_id = r.queue_id WHERE NOT r.bulk),
""" + KIND_COUNTS


def _a2_docs(spark, sf_dir, pages):
    r = non_bulk(spark, sf_dir)
    c = T.page_totals(spark, sf_dir)
    return r.select(F.col("queue_id").alias("doc_id"),
                    (F.col("deliver_searchable") & ~F.col("interactive")).alias("have_ocr"), "have_sphinx") \
            .join(c, "doc_id", "inner")


@job("document_complete", """
SELECT d.doc_id,
  COALESCE(COALESCE(k.n_pdf, 0) + COALESCE(k.n_main_extra, 0) = CASE WHEN d.have_ocr THEN d.num_pages + 3
                                                                   ELSE d.num_pages + 2 END
     AND COALESCE(k.n_thumbs, 0) = d.num_pages AND COALESCE(k.n_png, 0) = d.num_pages
     AND (NOT d.have_sphinx OR COALESCE(k.n_xml, 0) = d.num_pages), false) AS complete
FROM a2docs d LEFT JOIN kc k ON k.doc_id = d.doc_id""", RV + ("v_pages", "v_counts", "v_outputs"), REC + ",\n" + A2_DOCS)
def document_complete(spark, sf_dir):
    """A2: every wanted artifact of a non-bulk document exists."""
    pages = T.pages(spark, sf_dir)
    return complete.document_complete(T.outputs(spark, sf_dir, pages), _a2_docs(spark, sf_dir, pages))


@job("page_outputs_complete", """
SELECT c.doc_id, COALESCE(COALESCE(k.n_pdf, 0) = c.num_pages AND COALESCE(k.n_txt, 0) = c.num_pages, false) AS complete
FROM v_counts c LEFT JOIN kc k ON k.doc_id = c.doc_id""", ("v_pages", "v_counts", "v_outputs"),
     KIND_COUNTS)
def page_outputs_complete(spark, sf_dir):
    """A3: folder-tool check for output type PDF-TEXT (each kind counted on its own)."""
    pages = T.pages(spark, sf_dir)
    kinds = ["pdf", "txt"]
    return complete.page_outputs_complete(T.outputs(spark, sf_dir, pages), T.page_totals(spark, sf_dir), kinds)


@job("batch_complete", """
SELECT k.kind, (SELECT count(*) FROM v_counts) AS n_inputs, COALESCE(o.n, 0) AS n_outputs,
       (SELECT count(*) FROM v_counts) = COALESCE(o.n, 0) AS complete
FROM (VALUES ('pdf'), ('txt'), ('xml')) k(kind)
LEFT JOIN (SELECT kind, count(DISTINCT doc_id) AS n FROM v_outputs GROUP BY kind) o ON o.kind = k.kind""",
     ("v_pages", "v_counts", "v_outputs"))
def batch_complete(spark, sf_dir):
    """A4: per wanted kind, one merged output per input document."""
    pages = T.pages(spark, sf_dir)
    inputs = T.page_totals(spark, sf_dir)
    outs = T.outputs(spark, sf_dir, pages).select("doc_id", "kind").distinct()
    return complete.batch_complete(inputs, outs, ["pdf", "txt", "xml"])


@job("first_missing_page", """
SELECT p.doc_id, CAST(min(p.page_no) AS INTEGER) AS first_missing FROM v_pages p
WHERE NOT EXISTS (SELECT 1 FROM v_outputs o WHERE o.doc_id = p.doc_id AND o.page_no = p.page_no AND o.kind = 'pdf')
GROUP BY p.doc_id""", ("v_pages", "v_outputs"))
def first_missing_page(spark, sf_dir):
    """A10: lowest page without its page PDF."""
    pages = T.pages(spark, sf_dir)
    return complete.first_missing_page(pages, T.outputs(spark, sf_dir, pages), "pdf")


@job("redo_pages", """
SELECT p.doc_id, p.page_no FROM v_pages p JOIN (
  SELECT p.doc_id, min(p.page_no) AS fm FROM v_pages p
  WHERE NOT EXISTS (SELECT 1 FROM v_outputs o WHERE o.doc_id = p.doc_id AND o.page_no = p.page_no AND o.kind = 'pdf')
  GROUP BY p.doc_id) f ON f.doc_id = p.doc_id
WHERE p.page_no >= f.fm""", ("v_pages", "v_outputs"))
def redo_pages(spark, sf_dir):
    """Pages to redo after a restart: from the first missing page to the end."""
    pages = T.pages(spark, sf_dir)
    return complete.redo_pages(pages, T.outputs(spark, sf_dir, pages), "pdf")


@job("resume_route", """
SELECT s.doc_id, s.have_ocr, s.have_sphinx,
       CASE WHEN s.have_ocr THEN 'pdf' WHEN s.have_sphinx THEN 'txt' END AS missing_kind,
       CAST(CASE WHEN s.have_ocr THEN fp.fm WHEN s.have_sphinx THEN ft.fm END AS INTEGER) AS first_missing
FROM (SELECT r.queue_id AS doc_id,
             (t.doc_id IS NOT NULL AND r.deliver_searchable AND NOT r.interactive) AS have_ocr,
             (t.doc_id IS NOT NULL AND r.have_sphinx) AS have_sphinx
      FROM rec r LEFT JOIN (SELECT DISTINCT doc_id FROM v_outputs WHERE kind = 'temp') t ON t.doc_id = r.queue_id
      WHERE NOT r.bulk) s
LEFT JOIN (SELECT p.doc_id, min(p.page_no) AS fm FROM v_pages p WHERE NOT EXISTS (SELECT 1 FROM v_outputs o
           WHERE o.doc_id = p.doc_id AND o.page_no = p.page_no AND o.kind = 'pdf') GROUP BY p.doc_id) fp
  ON fp.doc_id = s.doc_id
LEFT JOIN (SELECT p.doc_id, min(p.page_no) AS fm FROM v_pages p WHERE NOT EXISTS (SELECT 1 FROM v_outputs o
           WHERE o.doc_id = p.doc_id AND o.page_no = p.page_no AND o.kind = 'txt') GROUP BY p.doc_id) ft
  ON ft.doc_id = s.doc_id""", RV + ("v_pages", "v_outputs"), REC)
def resume_route(spark, sf_dir):
    """what each saved non-bulk job must redo after a crash."""
    st = codes.job_struct(non_bulk(spark, sf_dir)).select(
        F.col("queue_id").alias("doc_id"), "state.have_ocr", "state.have_sphinx")
    pages = T.pages(spark, sf_dir)
    return complete.resume_route(st, T.outputs(spark, sf_dir, pages), pages)


@job("needs_page_list", """
SELECT queue_id FROM v_queue
WHERE COALESCE(CASE WHEN queue_id % 4 = 0 THEN 't' WHEN queue_id % 4 = 1 THEN 'f' END, 'f') = 'f'""", ("v_queue",))
def needs_page_list(spark, sf_dir):
    """saved jobs whose page list was never registered."""
    q = T.queue(spark, sf_dir)
    k = F.col("queue_id")
    st = q.select("queue_id", F.when(k % 4 == 0, "t").when(k % 4 == 1, "f").alias("add_pages"))
    return flt.needs_page_list(st).select("queue_id")


# --- images ----------------------------------------------------------------------------------------------------

@job("color_pages", "SELECT doc_id, page_no FROM v_pages WHERE ink_c > 0 OR ink_m > 0 OR ink_y > 0", ("v_pages",))
def color_pages(spark, sf_dir):
    """pages with any C, M or Y ink above 0."""
    return flt.color_pages(T.pages(spark, sf_dir))


COLOR_DEV = """cd AS (
SELECT c.doc_id, CAST(COALESCE(x.cp, 0) AS INTEGER) AS color_pages,
       CASE WHEN COALESCE(x.cp, 0) / c.num_pages < 0.5 THEN 'pnggray' ELSE 'png16m' END AS device
FROM v_counts c LEFT JOIN (SELECT doc_id, count_if(ink_c > 0 OR ink_m > 0 OR ink_y > 0) AS cp
                           FROM v_pages GROUP BY doc_id) x ON x.doc_id = c.doc_id
WHERE c.num_pages > 0)"""


@job("color_device", "SELECT * FROM cd", ("v_pages", "v_counts"), COLOR_DEV)
def color_device(spark, sf_dir):
    """A1: grey rendering unless at least half the pages have colour."""
    pages = T.pages(spark, sf_dir)
    return images.color_device(T.page_inks(spark, sf_dir))


@job("image_plan", """
SELECT p.doc_id, p.page_no, cd.device, (cd.device = 'pnggray' AND (p.ink_c > 0 OR p.ink_m > 0 OR p.ink_y > 0))
       AS redo_color
FROM v_pages p JOIN cd ON cd.doc_id = p.doc_id""", ("v_pages", "v_counts"), COLOR_DEV)
def image_plan(spark, sf_dir):
    """C20 + J10: device per page and whether a grey document redoes a page in colour."""
    pages = T.pages(spark, sf_dir)
    return images.image_plan(pages, images.color_device(T.page_inks(spark, sf_dir)))


@job("oversized_pages", """
SELECT doc_id, page_no, COALESCE(width, 0) > 1800 AS oversized,
       CASE WHEN COALESCE(width, 0) > 1800 THEN 'temp/oops/dummy.png'
            ELSE 'png/' || CAST(doc_id AS VARCHAR) || '_' || lpad(CAST(page_no AS VARCHAR), 6, '0') || '.png' END
         AS png_path,
       CASE WHEN COALESCE(width, 0) > 1800 THEN 'temp/oops/dummy.png'
            ELSE 'thumbs/' || CAST(doc_id AS VARCHAR) || '_' || lpad(CAST(page_no AS VARCHAR), 6, '0') || '.png' END
         AS thumb_path
FROM v_pages""", ("v_pages",))
def oversized_pages(spark, sf_dir):
    """placeholder image for every page wider than 1800 points."""
    return flt.oversized_pages(T.pages(spark, sf_dir))


ORIENT = f"""rep AS (
SELECT doc_id, page_no,
       'Page number: 0' || chr(10) || 'Orientation in degrees: ' ||
       CASE WHEN returnflag = 'R' THEN '180' WHEN returnflag = 'A' THEN ' 90 ' ELSE 'x' END ||
       chr(10) || 'Rotate: 0' || chr(10) AS text
FROM v_pages),
deg AS (
SELECT doc_id, page_no,
       COALESCE(CASE WHEN regexp_matches(r, '^[+-]?[0-9]+$') THEN TRY_CAST(r AS INTEGER) END, 0) AS degrees
FROM (SELECT doc_id, page_no,
             regexp_replace(regexp_extract(text, 'Orientation in degrees:([^\\n]*)', 1), '^{WS}+|{WS}+$', '', 'g') AS r
      FROM rep))"""


def _orientation(spark, sf_dir):
    p = T.pages(spark, sf_dir)
    deg = F.when(F.col("returnflag") == "R", "180").when(F.col("returnflag") == "A", " 90 ").otherwise("x")
    rep = p.select("doc_id", "page_no", F.concat(F.lit("Page number: 0\nOrientation in degrees: "), deg,
                                                 F.lit("\nRotate: 0\n")).alias("text"))
    return images.parse_orientation(rep)


@job("read_orientation_report", "SELECT * FROM deg", ("v_pages",), ORIENT)
def read_orientation_report(spark, sf_dir):
    """Degrees from orientation reports (unparsable -> 0)."""
    return _orientation(spark, sf_dir)


@job("upside_down_pages", "SELECT doc_id, page_no, 180 AS rotate FROM deg WHERE degrees = 180", ("v_pages",), ORIENT)
def upside_down_pages(spark, sf_dir):
    """pages to rotate by 180 degrees."""
    return flt.upside_down_pages(_orientation(spark, sf_dir))


@job("read_ink_report", """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS INTEGER) AS page_idx,
       ink[1] AS c, ink[2] AS m, ink[3] AS y
FROM (SELECT doc_id, line_no,
             list_transform(list_filter(string_split(line, ' '), lambda t: TRY_CAST(t AS DOUBLE) IS NOT NULL),
                            lambda t: CAST(t AS DOUBLE)) AS ink
      FROM (SELECT doc_id, 2 * page_no AS line_no,
                   ' ' || CAST(ink_c AS VARCHAR) || ' ' || CAST(ink_m AS VARCHAR) || ' ' || CAST(ink_y AS VARCHAR) ||
                   ' ' || CAST(ink_k AS VARCHAR) || ' CMYK OK' AS line FROM v_pages
            UNION ALL SELECT doc_id, 2 * page_no - 1, 'Page ' || CAST(page_no AS VARCHAR) FROM v_pages)
      WHERE instr(line, 'CMYK OK') > 0)""", ("v_pages",))
def read_ink_report(spark, sf_dir):
    """S4 + C11: per-page ink from report lines (header lines skipped; index by position)."""
    p = T.pages(spark, sf_dir)
    ink = F.concat_ws(" ", F.lit(""), *[F.col("ink")[i].cast("string") for i in range(4)], F.lit("CMYK OK"))
    # two lines per page from one read: a header and the page's ink
    line = lambda at, text: F.struct(at.cast("int").alias("line_no"), text.alias("line"))
    lines = p.select("doc_id", F.inline(F.array(
        line(F.col("page_no") * 2 - 1, F.concat(F.lit("Page "), F.col("page_no").cast("string"))), line(F.col("page_no") * 2, ink))))
    r = images.parse_ink_lines(lines)
    return r.select("doc_id", "page_idx", F.col("ink")[0].alias("c"), F.col("ink")[1].alias("m"),
                    F.col("ink")[2].alias("y"))


# --- merges ----------------------------------------------------------------------------------------------------

@job("merge_page_text", "SELECT doc_id, string_agg(text, '' ORDER BY page_no) AS text FROM v_page_text "
     "WHERE text IS NOT NULL GROUP BY doc_id", ("v_page_text",))
def merge_page_text(spark, sf_dir):
    """A5 + O4: page texts of each document in page order."""
    return merge.merge_page_text(T.page_text(spark, sf_dir))


@job("text_chunks", """
SELECT doc_id, chunk, CAST(coalesce(sum(n_bytes) OVER (PARTITION BY doc_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
  n_bytes, text
FROM (SELECT doc_id, chunk, strlen(text) AS n_bytes, text
      FROM (SELECT doc_id, chunk, CASE WHEN row_number() OVER (PARTITION BY doc_id ORDER BY chunk) > 1 THEN chr(10) ELSE '' END || text AS text
            FROM (SELECT doc_id, CAST((page_no - 1) // 4 AS BIGINT) AS chunk, string_agg(text, chr(10) ORDER BY page_no) AS text
                  FROM v_page_text WHERE text IS NOT NULL GROUP BY ALL)))""", ("v_page_text",))
def text_chunks(spark, sf_dir):
    """A5 as ordered chunks of four pages with their byte offsets."""
    return merge.text_chunks(T.page_text(spark, sf_dir), "\n", block_pages=4)


@job("read_range", """
SELECT doc_id, substr(hex(encode(string_agg(text, chr(10) ORDER BY page_no))), 2 * (doc_id % 50) + 1, 2 * (doc_id % 300)) AS bytes
FROM v_page_text WHERE text IS NOT NULL GROUP BY doc_id
HAVING doc_id % 300 > 0 AND strlen(string_agg(text, chr(10))) > doc_id % 50""", ("v_page_text",))
def read_range(spark, sf_dir):
    """A5: a range of bytes of every document, read from the chunks that hold it."""
    chunks = merge.text_chunks(T.page_text(spark, sf_dir), "\n", block_pages=4)
    wanted = T.page_text(spark, sf_dir).select("doc_id").distinct().select(
        "doc_id", (F.col("doc_id") % 50).alias("from_byte"), (F.col("doc_id") % 50 + F.col("doc_id") % 300).alias("to_byte"))
    parts = merge.read_range(chunks, wanted)
    return parts.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", F.hex("bytes").alias("h")))),
                                                                lambda x: x["h"]), "").alias("bytes"))


@job("join_page_text", f"""
SELECT doc_id, regexp_replace(string_agg(text, chr(10) || chr(10) ORDER BY page_no), '^{WS}+|{WS}+$', '', 'g') AS text
FROM v_page_text WHERE text IS NOT NULL GROUP BY doc_id""", ("v_page_text",))
def join_page_text(spark, sf_dir):
    """Page texts joined with a blank line, trimmed."""
    return merge.join_page_text(T.page_text(spark, sf_dir))


def _esc_sql(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _page_xml(spark, sf_dir):
    pt = T.page_text(spark, sf_dir)
    esc = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                    F.lit(">"), F.lit("&gt;"))
    xml = F.concat(F.lit('<page no="0" doc="'), F.col("doc_id").cast("string"), F.lit('"><img src="tmp/'),
                   F.col("doc_id").cast("string"), F.lit('_1.png"/><text>'), esc, F.lit("</text></page>"))
    return pt.select("doc_id", "page_no", xml.alias("xml"))


PAGE_XML = f"""px AS (
SELECT doc_id, page_no,
       '<page no="0" doc="' || CAST(doc_id AS VARCHAR) || '"><img src="tmp/' || CAST(doc_id AS VARCHAR) ||
       '_1.png"/><text>' || {_esc_sql('text')} || '</text></page>' AS xml
FROM v_page_text),
rx AS (
SELECT doc_id, page_no,
       CASE WHEN page_no = 1
            THEN replace(replace(xml, 'no="0"', 'no="' || CAST(page_no - 1 AS VARCHAR) || '"'),
                         'tmp/' || CAST(doc_id AS VARCHAR) || '_1.png', '/in/' || CAST(doc_id AS VARCHAR) || '.pdf')
            ELSE replace(xml, 'no="0"', 'no="' || CAST(page_no - 1 AS VARCHAR) || '"') END AS xml
FROM px)"""


def _renumbered(spark, sf_dir):
    x = _page_xml(spark, sf_dir)
    tmp = F.concat(F.lit("tmp/"), F.col("doc_id").cast("string"), F.lit("_1.png"))
    src = F.concat(F.lit("/in/"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    return x.select("doc_id", "page_no", paths.renumber_xml_page("xml", "page_no", tmp, src).alias("xml"))


@job("renumber_xml_page", "SELECT * FROM rx", ("v_page_text",), PAGE_XML)
def renumber_xml_page(spark, sf_dir):
    """Page XML numbered from 0; page 1 points at the source file."""
    return _renumbered(spark, sf_dir)


# scanned pages as recognisers write them: with declaration and comment, DOCTYPE, an empty root, or cut off
SCANNED = """sx AS (
SELECT doc_id, page_no, xml AS good,
       CASE WHEN (doc_id + page_no) % 11 = 5 THEN left(xml, 20)
            WHEN (doc_id + page_no) % 7 = 3 THEN '<page no="' || CAST(page_no - 1 AS VARCHAR) || '" />'
            WHEN (doc_id + page_no) % 5 = 1 THEN '<?xml version="1.0"?>' || chr(10) || '<!-- scan > -->' || xml || chr(10)
            WHEN (doc_id + page_no) % 5 = 2 THEN '<!DOCTYPE page [<!ENTITY a "b">]>' || xml || '<!-- end -->' ELSE xml END AS xml,
       (doc_id + page_no) % 11 = 5 AS bad, (doc_id + page_no) % 11 <> 5 AND (doc_id + page_no) % 7 = 3 AS bare
FROM rx WHERE xml IS NOT NULL)"""


def _scanned(spark, sf_dir):
    x = _renumbered(spark, sf_dir).where(F.col("xml").isNotNull())
    k, xml = F.col("doc_id") + F.col("page_no"), F.col("xml")
    return x.select("doc_id", "page_no", F.when(k % 11 == 5, F.left(xml, F.lit(20)))
                    .when(k % 7 == 3, F.concat(F.lit('<page no="'), (F.col("page_no") - 1).cast("string"), F.lit('" />')))
                    .when(k % 5 == 1, F.concat(F.lit('<?xml version="1.0"?>\n<!-- scan > -->'), xml, F.lit("\n")))
                    .when(k % 5 == 2, F.concat(F.lit('<!DOCTYPE page [<!ENTITY a "b">]>'), xml, F.lit("<!-- end -->")))
                    .otherwise(xml).alias("xml"))


@job("merge_page_xml", """
SELECT doc_id,
       CASE WHEN bool_or(NOT bad) THEN
         min_by(CASE WHEN bare THEN '<page no="' || CAST(page_no - 1 AS VARCHAR) || '">'
                     ELSE regexp_extract(good, '^(<page[^>]*>)', 1) END, page_no) FILTER (WHERE NOT bad) ||
         COALESCE(string_agg(CASE WHEN bare THEN '' ELSE regexp_extract(good, '(?s)^<page[^>]*>(.*)</page>$', 1) END, ''
                  ORDER BY page_no) FILTER (WHERE NOT bad), '') || '</page>' END AS xml,
       count_if(bad) AS bad_pages
FROM sx GROUP BY doc_id""", ("v_page_text",), PAGE_XML + ",\n" + SCANNED)
def merge_page_xml(spark, sf_dir):
    """The first good page's root with the children of all pages appended in order; broken pages are counted."""
    return merge.merge_page_xml(_scanned(spark, sf_dir))


@job("xml_page_errors", "SELECT doc_id, page_no, xml FROM sx WHERE bad", ("v_page_text",), PAGE_XML + ",\n" + SCANNED)
def xml_page_errors(spark, sf_dir):
    """Pages whose XML cannot be merged."""
    return merge.xml_page_errors(_scanned(spark, sf_dir))


@job("search_document", """
SELECT doc_id, page_no, '<h1></h1><h2></h2><h3></h3><h4>' || replace(COALESCE(text, ''), chr(10), ' ') || '</h4>'
       AS body
FROM v_page_text""", ("v_page_text",))
def search_document(spark, sf_dir):
    """Search-index document per page."""
    pt = T.page_text(spark, sf_dir)
    return pt.select("doc_id", "page_no", text.search_document("text").alias("body"))


@job("text_to_search_file", """
SELECT t.doc_id, t.page_no, CAST(length(t.text) AS INTEGER) AS n_chars FROM v_page_text t
JOIN v_outputs o ON o.doc_id = t.doc_id AND o.page_no = t.page_no AND o.kind = 'xml'""",
     ("v_page_text", "v_pages", "v_outputs"))
def text_to_search_file(spark, sf_dir):
    """Page texts that have a search-file slot."""
    slots = T.outputs(spark, sf_dir, T.pages(spark, sf_dir)).where(F.col("kind") == "xml").select("doc_id", "page_no")
    t = T.page_text(spark, sf_dir).select("doc_id", "page_no", F.length("text").alias("n_chars"))
    return joins.text_to_search_file(t, slots)


# --- page listings -----------------------------------------------------------------------------------------------

@job("explode_pages", "SELECT doc_id, CAST(unnest(range(1, num_pages + 1)) AS INTEGER) AS page_no FROM v_counts "
     "WHERE num_pages > 0", ("v_pages", "v_counts"))
def explode_pages(spark, sf_dir):
    """One row per page from a page count."""
    c = T.page_totals(spark, sf_dir).where(F.col("num_pages") > 0)
    return split.explode_range(c, F.lit(1), F.col("num_pages"), "page_no").select("doc_id", "page_no")


@job("split_pages_to_rows", """
SELECT doc_id, page_no, CAST(doc_id AS VARCHAR) || '_' || lpad(CAST(page_no AS VARCHAR), 6, '0') || '.pdf' AS piece_path
FROM (SELECT doc_id, CAST(unnest(range(1, num_pages + 1)) AS INTEGER) AS page_no FROM v_counts WHERE num_pages > 0)""",
     ("v_pages", "v_counts"))
def split_pages_to_rows(spark, sf_dir):
    """O6 + C5: single-page pieces with their names."""
    c = T.page_totals(spark, sf_dir).where(F.col("num_pages") > 0)
    x = split.explode_range(c, F.lit(1), F.col("num_pages"), "page_no")
    return x.select("doc_id", "page_no", paths.page_file_name(F.col("doc_id").cast("string"), "page_no", "pdf")
                    .alias("piece_path"))


@job("page_file_name", """
SELECT doc_id, page_no, CAST(doc_id AS VARCHAR) || '_' || lpad(CAST(page_no AS VARCHAR), 6, '0') || '.png' AS file_name
FROM v_pages""", ("v_pages",))
def page_file_name(spark, sf_dir):
    """Page image name ``{stem}_{page:06d}.png``."""
    p = T.pages(spark, sf_dir)
    return p.select("doc_id", "page_no", paths.page_file_name(F.col("doc_id").cast("string"), "page_no", "png")
                    .alias("file_name"))


@job("pages_in_name_order", """
SELECT doc_id, name, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY name) AS INTEGER) AS position
FROM (SELECT doc_id, CAST(doc_id AS VARCHAR) || '_' || lpad(CAST(page_no AS VARCHAR), 6, '0') || '.pdf' AS name
      FROM v_outputs WHERE kind = 'pdf')""", ("v_pages", "v_outputs"))
def pages_in_name_order(spark, sf_dir):
    """Page files ordered by name (zero padding makes it page order)."""
    o = T.outputs(spark, sf_dir, T.pages(spark, sf_dir)).where(F.col("kind") == "pdf")
    named = o.select("doc_id", paths.page_file_name(F.col("doc_id").cast("string"), "page_no", "pdf").alias("name"))
    # blocks by the document's prefix and the first three digits of the page
    block = F.substring(F.col("name"), F.lit(1), F.length(F.col("doc_id").cast("string")) + 4)
    return ordinal_within(named, "doc_id", ["name"], name="position", block=block).select("doc_id", "name", "position")


@job("without_excluded", "SELECT doc_id, kind, page_no FROM v_outputs WHERE kind NOT IN ('temp', 'state')",
     ("v_pages", "v_outputs"))
def without_excluded(spark, sf_dir):
    """U4: package listing without the temp folder and the job state file."""
    return joins.without_excluded(T.outputs(spark, sf_dir, T.pages(spark, sf_dir)))


@job("drop_source_document", """
SELECT doc_id, path FROM (
  SELECT doc_id, CASE WHEN kind = 'source' THEN CAST(doc_id AS VARCHAR) || '.pdf'
         ELSE CAST(doc_id AS VARCHAR) || '_' || lpad(CAST(page_no AS VARCHAR), 6, '0') || '.pdf' END AS path
  FROM v_outputs WHERE kind IN ('pdf', 'source'))
WHERE path <> CAST(doc_id AS VARCHAR) || '.pdf'""", ("v_pages", "v_outputs"))
def drop_source_document(spark, sf_dir):
    """PDF files of a job folder except the original document."""
    o = T.outputs(spark, sf_dir, T.pages(spark, sf_dir)).where(F.col("kind").isin("pdf", "source"))
    stem = F.col("doc_id").cast("string")
    path = F.when(F.col("kind") == "source", F.concat(stem, F.lit(".pdf"))).otherwise(
        paths.page_file_name(stem, "page_no", "pdf"))
    x = o.select("doc_id", path.alias("path"), F.concat(stem, F.lit(".pdf")).alias("source_path"))
    return flt.drop_source_document(x).select("doc_id", "path")


@job("suspect_small_files", """
SELECT doc_id, page_no, length FROM (
  SELECT o.doc_id, o.page_no, CAST(floor(p.width) AS BIGINT) % 40 AS length
  FROM v_outputs o JOIN v_pages p ON p.doc_id = o.doc_id AND p.page_no = o.page_no WHERE o.kind = 'png')
WHERE length < 12""", ("v_pages", "v_outputs"))
def suspect_small_files(spark, sf_dir):
    """page images too small to be complete (under 12 bytes)."""
    pages = T.pages(spark, sf_dir)
    o = T.outputs(spark, sf_dir, pages).where(F.col("kind") == "png").select("doc_id", "page_no")
    x = o.join(pages.select("doc_id", "page_no", (F.floor("width").cast("long") % 40).alias("length")),
               ["doc_id", "page_no"], "inner")
    return flt.suspect_small_files(x)


# --- folder tool ---------------------------------------------------------------------------------------------------

FILES = f"""files AS (
SELECT d.doc_id, d.source AS sub_dir, 'd' || CAST(d.doc_id AS VARCHAR) AS stem,
       CAST(floor(d.n_chars / 2000) AS INTEGER) AS num_pages, m.code
FROM documents d JOIN (
  SELECT doc_id, CASE WHEN NOT regexp_matches(t, '[^\\t\\n\\x0B\\f\\r ]') THEN 0
                      WHEN (length(t) - length(replace(t, '@', ''))) / length(t) > 0.5 THEN 0 ELSE 1 END AS code
  FROM (SELECT doc_id, replace(regexp_replace(COALESCE(text, ''), '[^A-Za-z ]+ ', '@', 'g'), ' ', '') AS t
        FROM v_docs_mangled)) m ON m.doc_id = d.doc_id),
outs AS (
SELECT d.source AS sub_dir, 'd' || CAST(l.doc_id AS VARCHAR) AS stem, 'pdf' AS kind
FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE l.quality = 1
UNION ALL
SELECT d.source, 'd' || CAST(l.doc_id AS VARCHAR), 'txt'
FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE l.toxic = 0),
want AS (SELECT f.sub_dir, f.stem, k.kind FROM files f CROSS JOIN (VALUES ('pdf'), ('txt')) k(kind)),
miss AS (SELECT * FROM want w WHERE NOT EXISTS (SELECT 1 FROM outs o WHERE o.sub_dir = w.sub_dir AND o.stem = w.stem
                                                AND o.kind = w.kind))"""
FV = ("v_docs_mangled",)


def _files(spark, sf_dir):
    d = T.docs(spark, sf_dir, "mangled", keep=("source", "n_chars"))
    return d.select("doc_id", F.col("source").alias("sub_dir"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("stem"),
                    F.floor(F.col("n_chars") / 2000).cast("int").alias("num_pages"), text.searchable_code("text").alias("code"))


def _outs(spark, sf_dir):
    lab = T.table(spark, sf_dir, "labels")
    d = T.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("sub_dir"))
    x = lab.join(d, "doc_id").select("sub_dir", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("stem"),
                                     "quality", "toxic")
    return x.where("quality = 1").select("sub_dir", "stem", F.lit("pdf").alias("kind")).unionByName(
        x.where("toxic = 0").select("sub_dir", "stem", F.lit("txt").alias("kind")))


KINDS = ["pdf", "txt"]


@job("pending_files", """
SELECT doc_id, sub_dir, stem FROM files f WHERE EXISTS (SELECT 1 FROM miss m WHERE m.sub_dir = f.sub_dir
                                                        AND m.stem = f.stem)""", FV, FILES)
def pending_files(spark, sf_dir):
    """Input files missing a wanted output (PDF-TEXT) at the mirrored place."""
    return complete.pending_files(_files(spark, sf_dir), _outs(spark, sf_dir), KINDS).select("doc_id", "sub_dir", "stem")


@job("done_files", """
SELECT doc_id, sub_dir, stem FROM files f WHERE NOT EXISTS (SELECT 1 FROM miss m WHERE m.sub_dir = f.sub_dir
                                                            AND m.stem = f.stem)""", FV, FILES)
def done_files(spark, sf_dir):
    """Input files whose wanted outputs all exist (skipped)."""
    return complete.done_files(_files(spark, sf_dir), _outs(spark, sf_dir), KINDS).select("doc_id", "sub_dir", "stem")


@job("missing_kinds", "SELECT sub_dir, stem, kind FROM miss", FV, FILES)
def missing_kinds(spark, sf_dir):
    """Wanted output kinds not present per input file."""
    return complete.missing_kinds(_files(spark, sf_dir), _outs(spark, sf_dir), KINDS)


ROUTE_SQL = """SELECT f.doc_id,
  CASE WHEN COALESCE(f.num_pages, 0) = 0 THEN 'unreadable'
       WHEN NOT EXISTS (SELECT 1 FROM miss m WHERE m.sub_dir = f.sub_dir AND m.stem = f.stem) THEN 'done'
       WHEN f.code = 0 THEN 'ocr_pages' ELSE 'pass_through' END AS route
FROM files f"""


def _routed(spark, sf_dir):
    return flt.route_file(complete.file_status(_files(spark, sf_dir), _outs(spark, sf_dir), KINDS), F.col("done"))


@job("route_file", ROUTE_SQL, FV, FILES)
def route_file(spark, sf_dir):
    """folder-tool road per input file."""
    return _routed(spark, sf_dir).select("doc_id", "route")


@job("all_outputs", f"""
SELECT doc_id, kind, road FROM (
  SELECT r.doc_id, k.kind, 'pass_through' AS road FROM ({ROUTE_SQL}) r CROSS JOIN (VALUES ('pdf'), ('txt')) k(kind)
  WHERE r.route = 'pass_through'
  UNION ALL
  SELECT r.doc_id, k.kind, 'ocr' FROM ({ROUTE_SQL}) r CROSS JOIN (VALUES ('pdf'), ('txt')) k(kind)
  WHERE r.route = 'ocr_pages')""", FV, FILES)
def all_outputs(spark, sf_dir):
    """Outputs of the pass-through and recognition roads in one result."""
    r = _routed(spark, sf_dir)
    kinds = F.explode(F.array(*[F.lit(k) for k in KINDS])).alias("kind")
    road = F.when(F.col("route") == "pass_through", "pass_through").when(F.col("route") == "ocr_pages", "ocr")
    return r.where(road.isNotNull()).select("doc_id", kinds, road.alias("road"))
