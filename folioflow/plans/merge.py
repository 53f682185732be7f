"""Ordered merges and request payloads.

Merging pages of a document is done in two levels so a document with very
many pages is not gathered by one task: pages are first joined inside blocks
of ``block_pages`` consecutive pages (work spread over many tasks), then the
block texts are joined per document.  The result of a document is one value by
definition; ``merge_page_text_blocks`` stops at the block level when even that
value would be too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import request_envelope
from ..functions.text import strip_ws


def _ordered_join(pos: Column, val: Column, sep: str) -> Column:
    """Aggregate: ``val`` joined by ``sep`` in ``pos`` order (collect_list has no order by itself)."""
    arr = F.array_sort(F.collect_list(F.struct(pos.alias("p"), val.alias("v"))))
    return F.array_join(F.transform(arr, lambda s: s["v"]), sep)


def merge_page_text_blocks(pages: DataFrame, sep: str = "", block_pages: int = 1024,
                           text_col: str = "text") -> DataFrame:
    """Level 1 of A5: (doc_id, block, text) with pages joined inside each block."""
    blk = F.floor((F.col("page_no") - 1) / F.lit(block_pages)).cast("long")
    return (pages.where(F.col(text_col).isNotNull())
                 .groupBy("doc_id", blk.alias("block"))
                 .agg(_ordered_join(F.col("page_no"), F.col(text_col), sep).alias("text")))


def merge_page_text(pages: DataFrame, sep: str = "", block_pages: int = 1024,
                    text_col: str = "text") -> DataFrame:
    """A5: document text = page texts in page order joined by ``sep``.

    The source wrote the printed form of a Python line list and ran pages
    together with no separator; here real text is written and the separator
    is a parameter (default none).
    """
    blocks = merge_page_text_blocks(pages, sep, block_pages, text_col)
    return blocks.groupBy("doc_id").agg(_ordered_join(F.col("block"), F.col("text"), sep).alias("text"))


def text_chunks(pages: DataFrame, sep: str = "", block_pages: int = 1024, text_col: str = "text") -> DataFrame:
    """A5 as ordered chunks: (doc_id, chunk, start, n_bytes, text); no document is gathered in one cell.

    ``text`` are the pages of a block joined by ``sep``, with ``sep`` before it
    if it is not the document's first; ``start`` is the number of UTF-8 bytes of
    the chunks before it, so the chunks in order of ``start`` are the document.
    """
    blocks = merge_page_text_blocks(pages, sep, block_pages, text_col)
    order = Window.partitionBy("doc_id").orderBy("block")           # one row per block_pages pages
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    text = F.concat(F.when(F.row_number().over(order) > 1, sep).otherwise(""), "text")
    sized = blocks.withColumn("text", text).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return sized.select("doc_id", F.col("block").alias("chunk"), F.coalesce(F.sum("n_bytes").over(before), F.lit(0)).alias("start"),
                        "n_bytes", "text")


def read_range(chunks: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes ``from_byte`` to ``to_byte`` (exclusive) of documents, from the chunks that hold them.

    ``wanted``: doc_id, from_byte, to_byte.  Returns doc_id, from_byte, to_byte,
    part (from 0), bytes: one row per chunk in reach, in order, none beyond the end.
    """
    x = chunks.join(wanted, "doc_id").where((F.col("start") < F.col("to_byte")) & (F.col("start") + F.col("n_bytes") > F.col("from_byte")))
    lo = F.greatest(F.col("from_byte") - F.col("start"), F.lit(0))
    hi = F.least(F.col("to_byte") - F.col("start"), F.col("n_bytes"))
    part = F.row_number().over(Window.partitionBy("doc_id", "from_byte", "to_byte").orderBy("start")) - 1
    return x.select("doc_id", "from_byte", "to_byte", part.alias("part"),
                    F.substring(F.col("text").cast("binary"), (lo + 1).cast("int"), (hi - lo).cast("int")).alias("bytes"))


def join_page_text(pages: DataFrame, block_pages: int = 1024, text_col: str = "text") -> DataFrame:
    """Page texts joined with a blank line, then trimmed."""
    m = merge_page_text(pages, "\n\n", block_pages, text_col)
    return m.select("doc_id", strip_ws("text").alias("text"))


# a page's XML: declaration, comments and DOCTYPE; the root's name and attributes; children and closing tag, or "/>"
_MISC = r"(?:\s++|<[?].*?[?]>|<!--.*?-->)*+"
_HEAD = rf"(?s)^{_MISC}(?:<!DOCTYPE[^\[>]*+(?:\[.*?\]\s*+)?>{_MISC})?<([A-Za-z_][\w:.-]*+)((?:[^>\"'/]|/(?!>)|\"[^\"]*+\"|'[^']*+')*+)"
XML_PAIRED = _HEAD + rf">(.*)</\1\s*>{_MISC}$"
XML_EMPTY = _HEAD + rf"/>{_MISC}$"


def _xml_parts(pages: DataFrame, xml_col: str) -> DataFrame:
    """doc_id, page_no, root, attributes, inner of each page; ``root`` is null when the page is not one XML element."""
    x = F.col(xml_col)
    paired, empty = x.rlike(XML_PAIRED), x.rlike(XML_EMPTY)
    part = lambda k: F.when(paired, F.regexp_extract(x, XML_PAIRED, k)).when(empty, F.regexp_extract(x, XML_EMPTY, k))
    return pages.select("doc_id", "page_no", x.alias("xml"), part(1).alias("root"),
                        F.rtrim(part(2)).alias("attributes"),
                        F.when(paired, F.regexp_extract(x, XML_PAIRED, 3)).when(empty, F.lit("")).alias("inner"))


def merge_page_xml(pages: DataFrame, xml_col: str = "xml", block_pages: int = 1024) -> DataFrame:
    """Keep the first page's root element and append the children of the others (doc_id, xml, bad_pages).

    A prolog (declaration, comments, DOCTYPE) may stand before the root and
    comments after it; a self-closing root has no children.  Pages that are
    not one XML element are counted in ``bad_pages`` and listed by
    :func:`xml_page_errors`; ``xml`` is null if no page of a document is good.
    """
    x = _xml_parts(pages, xml_col)
    head = x.groupBy("doc_id").agg(
        F.min_by(F.struct("root", "attributes"), F.when(F.col("root").isNotNull(), F.col("page_no"))).alias("h"),
        F.count_if(F.col("root").isNull()).alias("bad_pages"))
    body = merge_page_text(x.where(F.col("root").isNotNull()), "", block_pages, "inner")
    return head.join(body, "doc_id", "left").select(
        "doc_id", F.concat(F.lit("<"), F.col("h.root"), F.col("h.attributes"), F.lit(">"), F.col("text"), F.lit("</"),
                           F.col("h.root"), F.lit(">")).alias("xml"), "bad_pages")


def xml_page_errors(pages: DataFrame, xml_col: str = "xml") -> DataFrame:
    """The pages that A6 cannot merge (doc_id, page_no, xml)."""
    return _xml_parts(pages, xml_col).where(F.col("root").isNull()).select("doc_id", "page_no", "xml")


def page_list(docs: DataFrame) -> DataFrame:
    """Ordered page array ``{path: box/part/stem_%06d.pdf, version: page}`` per record.

    ``docs``: queue_id, box_number, box_part, pdf_name, num_pages.  Zero pages
    gives an empty array (``sequence(1, 0)`` would count down).
    """
    n = F.col("num_pages")
    seq = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    pages = F.transform(seq, lambda i: F.struct(
        F.format_string("%s/%s/%s_%06d.pdf", F.col("box_number"), F.col("box_part"), F.col("pdf_name"), i).alias("path"),
        i.cast("string").alias("version")))
    return docs.select("queue_id", pages.alias("pages"))


def add_pages_payload(docs: DataFrame) -> DataFrame:
    """K6: request row ``{bookmark_process_queue_id, pages}`` as JSON."""
    pl = page_list(docs)
    return pl.select("queue_id", F.to_json(F.struct(F.col("queue_id").cast("string").alias("bookmark_process_queue_id"),
                                                    F.col("pages"))).alias("payload"))


def split_process_payload(segments: DataFrame) -> DataFrame:
    """K5: one request per planned segment.

    ``segments``: queue_id, priority_id, barcode, upload_dir, piece_name.
    ``filename`` is ``last folder of upload_dir / piece_name.pdf``.
    """
    fname = F.concat(F.substring_index(F.col("upload_dir"), "/", -1), F.lit("/"), F.col("piece_name"), F.lit(".pdf"))
    st = F.struct(F.col("priority_id").cast("int").alias("priorityID"),
                  F.coalesce(F.col("barcode"), F.lit("")).alias("barcode"),
                  fname.alias("filename"),
                  F.col("queue_id").cast("string").alias("source_bookmark_process_queue_id"))
    return segments.select("queue_id", "from_page", F.to_json(st).alias("payload"))


def mark_processed_payload(finished: DataFrame, key: str = "queue_id") -> DataFrame:
    """K7: ``{bookmark_process_queue_id, processed: 'true'}`` for finished documents only."""
    done = finished.where(F.col("finished"))
    return done.select(key, F.to_json(F.struct(F.col(key).cast("string").alias("bookmark_process_queue_id"),
                                               F.lit("true").alias("processed"))).alias("payload"))


def mark_processed_request(finished: DataFrame, *, root: str, key: str, signature: str, machine: str,
                           doc: str = "queue_id") -> DataFrame:
    """K7 in its request envelope, for finished documents only."""
    return finished.where(F.col("finished")).select(doc, request_envelope(
        {"bookmarkProcessQueueId": F.col(doc).cast("string"), "processed": F.lit("true"), "machineName": F.lit(machine)},
        root=root, key=key, signature=signature).alias("request"))


def add_pages_request(docs: DataFrame, *, root: str, key: str, signature: str, machine: str) -> DataFrame:
    """K6 in its request envelope."""
    return page_list(docs).select("queue_id", request_envelope(
        {"bookmark_process_queue_id": F.col("queue_id").cast("string"), "pages": F.col("pages"), "machineName": F.lit(machine)},
        root=root, key=key, signature=signature).alias("request"))


# fixed value: first line of a manifest
XML_DECLARATION = "<?xml version='1.0' encoding='UTF-8'?>"


def manifest_xml(docs: DataFrame, run_date: str) -> DataFrame:
    """``FileInfo(process_date, profile_id) > Image(id) > Bookmark(ID) > piece(path)*`` per record.

    ``run_date`` is ``YYYY-MM-DD``; it is written day/month/year without padding.
    """
    d = F.to_date(F.lit(run_date))
    pdate = F.format_string("%d/%d/%d", F.dayofmonth(d), F.month(d), F.year(d))
    n = F.col("num_pages")
    seq = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    pieces = F.transform(seq, lambda i: F.struct(
        F.format_string("%s/%s/%s_%06d.pdf", F.col("box_number"), F.col("box_part"), F.col("pdf_name"), i).alias("_path")))
    st = F.struct(pdate.alias("_process_date"), F.col("profile_id").cast("string").alias("_profile_id"),
                  F.struct(F.col("image_id").cast("string").alias("_id"),
                           F.struct(F.col("queue_id").cast("string").alias("_ID"), pieces.alias("piece")).alias("Bookmark"))
                   .alias("Image"))
    return docs.select("queue_id", F.concat(F.lit(XML_DECLARATION + "\n"), F.to_xml(st, {"rowTag": "FileInfo"})).alias("xml"))
