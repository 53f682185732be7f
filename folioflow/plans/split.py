"""Bulk-scan split planning: where a scan is cut into separate documents.

Input is a page table (doc_id, page_no, barcode).  A page whose barcode is
valid (F8) starts a new document.  The rules (W4) are:

1. ``to = next barcode page - 1``, or the page count ``n`` for the last one;
   ``from = page + 1``.
2. ``adjacent`` = the next barcode is on the following page or the previous
   barcode on the page before.
3. The first barcode, when not adjacent and not on page 1, also yields a
   leading segment ``1 .. page-1`` with an empty barcode.  (An adjacent first
   barcode yields none: its leading pages are lost; ``keep_leading=True``
   emits them anyway.)
4. With keep-barcode, ``from`` is moved back one page; then ``from`` is
   clamped to ``to``.
5. A one-page segment that is adjacent loses its barcode unless keep-barcode.
6. A document with no valid barcode is one segment ``1 .. n``; ``n = 0``
   gives nothing.
7. ``page_index`` is 1 for an empty barcode, else ``from - 1`` (or ``from``
   with keep-barcode).
8. The barcode text is right-trimmed after the validity test.

Skew: the neighbour search is blocked (see :mod:`folioflow.operators.ordering`)
and the page count travels as a per-document sentinel row, so no step puts a
whole document into one task and no per-document table is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import rstrip_ws
from ..operators.filters import valid_barcode
from ..operators.ordering import adjacent_flag, neighbours_within

SEGMENT_COLS = ["doc_id", "barcode", "from_page", "to_page", "page_index"]


def page_counts(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """Pages per document (doc_id, num_pages int); partial aggregation first."""
    return pages.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("num_pages"))


def barcode_pages(pages: DataFrame, prefix: str = "NEU_", min_len: int = 5) -> DataFrame:
    """F8 + O1: valid barcode pages (doc_id, page_no, barcode) in page order."""
    return pages.where(valid_barcode(F.col("barcode"), prefix, min_len)).select("doc_id", "page_no", "barcode")


def split_plan(pages: DataFrame, keep_barcode: bool | str = False, docs: DataFrame | None = None,
               prefix: str = "NEU_", min_len: int = 5, keep_leading: bool = False,
               block_size: int = 4096) -> DataFrame:
    """Planned segments (doc_id, barcode, from_page, to_page, page_index).

    ``keep_barcode`` is a constant or the name of a boolean column of
    ``docs``; ``docs`` (doc_id, num_pages[, keep col]) defaults to the page
    count of ``pages``.
    """
    if docs is None:
        docs = page_counts(pages)
    doc_cols = ["doc_id", "num_pages"] + ([keep_barcode] if isinstance(keep_barcode, str) else [])
    docs = docs.select(*doc_cols).where(F.col("num_pages") > 0)

    marks = barcode_pages(pages, prefix, min_len).select(
        "doc_id", "page_no", "barcode", F.lit(False).alias("sentinel"),
        F.lit(None).cast("int").alias("num_pages"))
    sentinels = docs.select(
        "doc_id", (F.col("num_pages") + 1).alias("page_no"), F.lit(None).cast("string").alias("barcode"),
        F.lit(True).alias("sentinel"), "num_pages")
    # The sentinel on page n+1 carries n to the last barcode of its document.
    nb = neighbours_within(marks.unionByName(sentinels), "doc_id", "page_no",
                           carry=["sentinel", "barcode", "num_pages"], block_size=block_size)

    return segments_of(nb, keep_barcode, docs, keep_leading)


def segments_of(neighbours: DataFrame, keep_barcode: bool | str = False, docs: DataFrame | None = None,
                keep_leading: bool = False) -> DataFrame:
    """The W4 rules on barcode pages whose neighbours are known.

    ``neighbours`` has a row per barcode page and one per document without any
    (``sentinel``): doc_id, page_no, barcode, sentinel, num_pages, prev_page_no,
    next_page_no (the last barcode's is the page after the document) and
    next_sentinel.  ``docs`` has the flag column if ``keep_barcode`` names one.
    """
    # One pass over the neighbour rows: each barcode row yields its segment and
    # maybe the leading segment; a sentinel without a previous barcode yields the
    # whole document.  (No union of branches, so the plan above runs once.)
    x = neighbours
    if isinstance(keep_barcode, str):
        # per-document flag: equi join on doc_id (AQE splits a hot document)
        x = x.join(docs.select("doc_id", F.col(keep_barcode).alias("_keep")), "doc_id", "left")
        keep: Column = F.coalesce(F.col("_keep"), F.lit(False))
    else:
        keep = F.lit(bool(keep_barcode))
    p = F.col("page_no")
    n_next = F.col("next_page_no")  # a real mark's page, or n+1 from the sentinel
    x = x.withColumn("_real_next", F.when(~F.col("next_sentinel"), n_next))
    x = x.withColumn("_adj", adjacent_flag("page_no", "prev_page_no", "_real_next")) \
         .withColumn("_to", (n_next - 1).cast("int")) \
         .withColumn("_keep_v", keep)
    x = x.withColumn("_from", F.least(F.when(F.col("_keep_v"), p).otherwise(p + 1), F.col("_to")).cast("int"))
    blank = (F.col("_from") == F.col("_to")) & F.col("_adj") & ~F.col("_keep_v")

    def seg(barcode, frm, to, idx) -> Column:
        return F.struct(F.col("doc_id").alias("doc_id"), barcode.cast("string").alias("barcode"),
                        frm.cast("int").alias("from_page"), to.cast("int").alias("to_page"),
                        idx.cast("int").alias("page_index"))

    mark = ~F.col("sentinel")
    main = F.when(mark, seg(F.when(blank, F.lit("")).otherwise(rstrip_ws(F.col("barcode"))), F.col("_from"),
                            F.col("_to"),
                            F.when(blank, F.lit(1)).when(F.col("_keep_v"), F.col("_from"))
                             .otherwise(F.col("_from") - 1)))
    lead_cond = mark & F.col("prev_page_no").isNull() & (p != 1)
    if not keep_leading:
        lead_cond = lead_cond & ~F.col("_adj")
    leading = F.when(lead_cond, seg(F.lit(""), F.lit(1), p - 1, F.lit(1)))
    whole = F.when(F.col("sentinel") & F.col("prev_page_no").isNull(),
                   seg(F.lit(""), F.lit(1), F.col("num_pages"), F.lit(1)))
    segs = F.filter(F.array(main, leading, whole), lambda s: s.isNotNull())
    return x.select(F.inline(segs))


def explode_range(df: DataFrame, first: Column, last: Column, name: str, block: int = 4096) -> DataFrame:
    """``df`` with one row per number ``first..last`` in column ``name``; no row for an empty range.

    The numbers are made block by block, so no row ever holds a whole
    document as one array.
    """
    lo, hi = first.cast("int"), last.cast("int")
    n = hi - lo + 1
    blocks = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")))
    x = df.withColumn("_ff_b", F.explode(blocks))
    start = lo + F.col("_ff_b") * block
    return x.withColumn(name, F.explode(F.sequence(start, F.least(hi, start + block - 1)))).drop("_ff_b")


def assign_pages(segments: DataFrame, pages: DataFrame | None = None, block_pages: int = 4096) -> DataFrame:
    """Pages of each segment (doc_id, from_page, page_no, new_page_no [+ page columns]).

    Segments of one document do not overlap (W4), so a page belongs to the last
    segment that starts at or before it, if that one reaches it.  Segment starts
    and pages share one shuffle by (document, block of pages); a segment that
    goes on in later blocks starts anew at each of them, one row per
    ``block_pages`` pages, and a window carries the start forward to the pages.
    Without ``pages`` the page numbers are made from the segments.
    """
    segs = segments.select("doc_id", "barcode", "from_page", "to_page")
    if pages is None:
        x = explode_range(segs, F.col("from_page"), F.col("to_page"), "page_no")
        return x.withColumn("new_page_no", (F.col("page_no") - F.col("from_page") + 1).cast("int"))
    block = lambda c: F.floor(F.col(c) / F.lit(block_pages)).cast("int")
    rest = [c for c in pages.columns if c not in ("doc_id", "page_no")]
    starts = segs.withColumn("_blk", F.explode(F.sequence(block("from_page"), block("to_page")))).select(
        "doc_id", "_blk", F.greatest(F.col("from_page"), F.col("_blk") * block_pages).alias("_at"),
        F.struct("barcode", "from_page", "to_page").alias("_seg"))
    lines = pages.select("doc_id", block("page_no").alias("_blk"), F.col("page_no").alias("_at"),
                         F.struct("page_no", *rest).alias("_page"))
    both = starts.unionByName(lines, allowMissingColumns=True)
    # of a start and a page at one place the start comes first
    w = Window.partitionBy("doc_id", "_blk").orderBy("_at", F.col("_page").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    x = both.withColumn("_seg", F.last("_seg", ignorenulls=True).over(w)).where(
        F.col("_page").isNotNull() & (F.col("_seg.to_page") >= F.col("_at")))
    return x.select("doc_id", "_page.page_no", *[F.col(f"_seg.{c}").alias(c) for c in ("barcode", "from_page", "to_page")],
                    (F.col("_at") - F.col("_seg.from_page") + 1).cast("int").alias("new_page_no"), *[F.col("_page")[c].alias(c) for c in rest])


def barcode_map(pages: DataFrame, prefix: str = "NEU_", min_len: int = 5, block_pages: int = 4096) -> DataFrame:
    """Page -> barcode map per document (valid barcodes, page order).

    Built in two levels like the page merges: maps per block of pages first
    (spread over tasks), then the block maps of a document are concatenated
    in block order.
    """
    b = barcode_pages(pages, prefix, min_len)
    blk = F.floor(F.col("page_no") / F.lit(block_pages)).cast("long")
    per_block = b.groupBy("doc_id", blk.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("page_no", "barcode"))).alias("entries"))
    per_doc = per_block.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("block", "entries"))).alias("blocks"))
    return per_doc.select("doc_id", F.map_from_entries(F.flatten(F.transform("blocks", lambda x: x["entries"])))
                          .alias("barcodes"))
