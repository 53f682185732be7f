"""Colour, size and orientation planning for page images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import numeric_tokens, strip_ws
from ..operators.filters import has_colour
from ..operators.ordering import ordinal_within

# Fixed values of the renderer plan.
COLOUR_SHARE = 0.5          # below this share of colour pages a document is rendered grey
GREY_DEVICE = "pnggray"
COLOUR_DEVICE = "png16m"
INK_MARK = "CMYK OK"
ORIENTATION_MARK = "Orientation in degrees:"


def color_device(ink: DataFrame, docs: DataFrame | None = None, threshold: float = 0.0) -> DataFrame:
    """A1: (doc_id, color_pages, device); share of colour pages < 0.5 -> grey.

    ``ink`` has doc_id + ink array per page; ``docs`` (doc_id, num_pages) gives
    the page counts where pages may lack an ink row, else the ink rows are
    counted in the same pass.  Documents with 0 pages are left out.
    """
    c = ink.groupBy("doc_id").agg(F.count_if(has_colour("ink", threshold)).cast("int").alias("color_pages"),
                                  F.count(F.lit(1)).cast("int").alias("_rows"))
    x = c.withColumnRenamed("_rows", "num_pages") if docs is None else docs.where(F.col("num_pages") > 0).join(c, "doc_id", "left")
    cp = F.coalesce(F.col("color_pages"), F.lit(0))
    dev = F.when(cp / F.col("num_pages") < F.lit(COLOUR_SHARE), F.lit(GREY_DEVICE)).otherwise(F.lit(COLOUR_DEVICE))
    return x.select("doc_id", cp.alias("color_pages"), dev.alias("device"))


def image_plan(ink: DataFrame, devices: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Per page the document's full-size device, and whether to redo it in colour.

    A page is redone in colour when its document is rendered grey but the
    page has colour.  ``ink`` rows carry doc_id, page_no, ink; ``devices`` come
    from :func:`color_device`.
    """
    x = ink.select("doc_id", "page_no", has_colour("ink", threshold).alias("colour")).join(
        devices.select("doc_id", "device"), "doc_id", "inner")
    return x.select("doc_id", "page_no", "device",
                    ((F.col("device") == GREY_DEVICE) & F.col("colour")).alias("redo_color"))


def parse_ink_lines(lines: DataFrame, key: str = "doc_id", line_no: str = "line_no",
                    line: str = "line") -> DataFrame:
    """S4 (parse): keep lines holding ``CMYK OK``; ink = first three numbers; page index by position.

    The page index is the 0-based position among kept lines (the source used
    the first equal line, so repeated values collapsed; fixed).
    """
    kept = lines.where(F.instr(F.col(line), INK_MARK) > 0)
    kept = kept.select(key, line_no, F.slice(numeric_tokens(F.col(line)), 1, 3).alias("ink"))
    numbered = ordinal_within(kept, key, [line_no], name="_pos")
    return numbered.select(key, (F.col("_pos") - 1).cast("int").alias("page_idx"), "ink")


def read_ink_report(spark: SparkSession, path: str) -> DataFrame:
    """Ink reports, one text file per document; doc_id is the file name stem.

    A report is read in byte ranges that end at line breaks, by as many tasks as
    it has blocks.  A line's place is (start of its range, place in the range);
    page indexes come from the kept lines of each range and the counts of the
    ranges before it, so no task holds a whole report.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.regexp_replace(F.col("_metadata.file_name"), "[.][^.]*$", "").alias("doc_id"),
        F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    kept = lines.where(F.instr("line", INK_MARK) > 0).select("doc_id", "range", "at", F.slice(numeric_tokens(F.col("line")), 1, 3).alias("ink"))
    numbered = ordinal_within(kept, "doc_id", ["range", "at"], name="_pos", block=F.col("range"))
    return numbered.select("doc_id", (F.col("_pos") - 1).cast("int").alias("page_idx"), "ink")


def parse_orientation(reports: DataFrame, text_col: str = "text") -> DataFrame:
    """Degrees after ``Orientation in degrees:``; missing or unparsable -> 0."""
    raw = strip_ws(F.regexp_extract(F.col(text_col), "Orientation in degrees:([^\\n]*)", 1))
    deg = F.when(raw.rlike("^[+-]?[0-9]+$"), raw.try_cast("int"))
    return reports.select("doc_id", "page_no", F.coalesce(deg, F.lit(0)).alias("degrees"))
