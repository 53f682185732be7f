"""File sources: document crawl (S1), saved job state (S6), user table.

Ink and orientation report readers (S4, S5) live in :mod:`folioflow.plans.images`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import file_stem, sub_dir
from ..sinks import state_log

# Saved job state (M7): flat string fields plus the split task list.
JOB_STATE_SCHEMA = ("queue_id string, scannedimages_path string, pdf_name string, keep_barcode_ind string, "
                    "priority string, profile_id string, image_id string, box_number string, box_part string, "
                    "bookmark_id string, have_sphinx string, have_ocr string, has_interactive string, "
                    "add_pages string, pkged string, "
                    "tasks array<map<string,struct<page_index:int,is_finish:string>>>")


def scan_documents(spark: SparkSession, root: str, ext: str = "pdf", with_content: bool = False) -> DataFrame:
    """Recursive crawl for ``*.{ext}`` below ``root`` (suffix matched case-sensitively).

    Returns path, length, modification time, sub_dir below ``root`` and the
    file stem; ``content`` only when asked for, so it is never read for files
    that the done-test (J3/J4) skips.
    """
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", f"*.{ext.lower()}")
          .load(root))
    root_path = root.rstrip("/")
    cols = [F.col("path"), F.col("length"), F.col("modificationTime"),
            sub_dir(F.regexp_replace("path", "^file:", ""), root_path).alias("sub_dir"),
            file_stem("path").alias("stem")]
    if with_content:
        cols.append(F.col("content"))
    return df.select(*cols)


def read_job_state(spark: SparkSession, path: str) -> DataFrame:
    """The latest saved state of every job (K4 log); missing flags take the source defaults.

    ``have_ocr``, ``have_sphinx`` and ``add_pages`` default to ``'f'``;
    ``keep_barcode_ind`` defaults to ``'t'``.
    """
    df = state_log.latest(spark, path, JOB_STATE_SCHEMA, "queue_id")
    return df.withColumns({
        "have_ocr": F.coalesce("have_ocr", F.lit("f")),
        "have_sphinx": F.coalesce("have_sphinx", F.lit("f")),
        "add_pages": F.coalesce("add_pages", F.lit("f")),
        "keep_barcode_ind": F.coalesce("keep_barcode_ind", F.lit("t")),
    })


def read_users(spark: SparkSession, source: str, fmt: str = "parquet", **options) -> DataFrame:
    """The user table from parquet, a catalog table (``fmt='table'``) or JDBC (``fmt='jdbc'``)."""
    if fmt == "table":
        return spark.read.table(source)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=source, **options).load()
    return spark.read.format(fmt).options(**options).load(source)
