"""Completeness, done-tests and resume planning.

All counts are grouped aggregations with map-side partial aggregation, so a
hot document costs one partial row per task, never a whole group in a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_KINDS = ["thumbs", "png", "xml", "pdf", "txt"]
DOC_KINDS = ["source", "state", "manifest"]
#: pages of a document that share one row of bits
PAGE_BITS = 32


def kind_counts(artifacts: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Artifact count per document and kind, as columns ``n_<kind>`` (one grouped pass)."""
    return artifacts.where(F.col("kind").isin(*kinds)).groupBy("doc_id").agg(
        *[F.count_if(F.col("kind") == k).cast("int").alias(f"n_{k}") for k in kinds])


def document_complete(artifacts: DataFrame, docs: DataFrame) -> DataFrame:
    """A2: service check per document (doc_id, complete).

    ``docs``: doc_id, num_pages, have_ocr, have_sphinx.  Main folder holds the
    page PDFs, source and state (+ manifest with recognition): n+3 or n+2;
    thumbs = n; png = n; search files (xml) = n when wanted.
    """
    c = kind_counts(artifacts, PAGE_KINDS + DOC_KINDS)
    x = docs.join(c, "doc_id", "left").na.fill(0, [f"n_{k}" for k in PAGE_KINDS + DOC_KINDS])
    n = F.col("num_pages")
    main = F.col("n_pdf") + F.col("n_source") + F.col("n_state") + F.col("n_manifest")
    main_ok = main == F.when(F.col("have_ocr"), n + 3).otherwise(n + 2)
    ok = main_ok & (F.col("n_thumbs") == n) & (F.col("n_png") == n)
    ok = ok & (~F.col("have_sphinx") | (F.col("n_xml") == n))
    return x.select("doc_id", F.coalesce(ok, F.lit(False)).alias("complete"))


def page_outputs_complete(artifacts: DataFrame, docs: DataFrame, kinds: Sequence[str],
                          sum_only: bool = False) -> DataFrame:
    """A3: folder-tool check per document.

    XML wanted: xml count = n.  Otherwise each wanted kind of pdf/txt must
    have n files (``sum_only=True`` reproduces the source's pdf+txt sum test,
    where surplus text could stand in for missing PDFs).
    """
    c = kind_counts(artifacts, ["xml", "pdf", "txt"])
    x = docs.join(c, "doc_id", "left").na.fill(0, ["n_xml", "n_pdf", "n_txt"])
    n = F.col("num_pages")
    if "xml" in kinds:
        ok = F.col("n_xml") == n
    else:
        want = [k for k in ("pdf", "txt") if k in kinds]
        if sum_only:
            ok = (F.col("n_pdf") + F.col("n_txt")) == n * len(want)
        else:
            ok = F.lit(True)
            for k in want:
                ok = ok & (F.col(f"n_{k}") == n)
    return x.select("doc_id", F.coalesce(ok, F.lit(False)).alias("complete"))


def batch_complete(inputs: DataFrame, outputs: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """A4: per wanted kind, number of output files equals number of input files.

    ``inputs`` has one row per input file; ``outputs`` rows carry ``kind``.
    Returns one row per kind (kind, n_inputs, n_outputs, complete).
    """
    n_in = inputs.agg(F.count(F.lit(1))).scalar()  # scalar subquery, computed once
    spark = inputs.sparkSession
    wanted = spark.createDataFrame([(k,) for k in kinds], "kind string")
    n_out = outputs.where(F.col("kind").isin(*kinds)).groupBy("kind").agg(F.count(F.lit(1)).alias("n_outputs"))
    x = wanted.join(n_out, "kind", "left").withColumn("n_inputs", n_in)
    return x.select("kind", "n_inputs", F.coalesce("n_outputs", F.lit(0)).alias("n_outputs"),
                    (F.col("n_inputs") == F.coalesce("n_outputs", F.lit(0))).alias("complete"))


def all_segments_finished(tasks: DataFrame, key: str = "queue_id") -> DataFrame:
    """A document is finished when every segment is; a failed (null) entry counts as not."""
    return tasks.groupBy(key).agg(F.bool_and(F.coalesce(F.col("is_finish"), F.lit(False))).alias("finished"))


def missing_pages(pages: DataFrame, outputs: DataFrame, kind: str) -> DataFrame:
    """Pages with no output of ``kind`` (left anti join on doc_id, page_no)."""
    have = outputs.where(F.col("kind") == kind).select("doc_id", "page_no")
    return pages.select("doc_id", "page_no").join(have, ["doc_id", "page_no"], "left_anti")


def first_missing_page(pages: DataFrame, outputs: DataFrame, kind: str) -> DataFrame:
    """A10: lowest page without an output per document."""
    return missing_pages(pages, outputs, kind).groupBy("doc_id").agg(
        F.min("page_no").cast("int").alias("first_missing"))


def redo_pages(pages: DataFrame, outputs: DataFrame, kind: str) -> DataFrame:
    """Every page from the first missing one to the end (later existing pages are redone too)."""
    first = first_missing_page(pages, outputs, kind)
    return pages.select("doc_id", "page_no").join(first, "doc_id", "inner") \
                .where(F.col("page_no") >= F.col("first_missing")).select("doc_id", "page_no")


def resume_route(state: DataFrame, artifacts: DataFrame, pages: DataFrame) -> DataFrame:
    """what a resumed non-bulk job must redo.

    No temp folder -> treated as no recognition and no search file.  Else
    recognition jobs redo pages missing a page PDF, text jobs pages missing a
    text file.  Returns doc_id, have_ocr, have_sphinx, missing_kind, first_missing.
    """
    # one grouped pass: pages and their files as bits of blocks of pages, then the lowest page without each kind
    none, bit = F.lit(0).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("page_no", F.lit(PAGE_BITS)).cast("int"))
    block = F.floor(F.col("page_no") / PAGE_BITS).alias("_block")
    of_kind = lambda k: F.when(F.col("kind") == k, bit).otherwise(none).alias(f"_{k}")
    rows = pages.select("doc_id", block, bit.alias("_page"), none.alias("_pdf"), none.alias("_txt"), F.lit(False).alias("_temp")).union(
        artifacts.where(F.col("kind").isin("pdf", "txt", "temp")).select(
            "doc_id", block, none.alias("_page"), of_kind("pdf"), of_kind("txt"), (F.col("kind") == "temp").alias("_temp")))
    blocks = rows.groupBy("doc_id", "_block").agg(*[F.bit_or(c).alias(c) for c in ("_page", "_pdf", "_txt")],
                                                  F.bool_or("_temp").alias("_temp"))

    def lowest(kind):
        left = F.col("_page").bitwiseAND(F.bitwise_not(F.col(f"_{kind}")))
        return F.min(F.when(left != 0, F.col("_block") * PAGE_BITS + F.bit_count(left.bitwiseAND(-left) - 1))).alias(f"fm_{kind}")

    first = blocks.groupBy("doc_id").agg(F.bool_or("_temp").alias("has_temp"), lowest("pdf"), lowest("txt"))
    s = state.join(first, "doc_id", "left")
    t = F.coalesce(F.col("has_temp"), F.lit(False))
    s = s.select("doc_id", "fm_pdf", "fm_txt",
                 (t & (F.coalesce(F.col("have_ocr"), F.lit("f")) == "t")).alias("have_ocr"),
                 (t & (F.coalesce(F.col("have_sphinx"), F.lit("f")) == "t")).alias("have_sphinx"))
    s = s.withColumn("missing_kind", F.when(F.col("have_ocr"), F.lit("pdf"))
                     .when(F.col("have_sphinx"), F.lit("txt")))
    fm = F.when(F.col("missing_kind") == "pdf", F.col("fm_pdf")).when(F.col("missing_kind") == "txt", F.col("fm_txt"))
    return s.select("doc_id", "have_ocr", "have_sphinx", "missing_kind", fm.cast("int").alias("first_missing"))


def output_keys(files: DataFrame, kinds: Sequence[str], first_only: bool = False) -> DataFrame:
    """Expected outputs per input file: (file keys..., kind) for each wanted kind."""
    ks = list(kinds[:1]) if first_only else list(kinds)
    return files.select("*", F.explode(F.array(*[F.lit(k) for k in ks])).alias("kind"))


def file_status(files: DataFrame, outputs: DataFrame, kinds: Sequence[str],
                keys: Sequence[str] = ("sub_dir", "stem"), first_only: bool = False) -> DataFrame:
    """``files`` with ``done``: do all wanted outputs exist (one grouped pass over the outputs, one join)."""
    ks = list(kinds[:1]) if first_only else list(kinds)
    have = outputs.where(F.col("kind").isin(*ks)).groupBy(*keys).agg(
        *[(F.count_if(F.col("kind") == k) > 0).alias(f"_ff_{k}") for k in ks])
    enough = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"_ff_{k}"), F.lit(False)) for k in ks], F.lit(True))
    return files.join(have, list(keys), "left").withColumn("done", enough).drop(*[f"_ff_{k}" for k in ks])


def pending_files(files: DataFrame, outputs: DataFrame, kinds: Sequence[str],
                  keys: Sequence[str] = ("sub_dir", "stem"), first_only: bool = False) -> DataFrame:
    """Input files missing at least one wanted output.

    ``first_only=True`` reproduces the source, which only looked at the first kind.
    """
    return file_status(files, outputs, kinds, keys, first_only).where(~F.col("done")).select(*files.columns)


def done_files(files: DataFrame, outputs: DataFrame, kinds: Sequence[str],
               keys: Sequence[str] = ("sub_dir", "stem"), first_only: bool = False) -> DataFrame:
    """Input files whose wanted outputs all exist (complement of J3)."""
    return file_status(files, outputs, kinds, keys, first_only).where("done").select(*files.columns)


def missing_kinds(files: DataFrame, outputs: DataFrame, kinds: Sequence[str],
                  keys: Sequence[str] = ("sub_dir", "stem")) -> DataFrame:
    """Wanted kinds not present per file (set difference as a left anti join)."""
    want = output_keys(files.select(*keys), kinds)
    return want.join(outputs.select(*keys, "kind"), [*keys, "kind"], "left_anti")


def resume_segments(plan: DataFrame, finished: DataFrame, key: str = "doc_id") -> DataFrame:
    """Planned segments not finished yet, by document and first page (and barcode, if ``finished`` has one).

    ``from_page`` is the key because one barcode can start several segments; the
    source matched by barcode alone.
    """
    on = [key, "from_page", *(["barcode"] if "barcode" in finished.columns else [])]
    return plan.join(finished.select(*on), on, "left_anti").select(*plan.columns)
