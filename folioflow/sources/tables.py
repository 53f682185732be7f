"""Readers for the shared parquet tables and the page-level views built on them.

The views turn the driver's tables into the shapes the document jobs consume
(see FIXTURES.md §2).  Each view only renames, derives and re-keys columns:
every input row stays in, so a job's work grows with the tables.  The same
mapping is written as SQL in :mod:`folioflow.catalog.views_sql` for the DuckDB
oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import ordinal_within

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of the test mapping (FIXTURES.md §2).
BARCODE_PREFIX = "NEU_"          # prefix the barcode reader expects
SHORT_BARCODE = "NEU"            # too short to be valid (length < 5)
PAGE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_pages``: one row per line item as a page of document ``l_orderkey``.

    Columns: doc_id, page_no (1-based, ordered by the full line-item key),
    barcode, width, ink array<double> [C, M, Y, K], returnflag, linestatus.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *PAGE_ORDER)
    numbered = ordinal_within(li, "l_orderkey", PAGE_ORDER, name="page_no")
    barcode = (F.when(F.col("l_returnflag") == "R",
                      F.concat(F.lit(BARCODE_PREFIX), F.col("l_partkey").cast("string")))
                .when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1), F.lit(SHORT_BARCODE)))
    return numbered.select(
        F.col("l_orderkey").alias("doc_id"),
        F.col("page_no"),
        barcode.cast("string").alias("barcode"),
        (F.col("l_extendedprice") / 20).alias("width"),
        _ink(),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
    )


def page_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_counts``: pages per document (doc_id, num_pages), counted on the rows without numbering them."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(
        F.count(F.lit(1)).cast("int").alias("num_pages"))


def page_inks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inks of all pages without page numbers (doc_id, ink array<double> [C, M, Y, K])."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), _ink())


def _ink() -> Column:
    return F.array(F.col("l_discount"), F.col("l_tax"), F.lit(0.0), F.col("l_quantity") / 50).alias("ink")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_page_text``: conversation turns as page texts (doc_id, page_no, text)."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page_no"),
                    F.col("text"))


def docs(spark: SparkSession, sf_dir: str, variant: str = "plain", keep: tuple[str, ...] = ()) -> DataFrame:
    """``v_docs``: doc_id, text (and the columns of ``documents`` named in ``keep``).  ``variant='mangled'`` adds non-searchable rows.

    Mangled mapping (every row kept): empty text when doc_id % 7 = 0, else
    letters replaced by ``1`` when doc_id % 5 = 0; then `` a@b`` appended
    when doc_id % 3 = 0.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text", *keep)
    if variant == "plain":
        return d
    base = (F.when(F.col("doc_id") % 7 == 0, F.lit(""))
             .when(F.col("doc_id") % 5 == 0, F.regexp_replace("text", "[A-Za-z]", "1"))
             .otherwise(F.col("text")))
    text = F.when(F.col("doc_id") % 3 == 0, F.concat(base, F.lit(" a@b"))).otherwise(base)
    return d.select("doc_id", text.alias("text"), *keep)


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_paragraphs``: documents with ``'. '`` turned into a paragraph break."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", F.replace(F.col("text"), F.lit(". "), F.lit(".\n\n")).alias("text"))


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_queue``: one waiting document record per order (M1 shape)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    prio = F.substring("o_orderpriority", 1, 1)
    return o.select(
        k.alias("queue_id"),
        F.concat(F.lit("/scans/"), F.col("o_custkey").cast("string"), F.lit("/"),
                 k.cast("string"), F.lit(".pdf")).alias("path"),
        F.col("o_custkey").cast("string").alias("box_number"),
        F.year("o_orderdate").cast("string").alias("box_part"),
        F.when(prio != "5", prio.cast("int")).alias("priority"),
        F.when(k % 3 == 0, "t").when(k % 3 == 1, "f").alias("keep_barcode_ind"),
        F.when(F.col("o_orderstatus") == "F", "t").otherwise("f").alias("is_bulk"),
        F.when(k % 2 == 0, "t").otherwise("f").alias("deliver_searchable_pdf"),
        F.when(k % 5 == 0, "t").when(k % 5 == 1, F.lit(None)).when(k % 5 == 2, "")
         .otherwise("f").alias("has_interactive"),
        F.concat(F.lit("PRF"), (F.col("o_custkey") % 7).cast("string")).alias("profile_id"),
        F.concat(F.lit("IMG"), k.cast("string")).alias("image_id"),
        (F.col("o_custkey") % 5).cast("int").alias("run_id"),
    )


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_context``: run settings, one row per run (here: per region).

    Regions whose name holds a space have no upload folder, so their records
    are dropped by J5.
    """
    r = table(spark, sf_dir, "region")
    low = F.lower(F.col("r_name"))
    return r.select(
        F.col("r_regionkey").cast("int").alias("run_id"),
        F.when(F.instr("r_name", " ") == 0, F.concat(F.lit("/srv/upload/"), low)).alias("upload_dir"),
        F.concat(F.lit("/srv/pkged/"), F.regexp_replace(low, " ", "_")).alias("pkged"),
        (F.col("r_regionkey") % 2 == 0).alias("use_sphinx"),
        (F.col("r_regionkey") % 3).cast("int").alias("sphinx_db"),
    )


def outputs(spark: SparkSession, sf_dir: str, pages_df: DataFrame | None = None) -> DataFrame:
    """``v_outputs``: artifacts present per page (doc_id, kind, page_no).

    Kinds per page, chosen by return flag / line status so that some documents
    are complete and some not; per-document files (source, state, manifest)
    hang off page 1 with page_no 0.
    """
    p = pages_df if pages_df is not None else pages(spark, sf_dir)
    rf, ls = F.col("returnflag"), F.col("linestatus")
    kinds = F.array(
        F.lit("thumbs"),
        F.when(~((rf == "A") & (ls == "F")), F.lit("png")),
        F.when(~((rf == "A") & (ls == "O")), F.lit("xml")),
        F.when(~((rf == "R") & (ls == "F")), F.lit("pdf")),
        F.when(~((rf == "N") & (ls == "O")), F.lit("txt")),
        F.when(F.col("page_no") == 1, F.lit("source")),
        F.when(F.col("page_no") == 1, F.lit("state")),
        F.when((F.col("page_no") == 1) & (ls == "O"), F.lit("manifest")),
        F.when((F.col("page_no") == 1) & (rf != "R"), F.lit("temp")),
    )
    x = p.select("doc_id", "page_no", F.explode(kinds).alias("kind")).where(F.col("kind").isNotNull())
    per_doc = F.col("kind").isin("source", "state", "manifest", "temp")
    return x.select("doc_id", "kind", F.when(per_doc, F.lit(0)).otherwise(F.col("page_no")).alias("page_no"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_users``: customers as the user table (M12 shape)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_mktsegment"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.lit("").alias("phone"), F.lit("").alias("url"), F.lit("").alias("location"), F.lit("").alias("bio"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("deposit"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("key"), k.cast("string"))).alias("activation_key"),
        F.lit(None).cast("string").alias("avatar"),
        ((F.col("c_nationkey") % 3) + 1).cast("int").alias("sex"),
        (k % 3).cast("short").alias("role_code"),
        (k % 3).cast("short").alias("status_code"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_messages``: queue message bodies (value) with their time and payload."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("event_type").alias("value"),
                    F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("props").alias("body"))
