"""Jobs of the roads beside the default ones, and of operators whose output is random or lies in files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import filters as flt
from ..operators import joins
from ..plans import complete, page_functions
from ..plans import users as U
from ..session import shared_path
from ..sinks import writers
from ..sources import files, tables as T
from . import job
from .records import FILES, FV, KIND_COUNTS, KINDS, _files, _outs
from .streams import CLEAN

WHOLE_ROUTE = """SELECT f.doc_id,
  CASE WHEN COALESCE(f.num_pages, 0) = 0 THEN 'unreadable'
       WHEN NOT EXISTS (SELECT 1 FROM miss m WHERE m.sub_dir = f.sub_dir AND m.stem = f.stem) THEN 'done'
       ELSE 'ocr_whole' END AS route
FROM files f"""


def _whole_route(spark, sf_dir):
    status = complete.file_status(_files(spark, sf_dir), _outs(spark, sf_dir), KINDS)
    return flt.route_file(status, F.col("done"), ocr_all=True).select("doc_id", "route")


@job("route_file_whole", WHOLE_ROUTE, FV, FILES)
def route_file_whole(spark, sf_dir):
    """F7 with ``ocr_all``: every readable file that is not done goes through recognition as a whole."""
    return _whole_route(spark, sf_dir)


@job("whole_file_road", f"""
SELECT r.doc_id, r.route, CAST(CASE WHEN r.route = 'ocr_whole' THEN length({CLEAN}) END AS INTEGER) AS n_chars,
       CAST(CASE WHEN r.route = 'ocr_whole' THEN CASE WHEN {CLEAN} = '' THEN 0 ELSE 1 END END AS INTEGER) AS status
FROM ({WHOLE_ROUTE}) r JOIN v_docs d ON d.doc_id = r.doc_id""", (*FV, *(() if "v_docs" in FV else ("v_docs",))), FILES)
def whole_file_road(spark, sf_dir):
    """F7 + X3 + U2: files of the whole-file road through the document function, together with those that need none."""
    routed = _whole_route(spark, sf_dir)
    todo = routed.where("route = 'ocr_whole'")
    read = page_functions.map_documents(T.docs(spark, sf_dir).join(todo, "doc_id", "left_semi"))
    read = todo.join(read, "doc_id").select("doc_id", "route", F.length("text").alias("n_chars"), "status")
    rest = routed.where("route <> 'ocr_whole'").select("doc_id", "route", F.lit(None).cast("int").alias("n_chars"),
                                                       F.lit(None).cast("int").alias("status"))
    return joins.all_outputs(read, rest)


@job("page_outputs_sum_only", """
SELECT c.doc_id, COALESCE(COALESCE(k.n_pdf, 0) + COALESCE(k.n_txt, 0) = 2 * c.num_pages, false) AS complete
FROM v_counts c LEFT JOIN kc k ON k.doc_id = c.doc_id""", ("v_pages", "v_counts", "v_outputs"), KIND_COUNTS)
def page_outputs_sum_only(spark, sf_dir):
    """A3 as the source had it: the sum of PDFs and texts decides."""
    return complete.page_outputs_complete(T.outputs(spark, sf_dir, T.pages(spark, sf_dir)), T.page_totals(spark, sf_dir),
                                          ["pdf", "txt"], sum_only=True)


@job("pending_files_first_only", f"""
SELECT doc_id, sub_dir, stem FROM files f WHERE EXISTS (
  SELECT 1 FROM miss m WHERE m.sub_dir = f.sub_dir AND m.stem = f.stem AND m.kind = '{KINDS[0]}')""", FV, FILES)
def pending_files_first_only(spark, sf_dir):
    """J3 as the source had it: only the first wanted kind is looked for."""
    return complete.pending_files(_files(spark, sf_dir), _outs(spark, sf_dir), KINDS, first_only=True).select(
        "doc_id", "sub_dir", "stem")


def _holders(key: str) -> Column:
    return F.count(F.lit(1)).over(Window.partitionBy(key)).cast("int").alias("holders")


@job("random_keys_checked", """
SELECT id, 36 AS key_length, true AS well_formed, 1 AS holders FROM v_users""", ("v_users",))
def random_keys_checked(spark, sf_dir):
    """The form of each user's fresh key and how many users hold it."""
    keys = T.users(spark, sf_dir).select("id", codes.random_key().alias("k"))
    return keys.select("id", F.length("k").alias("key_length"),
                       F.col("k").rlike(r"\A[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z").alias("well_formed"), _holders("k"))


@job("random_ids_checked", """
SELECT id, 10 AS id_length, true AS well_formed, 1 AS holders FROM v_users""", ("v_users",))
def random_ids_checked(spark, sf_dir):
    """The form of each user's random id and how many users hold it."""
    ids = T.users(spark, sf_dir).select("id", codes.random_id(10).alias("k"))
    return ids.select("id", F.length("k").alias("id_length"), F.col("k").rlike(r"\A[0-9A-Za-z]{10}\z").alias("well_formed"),
                      _holders("k"))


@job("reset_keys_checked", """
SELECT id, email, true AS fresh, 1 AS holders FROM v_users WHERE id % 10 <> 0""", ("v_users",))
def reset_keys_checked(spark, sf_dir):
    """D3: who gets a reset key, whether it differs from the old one, and how many users hold it; unknown addresses get none."""
    users = T.users(spark, sf_dir)
    asked = users.select(F.when(F.col("id") % 10 == 0, F.lit("unknown@example.com")).otherwise(F.col("email")).alias("email"))
    issued = U.issue_reset_keys(users, asked.union(asked)).withColumnRenamed("activation_key", "k")
    old = users.select("id", F.col("activation_key").alias("old"))
    return issued.join(old, "id").select("id", "email", (F.length("k") == 36) & ~F.col("k").eqNullSafe(F.col("old")), _holders("k")).toDF(
        "id", "email", "fresh", "holders")


@job("crawl_files", """
SELECT 'shelf=' || CAST(doc_id % 16 AS VARCHAR) AS sub_dir, CAST(sum(octet_length(encode(COALESCE(text, ''))) + 1) AS BIGINT) AS n_bytes
FROM v_docs GROUP BY doc_id % 16""", ("v_docs",))
def crawl_files(spark, sf_dir):
    """All documents published as text files on shelves, found again by the crawl; sizes by folder, no content read."""
    root = shared_path(spark, "crawl", uuid.uuid4().hex)
    T.docs(spark, sf_dir).select((F.col("doc_id") % 16).alias("shelf"), F.coalesce("text", F.lit("")).alias("text")).write.partitionBy(
        "shelf").text(root)
    return files.scan_documents(spark, root, "txt").groupBy("sub_dir").agg(F.sum("length").alias("n_bytes"))


@job("users_table", "SELECT id, name, email, deposit FROM v_users", ("v_users",))
def users_table(spark, sf_dir):
    """K9 + S7: the user table made twice, each time empty before it is loaded, and read from the catalog."""
    users = T.users(spark, sf_dir)
    name = f"ff_users_{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        table, = writers.init_tables(spark, tables={name: ", ".join(f"`{c}` {t}" for c, t in users.dtypes)})
        users.write.insertInto(table)
    return files.read_users(spark, table, "table").select("id", "name", "email", "deposit")
