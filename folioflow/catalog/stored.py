"""Jobs that write with a sink and read the files back (S1, S6, K1, K2, K4, K8, T1, T2), and requests in their envelope.

Each job writes below a fresh folder of the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import codes
from ..plans import merge, split
from ..session import shared_path
from ..sinks import state_log, writers
from ..sources import files
from ..sources import tables as T
from ..streaming import queue_cursor as qc
from ..streaming import requests as rq
from . import job
from .records import REC, RV, non_bulk, records


def _folder(spark, name: str) -> str:
    return shared_path(spark, "jobs", f"{name}-{uuid.uuid4().hex}")


@job("scan_documents")
def scan_documents(spark, sf_dir):
    """Every table file of the data folder (paths differ by machine: rows-only check)."""
    return files.scan_documents(spark, sf_dir, "parquet")


@job("write_package", """
SELECT 'B' || CAST(q.queue_id % 20 AS VARCHAR) AS box_number, 'P' || q.box_part AS box_part, o.doc_id, o.kind, o.page_no
FROM v_outputs o JOIN v_queue q ON q.queue_id = o.doc_id WHERE o.kind NOT IN ('temp', 'state')""",
     ("v_pages", "v_outputs", "v_queue"))
def write_package(spark, sf_dir):
    """K1: outputs published by box, without temp files and job state, read back."""
    q = T.queue(spark, sf_dir).select(
        F.col("queue_id").alias("doc_id"), F.concat(F.lit("B"), (F.col("queue_id") % 20).cast("string")).alias("box_number"),
        F.concat(F.lit("P"), F.col("box_part")).alias("box_part"))
    path = _folder(spark, "package")
    writers.write_package(T.outputs(spark, sf_dir).join(q, "doc_id"), path)
    return spark.read.parquet(path).select("box_number", "box_part", "doc_id", "kind", "page_no")


WS = r"[\t\n\x0B\f\r ]"


@job("write_page_text", f"""
SELECT doc_id, page_no, regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') AS text FROM v_page_text""", ("v_page_text",))
def write_page_text(spark, sf_dir):
    """K2: page texts written by bucket of the document, read back."""
    path = _folder(spark, "page_text")
    writers.write_page_text(T.page_text(spark, sf_dir), path, buckets=16)
    return spark.read.parquet(path).select("doc_id", "page_no", "text")


@job("write_job_state", """
SELECT CAST(queue_id AS VARCHAR) AS queue_id, box_number, box_part, profile_id, image_id,
       COALESCE(keep_barcode_ind, 't') AS keep_barcode_ind, COALESCE(has_interactive, 'f') AS have_ocr, 'f' AS add_pages
FROM v_queue""", ("v_queue",))
def write_job_state(spark, sf_dir):
    """K4 + S6: job states written as JSON lines and read back with their defaults."""
    q = T.queue(spark, sf_dir)
    state = q.select(F.col("queue_id").cast("string").alias("queue_id"), "box_number", "box_part", "profile_id", "image_id",
                     "keep_barcode_ind", F.col("has_interactive").alias("have_ocr"))
    path = _folder(spark, "job_state")
    writers.write_job_state(state, path)
    return files.read_job_state(spark, path).select(
        "queue_id", "box_number", "box_part", "profile_id", "image_id", "keep_barcode_ind", "have_ocr", "add_pages")


@job("job_state_log", """
SELECT CAST(queue_id AS VARCHAR) AS queue_id, box_number, CASE WHEN queue_id % 3 = 0 THEN 't' ELSE 'f' END AS add_pages FROM v_queue""",
     ("v_queue",))
def job_state_log(spark, sf_dir):
    """K4 + S6: all jobs saved, then some of them again on their own, before and after a compaction; a batch is saved twice."""
    path = _folder(spark, "state_log")
    state = T.queue(spark, sf_dir).select(F.col("queue_id").cast("string").alias("queue_id"), "box_number",
                                          F.lit("f").alias("add_pages"), (F.col("queue_id") % 3 == 0).alias("again"))
    again = state.where("again").drop("again")
    writers.write_job_state(state.drop("again"), path, batch_id=1)
    writers.write_job_state(again.withColumn("add_pages", F.lit("x")), path, batch_id=2)
    state_log.compact(spark, path, files.JOB_STATE_SCHEMA, "queue_id", upto=2)
    for _ in range(2):                               # the second time as after a restart
        writers.write_job_state(again.withColumn("add_pages", F.lit("t")), path, batch_id=3)
    return files.read_job_state(spark, path).select("queue_id", "box_number", "add_pages")


@job("retry_log", """
SELECT event_id AS request_id, CAST(least(event_id % 5 + 1, 4) AS INTEGER) AS attempts,
  CASE WHEN event_id % 5 = 4 THEN 'done' WHEN event_id % 5 >= 2 THEN 'dead_letter'
       WHEN TIMESTAMP '2024-01-20 12:00:00' >= ts + to_seconds(2 * (event_id % 5 + 1)) THEN 'retry' ELSE 'wait' END AS outcome
FROM v_messages""", ("v_messages",))
def retry_log(spark, sf_dir):
    """Attempts logged batch by batch (one replayed); three failures end in dead letters, a success ends the request."""
    path = _folder(spark, "attempts")
    m = T.messages(spark, sf_dir).select(F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("ts"))
    for k in (0, 1, 2, 3, 3):
        failed = F.when((F.col("request_id") % 5 == 4) & F.lit(k == 3), F.lit(None)).otherwise(F.lit("busy"))
        state_log.append(m.where(F.col("request_id") % 5 >= k).select("request_id", (
            F.col("ts") + F.expr(f"INTERVAL {k} SECOND")).alias("tried"), failed.alias("error")), path, batch_id=k)
    return state_log.attempts(spark, path, now="2024-01-20 12:00:00")


@job("sync_table", "SELECT id, name, email, role_code FROM v_users", ("v_users",))
def sync_table(spark, sf_dir):
    """K8: the user table copied over another one and read back."""
    src, dst = _folder(spark, "users"), _folder(spark, "users_copy")
    T.users(spark, sf_dir).drop("avatar").write.parquet(src)
    writers.sync_table(spark, src, dst)
    return spark.read.parquet(dst).select("id", "name", "email", "role_code")


@job("sync_difference", """
SELECT id, CASE WHEN id = (SELECT max(id) FROM v_users) THEN 'changed' ELSE name END AS name, email, role_code, 1 AS copied, 0 AS copied_again
FROM v_users""", ("v_users",))
def sync_difference(spark, sf_dir):
    """K8 as a difference: the user table copied, one row changed (one bucket is copied), nothing changed (none is)."""
    dst = _folder(spark, "users_difference")
    users = T.users(spark, sf_dir).select("id", "name", "email", "role_code")
    last = users.agg(F.max("id")).scalar()
    changed = users.withColumn("name", F.when(F.col("id") == last, "changed").otherwise(F.col("name")))
    writers.sync_difference(users, dst, "id", buckets=64)
    copied, again = [writers.sync_difference(changed, dst, "id", buckets=64) for _ in range(2)]
    return writers.read_synced(spark, dst).select("id", "name", "email", "role_code", F.lit(copied).alias("copied"), F.lit(again).alias("copied_again"))


@job("request_stream", """
SELECT queue_id FROM v_queue ORDER BY COALESCE(priority, 3), queue_id
LIMIT (SELECT count(*) FROM v_messages WHERE value = 'purchase')""", ("v_queue", "v_messages"))
def request_stream(spark, sf_dir):
    """T1 + T2 + T5: the message folder consumed as a stream; each woken message picks the next record."""
    from ..operators.filters import decode_flags
    root = _folder(spark, "requests")
    T.messages(spark, sf_dir).drop("body").write.parquet(f"{root}/messages")
    handle = rq.pick_next_records(decode_flags(T.queue(spark, sf_dir)).select("queue_id", "priority_id"), f"{root}/outbox")
    q = rq.start_request_stream(spark, f"{root}/messages", "event_id long, value string, ts timestamp_ntz", f"{root}/state",
                                handle, trigger="purchase", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(f"{root}/outbox").select("queue_id")


@job("capped_request_stream", """
SELECT queue_id, rank, true AS within_cap
FROM (SELECT queue_id, row_number() OVER (ORDER BY COALESCE(priority, 3), queue_id) AS rank FROM v_queue)
WHERE rank <= (SELECT count(*) FROM v_messages WHERE value = 'purchase')""", ("v_queue", "v_messages"))
def capped_request_stream(spark, sf_dir):
    """T1 + T2 + O2: the queue ranked once, messages consumed as a stream; no batch picks more than its tokens.

    A batch stands for ten seconds of a hundred workers at five tasks a second;
    what is owed after the last message is served by heartbeats.
    """
    from ..operators.filters import decode_flags
    root = _folder(spark, "capped")
    T.messages(spark, sf_dir).drop("body").repartition(4).write.parquet(f"{root}/messages")
    qc.rank_queue(decode_flags(T.queue(spark, sf_dir)).select("queue_id", "priority_id"), f"{root}/queue")
    ticks = iter(range(0, 10 * 1_000_000, 10))
    cap = 100 * rq.MAX_TASKS_PER_SECOND * 10
    cursor = qc.QueueCursor(spark, f"{root}/cursor", rate=cap / 10, burst=cap, clock=lambda: next(ticks))
    handle = qc.pick_by_cursor(spark, f"{root}/queue", f"{root}/outbox", cursor)
    seen = []

    def batch(df, batch_id):
        seen.append(batch_id)
        handle(df, batch_id)

    q = rq.start_request_stream(spark, f"{root}/messages", "event_id long, value string, ts timestamp_ntz", f"{root}/state",
                                batch, trigger="purchase", max_files_per_trigger=2, available_now=True)
    q.awaitTermination()
    if cursor.owed():
        qc.serve_owed(spark, f"{root}/queue", f"{root}/outbox", cursor, seen[-1] + 1)
    picked = spark.read.parquet(f"{root}/outbox")
    sizes = picked.groupBy("batch_id").agg((F.count(F.lit(1)) <= cap).alias("within_cap"))
    return picked.join(sizes, "batch_id").select("queue_id", "rank", "within_cap")


@job("mark_processed_request", """
SELECT queue_id, '{"Request":{"api_key":"k","api_sig":"s","bookmarkProcessQueueId":"' || CAST(queue_id AS VARCHAR) ||
       '","processed":"true","machineName":"m1"}}' AS request
FROM rec WHERE NOT bulk""", RV, REC)
def mark_processed_request(spark, sf_dir):
    """K7 + C18: the processed mark in its request envelope, per non-bulk record."""
    done = non_bulk(spark, sf_dir).select("queue_id", F.lit(True).alias("finished"))
    return merge.mark_processed_request(done, root="Request", key="k", signature="s", machine="m1")


@job("add_pages_request", """
SELECT r.queue_id, '{"Request":{"api_key":"k","api_sig":"s","bookmark_process_queue_id":"' || CAST(r.queue_id AS VARCHAR) ||
  '","pages":[' || array_to_string(list_transform(range(1, c.num_pages + 1), lambda i: '{"path":"' || r.box_number || '/' ||
  r.box_part || '/' || CAST(r.queue_id AS VARCHAR) || '_' || lpad(CAST(i AS VARCHAR), 6, '0') || '.pdf","version":"' ||
  CAST(i AS VARCHAR) || '"}'), ',') || '],"machineName":"m1"}}' AS request
FROM rec r JOIN v_counts c ON c.doc_id = r.queue_id""", RV + ("v_pages", "v_counts"), REC)
def add_pages_request(spark, sf_dir):
    """K6 + C18: the page list in its request envelope."""
    r = records(spark, sf_dir).select("queue_id", "box_number", "box_part", F.col("queue_id").cast("string").alias("pdf_name"))
    c = T.page_totals(spark, sf_dir).withColumnRenamed("doc_id", "queue_id")
    return merge.add_pages_request(r.join(c, "queue_id"), root="Request", key="k", signature="s", machine="m1")


@job("random_id")
def random_id(spark, sf_dir):
    """A fresh id of ten letters and digits per user (rows-only check)."""
    return T.users(spark, sf_dir).select("id", codes.random_id(10).alias("new_id"))
