"""Streams: trigger filter + restart without repeats (T1, T2, T5), dead letters (T4), completion state."""

from __future__ import annotations

import os
import time

from pyspark.sql import functions as F

from folioflow.streaming import requests as rq

SCHEMA = "event_id long, value string, body string"


def _write_batch(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, name))


def test_request_stream_restart_adds_nothing(spark, scratch):
    src = os.path.join(scratch, "msgs")
    ck = os.path.join(scratch, "ck")
    out = os.path.join(scratch, "out")
    _write_batch(spark, src, [(1, "pdf process request", "{}"), (2, "noise", "{}"), (3, "pdf process request", "{}")],
                 "b1")

    def handle(batch, batch_id):
        # idempotent per batch id: overwrite this batch's folder
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))

    def run():
        q = rq.start_request_stream(spark, src + "/*", SCHEMA, ck, handle, max_files_per_trigger=1,
                                    available_now=True)
        q.awaitTermination()

    run()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 3]
    run()  # restart on a finished checkpoint
    assert spark.read.parquet(out).count() == 2
    _write_batch(spark, src, [(4, "pdf process request", "{}")], "b2")
    run()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 3, 4]


def test_dead_letters(spark):
    msgs = spark.createDataFrame([(1, "pdf process request", '{"k": 1}'), (2, "other", '{"k": 2}'),
                                  (3, "", None), (4, "pdf process request", "{not json")], SCHEMA)
    got = {r.event_id: (r.outcome, r.reason) for r in rq.classify_messages(msgs).collect()}
    assert got[1] == ("task", None)
    assert got[2] == ("dead_letter", "unknown")
    assert got[3] == ("dead_letter", "empty")
    assert got[4][0] == "dead_letter"


def test_completion_tracker_completes_and_times_out(spark, scratch):
    src = os.path.join(scratch, "pages")
    schema = "doc_id long, page_no int"
    spark.createDataFrame([(1, 1), (1, 2), (2, 1)], schema).coalesce(1).write.parquet(os.path.join(src, "a"))
    counts = spark.createDataFrame([(1, 2), (2, 2)], "doc_id long, num_pages int")
    stream = spark.readStream.schema(schema).parquet(src + "/*")
    tracked = rq.track_completion(stream, counts, timeout_ms=2000)
    q = (tracked.writeStream.format("memory").queryName("ff_track_test").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            rows = {r.doc_id: r.status for r in spark.table("ff_track_test").collect()}
            if rows.get(2) == "timed_out":
                break
            time.sleep(1)
    finally:
        q.stop()
    rows = {r.doc_id: (r.status, r.pages_seen) for r in spark.table("ff_track_test").collect()}
    assert rows[1] == ("complete", 2)
    assert rows[2] == ("timed_out", 1)


def test_retry_eligible(spark):
    df = spark.createDataFrame([(1, 0, "2024-01-20 11:59:59"), (2, 2, "2024-01-20 11:59:59"),
                                (3, 2, "2024-01-20 11:59:58"), (4, 3, "2024-01-01 00:00:00")],
                               "id int, attempts int, last_try string")
    got = {r.id: r.ok for r in df.select("id", rq.retry_eligible(df, "2024-01-20 12:00:00").alias("ok")).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False}


def test_wrap_messages_stable_id(spark):
    df = spark.createDataFrame([(1, "pdf process request", None)], SCHEMA)
    a = rq.wrap_messages(df).first().envelope
    b = rq.wrap_messages(df).first().envelope
    assert a == b and '"task":"ai.pdf_request"' in a and F is not None


def test_rate_cap_one_file_per_batch(spark, scratch):
    src = os.path.join(scratch, "msgs")
    for i in range(3):
        _write_batch(spark, src, [(i, "pdf process request", "{}")], f"b{i}")
    seen = []

    def handle(batch, batch_id):
        seen.append((batch_id, batch.count()))

    q = rq.start_request_stream(spark, src + "/*", SCHEMA, os.path.join(scratch, "ck"), handle,
                                max_files_per_trigger=1, available_now=True)
    q.awaitTermination()
    assert [n for _, n in sorted(seen) if n] == [1, 1, 1]


def test_wake_messages_pick_next_records_once(spark, scratch):
    src = os.path.join(scratch, "msgs")
    outbox = os.path.join(scratch, "outbox")
    queue = spark.createDataFrame([(10, 2), (11, 1), (12, 3), (13, 1)], "queue_id long, priority_id int")
    handle = rq.pick_next_records(queue, outbox)
    _write_batch(spark, src, [(1, "pdf process request", "{}"), (2, "noise", "{}")], "b1")

    def run():
        q = rq.start_request_stream(spark, src + "/*", SCHEMA, os.path.join(scratch, "ck"), handle,
                                    available_now=True)
        q.awaitTermination()

    run()
    assert [r.queue_id for r in spark.read.parquet(outbox).collect()] == [11]
    handle(spark.createDataFrame([(1, "pdf process request", "{}")], SCHEMA), 0)  # replay of batch 0
    assert [r.queue_id for r in spark.read.parquet(outbox).collect()] == [11]
    _write_batch(spark, src, [(3, "pdf process request", "{}"), (4, "pdf process request", "{}")], "b2")
    run()
    assert sorted(r.queue_id for r in spark.read.parquet(outbox).collect()) == [10, 11, 13]


def test_dead_letter_batch_two_sinks(spark):
    msgs = spark.createDataFrame([(1, "pdf process request", '{"k": 1}'), (2, "other", '{"k": 2}'),
                                  (3, "pdf process request", "{bad")], SCHEMA)
    got = {}
    rq.dead_letter_batch(msgs, lambda df: got.setdefault("task", sorted(r.event_id for r in df.collect())),
                         lambda df: got.setdefault("dead", sorted(r.event_id for r in df.collect())))
    assert got == {"task": [1], "dead": [2, 3]}


def _logged(spark, folder, rows, name):
    spark.createDataFrame(rows, "doc_id long, page_no int").coalesce(1).write.parquet(os.path.join(folder, name))


def test_late_pages_after_restart(spark, scratch):
    """A page after the time-out is late, still counts over a restart, and the status equals the batch count."""
    src, out, ck = (os.path.join(scratch, x) for x in ("pages", "out", "ck"))
    counts = spark.createDataFrame([(1, 3), (2, 2), (3, 1), (4, 70)], "doc_id long, num_pages int")

    def run(**trigger):
        stream = spark.readStream.schema("doc_id long, page_no int").parquet(src + "/*")
        w = rq.track_completion(stream, counts, timeout_ms=1, block_pages=32).writeStream.format("parquet")
        w.option("path", out).option("checkpointLocation", ck).trigger(**trigger).start().awaitTermination()

    _logged(spark, src, [(1, 1), (1, 1), (2, 2), (3, 1), (9, 1), (2, 5), (2, 0)] + [(4, p) for p in range(1, 41)], "a")
    with rq.drained(spark):
        run(availableNow=True)
        _logged(spark, src, [(-1, 0)], "heartbeat")                                     # no document, but a batch
        run(availableNow=True)
    status = lambda: {r.doc_id: (r.status, r.pages_seen) for r in rq.document_status(spark.read.parquet(out)).collect()}
    assert status() == {1: ("timed_out", 1), 2: ("timed_out", 1), 3: ("complete", 1), 4: ("timed_out", 40)}
    seen = {(r.doc_id, r.page_no) for r in rq.tracked_pages(spark, ck, block_pages=32).collect()}
    assert seen == {(1, 1), (2, 2), (3, 1)} | {(4, p) for p in range(1, 41)}
    _logged(spark, src, [(1, 2), (1, 3), (1, 2)] + [(4, p) for p in range(30, 71)], "b")
    with rq.drained(spark):
        run(availableNow=True)
    late = sorted((r.doc_id, r.page_no) for r in rq.late_pages(spark.read.parquet(out)).collect())
    # pages 65 to 70 of document 4 open a block of their own
    assert late == [(1, 2), (1, 3)] + [(4, p) for p in range(41, 65)]
    assert status() == {1: ("complete", 3), 2: ("timed_out", 1), 3: ("complete", 1), 4: ("complete", 70)}


def test_timers_and_expiring_state(spark, scratch):
    """The tracker with timers and map state: late pages, restart, audit from the checkpoint."""
    from folioflow.streaming import completion as cp
    src, out, ck = (os.path.join(scratch, x) for x in ("pages", "out", "ck"))
    counts = spark.createDataFrame([(1, 3), (2, 2), (3, 130)], "doc_id long, num_pages int")

    def run(**trigger):
        stream = spark.readStream.schema("doc_id long, page_no int").parquet(src + "/*")
        w = cp.track_pages(stream, counts, timeout_ms=1, block_pages=128).writeStream.format("parquet")
        w.option("path", out).option("checkpointLocation", ck).trigger(**trigger).start().awaitTermination()

    _logged(spark, src, [(1, 1), (1, 1), (2, 1), (2, 2), (2, 7), (8, 1)] + [(3, p) for p in range(1, 128)], "a")
    with cp.state_settings(spark, drain=True):
        run(availableNow=True)
        assert {(r.doc_id, r.block, r.pages_seen) for r in cp.open_blocks(spark, ck).collect()} == {(1, 0, 1), (3, 0, 127)}
        seen = {(r.doc_id, r.page_no) for r in cp.seen_pages(spark, ck, block_pages=128).collect()}
        assert seen == {(1, 1), (2, 1), (2, 2)} | {(3, p) for p in range(1, 128)}
        _logged(spark, src, [(-1, 0)], "heartbeat")
        run(availableNow=True)
    status = lambda: {r.doc_id: r.status for r in cp.document_status(spark.read.parquet(out), counts).collect()}
    assert status() == {1: "timed_out", 2: "complete", 3: "timed_out"}
    _logged(spark, src, [(1, 3), (1, 2), (3, 64), (3, 128), (3, 129), (3, 130)], "b")
    with cp.state_settings(spark, drain=True):
        run(availableNow=True)
        assert cp.open_blocks(spark, ck).count() == 0
    assert sorted(map(tuple, cp.late_pages(spark.read.parquet(out)).collect())) == [(1, 2), (1, 3), (3, 128)]
    assert status() == {1: "complete", 2: "complete", 3: "complete"}


def test_cursor_caps_batches_and_replays(spark, scratch):
    """No batch beyond its tokens, owed requests served later, a replayed batch picks the same, ranks once each."""
    from folioflow.streaming import queue_cursor as qc
    queue = spark.createDataFrame([(k, k % 3) for k in range(100)], "queue_id long, priority_id int").repartition(7)
    at = lambda x: os.path.join(scratch, x)
    qc.rank_queue(queue, at("queue"))
    ranked = [r.queue_id for r in qc.ranked_queue(spark, at("queue")).orderBy("rank").collect()]
    assert ranked == sorted(range(100), key=lambda k: (k % 3, k))
    assert [r.rank for r in qc.ranked_queue(spark, at("queue")).orderBy("rank").collect()] == list(range(1, 101))
    time_now = [0.0]
    cursor = qc.QueueCursor(spark, at("cursor"), rate=2, burst=10, clock=lambda: time_now[0])
    handle = qc.pick_by_cursor(spark, at("queue"), at("out"), cursor)
    woken = lambda n: spark.range(n)
    handle(woken(4), 0)                              # 10 tokens, 6 left
    handle(woken(30), 1)                             # 6 served, 24 owed
    assert cursor.owed() == 24
    time_now[0] = 3.0
    handle(woken(0), 2)                              # three seconds: 6 more
    time_now[0] = 60.0
    handle(woken(30), 1)                             # replay: as before
    handle(woken(500), 3)                            # the bucket holds 10
    out = {}
    for r in spark.read.parquet(at("out")).collect():
        out.setdefault(r.batch_id, []).append(r["rank"])
    assert {k: (min(v), max(v), len(v)) for k, v in out.items()} == {0: (1, 4, 4), 1: (5, 10, 6), 2: (11, 16, 6), 3: (17, 26, 10)}
    # a new cursor on the same log goes on; requests beyond the queue's end are not owed
    again = qc.QueueCursor(spark, at("cursor"), rate=2, burst=1000, clock=lambda: 10_000.0)
    handle = qc.pick_by_cursor(spark, at("queue"), at("out"), again)
    handle(woken(0), 4)
    got = sorted(r["rank"] for r in spark.read.parquet(at("out")).collect())
    assert got == list(range(1, 101)) and again.owed() == 0
    plan = qc.ranked_queue(spark, at("queue")).where("rank BETWEEN 3 AND 9")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rank,3)" in plan and "Exchange" not in plan


def test_segments_stream_equals_batch_plan(spark, scratch):
    """Pages in any order over several batches: each segment comes once, no earlier than it can, and all of them equal the batch plan."""
    import random
    from folioflow.plans import split
    from folioflow.streaming.segments import SegmentStream
    rng = random.Random(11)
    sizes = {d: rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 40, 70]) for d in range(60)}
    rate = {d: rng.choice([0, 0.05, 0.3, 0.8]) for d in sizes}
    pages = [(d, p, f"NEU_{p}{rng.choice(['', ' '])}" if rng.random() < rate[d] else rng.choice([None, "NEU", "XYZ_12"]))
             for d, n in sizes.items() for p in range(1, n + 1)]
    schema = "doc_id long, page_no int, barcode string"
    counts = spark.createDataFrame(list(sizes.items()), "doc_id long, num_pages int")
    table = spark.createDataFrame(pages, schema)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    want = rows(split.split_plan(table, docs=counts))
    shuffled = pages[:]
    rng.shuffle(shuffled)
    src, found = os.path.join(scratch, "pages"), []
    noise = [(0, 0, "NEU_before"), (0, sizes[0] + 1, "NEU_after"), (999, 1, "NEU_nowhere")]
    for k in range(3):
        part = shuffled[k::3] + noise + (shuffled[0::3][:200] if k else [])           # some pages are reported again
        spark.createDataFrame(part, schema).coalesce(2).write.parquet(os.path.join(src, str(k)))
        stream = SegmentStream(spark, scratch + "/plan", counts, block_pages=8)       # a new object: a restart
        stream.drain(spark.readStream.schema(schema).parquet(src + "/*"))
        found.append(rows(stream.segments()))
        assert set(found[-1]) <= set(want)
    assert found[2] == want and 0 < len(found[0]) < len(found[1]) < len(want)
    assert rows(stream.segments(True)) == rows(split.split_plan(table, True, counts))
    flags = counts.withColumn("keep", F.col("doc_id") % 2 == 0)
    assert rows(stream.segments("keep", flags)) == rows(split.split_plan(table, "keep", flags))
    assert rows(stream.segments(keep_leading=True)) == rows(split.split_plan(table, docs=counts, keep_leading=True))


def test_many_documents_share_stateful_groups(spark, scratch):
    """State rows are bounded by the shards, not by the documents; late pages and statuses stay exact over a restart."""
    src, out, ck = (os.path.join(scratch, x) for x in ("pages", "out", "ck"))
    sizes = {d: 1 + d % 6 for d in range(1, 401)}
    counts = spark.createDataFrame(list(sizes.items()), "doc_id long, num_pages int")

    def run(rows, name):
        _logged(spark, src, rows, name)
        stream = spark.readStream.schema("doc_id long, page_no int").parquet(src + "/*")
        w = rq.track_completion(stream, counts, timeout_ms=1, block_pages=4, shards=5).writeStream.format("parquet")
        with rq.drained(spark):
            w.option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()

    pages = [(d, p) for d, n in sizes.items() for p in range(1, n + 1)]
    run([x for x in pages if x[1] % 2] + [(None, 1), (1, None)], "a")
    run([(-1, 0)], "heartbeat")
    assert spark.read.format("statestore").option("path", ck).load().count() <= 5
    assert {tuple(r) for r in rq.tracked_pages(spark, ck, block_pages=4).collect()} == {x for x in pages if x[1] % 2}
    run([x for x in pages if x[1] % 2 == 0] * 2, "b")
    events = spark.read.parquet(out)
    # pages 5 and 6 are in a block of their own, so page 6 comes after that one's time-out too
    assert sorted(map(tuple, rq.late_pages(events).collect())) == [x for x in pages if x[1] % 2 == 0]
    assert {tuple(r) for r in rq.document_status(events).collect()} == {(d, n, n, "complete") for d, n in sizes.items()}
    last = events.where("status = 'late'").groupBy("doc_id", "block").agg(F.max("pages_seen").alias("seen"), F.max("block_pages").alias("size"))
    assert last.where("seen <> size").count() == 0


def test_cursor_opens_only_the_folders_of_its_ranks(spark, scratch, monkeypatch):
    """A batch reads the folders of its own ranks, however long the queue is; ranks over an edge come whole."""
    from folioflow.streaming import queue_cursor as qc
    monkeypatch.setattr(qc, "FOLDER_RANKS", 16)
    at = lambda x: os.path.join(scratch, x)
    qc.rank_queue(spark.range(200).select(F.col("id").alias("queue_id"), F.lit(1).alias("priority_id")), at("queue"))
    assert qc.ranked_queue(spark, at("queue")).columns == ["queue_id", "priority_id", "rank"]
    part = qc.ranks_between(spark, at("queue"), 10, 20)
    assert sorted(r["rank"] for r in part.collect()) == list(range(10, 21))
    folders = {f.split("_folder=")[1].split("/")[0] for f in part.inputFiles()}
    assert folders == {"0", "1"} and len(qc.ranked_queue(spark, at("queue")).inputFiles()) > len(part.inputFiles())


def test_owed_requests_are_served_by_few_jobs(spark, scratch, monkeypatch):
    """Heartbeats are logged and picked many at a time; batches and log are those of one heartbeat after the other."""
    from folioflow.sinks import state_log
    from folioflow.streaming import queue_cursor as qc
    at = lambda *x: os.path.join(scratch, *x)
    qc.rank_queue(spark.range(90).select(F.col("id").alias("queue_id"), (F.col("id") % 3).cast("int").alias("priority_id")), at("queue"))
    reads, between = [], qc.ranks_between
    monkeypatch.setattr(qc, "ranks_between", lambda *a: reads.append(a) or between(*a))
    monkeypatch.setattr(qc, "COMPACT_EVERY", 8)
    found, logs = {}, {}
    for way in ("single", "many"):
        ticks = iter(range(0, 1000, 2))
        cursor = qc.QueueCursor(spark, at(way, "cursor"), rate=2.5, burst=7, clock=lambda: next(ticks))
        handle = qc.pick_by_cursor(spark, at("queue"), at(way, "out"), cursor)
        handle(spark.range(60), 0)
        if way == "single":
            k = 0
            while cursor.owed():
                k += 1
                handle(spark.range(0), k)
            end = k + 1
        else:
            reads.clear()
            assert qc.serve_owed(spark, at("queue"), at(way, "out"), cursor, 1, beats=5) == end
            assert len(reads) == -(-(end - 1) // 5) < 4
            # a replay hands out the same ranks; nothing owed, nothing done
            assert cursor.beats(end - 1, 90) == [(end - 1, 58, 60)]
            assert qc.serve_owed(spark, at("queue"), at(way, "out"), cursor, end) == end
        found[way] = sorted((r.batch_id, r["rank"], r.queue_id) for r in spark.read.parquet(at(way, "out")).collect())
        logs[way] = {tuple(r) for r in state_log.entries(spark, at(way, "cursor"), qc.ENTRY).where(f"batch_id >= {end - 2}").collect()}
    assert found["many"] == found["single"] and [x[1] for x in found["many"]] == list(range(1, 61))
    assert logs["many"] == logs["single"]
