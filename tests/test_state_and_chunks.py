"""State log, ordered chunks, carry-forward assignment, splittable reports, hot keys of the row number."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from folioflow.functions import codes
from folioflow.operators.ordering import ordinal_within
from folioflow.plans import images, merge, split
from folioflow.sinks import state_log, writers
from folioflow.sources import files

SCHEMA = "job string, step int, note string"


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_state_log_keeps_other_jobs(spark, scratch):
    path = os.path.join(scratch, "log")
    now = lambda: {r.job: (r.step, r.note) for r in state_log.latest(spark, path, SCHEMA, "job").collect()}
    assert now() == {}
    state_log.append(_rows(spark, *[(f"j{k}", 0, None) for k in range(50)]), path, 0)
    state_log.append(_rows(spark, ("j7", 1, "alone")), path, 1)
    want = {f"j{k}": (0, None) for k in range(50)} | {"j7": (1, "alone")}
    assert now() == want
    # a batch replayed with other content replaces itself
    state_log.append(_rows(spark, ("j8", 5, "x")), path, 2)
    state_log.append(_rows(spark, ("j9", 6, "y")), path, 2)
    want["j9"] = (6, "y")
    assert now() == want
    state_log.compact(spark, path, SCHEMA, "job", upto=1)
    assert now() == want
    state_log.compact(spark, path, SCHEMA, "job", upto=2)
    state_log.compact(spark, path, SCHEMA, "job", upto=2)
    assert now() == want
    # batches behind the snapshot are not read any more
    assert state_log.entries(spark, path, SCHEMA).count() == 50
    state_log.append(_rows(spark, ("j7", 2, None), ("j50", 0, "new")), path, 3)
    assert now() == want | {"j7": (2, None), "j50": (0, "new")}


def test_saved_job_alone_leaves_the_others(spark, scratch):
    path = os.path.join(scratch, "state")
    make = lambda ids, ocr: spark.createDataFrame([(str(i), ocr) for i in ids], "queue_id string, have_ocr string")
    writers.write_job_state(make(range(50), "f"), path, batch_id=1)
    writers.write_job_state(make([7], "t"), path, batch_id=2)
    back = {r.queue_id: r.have_ocr for r in files.read_job_state(spark, path).collect()}
    assert len(back) == 50 and back["7"] == "t" and back["8"] == "f"


def test_three_failed_attempts_are_dead_letters(spark, scratch):
    path = os.path.join(scratch, "attempts")
    log = lambda batch, *rows: state_log.append(spark.createDataFrame(list(rows), "request_id long, tried string, error string").withColumn(
        "tried", F.col("tried").cast("timestamp")), path, batch)
    log(0, (1, "2024-01-20 11:59:50", "busy"), (2, "2024-01-20 11:59:50", "busy"), (3, "2024-01-20 11:59:59", "busy"), (4, "2024-01-20 11:59:50", None))
    log(1, (1, "2024-01-20 11:59:53", "busy"), (2, "2024-01-20 11:59:59", "busy"))
    log(2, (1, "2024-01-20 11:59:56", "busy"))
    log(2, (1, "2024-01-20 11:59:56", "busy"))
    got = {r.request_id: (r.attempts, r.outcome) for r in state_log.attempts(spark, path, now="2024-01-20 12:00:00").collect()}
    assert got == {1: (3, "dead_letter"), 2: (2, "wait"), 3: (1, "retry"), 4: (1, "done")}


@pytest.mark.parametrize("block", [3, 4096])
def test_assign_pages_carries_segments_over_blocks(spark, block):
    segs = spark.createDataFrame([(1, "", 1, 2, 1), (1, "A", 4, 20, 3), (1, "B", 22, 22, 21), (2, "C", 1, 1, 1), (3, "D", 5, 7, 4), (9, "E", 1, 4, 1)],
                                 "doc_id long, barcode string, from_page int, to_page int, page_index int")
    pages = spark.createDataFrame([(d, p, f"{d}-{p}") for d, n in ((1, 25), (2, 3), (3, 8), (4, 2)) for p in range(1, n + 1)],
                                  "doc_id long, page_no int, note string")
    got = split.assign_pages(segs, pages, block_pages=block)
    want = split.assign_pages(segs).join(pages, ["doc_id", "page_no"])
    cols = ["doc_id", "barcode", "from_page", "to_page", "page_no", "new_page_no", "note"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_report_is_read_by_many_tasks(spark, scratch):
    rows = [f" 0.{k % 97:05d}  0.00000  {k}.5  0.02231 CMYK OK" if k % 3 else f"Page {k}" for k in range(1, 20_000)]
    os.makedirs(os.path.join(scratch, "rep"))
    for name, part in (("big", rows), ("small", rows[:7]), ("none", ["Page 1"])):
        with open(os.path.join(scratch, "rep", f"{name}.txt"), "w") as f:
            f.write("\n".join(part) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = images.read_ink_report(spark, os.path.join(scratch, "rep"))
        ranges = spark.read.text(os.path.join(scratch, "rep")).select("_metadata.file_block_start").distinct().count()
        got = sorted((r.doc_id, r.page_idx, tuple(r.ink)) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ranges > 5
    lines = spark.createDataFrame([(n, k, x) for n, part in (("big", rows), ("small", rows[:7])) for k, x in enumerate(part)],
                                  "doc_id string, line_no int, line string")
    assert got == sorted((r.doc_id, r.page_idx, tuple(r.ink)) for r in images.parse_ink_lines(lines).collect())


def test_row_number_of_a_hot_key_with_few_first_values(spark):
    """A document with a third of all rows and seven values in the first order column is spread over its blocks."""
    hot = spark.range(0, 10_000).select(F.lit(1).cast("long").alias("d"), (F.col("id") % 7).cast("int").alias("a"),
                                        (F.col("id") * 31 % 997).alias("b"), F.col("id").alias("c"))
    cold = spark.range(0, 20_000).select((F.col("id") % 5000 + 2).alias("d"), (F.col("id") % 7).cast("int").alias("a"),
                                         (F.col("id") % 13).alias("b"), F.col("id").alias("c"))
    df = hot.unionByName(cold)
    got = ordinal_within(df, "d", ["a", "b", "c"], name="o", hot_rows=1000)
    want = df.withColumn("o", F.row_number().over(Window.partitionBy("d").orderBy("a", "b", "c")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plain = ordinal_within(df, "d", ["a", "b", "c"], name="o")
    assert plain.exceptAll(want).count() == 0
    # the blocks that the windows work on
    size = hot.groupBy("a", "b").count().agg(F.max("count")).first()[0]
    assert size < 100
    nulls = spark.createDataFrame([(None, None, 1), (None, 2, None), (1, None, 5), (1, 1, 1)], "d long, a int, b int")
    for limit in (1, 100):
        got = ordinal_within(nulls, "d", ["a", "b"], name="o", hot_rows=limit)
        assert sorted(r.o for r in got.collect()) == [1, 1, 2, 2]


def test_chunks_and_byte_ranges(spark):
    texts = ["α" * 5, "bc", "", "déf", "g" * 9, "x"]
    pages = spark.createDataFrame([(1, k + 1, t) for k, t in enumerate(texts)] + [(2, 1, "one"), (3, 1, None)], "doc_id long, page_no int, text string")
    chunks = merge.text_chunks(pages, "|", block_pages=2)
    rows = sorted(chunks.collect(), key=lambda r: (r.doc_id, r.chunk))
    whole = "|".join(texts).encode()
    assert "".join(r.text for r in rows if r.doc_id == 1).encode() == whole
    assert [(r.doc_id, r.start) for r in rows] == [(1, 0), (1, len("|".join(texts[:2]).encode())), (1, len("|".join(texts[:4]).encode())), (2, 0)]
    wanted = [(1, a, b) for a in range(0, 30, 4) for b in range(a, 40, 5)] + [(2, 0, 2), (2, 3, 9), (7, 0, 1)]
    got = {}
    for r in sorted(merge.read_range(chunks, spark.createDataFrame(wanted, "doc_id long, from_byte long, to_byte long")).collect(), key=lambda r: r.part):
        got[r.doc_id, r.from_byte, r.to_byte] = got.get((r.doc_id, r.from_byte, r.to_byte), b"") + bytes(r.bytes)
    for d, a, b in wanted:
        assert got.get((d, a, b), b"") == (whole if d == 1 else b"one" if d == 2 else b"")[a:b]


def test_task_lists_first_match(spark):
    state = spark.createDataFrame([("q", '[{"": {"page_index": 1, "is_finish": "t"}}, {"A": {"page_index": 3, "is_finish": "f"}}, {"": {"page_index": 9}}]')],
                                  "queue_id string, tasks string")
    rows = codes.explode_tasks(state)
    assert sorted((r.task_pos, r.barcode, r.page_index, r.is_finish) for r in rows.collect()) == [(0, "", 1, True), (1, "A", 3, False), (2, "", 9, None)]
    assert sorted((r.barcode, r.task_pos, r.page_index) for r in codes.first_task(rows).collect()) == [("", 0, 1), ("A", 1, 3)]


def test_hot_box_is_written_by_several_tasks(spark, scratch):
    arts = spark.range(0, 200_000).select(F.lit("B1").alias("box_number"), F.lit("P1").alias("box_part"), F.lit("pdf").alias("kind"),
                                          F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        writers.write_package(arts, os.path.join(scratch, "pkg"))
    finally:
        spark.conf.set(key, before)
    folder = os.path.join(scratch, "pkg", "box_number=B1", "box_part=P1")
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) > 3
    assert spark.read.parquet(folder).count() == 200_000


def test_page_view_scans(spark):
    """The flagship counts pages on the rows and never numbers them for a count."""
    from __spark_entry__ import queries
    sf = "/root/testdata/sf0.001"
    for name, most in (("page_counts", 1), ("color_device", 1)):
        plan = queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") <= most and "Window" not in plan, name


def test_sync_copies_only_what_differs(spark, scratch):
    dst = os.path.join(scratch, "copy")
    make = lambda rows: spark.createDataFrame(rows, "id long, name string")
    rows = [(k, f"n{k}") for k in range(200)] + [(5, "n5"), (None, None)]
    now = lambda: sorted(map(tuple, writers.read_synced(spark, dst).collect()), key=str)
    assert writers.sync_difference(make(rows), dst, "id", buckets=16) == 16 and now() == sorted(rows, key=str)
    assert writers.sync_difference(make(rows[::-1]), dst, "id", buckets=16) == 0        # the order does not matter
    rows[7] = (7, None)
    assert writers.sync_difference(make(rows), dst, "id", buckets=16) == 1 and now() == sorted(rows, key=str)
    rows.remove((5, "n5"))                                                              # one of two equal rows
    assert writers.sync_difference(make(rows), dst, "id", buckets=16) == 1 and now() == sorted(rows, key=str)
    assert writers.sync_difference(make(rows[:3]), dst, "id", buckets=16) > 1 and now() == rows[:3]
    assert writers.sync_difference(make([]), dst, "id", buckets=16) > 0 and now() == []


def test_search_many_against_single_searches(spark):
    from folioflow.operators import filters
    users = spark.createDataFrame([(1, "Anna Berg", "anna@x.org"), (2, "BERGER", None), (3, "Åsa_b", "a%b@y.org"), (4, None, None), (5, "", "q@x.org")],
                                  "id long, name string, email string")
    asked = ["berg", "ANNA berg", "a", "x.org", "b_rg", "%", "", "  ", "zz", "a%a", "_", "an x.o", "åsa", "g@nobody"]
    got = {}
    for r in filters.search_many(users, spark.createDataFrame(list(enumerate(asked)), "search_id int, keywords string")).collect():
        got.setdefault(r.search_id, set()).add(r.id)
    for k, words in enumerate(asked):
        assert got.get(k, set()) == {r.id for r in filters.search_users(users, words).collect()}, words


def test_search_many_searches_equal_keywords_once(spark, scratch):
    """Searches with the same words share one pass over the users; each still gets all of its rows."""
    import os
    import re
    from folioflow.operators import filters
    users, searches = os.path.join(scratch, "users"), os.path.join(scratch, "searches")
    spark.range(40).selectExpr("id", "concat('name', id) AS name", "'q@x.org' AS email").write.parquet(users)
    spark.range(300).selectExpr("id AS search_id", "concat('NAME', id % 3) AS keywords").write.parquet(searches)
    found = filters.search_many(spark.read.parquet(users), spark.read.parquet(searches))
    want = {(s, u) for s in range(300) for u in range(40) if str(u).startswith(str(s % 3))}
    got = [(r.search_id, r.id) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want
    # the users are verified before the searches of a set are joined: no join below the filter knows a search
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    forall = next(x for x in plan.splitlines() if "forall(" in x)
    assert "search_id" not in forall
    below = plan[plan.index(forall):]
    depth = len(re.match(r"[\s:+|-]*", forall).group())
    inside = []
    for line in below.splitlines()[1:]:
        if len(re.match(r"[\s:+|-]*", line).group()) <= depth:
            break
        inside.append(line)
    # below it searches appear only where equal keyword sets are reduced to one
    assert not any(x.lstrip(" :+|-").startswith("Project [search_id") for x in inside)


def test_searches_are_not_sent_through_the_driver(spark, scratch):
    """The copies of the searches come from a small file and are many; they are shuffled, not broadcast."""
    import os
    from folioflow.operators import filters
    users, searches = os.path.join(scratch, "users"), os.path.join(scratch, "searches")
    spark.range(40).selectExpr("id", "concat('name', id) AS name", "'q@x.org' AS email").write.parquet(users)
    spark.range(5000).selectExpr("id AS search_id", "concat('NAME', id % 3) AS keywords").write.parquet(searches)
    found = filters.search_many(spark.read.parquet(users), spark.read.parquet(searches))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # the join of the searches is the topmost one
    join = next(x for x in plan.splitlines() if "Join" in x)
    assert "SortMergeJoin" in join and "_part" in join, join
