"""Plan shape and skew: no nested-loop joins, filters pushed to the scan, hot documents split."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from __spark_entry__ import queries
from folioflow.operators.ordering import neighbours_within, ordinal_within
from folioflow.plans import complete, merge, page_functions

SF = "/root/testdata/sf0.001"
# J5 attaches run settings with a one-row-per-run broadcast; every other job is equi-joined.
NO_NESTED_LOOP = ["split_plan", "assign_pages", "resume_segments", "match_logins", "pending_files", "done_files",
                  "document_complete", "redo_pages", "taken_names"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop(spark):
    for name in NO_NESTED_LOOP:
        p = _plan(queries()[name](spark, SF))
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name


def test_filters_and_columns_reach_scan(spark):
    df = queries()["wake_messages"](spark, SF)
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in p


def _hot(spark):
    # one document holds most rows (a third of all rows and more)
    hot = spark.range(0, 30000).select(F.lit(1).cast("long").alias("doc_id"), (F.col("id") * 7 % 30011).alias("k"))
    cold = spark.range(0, 20000).select((F.col("id") % 500 + 2).alias("doc_id"), F.col("id").alias("k"))
    return hot.unionByName(cold)


def test_ordinal_within_matches_row_number_on_hot_key(spark):
    df = _hot(spark)
    want = df.withColumn("o", F.row_number().over(Window.partitionBy("doc_id").orderBy("k")))
    got = ordinal_within(df, "doc_id", ["k"], name="o", block_size=1000)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # string order, blocks by prefix; a payload column outside the order stays with its row
    text = df.withColumn("s", F.col("k").cast("string")).withColumn("payload", F.col("k") * 3)
    want2 = text.withColumn("o", F.row_number().over(Window.partitionBy("doc_id").orderBy("s")))
    for block in (None, F.substring("s", 1, 2)):
        got2 = ordinal_within(text, "doc_id", ["s"], name="o", block=block)
        assert got2.exceptAll(want2).count() == 0 and want2.exceptAll(got2).count() == 0


def test_ordinal_within_without_exchange_reuse(spark):
    df = _hot(spark).withColumn("payload", F.rand(3))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = ordinal_within(df, "doc_id", ["k", "payload"], name="o", block_size=100)
        assert got.count() == 50000 and got.select("doc_id", "o").distinct().count() == 50000
        largest = got.groupBy("doc_id").agg(F.max("o").alias("m"), F.count("*").alias("n")).where("m <> n").count()
        assert largest == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_ordinal_within_keeps_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, None), (1, None), (1, 5), (1, 9000)], "d long, k int")
    got = sorted(map(tuple, ordinal_within(df, "d", ["k"], name="o").collect()), key=str)
    assert got == sorted([(None, None, 1), (None, 1, 2), (1, None, 1), (1, 5, 2), (1, 9000, 3)], key=str)


def test_no_job_while_building(spark):
    tracker = spark.sparkContext.statusTracker()
    for name in ("split_plan", "resume_segments", "document_complete", "pages_in_name_order", "upside_down_pages", "with_context",
                 "page_counts", "valid_barcodes"):
        group = f"build-{name}"
        spark.sparkContext.setJobGroup(group, group)
        queries()[name](spark, SF)
        # reading a file's schema is the only job allowed: one per table
        assert len(tracker.getJobIdsForGroup(group)) <= 4, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_neighbours_within_matches_lag_lead_on_hot_key(spark):
    df = _hot(spark).withColumnRenamed("k", "page_no")
    w = Window.partitionBy("doc_id").orderBy("page_no")
    want = df.select("doc_id", "page_no", F.lag("page_no").over(w).alias("prev_page_no"),
                     F.lead("page_no").over(w).alias("next_page_no"))
    got = neighbours_within(df, "doc_id", "page_no", block_size=512).select(
        "doc_id", "page_no", "prev_page_no", "next_page_no")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_merge_two_levels_keeps_page_order(spark):
    pages = spark.range(1, 3001).select(F.lit(9).cast("long").alias("doc_id"), F.col("id").cast("int").alias("page_no"),
                                        F.col("id").cast("string").alias("text"))
    got = merge.merge_page_text(pages, sep=",", block_pages=100).first().text
    assert got == ",".join(str(i) for i in range(1, 3001))


def test_page_function_failure_is_isolated(spark):
    pages = spark.createDataFrame([(1, 1, "ok"), (1, 2, "boom"), (1, 3, "   ")], "doc_id long, page_no int, text string")

    def fn(t):
        if t == "boom":
            raise ValueError("bad page")
        return t

    got = {r.page_no: (r.status, r.error) for r in page_functions.map_pages(pages, fn).collect()}
    assert got[1] == (1, None) and got[2][0] == -1 and "bad page" in got[2][1] and got[3] == (0, None)


def test_context_is_broadcast_while_small(spark):
    p = _plan(queries()["with_context"](spark, SF))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_row_number_joins_only_blocks_after_the_first(spark):
    df = spark.createDataFrame([(d, k, 5 * d + k) for d in range(40) for k in range(1 + d % 7)], "doc_id int, k int, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ordinal_within(df, "doc_id", ["k", "v"], name="o")
        assert all(o == k + 1 for k, o in got.select("k", "o").collect())
        plan = got.select("k", "o")
        plan.collect()
        # no document has a second block, so nothing is left to sort and join
        assert "SortMergeJoin" not in plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        got = ordinal_within(df, "doc_id", ["k", "v"], name="o", block_size=2)
        assert all(o == k + 1 for k, o in got.select("k", "o").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_resume_route_in_blocks_of_pages(spark):
    pages = [(d, p) for d in range(1, 9) for p in range(1, 31 * d)] + [(1, 3), (None, 1), (2, None), (9, 70)]
    files = [(d, "temp", 0) for d in (1, 2, 3, 4, 5, 9)] + [(5, "temp", 0), (None, "temp", 0), (7, "png", 1), (6, "temp", None)]
    files += [(d, "pdf", p) for d, p in pages if d and d != 9 and p and p < 16 * d] + [(1, "pdf", 2), (4, "pdf", 500), (4, "pdf", None)]
    files += [(d, "txt", p) for d, p in pages if d and p and (p % 32 or d == 2)]
    state = [(d, "t" if d and d % 2 else "f", "t") for d in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None)] + [(3, "f", "t"), (3, None, "f")]
    got = complete.resume_route(
        spark.createDataFrame(state, "doc_id int, have_ocr string, have_sphinx string"),
        spark.createDataFrame(files, "doc_id int, kind string, page_no int"),
        spark.createDataFrame(pages, "doc_id int, page_no int"))
    want = []
    for d, ocr, sphinx in state:
        temp = d is not None and any(f[:2] == (d, "temp") for f in files)
        kind = "pdf" if temp and ocr == "t" else "txt" if temp and sphinx == "t" else None
        have = {p for e, k, p in files if e == d and k == kind}
        lacks = [p for e, p in pages if e == d and p is not None and p not in have] if kind else []
        want.append((d, temp and ocr == "t", temp and sphinx == "t", kind, min(lacks, default=None)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert dict(got.dtypes)["first_missing"] == "int"
    # pages and files are grouped together; the only join is that with the saved jobs
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
