"""Edge rows for the scalar functions (FIXTURES.md §3), each with the answer worked out from the rule text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from folioflow.functions import dates, paths, text


def test_classify_searchable_edges(spark):
    # expected by hand: a run of other signs and its space becomes one mark, spaces go; 0 if nothing is left or
    # more than half of what is left are marks
    rows = {"": 0, "   ": 0, "\n\n\n": 0, "1 2 3 ": 0, "a": 1, "ab 1 ": 1, "a 1 ": 1, "mail a@b": 1, "hello world": 1,
            "12 34 56 x": 0, "Ünïcode wörds here": 1, "a\tb 9 ": 1}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.code for r in text.classify_searchable(df).collect()}
    assert got == dict(enumerate(rows.values()))


def test_file_stem_edges(spark):
    names = ["a.pdf", "a.pdf.pdf", "x.pdfx", "a.PDF", "no", "/d/e/b.pdf"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = [r.s for r in df.select(paths.file_stem("p").alias("s")).collect()]
    assert got == ["a", "a.pdf", "x", "a.PDF", "no", "b"]


def test_pretty_date_edges(spark):
    now = dt.datetime(2024, 1, 20, 12, 0, 0)
    ages = {dt.timedelta(0): "just now", dt.timedelta(seconds=1): "1 second ago",
            # one second ahead: a day back and 86,399 seconds on
            dt.timedelta(seconds=-1): "-1 years ago", dt.timedelta(days=1): "1 day ago", dt.timedelta(days=7): "1 week ago",
            dt.timedelta(days=30): "1 month ago", dt.timedelta(days=365): "1 year ago",
            dt.timedelta(days=364, hours=23, minutes=59, seconds=59): "12 months ago",
            dt.timedelta(days=-400): "-2 years ago", dt.timedelta(minutes=61): "1 hour ago",
            dt.timedelta(microseconds=500): "just now"}
    df = spark.createDataFrame([(i, now - age) for i, age in enumerate(ages)], "i int, ts timestamp")
    got = {r.i: r.s for r in df.select("i", dates.pretty_date("ts", now).alias("s")).collect()}
    assert got == dict(enumerate(ages.values()))


def test_nl2br_edges(spark):
    rows = [(None, ""), ("", ""), ("   ", "<p></p>"), ("a\nb", "<p>a<br>\nb</p>"), ("a\n\nb", "<p>a</p>\n\n<p>b</p>"),
            ("a\r\n\r\nb", "<p>a</p>\n\n<p>b</p>"), ("<&>'\"", "<p>&lt;&amp;&gt;&#39;&#34;</p>"),
            ("x\n\n\n\ny\nz", "<p>x</p>\n\n<p>y<br>\nz</p>")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string")
    got = {r.i: r.h for r in df.select("i", text.nl2br("t").alias("h")).collect()}
    assert got == {i: h for i, (_, h) in enumerate(rows)}


def test_format_date(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),), (None,)], "ts timestamp")
    assert [r.d for r in df.select(dates.format_date("ts").alias("d")).collect()] == ["2024-01-02", ""]


def test_slugify(spark):
    want = {"Hello, Wörld -- été's!": "hello-world-etes", "Straße": "strasse", "Łódź": "lodz", "Œuvre": "oeuvre",
            "Привет, мир": "privet-mir", "Щука": "shchuka", "Ωμέγα": "omega", "": "", "Tiếng Việt": "tieng-viet"}
    df = spark.createDataFrame([(k,) for k in want], "s string")
    got = {r.s: r.x for r in df.select("s", text.slugify("s").alias("x")).collect()}
    assert got == want
    chinese = spark.createDataFrame([("文件",), ("档案",)], "s string").select(text.slugify("s").alias("x")).collect()
    assert len({r.x for r in chinese}) == 2 and all(r.x.startswith("x-") and len(r.x) == 10 for r in chinese)


def test_search_words(spark):
    from folioflow.operators.filters import search_users
    users = spark.createDataFrame([(1, "Alice", "a@x.com"), (2, "Bob", "bob%1@y.com"), (3, "carol", "c@x.com")],
                                  "id long, name string, email string")
    assert search_users(users, "").count() == 3
    assert {r.id for r in search_users(users, "x.com AL").collect()} == {1}
    assert {r.id for r in search_users(users, "b%1").collect()} == {2}



def test_signup_refused_candidate_blocks_nobody(spark):
    from folioflow.plans import users as U
    cols = spark.createDataFrame([], "id long, name string, email string")
    free = spark.createDataFrame([(1, "anna", "a@x.com"), (2, "anna", "b@x.com"), (3, "carl", "b@x.com"), (4, "carl", "d@x.com")],
                                 "cand_id long, name string, email string")
    real = U.validate_users
    U.validate_users = lambda c: c.withColumn("errors", F.array().cast("array<string>"))
    try:
        got = U.signup_batch(free, cols, "2024-01-20 12:00:00")
        assert sorted(r.name + r.email for r in got.collect()) == ["annaa@x.com", "carlb@x.com"]
    finally:
        U.validate_users = real


def test_every_change_counts(spark):
    from folioflow.plans import users as U
    users = spark.createDataFrame([(1, "old@x.com", "1", "key1"), (2, "two@x.com", "2", "key2")],
                                  "id long, email string, phone string, activation_key string")
    changes = spark.createDataFrame([(1, 10, "new@x.com", None, "pw"), (1, 20, None, "555", None)],
                                    "id long, changed_at int, email string, phone string, new_password string")
    got = sorted(map(tuple, U.apply_user_changes(users, changes).collect()))
    assert got == [(1, "new@x.com", "555", None, 20), (2, "two@x.com", "2", "key2", None)]
