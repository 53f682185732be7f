"""Sources and sinks that touch files (S1, S4, S6, K1-K4, K8, K9), in a scratch folder."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from folioflow.plans import images
from folioflow.sinks import writers
from folioflow.sources import files


def _touch(path, data=b"%PDF-1.4 x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_scan_documents_suffix_and_nesting(spark, scratch):
    root = os.path.join(scratch, "in")
    for rel in ["a.pdf", "sub/b.pdf", "sub/deeper/c.pdf", "d.PDF", "e.txt", "sub/f.pdfx"]:
        _touch(os.path.join(root, rel))
    df = files.scan_documents(spark, root)
    got = sorted((r.sub_dir, r.stem) for r in df.collect())
    assert got == [("", "a"), ("sub", "b"), ("sub/deeper", "c")]
    assert "content" not in df.columns


def test_read_ink_report_positional_index(spark, scratch):
    rep = os.path.join(scratch, "ink", "doc7.txt")
    os.makedirs(os.path.dirname(rep))
    with open(rep, "w") as f:
        f.write(" 0.10000  0.00000  0.00000  0.02231 CMYK OK\n"
                "Page 2\n"
                " 0.00000  0.00000  0.00000  0.50000 CMYK OK\n"
                " 0.00000  0.00000  0.00000  0.50000 CMYK OK\n"
                " 0.10000  0.00000  0.00000  0.02231 CMYK OK\n")
    got = sorted((r.doc_id, r.page_idx, tuple(r.ink)) for r in images.read_ink_report(spark, rep).collect())
    assert [g[1] for g in got] == [0, 1, 2, 3]
    assert got[0][2] == (0.1, 0.0, 0.0) and got[3][2] == (0.1, 0.0, 0.0)
    assert all(g[0] == "doc7" for g in got)


def test_job_state_roundtrip_and_defaults(spark, scratch):
    path = os.path.join(scratch, "state")
    state = spark.createDataFrame(
        [("1", "t", None, "[{\"NEU_1\": {\"page_index\": 1, \"is_finish\": \"t\"}}]"),
         ("2", None, "t", "[]")],
        "queue_id string, have_ocr string, add_pages string, tasks_json string")
    state = state.withColumn("tasks", F.from_json("tasks_json", files.JOB_STATE_SCHEMA.split("tasks ")[1])) \
                 .drop("tasks_json")
    writers.write_job_state(state, path)
    back = {r.queue_id: r for r in files.read_job_state(spark, path).collect()}
    assert back["1"].have_ocr == "t" and back["1"].add_pages == "f" and back["1"].keep_barcode_ind == "t"
    assert back["2"].have_ocr == "f" and back["2"].add_pages == "t"
    assert back["1"].tasks[0]["NEU_1"]["is_finish"] == "t"


def test_write_package_excludes_temp_and_state(spark, scratch):
    out = os.path.join(scratch, "pkg")
    arts = spark.createDataFrame([("B1", "P1", "pdf", 1), ("B1", "P1", "temp", 0), ("B1", "P1", "state", 0),
                                  ("B2", "P1", "png", 3)], "box_number string, box_part string, kind string, page int")
    writers.write_package(arts, out)
    back = spark.read.parquet(out)
    assert sorted((r.box_number, r.kind) for r in back.collect()) == [("B1", "pdf"), ("B2", "png")]
    assert os.path.isdir(os.path.join(out, "box_number=B1", "box_part=P1"))


def test_page_text_and_run_log(spark, scratch):
    pages = spark.createDataFrame([(1, 1, "  a \n"), (1, 2, "b"), (2, 1, "")], "doc_id long, page_no int, text string")
    writers.write_page_text(pages, os.path.join(scratch, "txt"))
    back = spark.read.parquet(os.path.join(scratch, "txt"))
    assert sorted((r.doc_id, r.page_no, r.text) for r in back.collect()) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "")]
    log = os.path.join(scratch, "log")
    res = spark.createDataFrame([(1, None, "/x/a.pdf"), (0, None, "/x/b.txt"), (-1, "boom", "/x/c.pdf")],
                                "status int, error string, path string")
    writers.append_run_log(res, log, "2024-01-20 12:00:00")
    writers.append_run_log(res.limit(1), log, "2024-01-20 12:00:01")
    lines = sorted(r.value for r in spark.read.text(log).collect())
    assert "[2024-01-20 12:00:00][ERROR][boom]: /x/c.pdf" in lines
    assert "[2024-01-20 12:00:00][BLANK][]: /x/b.txt" in lines
    assert len(lines) == 4


def test_sync_and_init_tables(spark, scratch):
    src, dst = os.path.join(scratch, "src"), os.path.join(scratch, "dst")
    spark.range(5).write.parquet(src)
    spark.range(2).write.parquet(dst)
    writers.sync_table(spark, src, dst)
    assert spark.read.parquet(dst).count() == 5
    spark.sql(f"CREATE DATABASE IF NOT EXISTS ff_test LOCATION '{os.path.join(scratch, 'wh')}'")
    names = writers.init_tables(spark, "ff_test")
    assert names == ["ff_test.users"] and spark.table("ff_test.users").count() == 0


def test_manifest_xml_nests(spark):
    from folioflow.plans.merge import manifest_xml
    docs = spark.createDataFrame([(5, "PRF1", "IMG5", "B", "P", "doc5", 2)],
                                 "queue_id long, profile_id string, image_id string, box_number string, "
                                 "box_part string, pdf_name string, num_pages int")
    xml = manifest_xml(docs, "2024-01-02").first().xml
    assert '<FileInfo process_date="2/1/2024" profile_id="PRF1">' in xml
    assert '<Bookmark ID="5">' in xml and '<piece path="B/P/doc5_000002.pdf"' in xml


def test_request_json_keeps_apostrophes(spark):
    from folioflow.functions.codes import request_json
    df = spark.createDataFrame([("it's",)], "a string")
    assert json.loads(df.select(request_json(F.struct("a")).alias("j")).first().j) == {"a": "it's"}
