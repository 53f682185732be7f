"""W4 split plan against a plain sequential model of the rules, on random documents."""

from __future__ import annotations

import random

from folioflow.plans import split


def model(n: int, barcodes: dict[int, str], keep: bool) -> list[tuple]:
    """Sequential statement of the split rules (one document)."""
    if n <= 0:
        return []
    marks = sorted((p, b) for p, b in barcodes.items() if b and len(b) >= 5 and "NEU_" in b)
    out = []
    if not marks:
        return [("", 1, n, 1)]
    for i, (p, b) in enumerate(marks):
        prev = marks[i - 1][0] if i > 0 else None
        nxt = marks[i + 1][0] if i + 1 < len(marks) else None
        to = nxt - 1 if nxt is not None else n
        frm = p + 1
        adj = (nxt is not None and nxt == p + 1) or (prev is not None and prev == p - 1)
        if i == 0 and not adj and frm != 2:
            out.append(("", 1, p - 1, 1))
        if keep:
            frm -= 1
        if frm > to:
            frm = to
        blank = frm == to and adj and not keep
        name = "" if blank else b.rstrip()
        idx = 1 if blank else (frm if keep else frm - 1)
        out.append((name, frm, to, idx))
    return out


def _random_docs(rng: random.Random, count: int):
    docs = []
    for d in range(count):
        n = rng.randint(0, 12)
        bc = {}
        for p in range(1, n + 1):
            r = rng.random()
            if r < 0.3:
                bc[p] = f"NEU_{rng.randint(1, 99)}"
            elif r < 0.35:
                bc[p] = "NEU"
            elif r < 0.38:
                bc[p] = "XYZ_12"
            elif r < 0.40:
                bc[p] = "NEU_7 "
            elif r < 0.42:
                bc[p] = "NEU_a:b"
        docs.append((d, n, bc))
    return docs


def _run(spark, docs, keep):
    rows = [(d, p, bc.get(p)) for d, n, bc in docs for p in range(1, n + 1)]
    pages = spark.createDataFrame(rows, "doc_id long, page_no int, barcode string")
    counts = spark.createDataFrame([(d, n) for d, n, _ in docs], "doc_id long, num_pages int")
    got = split.split_plan(pages, keep_barcode=keep, docs=counts, block_size=3).collect()
    return sorted((r.doc_id, r.barcode, r.from_page, r.to_page, r.page_index) for r in got)


def test_readme_example(spark):
    docs = [(1, 5, {1: "NEU_11", 4: "NEU_44"})]
    assert _run(spark, docs, False) == [(1, "NEU_11", 2, 3, 1), (1, "NEU_44", 5, 5, 4)]


def test_edge_plans(spark):
    cases = [(0, 5, {}), (1, 5, {5: "NEU_5"}), (2, 5, {1: "NEU_1"}), (3, 5, {3: "NEU_3"}),
             (4, 5, {1: "NEU_1", 2: "NEU_2"}), (5, 5, {2: "NEU_2", 3: "NEU_3"}),
             (6, 6, {3: "NEU_3", 4: "NEU_4", 6: "NEU_6"}), (7, 4, {p: f"NEU_{p}" for p in range(1, 5)}),
             (8, 0, {}), (9, 3, {2: "NEU_"}), (10, 3, {2: "ABC_12"}), (11, 3, {2: "NEU_9 "}),
             (12, 3, {2: "NEU_1:2"})]
    for keep in (False, True):
        want = sorted((d, *seg) for d, n, bc in cases for seg in model(n, bc, keep))
        assert _run(spark, cases, keep) == want, keep


def test_random_documents_match_model(spark):
    rng = random.Random(42)
    docs = _random_docs(rng, 300)
    for keep in (False, True):
        want = sorted((d, *seg) for d, n, bc in docs for seg in model(n, bc, keep))
        assert _run(spark, docs, keep) == want


def test_assign_pages_is_equi_join(spark):
    docs = [(1, 5, {1: "NEU_11", 4: "NEU_44"})]
    rows = [(d, p, bc.get(p)) for d, n, bc in docs for p in range(1, n + 1)]
    pages = spark.createDataFrame(rows, "doc_id long, page_no int, barcode string")
    segs = split.split_plan(pages)
    got = split.assign_pages(segs, pages.select("doc_id", "page_no"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sorted((r.from_page, r.page_no, r.new_page_no) for r in got.collect()) == [
        (2, 2, 1), (2, 3, 2), (5, 5, 1)]


def test_hot_document_split_matches_model(spark):
    # one scan holds most pages: 20,000 pages with a barcode on every 7th and on some neighbours
    rng = random.Random(7)
    hot_n = 20000
    hot = {p: f"NEU_{p}" for p in range(1, hot_n + 1) if p % 7 == 0 or rng.random() < 0.02}
    docs = [(0, hot_n, hot)] + _random_docs(rng, 200)[1:]
    for keep in (False, True):
        want = sorted((d, *seg) for d, n, bc in docs for seg in model(n, bc, keep))
        assert _run(spark, docs, keep) == want
