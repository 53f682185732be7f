from __future__ import annotations

import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import html_extraction, html_training, quality_classifier, toxicity
from folioflow.llm.decontamination import decontaminate, find_contamination, search, write_index
from folioflow.llm.html_blocks import blocks
from folioflow.llm.quality_rules import judge, measures

SF_SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


# ---- benchmark -----------------------------------------------------------------------------

@pytest.fixture(scope="session")
def items(spark, corpus):
    long = words(corpus[7][1])
    rows = [(1, " ".join(long[2:30])), (2, " ".join(words(corpus[9][1])[:6])), (3, None), (4, "..."), (5, "no such words here at all"),
            (6, corpus[0][1].split("\n")[0]), (None, "a b c d e f"), (1, " ".join(long[2:30]))]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def brute_hits(text, items, width=10):
    w, hit, own = words(text), set(), set()
    for i, t in items:
        v = words(t)
        k = min(width, len(v))
        wins = {tuple(v[s:s + k]) for s in range(len(v) - k + 1)} if k else set()
        for s in range(len(w) - k + 1 if k else 0):
            if tuple(w[s:s + k]) in wins:
                hit.update(range(s, s + k))
                own.add(i)
    return len(w), len(hit), own


@pytest.mark.parametrize("max_slice_words", [1_000_000, 20])
def test_decontamination(spark, docs, corpus, items, scratch, max_slice_words):
    one = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    write_index(one, scratch + "/index")
    got = search(spark, scratch + "/index", items[1], max_slice_words=max_slice_words).collect()
    text = {i: t for i, t, *_ in corpus}
    assert sorted(r["doc_id"] for r in got) == sorted(x for x in text if x is not None)
    for r in got:
        n, hit, own = brute_hits(text[r["doc_id"]], items[0])
        assert (r["n_words"], r["n_hit"], {s["item_id"] for s in r["spans"]}) == (n, hit, own), r["doc_id"]


def test_decontamination_filter(spark, wide_docs, empty_docs, corpus, items):
    out = decontaminate(wide_docs, items[1])
    assert out.columns == wide_docs.columns
    want = [i for i, t, *_ in corpus if not brute_hits(t, items[0])[1]]
    assert sorted(map(str, want)) == sorted(str(r["doc_id"]) for r in out.select("doc_id").collect())
    assert find_contamination(empty_docs, items[1]).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(wide_docs, none).count() == len(corpus)


def test_slices_keep_rows_apart(spark, scratch):
    """Repeated rows, and rows of one id and word count, are reported once each for any number of slices."""
    a, b = " ".join(f"a{k}" for k in range(12)), " ".join(f"b{k}" for k in range(12))
    rows = [(1, a), (1, a), (1, b), (None, a), (None, " ".join(f"c{k}" for k in range(12)))]
    write_index(spark.createDataFrame(rows, "doc_id long, text string"), scratch + "/index")
    items = spark.createDataFrame([(1, a), (2, b)], "item_id long, text string")
    for size in (1_000_000, 12):
        got = search(spark, scratch + "/index", items, max_slice_words=size).collect()
        assert sorted((r["doc_id"] or 0, r["n_hit"], *{s["item_id"] for s in r["spans"]}) for r in got) == [
            (0, 0), (0, 12, 1), (1, 12, 1), (1, 12, 1), (1, 12, 2)]


def test_many_slices_one_aggregation(spark, scratch):
    """Fifty slices of a benchmark give what one slice gives, with one aggregation over the documents."""
    passages = [" ".join(f"w{k}x{j}" for j in range(12)) for k in range(50)]
    rows = [(k, f"{passages[k]} between {passages[(k * 7 + 1) % 50]} {passages[k]}") for k in range(50)] + [(99, "nothing of it")]
    write_index(spark.createDataFrame(rows, "doc_id long, text string"), scratch + "/index")
    items = spark.createDataFrame(list(enumerate(passages)), "item_id long, text string")
    one, many = (search(spark, scratch + "/index", items, max_slice_words=n) for n in (1_000_000, 12))
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1
    found = lambda df: sorted((r["doc_id"], r["n_words"], r["n_hit"], sorted(map(tuple, r["spans"]))) for r in df.collect())
    assert found(one) == found(many) and sum(r[2] for r in found(many)) == 50 * 36


def test_proximity(spark, scratch):
    docs = spark.createDataFrame([(1, "red x x green blue"), (2, "red " + "x " * 30 + "green blue"), (3, "blue green red")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(7, "red green blue")], "item_id long, text string")
    write_index(docs, scratch + "/near")
    near = search(spark, scratch + "/near", items, proximity=6).where("size(spans) > 0").collect()
    assert {r["doc_id"] for r in near} == {1, 3}


# ---- quality rules -------------------------------------------------------------------------

def test_quality_measures(docs, corpus):
    sep = re.compile("[ \t\n\x0b\x0c\r]+")
    got = {}
    for r in measures(docs).select("doc_id", "quality.*").collect():
        got.setdefault(r["doc_id"], set()).add((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]))
    want = {}
    for i, t, *_ in corpus:
        t = t or ""
        w = [x for x in sep.split(t) if x]
        win = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        count = {}
        for x in win:
            count[x] = count.get(x, 0) + 1
        rep = {p for k, x in enumerate(win) if count[x] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in t.split("\n") if sep.sub("", x)]
        want.setdefault(i, set()).add((len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
                                       len(rep)))
    assert got == want


def test_quality_verdict(wide_docs, empty_docs, corpus):
    out = judge(wide_docs)
    assert set(wide_docs.columns) <= set(out.columns) and out.count() == len(corpus)
    assert judge(empty_docs).count() == 0
    assert not any(r["quality_kept"] for r in out.where("text IS NULL OR doc_id IN (81, 82, 83, 88)").collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.split("Scan")[0].split("Project")[1]


# ---- quality classifier --------------------------------------------------------------------

def noisy(rng, k):
    from tests_llm_prose import prose
    w = prose(rng, rng.randint(60, 200)).split(" ")
    return [" ".join(x + "***" for x in w), " ".join(x.upper() + "!!" for x in w), " ".join([w[0]] * 80)][k % 3]


@pytest.fixture(scope="session")
def labelled(spark):
    from tests_llm_prose import prose
    rng = random.Random(11)
    rows, labels = [], []
    for k in range(300):
        bad = k % 5 == 0
        rows.append((k, noisy(rng, k // 5) if bad else prose(rng, rng.randint(60, 200)), "en", f"s{k % 3}", 100))
        if k % 4:
            labels.append((k, 0 if bad else 1, 0))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_classifier(labelled, docs, empty_docs, corpus):
    table, labels = labelled
    got = {r["doc_id"]: r["kept"] for r in quality_classifier.quality_scores(table, labels).collect()}
    unseen = [k for k in got if k % 4 == 0]
    assert sum(got[k] == (k % 5 != 0) for k in unseen) >= 0.98 * len(unseen)
    assert quality_classifier.quality_scores(docs, labels.where("quality = 1")).where("kept").count() == len(corpus)
    assert quality_classifier.quality_scores(empty_docs, labels).count() == 0
    assert quality_classifier.quality_scores(docs, labels).count() == len(corpus)


def test_quality_filter_keeps_columns(wide_docs, labelled):
    out = quality_classifier.keep_good(wide_docs, labelled[1])
    assert out.columns == wide_docs.columns


def test_filters_judge_rows_not_ids(spark, labelled, items):
    """A rejected or contaminated row takes no other row of its null or repeated ``doc_id`` along."""
    table, labels = labelled
    some = table.where("doc_id IN (1, 2, 3, 5, 10)").withColumn("was", F.col("doc_id"))
    for same in (None, 7000):
        rows = table.withColumn("was", F.col("doc_id")).union(some.withColumn("doc_id", F.lit(same).cast("long")))
        kept = quality_classifier.keep_good(rows, labels).where(F.col("doc_id").eqNullSafe(F.lit(same).cast("long"))).collect()
        assert sorted(r["was"] for r in kept) == [1, 2, 3]
        passage = items[0][0][1]
        docs = spark.createDataFrame([(same, "clean words"), (same, passage), (same, None), (9, passage)], "doc_id long, text string")
        assert sorted(str(r["text"]) for r in decontaminate(docs, items[1]).collect()) == ["None", "clean words"]


# ---- toxicity ------------------------------------------------------------------------------

def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton():
    rng = random.Random(2)
    entries = {"idiot": 5.0, "scum": 4.0, "worthless": 3.0, "ab": 6.0}
    auto = toxicity.Automaton(entries)
    for _ in range(3000):
        w = list(rng.choice(list(entries)))
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "i", "x"])
        w = "".join(w)
        near = [(s * toxicity.PER_EDIT ** d) for e, s in entries.items() if (d := edit_distance(w, e)) <= toxicity.allowed_edits(e)]
        assert auto.match(w)[0] == pytest.approx(max(near, default=0.0)), w


def test_context_lowers_quotations():
    auto = toxicity.Automaton({"idiot": 5.0})
    import pyarrow as pa
    scores = []
    for text in ("well you idiot go", "well he idiot go", 'they said the word "an idiot here" once'):
        for _, _, data, offsets in toxicity._slices(pa.array([text])):
            starts, ends, doc = toxicity._tokens(data, offsets)
            key, value, _ = toxicity.Matcher(auto).strengths(data, starts, ends)
            k = int(np.flatnonzero(value)[0])
            scores.append(toxicity._context(data.tobytes(), key, doc, starts, ends, k))
    assert scores[0] > scores[1] > scores[2]


def test_toxicity(spark, docs, empty_docs, corpus):
    from tests_llm_prose import prose
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(400):
        w = prose(rng, 80).split(" ")
        if k % 8 == 0:
            for _ in range(2):
                w[rng.randrange(80)] = rng.choice(["worthless", "disgusting", "scummy"])
        rows.append((k, " ".join(w)))
        labels.append((k, int(k % 8 == 0)))
    rows += [(1000, "x y worthles z " * 3), (1001, None), (None, "disgusting")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(table, known).collect()}
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k]["held_out"] == (k in held) for k in range(400))
    assert all(got[k]["predicted"] == (k % 8 == 0) for k in held)
    assert got[1000]["score"] > 10 * got[1001]["score"] and got[None]["predicted"] == 1
    none = toxicity.toxicity_scores(docs, known.where("toxic = 0"))
    assert none.count() == len(corpus) and none.where("score > 0").count() == 0
    assert toxicity.toxicity_scores(empty_docs, known).count() == 0
    assert toxicity.toxicity_scores(docs, known).count() == len(corpus)


def test_misspellings_in_clean_documents(spark):
    """One clean document does not switch a misspelling off, many do; a lexicon has no fixed size."""
    from tests_llm_prose import prose
    rng = random.Random(9)
    three = [a + b + c for a in "bcdfghjklmnpqrstvwxyz" for b in "0123456789aeiou" for c in "bcdfghjklmnp"][:3500]
    rows, labels = [], []
    for k in range(900):
        w = prose(rng, 60).split(" ")
        if k % 3 == 0:
            w += ["worthless", "disgusting"] + rng.sample(three, 200)
        elif k == 1 or k % 2:
            w[5] = "vorthless" if k == 1 else "disgustine"
        rows.append((k, " ".join(w)))
        labels.append((k, int(k % 3 == 0)))
    assert zlib.crc32(b"1") % 5 != 0
    rows += [(2000, "x y vorthless z"), (2001, "x y disgustine z"), (2002, "x y z")] + [(3000 + k, "x y " + w) for k, w in enumerate(three)]
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert got[2000] > got[2002] and got[2001] == got[2002]
    assert np.mean([got[3000 + k] > got[2002] for k in range(len(three))]) >= 0.99


# ---- html ----------------------------------------------------------------------------------

@pytest.fixture(scope="session")
def model():
    return html_extraction.default_model()


def test_viterbi_is_the_best_labelling(model):
    rng = random.Random(1)
    names = list(model.weights)
    for _ in range(30):
        page = [("t", tuple(rng.sample(names, 3)), ("bias",)) for _ in range(rng.randint(1, 7))]

        def score(ys):
            s = model.first[ys[0]] + model.last[ys[-1]]
            s += sum(sum(model.weights[f] for f in p + o) for (_, p, o), y in zip(page, ys) if y)
            return s + sum(model.moves[a][b] for a, b in zip(ys, ys[1:]))
        best = max(itertools.product((0, 1), repeat=len(page)), key=score)
        assert score(tuple(model.decode(page))) == pytest.approx(score(best))


def test_held_out_pages(model):
    pages = html_training.labelled_pages(200, seed=99)
    right = sum(a == b for page, y in pages for a, b in zip(model.decode(page), y))
    assert right >= 0.98 * sum(len(y) for _, y in pages)


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<p>", ""),
    ("<nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One  two\n three<br>four five six seven.<p>Next one is here now.</article>"
     "<footer>&copy; x</footer>", "A & B\nOne two three four five six seven.\nNext one is here now."),
    ("<article><p>A long enough sentence stands here.</p><script>var t='</p><p>no'</script><!-- <p>no</p> --></article>",
     "A long enough sentence stands here."),
])
def test_main_text(model, html, text):
    assert html_extraction.main_text(html, model) == text


def test_broken_pages_do_not_crash(model):
    for page in ("<", "<<<a", "<p class=\"x", "</p></div>", "<script>", "<!--", "<b><i></b></i><p>" * 50, "&#x110000; &bogus; &#0;",
                 "<ul><li>a<li>b</ul>", "<table><tr><td>a<td>b</table>"):
        assert isinstance(html_extraction.main_text(page, model), str)
    assert [t for t, _, _ in blocks("<ul><li>a<li>b <b>c</b></ul>d")] == ["a", "b c", "d"]


def test_pages_table(spark, model):
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = html_extraction.extract(rows, model=model).collect()
    assert len(got) == rows.count()
    for r in got:
        inner = r["html"].split("<article>", 1)[1].rsplit("</article>", 1)[0]
        import html as h
        want = [" ".join(h.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r["main_text"] == "\n".join(x for x in want if x)
    assert html_extraction.extract(rows.limit(0), model=model).count() == 0


@pytest.mark.parametrize("page", ["<a '" * 60_000, "<!x " * 100_000, "<" + "a" * 300_000, "<a " * 100_000 + "'", "<div>" * 3000 + "</p>" * 60_000,
                                  "<a '\">" * 30_000 + "<p>\"", "<a '" * 30_000 + "<b \"" * 30_001 + ">"])
def test_broken_pages_take_linear_time(page):
    import time

    from folioflow.llm.html_blocks import blocks
    t = time.process_time()
    blocks("<p>start</p>" + page)
    assert time.process_time() - t < 5


def test_tags_without_end_are_text():
    from folioflow.llm.html_blocks import blocks
    texts = lambda page: [t for t, *_ in blocks(page)]
    assert texts("<p>a < b <c 'd</p><p>e</p>") == ["a < b <c 'd", "e"]
    assert texts("<p title=\"x > y\">one</p><p title='>'>two<p>three") == ["one", "two", "three"]
    assert texts("<p>x</p><!-- open <p>y") == ["x"] and texts("a <!-- open") == ["a"] and texts("1 < 2") == ["1 < 2"]
    # a cue at the end of a long block counts
    assert any("cue" in f for _, _, f in blocks("<p>" + "word " * 200 + "newsletter</p>"))
