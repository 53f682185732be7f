from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import suffix_dedup
from folioflow.llm.common import components
from folioflow.llm.line_dedup import dedup_lines
from folioflow.llm.near_dedup import drop_near_duplicates, near_duplicates

SPACE = re.compile("[ \t\n\x0b\x0c\r]+")


def shingles(text, k):
    w = [x for x in SPACE.split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            if i != j and x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs, corpus, k):
    got = near_duplicates(docs, words=k).collect()
    assert len(got) == len(corpus)
    want = brute_components([(i, t) for i, t, *_ in corpus], k)
    size = {}
    for i, t, *_ in corpus:
        size.setdefault(i, set()).add(len(shingles(t, k)))
    for r in got:
        assert r["n_shingles"] in size[r["doc_id"]]
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == want[r["doc_id"]])


def test_near_duplicates_bad_center(spark):
    """Links that no bucket centre shows are still found: a chain of texts, each close to the next only."""
    words = [f"w{k}" for k in range(600)]
    rows = [(k, " ".join(words[8 * k:8 * k + 200])) for k in range(40)]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"),
                                                                  words=2).collect()}
    assert got == brute_components(rows, 2) and set(got.values()) == {0}


def test_near_duplicates_large_family(spark):
    """Many close copies, copies that are too far from all others, and some that only a far copy reaches."""
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(150)]

    def copy(of, edits, tag):
        out = list(of)
        for k in rng.choice(len(out), edits, replace=False):
            out[k] = f"{tag}x{k}"
        return out
    texts = [copy(base, int(rng.integers(0, 5)), f"a{k}") for k in range(40)]
    far = [copy(base, 14, f"b{k}") for k in range(20)]
    texts += far + [copy(f, 3, f"c{k}") for k, f in enumerate(far[:10])]
    order = rng.permutation(len(texts))
    rows = [(int(i), " ".join(t)) for i, t in zip(order, texts)]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"),
                                                                  words=2).collect()}
    want = brute_components(rows, 2)
    assert got == want and len(set(want.values())) > 10


def test_near_duplicates_filter(wide_docs, empty_docs, corpus):
    kept = drop_near_duplicates(wide_docs)
    assert kept.columns == wide_docs.columns
    want = brute_components([(i, t) for i, t, *_ in corpus], 5)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        (i is not None, i or 0) for i, *_ in corpus if i is None or want[i] == i)
    assert near_duplicates(empty_docs).count() == 0


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(k, k + 1) for k in range(400, 470)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


# ---- byte strings --------------------------------------------------------------------------

def brute_cut(rows, length):
    seen, out = set(), {}
    for i, t in sorted({r for r in rows if r[0] is not None}):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)),
                  hashlib.sha256(kept).hexdigest())
    return out


def test_cut_with_text_ids(spark):
    """Any type of ``doc_id`` that can be ordered will do; the smaller id keeps a repeated string."""
    rng = np.random.default_rng(4)
    passage = "".join(chr(97 + k) for k in rng.integers(0, 26, 140))
    rows = [("b", "head " + passage + " x"), ("a", passage), ("c", "own text"), (None, passage)]
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.cut(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a": 0, "b": 140, "c": 0, None: 0}


@pytest.mark.parametrize("length,gram,max_group", [(100, 32, 64), (100, 32, 1), (60, 20, 3), (40, 8, 2)])
def test_cut(docs, corpus, length, gram, max_group):
    rows = [(i, t or "") for i, t, *_ in corpus if i != 87]
    got = suffix_dedup.cut(docs.where("doc_id IS NULL OR doc_id <> 87"), length=length, gram=gram, max_group=max_group).collect()
    want = brute_cut(rows, length)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]


def test_cut_long_and_empty(docs, empty_docs):
    one = suffix_dedup.cut(docs.where("doc_id = 87")).first()
    assert one["n_bytes"] > 200_000 and one["n_removed"] == 0
    assert suffix_dedup.cut(empty_docs).count() == 0


def test_suffix_order():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    anchor = np.sort(rng.choice(360, 50, replace=False))
    s = suffix_dedup.Suffixes(data, anchor, np.minimum(anchor, 20), np.full(50, 40), np.repeat([0, 1], 25))
    order = s.order().tolist()
    text = lambda k: data[anchor[k]:anchor[k] + 40].tobytes()
    assert [text(k) for k in order[:25]] == sorted(map(text, range(25)))
    assert [text(k) for k in order[25:]] == sorted(map(text, range(25, 50)))


# ---- lines ---------------------------------------------------------------------------------

BREAK = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def test_lines(spark):
    a = "The quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [(1, a + "\nshort line\nshort line\n" + "x y z w v u"), (2, "first\n" + a.upper() + "!\nlast one"),
            (3, a.replace("lazy", "lazyy") + "\nown words stand here in this very line"), (4, None), (5, ""), (None, a), (2, "first\n" + a.upper() + "!\nlast one"),
            (6, "x y z w v u")]
    got = sorted(map(tuple, dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    want = [(1, rows[0][1]), (2, "first\nlast one"), (3, None), (4, None), (5, ""), (None, a), (2, "first\nlast one"), (6, "")]
    for (i, t), (j, u) in zip(got, sorted(want, key=str)):
        assert i == j and (t == u or i == 3)


def test_lines_against_exact_rule(docs, corpus, wide_docs, empty_docs):
    """Every repeat of a normalised line of five words or more goes; lines without a close one stay."""
    out = dedup_lines(wide_docs)
    assert out.columns == wide_docs.columns
    got = {}
    for r in out.select("doc_id", "text").collect():
        got.setdefault(r["doc_id"], set()).add(r["text"])
    first = {}
    for i, t, *_ in sorted((r for r in corpus if r[0] is not None and r[1]), key=lambda r: r[0]):
        for p, line in enumerate(t.split("\n")):
            w = tuple(x for x in BREAK.split(line.lower()) if x)
            if len(w) >= 5:
                first.setdefault(w, (i, p))
    for i, t, *_ in corpus:
        if i is None or 60 <= i < 72 or i < 40 and i % 5 == 0:                      # near copies, shared passages
            continue
        if t is None:
            assert got[i] == {None}
            continue
        keep = []
        for p, line in enumerate(t.split("\n")):
            w = tuple(x for x in BREAK.split(line.lower()) if x)
            if len(w) < 5 or first[w] == (i, p):
                keep.append(line)
        assert got[i] == {"\n".join(keep)}, i
    assert sum(bool(t) for i in range(60, 72) for t in got[i]) == 1                # one of the near copies
    assert dedup_lines(empty_docs).count() == 0


def test_lines_are_native(docs, scratch):
    plan = dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_lines_with_small_edits(spark):
    """Lines of 5 to 50 words with one word, one letter or a few letters changed go; others stay."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    rows, kinds = [], []
    for n in range(5, 51):
        for kind in ("word", "letter", "letters"):
            line = [word() for _ in range(n)]
            other, k = list(line), int(rng.integers(n))
            if kind == "word":
                other[k] = word()
            for j in {"word": [], "letter": [k]}.get(kind, range(0, n, 5)):
                other[j] = other[j][:2] + "0" + other[j][3:]
            kinds.append(kind)
            rows += [(len(rows), " ".join(line)), (len(rows) + 1, " ".join(other))]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == t for i, t in rows if i % 2 == 0)
    for kind in set(kinds):
        gone = [got[2 * k + 1] == "" for k, x in enumerate(kinds) if x == kind]
        assert np.mean(gone) >= 0.95, kind


def test_long_lines_in_order(spark):
    """Long lines over one vocabulary stay; a long line with many small typing errors goes."""
    rng = np.random.default_rng(6)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(200)]
    share = 1 / np.arange(1, 201)
    text = lambda: " ".join(rng.choice(vocabulary, 3000, p=share / share.sum()))
    own = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(1500)]
    typed = [w[:2] + "0" + w[3:] if k % 4 == 0 else w for k, w in enumerate(own)]
    rows = [(0, text()), (1, text()), (2, text()), (3, " ".join(own)), (4, " ".join(typed))]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict(rows), 4: ""}


def test_lines_of_few_words(spark):
    """Lines without spaces and boilerplate of few words go by their bytes; very short lines stay."""
    rng = np.random.default_rng(7)
    chinese = "".join(chr(c) for c in rng.integers(0x4E00, 0x9000, 60)) + "\u3002"
    thai = "".join(chr(c) for c in rng.integers(0x0E01, 0x0E2F, 60))
    few = "Subscribe newsletter, privacy policy"
    rows = [(0, f"{chinese}\n{few}\n{thai}\nread more"), (1, f"{few.upper()}\nread more"), (2, chinese),
            (3, chinese[:30] + "\u4e00" + chinese[31:]), (4, thai[:20] + thai[21:]), (5, chinese[::-1])]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: rows[0][1], 1: "read more", 2: "", 3: "", 4: "", 5: rows[5][1]}


def thue_morse(n):
    """A word over a and b and its complement: equal polynomial hashes modulo 2**64 at any multiplier."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_hash_of_long_words(spark):
    from folioflow.llm.decontamination import find_contamination
    from folioflow.llm.tokens import encoder
    x, y = thue_morse(1024)
    docs = spark.createDataFrame([(1, x), (2, y), (3, f"v {y} w")], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, words=2).collect()} == {1: 1, 2: 2, 3: 3}
    items = spark.createDataFrame([(7, x)], "item_id long, text string")
    assert {r["doc_id"]: r["n_hit"] for r in find_contamination(docs, items).collect()} == {1: 1, 2: 0, 3: 0}
    enc = encoder()
    raw = np.frombuffer((x + y).encode(), np.uint8)
    ids, bounds = enc.encode_slice(raw, np.array([0, 1024, 2048]))
    assert ids[:bounds[1]].tolist() == enc.library(x) and ids[bounds[1]:].tolist() == enc.library(y)


def test_rows_of_one_id(spark):
    """A row goes by its own text: rows of one id with different texts are judged apart."""
    a, c = "\n".join(f"w{k} x{k} y{k} z{k} v{k} u{k}" for k in range(20)), "\n".join(f"p{k} q{k} r{k} s{k} t{k} o{k}" for k in range(20))
    rows = [(1, a, "one"), (2, a, "two"), (2, c, "three"), (None, a, "four"), (None, c + " end", "five"), (3, c, "six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string")
    left = {r["note"]: r["text"] for r in dedup_lines(docs).collect()}
    assert left == {"one": a, "two": "", "three": c, "four": a, "five": c + " end", "six": ""}
    # of the copies the first by id stays; rows without an id stay
    assert {r["note"] for r in drop_near_duplicates(docs).collect()} == {"one", "three", "four", "five"}


def test_lines_keep_little_on_disk(spark, scratch):
    """The tables kept for lines hold each distinct line once, not its occurrences too."""
    from pathlib import Path

    from folioflow.session import ensure_checkpoint_dir
    rng = np.random.default_rng(8)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    rows = [(i, "\n".join(" ".join("".join(rng.choice(letters, 6)) for _ in range(150)) for _ in range(4))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{scratch}/docs", compression="zstd")
    size = lambda at: sum(p.stat().st_size for p in Path(at).rglob("*.parquet"))
    kept = f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/llm"
    before = size(kept)
    out = dedup_lines(spark.read.parquet(f"{scratch}/docs"))
    assert sorted(map(tuple, out.collect())) == rows
    assert size(kept) - before < 1.8 * size(f"{scratch}/docs")


def test_line_pairs_in_parts(spark, monkeypatch):
    """Pairs measured in several parts give the groups of brute force."""
    from folioflow.llm import line_dedup
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5))
    # lines of one template share buckets; only their near copies are links
    lines = [" ".join(["the", "same", "long", "words", "for", "each"] + [word() for _ in range(9)]) for _ in range(40)]
    rows = list(enumerate(lines + [x[:-1] + "0" for x in lines[:10]]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    parts, measured = [], line_dedup._measured
    monkeypatch.setattr(line_dedup, "_measured", lambda pairs, *a: parts.append(pairs.count()) or measured(pairs, *a))
    monkeypatch.setattr(line_dedup, "PART_PAIRS", 20)
    got = {r["doc_id"]: r["text"] for r in dedup_lines(docs).collect()}
    assert got == {i: t if i < 40 else "" for i, t in rows}
    assert len(parts) > 3 and max(parts) < sum(parts)


def test_long_lines_of_common_words(spark, monkeypatch):
    """Long lines that share common words are rarely compared; their near copies go, also where the tables change."""
    from folioflow.llm import line_dedup
    rng = np.random.default_rng(10)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    common = [word(3) for _ in range(40)]
    lines = []
    for k in range(300):
        # 150 to 330 characters, so some pairs have one line on each side of LONG
        words = [word(9) for _ in range(8 + k % 10)] + list(rng.choice(common, 18 + k % 12))
        lines.append(" ".join(words[j] for j in rng.permutation(len(words))))
    copies = [x + " " + word(9) + " " + word(9) for x in lines[:60]]
    assert sum(len(x) < line_dedup.LONG <= len(y) for x, y in zip(lines, copies)) >= 5
    docs = spark.createDataFrame(list(enumerate(lines + copies)), "doc_id long, text string")
    pairs, measured = [], line_dedup._measured
    monkeypatch.setattr(line_dedup, "_measured", lambda p, *a: pairs.append(p.count()) or measured(p, *a))
    got = {r["doc_id"]: r["text"] for r in dedup_lines(docs).collect()}
    assert got == {i: x if i < 300 else "" for i, x in enumerate(lines + copies)}
    # 1,857 when all words had one weight, 1,152 now
    assert sum(pairs) < 1500


def test_measured_pairs_are_exact(spark):
    """Small bounds and beginnings first: the same pairs as by the whole edit distance."""
    from folioflow.llm import line_dedup
    rng = np.random.default_rng(11)
    letters = list("abcdefgh ")
    lines, pairs = [], []
    for k in range(400):
        x = list(rng.choice(letters, int(rng.integers(20, 600))))
        y = list(x)
        for _ in range(int(len(x) * rng.choice([0, .02, .1, .18, .25]))):
            # edits at one end, or anywhere
            at = int(rng.integers(max(1, len(y) // 4 if k % 3 == 0 else len(y))))
            at = len(y) - 1 - at if k % 2 else at
            y[at:at + 1] = [[], ["z"], [y[at], "z"]][[0, 1, 2, int(rng.integers(3))][k % 4]]
            y = y or ["z"]
        lines += [(2 * k, "".join(x)), (2 * k + 1, "".join(y))]
        pairs.append((2 * k, 2 * k + 1))
    classes = spark.createDataFrame(lines, "id long, line string")
    got = line_dedup._measured(spark.createDataFrame(pairs, "a long, b long"), classes, classes, 0.8).collect()
    text = dict(lines)
    both = spark.createDataFrame([(a, b, text[a], text[b]) for a, b in pairs], "a long, b long, x string, y string")
    want = both.selectExpr("a", "b", "levenshtein(x, y) AS d", "greatest(length(x), length(y)) AS n").collect()
    want = {(r["a"], r["b"]) for r in want if r["d"] <= int(r["n"] * 0.2 + 1e-9)}
    assert {(r["a"], r["b"]) for r in got} == want and 100 < len(want) < 390


def test_components_are_not_sent_through_the_driver(spark, scratch):
    """Tables of ids that are small on disk and large in memory are joined with a shuffle, whatever the session's threshold."""
    from folioflow.llm import common
    spark.range(200_000).selectExpr("id", "id % 20000 AS comp").write.parquet(f"{scratch}/members")
    members = spark.read.parquet(f"{scratch}/members")
    facts = members.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan(common.by_component(members, facts))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    assert "BroadcastHashJoin" in plan(members.join(facts, "comp"))
    with common.measured_broadcasts(spark):
        assert "BroadcastHashJoin" not in plan(members.join(facts, "comp"))
        assert "BroadcastHashJoin" in plan(members.join(F.broadcast(facts), "comp"))
    assert spark.conf.get(setting) == before and spark.conf.get(common.MEASURED_BROADCAST, None) is None


def test_rest_of_line_pairs_without_wide_rows(spark, monkeypatch):
    """Pairs left at the end are listed from narrow rows, once each, though they share several buckets."""
    from folioflow.llm import line_dedup
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    # lines of one beginning share many buckets and are no copies of each other
    begin = " ".join(word() for _ in range(12))
    lines = [begin + " " + " ".join(word() for _ in range(7)) for _ in range(30)]
    rows = list(enumerate(lines + [x + "0" for x in lines[:5]]))
    groups, verified, wide, asked = line_dedup.linked_groups, line_dedup._verified, [], []
    monkeypatch.setattr(line_dedup, "linked_groups", lambda *a, **kw: wide.append(kw.get("extra")) or groups(*a, **kw))
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *a: asked.append(sorted(map(tuple, pairs.collect()))) or verified(pairs, *a))
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: t if i < 30 else "" for i, t in rows}
    assert wide == [None]
    listed = [p for pairs in asked for p in pairs]
    assert len(listed) == len(set(listed)) > 200
