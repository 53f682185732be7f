"""Merkle manifest, nearest neighbours and filter audit against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dedup import SPACE

from folioflow.llm.cross_polytope import codes_of, hadamard, nearest_neighbours, turned, unit
from folioflow.llm.merkle import folded, manifest, proof_digest
from folioflow.llm.survival import filter_audit, positional_popcount, survival_word


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(doc_id, text, lang, source, n_chars):
    out = ""
    for v in (doc_id, source, lang, n_chars, text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def brute_tree(leaves, arity):
    """Root and, for every leaf, its siblings level by level as (before, after)."""
    paths, level, of = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i in range(len(leaves)):
            at = of[i] - of[i] % arity
            run = level[at:at + arity]
            paths[i].append(("".join(run[:of[i] - at]), "".join(run[of[i] - at + 1:])))
        level = [sha("".join(level[k:k + arity])) for k in range(0, len(level), arity)]
        of = [k // arity for k in of]
    return level[0], paths


def brute_manifest(rows, arity):
    parts = {}
    for r in rows:
        parts.setdefault((r[2] is not None, (r[2] or "").encode()), []).append((r[0] is not None, r[0] or 0, brute_leaf(*r)))
    trees = {p: (sorted(v), *brute_tree([x[2] for x in sorted(v)], arity)) for p, v in parts.items()}
    order = sorted(trees)
    root, tops = brute_tree([trees[p][1] for p in order], arity)
    out = []
    for p, top in zip(order, tops):
        leaves, subroot, paths = trees[p]
        for leaf, path in zip(leaves, paths):
            out.append((leaf[1] if leaf[0] else None, leaf[2], subroot, root, sha("".join(a + b for a, b in path + top))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("arity,block", [(2, 1024), (2, 4), (3, 9)])
def test_manifest(docs, corpus, arity, block):
    rows = manifest(docs, arity=arity, block=block).select(
        "doc_id", "leaf", "subroot", "root", proof_digest().alias("proof"), folded(F.col("leaf")).alias("back")).collect()
    assert sorted([tuple(r)[:5] for r in rows], key=repr) == brute_manifest(corpus, arity)
    assert all(r["back"] == r["root"] for r in rows)


def test_manifest_edges(spark, docs, wide_docs, corpus, empty_docs):
    assert manifest(empty_docs).collect() == []
    one = [(1, "a", "en", None, 1)]
    got = manifest(spark.createDataFrame(one, docs.schema)).collect()
    assert [(r["leaf"], r["subroot"], r["root"], r["path"]) for r in got] == [(brute_leaf(*one[0]),) * 3 + ([],)]
    # repeated rows are leaves of their own; a null and an empty part differ; a lone last node is hashed alone
    many = [(5, "x", None, "s", 1)] * 3 + [(5, None, "", None, None), (None, "y", "é", "s", 2), (-7, "z" * 100_000, "z", "s", None)]
    got = manifest(spark.createDataFrame(many, docs.schema), block=2).select(
        "doc_id", "leaf", "subroot", "root", proof_digest().alias("proof")).collect()
    assert sorted(map(tuple, got), key=repr) == brute_manifest(many, 2)
    # extra columns of any name change nothing
    named = wide_docs.withColumns({"part": F.lit(1), "digest": F.lit(2), "path": F.lit(3), "block": F.lit(4), "idx": F.lit(5)})
    plain = {(r["doc_id"], r["leaf"], r["root"]) for r in manifest(docs).collect()}
    assert {(r["doc_id"], r["leaf"], r["root"]) for r in manifest(named).collect()} == plain
    # a change of any row shows in the root
    other = docs.withColumn("n_chars", F.when(F.col("doc_id") == 7, F.lit(-1)).otherwise(F.col("n_chars")))
    assert {r["root"] for r in manifest(other).select("root").distinct().collect()}.isdisjoint(r for *_, r in plain)


# ---- filter audit --------------------------------------------------------------------------

def brute_fails(rows):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t, lang, *_ in rows:
        t = t or ""
        w = [x for x in SPACE.split(t) if x]
        out.append((lang or "", i, (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                                    bool(re.search("[#$%&*|]", t)), i is not None and i > first[t])))
    return out


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, x in labels if x == 1} - {None}
    out = {}
    for part, i, fails in brute_fails(rows):
        for order in permutations("ABCDE"):
            gone = None
            for k, f in enumerate(order):
                c = out.setdefault((part, "".join(order), k + 1), [0] * 6)
                fail = fails["ABCDE".index(f)]
                c[2] += fail and gone is not None
                c[3] += fail and sum(fails) == 1
                if fail and gone is None:
                    gone = k
                    c[1] += 1
                    c[4] += i in good
                    c[5] += i in toxic
                c[0] += gone is None
    shapley = {}
    for (part, order, k), c in out.items():
        shapley[part, order[k - 1]] = shapley.get((part, order[k - 1]), 0) + c[1]
    return {key: (*map(int, c), shapley[key[0], key[1][key[2] - 1]]) for key, c in out.items()}


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_filter_audit(spark, docs, wide_docs, corpus, empty_docs):
    labels = [(i, k % 2, int(k % 3 == 0)) for k, (i, *_) in enumerate(corpus) if k % 4] + [(1, 1, 1), (1, None, None), (999, 1, 1), (None, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = brute_audit(corpus, labels)
    for rows in (docs, wide_docs.withColumns({"mask": F.lit(1), "digest": F.lit(2), "part": F.lit(3), "first": F.lit(4)})):
        got = filter_audit(rows, table).collect()
        assert len(got) == len(want)
        assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in FIGURES) for r in got} == want
    assert filter_audit(empty_docs, table).collect() == []
    assert len(filter_audit(docs, table.limit(0)).collect()) == len(want)


def test_positional_popcount(spark):
    rng = np.random.default_rng(3)
    for n in (0, 1, 47, 48, 1000, 100_003):
        words = rng.integers(0, 1 << 32, n).astype(np.int64)
        assert positional_popcount(words, 32).tolist() == [int((words >> b & 1).sum()) for b in range(32)]
    got = spark.range(32).select("id", survival_word(F.col("id").cast("int")).alias("w")).collect()
    assert all(r["w"] == sum(1 << s for s in range(32) if not s & r["id"]) for r in got)


# ---- nearest neighbours --------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>"


def brute_neighbours(vectors, k=10):
    ok = [(i, np.array(v, float)) for i, v in vectors if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for n, (i, v) in enumerate(ok):
        if i is not None and i % 100 == 0:
            far = [(math.sqrt(((v - w) ** 2).sum()), j is None, j, m) for m, (j, w) in enumerate(ok) if m != n and len(w) == len(v)]
            out.setdefault(i, []).append([(round(d, 9), j) for d, _, j, _ in sorted(far, key=lambda x: (x[0], x[1], x[2] or 0, x[3]))[:k]])
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], round(r["score"], 9), r["vec_id"]))
    return out


def test_pseudo_rotation():
    x = np.random.default_rng(1).normal(size=(7, 100))
    u = unit(x)
    t = turned(u, 2, 0)
    assert t.shape == (7, 256) and np.allclose((t[:, :128] ** 2).sum(axis=1), 1)       # lengths stay
    assert np.allclose(t[:, :128] @ t[:, :128].T, u @ u.T)                              # and angles
    eye = hadamard(np.eye(8))
    assert np.array_equal(eye @ eye.T, 8 * np.eye(8)) and set(eye.ravel()) == {1.0, -1.0}
    assert codes_of(u * 1.0, 1).tolist() == codes_of(unit(x * 7.5), 1).tolist()          # the length does not matter


@pytest.mark.parametrize("kind", ["random", "clustered", "lengths"])
def test_neighbours_recall(spark, kind, monkeypatch):
    from folioflow.llm import cross_polytope
    rng = np.random.default_rng(11)
    n, dim = 4000, 24
    x = rng.normal(size=(n, dim))
    if kind == "clustered":
        x = 4 * rng.normal(size=(40, dim))[rng.integers(0, 40, n)] + x
        x[::3] = x[0] + 1e-3 * x[::3]                                                   # a third of all rows are near copies
    if kind == "lengths":
        x *= np.exp(rng.normal(size=(n, 1)))
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    monkeypatch.setattr(cross_polytope, "BLOCK_VALUES", 24 * 300)                        # several blocks, split hot codes
    monkeypatch.setattr(cross_polytope, "BLOCK_ROWS", 16)
    monkeypatch.setattr(cross_polytope, "VISITS", 8)
    got = found(nearest_neighbours(spark.createDataFrame(vectors, VECTORS).repartition(5), F.col("vec_id") % 100 == 0))
    want = brute_neighbours(vectors)
    assert set(got) == set(want) and all([p for p, *_ in sorted(v)] == list(range(1, 11)) for v in got.values())
    hit = sum(len({j for _, j in want[q][0]} & {j for *_, j in got[q]}) for q in want)
    assert hit >= 0.9 * 10 * len(want)


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    same = [1.0, 2.0, 3.0]
    rows = [(0, same), (0, same), (100, [0.0, 0.0, 0.0]), (200, None), (300, [nan, 1.0, 1.0]), (400, [inf, 1.0, 1.0]), (500, [None, 1.0, 1.0]),
            (600, []), (700, [1.0, 0.0]), (800, [2.0]), (None, same), (7, same), (3, same), (9, [1.0, 2.0, 3.5]), (900, [3.0, -1.0, 0.5]),
            (11, [5.0, 5.0]), (12, [-1e30, 2e30, 1.0])] + [(20 + k, same) for k in range(15)]
    for schema in (VECTORS, "vec_id long, embedding array<double>"):
        df = spark.createDataFrame(rows, schema).withColumns({c: F.lit(1) for c in ("row", "id", "dim", "vec", "codes", "block", "part", "rank")})
        got = found(nearest_neighbours(df, F.col("vec_id") % 100 == 0))
        want = brute_neighbours(rows)
        assert 800 not in got and set(got) == {0, 700, 900}                             # no candidates: no rows
        assert sorted(got[700]) == [(1, want[700][0][0][0], 11)]
        # both rows of id 0: the other copy first, then ties by id, nulls last
        assert [(d, j) for _, d, j in sorted(got[0])] == sorted(want[0][0] + want[0][1]) and len(got[0]) == 20
        assert [j for _, _, j in sorted(got[0])][:4] == [0, 0, 3, 3]
        assert len(got[900]) == 10
    assert nearest_neighbours(spark.createDataFrame([], VECTORS), F.col("vec_id") % 100 == 0).collect() == []
    assert nearest_neighbours(spark.createDataFrame([(1, same)], VECTORS), F.col("vec_id") % 100 == 0).collect() == []


def test_queries_of_the_tables(spark):
    """The registered search against brute force over a whole table."""
    from folioflow.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute_neighbours(vectors), found(QUERIES["op12_nearest_neighbours"](spark, sf))
    assert set(want) == set(got)
    assert sum(len({j for _, j in want[q][0]} & {j for *_, j in got[q]}) for q in want) >= 0.9 * 10 * len(want)
