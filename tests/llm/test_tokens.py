from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm.packing import best_fit_packing, pack, plan
from folioflow.llm.token_files import Shard, compress, read_token_files, write_token_files
from folioflow.llm.tokens import encoded_texts, encoder


def ids_of(text):
    return encoder().whole.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB é'ÀÿßİΣς<|>endoftext.,!1２\n\t ́日ﬁ", max_size=40), min_size=1, max_size=5))
def test_encoder_equals_library(texts):
    for first, ids, bounds in encoded_texts(encoder(), pa.array(texts), 7):
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            assert ids[a:b].tolist() == ids_of(texts[first + k]) + [7]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=60), max_size=8))
def test_grammar_round_trip(each):
    ids = np.array([x for d in each for x in d], np.uint32)
    shard = Shard(compress(ids, np.array([len(d) for d in each], np.int64), min_count=2))
    assert shard.decode_all().tolist() == ids.tolist()
    for k, d in enumerate(each):
        assert shard.decode_document(k).tolist() == d
        assert shard.decode_range(k, 1, len(d) - 1).tolist() == d[1:max(len(d) - 1, 1)]


def most_frequent_pair(shard):
    """Occurrences of the most frequent pair of symbols, none across a document end."""
    count = {}
    for a, b in zip(shard.first_symbol[:-1], shard.first_symbol[1:]):
        d = shard.symbols[a:b].tolist()
        for p in zip(d, d[1:]):
            count[p] = count.get(p, 0) + 1
    return max(count.values(), default=0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=300), max_size=8), st.integers(2, 9))
def test_grammar_leaves_no_frequent_pair(each, min_count):
    ids = np.array([x for d in each for x in d], np.uint32)
    shard = Shard(compress(ids, np.array([len(d) for d in each], np.int64), min_count=min_count))
    assert shard.decode_all().tolist() == ids.tolist()
    assert most_frequent_pair(shard) < min_count


def test_grammar_of_copies_and_runs():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 40_000, 3000).astype(np.uint32)
    each = [np.concatenate([rng.integers(0, 40_000, 50).astype(np.uint32), passage]) for _ in range(40)]
    each.append(np.full(20_000, 7, np.uint32))
    shard = Shard(compress(np.concatenate(each), np.array([len(d) for d in each], np.int64)))
    for k, d in enumerate(each):
        assert (shard.decode_document(k) == d).all() and (shard.decode_range(k, 60, 900) == d[60:900]).all()
    assert most_frequent_pair(shard) < 16
    assert len(shard.symbols) < 40 * 52 + 40         # a copy is one symbol or two, the run a few
    assert shard.size.max() >= 3000


def test_token_files_of_one_id(spark, scratch):
    rows = [(None, f"text number {k} of many rows") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # keep small ranges apart
    try:
        write_token_files(docs, scratch + "/hot", shard_tokens=500)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = read_token_files(spark, scratch + "/hot")
    assert sorted((r["n_tokens"], r["ids_crc32"]) for r in got.collect()) == sorted(
        (len(x), zlib.crc32(x.tobytes())) for _, t in rows for x in [np.array(ids_of(t) + [2], "<u4")])
    assert spark.read.parquet(scratch + "/hot").select("part").distinct().count() > 1


def test_token_files(spark, docs, corpus, scratch):
    path = scratch + "/tokens"
    write_token_files(docs, path, shard_tokens=3000)
    got = read_token_files(spark, path).orderBy("start").collect()
    assert len(got) == len(corpus)
    order = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [r[0] for r in order]
    want = {}
    for i, t, *_ in corpus:
        x = np.array(ids_of(t) + [2], "<u4")
        want.setdefault(i, set()).add((len(x), zlib.crc32(x.tobytes())))
    start = 0
    for r in got:
        assert r["start"] == start and (r["n_tokens"], r["ids_crc32"]) in want[r["doc_id"]]
        start += r["n_tokens"]


def test_token_files_empty(spark, empty_docs, scratch):
    write_token_files(empty_docs, scratch + "/none")
    assert read_token_files(spark, scratch + "/none").count() == 0


def check_packing(rows, corpus, capacity):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(docs, corpus, capacity):
    rows = best_fit_packing(docs, capacity=capacity).collect()
    want = sorted((i is not None, i or 0, k // capacity, k, len(x[k:k + capacity]), zlib.crc32(x[k:k + capacity].tobytes()))
                  for i, t, *_ in corpus for x in [np.array(ids_of(t) + [0], "<u4")] for k in range(0, len(x), capacity))
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == want
    used = check_packing(rows, corpus, capacity)
    assert used <= 1.02 * -(-sum(w[4] for w in want) // capacity) + 1


@pytest.mark.parametrize("doc_id", ["NULL", "7"])
def test_packing_rows_of_one_id(spark, doc_id):
    """Equal pieces of one id (or of none) are ranked in many blocks and all get a place of their own."""
    parts = spark.range(5000).selectExpr(f"CAST({doc_id} AS LONG) AS doc_id", "0 AS piece", "IF(id % 3 = 0, 900L, 700L) AS length")
    packed = pack(parts, rank_blocks=64)
    assert packed.columns == ["doc_id", "piece", "length", "sequence_id", "offset"]
    rows = packed.collect()
    assert len(rows) == 5000 == len({(r["sequence_id"], r["offset"]) for r in rows})
    check_packing(rows, None, 2048)


def test_packing_ids_and_empty(docs, empty_docs):
    assert best_fit_packing(empty_docs).count() == 0
    for r in best_fit_packing(docs.where("doc_id < 10"), with_ids=True).collect():
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 30), max_size=12))
def test_plan_places_every_rank_once(histogram):
    runs, capacity = plan(histogram, 20), 20
    seen, bins = {}, {}
    for length, lo, hi, first, offset in runs:
        for r in range(lo, hi):
            assert (length, r) not in seen
            seen[length, r] = (first + r - lo, offset)
            bins.setdefault(first + r - lo, []).append((offset, length))
    assert len(seen) == sum(histogram.values())
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_a_slice_is_taken_apart_in_blocks(monkeypatch):
    from folioflow.llm import tokens
    texts = ["", "One two 34 don't caf\u00c9", None, "x" * 900, "a long\ttext " * 40, "", "end"] * 5
    enc, seen, step = tokens.Encoder(), [], tokens.Encoder.encode_slice
    (want,) = list(encoded_texts(enc, pa.array(texts), 7))

    def counted(self, data, offsets):
        seen.append((len(data), len(offsets) - 1))
        return step(self, data, offsets)

    monkeypatch.setattr(tokens, "BLOCK_BYTES", 600)
    monkeypatch.setattr(tokens.Encoder, "encode_slice", counted)
    (got,) = list(encoded_texts(enc, pa.array(texts), 7))
    assert len(seen) > 5 and all(size <= 600 or n == 1 for size, n in seen)
    assert got[0] == want[0] == 0 and np.array_equal(got[1], want[1]) and np.array_equal(got[2], want[2])


def test_frequent_pairs_are_counted_exactly_in_shared_bins(monkeypatch):
    from folioflow.llm import token_files
    rng = np.random.default_rng(4)
    seq = rng.integers(0, 12, 3000).astype(np.uint32)
    at = np.flatnonzero(rng.random(len(seq) - 1) < 0.8)
    pair, of, count = np.unique(seq[at].astype(np.uint64) << np.uint64(32) | seq[at + 1], return_inverse=True, return_counts=True)
    for bins in (1, 3, 19):
        monkeypatch.setattr(token_files, "_BINS", bins)
        for least in (2, 15, 20, 5000):
            enough = count >= least
            got = token_files._frequent(seq, at, least)
            assert np.array_equal(got[0], at[enough[of]]) and np.array_equal(got[2], pair[enough])
            assert np.array_equal(got[3], count[enough]) and np.array_equal(got[2][got[1]], pair[of[enough[of]]])
