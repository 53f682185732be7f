"""Benchmark decontamination over a distributed positional inverted index.

The index is split by documents: each row holds one block of whole documents
(about ``SLICE_BYTES`` of text) with its sorted term hashes, the start of each
term's posting list and the word positions, delta-coded.  It is written once
and can be searched again.  A search reads every block once, without a shuffle:

1. Term counts over all blocks give the rarest term of every test window.
2. In each block a window's candidates are the postings of its rarest term
   shifted by that term's place in the window; the lists of the other terms,
   rarest first and shifted by their places, are intersected with them.
3. What is left are exact phrase matches; ``proximity`` instead asks for all
   terms of a window within a given distance of its rarest term.

The test items are the query set.  They are sent to the tasks in slices of at
most ``MAX_SLICE_WORDS`` words; a larger benchmark takes more passes over the
index, never a larger broadcast.

Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z
lower-cased.  Defined cases: null or empty texts have no words and match
nothing; an item without words never matches; repeated rows are reported once
each; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import LOWER, byte_slices, map_arrow, shared_folder, split_words, string_hash

WINDOW = 10
MAX_SLICE_WORDS = 1_000_000

_BREAKS = np.ones(256, bool)
_BREAKS[0x30:0x3A] = False
_BREAKS[0x61:0x7B] = False
_BREAKS[0x80:] = False


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words of every text."""
    data = LOWER[data]
    starts, ends = split_words(data, offsets, _BREAKS)
    hashes = string_hash(data, starts, ends)
    return hashes, np.diff(np.searchsorted(starts, offsets))


# ---- the index -----------------------------------------------------------------------------

def write_index(docs: DataFrame, path: str) -> None:
    """Write the positional index of ``docs(doc_id, text)`` below ``path``."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in byte_slices(batch.column(1)):
                hashes, counts = _words(data, offsets)
                order = np.argsort(hashes, kind="stable")
                ranked = hashes[order]
                first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else order
                delta = np.diff(order, prepend=0)
                delta[first] = order[first]          # each posting list starts from zero
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), batch.column(0).slice(i, j - i)),
                     pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                     pa.array([ranked[first].astype("<u8").tobytes()], pa.binary()),
                     pa.array([first.astype("<u4").tobytes()], pa.binary()),
                     pa.array([delta.astype("<u4").tobytes()], pa.binary()),
                     pa.array([int.from_bytes(os.urandom(8), "little", signed=True)], pa.int64())],
                    ["doc_ids", "words", "terms", "starts", "postings", "block"])

    map_arrow(docs.select("doc_id", "text"), run,
              f"doc_ids array<{key}>, words binary, terms binary, starts binary, postings binary, block long"
              ).write.option("compression", "zstd").parquet(path)


class Block:
    """One index row, opened for the terms of a query."""

    def __init__(self, words: bytes, terms: bytes, starts: bytes, postings: bytes):
        self.words = np.frombuffer(words, "<u4").astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.words)])
        self.terms = np.frombuffer(terms, "<u8")
        self.delta = np.frombuffer(postings, "<u4")
        self.starts = np.append(np.frombuffer(starts, "<u4").astype(np.int64), len(self.delta))

    def find(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys ``term number << 32 | position`` in order, and the first key of each term."""
        at = np.minimum(np.searchsorted(self.terms, vocabulary), max(len(self.terms) - 1, 0))
        there = self.terms[at] == vocabulary if len(self.terms) else np.zeros(len(vocabulary), bool)
        lo = np.where(there, self.starts[at], 0)
        n = np.where(there, self.starts[at + 1] - self.starts[at], 0) if len(self.terms) else lo
        first = np.concatenate([[0], np.cumsum(n)])
        inner = np.arange(first[-1]) - np.repeat(first[:-1], n)
        sums = np.cumsum(self.delta[np.repeat(lo, n) + inner].astype(np.int64))
        before = np.concatenate([[0], sums])[first[:-1]]
        return (np.repeat(np.arange(len(vocabulary)), n) << 32) | (sums - np.repeat(before, n)), first


# ---- the query set -------------------------------------------------------------------------

def _slices(items: DataFrame, width: int, max_words: int):
    """Slices of the query set: lists of ``(item_id, word hashes)``, each of at most about ``max_words`` words."""
    key = items.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in byte_slices(batch.column(1)):
                hashes, counts = _words(data, offsets)
                ends = np.concatenate([[0], np.cumsum(counts)])
                keep = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(keep)), pa.array(counts[keep], pa.int64()),
                     pa.array([hashes[ends[k]:ends[k + 1]].astype("<u8").tobytes() for k in keep], pa.binary())],
                    ["item_id", "n", "hashes"])

    worded = map_arrow(items.select("item_id", "text"), run, f"item_id {key}, n long, hashes binary")
    total = worded.agg(F.sum("n")).first()[0] or 0
    parts = -(-total // max_words)
    for k in range(parts):
        part = worded.where(F.pmod(F.xxhash64("item_id", "hashes"), F.lit(parts)) == k)
        rows = [(r["item_id"], np.frombuffer(bytes(r["hashes"]), "<u8")) for r in part.collect()]
        if rows:
            yield rows


class Windows:
    """Windows of a slice: term numbers by rank of rarity, their places, and the items they belong to."""

    def __init__(self, part: list, width: int):
        self.items = [x for x, _ in part]
        self.vocabulary = np.unique(np.concatenate([h for _, h in part]))
        seen: dict[bytes, int] = {}
        rows, self.of = [], []
        for item, (_, h) in enumerate(part):
            t = np.searchsorted(self.vocabulary, h)
            for s in range(max(1, len(t) - width + 1)):
                w = t[s:s + width]
                k = seen.setdefault(w.tobytes(), len(rows))
                if k == len(rows):
                    rows.append(w)
                    self.of.append(set())
                self.of[k].add(item)
        self.length = np.array([len(w) for w in rows])
        self.terms = np.full((len(rows), width), -1, np.int64)
        for k, w in enumerate(rows):
            self.terms[k, :len(w)] = w
        self.places = np.tile(np.arange(width), (len(rows), 1))

    def rarest_first(self, counts: np.ndarray) -> None:
        weight = np.where(self.terms >= 0, counts[self.terms], np.iinfo(np.int64).max)
        order = np.argsort(weight, axis=1, kind="stable")
        self.terms = np.take_along_axis(self.terms, order, 1)
        self.places = np.take_along_axis(self.places, order, 1)


def _counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Postings of each term over the whole index."""
    def run(batches):
        for batch in batches:
            total = np.zeros(len(vocabulary), np.int64)
            for i in range(batch.num_rows):
                terms = np.frombuffer(batch.column(0)[i].as_py(), "<u8")
                n = np.frombuffer(batch.column(2)[i].as_py(), "<u4").astype(np.int64).sum()
                starts = np.append(np.frombuffer(batch.column(1)[i].as_py(), "<u4").astype(np.int64), n)
                if len(terms):
                    at = np.minimum(np.searchsorted(terms, vocabulary), len(terms) - 1)
                    total += np.where(terms[at] == vocabulary, starts[at + 1] - starts[at], 0)
            k = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total[k], pa.int64())], ["term", "n"])

    out = np.zeros(len(vocabulary), np.int64)
    # at most one row per term of the slice reaches the driver
    for r in map_arrow(index.select("terms", "starts", "words"), run, "term long, n long").groupBy("term").agg(
            F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def _phrases(block: Block, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """``(window, first word)`` of every exact occurrence in the block."""
    keys, first = block.find(w.vocabulary)
    size = np.diff(first)
    rare = w.terms[:, 0]
    n = np.where(np.where(w.terms >= 0, size[w.terms] > 0, True).all(axis=1), size[rare], 0)
    win = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(win)) - np.repeat(np.cumsum(n) - n, n)
    start = (keys[first[rare[win]] + inner] & 0xFFFFFFFF) - w.places[win, 0]
    doc = np.searchsorted(block.bounds, start, "right") - 1
    ok = (start >= 0) & (start + w.length[win] <= block.bounds[np.minimum(doc + 1, len(block.words))])
    win, start = win[ok], start[ok]
    for k in range(1, w.terms.shape[1]):
        term = w.terms[win, k]
        want = (term << 32) | (start + w.places[win, k])
        at = np.minimum(np.searchsorted(keys, want), max(len(keys) - 1, 0))
        ok = (term < 0) | (keys[at] == want) if len(keys) else term < 0
        win, start = win[ok], start[ok]
    return win, start


def _near(block: Block, w: Windows, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """``(window, word of the rarest term)`` where all other terms stand within ``slop`` words of it."""
    keys, first = block.find(w.vocabulary)
    size = np.diff(first)
    rare = w.terms[:, 0]
    n = size[rare]
    win = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(win)) - np.repeat(np.cumsum(n) - n, n)
    at = keys[first[rare[win]] + inner] & 0xFFFFFFFF
    doc = np.searchsorted(block.bounds, at, "right") - 1
    for k in range(1, w.terms.shape[1]):
        term = w.terms[win, k]
        lo = np.maximum(at - slop, block.bounds[doc])
        hi = np.minimum(at + slop + 1, block.bounds[doc + 1])
        ok = (term < 0) | (np.searchsorted(keys, (term << 32) | hi) > np.searchsorted(keys, (term << 32) | lo))
        win, at, doc = win[ok], at[ok], doc[ok]
    return win, at


def _search(index: DataFrame, w: Windows, item_type, slop: int | None) -> DataFrame:
    key = index.schema["doc_ids"].dataType.elementType.simpleString()
    items = pa.array(w.items, to_arrow_type(item_type))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(*(batch.column(k)[i].as_py() for k in range(1, 5)))
                win, at = _phrases(block, w) if slop is None else _near(block, w, slop)
                doc = np.searchsorted(block.bounds, at, "right") - 1
                order = np.lexsort((win, at, doc))
                rows: dict[int, list] = {}
                for d, k, a in zip(doc[order].tolist(), win[order].tolist(), (at - block.bounds[doc])[order].tolist()):
                    rows.setdefault(d, []).append((a, k))
                n_hit, spans = np.zeros(len(block.words), np.int64), []
                for d in range(len(block.words)):
                    found, reach, own = rows.get(d, ()), 0, {}
                    for a, k in found:
                        end = a + int(w.length[k])
                        n_hit[d] += max(0, end - max(a, reach))
                        reach = max(reach, end)
                        for x in w.of[k]:
                            own.setdefault(x, []).append((a, end - a))
                    spans.append([(x, a, n) for x in sorted(own) for a, n in own[x]])
                size = np.cumsum([0, *map(len, spans)])
                flat = [s for x in spans for s in x]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, pa.array(block.words, pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.StructArray.from_arrays(
                         [items.take(pa.array([s[0] for s in flat], pa.int64())), pa.array([s[1] for s in flat], pa.int32()),
                          pa.array([s[2] for s in flat], pa.int32())], ["item_id", "start", "length"])),
                     pa.array(np.full(len(block.words), batch.column(5)[i].as_py(), np.int64)),
                     pa.array(np.arange(len(block.words), dtype=np.int32))],
                    ["doc_id", "n_words", "n_hit", "spans", "block", "place"])

    return map_arrow(index.select("doc_ids", "words", "terms", "starts", "postings", "block"), run,
                     f"doc_id {key}, n_words long, n_hit long, "
                     f"spans array<struct<item_id:{item_type.simpleString()},start:int,length:int>>, block long, place int")


def search(spark: SparkSession, path: str, items: DataFrame, *, width: int = WINDOW, proximity: int | None = None,
           max_slice_words: int = MAX_SLICE_WORDS) -> DataFrame:
    """Search the index below ``path`` for all windows of ``items(item_id, text)``.

    One row per indexed document: ``doc_id, n_words, n_hit`` (words inside any
    occurrence) and ``spans`` (item, first word, words).  With ``proximity`` the
    spans start at the rarest term of a window whose other terms are that near.
    """
    index = spark.read.parquet(path)
    item_type = items.schema["item_id"].dataType
    found = []
    for part in _slices(items, width, max_slice_words):
        w = Windows(part, width)
        w.rarest_first(_counts(index, w.vocabulary))
        found.append(_search(index, w, item_type, proximity))
    if not found:
        w = Windows([(None, np.zeros(1, np.uint64))], width)
        w.of = [set()]
        w.items = []
        found.append(_search(index, w, item_type, proximity))
    if len(found) == 1:
        return found[0].drop("block", "place")
    # a benchmark of several slices: one aggregation gathers the spans of each indexed row
    return reduce(DataFrame.union, found).groupBy("block", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans")).select(
        "doc_id", "n_words", _covered("spans").alias("n_hit"), "spans")


def _covered(spans: str):
    """Words covered by the union of spans."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].cast("long").alias("a"),
                                                                  (s["start"] + s["length"]).cast("long").alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    return F.aggregate(ordered, zero, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(s["a"], acc["reach"]))).alias("n"),
        F.greatest(acc["reach"], s["b"]).alias("reach")))["n"]


def find_contamination(docs: DataFrame, items: DataFrame, *, width: int = WINDOW) -> DataFrame:
    """Index ``docs`` and search it for ``items``: ``doc_id, n_words, n_hit, spans, item_ids``."""
    spark = docs.sparkSession
    path = shared_folder(spark, "positional_index")
    write_index(docs, path)
    return search(spark, path, items, width=width).withColumn(
        "item_ids", F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"].cast("string")))))


def decontaminate(docs: DataFrame, items: DataFrame, *, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window; each row goes by its own text, whatever its ``doc_id``."""
    text = F.sha2(docs["text"].cast("binary"), 256)
    bad = find_contamination(docs.select(text.alias("doc_id"), "text"), items, width=width).where("n_hit > 0").select(
        F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, text == bad["_bad"], "left_anti")
