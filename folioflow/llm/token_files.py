"""Token-id output as Re-Pair compressed binary shards with random access.

Documents are range-partitioned and sorted by ``doc_id`` (rows of one ``doc_id``
by a hash of their text), encoded, and cut into shards of whole documents (about
``SHARD_TOKENS`` ids).  Inside a shard, rounds of Re-Pair replace frequent
adjacent symbol pairs by nonterminals until no pair occurs ``min_count`` times; a
pair never crosses a document end.  A shard is one self-contained binary value,
written with Spark's committed Parquet writer (a lost task leaves no part of a
shard behind), one row per shard.

Shard layout, little-endian:

====================  =====================================================
``RPT2``              magic
5 x uint32            n_docs, n_terms, n_rules, n_symbols, symbol width
n_terms x uint32      the id of each terminal, ascending
n_rules x 2 x uint32  the pair of symbols each nonterminal stands for
n_rules x uint32      expansion length of each nonterminal, in ids
(n_docs + 1) x uint32 first symbol of each document
(n_docs + 1) x uint64 first id of each document within the shard
n_symbols x width     the symbols: terminals, then nonterminals (2, 3 or 4 bytes)
====================  =====================================================

``decode_document`` and ``decode_range`` expand only the symbols they need.
A null text is empty (the end id alone); repeated rows are written once each; a
null ``doc_id`` sorts first; an empty table gives no shard.  One ``doc_id`` may
hold any number of rows: ranges cut between texts of one ``doc_id``.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_arrow
from .tokens import encoded_texts, encoder

SHARD_TOKENS = 1 << 20
MIN_COUNT = 16
_BINS = 19
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_MIX_A, _MIX_B = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def _bins(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * _MIX_A ^ b) * _MIX_B) >> np.uint32(32 - _BINS)


def _frequent(seq: np.ndarray, at: np.ndarray, min_count: int) -> tuple[np.ndarray, ...]:
    """Of the pairs that start at ``at``: places of those that occur ``min_count`` times, each one's pair, pairs, counts.

    Hash bins drop most rare pairs first (a bin holds at least as many places as
    any of its pairs); what is left is counted exactly, by sorting the pairs alone.
    A place finds its pair by its bin, or by search if frequent pairs share the bin.
    """
    a, b = seq[at], seq[at + 1]
    bins = _bins(a, b)
    left = np.flatnonzero((np.bincount(bins, minlength=1 << _BINS) >= min_count)[bins])
    at, bins = at[left], bins[left]
    key = (a[left].astype(np.uint64) << np.uint64(32)) | b[left]
    ranked = np.sort(key)
    first = np.flatnonzero(np.concatenate([ranked[:1] == ranked[:1], ranked[1:] != ranked[:-1]]))
    count = np.diff(np.append(first, len(ranked)))
    enough = count >= min_count
    pair, count = ranked[first[enough]], count[enough]
    if not len(pair):
        return at[:0], np.zeros(0, np.int64), pair, count
    slot = _bins((pair >> np.uint64(32)).astype(np.uint32), pair.astype(np.uint32))
    of_bin = np.zeros(1 << _BINS, np.int32)
    of_bin[slot] = np.arange(len(pair))
    of = of_bin[bins]
    shared = np.bincount(slot, minlength=1 << _BINS) > 1
    again = np.flatnonzero(shared[bins])
    of[again] = np.minimum(np.searchsorted(pair, key[again]), len(pair) - 1)
    found = np.flatnonzero(pair[of] == key)
    return at[found], of[found].astype(np.int64), pair, count


def _chosen(at: np.ndarray, of: np.ndarray, pair: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which candidates to replace, none overlapping: those more frequent than both neighbours, as far as they compete.

    Pairs rank by the binary logarithm of their count, then by a hash, so equal
    passages are parsed alike wherever they stand.  In a run of one pair (``aaaa``)
    every second place is taken.
    """
    rank = (np.log2(count).astype(np.uint64) << np.uint64(56)) | ((pair * _SPREAD) >> np.uint64(8))
    mine = rank[of]
    beside = np.diff(at) == 1                        # candidate k + 1 overlaps candidate k
    same = beside & (mine[1:] == mine[:-1])
    start = np.concatenate([[True], ~same])          # runs of one rank
    run = np.cumsum(start) - 1
    first = np.flatnonzero(start)
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    lower = np.ones(len(first), bool)
    lower[1:] &= ~(beside[first[1:] - 1] & (mine[first[1:] - 1] > mine[first[1:]]))
    lower[:-1] &= ~(beside[last[:-1]] & (mine[last[:-1] + 1] > mine[last[:-1]]))
    return lower[run] & ((np.arange(len(at)) - first[run]) % 2 == 0)


def compress(ids: np.ndarray, doc_lengths: np.ndarray, *, min_count: int = MIN_COUNT) -> bytes:
    """One shard of whole documents (their ids one after another).

    A round looks only at places whose pair may have become frequent since it was
    last counted, those beside a replaced one or still waiting for a neighbour;
    when none is left, all pairs are counted once more.
    """
    present = np.bincount(ids) > 0 if len(ids) else np.zeros(0, bool)
    terms = np.flatnonzero(present).astype("<u4")
    seq = (np.cumsum(present) - 1).astype(np.uint32)[ids] if len(ids) else np.zeros(0, np.uint32)
    base, min_count = len(terms), max(2, min_count)
    bounds = np.concatenate([[0], np.cumsum(doc_lengths)]).astype(np.int64)
    filled = doc_lengths > 0
    ends = np.zeros(len(seq), bool)
    ends[bounds[1:][filled] - 1] = True
    alive = ~ends                                    # places whose pair has to be counted
    symbol_of: dict[int, int] = {}
    rules, size, whole = [], np.ones(base, np.uint32), True
    while len(seq) > 1:
        at, of, pair, count = _frequent(seq, np.flatnonzero(alive), min_count)
        taken = _chosen(at, of, pair, count) if len(at) else np.zeros(0, bool)
        # a rule pays for itself from a few places on; the best pair is always replaced in half of its places
        made = np.bincount(of[taken], minlength=len(pair)) >= max(1, min_count // 2)
        taken &= made[of] if len(at) else False
        if not taken.any():
            if whole:
                break
            alive, whole = ~ends, True
            continue
        whole = False
        symbol, fresh = np.zeros(len(pair), np.uint32), []
        for k in np.flatnonzero(made).tolist():
            key = int(pair[k])
            if key not in symbol_of:
                symbol_of[key] = base + len(symbol_of)
                fresh.append(key)
            symbol[k] = symbol_of[key]
        new = np.array(fresh, np.uint64)
        a, b = (new >> np.uint64(32)).astype(np.uint32), new.astype(np.uint32)
        rules.append(np.stack([a, b], 1))
        size = np.concatenate([size, size[a] + size[b]])
        waiting = at[~taken]
        alive[:] = False
        alive[waiting] = True
        at, of = at[taken], of[taken]
        seq[at] = symbol[of]
        ends[at] = ends[at + 1]
        alive[at] = True
        alive[at[at > 0] - 1] = True                 # the pair before (a place that goes was itself replaced)
        gone = np.ones(len(seq), bool)
        gone[at + 1] = False
        seq, ends, alive = seq[gone], ends[gone], alive[gone]
        alive &= ~ends
    per_doc = np.zeros(len(doc_lengths), np.int64)
    per_doc[filled] = np.diff(np.concatenate([[-1], np.flatnonzero(ends)]))
    starts = np.concatenate([[0], np.cumsum(per_doc)]).astype("<u4")
    top = len(size)
    width = 2 if top <= 1 << 16 else 3 if top <= 1 << 24 else 4
    symbols = seq.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    rules = np.concatenate(rules).astype("<u4") if rules else np.zeros((0, 2), "<u4")
    return b"".join([b"RPT2", struct.pack("<5I", len(doc_lengths), base, len(rules), len(seq), width), terms.tobytes(),
                     rules.tobytes(), size[base:].astype("<u4").tobytes(), starts.tobytes(), bounds.astype("<u8").tobytes(),
                     symbols.tobytes()])


class Shard:
    """A shard opened for reading; symbols are expanded on request."""

    def __init__(self, payload: bytes):
        if payload[:4] != b"RPT2":
            raise ValueError("not a token shard")
        self.n_docs, self.base, n_rules, n_symbols, width = struct.unpack_from("<5I", payload, 4)
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.terms = take("<u4", self.base)
        self.rules = rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.size = take("<u4", n_rules).astype(np.int64)
        self.first_symbol = take("<u4", self.n_docs + 1).astype(np.int64)
        self.first_id = take("<u8", self.n_docs + 1).astype(np.int64)
        symbols = np.zeros((n_symbols, 4), np.uint8)
        symbols[:, :width] = take("u1", n_symbols * width).reshape(-1, width)
        self.symbols = symbols.view("<u4").ravel()
        # expansions of all nonterminals one after another; a rule uses earlier rules only
        self.at = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        flat, at, terms = np.empty(int(self.at[-1]), np.uint32), self.at.tolist(), self.terms.tolist()
        for k, pair in enumerate(rules.tolist()):
            p = at[k]
            for s in pair:
                if s < self.base:
                    flat[p] = terms[s]
                    p += 1
                else:
                    lo, hi = at[s - self.base], at[s - self.base + 1]
                    flat[p:p + hi - lo] = flat[lo:hi]
                    p += hi - lo
        self.flat = flat

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        s = symbols.astype(np.int64)
        if not len(s):
            return np.zeros(0, np.uint32)
        rules = np.flatnonzero(s >= self.base)
        rule = s[rules] - self.base
        more = self.size[rule]
        n = np.ones(len(s), np.int64)
        n[rules] = more
        out = np.repeat(self.terms[np.minimum(s, self.base - 1)], n)     # right for terminals; nonterminals are overwritten
        first = (np.cumsum(n) - n)[rules]
        inner = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more)
        out[np.repeat(first, more) + inner] = self.flat[np.repeat(self.at[rule], more) + inner]
        return out

    def decode_all(self) -> np.ndarray:
        return self._expand(self.symbols)

    def decode_document(self, k: int) -> np.ndarray:
        return self._expand(self.symbols[self.first_symbol[k]:self.first_symbol[k + 1]])

    def decode_range(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start:stop`` of document ``k``, expanding only the symbols that cover them."""
        symbols = self.symbols[self.first_symbol[k]:self.first_symbol[k + 1]]
        rule = symbols.astype(np.int64) - self.base
        n = np.where(rule >= 0, self.size[np.maximum(rule, 0)] if len(self.size) else 1, 1)
        end = np.cumsum(n)
        start, stop = max(0, start), min(stop, int(end[-1]) if len(end) else 0)
        if stop <= start:
            return np.zeros(0, np.uint32)
        i, j = int(np.searchsorted(end, start, "right")), int(np.searchsorted(end, stop, "left")) + 1
        skip = int(end[i] - n[i])
        return self._expand(symbols[i:j])[start - skip:stop - skip]


def write_token_files(docs: DataFrame, path: str, *, end_id: int = 2, tokenizer: str | None = None,
                      shard_tokens: int = SHARD_TOKENS, min_count: int = MIN_COUNT) -> None:
    """Write all documents' ids, in ascending ``doc_id`` order, as shards below ``path``."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext
        enc, part, shard = encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys, data, lengths = [], [], []

        def close():
            nonlocal keys, data, lengths, shard
            n = np.concatenate(lengths)
            payload = compress(np.concatenate(data), n, min_count=min_count)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([int(n.sum())], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.concat_arrays(keys)),
                 pa.array([payload], pa.binary())], ["part", "shard", "n_tokens", "doc_ids", "payload"])
            keys, data, lengths, shard = [], [], [], shard + 1
            return out

        for batch in batches:
            for first, ids, bounds in encoded_texts(enc, batch.column(1), end_id):
                keys.append(batch.column(0).slice(first, len(bounds) - 1))
                data.append(ids)
                lengths.append(np.diff(bounds))
                if sum(map(len, data)) >= shard_tokens:
                    yield close()
        if data:
            yield close()

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    map_arrow(ordered, run, f"part int, shard int, n_tokens long, doc_ids array<{key}>, payload binary"
              ).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """Rows ``doc_id, start, n_tokens, ids_crc32`` (and ``ids`` if asked) decoded from the shards."""
    shards = spark.read.parquet(path)
    key = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column(3)[i].as_py())
                ids = shard.decode_all().astype("<u4")
                raw = memoryview(ids.tobytes())
                first = shard.first_id
                keys = batch.column(2)[i].values
                n = len(keys)
                cols = [keys, pa.array([batch.column(0)[i].as_py()] * n, pa.int32()),
                        pa.array([batch.column(1)[i].as_py()] * n, pa.int32()), pa.array(first[:-1], pa.int64()),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(first[:-1], first[1:])], pa.int64())]
                names = ["doc_id", "_part", "_shard", "_in", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    docs = map_arrow(shards.select("part", "shard", "doc_ids", "payload"), run,
                     f"doc_id {key}, _part int, _shard int, _in long, n_tokens long, ids_crc32 long"
                     + (", ids array<int>" if with_ids else ""))
    # ids before each shard: totals of the earlier parts, then of the earlier shards of its part
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_part_start"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("_before")).join(
        parts, "part").select(F.col("part").alias("_part"), F.col("shard").alias("_shard"),
                              (F.col("_before") + F.col("_part_start")).alias("_base"))
    return docs.join(starts, ["_part", "_shard"]).withColumn("start", F.col("_base") + F.col("_in")).drop(
        "_part", "_shard", "_base", "_in")
