"""Removal of repeated byte strings with a hash-compared suffix sort.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
(smaller ``doc_id``, or the same document at an earlier byte).

1. Each text is thinned to anchors: the ``gram``-byte string with the smallest
   hash in every stretch of ``length`` bytes.  Equal strings of ``length`` bytes
   have the same anchor at the same place, so nothing else need be compared.
2. Anchors whose string occurs once in the corpus are dropped.  Occurrences with
   equal surroundings (all bytes that a string over the anchor can touch) form
   one class; all but its first occurrence are repeated as a whole.
3. Classes of one anchor with different surroundings are compared as suffixes:
   prefix polynomial hashes and binary search give the common extension of two
   suffixes, which orders them in a mergesort and bounds every repeat to the
   right; the extension to the left follows in the same way, and matches are
   verified on the bytes.
4. An anchor with more classes than ``max_group`` is not gathered in one task:
   its strings are grouped by their own hashes over the cluster, after a
   coarser grouping of the bytes that neighbouring strings share.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing;
rows with a null ``doc_id`` have no order, so they lose nothing and nothing is
lost to them; identical repeated rows share their result (the texts of one
``doc_id`` should be equal); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (MIX_1, byte_slices, map_arrow, mix, powers, prefix_hash, range_hash, signed, written)

LENGTH = 100
GRAM = 32
MAX_GROUP = 64
#: strings over an anchor are first grouped by the bytes that this many neighbouring ones share
STEP = 17
SLICE = 512 << 10
#: spans of one document are merged in blocks of ``2 ** BLOCK`` bytes before they are put into a list
BLOCK = 16


# ---- anchors -------------------------------------------------------------------------------

def _sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over ``x[i:i + w]``, for ``i <= len(x) - w``."""
    size, cur = 1, x
    while 2 * size <= w:
        cur = pick(cur[:-size], cur[size:])
        size *= 2
    return pick(cur[:len(x) - w + 1], cur[w - size:w - size + len(x) - w + 1])


class Anchors:
    """Anchors of the texts of one slice, with the hashes of their strings and surroundings."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
        self.prefix = prefix_hash(data)
        n, w = len(data), length - gram + 1
        self.at = np.zeros(0, np.int64)
        if n >= length:
            _, down = powers(n + 1)
            with np.errstate(over="ignore"):
                low = ((self.prefix[gram:] - self.prefix[:-gram]) * down[:n - gram + 1] * np.uint64(MIX_1)) >> np.uint64(32)
            low = low.astype(np.uint32)
            least = _sliding(low, w, np.minimum)     # of the stretch of `length` bytes from i on
            ends = np.repeat(offsets[1:], np.diff(offsets))[:len(least)]
            least[np.arange(len(least)) + length > ends] = 0
            padded = np.concatenate([np.zeros(w - 1, np.uint32), least, np.zeros(w - 1, np.uint32)])
            self.at = np.flatnonzero((_sliding(padded, w, np.maximum) == low) & (low > 0))
        self.doc = np.searchsorted(offsets, self.at, "right") - 1
        self.pos = self.at - offsets[self.doc]
        self.left = np.minimum(length - gram, self.pos)
        self.right = np.minimum(length, offsets[self.doc + 1] - self.at)
        self.h = range_hash(self.prefix, self.at, self.at + gram)
        with np.errstate(over="ignore"):
            self.c = mix(range_hash(self.prefix, self.at - self.left, self.at + self.right) + self.left.astype(np.uint64))
        # the same string and surroundings again in one text
        order = np.lexsort((self.at, self.c, self.h, self.doc))
        same = np.zeros(len(order), bool)
        same[1:] = ((self.h[order][1:] == self.h[order][:-1]) & (self.c[order][1:] == self.c[order][:-1])
                    & (self.doc[order][1:] == self.doc[order][:-1]))
        self.again = np.zeros(len(order), bool)
        self.again[order] = same


def _anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i, _, data, offsets in byte_slices(batch.column(1), SLICE):
                a = Anchors(data, offsets, length, gram)
                k = np.flatnonzero(~a.again)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(a.h[k])), pa.array(signed(a.c[k])), batch.column(0).take(pa.array(i + a.doc[k])),
                     pa.array(a.pos[k], pa.int32()), pa.array(a.left[k], pa.int16()), pa.array(a.right[k], pa.int16())],
                    ["h", "c", "doc_id", "pos", "l", "r"])

    return map_arrow(docs, run, f"h long, c long, doc_id {_key_type(docs)}, pos int, l short, r short")


# ---- suffixes ------------------------------------------------------------------------------

class Suffixes:
    """Surroundings of anchors, one after another: common extensions, order, repeats."""

    def __init__(self, data: np.ndarray, anchor: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray):
        self.data, self.anchor, self.left, self.right = data, anchor, left, right
        self.prefix = prefix_hash(data)
        self.down = powers(len(data) + 1)[1]
        change = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(change, len(group)))
        self.first, self.stop = np.repeat(change, size), np.repeat(change + size, size)

    def _equal(self, a, b, n):
        with np.errstate(over="ignore"):
            return (self.prefix[a + n] - self.prefix[a]) * self.down[a] == (self.prefix[b + n] - self.prefix[b]) * self.down[b]

    def _extension(self, x, y, most, sign):
        """Longest common extension of the suffixes (or, with sign -1, of what stands before them)."""
        lo, hi = np.zeros(len(x), np.int64), most.copy()
        a, b = self.anchor[x], self.anchor[y]
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            ok = self._equal(a, b, mid) if sign > 0 else self._equal(a - mid, b - mid, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo

    def common_right(self, x, y):
        return self._extension(x, y, np.minimum(self.right[x], self.right[y]), 1)

    def common_left(self, x, y):
        return self._extension(x, y, np.minimum(self.left[x], self.left[y]), -1)

    def _less(self, x, y, or_equal):
        n = self.common_right(x, y)
        end_x, end_y = n == self.right[x], n == self.right[y]
        top = len(self.data) - 1
        bx, by = self.data[np.minimum(self.anchor[x] + n, top)], self.data[np.minimum(self.anchor[y] + n, top)]
        return np.where(end_x & end_y, or_equal, np.where(end_x, True, np.where(end_y, False, bx < by)))

    def order(self) -> np.ndarray:
        """Rows of each group in suffix order: all groups' runs are merged level by level at once."""
        n = len(self.anchor)
        rows, width, slots = np.arange(n), 1, np.arange(n)
        largest = int((self.stop - self.first).max()) if n else 0
        while width < largest:
            q = slots - self.first
            run = q // width
            lo = self.first + (run ^ 1) * width
            hi = np.minimum(lo + width, self.stop)
            some = np.flatnonzero(lo < self.stop)
            start, a, b = lo[some], lo[some].copy(), hi[some]
            own, odd = rows[some], (run[some] & 1).astype(bool)
            while (a < b).any():                     # place of each suffix in the neighbouring run
                mid = (a + b) // 2
                go = np.flatnonzero(a < b)
                other = rows[mid[go]]
                # a suffix of the right run comes after equal ones of the left run
                after = self._less(other, own[go], odd[go])
                a[go] = np.where(after, mid[go] + 1, a[go])
                b[go] = np.where(after, b[go], mid[go])
            new = slots.copy()
            new[some] = self.first[some] + (run[some] // 2) * 2 * width + q[some] % width + (a - start)
            out = np.empty_like(rows)
            out[new] = rows
            rows, width = out, 2 * width
        return rows

    def repeats(self, length: int):
        """``(row, bytes to the left, bytes to the right)`` repeated from an earlier row of the group."""
        rows = self.order()
        found = []
        n = len(rows)
        x = np.arange(n - 1) if n else np.zeros(0, np.int64)
        x = x[self.stop[x] > x + 1]
        step = np.zeros(n, np.int64)
        step[x] = self.common_right(rows[x], rows[x + 1])
        reach, d = step[x], 1
        while len(x):                                # pairs d places apart: the least step between them
            a, b = rows[x], rows[x + d]
            may = np.flatnonzero(reach + np.minimum(self.left[a], self.left[b]) >= length)
            if len(may):
                left = self.common_left(a[may], b[may])
                good = left + reach[may] >= length
                a2, b2, l2, r2 = a[may][good], b[may][good], left[good], reach[may][good]
                ok = self._verified(a2, b2, l2, r2)
                found.append((np.maximum(a2, b2)[ok], l2[ok], r2[ok]))
            d += 1
            keep = np.flatnonzero(x + d < self.stop[x])
            x, reach = x[keep], reach[keep]
            reach = np.minimum(reach, step[x + d - 1])
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(z) for z in zip(*found))

    def _verified(self, a, b, left, right):
        """Whether the bytes that the hashes call equal are equal."""
        n = left + right
        shift = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        x, y = np.repeat(self.anchor[a] - left, n) + shift, np.repeat(self.anchor[b] - left, n) + shift
        wrong = np.flatnonzero(self.data[x] != self.data[y])
        ok = np.ones(len(a), bool)
        ok[np.searchsorted(np.cumsum(n), wrong, "right")] = False
        return ok


def _compared(members: DataFrame, length: int) -> DataFrame:
    """``doc_id, s, e`` repeated in groups of equal ``h``; each group is small."""
    def solve(t: pa.Table):
        h, doc, pos = (t.column(k).to_numpy() for k in ("h", "doc_id", "pos"))
        new = np.ones(len(h), bool)                  # repeated rows of one document give a place twice
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])
        if not new.all():
            t = t.filter(pa.array(new))
        text = t.column("bytes").combine_chunks()
        offs = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
        data = np.frombuffer(text.buffers()[2], np.uint8)[offs[0]:offs[-1]]
        offs = offs - offs[0]
        left = t.column("l").to_numpy().astype(np.int64)
        s = Suffixes(data, offs[:-1] + left, left, np.diff(offs) - left, t.column("h").to_numpy())
        row, l2, r2 = s.repeats(length)
        pos = t.column("pos").to_numpy().astype(np.int64)[row]
        return pa.RecordBatch.from_arrays(
            [t.column("doc_id").combine_chunks().take(pa.array(row)), pa.array(pos - l2, pa.int32()),
             pa.array(pos + r2, pa.int32())], ["doc_id", "s", "e"])

    def run(batches):
        kept = None                                  # the unfinished last group
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([kept, t]) if kept is not None else t
            h = t.column("h").to_numpy()
            cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if (h != h[-1]).any() else 0
            kept = t.slice(cut)
            if cut:
                yield solve(t.slice(0, cut))
        if kept is not None and kept.num_rows:
            yield solve(kept)

    # at most MAX_GROUP rows have one h, so a hot string cannot make a large partition
    placed = members.repartition("h").sortWithinPartitions("h", "doc_id", "pos")
    return map_arrow(placed, run, f"doc_id {_key_type(members)}, s int, e int")


# ---- texts with lists of places ------------------------------------------------------------

def _key_type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def _listed(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``_doc, items``: the rows of each document (of one document's places) as a list."""
    return written(rows.groupBy("doc_id").agg(F.collect_list(F.struct(*columns)).alias("items")), name).withColumnRenamed(
        "doc_id", "_doc")


def _with_lists(docs: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """``doc_id, text, items``: the documents that ``rows`` name, with their rows as a list.

    Both sides are shuffled at every size: the lists grow with the corpus, so
    nothing is broadcast.
    """
    lists = _listed(rows, columns, "places").hint("merge")
    return docs.join(lists, docs["doc_id"] == lists["_doc"]).select("doc_id", "text", "items")


def _merged(spans: DataFrame) -> DataFrame:
    """``doc_id, s, e``: the union of the spans of each block of a document as runs that do not touch."""
    block = Window.partitionBy("doc_id", "block").orderBy("s")
    reach = F.max("e").over(block.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.groupBy("doc_id", F.shiftright("s", BLOCK).alias("block"), "s").agg(F.max("e").alias("e")).withColumn(
        "new", F.when(F.col("s") <= reach, 0).otherwise(1)).withColumn(
        "run", F.sum("new").over(block.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "block", "run").agg(F.min("s").alias("s"), F.max("e").alias("e")).select("doc_id", "s", "e")


def _items(column: pa.Array, i: int, j: int, names: list[str]):
    """Row number in the slice and the fields of all list items of rows ``i:j``."""
    part = column.slice(i, j - i)
    offs = part.offsets.to_numpy().astype(np.int64)
    flat = part.flatten()
    return np.repeat(np.arange(j - i), np.diff(offs)), [flat.field(n).to_numpy(zero_copy_only=False) for n in names]


def _surroundings(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """``h, doc_id, pos, l, bytes`` of the wanted anchors."""
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in byte_slices(batch.column(1), SLICE):
                row, (h, pos, left, right) = _items(batch.column(2), i, j, ["h", "pos", "l", "r"])
                a = offsets[row] + pos
                n = left.astype(np.int64) + right
                ends = np.cumsum(n)
                flat = data[np.arange(int(n.sum())) - np.repeat(ends - n, n) + np.repeat(a - left, n)]
                bytes_ = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(
                    np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), batch.column(0).take(pa.array(i + row)), pa.array(pos), pa.array(left), bytes_],
                    ["h", "doc_id", "pos", "l", "bytes"])

    return map_arrow(_with_lists(docs, reps, ["h", "pos", "l", "r"]), run,
                     f"h long, doc_id {_key_type(docs)}, pos int, l short, bytes binary")


def _cores(docs: DataFrame, reps: DataFrame, length: int, gram: int) -> DataFrame:
    """``k, doc_id, pos, t``: hashes of the bytes shared by the strings ``t * STEP`` to ``t * STEP + STEP - 1``
    bytes before an anchor."""
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in byte_slices(batch.column(1), SLICE):
                row, (pos,) = _items(batch.column(2), i, j, ["pos"])
                a, prefix = offsets[row] + pos, prefix_hash(data)
                for t in range(-(-(length - gram + 1) // STEP)):
                    last = min(STEP * (t + 1) - 1, length - gram)
                    # a string that starts o bytes before the anchor, t * STEP <= o <= last, covers all of this
                    lo, hi = a - t * STEP, a - last + length
                    ok = np.flatnonzero((lo >= offsets[row]) & (hi <= offsets[row + 1]))
                    key = range_hash(prefix, lo[ok], hi[ok])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(key)), batch.column(0).take(pa.array(i + row[ok])), pa.array(pos[ok]),
                         pa.array(np.full(len(ok), t, np.int16))], ["k", "doc_id", "pos", "t"])

    return map_arrow(_with_lists(docs, reps, ["pos"]), run, f"k long, doc_id {_key_type(docs)}, pos int, t short")


def _strings(docs: DataFrame, places: DataFrame, length: int, gram: int) -> DataFrame:
    """``k1, k2, doc_id, s``: two hashes and the start of each string over the wanted places."""
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in byte_slices(batch.column(1), SLICE):
                row, (pos, t) = _items(batch.column(2), i, j, ["pos", "t"])
                prefix = prefix_hash(data)
                last = np.minimum(STEP * (t.astype(np.int64) + 1) - 1, length - gram)
                starts, rows = [], []
                for o in range(STEP):
                    back = t.astype(np.int64) * STEP + o
                    s = offsets[row] + pos - back
                    ok = (back <= last) & (s >= offsets[row]) & (s + length <= offsets[row + 1])
                    starts.append(s[ok])
                    rows.append(row[ok])
                s, first = np.unique(np.concatenate(starts), return_index=True)
                row = np.concatenate(rows)[first]
                one = range_hash(prefix, s, s + length // 2)
                two = range_hash(prefix, s + length // 2, s + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(one)), pa.array(signed(two)), batch.column(0).take(pa.array(i + row)),
                     pa.array((s - offsets[row]).astype(np.int32))], ["k1", "k2", "doc_id", "s"])

    return map_arrow(_with_lists(docs, places, ["pos", "t"]), run,
                     f"k1 long, k2 long, doc_id {_key_type(docs)}, s int")


# ---- the operator --------------------------------------------------------------------------

def repeated_spans(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """``doc_id, s, e``: byte ranges repeated from an earlier place of the corpus outside the same surroundings of
    the same document (those ``cut`` finds by itself)."""
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    anchors = _anchors(docs, length, gram)
    shared = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    anchors = written(anchors.join(shared, "h", "left_semi"), "shared_anchors")
    place = F.struct("doc_id", "pos")
    classes = written(anchors.groupBy("h", "c").agg(
        F.min(F.struct("doc_id", "pos", "l", "r")).alias("m"), F.count(F.lit(1)).alias("n")), "anchor_classes")
    whole = written(_merged(anchors.where(F.col("l") + F.col("r") >= length).join(
        classes.where("n > 1").select("h", "c", F.struct("m.doc_id", "m.pos").alias("first")), ["h", "c"]).where(
        place != F.col("first")).select("doc_id", (F.col("pos") - F.col("l")).cast("int").alias("s"),
                                        (F.col("pos") + F.col("r")).cast("int").alias("e"))), "whole_spans")
    mixed = classes.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    reps = written(classes.join(mixed, "h").where(F.col("m.l") + F.col("m.r") >= length).select("h", "size", "m.*"),
                   "anchor_representatives")
    near = written(_merged(_compared(_surroundings(docs, reps.where(F.col("size") <= max_group)), length)), "near_spans")

    # anchors with many surroundings
    cores = written(_cores(docs, reps.where(F.col("size") > max_group), length, gram), "cores")
    often = cores.groupBy("k", "t").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k", "t")
    strings = written(_strings(docs, written(cores.join(often, ["k", "t"], "left_semi").select("doc_id", "pos", "t"),
                                             "core_places"), length, gram), "strings")
    first = strings.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "s")).alias("first"), F.count(F.lit(1)).alias("n"))
    far = written(_merged(strings.join(first.where("n > 1"), ["k1", "k2"]).where(
        F.struct("doc_id", "s") != F.col("first")).select("doc_id", "s", (F.col("s") + length).cast("int").alias("e"))), "far_spans")
    return _merged(whole.union(near).union(far))


def cut(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP,
        with_kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the remaining bytes, if asked) per document."""
    docs = docs.select("doc_id", "text")
    lists = _listed(repeated_spans(docs, length=length, gram=gram, max_group=max_group), ["s", "e"], "span_lists").hint("merge")
    both = docs.join(lists, docs["doc_id"] == lists["_doc"], "left").select(
        "doc_id", "text", F.coalesce("items", F.array().cast("array<struct<s:int,e:int>>")).alias("items"))

    def run(batches):
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for i, j, data, offsets in byte_slices(batch.column(1), SLICE):
                row, (s, e) = _items(batch.column(2), i, j, ["s", "e"])
                size = np.diff(offsets)
                a = Anchors(data, offsets, length, gram)
                own = np.flatnonzero(a.again & (a.left + a.right >= length) & known[i:j][a.doc])
                lo = np.concatenate([offsets[row] + s, a.at[own] - a.left[own]])
                hi = np.concatenate([offsets[row] + np.minimum(e, size[row]), a.at[own] + a.right[own]])
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, lo, 1)
                np.add.at(depth, hi, -1)
                gone = np.cumsum(depth[:-1]) > 0
                before = np.concatenate([[0], np.cumsum(gone)])
                removed = np.diff(before[offsets])
                start = gone.copy()
                start[1:] &= ~gone[:-1]
                start[offsets[(offsets > 0) & (offsets < len(data))]] = gone[offsets[(offsets > 0) & (offsets < len(data))]]
                runs = np.diff(np.concatenate([[0], np.cumsum(start)])[offsets])
                left = data[~gone].tobytes()
                at = offsets - before[offsets]
                kept = [left[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
                cols = [batch.column(0).slice(i, j - i), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                        pa.array(runs, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_kept:
                    cols.append(pa.array(kept, pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(cols, names)

    return map_arrow(both, run, f"doc_id {_key_type(docs)}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                     + (", kept binary" if with_kept else ""))
