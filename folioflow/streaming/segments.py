"""Split planning (W4) over a stream of recognised pages, in any order.

A barcode page can be cut as soon as nothing can come between it and its
neighbours: all pages back to the previous barcode (or page 1) and on to the
next one (or the last page) are in.  Two stateful steps find the neighbours:

1. :func:`block_marks` keeps, per (document, block of pages), a bitmap of the
   pages seen and the barcodes among them.  Barcodes whose neighbours stand in
   the same block (or at an end of the document) are emitted at once, each one
   time; a block of a longer document emits one ``edge`` row when it is complete.
2. :func:`edge_marks` joins the edge rows of a document, one per ``block_pages``
   pages, and emits the barcodes whose neighbours stand in other blocks.

The blocks of the first step are dealt over a fixed number of stateful groups
(:mod:`folioflow.streaming.shards`), so the many small documents cost no group each.
So a document with a third of all pages is spread over its blocks, and only its
edge rows meet in one task.  The rules of the batch plan are then applied to the
emitted neighbours; over all batches the segments equal those of
:func:`folioflow.plans.split.split_plan`.

Pages of unknown documents and numbers outside a document are left out.  A page
reported again changes nothing; of several reports in one batch the smallest
barcode counts.  State that nothing touches for ``ttl_ms`` expires.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.filters import valid_barcode
from ..plans.split import segments_of
from ..session import ship_package
from . import shards as sh
from .completion import BLOCK_PAGES, TTL_MS, state_settings

_NEIGHBOURS = ("doc_id long, page_no int, barcode string, sentinel boolean, num_pages int, "
               "prev_page_no int, next_page_no int, next_sentinel boolean")
_EDGE = "marks int, first_page int, first_barcode string, first_next int, last_page int, last_barcode string, last_prev int"
MARKS = f"{_NEIGHBOURS}, block int, {_EDGE}, kind string"
_NO_EDGE = dict.fromkeys(("block", *(c.split()[0] for c in _EDGE.split(", "))))


def _mark(doc: int, page: int, barcode: str, n: int, prev: int | None, following: int | None) -> Row:
    """A barcode page with its neighbours; without a following one it reaches the end of its document."""
    return Row(doc_id=doc, page_no=page, barcode=barcode, sentinel=False, num_pages=n, prev_page_no=prev,
               next_page_no=n + 1 if following is None else following, next_sentinel=following is None, **_NO_EDGE, kind="mark")


def _unmarked(doc: int, n: int) -> Row:
    """A document without any barcode."""
    return Row(doc_id=doc, page_no=n + 1, barcode=None, sentinel=True, num_pages=n, prev_page_no=None, next_page_no=None,
               next_sentinel=None, **_NO_EDGE, kind="mark")


#: state of a shard: its blocks, their page bits, the barcodes of open blocks and the bytes of their texts
_STATE = "pairs binary, seen binary, marks binary, codes binary"
_OPEN, _COMPLETE = 0, 1
_MARK = np.dtype([("of", "<i4"), ("at", "<i4"), ("sent", "?"), ("size", "<i4")])


def _texts(marks: np.ndarray, codes: bytes) -> np.ndarray:
    ends = np.cumsum(marks["size"], dtype=np.int64)
    out = np.empty(len(marks), object)
    out[:] = [codes[e - n:e].decode() for e, n in zip(ends.tolist(), marks["size"].tolist())]
    return out


def _least(of: np.ndarray, at: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row per (of, at), sorted, with its smallest code; rows without a code are left out."""
    some = np.array([c is not None for c in code], bool)
    of, at, code = of[some], at[some], code[some]
    order = np.lexsort((at, of))
    of, at, code = of[order], at[order], code[order]
    first = np.ones(len(of), bool)
    first[1:] = (of[1:] != of[:-1]) | (at[1:] != at[:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(len(of)), 0)) if len(of) else np.zeros(0, np.int64)
    for k in np.flatnonzero(~first):
        code[head[k]] = min(code[head[k]], code[k])
    return of[first], at[first], code[first]


def _block_marks(block_pages: int, ttl_ms: int):
    """State function of one shard of blocks: barcodes whose neighbours are known, and the edges of complete blocks."""
    neighbours, edge = [[c.split()[0] for c in x.split(", ")] for x in (_NEIGHBOURS, _EDGE)]
    whole = {c.split()[0]: "Int64" if c.endswith("long") else "Int32" if c.endswith("int") else "boolean"
             for c in MARKS.split(", ") if not c.endswith("string")}

    def track(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old_pairs, old_bits, old_marks, codes = state.get if state.exists else (b"",) * 4
        old, bits = sh.opened(old_pairs, old_bits)
        marks = np.frombuffer(bytes(old_marks), _MARK)
        texts = _texts(marks, bytes(codes))
        now = state.getCurrentProcessingTimeMs()
        live = old["at_ms"] + ttl_ms >= now
        if not live.all():
            place, keep = np.cumsum(live) - 1, live[marks["of"]]
            old, bits = sh.kept(old, bits, live)
            marks, texts = marks[keep].copy(), texts[keep]
            marks["of"] = place[marks["of"]]
        rows = pd.concat([_NO_ROWS, *([] if state.hasTimedOut else [b[list(_NO_ROWS)] for b in batches])])
        doc, block, page, n = (rows[c].to_numpy(np.int64) for c in ("doc_id", "block", "page_no", "num_pages"))
        code = rows["barcode"].to_numpy(object)
        pairs, was, of = sh.joined(old, doc, block)
        use = pairs["status"][of] != _COMPLETE       # reports of a complete block change nothing
        of, page, n, code = of[use], page[use], n[use], code[use]
        touched = np.zeros(len(pairs), bool)
        touched[of] = True
        pairs["n"][touched] = 0
        np.maximum.at(pairs["n"], of, n)
        pairs["at_ms"][touched] = now
        lo = pairs["block"].astype(np.int64) * block_pages + 1
        hi = np.minimum(pairs["n"], lo + block_pages - 1)
        size, at = hi - lo + 1, page - lo[of]
        pairs["width"] = np.where(touched, np.maximum(pairs["width"], size), pairs["width"])
        seen, start = sh.widened(old, bits, pairs, was), sh.offsets(pairs)
        new = ~seen[start[of] + at]
        new_of, new_at, new_code = _least(of[new], at[new], code[new])
        seen[start[of] + at] = True
        upto = sh.counted(seen)
        m_of, m_at = np.concatenate([was[marks["of"]], new_of]), np.concatenate([marks["at"].astype(np.int64), new_at])
        sent, text = np.concatenate([marks["sent"], np.zeros(len(new_of), bool)]), np.concatenate([texts, new_code])
        order = np.lexsort((m_at, m_of))
        m_of, m_at, sent, text = m_of[order], m_at[order], sent[order], text[order]
        first, last = np.ones(len(m_of), bool), np.ones(len(m_of), bool)
        first[1:] = m_of[1:] != m_of[:-1]
        last[:-1] = first[1:]
        m_lo, m_n = lo[m_of], pairs["n"][m_of].astype(np.int64)
        before, after = np.where(first, 0, np.roll(m_at, 1)), np.where(last, size[m_of] - 1, np.roll(m_at, -1))
        inside = (~first | (m_lo == 1)) & (~last | (hi[m_of] == m_n)) & touched[m_of] & ~sent
        k = np.flatnonzero(inside)
        inside[k] = upto[start[m_of[k]] + after[k] + 1] - upto[start[m_of[k]] + before[k]] == after[k] - before[k] + 1
        some = lambda known, v: pd.arrays.IntegerArray(np.where(known, v, 0).astype(np.int32), ~known)
        out = []

        def emit(kind: str, **columns) -> None:
            if len(columns["doc_id"]):
                x = pd.DataFrame({c.split()[0]: columns.get(c.split()[0]) for c in MARKS.split(", ")[:-1]})
                out.append(x.assign(kind=kind).astype(whole))

        k = np.flatnonzero(inside)
        emit("mark", doc_id=pairs["doc"][m_of[k]], page_no=(m_lo + m_at)[k], barcode=text[k], sentinel=False, num_pages=m_n[k],
             prev_page_no=some(~first[k], (m_lo + before)[k]), next_page_no=np.where(last, m_n + 1, m_lo + after)[k], next_sentinel=last[k])
        sent[k] = True
        done = touched.copy()
        done[touched] = upto[(start[:-1] + size)[touched]] - upto[start[:-1][touched]] == size[touched]
        marked = np.bincount(m_of, minlength=len(pairs))
        alone = (lo == 1) & (hi == pairs["n"])
        k = np.flatnonzero(done & alone & (marked == 0))
        emit("mark", doc_id=pairs["doc"][k], page_no=pairs["n"][k].astype(np.int64) + 1, barcode=None, sentinel=True, num_pages=pairs["n"][k])
        k = np.flatnonzero(done & ~alone)
        if len(k):
            end = np.cumsum(marked)[k] - 1
            head, has, several = end - marked[k] + 1, marked[k] > 0, marked[k] > 1
            at_of = lambda where, known: some(known, lo[k] + (m_at[np.where(known, where, 0)] if len(m_at) else 0))
            text_of = lambda where: [text[w] if h else None for w, h in zip(where, has)]
            emit("edge", doc_id=pairs["doc"][k], num_pages=pairs["n"][k], block=pairs["block"][k], marks=marked[k],
                 first_page=at_of(head, has), first_barcode=text_of(head), first_next=at_of(head + 1, several),
                 last_page=at_of(end, has), last_barcode=text_of(end), last_prev=at_of(end - 1, several))
        # of a complete block only its key stays
        stay = ~done[m_of]
        left = np.zeros(int(stay.sum()), _MARK)
        left["of"], left["at"], left["sent"] = m_of[stay], m_at[stay], sent[stay]
        blobs = [t.encode() for t in text[stay]]
        left["size"] = [len(t) for t in blobs]
        seen = seen[np.repeat(~done, pairs["width"])]
        pairs["width"][done], pairs["status"][done] = 0, _COMPLETE
        if len(pairs):
            state.update((*sh.closed(pairs, seen), left.tobytes(), b"".join(blobs)))
            state.setTimeoutDuration(max(1, int(pairs["at_ms"].min()) + ttl_ms - now))
        elif state.exists:
            state.remove()
        yield from out

    return track


_NO_ROWS = pd.DataFrame({"doc_id": pd.Series(dtype="int64"), "block": pd.Series(dtype="int64"), "page_no": pd.Series(dtype="int64"),
                         "num_pages": pd.Series(dtype="int64"), "barcode": pd.Series(dtype=object)})


class EdgeMarks(StatefulProcessor):
    """First and last barcodes of the complete blocks of one document."""

    def __init__(self, block_pages: int, ttl_ms: int):
        self.block_pages, self.ttl_ms = block_pages, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.edges = handle.getMapState("edges", "block int", f"{_EDGE}, first_sent boolean, last_sent boolean",
                                        ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802,N803
        doc, n, new = int(key[0]), 0, {}
        names = [c.split()[0] for c in _EDGE.split(", ")]
        for r in rows:
            n = max(n, r["num_pages"])
            new[int(r["block"])] = {c: r[c] for c in names} | {"first_sent": False, "last_sent": False}
        edges = {k[0]: dict(zip([*names, "first_sent", "last_sent"], tuple(v))) for k, v in self.edges.iterator()}
        changed = set(new) - set(edges)
        edges = new | edges
        top = -(-n // self.block_pages) - 1
        # the nearest barcode before and after each block: a page, None for none, or absent while a block between is open
        before, after = {0: None}, {top: None}
        for b in range(top + 1):
            if b in edges and (edges[b]["marks"] or b in before):
                before[b + 1] = edges[b]["last_page"] if edges[b]["marks"] else before[b]
        for b in range(top, 0, -1):
            if b in edges and (edges[b]["marks"] or b in after):
                after[b - 1] = edges[b]["first_page"] if edges[b]["marks"] else after[b]
        out = []
        for b, e in edges.items():
            single = e["marks"] == 1
            # with a neighbour in its block and the other at an end of the document, a barcode is out already
            if e["marks"] and not e["first_sent"] and (single or b > 0) and b in before and (not single or b in after):
                out.append(_mark(doc, e["first_page"], e["first_barcode"], n, before[b], after[b] if single else e["first_next"]))
                e["first_sent"] = True
                changed.add(b)
            if e["marks"] > 1 and not e["last_sent"] and b < top and b in after:
                out.append(_mark(doc, e["last_page"], e["last_barcode"], n, e["last_prev"], after[b]))
                e["last_sent"] = True
                changed.add(b)
        if len(edges) == top + 1 and changed and not any(e["marks"] for e in edges.values()):
            out.append(_unmarked(doc, n))
        for b in changed:
            self.edges.updateValue((b,), tuple(edges[b].values()))
        return iter(out)

    def close(self) -> None:
        pass


def block_marks(pages: DataFrame, counts: DataFrame, *, prefix: str = "NEU_", min_len: int = 5,
                block_pages: int = BLOCK_PAGES, ttl_ms: int = TTL_MS, shards: int = sh.SHARDS) -> DataFrame:
    """Rows of ``MARKS`` from a stream of pages (doc_id, page_no, barcode) and ``counts`` (doc_id, num_pages).

    Blocks are dealt over ``shards`` stateful groups (:mod:`folioflow.streaming.shards`).
    """
    ship_package(pages.sparkSession)
    code = F.when(valid_barcode(F.col("barcode"), prefix, min_len), F.col("barcode"))
    x = sh.paged(pages.select("doc_id", F.col("page_no").cast("int").alias("page_no"), code.alias("barcode")), counts, block_pages, shards)
    return x.where("page_no BETWEEN 1 AND num_pages").groupBy("shard").applyInPandasWithState(
        _block_marks(block_pages, ttl_ms), MARKS, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def edge_marks(marks: DataFrame, *, block_pages: int = BLOCK_PAGES, ttl_ms: int = TTL_MS) -> DataFrame:
    """Rows of ``MARKS`` for barcodes with a neighbour in another block, from the stream of :func:`block_marks`."""
    ship_package(marks.sparkSession)
    return marks.where("kind = 'edge'").groupBy("doc_id").transformWithState(
        EdgeMarks(block_pages, ttl_ms), MARKS, "append", "processingTime")


class SegmentStream:
    """Both steps with their tables and checkpoints below one shared ``folder``; a new object goes on where the last one stopped."""

    def __init__(self, spark: SparkSession, folder: str, counts: DataFrame, **options):
        self.spark, self.counts, self.options = spark, counts, options
        self.step_options = {k: v for k, v in options.items() if k in ("block_pages", "ttl_ms")}
        self.marks, self.edges = os.path.join(folder, "marks"), os.path.join(folder, "edges")

    def _run(self, rows: DataFrame, path: str) -> None:
        w = rows.writeStream.format("parquet").partitionBy("kind").outputMode("append").option("path", path)
        w.option("checkpointLocation", path + "_state").trigger(availableNow=True).start().awaitTermination()

    def drain(self, pages: DataFrame) -> None:
        """Run both steps over all that the stream ``pages`` has now."""
        with state_settings(self.spark, drain=True):
            self._run(block_marks(pages, self.counts, **self.options), self.marks)
            self._run(edge_marks(self.spark.readStream.schema(MARKS).parquet(self.marks), **self.step_options), self.edges)

    def segments(self, keep_barcode: bool | str = False, docs: DataFrame | None = None, keep_leading: bool = False) -> DataFrame:
        """The segments known so far; each one stays as it is once it is there."""
        read = self.spark.read.schema(MARKS)
        rows = read.parquet(self.marks).where("kind = 'mark'").union(read.parquet(self.edges))
        return segments_of(rows, keep_barcode, docs, keep_leading)
