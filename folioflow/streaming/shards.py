"""Stateful groups of many (document, block of pages) pairs, for trackers whose documents are many and small.

A stateful Python function costs a fixed time per group, which is far more than
the work on the few pages of a usual document.  So the pairs are dealt by their
hash over ``SHARDS`` groups; the state of a group is one table of its pairs and
one run of page bits, no longer than the pages seen, and a batch changes all of
its pairs at once.  A hot document is spread over its blocks as before.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS = 1024

#: a pair: ``width`` of the page bits belong to it; ``at_ms`` is a time of its own use
PAIR = np.dtype([("doc", "<i8"), ("block", "<i4"), ("n", "<i4"), ("width", "<i4"), ("status", "u1"), ("at_ms", "<i8")])


def shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "block"), F.lit(shards)).cast("int")


def paged(pages: DataFrame, counts: DataFrame, block_pages: int, shards: int) -> DataFrame:
    """``pages`` of the documents of ``counts`` with num_pages, block and shard."""
    x = pages.join(counts.select("doc_id", F.col("num_pages").cast("int").alias("num_pages")), "doc_id", "inner")
    x = x.where("page_no IS NOT NULL AND num_pages IS NOT NULL").withColumn(
        "block", F.floor((F.col("page_no") - 1) / block_pages).cast("int"))
    return x.withColumn("shard", shard(shards))


def offsets(pairs: np.ndarray) -> np.ndarray:
    """Where the bits of each pair start, and the end of the last."""
    return np.concatenate([[0], np.cumsum(pairs["width"], dtype=np.int64)])


def opened(pairs: bytes, bits: bytes) -> tuple[np.ndarray, np.ndarray]:
    table = np.frombuffer(bytes(pairs), PAIR)
    size = int(table["width"].sum(dtype=np.int64))
    return table, np.unpackbits(np.frombuffer(bytes(bits), np.uint8), count=size, bitorder="little").astype(bool)


def closed(pairs: np.ndarray, bits: np.ndarray) -> tuple[bytes, bytes]:
    return pairs.tobytes(), np.packbits(bits, bitorder="little").tobytes()


def placed(pairs: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pair and the place (from 0) in its block of every bit that is set."""
    start, on = offsets(pairs), np.flatnonzero(bits)
    of = np.searchsorted(start, on, side="right") - 1
    return of, on - start[of]


def kept(pairs: np.ndarray, bits: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that ``keep`` names, and their bits."""
    return pairs[keep], bits[np.repeat(keep, pairs["width"])]


def joined(old: np.ndarray, doc: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of the state and of the rows in one table, sorted: the table, the places of ``old`` and of each row in it."""
    docs, blocks = np.concatenate([old["doc"], doc]), np.concatenate([old["block"], block])
    order = np.lexsort((blocks, docs))
    first = np.ones(len(order), bool)
    first[1:] = (docs[order][1:] != docs[order][:-1]) | (blocks[order][1:] != blocks[order][:-1])
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(first) - 1
    table = np.zeros(int(first.sum()), PAIR)
    table["doc"], table["block"] = docs[order[first]], blocks[order[first]]
    table[at[:len(old)]] = old
    return table, at[:len(old)], at[len(old):]


def widened(old: np.ndarray, bits: np.ndarray, table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``bits`` of ``old`` laid out for ``table``, whose widths may have grown; ``at`` are the places of ``old`` in it."""
    start = offsets(table)
    out = np.zeros(int(start[-1]), bool)
    of, place = placed(old, bits)
    out[start[at[of]] + place] = True
    return out


def counted(bits: np.ndarray) -> np.ndarray:
    """Running count of the bits, one entry more than there are bits."""
    return np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
