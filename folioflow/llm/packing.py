"""Best-fit packing of token sequences, planned on the length histogram.

1. Every document becomes pieces of at most ``capacity`` tokens (only longer
   documents are cut).
2. The histogram of piece lengths (at most ``capacity`` rows) goes to the
   driver, where best-fit decreasing runs over *counts*: all bins with the same
   free space are kept as runs of consecutive bin numbers, so the plan has a
   few thousand runs however many documents there are.
3. Pieces get their rank among the pieces of equal length (block counts plus a
   rank inside small blocks, so a length that holds a third of all pieces is
   still split over tasks) and join the plan on length and rank.

Defined cases: a null or empty text has only the end id; an empty table packs
into no sequence; repeated rows are packed once each; a null doc_id is kept.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, written
from .tokens import encoded_texts, encoder

CAPACITY = 2048
#: a plan of more runs than this is joined with a shuffle instead of a broadcast
MAX_BROADCAST_RUNS = 200_000


def pieces(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = 0, tokenizer: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids_crc32`` (and ``ids`` if asked) of every document."""
    key_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key_type}, piece int, start long, length long, ids_crc32 long" + (
        ", ids array<int>" if with_ids else "")

    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            for first, ids, bounds in encoded_texts(enc, batch.column(1), end_id):
                n = np.diff(bounds)
                per_doc = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), per_doc)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
                start = piece * capacity
                length = np.minimum(capacity, n[row] - start)
                at = bounds[row] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                cols = [batch.column(0).take(pa.array(first + row)), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)), pa.int32()),
                                                         pa.array(ids.view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs ``(length, rank_from, rank_to, first_sequence, offset)``.

    The pieces of one length with ranks ``rank_from <= r < rank_to`` go to the
    sequences ``first_sequence + r - rank_from`` at ``offset``.
    """
    free: dict[int, list[tuple[int, int]]] = {}      # free space -> runs of sequences [from, to)
    sizes: list[int] = []                            # free spaces present, ascending
    runs, used = [], 0

    def give(space: int, lo: int, hi: int) -> None:
        if space > 0 and hi > lo:
            if space not in free:
                free[space] = []
                insort(sizes, space)
            free[space].append((lo, hi))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):                      # the tightest open sequences
                space = sizes[at]
                lo, hi = free[space].pop()
                if not free[space]:
                    del free[space]
                    sizes.pop(at)
                n = min(left, hi - lo)
                give(space, lo + n, hi)
            else:                                    # new sequences, each filled with equal pieces
                space, lo, n = capacity, used, -(-left // (capacity // length))
                n = min(n, left)
                used += n
            runs.append((length, rank, rank + n, lo, capacity - space))
            give(space - length, lo, lo + n)
            rank, left = rank + n, left - n
    return runs


def pack(parts: DataFrame, *, capacity: int = CAPACITY, rank_blocks: int | None = None) -> DataFrame:
    """``parts`` (``doc_id, piece, length, ...``) with ``sequence_id`` and ``offset``."""
    spark = parts.sparkSession
    blocks = rank_blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a row's place in the written table ranks it, so rows of one doc_id spread like any others
    parts = written(parts.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int")), "pieces")
    counts = written(parts.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("_n")), "piece_counts")
    # at most `capacity` rows reach the driver
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = plan(histogram, capacity)
    slots = spark.createDataFrame(
        runs, "length long, _from long, _to long, _first long, offset long") if runs else spark.createDataFrame(
        [], "length long, _from long, _to long, _first long, offset long")
    if len(runs) <= MAX_BROADCAST_RUNS:
        slots = F.broadcast(slots)
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_block").orderBy("_row")
    ranked = parts.withColumn("_in", F.row_number().over(inside) - 1).join(base, ["length", "_block"]).withColumn(
        "_rank", F.col("_base") + F.col("_in"))
    return ranked.join(slots, (ranked["length"] == slots["length"]) & (ranked["_rank"] >= slots["_from"])
                       & (ranked["_rank"] < slots["_to"])).select(
        *[ranked[c] for c in parts.columns if c not in ("_block", "_row")],
        (F.col("_first") + F.col("_rank") - F.col("_from")).alias("sequence_id"), slots["offset"])


def best_fit_packing(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = 0, tokenizer: str | None = None,
                     with_ids: bool = False) -> DataFrame:
    """Pack whole documents; ``with_ids`` also returns each piece's token ids."""
    return pack(pieces(docs, capacity=capacity, end_id=end_id, tokenizer=tokenizer, with_ids=with_ids),
                capacity=capacity)
