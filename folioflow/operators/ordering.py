"""Order-inside-a-document primitives that stay balanced when one document is huge.

A plain ``Window.partitionBy(doc_id)`` sends every row of a document to one
task.  If one scan holds a third of all pages that task holds a third of the
data.  The two primitives below split such documents:

* :func:`ordinal_within` (W5) numbers rows inside blocks of the first order
  column, so a hot document is spread over many tasks, and adds per-block
  offsets from a small count table.
* :func:`neighbours_within` (W1) finds the previous and next row inside
  fixed-size blocks of a numeric order column, then patches block edges from
  a per-block summary that is ``block_size`` times smaller than the input.

Both are exact: no row is dropped, capped or sampled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def ordinal_within(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                   name: str = "ordinal", block: Column | None = None, block_size: int = 4096,
                   hot_rows: int = 1_000_000) -> DataFrame:
    """1-based ``row_number()`` over ``partition by key order by order`` without a hot task.

    Rows are numbered inside blocks (a window over ``(key, block)``); block
    offsets come from a per-block count table (one row per key and block but the
    key's first, which has no offset; without such rows no row is sorted for the join).
    ``block`` is any expression that never falls while the first order column
    rises; the default is ``div block_size`` for an integer column and the
    column itself otherwise.  Give a prefix (``substring``) for strings with
    many distinct values.

    A key of more than ``hot_rows`` rows is cut finer, by the values of its first
    two order columns, since the first one may have few.  Such keys come from one
    count of the rows and are broadcast; there are at most rows / ``hot_rows`` of them.
    Nothing is sampled and no Spark job runs while the plan is built.  Null
    keys, blocks and order values are kept (nulls come first).
    """
    keys, names = _names(key), df.columns
    if block is None:
        whole = dict(df.dtypes)[order[0]] in ("int", "bigint", "smallint", "tinyint")
        block = F.floor(F.col(order[0]) / F.lit(block_size)).cast("long") if whole else F.col(order[0])
        if len(order) > 1:
            # a coarse block on its own, or for a hot key the values themselves (never both for one key)
            hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select(
                *[F.col(k).alias(f"_ff_h{i}") for i, k in enumerate(keys)], F.lit(True).alias("_ff_hot"))
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_ff_h{i}")) for i, k in enumerate(keys)])
            df = df.join(F.broadcast(hot), same, "left").select(*df.columns, F.coalesce("_ff_hot", F.lit(False)).alias("_ff_hot"))
            fine = F.struct(F.col(order[0]).alias("a"), F.col(order[1]).alias("b"))
            block = F.struct(F.when(~F.col("_ff_hot"), block).alias("coarse"), F.when(F.col("_ff_hot"), fine).alias("fine"))
    x = df.withColumn("_ff_blk", block)
    x = x.withColumn("_ff_local", F.row_number().over(Window.partitionBy(*keys, "_ff_blk").orderBy(*order)))
    counts = x.groupBy(*keys, "_ff_blk").agg(F.count(F.lit(1)).alias("_ff_n"))
    before = Window.partitionBy(*keys).orderBy("_ff_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"_ff_k{i}") for i, k in enumerate([*keys, "_ff_blk"])],
                            F.sum("_ff_n").over(before).alias("_ff_base")).where("_ff_base > 0")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_ff_k{i}")) for i, k in enumerate([*keys, "_ff_blk"])])
    out = x.join(offsets, same, "left")
    return out.select(*names, (F.col("_ff_local") + F.coalesce("_ff_base", F.lit(0))).cast("int").alias(name))


def neighbours_within(df: DataFrame, key: str | Sequence[str], order_col: str,
                      carry: Sequence[str] = (), block_size: int = 4096) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` for ``order_col`` and every ``carry`` column.

    Neighbours are the adjacent rows of the same ``key`` in ``order_col``
    order (null at both ends), as ``lag``/``lead`` would give.  ``order_col``
    must be an integer column that is unique inside a key (a page number).
    Work is partitioned by ``(key, order_col div block_size)``; only the
    block-edge rows need the small per-block summary.
    """
    keys = _names(key)
    cols = [order_col, *[c for c in carry if c != order_col]]
    blk = F.floor(F.col(order_col) / F.lit(block_size)).cast("long")
    x = df.withColumn("_ff_blk", blk)
    w = Window.partitionBy(*keys, "_ff_blk").orderBy(order_col)
    x = x.withColumn("_ff_lag", F.lag(F.struct(*cols)).over(w)) \
         .withColumn("_ff_lead", F.lead(F.struct(*cols)).over(w))
    edges = (x.groupBy(*keys, "_ff_blk")
               .agg(F.min_by(F.struct(*cols), F.col(order_col)).alias("_ff_head"),
                    F.max_by(F.struct(*cols), F.col(order_col)).alias("_ff_tail")))
    wb = Window.partitionBy(*keys).orderBy("_ff_blk")
    edges = edges.select(*keys, "_ff_blk",
                         F.lag("_ff_tail").over(wb).alias("_ff_prev_tail"),
                         F.lead("_ff_head").over(wb).alias("_ff_next_head"))
    x = x.join(edges, on=[*keys, "_ff_blk"], how="inner")
    prev = F.coalesce(F.col("_ff_lag"), F.col("_ff_prev_tail"))
    nxt = F.coalesce(F.col("_ff_lead"), F.col("_ff_next_head"))
    for c in cols:
        x = x.withColumn(f"prev_{c}", prev[c]).withColumn(f"next_{c}", nxt[c])
    return x.drop("_ff_blk", "_ff_lag", "_ff_lead", "_ff_prev_tail", "_ff_next_head")


def adjacent_flag(page: str = "page_no", prev: str = "prev_page_no", nxt: str = "next_page_no") -> Column:
    """True when the next item is on page+1 or the previous on page-1 (nulls count as no)."""
    return F.coalesce(F.col(nxt) == F.col(page) + 1, F.lit(False)) | \
        F.coalesce(F.col(prev) == F.col(page) - 1, F.lit(False))


def first_flag(prev: str = "prev_page_no") -> Column:
    """The first item of its document has no previous item."""
    return F.col(prev).isNull()
