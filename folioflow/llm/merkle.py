"""Merkle manifest of a table: leaf hashes, one tree per part, a root over the parts, and proofs.

1. A row's leaf is the SHA-256 of its fields, each written as its UTF-8 length,
   ``:`` and its value, or ``-`` if null.
2. Leaves are numbered within their part (``common.numbered``).  Node ``k`` of a
   level covers the rows ``k * span`` to ``(k + 1) * span - 1``, and its digest
   stands on the first of them.
3. A tree is climbed a few levels at a time inside aligned blocks of at most
   ``BLOCK`` rows.  Runs never cross a block, so one window over ``(part, block)``
   serves all these levels: lag and lead columns with the fixed offsets
   ``j * span``, masked by the slot in the run and the length of the run, give
   the siblings, and the first row of a run hashes its parent.
4. The first rows of the blocks are the rows of the next climb; the last climb
   is over the subroots.  A row's proof is the proof inside its block followed
   by that of the block's own row, joined on ``(part, block)``, the key by which
   the rows are dealt out already.

No task holds more than a block of a part.  Only the numbers of rows of the
largest part reach the driver, one for each climb.

Defined cases: a null part is a part of its own, before all others; parts are
ordered by their UTF-8 bytes; a part of one leaf is its own subroot, a table of
one part has the subroot as its root; rows of one key are ordered by their leaf,
equal rows are leaves of their own with a proof each; a null key comes first in
its part; an empty table has no rows; columns that are no fields are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, written

ARITY = 2
#: rows of a part in one window, at most
BLOCK = 1024
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "array<struct<before:string,after:string>>"


def digest(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs, concatenated."""
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return digest(*[field(v) for v in values])


def _climb(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """``part, block, idx, n`` and the other columns of ``nodes``, with ``path`` (steps inside the block) and ``top``.

    ``top`` is the digest of the block's highest node on the block's first row.
    """
    span_of_block = arity ** levels
    df = nodes.withColumn("block", F.expr(f"idx div {span_of_block}")).withColumn("top", F.col("digest"))
    rows = Window.partitionBy("part", "block").orderBy("idx")
    for level in range(levels):
        span = arity ** level
        count = F.expr(f"(n + {span - 1}) div {span}")
        slot = F.expr(f"idx div {span} % {arity}")
        run = F.least(F.lit(arity).cast("long"), count - (F.expr(f"idx div {span}") - slot))
        before = [F.when(slot >= j, F.lag("top", j * span).over(rows)).otherwise("") for j in range(arity - 1, 0, -1)]
        after = [F.when(slot + j < run, F.lead("top", j * span).over(rows)).otherwise("") for j in range(1, arity)]
        # nodes stand on the first of their rows; levels above a part's only node are no steps
        here, more = F.col("idx") % span == 0, count > 1
        df = df.withColumns({f"b{level}": F.when(here, F.when(more, F.concat(*before))),
                             f"a{level}": F.when(here, F.when(more, F.concat(*after)))})
        df = df.withColumn("top", F.when(here & more & (slot == 0), digest(F.col("top"), F.col(f"a{level}"))).otherwise(
            F.when(here, F.col("top"))))
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = [F.struct(F.last(f"b{k}", ignorenulls=True).over(so_far).alias("before"),
                     F.last(f"a{k}", ignorenulls=True).over(so_far).alias("after")) for k in range(levels)]
    df = df.withColumn("path", F.array(*held))
    return df.withColumn("path", F.filter("path", lambda s: s["before"].isNotNull())).drop(
        *[f"{side}{k}" for k in range(levels) for side in "ab"])


def _proved(nodes: DataFrame, arity: int, block: int, name: str, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``nodes(part, idx, n, digest, ...)`` with ``path`` up to the top of their part, then as ``finish`` goes on.

    ``finish(tops)`` takes the top nodes ``part, digest`` of all parts and returns
    ``part, more`` (steps that follow) and ``root``; both end up on every node.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = 1
    while arity ** (levels + 1) <= block and arity ** levels < most:
        levels += 1
    inside = _climb(nodes, arity, levels)
    if most <= arity ** levels:
        tops = written(inside.where("idx = 0").select("part", F.col("top").alias("digest")), f"{name}_tops")
        ends = finish(tops)
        return inside.drop("top", "block").join(ends, "part").withColumn("path", F.concat("path", "more")).drop("more")
    size = arity ** levels
    upper = written(inside.where(f"idx % {size} = 0").select(
        "part", F.col("block").alias("idx"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("digest")), f"{name}_nodes")
    above = written(_proved(upper, arity, block, name, finish).select(
        "part", F.col("idx").alias("block"), F.col("path").alias("above"), "root"), f"{name}_paths")
    return inside.drop("top").join(above, ["part", "block"]).withColumn("path", F.concat("path", "above")).drop("above", "block")


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda acc, s: digest(s["before"], acc, s["after"]))


def proof_digest(path: str = "path") -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def manifest(docs: DataFrame, *, part: str = "lang", key: str = "doc_id", fields: tuple[str, ...] = FIELDS, arity: int = ARITY,
             block: int = BLOCK, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``key, part, idx, leaf, path, subroot, root``.

    ``path`` lists the siblings of each level as ``before`` and ``after``; the
    digest of ``before``, the node and ``after`` is the parent.  ``carry`` adds
    columns computed from the row.
    """
    extra = carry or {}
    leaves = written(docs.select(
        F.col(key).alias("key"), F.coalesce(F.concat(F.lit("1"), F.col(part).cast("string")), F.lit("0")).alias("part"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"), *[v.alias(f"x_{k}") for k, v in extra.items()]), "leaves")
    nodes = numbered(leaves, "part", ["key", "digest"], "leaves_in_order").withColumn("leaf", F.col("digest"))

    def parts_joined(tops: DataFrame) -> DataFrame:
        named = tops.select(F.lit("").alias("part"), F.col("part").alias("of"), "digest", F.col("digest").alias("subroot"))
        over = numbered(written(named, "subroots"), "part", ["of"], "subroots_in_order")

        def closed(root: DataFrame) -> DataFrame:
            return root.select("part", F.array().cast(_STEP).alias("more"), F.struct(
                F.col("digest").alias("root")).alias("root"))

        top = _proved(over, arity, block, "subroot", closed)
        return written(top.select(F.col("of").alias("part"), F.col("path").alias("more"), F.struct(
            "subroot", F.col("root.root").alias("root")).alias("root")), "parts")

    rows = _proved(nodes, arity, block, "leaf", parts_joined)
    return rows.select(F.col("key").alias(key), F.when(F.col("part") != "0", F.substring("part", 2, 1 << 30)).alias("part"), "idx",
                       "leaf", "path", F.col("root.subroot").alias("subroot"), F.col("root.root").alias("root"),
                       *[F.col(f"x_{k}").alias(k) for k in extra])
