"""Joins that need a decision beyond a plain equi join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .filters import needs_search_file

def with_context(records: DataFrame, ctx: DataFrame, on: str = "run_id") -> DataFrame:
    """Attach run settings to each record; records of a run without ``upload_dir`` are dropped.

    Adds ``upload_dir``, ``pkged`` and ``have_sphinx`` (F4).  The settings
    table holds one row per run; the optimiser broadcasts it while it is small.
    """
    c = ctx.where(F.col("upload_dir").isNotNull()).select(
        on, "upload_dir", "pkged", needs_search_file("use_sphinx", "sphinx_db").alias("have_sphinx"))
    return records.join(c, on, "inner")


def text_to_search_file(texts: DataFrame, slots: DataFrame) -> DataFrame:
    """Page text meets its search-file slot (inner equi join on doc_id, page_no)."""
    return texts.join(slots, ["doc_id", "page_no"], "inner")


def next_records(queue: DataFrame, n: int = 1, group: str | None = None,
                 order: Sequence[str] = ("priority_id", "queue_id")) -> DataFrame:
    """O2: the next ``n`` records in processing order, overall or per ``group``.

    ``n = 1`` per group is a grouped ``min_by`` (partial aggregation, no
    window); larger ``n`` uses ``row_number`` per group; no group is a
    top-``n`` (``TakeOrderedAndProject``).
    """
    key = F.struct(*[F.col(c) for c in order])
    if group is None:
        return queue.orderBy(*order).limit(n)
    if n == 1:
        cols = [c for c in queue.columns if c != group]
        best = queue.groupBy(group).agg(F.min_by(F.struct(*cols), key).alias("_r"))
        return best.select(group, "_r.*")
    w = Window.partitionBy(group).orderBy(*order)
    return queue.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def first_match(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """O3: the first row per key under an explicit order (grouped ``min_by``)."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*[F.col(c) for c in order])).alias("_r"))
    return best.select(*keys, "_r.*")


def all_outputs(*parts: DataFrame) -> DataFrame:
    """Outputs of every road in one result set (UNION ALL by name)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Files left out of a published package.
EXCLUDED_KINDS = ["temp", "state"]


def without_excluded(listing: DataFrame, excluded: Sequence[str] = tuple(EXCLUDED_KINDS),
                     col: str = "kind") -> DataFrame:
    """U4: listing minus excluded entries (used by the package writer K1)."""
    return listing.where(~F.col(col).isin(*excluded))
