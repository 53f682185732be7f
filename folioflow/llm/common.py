"""Shared helpers: Arrow text slices, byte-level word splitting, hashing, written tables, components.

The array helpers work on whole slices of a batch (about ``SLICE_BYTES`` of
text, or one longer document), never on a whole partition, so the memory of a
Python worker is bounded by the slice and the longest single document.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.session import ship_package

SLICE_BYTES = 2 << 20
U64 = np.uint64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (shared storage on a cluster)."""
    from folioflow.session import shared_path
    ship_package(spark)
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


#: Spark drops the shuffle files of a query at its end; a table that is written has no more use for them
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


BROADCAST, MEASURED_BROADCAST = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
#: bytes up to which a side of a join that Spark has not measured yet may be sent through the driver
GUESSED = 256 << 10


def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)\s*([bkmgtp]?)[ib]*", setting.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


@contextmanager
def measured_broadcasts(spark: SparkSession):
    """Joins that run inside broadcast a side by its measured size, not by the size of the file it comes from.

    The written tables are columns of numbers in few distinct values, many times
    as large in memory as on disk, and rows may be multiplied before a join.  So
    only small guesses count; sides that were shuffled keep the session's
    threshold, and hints stay.
    """
    before = {k: spark.conf.get(k, None) for k in (BROADCAST, MEASURED_BROADCAST)}
    usual = spark.conf.get(BROADCAST)
    if before[MEASURED_BROADCAST] is None:
        spark.conf.set(MEASURED_BROADCAST, usual)
    spark.conf.set(BROADCAST, str(min(_bytes(usual), GUESSED)))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts the lineage).

    The shuffle files of the write go when it has ended, so a job of many steps
    holds those of one step at a time.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        with measured_broadcasts(spark):
            df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


# ---- Arrow text -> byte slices -------------------------------------------------------------

def byte_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, end row, bytes, offsets)``; null texts count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_large_string(col.type):
        col = col.cast(pa.string())
    n = len(col)
    if not n:
        return
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


#: word separators: space and \t \n \v \f \r
SPACES = byte_class(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def split_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions ``(starts, ends)`` of all words; a word never crosses a document."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sep = separators[data]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = sep[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    first[inner] = True
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = sep[1:]
    last[inner - 1] = True
    word = ~sep
    return np.flatnonzero(word & first), np.flatnonzero(word & last) + 1


# ---- hashing -------------------------------------------------------------------------------

#: fixed odd multipliers of the polynomial hash and of the bit mixer
POLY = 0x9E3779B97F4A7C15 | 5
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``POLY**i`` and its inverse modulo 2**64 for ``i < n`` (kept between calls)."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        up, down = np.full(size, POLY, U64), np.full(size, pow(POLY, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(up, out=up)
            np.multiply.accumulate(down, out=down)
        _POWERS["up"], _POWERS["down"] = up, down
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: ``out[j] - out[i]`` identifies ``data[i:j]`` up to a shift."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(U64) + U64(1)) * up[:len(data)], out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(MIX_1)
        x = (x ^ (x >> U64(27))) * U64(MIX_2)
        return x ^ (x >> U64(31))


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range, equal for equal bytes wherever they stand."""
    _, down = powers(len(prefix))
    with np.errstate(over="ignore"):
        return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(U64))


#: longer strings are hashed by a digest: a polynomial modulo a power of two has equal values for some strings of 1,024 bytes
LONG_STRING = 64


def string_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of words or pieces, safe to stand for their bytes at any length (long ones by BLAKE2b)."""
    out = range_hash(prefix_hash(data), starts, ends)
    long = np.flatnonzero(ends - starts > LONG_STRING)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data))
        out[long] = np.frombuffer(b"".join(hashlib.blake2b(raw[a:b], digest_size=8).digest()
                                           for a, b in zip(starts[long].tolist(), ends[long].tolist())), "<u8")
    return out


def hash_bytes(x: bytes) -> int:
    """``range_hash`` of one whole byte string."""
    data = np.frombuffer(x, np.uint8)
    return int(range_hash(prefix_hash(data), np.array([0]), np.array([len(data)]))[0])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# ---- connected components ------------------------------------------------------------------

def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(id, component_id)`` for the ids of ``edges(a, b)``: the smallest id reachable.

    Alternates large-star and small-star steps; each step is a grouped minimum
    and one equi join, its edge list is written to the shared folder.  Rounds
    grow with the logarithm of the longest chain.  Nothing but two counters
    reaches the driver.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cur = written(both, name)
    while True:
        # large star: every larger neighbour of a node is tied to the node's smallest neighbour
        sym = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = sym.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours are tied to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        nxt = written(small, name)
        # a star forest: every node has one smaller neighbour, which has none itself
        again = nxt.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("a").alias("x"))
        chained = nxt.join(nxt.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select(F.col("a").alias("x"))
        cur = nxt
        with measured_broadcasts(nxt.sparkSession):
            if again.union(chained).isEmpty():
                break
    return cur.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(
        cur.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())


def row_key(docs: DataFrame) -> Column:
    """What tells the rows of a table of documents apart: ``doc_id`` and a hash of the text."""
    return F.struct(docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("h"))


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint for a written table of at most ``max_rows`` narrow rows, else the table as it is."""
    return F.broadcast(df) if df.count() <= max_rows else df


#: parts that the rows of one component are dealt to in a join
SPREAD = 16


def by_component(df: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """``df(id, comp, ...)`` joined with ``facts`` (a row per ``comp``), the rows of one component over ``SPREAD`` tasks.

    A component may hold a third of all rows; its one row of facts is copied for each part.  The copies are never broadcast:
    Spark takes them for as few as the facts.
    """
    salt = F.pmod(F.xxhash64("id"), F.lit(SPREAD)).cast("int").alias("_salt")
    copies = facts.select("*", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_salt"))
    return df.select("*", salt).join(copies.hint("merge"), ["comp", "_salt"], how).drop("_salt")


# ---- groups of similar rows from candidate buckets -----------------------------------------

def linked_groups(buckets: DataFrame, key: list[str], carry: list[str], may, first_table, confirm, *,
                  extra: DataFrame | None = None, bound=None, fits=None, name: str = "groups", rounds: int = 2,
                  small: int = 8, parts: int = 1) -> DataFrame:
    """``id, component_id`` of all ids that a confirmed link joins with another one.

    ``buckets`` has a row per id and bucket: ``key`` columns, ``tab`` (number of
    the bucket's table), ``id``, ``size`` (rows of the bucket) and ``carry``
    columns.  All pairs within a bucket are candidates, but few are compared:

    * the members of a bucket with its most central member (the one that shares
      the most bucket rows), then, in ``rounds``, members of other components
      with some member of the bucket's largest component, another one each time;
    * at the end all pairs that are still in different components and were not
      compared, each pair in its first common bucket.  No pair is left out.

    ``may(x, y)`` and ``first_table(x, y)`` are conditions on two rows, given as
    functions from a column name to a column; ``confirm(pairs)`` returns the
    pairs ``a, b`` that are links.  ``extra`` has more columns by ``id`` for
    ``first_table``; without ``first_table`` a pair is listed in each common
    bucket, which is cheaper than wide rows where pairs share few, and then once.  ``bound(members)`` may return, for ``members(id, family)``
    of the larger buckets (families are connected by buckets), a column ``s`` by
    ``id`` and pairs ``a, b``: of the pairs in larger buckets only those with
    ``fits(x, y)`` on ``s``, and the returned ones, can then be links.  The pairs
    left at the end are listed in ``parts``, by bucket, one after another, so
    the shuffles of one part lie on disk at a time.
    """
    mine, other = (lambda c: F.col(c)), (lambda c: F.col("p_" + c))
    named = lambda df: df.select(*key, *[F.col(c).alias("p_" + c) for c in df.columns if c not in key])
    ordered = [F.greatest("id", "p_id").alias("a"), F.least("id", "p_id").alias("b")]

    central = buckets.groupBy("id").agg(F.sum("size").alias("c"))
    best = buckets.join(central, "id").groupBy(*key).agg(F.max(F.struct("c", "id", *carry)).alias("m"))
    centers = best.select(*key, *[F.col(f"m.{c}").alias("p_" + c) for c in ("id", *carry)])
    tested = written(buckets.join(centers, key).where((F.col("id") != F.col("p_id")) & may(mine, other)).select(
        *ordered).distinct(), f"{name}_pairs")
    state = buckets.where("size > 2").withColumn("comp", F.col("id"))
    whole = buckets.select("id").distinct().withColumn("comp", F.col("id"))

    def merged(links: DataFrame, of: DataFrame) -> DataFrame:
        """Components of the components: ``comp, component_id``."""
        low = of.select(F.col("id").alias("a"), F.col("comp").alias("ca"))
        high = of.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
        edges = links.join(low, "a").join(high, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        return components(edges, f"{name}_components").withColumnRenamed("id", "comp")

    def moved(df: DataFrame, to: DataFrame) -> DataFrame:
        return by_component(df, to, "left").withColumn("comp", F.coalesce("component_id", "comp")).drop("component_id")

    def still_open(df: DataFrame) -> DataFrame:
        keys = df.groupBy(*key).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select(*key)
        return df.join(keys, key, "left_semi")

    links = written(confirm(tested), f"{name}_links")
    to = merged(links, whole)
    whole = written(moved(whole, to), f"{name}_members")
    state = written(still_open(moved(state, to)), f"{name}_state")
    for k in range(rounds):
        sizes = whole.groupBy("comp").agg(F.count(F.lit(1)).alias("_of"))
        ranked = by_component(state.where(F.col("size") > small), sizes)
        partner = ranked.groupBy(*key).agg(F.max(F.struct(
            "_of", F.xxhash64("id", *key, F.lit(k)).alias("_turn"), "id", "comp", *carry)).alias("m"))
        partner = partner.select(*key, *[F.col(f"m.{c}").alias("p_" + c) for c in ("id", "comp", *carry)])
        pairs = written(state.join(partner, key).where((F.col("comp") != F.col("p_comp")) & may(mine, other)).select(
            *ordered).distinct().join(tested, ["a", "b"], "left_anti"), f"{name}_pairs")
        if pairs.isEmpty():
            break
        tested = tested.union(pairs)
        links = written(confirm(pairs), f"{name}_links")
        if links.isEmpty():
            continue
        to = merged(links, whole)
        whole = written(moved(whole, to), f"{name}_members")
        state = written(still_open(moved(state, to)), f"{name}_state")
    rest = state.join(extra, "id") if extra is not None else state
    able = F.lit(True)
    if bound is not None:
        large = state.where(F.col("size") > small)
        low = large.groupBy(*key).agg(F.min("id").alias("b"))
        family = components(large.join(low, key).select(F.col("id").alias("a"), "b"), f"{name}_families")
        most, near = bound(family.withColumnRenamed("component_id", "family"))
        rest = rest.join(written(most, f"{name}_bounds"), "id", "left")
        able = (F.col("size") <= small) | fits(mine, other)

    def left_over(rest: DataFrame) -> DataFrame:
        found = rest.join(named(rest), key).where(
            (F.col("id") > F.col("p_id")) & (F.col("comp") != F.col("p_comp")) & may(mine, other) & able)
        if first_table is None:
            return found.select(*ordered).distinct()
        return found.where(F.col("tab") == first_table(mine, other)).select(*ordered)

    part = F.pmod(F.xxhash64(*key), F.lit(parts))
    pairs = left_over(rest) if parts == 1 else reduce(DataFrame.union, [
        written(left_over(rest.where(part == k)).join(tested, ["a", "b"], "left_anti"), f"{name}_rest") for k in range(parts)])
    if bound is not None:
        of = whole.select("id", "comp")
        apart = near.join(of.select(F.col("id").alias("a"), F.col("comp").alias("ca")), "a").join(
            of.select(F.col("id").alias("b"), F.col("comp").alias("cb")), "b").where("ca <> cb").select("a", "b")
        pairs = pairs.union(apart).distinct()
    if parts > 1 and first_table is None:
        pairs = written(pairs.distinct(), f"{name}_rest")
    if parts == 1 or bound is not None:
        pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), f"{name}_rest")
    if not pairs.isEmpty():
        whole = moved(whole, merged(written(confirm(pairs), f"{name}_links"), whole))
    linked = whole.groupBy("comp").agg(F.count(F.lit(1)).alias("_of")).where("_of > 1").select("comp")
    return by_component(whole, linked).select("id", F.col("comp").alias("component_id"))


# ---- places in a global order --------------------------------------------------------------

def numbered(df: DataFrame, part: str, order: list[str], name: str) -> DataFrame:
    """The rows of ``df`` (a written table) with ``idx`` (place in their part, from 0) and ``n`` (rows of the part).

    Rows are dealt by ranges of part, order and, so that equal rows spread too,
    their place in the table.  A sorted partition numbers its own rows; the rows
    of each part before it come from one count per partition and part.
    """
    shards = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [part, *order, "_at"]
    placed = written(df.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(shards, *keys)
                     .sortWithinPartitions(*keys).drop("_at").withColumn("_m", F.monotonically_increasing_id()), name)
    shard = F.shiftright("_m", 33).alias("_shard")
    counts = written(placed.groupBy(shard, part).agg(F.min("_m").alias("_lo"), F.count(F.lit(1)).alias("_c")), f"{name}_counts")
    before = Window.partitionBy(part).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_shard", part, "_lo", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"),
                          F.sum("_c").over(Window.partitionBy(part)).alias("n"))
    return placed.withColumn("_shard", F.shiftright("_m", 33)).join(bases, ["_shard", part]).withColumn(
        "idx", F.col("_base") + F.col("_m") - F.col("_lo")).drop("_shard", "_m", "_lo", "_base")
