"""MinHash near-duplicate groups with tensored banding.

1. ``signatures``: each text's set of word shingles, and two small collections
   of ``half_keys`` hash values, each formed from ``rows`` MinHash values.  A
   table key is a pair of one value from either collection, so
   ``half_keys ** 2`` tables need only ``2 * half_keys * rows`` MinHash values.
2. Texts with equal sets form one class; only class representatives go on.
3. Representatives that share a table key are candidates.  ``linked_groups``
   compares them with central members first, so a group of copies costs about as
   many comparisons as members, and skips only pairs that are connected already.
4. Every candidate pair is confirmed on the full sets; components follow from
   the confirmed pairs.

Recall of a pair at Jaccard similarity s is ``(1 - (1 - s**rows)**half_keys)**2``:
0.9999 at 0.8 with the defaults.  Candidate search has no cap of any kind.

Defined cases: a null text or one without words has an empty set and is linked
with nothing; a text of fewer than ``words`` words has its whole sequence as its
one shingle; repeated rows with one ``doc_id`` are one document (each row is
returned); a null ``doc_id`` is linked with nothing and has a null component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (LOWER, SPACES, byte_slices, linked_groups, map_arrow, mix, row_key, signed, split_words, string_hash, written)

WORDS = 5
PERCENT = 80
HALF_KEYS, ROWS = 10, 2
#: a shingle of so few members of a family, or fewer, is rare (only the amount of work depends on it)
RARE = 8

_FOLD = np.uint64(0x9DDFEA08EB382D69)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ordered within each text, and the bounds of each text."""
    low = LOWER[data]
    starts, ends = split_words(low, offsets, SPACES)
    word = string_hash(low, starts, ends)
    bounds = np.searchsorted(starts, offsets)
    n_words = np.diff(bounds)
    n = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + bounds[:-1][doc]
    take = np.minimum(words, n_words)[doc]
    padded = np.concatenate([word, np.zeros(words, np.uint64)])
    with np.errstate(over="ignore"):
        h = take.astype(np.uint64)
        for k in range(words):
            h = np.where(k < take, mix(h * _FOLD + padded[at + k]), h)
    order = np.argsort(h)
    # stable by text: radix sort on 16-bit numbers, a few texts only in a slice
    owner = doc[order]
    order = order[np.argsort(owner.astype(np.uint16) if len(n) < 1 << 16 else owner, kind="stable")]
    h, doc = h[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[first], doc[first]
    return h, np.searchsorted(doc, np.arange(len(n) + 1))


def signatures(docs: DataFrame, *, words: int = WORDS, half_keys: int = HALF_KEYS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n, h1, h2`` (set size and hash) and the half-key collections ``a`` and ``b``."""
    key = docs.schema["doc_id"].dataType.simpleString()
    n_hash = 2 * half_keys * rows

    def run(batches):
        with np.errstate(over="ignore"):
            odd = mix(np.arange(1, n_hash + 1, dtype=np.uint64) * _FOLD) | np.uint64(1)
        for batch in batches:
            for i, j, data, offsets in byte_slices(batch.column(1)):
                h, bounds = shingle_sets(data, offsets, words)
                n = np.diff(bounds)
                some = np.flatnonzero(n)
                cut = bounds[:-1][some]
                h1, h2 = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                half = np.zeros((j - i, 2 * half_keys), np.uint64)
                if len(some):
                    with np.errstate(over="ignore"):
                        h1[some] = np.add.reduceat(mix(h ^ _FOLD), cut)
                        h2[some] = np.add.reduceat(mix(h + _FOLD), cut)
                        for k in range(2 * half_keys):
                            v = np.full(len(some), k, np.uint64)
                            for r in range(rows):
                                low = np.minimum.reduceat(h * odd[k * rows + r], cut)
                                v = mix(v * _FOLD + low)
                            half[some, k] = v
                lists = lambda x: pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(signed(np.ascontiguousarray(x).ravel())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(signed(h1)), pa.array(signed(h2)),
                     lists(half[:, :half_keys]), lists(half[:, half_keys:])], ["doc_id", "n", "h1", "h2", "a", "b"])

    return map_arrow(docs.select("doc_id", "text"), run,
                     f"doc_id {key}, n long, h1 long, h2 long, a array<long>, b array<long>")


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id, n, items``: the shingle set of each wanted document as sorted 64-bit hashes."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in byte_slices(batch.column(1)):
                h, bounds = shingle_sets(data, offsets, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(
                        [h[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())], ["id", "items"])

    wanted = docs.select("doc_id", "text").join(ids, docs["doc_id"] == ids["id"], "left_semi")
    return map_arrow(wanted, run, f"id {key}, items binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs(a, b)`` whose sets reach the similarity."""
    key = pairs.schema["a"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            keep = []
            left, right = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(left[i].as_py(), np.uint64), np.frombuffer(right[i].as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = 0
                if len(x) and 100 * len(x) >= percent * len(y):
                    at = np.searchsorted(y, x)
                    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    return map_arrow(pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y"), run, f"a {key}, b {key}")


def _shared_sizes(sets: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bounds on what members of a family can share: ``id, s`` and pairs ``a, b``.

    A shingle that at most ``RARE`` members of a family have is rare.  Two
    members that share a rare shingle are returned as a pair; two others share
    at most ``s`` shingles, the number of shingles that are not rare.
    """
    key = members.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            items = batch.column(2).combine_chunks() if isinstance(batch.column(2), pa.ChunkedArray) else batch.column(2)
            n = pa.compute.binary_length(items).to_numpy(zero_copy_only=False).astype(np.int64) // 8
            for lo in range(0, len(n), 512):
                part = np.arange(lo, min(lo + 512, len(n)))
                row = np.repeat(part, n[part])
                x = np.frombuffer(b"".join(items[int(k)].as_py() for k in part), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(x)], ["id", "family", "x"])

    rows = written(map_arrow(members.join(sets, "id").select("id", "family", "items"), run,
                             f"id {key}, family {key}, x long"), "family_shingles")
    few = rows.groupBy("family", "x").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") <= RARE)
    rare = written(rows.join(few, ["family", "x"]), "rare_shingles")
    unshared = rare.groupBy("id").agg(F.count(F.lit(1)).alias("u"))
    size = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    most = size.join(unshared, "id", "left").select("id", (F.col("n") - F.coalesce("u", F.lit(0))).alias("s"))
    # at most RARE ids in a list
    owners = rare.where("c > 1").groupBy("family", "x").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    low = owners.select("ids", F.posexplode("ids").alias("k", "b"))
    pairs = low.select("b", F.explode(F.slice("ids", F.col("k") + 2, RARE)).alias("a")).select("a", "b").distinct()
    return most, pairs


def near_duplicates(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT, half_keys: int = HALF_KEYS,
                    rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    docs = docs.select("doc_id", "text")
    signed_docs = written(signatures(docs, words=words, half_keys=half_keys, rows=rows), "signatures")
    classes = written(
        signed_docs.where("n > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2", "n").agg(
            F.min("doc_id").alias("id"), F.first("a").alias("a"), F.first("b").alias("b")), "classes")

    # rows sharing a table key with another class
    keyed = classes.select("id", "n", F.posexplode("a").alias("i", "x"), "b").select(
        "id", "n", "i", "x", F.posexplode("b").alias("j", "y")).select(
        "id", "n", F.xxhash64("i", "x", "j", "y").alias("key"), (F.col("i") * half_keys + F.col("j")).alias("tab"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = written(keyed.join(shared, "key"), "buckets")

    members = buckets.select("id").distinct()
    sets = written(_sets(docs, members, words), "sets")

    def alike(x, y):
        return 100 * F.least(x("n"), y("n")) >= percent * F.greatest(x("n"), y("n"))

    def first_table(x, y):
        place = lambda c: F.array_position(F.zip_with(x(c), y(c), lambda p, q: p == q), True) - 1
        return place("a") * half_keys + place("b")

    def fits(x, y):
        most = F.least(x("s"), y("s"))
        return 100 * most >= percent * (x("n") + y("n") - most)

    comp = linked_groups(buckets, ["key"], ["n"], alike, first_table, lambda pairs: _confirmed(pairs, sets, percent),
                         extra=classes.select("id", "a", "b"), bound=lambda members: _shared_sizes(sets, members),
                         fits=fits, name="near")
    found = classes.join(comp, "id", "left").select(
        "h1", "h2", "n", F.coalesce("component_id", "id").alias("component_id"))
    return signed_docs.join(found, ["h1", "h2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(
            F.col("doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are the first of their group by ``doc_id``, and those without one.

    Rows are told apart by ``doc_id`` and text, so a row with a repeated
    ``doc_id`` goes only by its own text; rows equal in both stay or go together.
    """
    key = row_key(docs)
    rows = docs.where(docs["doc_id"].isNotNull()).select(key.alias("doc_id"), "text")
    gone = near_duplicates(rows, **options).where("NOT kept").select(
        F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, key == gone["_gone"], "left_anti")
