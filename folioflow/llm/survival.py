"""Filter interaction audit: survival words of all filter subsets and their positional popcounts.

1. Every document gets the set of filters that it fails as a bit mask, in one
   projection.  The filter on repeated texts compares the document with the
   smallest key of its text digest, joined on digest and key, so a text that many
   documents share is no hot key.
2. The mask becomes a truth table: bit ``S`` of the survival word is set if the
   document survives the subset ``S`` of the filters, that is, fails none of it.
   Five filters make a word of 32 bits.
3. Words are counted by bit position for each part and label class.  Each batch
   goes through carry-save adders: three words of weight ``w`` make a sum word
   of weight ``w`` and a carry word of weight ``2 w``, until few words are left
   whose bits are counted one by one.  The partial counts are summed in Spark.
4. Any order of filters is a chain of subsets, so all figures of all orders
   follow from the 32 counts of a part and class.

Defined cases: a null text is empty; a null part is the empty string; a document
without labels, or with null labels, is of no label class; with several label
rows it is of a class that any of them names; a null key is no larger than any
other, so such a row never fails the repetition filter, and other rows are not
compared with it; rows of one key are not repetitions of each other, each counts;
an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, written

SPACE = "[ \\t\\n\\x0B\\f\\r]+"
#: the last filter of ``FILTERS``: a text that a smaller key has, too
REPEATED = "E"
FILTERS = "ABCDE"
CLASSES = ("all", "good", "toxic")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that a text decides alone."""
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", part: str = "lang", text: str = "text") -> DataFrame:
    """``part, good, toxic, failed`` of every row of ``docs``; bit ``i`` of ``failed`` stands for filter ``i``."""
    body = F.coalesce(F.col(text), F.lit(""))
    bits = [F.when(cond, 1 << FILTERS.index(name)).otherwise(0) for name, cond in text_filters(body).items()]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    narrow = written(docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"), mask.alias("mask")), "filter_masks")
    known, anonymous = narrow.where("key IS NOT NULL"), narrow.where("key IS NULL")
    first = known.groupBy("digest").agg(F.min("key").alias("key")).withColumn("first", F.lit(True))
    classes = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    repeated = F.when(F.col("first"), 0).otherwise(1 << FILTERS.index(REPEATED))
    no = F.lit(False)
    return known.join(first, ["digest", "key"], "left").join(classes, "key", "left").select(
        "part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"),
        F.col("mask").bitwiseOR(repeated).alias("failed")).union(
        anonymous.select("part", no.alias("good"), no.alias("toxic"), F.col("mask").alias("failed")))


def survival_word(failed: Column, n: int = len(FILTERS)) -> Column:
    """The truth table over subsets: bit ``S`` is set if ``S`` and the failed filters have nothing in common."""
    word = F.lit((1 << (1 << n)) - 1).cast("long")
    for i in range(n):
        without = sum(1 << s for s in range(1 << n) if not s >> i & 1)
        word = F.when(failed.bitwiseAND(F.lit(1 << i)) != 0, word.bitwiseAND(F.lit(without).cast("long"))).otherwise(word)
    return word


def positional_popcount(words: np.ndarray, bits: int) -> np.ndarray:
    """How many of the ``words`` have each bit set, by carry-save adders."""
    counts = np.zeros(bits, np.int64)
    place = np.arange(bits, dtype=np.uint64)
    planes = {0: words.astype(np.uint64)}          # exponent of the weight -> words of this weight
    level = 0
    while level in planes:
        have = planes.pop(level)
        while len(have) >= 48:
            third = len(have) // 3
            a, b, c, rest = have[:third], have[third:2 * third], have[2 * third:3 * third], have[3 * third:]
            half = a ^ b
            carry = (a & b) | (half & c)
            up = planes.get(level + 1)
            planes[level + 1] = carry if up is None else np.concatenate([up, carry])
            have = np.concatenate([half ^ c, rest])
        counts += ((have[:, None] >> place) & np.uint64(1)).sum(axis=0).astype(np.int64) << level
        level += 1
    return counts


def survivors(failed: DataFrame, n: int = len(FILTERS)) -> DataFrame:
    """``part, alive``: an array whose entry ``S`` has the documents of each class that survive subset ``S``."""
    subsets = 1 << n
    words = failed.select("part", (F.col("good").cast("int") + 2 * F.col("toxic").cast("int")).alias("class"),
                          survival_word(F.col("failed"), n).alias("word"))

    def run(batches):
        for batch in batches:
            group = batch.column(0).dictionary_encode()
            code = group.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + batch.column(1).to_numpy()
            word = batch.column(2).to_numpy()
            order = np.argsort(code, kind="stable")
            code, word = code[order], word[order]
            cuts = np.flatnonzero(np.diff(code, prepend=-1))
            if not len(cuts):
                continue
            rows = [positional_popcount(w, subsets) for w in np.split(word, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [group.dictionary.take(pa.array(code[cuts] // 4)), pa.array((code[cuts] % 4).astype(np.int32)),
                 pa.array([r.tolist() for r in rows], pa.list_(pa.int64()))], ["part", "class", "counts"])

    counted = map_arrow(words, run, "part string, class int, counts array<long>")
    by_place = counted.select("part", "class", F.posexplode("counts").alias("subset", "c")).groupBy("part", "subset").agg(
        F.sum("c").alias("all"), F.sum(F.expr("c * (class & 1)")).alias("good"), F.sum(F.expr("c * (class >> 1)")).alias("toxic"))
    # one row for each subset
    return by_place.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", *CLASSES))).alias("alive"))


def _steps(filters: str) -> list[dict]:
    """Every step of all orders: its filter as a bit, and the subsets before and after it."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        for k, i in enumerate(order):
            out.append({"filter_order": "".join(filters[j] for j in order), "step": k + 1, "mine": 1 << i, "b": before, "a": before | 1 << i})
            before |= 1 << i
    return out


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """All figures of every part, filter order and step from the survivor counts of ``survivors``."""
    n = len(filters)
    full = (1 << n) - 1
    steps = F.from_json(F.lit(json.dumps(_steps(filters))), "array<struct<filter_order:string,step:int,mine:int,b:int,a:int>>")
    # in so many orders exactly the filters of a subset of each size come before a given one
    weights = ", ".join(f"{factorial(k) * factorial(n - 1 - k)}L" for k in range(n))
    gone = lambda c: F.expr(f"alive[b].{c} - alive[a].{c}")
    return counts.select("part", "alive", F.explode(steps).alias("s")).select("part", "alive", "s.*").select(
        "part", "filter_order", "step", F.expr("alive[a].all").alias("kept"), gone("all").alias("removed"),
        F.expr("alive[0].all - alive[mine].all - (alive[b].all - alive[a].all)").alias("redundant"),
        F.expr(f"alive[{full} - mine].all - alive[{full}].all").alias("unique_fails"),
        gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"),
        F.expr(f"""aggregate(filter(alive, x -> x.subset & mine = 0), 0L, (sum, x) ->
            sum + array({weights})[bit_count(x.subset)] * (x.all - alive[x.subset | mine].all))""").alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    return audit(survivors(failures(docs, labels, **columns)))
