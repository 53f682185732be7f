"""Quality classifier by co-training of a text view and a metadata view.

The text view holds ratios of a whole text (characters, words, lines,
repetition); the metadata view holds source, language and the stated length.
Each view has its own logistic regression.  In every round both score all
documents, and each view hands its confident documents, with their
pseudo-labels, to the other view's next fit.  At the end both views are
calibrated on labelled rows that no fit has seen, and their log-odds are added.

Fits run on bounded, documented samples (``MAX_LABELLED`` labelled rows and
``MAX_PSEUDO`` pseudo-labelled rows per class and round, chosen by a hash of
``doc_id``); features, scores and confidence cover all documents.

Defined cases: a null or empty text has all-zero text features; null metadata is
a category of its own; a null ``doc_id`` is scored and never used for a fit;
several label rows of a document count by their mean; without labels of both
classes every score is 0.5 and every document is kept; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACES, byte_class, byte_slices, map_arrow, prefix_hash, range_hash, split_words, written
from .fitting import Logistic, Platt, sigmoid
from .near_dedup import shingle_sets

MAX_LABELLED = 20_000
MAX_PSEUDO = 5_000
ROUNDS = 2
CONFIDENT = 0.97
#: a good document lost costs as much as so many bad ones kept
LOSS_WEIGHT = 20.0

SOURCE_BINS, LANG_BINS = 32, 16
_KIND = np.full(256, 0, np.uint8)                    # 0: other
for _k, _chars in enumerate((bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b" \t", b"\n", b".,;:'\"-()", b"!?",
                             b"#*$%&~^=+_@\\", b"|<>{}[]/"), 1):
    _KIND[list(_chars)] = _k
_KIND[0x80:] = 10
N_KINDS = 11
_NEWLINE = byte_class(b"\n")


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ratios per text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(doc * N_KINDS + _KIND[data], minlength=n * N_KINDS).reshape(n, N_KINDS).astype(float)
    starts, ends = split_words(data, offsets, SPACES)
    bounds = np.searchsorted(starts, offsets)
    n_words = np.diff(bounds)
    of = np.repeat(np.arange(n), n_words)
    low = LOWER[data]
    word = range_hash(prefix_hash(low), starts, ends)
    length = ends - starts
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (of[1:] == of[:-1])
    per_word = np.maximum(n_words, 1)

    def distinct(k: int) -> np.ndarray:
        total = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
        return np.diff(shingle_sets(data, offsets, k)[1]) / np.maximum(total, 1)

    a, b = split_words(data, offsets, _NEWLINE)
    line_of = np.searchsorted(offsets, a, "right") - 1
    lines = np.bincount(line_of, minlength=n)
    key = np.unique(np.stack([line_of.astype(np.uint64), range_hash(prefix_hash(data), a, b)]), axis=1)[0]
    n_distinct = np.bincount(key.astype(np.int64), minlength=n)
    ratio = np.column_stack([
        kinds / np.maximum(size, 1)[:, None],
        np.bincount(of, length, n) / per_word / 20.0,
        np.bincount(of, (length == 1), n) / per_word,
        np.bincount(of, (length > 20), n) / per_word,
        np.bincount(of, same, n) / per_word,
        distinct(1), distinct(3),
        n_distinct / np.maximum(lines, 1),
        np.minimum(size / np.maximum(lines, 1) / 1000.0, 5.0),
    ])
    return np.hstack([ratio, np.log1p(100.0 * ratio), np.log1p(n_words)[:, None] / 10.0])


def meta_features(source: list, lang: list, n_chars: list) -> np.ndarray:
    out = np.zeros((len(source), SOURCE_BINS + LANG_BINS + 2))
    for i, (s, g, c) in enumerate(zip(source, lang, n_chars)):
        out[i, zlib.crc32(repr(s).encode()) % SOURCE_BINS] = 1.0
        out[i, SOURCE_BINS + zlib.crc32(repr(g).encode()) % LANG_BINS] = 1.0
        out[i, -2] = np.log1p(max(c or 0, 0)) / 10.0
        out[i, -1] = c is None
    return out


N_TEXT = 2 * (N_KINDS + 8) + 1


def _row_key(docs: DataFrame) -> Column:
    """Hash of what a row is judged by."""
    read = [docs["text"], docs["source"].cast("string"), docs["lang"].cast("string"), docs["n_chars"].cast("long")]
    return F.xxhash64(*[x for c in read for x in (c, c.isNull())])


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, x, row``: text features followed by metadata features, and the row's key."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in byte_slices(batch.column(1)):
                meta = [batch.column(k).slice(i, j - i).to_pylist() for k in (2, 3, 4)]
                x = np.hstack([text_features(data, offsets), meta_features(*meta)]).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(np.ascontiguousarray(x).ravel())),
                     batch.column(5).slice(i, j - i)], ["doc_id", "x", "row"])

    return map_arrow(docs.select("doc_id", "text", F.col("source").cast("string"), F.col("lang").cast("string"),
                                 F.col("n_chars").cast("long"), _row_key(docs).alias("row")), run,
                     f"doc_id {key}, x array<float>, row long")


def _threshold(score: np.ndarray, y: np.ndarray, weight: np.ndarray, loss_weight: float) -> float:
    """The threshold up to 0.5 that costs least on the calibration rows; the highest one if several do."""
    order = np.argsort(score)
    s, good, w = score[order], y[order] == 1, weight[order]
    cost = np.concatenate([[0.0], np.cumsum(np.where(good, loss_weight * w, -w))])     # of rejecting the first k rows
    k = int(np.searchsorted(s, 0.5))
    best = int(np.flatnonzero(cost[:k + 1] == cost[:k + 1].min())[-1])
    return 0.5 if best == k else float(s[best])


def _matrix(rows: list) -> np.ndarray:
    return np.array([r["x"] for r in rows], np.float64)


def _scored(table: DataFrame, views: dict, extra: str = "") -> DataFrame:
    """``table`` with the calibrated log-odds ``t`` and ``m`` of both views."""
    text, meta, cal_t, cal_m = views["text"], views["meta"], views["cal_t"], views["cal_m"]
    names = table.columns

    def run(batches):
        for batch in batches:
            x = batch.column(names.index("x"))
            z = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cal_t.logit(text.logit(z[:, :N_TEXT]))),
                 pa.array(cal_m.logit(meta.logit(z[:, N_TEXT:])))], [*names, "t", "m"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    return map_arrow(table, run, f"{schema}, t double, m double")


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, text_score, meta_score, score, kept``."""
    return _row_scores(docs, labels, **options).drop("row")


def _row_scores(docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_labelled: int = MAX_LABELLED,
                max_pseudo: int = MAX_PSEUDO, rounds: int = ROUNDS, confident: float = CONFIDENT,
                loss_weight: float = LOSS_WEIGHT) -> DataFrame:
    """One row per document: ``doc_id, row, text_score, meta_score, score, kept``."""
    known = labels.where(f"doc_id IS NOT NULL AND {label} IS NOT NULL").groupBy(F.col("doc_id").alias("_doc")).agg(
        (F.avg(label) >= 0.5).cast("int").alias("label"))
    table = features(docs)
    table = written(table.join(known, table["doc_id"] == known["_doc"], "left").select("doc_id", "x", "row", "label"),
                    "quality_features")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    pick = lambda df, n: df.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(n).collect()
    labelled = table.where("label IS NOT NULL").withColumn("fold", fold)
    rows = [r for y in (0, 1) for r in pick(labelled.where(F.col("label") == y), max_labelled // 2)]
    y = np.array([r["label"] for r in rows], float)
    held = np.array([r["fold"] == 0 for r in rows], bool)
    if len(rows) == 0 or any(len(np.unique(y[k])) < 2 for k in (held, ~held)):
        half = F.lit(0.5).cast("double")
        return table.select("doc_id", "row", half.alias("text_score"), half.alias("meta_score"), half.alias("score"),
                            F.lit(True).alias("kept"))
    x = _matrix(rows)
    # the sample is drawn by class; weights restore the classes' shares
    n_of = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = np.array([n_of[int(k)] / max((y == k).sum(), 1) for k in y])
    weight *= len(weight) / weight.sum()
    given = {"text": (np.zeros((0, x.shape[1])), np.zeros(0)), "meta": (np.zeros((0, x.shape[1])), np.zeros(0))}
    views: dict = {}
    for step in range(rounds + 1):
        for view, cols in (("text", slice(0, N_TEXT)), ("meta", slice(N_TEXT, None))):
            px, py = given[view]
            views[view] = Logistic(np.vstack([x[~held], px])[:, cols], np.concatenate([y[~held], py]),
                                   np.concatenate([weight[~held], np.full(len(py), 0.5)]))
        views["cal_t"] = Platt(views["text"].logit(x[held, :N_TEXT]), y[held])
        views["cal_m"] = Platt(views["meta"].logit(x[held, N_TEXT:]), y[held])
        if step == rounds:
            break
        scored = _scored(table.where("label IS NULL AND doc_id IS NOT NULL"), views)
        edge = float(np.log(confident / (1 - confident)))
        for mine, other in (("t", "meta"), ("m", "text")):
            good = pick(scored.where(F.col(mine) >= edge).select("doc_id", "x"), max_pseudo)
            bad = pick(scored.where(F.col(mine) <= -edge).select("doc_id", "x"), max_pseudo)
            if good or bad:
                given[other] = (_matrix(good + bad), np.array([1.0] * len(good) + [0.0] * len(bad)))
    share = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    prior = float(np.log(share / (1 - share)))
    both = lambda z: (views["cal_t"].logit(views["text"].logit(z[:, :N_TEXT]))
                      + views["cal_m"].logit(views["meta"].logit(z[:, N_TEXT:])) - prior)
    threshold = _threshold(sigmoid(both(x[held])), y[held], weight[held], loss_weight)
    prob = lambda z: 1 / (1 + F.exp(-z))
    return _scored(table.select("doc_id", "row", "x"), views).select(
        "doc_id", "row", prob(F.col("t")).alias("text_score"), prob(F.col("m")).alias("meta_score"),
        prob(F.col("t") + F.col("m") - F.lit(prior)).alias("score")).withColumn("kept", F.col("score") >= threshold)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps; each row goes by its own score, whatever its ``doc_id``."""
    bad = _row_scores(docs, labels, **options).where("NOT kept").select(
        F.col("doc_id").alias("_bad"), F.col("row").alias("_bad_row")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]) & (_row_key(docs) == bad["_bad_row"]), "left_anti")
