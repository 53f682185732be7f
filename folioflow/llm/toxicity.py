"""Toxicity scores from a learned lexicon, Levenshtein automata and context windows.

1. Lexicon: document counts of words and word beginnings in toxic and clean
   training documents; those that are much likelier in toxic ones become
   entries, weighted by their log-odds.  Counts cover every training row; only
   terms above a share of the toxic documents come to the driver, so their
   number does not grow with the corpus.
2. Matching: the entries form a trie; the Levenshtein automaton of a bounded
   number of edits is run on it as one lazily built deterministic automaton, so
   a word costs one step per letter.  Misspellings that stand in a share of the
   clean training documents, and are likelier there, are learned as exceptions.
3. Context: a match inside quotation marks or next to reporting words counts
   less, next to words of address more.
4. A logistic regression on the strongest match, their sum and their rate is
   fitted on a bounded sample of training rows (``MAX_FIT`` per class).

Only texts are read for a score.  Defined cases: a null or empty text has no
match and gets the score of match-free texts; repeated rows score alike; a null
``doc_id`` is scored but not trained on; several label rows count by their
mean; without training rows of both classes every score is 0; an empty table
gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (broadcast_if_small, byte_slices, hash_bytes, map_arrow, prefix_hash, range_hash, split_words, written)
from .fitting import Logistic

MAX_FIT = 10_000
MIN_SHARE = 0.0008
MIN_COUNT = 4
#: documents, and share of the clean documents, from which a misspelling can be an exception
MIN_CLEAN, MIN_CLEAN_SHARE = 2, 0.0005
MIN_WEIGHT = 2.5
STEMS = (4, 5, 6)
MAX_BROADCAST_ROWS = 500_000
#: weight of a match per edit, and of the kinds of context
PER_EDIT = 0.6
QUOTED, REPORTED, ADDRESSED = 0.3, 0.6, 1.15
WINDOW = 6

#: fixed values: words that report speech, and words of address
REPORTING = ("said says saying called calls quote quoted quotes wrote writes word words term terms phrase reported according "
             "sagte sagt nannte wort begriff zitat zitiert schrieb dit appelle mot terme citation selon écrit "
             "dijo dice llamó palabra término cita citado según").split()
ADDRESS = "you your you're u ur yourself du dich dein deine dir ihr euch tu toi ton ta tes vous votre tú te ti tus usted".split()

_BREAK = np.ones(256, bool)
_BREAK[0x30:0x3A] = False
_BREAK[0x61:0x7B] = False
_BREAK[0x80:] = False
_INNER = np.zeros(256, bool)
_INNER[list(b"@$*")] = True
_QUOTES = re.compile("[\"“”„«»‘]")


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (letters, digits, and ``@ $ *`` between such), and each word's text number."""
    space = _BREAK[data]
    if len(data) > 2:
        inside = np.flatnonzero(_INNER[data[1:-1]]) + 1
        inside = inside[~space[inside - 1] & ~space[inside + 1]]
        space[inside] = False
    # the separator table is applied already: 1 stands for a break
    starts, ends = split_words(space.view(np.uint8), offsets, np.arange(256) == 1)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _stem_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Words longer than ``k`` characters, and the byte after their first ``k``."""
    first = (data & 0xC0) != 0x80
    count = np.concatenate([[0], np.cumsum(first)])
    longer = np.flatnonzero(count[ends] - count[starts] > k)
    at = np.flatnonzero(first)
    return longer, at[count[starts[longer]] + k]


# ---- lexicon -------------------------------------------------------------------------------

def _slices(batch_col):
    return byte_slices(pc.utf8_lower(pc.fill_null(batch_col, "")))


def _distinct(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    new = np.ones(len(order), bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    return order[new]


def _terms(data, offsets):
    """For words and each stem length: ``(mark, starts, ends, text numbers, hashes)``."""
    starts, ends, doc = _tokens(data, offsets)
    prefix = prefix_hash(data)
    yield "", starts, ends, doc, range_hash(prefix, starts, ends)
    for k in STEMS:
        longer, stop = _stem_ends(data, starts, ends, k)
        yield "*", starts[longer], stop, doc[longer], range_hash(prefix, starts[longer], stop)


def _toxic_terms(docs: DataFrame, least: int) -> list[tuple[str, int]]:
    """Words and beginnings (marked ``*``) with the number of toxic documents that have them."""
    def run(batches):
        for batch in batches:
            for _, _, data, offsets in _slices(batch.column(0)):
                raw = data.tobytes()
                names, counts = [], []
                for mark, starts, ends, doc, key in _terms(data, offsets):
                    if not len(key):
                        continue
                    own = _distinct(doc, key)
                    _, some, n = np.unique(key[own], return_index=True, return_counts=True)
                    some = own[some]
                    names += [raw[a:b].decode(errors="replace") + mark for a, b in zip(starts[some].tolist(), ends[some].tolist())]
                    counts.append(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(np.concatenate(counts) if counts else [], pa.int64())],
                    ["term", "n"])

    total = map_arrow(docs.select("text"), run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return [(r["term"], r["n"]) for r in total.where(F.col("n") >= least).collect()]


def _clean_counts(docs: DataFrame, terms: list[str]) -> np.ndarray:
    """Number of clean documents that have each term."""
    order = np.argsort(keys := np.array([hash_bytes(t.rstrip("*").encode()) ^ (t.endswith("*") * 1) for t in terms], np.uint64))
    keys = keys[order]

    def run(batches):
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            for _, _, data, offsets in _slices(batch.column(0)):
                for mark, _, _, doc, key in _terms(data, offsets):
                    key = key ^ np.uint64(bool(mark))
                    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    found = np.flatnonzero(keys[at] == key)
                    pair = np.unique(doc[found] * len(keys) + at[found])
                    total += np.bincount(pair % len(keys), minlength=len(keys))
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total[k])], ["k", "n"])

    out = np.zeros(len(terms), np.int64)
    for r in map_arrow(docs.select("text"), run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[order[r["k"]]] = r["n"]
    return out


# ---- automaton -----------------------------------------------------------------------------

def allowed_edits(entry: str) -> int:
    return 0 if len(entry) < 4 else 1 if len(entry) < 7 else 2


class Automaton:
    """Trie of the entries and, over it, the Levenshtein automaton as a lazily built deterministic one.

    A state is the set of ``(trie node, edits)`` a word's letters so far can
    stand for; ``match`` returns the best entry's strength and edits.
    """

    MAX_STATES = 100_000

    def __init__(self, weights: dict[str, float], exceptions: frozenset[str] = frozenset()):
        self.exceptions = exceptions
        self.next: list[dict[str, int]] = [{}]
        self.word: list[float] = [0.0]
        self.stem: list[float] = [0.0]
        self.edits: list[int] = [0]                  # edits allowed at the node's own entry
        self.below: list[int] = [0]                  # most edits allowed at any entry below
        for entry, weight in weights.items():
            text, node, k = entry.rstrip("*"), 0, 0 if entry.endswith("*") else allowed_edits(entry)
            path = [0]
            for c in text:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    for table, empty in ((self.next, {}), (self.word, 0.0), (self.stem, 0.0), (self.edits, 0), (self.below, 0)):
                        table.append(empty if table is not self.next else {})
                node = self.next[node][c]
                path.append(node)
            if entry.endswith("*"):
                self.stem[node] = max(self.stem[node], weight)
            else:
                self.word[node], self.edits[node] = max(self.word[node], weight), k
            for p in path:
                self.below[p] = max(self.below[p], k)
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple[dict[int, int], float]] = []
        self.numbers: dict = {}
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0}, 0.0)

    def _state(self, nodes: dict[int, int], stem: float) -> int:
        # an unwritten letter of an entry: step down the trie at the cost of one edit
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            for child in self.next[node].values():
                if e + 1 <= self.below[child] and nodes.get(child, 9) > e + 1:
                    nodes[child] = e + 1
                    todo.append((child, e + 1))
        key = (frozenset(nodes.items()), stem)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append((nodes, stem))
            self.moves.append({})
        return self.numbers[key]

    def _move(self, state: int, c: str) -> int:
        nodes, stem = self.states[state]
        out: dict[int, int] = {}
        for node, e in nodes.items():
            child = self.next[node].get(c)
            if child is not None and out.get(child, 9) > e:
                out[child] = e
                if e == 0:
                    stem = max(stem, self.stem[child])
            if e + 1 <= self.below[node]:            # a letter too many, or another letter
                if out.get(node, 9) > e + 1:
                    out[node] = e + 1
                for other in self.next[node].values():
                    if e + 1 <= self.below[other] and out.get(other, 9) > e + 1:
                        out[other] = e + 1
        number = self._state(out, stem)
        self.moves[state][c] = number
        return number

    def match(self, word: str) -> tuple[float, int]:
        """``(strength, edits)`` of the best entry, or ``(0, 0)``."""
        if len(self.states) > self.MAX_STATES:
            self._reset()
        state, moves = self.start, self.moves
        for c in word:
            to = moves[state].get(c)
            state = self._move(state, c) if to is None else to
            nodes, stem = self.states[state]
            if not nodes:
                return stem, 0
        nodes, best = self.states[state]
        edits = 0
        for node, e in nodes.items():
            if self.word[node] and e <= self.edits[node]:
                strength = self.word[node] * PER_EDIT ** e
                if strength > best and not (e and word in self.exceptions):
                    best, edits = strength, e
        return best, edits


class Matcher:
    """Strength of each word of a slice, with a memo of a fixed size per worker."""

    BITS = 20

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.key = np.zeros(1 << self.BITS, np.uint64)
        self.value = np.zeros(1 << self.BITS, np.float32)
        self.edit = np.zeros(1 << self.BITS, np.int8)

    def strengths(self, data, starts, ends):
        key = range_hash(prefix_hash(data), starts, ends)
        slot = (key >> np.uint64(64 - self.BITS)).astype(np.int64)
        value, edit = self.value[slot], self.edit[slot]
        todo = np.flatnonzero(self.key[slot] != key)
        if len(todo):
            _, some, inverse = np.unique(key[todo], return_index=True, return_inverse=True)
            some, raw, match = todo[some], data.tobytes(), self.automaton.match
            got = [match(raw[a:b].decode(errors="replace")) for a, b in zip(starts[some].tolist(), ends[some].tolist())]
            v, e = np.array([g[0] for g in got], np.float32), np.array([g[1] for g in got], np.int8)
            self.key[slot[some]], self.value[slot[some]], self.edit[slot[some]] = key[some], v, e
            value[todo], edit[todo] = v[inverse], e[inverse]
        return key, value, edit


_CUES = {name: np.sort(np.array([hash_bytes(w.encode()) for w in words], np.uint64))
         for name, words in (("reporting", REPORTING), ("address", ADDRESS))}


def _context(raw: bytes, key: np.ndarray, doc: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> float:
    """How much a match at word ``k`` counts: its neighbours in the same text and the marks around it."""
    lo, hi = max(0, k - WINDOW), min(len(key), k + WINDOW + 1)
    near = [j for j in range(lo, hi) if doc[j] == doc[k]]
    before = raw[starts[near[0]]:starts[k]].decode(errors="replace").rsplit("\n", 1)[-1]
    after = raw[ends[k]:ends[near[-1]] + 4].decode(errors="replace").split("\n", 1)[0]
    out = 1.0
    if len(_QUOTES.findall(before)) % 2 and _QUOTES.search(after):
        out *= QUOTED
    if np.isin(key[near], _CUES["reporting"]).any():
        out *= REPORTED
    if np.isin(key[near], _CUES["address"]).any():
        out *= ADDRESSED
    return out


def _features(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """``doc_id, best, total, rate, label`` of every document."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int, best double, total double, rate double"

    def run(batches):
        matcher = Matcher(automaton)
        for batch in batches:
            for i, j, data, offsets in _slices(batch.column(1)):
                starts, ends, doc = _tokens(data, offsets)
                key, value, _ = matcher.strengths(data, starts, ends)
                best, total = np.zeros(j - i), np.zeros(j - i)
                raw = data.tobytes()
                for k in np.flatnonzero(value).tolist():
                    s = float(value[k]) * _context(raw, key, doc, starts, ends, k)
                    best[doc[k]] = max(best[doc[k]], s)
                    total[doc[k]] += s
                words = np.bincount(doc, minlength=j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(best), pa.array(np.log1p(total)),
                     pa.array(np.log1p(100 * total / np.maximum(words, 20)))], ["doc_id", "label", "best", "total", "rate"])

    return map_arrow(docs.select("doc_id", "text", "label"), run, schema)


def _exceptions(rows: DataFrame, automaton: Automaton, n_bad: int, n_good: int) -> frozenset[str]:
    """Words that the automaton takes for misspellings, but whose odds in the training documents speak for clean."""
    def run(batches):
        matcher = Matcher(automaton)
        for batch in batches:
            for i, j, data, offsets in _slices(batch.column(0)):
                starts, ends, doc = _tokens(data, offsets)
                key, value, edit = matcher.strengths(data, starts, ends)
                k = np.flatnonzero((value > 0) & (edit > 0))
                k = k[_distinct(doc[k], key[k])]
                bad = batch.column(1).slice(i, j - i).to_numpy(zero_copy_only=False)[doc[k]] == 1
                raw = data.tobytes()
                words = [raw[a:b].decode(errors="replace") for a, b in zip(starts[k].tolist(), ends[k].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.string()), pa.array(bad.astype(np.int64)), pa.array((~bad).astype(np.int64))],
                    ["word", "pos", "neg"])

    # words in a share of the clean documents: their number does not grow with the corpus
    found = map_arrow(rows.where("label IS NOT NULL").select("text", "label"), run, "word string, pos long, neg long").groupBy(
        "word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    often = found.where(F.col("neg") >= max(MIN_CLEAN, MIN_CLEAN_SHARE * n_good))
    # smoothed by one document, divided between the classes by their size
    share = n_bad / (n_bad + n_good)
    for_clean = (F.col("pos") + share) / n_bad < (F.col("neg") + 1 - share) / n_good
    return frozenset(r["word"] for r in often.where(for_clean).select("word").collect())


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", held_out_mod: int = 5,
                    max_fit: int = MAX_FIT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    spark = docs.sparkSession
    known = written(labels.where(f"doc_id IS NOT NULL AND {label} IS NOT NULL").groupBy(F.col("doc_id").alias("_doc")).agg(
        (F.avg(label) >= 0.5).cast("int").alias("label")), "toxic_labels")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(held_out_mod)) == 0, F.lit(False))
    train_labels = broadcast_if_small(known.where(F.pmod(F.crc32(F.col("_doc").cast("string").cast("binary")),
                                                         F.lit(held_out_mod)) != 0), MAX_BROADCAST_ROWS)
    rows = docs.select("doc_id", "text").join(train_labels, docs["doc_id"] == train_labels["_doc"], "left").select(
        "doc_id", "text", "label")
    size = {r["label"]: r["n"] for r in rows.where("label IS NOT NULL").groupBy("label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    n_bad, n_good = size.get(1, 0), size.get(0, 0)
    if not n_bad or not n_good:
        return docs.select("doc_id", held.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    terms = _toxic_terms(rows.where("label = 1"), max(MIN_COUNT, int(MIN_SHARE * n_bad)))
    clean = rows.where("label = 0")
    weights: dict[str, float] = {}
    if terms:
        pos, neg = np.array([n for _, n in terms]), _clean_counts(clean, [t for t, _ in terms])
        odds = np.log((pos + 0.5) / (n_bad + 1)) - np.log((neg + 0.5) / (n_good + 1))
        order = [k for k in np.argsort(-odds * np.sqrt(pos)) if odds[k] >= MIN_WEIGHT]
        weights = {terms[k][0]: float(odds[k]) for k in order}
    exceptions = _exceptions(rows, Automaton(weights), n_bad, n_good)
    table = written(_features(rows, Automaton(weights, exceptions)), "toxic_features")
    pick = lambda y: table.where(F.col("label") == y).orderBy(
        F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(max_fit).collect()
    sample = pick(0) + pick(1)
    x = np.array([[r["best"], r["total"], r["rate"]] for r in sample], float)
    y = np.array([r["label"] for r in sample], float)
    share = np.array([n_good, n_bad]) / np.maximum([(y == 0).sum(), (y == 1).sum()], 1)
    weight = share[y.astype(int)]
    fit = Logistic(x, y, weight * len(y) / weight.sum())
    z = F.lit(float(fit.w[-1]))
    for k, c in enumerate(("best", "total", "rate")):
        step = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col(c) - float(fit.mean[k])) / float(fit.scale[k])))
        z = z + step * float(fit.w[k])
    return table.select("doc_id", held.alias("held_out"), (1 / (1 + F.exp(-z))).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
