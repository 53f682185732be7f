from __future__ import annotations

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from tests_llm_prose import prose  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus():
    """Small documents with every planted case: copies, near copies, shared lines, null, empty and very long texts."""
    rng = random.Random(5)
    rows = []
    line = prose(rng, 14)
    passage = prose(rng, 60)
    base = prose(rng, 300)
    for k in range(40):
        text = "\n".join(prose(rng, rng.randint(6, 40)) for _ in range(rng.randint(1, 6)))
        if k % 4 == 0:
            text = line + "\n" + text
        if k % 5 == 0:
            text += "\n" + prose(rng, 3) + " " + passage + " " + prose(rng, 3)
        rows.append([k, text])
    rows += [[50 + k, rows[3][1]] for k in range(3)]                                  # exact copies
    for k in range(12):                                                               # near copies
        w = base.split(" ")
        for j in rng.sample(range(300), k % 4):
            w[j] = "changed"
        rows.append([60 + k, " ".join(w)])
    rows += [[80, None], [81, ""], [82, " \n\t "], [83, "one"], [84, "one"], [85, "A B"], [86, "a b c d e f"],
             [87, prose(rng, 30_000)], [88, "the the the the " * 400], [89, "a" * 5000], [90, "ÀÉ ÿ 日本語 😀 don't <b> x"],
             [None, base], [None, None], [3, rows[3][1]]]
    return [(i, t, ["en", "fr", None][n % 3], f"src{n % 4}" if n % 7 else None, len(t) if t and n % 5 else None)
            for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def wide_docs(docs):
    """Extra columns with the names that the operators use themselves."""
    names = ["id", "key", "n", "h", "a", "b", "c", "pos", "items", "score", "kept", "label", "component_id", "gone", "_gone", "_doc",
             "_bad", "_w", "_l", "_s", "_c", "_m", "_row", "_t", "length", "sequence_id", "offset", "words", "spans", "item_id"]
    return docs.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
