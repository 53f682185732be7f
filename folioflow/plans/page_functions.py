"""Caller-supplied page and document functions run in parallel.

The per-page work of the source (recognition, text extraction) is an external
engine; here it is a Python function the caller passes in.  It runs inside
``mapInPandas`` on Arrow batches, one call per page, and one page failing
does not stop the others: each output row carries ``status`` (1 written,
0 blank, -1 error) and ``error``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_ws
from ..session import ship_package

PAGE_OUT = "doc_id long, page_no int, text string, status int, error string"
DOC_OUT = "doc_id long, text string, status int, error string"


def _apply(fn: Callable[[str | None], str], values) -> tuple[list, list, list]:
    texts, status, errors = [], [], []
    for v in values:
        try:
            out = fn(v)
            texts.append(out)
            status.append(1 if out.strip(" \t\n\r\x0b\x0c") else 0)
            errors.append(None)
        except Exception as e:  # noqa: BLE001 - a failing page is reported, not raised
            texts.append(None)
            status.append(-1)
            errors.append(f"{type(e).__name__}: {e}")
    return texts, status, errors


def _cleaned(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """The default function as column expressions: no Python runs."""
    text = F.coalesce(strip_ws(text_col), F.lit(""))
    return df.select(*keys, text.alias("text"), F.when(text == "", 0).otherwise(1).alias("status"),
                     F.lit(None).cast("string").alias("error"))


def map_pages(pages: DataFrame, fn: Callable[[str | None], str] | None = None, text_col: str = "text",
              rebalance: bool = True) -> DataFrame:
    """Run ``fn`` on every page's ``text_col``; output doc_id, page_no, text, status, error.

    ``rebalance`` hash-partitions on (doc_id, page_no) first so the pages of
    one large document are spread over all tasks.  Without ``fn`` the text is
    cleaned up (C10) by built-in functions.
    """
    if fn is None:
        return _cleaned(pages, ["doc_id", "page_no"], text_col)
    ship_package(pages.sparkSession)
    src = pages.select("doc_id", "page_no", text_col)
    if rebalance:
        src = src.repartition("doc_id", "page_no")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            texts, status, errors = _apply(fn, b[text_col].tolist())
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("int64"), "page_no": b["page_no"].astype("int32"),
                                "text": texts, "status": pd.Series(status, dtype="int32"), "error": errors})

    return src.mapInPandas(run, PAGE_OUT)


def map_documents(docs: DataFrame, fn: Callable[[str | None], str] | None = None,
                  text_col: str = "text") -> DataFrame:
    """Run ``fn`` once per whole document (default: clean-up as in X2); output doc_id, text, status, error."""
    if fn is None:
        return _cleaned(docs, ["doc_id"], text_col)
    ship_package(docs.sparkSession)
    src = docs.select("doc_id", text_col)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            texts, status, errors = _apply(fn, b[text_col].tolist())
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("int64"), "text": texts,
                                "status": pd.Series(status, dtype="int32"), "error": errors})

    return src.mapInPandas(run, DOC_OUT)
