"""Registry of named jobs: a Spark builder ``(spark, sf_dir) -> DataFrame`` and its DuckDB oracle SQL.

Modules under this package register jobs with :func:`job`.  Every job reads
the shared tables (or views derived from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views_sql import with_views

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def job(name: str, sql: str | None = None, views: tuple[str, ...] = (), ctes: str = ""):
    """Register ``fn`` as job ``name``; ``sql`` (if any) runs in DuckDB with ``views`` in front."""
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate job {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *views, ctes=ctes)
        return fn
    return deco


def load_all() -> None:
    from . import pipeline, records, scalars, users_jobs, streams, stored, roads  # noqa: F401,I001
