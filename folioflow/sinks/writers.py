"""Sinks (K1-K4, K8, K9).  All writes go through Spark writers; no driver-side file loops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import log_line
from ..functions.text import strip_ws
from ..operators.joins import EXCLUDED_KINDS, without_excluded
from . import state_log


def write_package(artifacts: DataFrame, root: str, excluded: Sequence[str] = tuple(EXCLUDED_KINDS),
                  mode: str = "overwrite") -> None:
    """K1: publish a job's results under ``root/box_number=../box_part=..`` without temp files or job state.

    ``artifacts`` needs box_number, box_part, kind (+ payload columns).  Only
    the partitions being written are replaced (dynamic partition overwrite).
    """
    # few files per folder, and a box beyond the advisory partition size is split over several tasks
    (without_excluded(artifacts, excluded).hint("rebalance", "box_number", "box_part").write
        .option("partitionOverwriteMode", "dynamic")
        .mode(mode).partitionBy("box_number", "box_part").parquet(root))


def write_page_text(pages: DataFrame, root: str, mode: str = "overwrite", buckets: int = 256, page_block: int = 4096) -> None:
    """K2: one trimmed UTF-8 text per page, laid out in ``buckets`` folders by a hash of the document (``bucket=../``)."""
    out = pages.select("doc_id", "page_no", strip_ws("text").alias("text"), bucket_of("doc_id", buckets).alias("bucket"))
    # one writer per (bucket, block of pages): few files per folder, and a
    # document with very many pages is still written by many tasks
    block = F.floor(F.col("page_no") / F.lit(page_block)).cast("long")
    out.repartition("bucket", block).sortWithinPartitions("bucket", "doc_id", "page_no").write.mode(mode).partitionBy(
        "bucket").parquet(root)


def bucket_of(key: str, buckets: int) -> Column:
    """Folder number of a key; folders stay few however many keys there are."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def append_run_log(results: DataFrame, path: str, run_ts: str) -> None:
    """K3: append ``[ts][STATUS][error]: path`` lines (status 1 SUCCESS, 0 BLANK, else ERROR)."""
    lines = results.select(log_line(F.lit(run_ts), F.col("status"), F.col("error"), F.col("path")).alias("value"))
    lines.write.mode("append").text(path)


def write_job_state(state: DataFrame, path: str, batch_id: int = 0) -> None:
    """K4: persist the given job states as batch ``batch_id`` of the state log below ``path``.

    Jobs that are not in ``state`` keep theirs; the state of a job is the one of
    its highest batch (:func:`folioflow.sources.files.read_job_state`).
    """
    state_log.append(state, path, batch_id)


def sync_table(spark: SparkSession, src: str, dst: str, fmt: str = "parquet") -> None:
    """K8: copy one whole table over another (the source dumped, shipped and loaded it)."""
    spark.read.format(fmt).load(src).write.mode("overwrite").format(fmt).save(dst)


MANIFEST = "bucket int, version long, n long, mixed long, total long"


def sync_difference(source: DataFrame, dst: str, key: str, buckets: int = 256) -> int:
    """K8 as a difference: copy only the buckets of ``source`` that differ from the copy below ``dst``; returns how many.

    A bucket's digest does not depend on the order of its rows (their number,
    the exclusive or and the sum of their hashes) and stands in the manifest, so
    the copy itself is not read.  Changed buckets are written as a new version
    and then named in the manifest: a copy that fails half-way changes nothing.
    """
    spark = source.sparkSession
    rows = source.withColumn("bucket", bucket_of(key, buckets))
    h = F.xxhash64(*[x for c in source.columns for x in (F.col(c), F.col(c).isNull())])
    now = rows.select("bucket", h.alias("h")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("mixed"), F.sum(F.pmod(F.xxhash64("h"), F.lit(1 << 31))).alias("total"))
    old = {r["bucket"]: r for r in state_log.latest(spark, f"{dst}/manifest", MANIFEST, "bucket").collect()}
    new = {r["bucket"]: r for r in now.collect()}                    # at most one row per bucket, either side
    figures = lambda r: (r["n"], r["mixed"], r["total"]) if r else (0, 0, 0)
    changed = [b for b in {*old, *new} if figures(old.get(b)) != figures(new.get(b))]
    if not changed:
        return 0
    version = 1 + max((r["version"] for r in old.values()), default=0)
    rows.where(F.col("bucket").isin(changed)).repartition("bucket", F.pmod(h, F.lit(4))).write.mode("overwrite").partitionBy(
        "bucket").parquet(f"{dst}/data/version={version}")
    entries = [(b, version, *figures(new.get(b))) for b in changed]
    state_log.append(spark.createDataFrame(entries, MANIFEST), f"{dst}/manifest", version)
    return len(changed)


def read_synced(spark: SparkSession, dst: str) -> DataFrame:
    """The copy that :func:`sync_difference` has made: of every bucket its latest version."""
    parts = state_log.latest(spark, f"{dst}/manifest", MANIFEST, "bucket").select("bucket", "version")
    return spark.read.parquet(f"{dst}/data").join(F.broadcast(parts), ["bucket", "version"], "left_semi").drop("bucket", "version")


USERS_DDL = ("id BIGINT, name STRING, email STRING, phone STRING, url STRING, location STRING, bio STRING, "
             "deposit DECIMAL(18,2), activation_key STRING, avatar STRING, create_at TIMESTAMP, "
             "update_at TIMESTAMP, password STRING, sex INT, role_code SMALLINT, status_code SMALLINT")


def init_tables(spark: SparkSession, database: str = "default", tables: dict[str, str] | None = None) -> list[str]:
    """K9: drop and recreate the managed tables empty."""
    tables = tables or {"users": USERS_DDL}
    names = []
    for name, ddl in tables.items():
        full = f"{database}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE {full} ({ddl}) USING parquet")
        names.append(full)
    return names
