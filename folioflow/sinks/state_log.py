"""Append-only state tables: versions per key, idempotent batches, compaction.

A log is a folder with one sub-folder per batch (``batches/batch_id=<n>``).
Saving a batch writes its own sub-folder and nothing else, so a worker can save
one job without knowing any other, and a batch that is saved again (after a
restart) replaces itself.  Reading takes the row of the highest batch per key.
:func:`compact` writes the latest rows once below ``snapshots/upto=<n>``;
readers then need only that snapshot and the batches after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_ATTEMPTS = 3
_BATCH = "batch_id"


def append(rows: DataFrame, path: str, batch_id: int) -> None:
    """Save ``rows`` as batch ``batch_id``; the same batch saved again replaces itself."""
    rows.write.mode("overwrite").json(f"{path}/batches/{_BATCH}={int(batch_id)}", ignoreNullFields=False)


def append_many(rows: DataFrame, path: str) -> None:
    """Save the batches that ``rows`` names in its column ``batch_id`` in one write; each replaces itself."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BATCH).json(
        f"{path}/batches", ignoreNullFields=False)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows that are not behind the latest snapshot, with ``batch_id`` (the snapshot's number for its rows)."""
    typed = f"{schema}, {_BATCH} long"
    log = _table(spark, f"{path}/batches", typed)
    old = _table(spark, f"{path}/snapshots", f"{schema}, {_BATCH} long, upto long")
    if log is None:
        log = spark.createDataFrame([], typed)
    if old is None:
        return log
    # one row: the newest snapshot that is whole (a write shows its files only when it is done)
    newest = old.agg(F.max("upto")).scalar()
    return old.where(F.col("upto") == newest).drop("upto").unionByName(log.where(F.col(_BATCH) > newest))


def latest(spark: SparkSession, path: str, schema: str, key: str | Sequence[str]) -> DataFrame:
    """The newest row of every key.  A key saved twice in one batch keeps its greatest row."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = entries(spark, path, schema)
    # text stands for the row where values (maps) cannot be compared
    whole = F.struct(*rows.columns)
    return rows.groupBy(*keys).agg(F.max_by(whole, F.struct(F.col(_BATCH), F.to_json(whole))).alias("row")).select("row.*").drop(_BATCH)


def compact(spark: SparkSession, path: str, schema: str, key: str | Sequence[str], upto: int) -> None:
    """Write the newest rows of the batches up to ``upto`` as a snapshot.  Readers may go on meanwhile; repeating it is harmless."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = entries(spark, path, schema).where(F.col(_BATCH) <= upto)
    whole = F.struct(*rows.columns)
    kept = rows.groupBy(*keys).agg(F.max_by(whole, F.struct(F.col(_BATCH), F.to_json(whole))).alias("row")).select("row.*")
    kept.write.mode("overwrite").json(f"{path}/snapshots/upto={int(upto)}", ignoreNullFields=False)


# ---- attempts (T7) -------------------------------------------------------------------------

ATTEMPT = "request_id long, tried timestamp, error string"


def attempts(spark: SparkSession, path: str, *, now: str, max_attempts: int = MAX_ATTEMPTS, backoff_s: int = 1) -> DataFrame:
    """request_id, attempts, outcome of every logged request.

    ``done`` if any attempt has no error, else ``dead_letter`` after
    ``max_attempts``, else ``retry`` once the wait (attempts x ``backoff_s``) is
    over, else ``wait``.  An attempt is a batch and a time, so a replayed batch counts once.
    """
    log = entries(spark, path, ATTEMPT)
    one = log.groupBy("request_id").agg(F.count(F.lit(1)).cast("int").alias("attempts"), F.max("tried").alias("last"),
                                        F.bool_or(F.col("error").isNull()).alias("ok"))
    wait = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("attempts") * backoff_s).cast("decimal(18,6)"))
    due = F.lit(now).cast("timestamp") >= F.col("last") + wait
    return one.select("request_id", "attempts", F.when(F.col("ok"), "done").when(F.col("attempts") >= max_attempts, "dead_letter").when(
        due, "retry").otherwise("wait").alias("outcome"))
