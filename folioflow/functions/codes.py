"""Code tables, names, keys, state structs and request payloads (C8, C16-C19, C21, C22, K3 line)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# User code tables.
ROLE_LABELS = {0: "admin", 1: "staff", 2: "user"}
STATUS_LABELS = {0: "inactive", 1: "new", 2: "active"}
SEX_LABELS = {1: "Male", 2: "Female", 3: "Other"}
# Run-log status labels by result code (1 written, 0 blank, other error).
LOG_LABELS = {1: "SUCCESS", 0: "BLANK"}
LOG_OTHER = "ERROR"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _label_map(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def code_label(code: str | Column, table: dict, strict: bool = False, what: str = "code") -> Column:
    """Label for a code; unknown -> null, or an error when ``strict``."""
    v = F.try_element_at(_label_map(table), _c(code).cast("int"))
    if strict:
        return F.when(_c(code).isNull() | v.isNotNull(), v).otherwise(
            F.raise_error(F.concat(F.lit(f"unknown {what} "), _c(code).cast("string"))))
    return v


def code_labels(users: DataFrame, strict: bool = False) -> DataFrame:
    """Role, status and sex labels (unknown sex -> null; unknown role/status -> error if strict)."""
    return users.select("*",
                        code_label("role_code", ROLE_LABELS, strict, "role").alias("role"),
                        code_label("status_code", STATUS_LABELS, strict, "status").alias("status"),
                        code_label("sex", SEX_LABELS).alias("sex_label"))


def piece_name(barcode: str | Column, run_ts: str | Column, *key: str | Column) -> Column:
    """``md5(barcode + run time)`` + ``_`` + 10 digits derived from the key.

    The source drew 10 random digits per call, so a retry produced a new
    name; here the digits are ``10^9`` plus the first 32 bits of the md5 of
    the key, so a retried segment keeps its name.
    """
    h = F.md5(F.concat(F.coalesce(_c(barcode), F.lit("")), _c(run_ts).cast("string")))
    key_text = F.concat_ws("|", *[_c(k).cast("string") for k in key])
    digits = (F.conv(F.substring(F.md5(key_text), 1, 8), 16, 10).cast("long") + F.lit(1000000000)).cast("string")
    return F.concat(h, F.lit("_"), digits)


def bool_tf(x: Column) -> Column:
    """Boolean as the ``'t'`` / ``'f'`` text used in saved state."""
    return F.when(F.coalesce(x, F.lit(False)), F.lit("t")).otherwise(F.lit("f"))


def job_struct(rec: DataFrame) -> DataFrame:
    """C17: the saved non-bulk job state (flags as 't'/'f'); needs decode_flags + context.

    ``have_ocr`` is stored as the route decision (the source stored the
    deliver flag alone, so a resumed job could recognise an interactive
    record; fixed).
    """
    ocr = F.col("deliver_searchable") & ~F.col("interactive")
    st = F.struct(
        F.col("profile_id").cast("string").alias("profile_id"),
        F.col("image_id").cast("string").alias("image_id"),
        F.col("box_number").cast("string").alias("box_number"),
        F.col("box_part").cast("string").alias("box_part"),
        F.col("queue_id").cast("string").alias("bookmark_id"),
        bool_tf(F.col("have_sphinx")).alias("have_sphinx"),
        bool_tf(ocr).alias("have_ocr"),
        bool_tf(F.col("interactive")).alias("has_interactive"),
        F.col("pkged").cast("string").alias("pkged"),
        F.regexp_replace(F.substring_index(F.col("path"), "/", -1), "(?s)^(.*)[.]pdf.*$", "$1").alias("pdf_name"),
    )
    return rec.select("queue_id", st.alias("state"))


def request_json(s: Column) -> Column:
    """Request payload as JSON text (proper quoting, so apostrophes survive)."""
    return F.to_json(s)


def request_envelope(fields: dict[str, Column], *, root: str, key: str, signature: str) -> Column:
    """The request as JSON, ``{root: {"api_key", "api_sig", fields...}}``; key and signature come from the caller."""
    inner = F.struct(F.lit(key).alias("api_key"), F.lit(signature).alias("api_sig"),
                     *[v.alias(k) for k, v in fields.items()])
    return F.to_json(F.struct(inner.alias(root)))


def random_id(size: int = 10, seed: int | None = None) -> Column:
    """A random id of ``size`` letters and digits per row (pass a seed for repeatable ids)."""
    return F.randstr(size, seed) if seed is not None else F.randstr(size)


def random_key(seed: int | None = None) -> Column:
    """A random key per row (``uuid``; pass a seed for repeatable keys)."""
    return F.uuid(seed) if seed is not None else F.uuid()


def run_status(written: str | Column, text: str | Column | None = None, error: str | Column | None = None) -> Column:
    """1 written, 0 blank text, -1 error."""
    st = F.when(_c(written), F.lit(1)).otherwise(F.lit(-1))
    if text is not None:
        st = F.when(_c(written) & (F.regexp_replace(_c(text), "[\\t\\n\\x0B\\f\\r ]", "") == ""), F.lit(0)).otherwise(st)
    if error is not None:
        st = F.when(_c(error).isNotNull(), F.lit(-1)).otherwise(st)
    return st


def log_label(status: str | Column) -> Column:
    s = _c(status)
    return F.when(s == 1, F.lit(LOG_LABELS[1])).when(s == 0, F.lit(LOG_LABELS[0])).otherwise(F.lit(LOG_OTHER))


def log_line(ts: str | Column, status: str | Column, error: str | Column, path: str | Column) -> Column:
    """K3: ``[ts][STATUS][error]: path``."""
    return F.format_string("[%s][%s][%s]: %s", _c(ts).cast("string"), log_label(status),
                           F.coalesce(_c(error), F.lit("")), _c(path))


TASKS_SCHEMA = "array<map<string,struct<page_index:int,is_finish:string>>>"


def explode_tasks(state: DataFrame, col: str = "tasks", key: str | Sequence[str] = "queue_id") -> DataFrame:
    """Saved task list ``[{name: {page_index, is_finish}}]`` -> rows in list order.

    ``col`` is a JSON string or already the parsed array.
    """
    keys = [key] if isinstance(key, str) else list(key)
    arr = F.from_json(F.col(col), TASKS_SCHEMA) if dict(state.dtypes)[col] == "string" else F.col(col)
    x = state.select(*keys, F.posexplode(arr).alias("task_pos", "task"))
    x = x.select(*keys, "task_pos", F.explode("task").alias("barcode", "v"))
    return x.select(*keys, "task_pos", "barcode", F.col("v.page_index").alias("page_index"),
                    (F.col("v.is_finish") == "t").alias("is_finish"))


def first_task(tasks: DataFrame, key: str | Sequence[str] = "queue_id") -> DataFrame:
    """Of the entries of one name in a list the first one, as a lookup by name finds it."""
    keys = [key] if isinstance(key, str) else list(key)
    return tasks.groupBy(*keys, "barcode").agg(
        F.min("task_pos").alias("task_pos"), F.min_by("page_index", "task_pos").alias("page_index"),
        F.min_by("is_finish", "task_pos").alias("is_finish"))
