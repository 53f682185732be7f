"""Jobs of scalar functions, messages and the template functions (C1, C3-C7, C10, C13-C15, C19, C21, F1, F12,
F17, K3, T3, T4, T7, X1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes, dates, paths, text
from ..functions.sql_functions import register_functions
from ..operators import filters as flt
from ..sources import tables as T
from ..streaming import requests as rq
from . import job

WS = r"[\t\n\x0B\f\r ]"
NOW = "2024-01-20 12:00:00"
RUN_TS = "2024-01-20 12:00:00"

C1_SQL = f"""
SELECT doc_id, code, CASE WHEN code = 1 THEN regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') ELSE '' END AS text
FROM (SELECT doc_id, text,
             CASE WHEN NOT regexp_matches(t, '[^\\t\\n\\x0B\\f\\r ]') THEN 0
                  WHEN (length(t) - length(replace(t, '@', ''))) / length(t) > 0.5 THEN 0 ELSE 1 END AS code
      FROM (SELECT doc_id, text, replace(regexp_replace(COALESCE(text, ''), '[^A-Za-z ]+ ', '@', 'g'), ' ', '') AS t
            FROM {{view}}))"""


@job("classify_searchable", C1_SQL.format(view="v_docs"), ("v_docs",))
def classify_searchable(spark, sf_dir):
    """Does a document already hold usable text."""
    return text.classify_searchable(T.docs(spark, sf_dir))


@job("classify_searchable_mangled", C1_SQL.format(view="v_docs_mangled"), ("v_docs_mangled",))
def classify_searchable_mangled(spark, sf_dir):
    """C1 on the variant with empty, digit-only and ``@`` texts."""
    return text.classify_searchable(T.docs(spark, sf_dir, "mangled"))


# File-name suffixes used to build edge-case names (FIXTURES.md §3).
SUFFIXES = [".pdf", ".pdf.pdf", ".pdfx", ".PDF", ""]

NAMES = """names AS (
SELECT p_partkey AS id, '/docs/' || p_brand || '/' || replace(p_name, ' ', '_') ||
       CASE p_partkey % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.pdf.pdf' WHEN 2 THEN '.pdfx' WHEN 3 THEN '.PDF' ELSE '' END
       AS path
FROM part)"""


def _names(spark, sf_dir):
    p = T.table(spark, sf_dir, "part")
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return p.select(F.col("p_partkey").alias("id"),
                    F.concat(F.lit("/docs/"), F.col("p_brand"), F.lit("/"),
                             F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), suffix).alias("path"))


@job("file_stem", r"""
SELECT id, regexp_replace(regexp_extract(path, '[^/]*$'), '(?s)^(.*)[.]pdf.*$', '\1') AS stem FROM names""", (), NAMES)
def file_stem(spark, sf_dir):
    """Base name cut at the last ``.pdf`` (case-sensitive)."""
    return _names(spark, sf_dir).select("id", paths.file_stem("path").alias("stem"))


PARTS_SQL = """
SELECT id, regexp_extract(path, '[^/]*$') AS name, d AS dir,
       regexp_replace(CASE WHEN instr(d, '/docs') > 0 THEN substr(d, instr(d, '/docs') + 5) ELSE '' END,
                      '^/+|/+$', '', 'g') AS sub_dir
FROM (SELECT id, path, CASE WHEN instr(path, '/') > 0 THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS d
      FROM names)"""


def _parts(spark, sf_dir):
    n = _names(spark, sf_dir)
    return n.select("id", paths.base_name("path").alias("name"), paths.dir_name("path").alias("dir"),
                    paths.sub_dir("path", "/docs").alias("sub_dir"))


@job("path_parts", PARTS_SQL, (), NAMES)
def path_parts(spark, sf_dir):
    """C4: file name, folder and sub-folder below the crawl root ``/docs``."""
    return _parts(spark, sf_dir)


@job("target_path", r"""
SELECT id, CASE WHEN sub_dir = '' THEN '/out' ELSE '/out/' || sub_dir END AS target_dir,
       CASE WHEN sub_dir = '' THEN '/out' ELSE '/out/' || sub_dir END || '/' ||
       regexp_replace(regexp_replace(regexp_replace(translate(lower(regexp_replace(name, '(?s)^(.*)[.]pdf.*$', '\1')),
         'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '''+', '', 'g'), '[^a-z0-9]+', '-', 'g'),
         '^-+|-+$', '', 'g') || '/tmp_dir' AS temp_dir
FROM (""" + PARTS_SQL + ")", (), NAMES)
def target_path(spark, sf_dir):
    """Output folder mirroring the input sub-folder, and the page-image scratch folder."""
    x = _parts(spark, sf_dir)
    stem = paths.file_stem("name")
    return x.select("id", paths.target_dir("/out", "sub_dir").alias("target_dir"),
                    paths.temp_dir("/out", "sub_dir", stem).alias("temp_dir"))


@job("slugify", """
SELECT doc_id, CASE WHEN slug = '' AND text <> '' THEN 'x-' || left(md5(text), 8) ELSE slug END AS slug
FROM (SELECT doc_id, text, regexp_replace(regexp_replace(regexp_replace(strip_accents(replace(lower(text), 'ß', 'ss')),
         '''+', '', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM v_docs)""", ("v_docs",))
def slugify(spark, sf_dir):
    """Slug of each whole document text."""
    return T.docs(spark, sf_dir).select("doc_id", text.slugify("text").alias("slug"))


@job("clean_text", f"SELECT conv_id, turn, regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') AS text FROM conversations")
def clean_text(spark, sf_dir):
    """Recognised text with surrounding whitespace removed."""
    c = T.table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", text.strip_ws("text").alias("text"))


@job("format_date", "SELECT event_id, COALESCE(printf('%4d-%02d-%02d', year(ts), month(ts), day(ts)), '') AS day "
     "FROM v_messages", ("v_messages",))
def format_date(spark, sf_dir):
    """``YYYY-MM-DD`` of each message time."""
    return T.messages(spark, sf_dir).select("event_id", dates.format_date("ts").alias("day"))


def _pretty_sql(ts: str, now: str) -> str:
    total = f"floor((epoch_us(TIMESTAMP '{now}') - epoch_us({ts})) / 1000000.0)"
    days = f"floor({total} / 86400.0)"
    secs = f"({total} - {days} * 86400)"
    parts = [(f"floor({days} / 365.0)", "year", "years"), (f"floor({days} / 30.0)", "month", "months"),
             (f"floor({days} / 7.0)", "week", "weeks"), (days, "day", "days"),
             (f"floor({secs} / 3600.0)", "hour", "hours"), (f"floor({secs} / 60.0)", "minute", "minutes"),
             (secs, "second", "seconds")]
    whens = " ".join(
        f"WHEN CAST({v} AS BIGINT) <> 0 THEN CAST(CAST({v} AS BIGINT) AS VARCHAR) || "
        f"CASE WHEN CAST({v} AS BIGINT) = 1 THEN ' {a} ago' ELSE ' {b} ago' END" for v, a, b in parts)
    return f"CASE WHEN {ts} IS NULL THEN NULL {whens} ELSE 'just now' END"


@job("pretty_date", f"SELECT event_id, {_pretty_sql('ts', NOW)} AS age FROM v_messages", ("v_messages",))
def pretty_date(spark, sf_dir):
    """C14: age of each message time relative to a fixed ``now`` (past and future times)."""
    return T.messages(spark, sf_dir).select("event_id", dates.pretty_date("ts", NOW).alias("age"))


def _nl2br_sql(col: str) -> str:
    esc = (f"replace(replace(replace(replace(replace(regexp_replace({col}, '^{WS}+|{WS}+$', '', 'g'), '&', '&amp;'),"
           f" '<', '&lt;'), '>', '&gt;'), '\"', '&#34;'), '''', '&#39;')")
    return (f"CASE WHEN {col} IS NULL OR {col} = '' THEN '' ELSE array_to_string(list_transform("
            f"regexp_split_to_array({esc}, '(?:\\r\\n|\\r|\\n){{2,}}'), lambda p: '<p>' || replace(p, chr(10), "
            f"'<br>' || chr(10)) || '</p>'), chr(10) || chr(10)) END")


@job("nl2br", f"SELECT doc_id, {_nl2br_sql('text')} AS html FROM v_docs", ("v_docs",))
def nl2br(spark, sf_dir):
    """Documents as HTML paragraphs."""
    return T.docs(spark, sf_dir).select("doc_id", text.nl2br("text").alias("html"))


@job("nl2br_paragraphs", f"SELECT doc_id, {_nl2br_sql('text')} AS html FROM v_paragraphs", ("v_paragraphs",))
def nl2br_paragraphs(spark, sf_dir):
    """C15 on the variant with blank-line paragraph breaks."""
    return T.paragraphs(spark, sf_dir).select("doc_id", text.nl2br("text").alias("html"))


@job("register_functions", f"""
SELECT event_id, COALESCE(printf('%4d-%02d-%02d', year(ts), month(ts), day(ts)), '') AS day,
       {_pretty_sql('ts', NOW)} AS age, {_nl2br_sql('body')} AS html
FROM v_messages""", ("v_messages",))
def register_functions_job(spark, sf_dir):
    """The template functions registered for SQL and used from a SQL query."""
    register_functions(spark)
    T.messages(spark, sf_dir).createOrReplaceTempView("ff_messages")
    return spark.sql(f"SELECT event_id, format_date(ts) AS day, pretty_date(ts, TIMESTAMP '{NOW}') AS age, "
                     "nl2br(body) AS html FROM ff_messages")


@job("wake_messages", "SELECT event_id, value, ts FROM v_messages WHERE value = 'purchase'", ("v_messages",))
def wake_messages(spark, sf_dir):
    """messages whose body is the trigger (here ``purchase``)."""
    return flt.wake_messages(T.messages(spark, sf_dir), "purchase").select("event_id", "value", "ts")


@job("wrap_messages", """
SELECT event_id, '{"task":"ai.pdf_request","id":"' || md5(CAST(event_id AS VARCHAR) || '|' || value) ||
       '","args":["' || value || '"]}' AS envelope
FROM v_messages""", ("v_messages",))
def wrap_messages(spark, sf_dir):
    """Message body -> task envelope with a stable id."""
    return rq.wrap_messages(T.messages(spark, sf_dir))


@job("dead_letters", """
SELECT event_id, CASE WHEN value IS NULL OR value = '' THEN 'empty'
                      WHEN body IS NOT NULL AND NOT json_valid(body) THEN 'undecodable'
                      WHEN value <> 'purchase' THEN 'unknown' END AS reason,
       CASE WHEN (value IS NULL OR value = '') OR value <> 'purchase' THEN 'dead_letter' ELSE 'task' END AS outcome
FROM v_messages""", ("v_messages",))
def dead_letters(spark, sf_dir):
    """T4: messages split into tasks and dead letters with a reason."""
    c = rq.classify_messages(T.messages(spark, sf_dir), trigger="purchase")
    return c.select("event_id", "reason", "outcome")


@job("retry_table", f"""
SELECT event_id, CAST(event_id % 5 AS INTEGER) AS attempts,
       (event_id % 5 < 3 AND TIMESTAMP '{NOW}' >= ts + to_seconds(CAST(event_id % 5 AS BIGINT))) AS eligible
FROM v_messages""", ("v_messages",))
def retry_table(spark, sf_dir):
    """Which failed requests may be retried now (attempts < 3, back-off of attempts seconds)."""
    m = T.messages(spark, sf_dir).select("event_id", (F.col("event_id") % 5).cast("int").alias("attempts"),
                                         F.col("ts").alias("last_try"))
    return m.select("event_id", "attempts", rq.retry_eligible(m, NOW).alias("eligible"))


AVATAR = """av AS (
SELECT p_partkey AS id, lower(replace(p_brand, '#', '')) ||
       CASE p_size % 6 WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' WHEN 2 THEN '.gif' WHEN 3 THEN '.jpeg'
                       WHEN 4 THEN '' ELSE '.png.exe' END AS name
FROM part)"""
AV_EXT = [".png", ".JPG", ".gif", ".jpeg", "", ".png.exe"]


@job("avatar_allowed", """
SELECT id, name, COALESCE(instr(name, '.') > 0 AND regexp_extract(name, '[^.]*$') IN ('png', 'jpg', 'jpeg', 'gif'),
                          false) AS allowed
FROM av""", (), AVATAR)
def avatar_allowed(spark, sf_dir):
    """upload name has an allowed image extension (case-sensitive)."""
    p = T.table(spark, sf_dir, "part")
    ext = F.element_at(F.array(*[F.lit(e) for e in AV_EXT]), (F.col("p_size") % 6 + 1).cast("int"))
    x = p.select(F.col("p_partkey").alias("id"),
                 F.concat(F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))), ext).alias("name"))
    return x.select("id", "name", flt.avatar_allowed("name").alias("allowed"))


# The output types the folder tool accepts.
OUTPUT_TYPES = ["PDF", "PDF-TEXT", "PDF-XML", "PDF-TEXT-XML", "TEXT", "TEXT-XML", "XML"]


@job("wanted_outputs", """
SELECT queue_id, CAST(pos - 1 AS INTEGER) AS kind_pos,
       CASE WHEN kinds[pos] = 'text' THEN 'txt' ELSE kinds[pos] END AS kind,
       (list_contains(kinds, 'pdf') AND list_contains(kinds, 'text')) AS pdf_and_text
FROM (SELECT queue_id, kinds, unnest(range(1, len(kinds) + 1)) AS pos
      FROM (SELECT o_orderkey AS queue_id,
                   string_split(lower(CASE o_orderkey % 7 WHEN 0 THEN 'PDF' WHEN 1 THEN 'PDF-TEXT' WHEN 2 THEN 'PDF-XML'
                     WHEN 3 THEN 'PDF-TEXT-XML' WHEN 4 THEN 'TEXT' WHEN 5 THEN 'TEXT-XML' ELSE 'XML' END), '-') AS kinds
            FROM orders))""")
def wanted_outputs(spark, sf_dir):
    """output-type text per request -> wanted kinds in order."""
    o = T.table(spark, sf_dir, "orders")
    ot = F.element_at(F.array(*[F.lit(t) for t in OUTPUT_TYPES]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    x = flt.wanted_outputs(o.select(F.col("o_orderkey").alias("queue_id"), ot.alias("output_type")))
    return x.select("queue_id", F.col("kind_pos").cast("int").alias("kind_pos"), "kind", "pdf_and_text")


@job("run_status_log", f"""
SELECT doc_id, page_no, status,
       '[{RUN_TS}][' || CASE status WHEN 1 THEN 'SUCCESS' WHEN 0 THEN 'BLANK' ELSE 'ERROR' END || '][]: out/' ||
       CAST(doc_id AS VARCHAR) || '_' || lpad(CAST(page_no AS VARCHAR), 6, '0') || '.txt' AS line
FROM (SELECT doc_id, page_no,
             CASE WHEN text IS NULL THEN -1 WHEN regexp_replace(text, '{WS}', '', 'g') = '' THEN 0 ELSE 1 END AS status
      FROM v_page_text)""", ("v_page_text",))
def run_status_log(spark, sf_dir):
    """C21 + K3: result code per page output and its run-log line."""
    pt = T.page_text(spark, sf_dir)
    st = codes.run_status(F.col("text").isNotNull(), F.coalesce(F.col("text"), F.lit("")))
    x = pt.select("doc_id", "page_no", st.alias("status"))
    path = F.concat(F.lit("out/"), paths.page_file_name(F.col("doc_id").cast("string"), "page_no", "txt"))
    return x.select("doc_id", "page_no", "status",
                    codes.log_line(F.lit(RUN_TS), F.col("status"), F.lit(None), path).alias("line"))


@job("random_key")
def random_key(spark, sf_dir):
    """A fresh random key per user (a new one on each run)."""
    return T.users(spark, sf_dir).select("id", codes.random_key().alias("activation_key"))
