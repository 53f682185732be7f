"""The template functions as SQL functions (``pretty_date``, ``format_date``, ``nl2br``).

They are registered as SQL user functions whose bodies are plain Spark SQL
expressions, so they run inside the JVM like any built-in (no Python per row).
The bodies mirror :mod:`folioflow.functions.dates` and :mod:`.text`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_WS = r"[\\t\\n\\x0B\\f\\r ]"

FORMAT_DATE = ("CREATE OR REPLACE TEMPORARY FUNCTION format_date(ts TIMESTAMP) RETURNS STRING RETURN "
               "CASE WHEN ts IS NULL THEN '' ELSE format_string('%4d-%02d-%02d', year(ts), month(ts), day(ts)) END")


def _period(v: str, one: str, many: str) -> str:
    return f"WHEN {v} != 0 THEN format_string('%d %s ago', {v}, CASE WHEN {v} = 1 THEN '{one}' ELSE '{many}' END)"


def _pretty_body() -> str:
    total = "floor(timestampdiff(MICROSECOND, CAST(ts AS TIMESTAMP_NTZ), CAST(now AS TIMESTAMP_NTZ)) / 1000000)"
    days = f"floor({total} / 86400)"
    secs = f"({total} - {days} * 86400)"
    parts = [(f"floor({days} / 365)", "year", "years"), (f"floor({days} / 30)", "month", "months"),
             (f"floor({days} / 7)", "week", "weeks"), (days, "day", "days"),
             (f"floor({secs} / 3600)", "hour", "hours"), (f"floor({secs} / 60)", "minute", "minutes"),
             (secs, "second", "seconds")]
    whens = " ".join(_period(f"CAST({v} AS BIGINT)", a, b) for v, a, b in parts)
    return f"CASE WHEN ts IS NULL THEN NULL {whens} ELSE 'just now' END"


PRETTY_DATE = ("CREATE OR REPLACE TEMPORARY FUNCTION pretty_date(ts TIMESTAMP, now TIMESTAMP) RETURNS STRING RETURN "
               + _pretty_body())

NL2BR = ("CREATE OR REPLACE TEMPORARY FUNCTION nl2br(t STRING) RETURNS STRING RETURN "
         "CASE WHEN t IS NULL OR t = '' THEN '' ELSE array_join(transform(split("
         "replace(replace(replace(replace(replace(regexp_replace(t, '^" + _WS + "+|" + _WS + "+$', ''), "
         "'&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&#34;'), '''', '&#39;'), "
         "'(?:\\\\r\\\\n|\\\\r|\\\\n){2,}'), p -> concat('<p>', replace(p, '\\n', '<br>\\n'), '</p>')), '\\n\\n') END")

ALL = [FORMAT_DATE, PRETTY_DATE, NL2BR]


def register_functions(spark: SparkSession) -> list[str]:
    """Register the template functions for SQL; returns their names."""
    for stmt in ALL:
        spark.sql(stmt)
    return ["format_date", "pretty_date", "nl2br"]
