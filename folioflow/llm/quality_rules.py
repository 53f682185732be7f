"""Quality rules: a table of thresholds compiled into one Spark projection.

``RULES`` names a measure, its lowest and highest accepted value.  ``measures``
computes every measure of a text with built-in functions only, ``verdict``
turns the table into one boolean expression.  There is no shuffle and no user
function; a document is judged on its own row.

Words are runs of characters other than space and ``\\t``-``\\r``.  Defined cases:
a null text counts as empty; a text without words has ratio 0 for every
measure and fails the length rule; repeated rows are judged alike; an empty
table gives an empty result; other columns of the input are kept by ``judge``
and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: frequent function words of English, German, French and Spanish
STOP_WORDS = (
    "the of and to in is that for it with as was on be at by this have from or an are not but "
    "der die das und ist in den von zu mit sich des auf für nicht ein eine als auch im dem "
    "le la les de des du et est en un une que qui dans pour pas sur au par avec "
    "el los las y en que por con una para se del al lo como su no es").split()

#: fixed values: characters that count as symbols, and those that mark shouting, tables and markup
SYMBOLS = "#*$%&|<>"
MARKS = "!#*$%&|<>{}[]^~=_\\"

MIN_WORDS = 50

#: (measure, lowest, highest accepted value)
RULES: list[tuple[str, float | None, float | None]] = [
    ("n_words", MIN_WORDS, None),
    ("repeat_word_ratio", None, 0.5),
    ("mean_word_length", 2.0, 14.0),
    ("symbol_ratio", None, 0.25),
    ("mark_ratio", None, 0.35),
    ("stop_word_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.3),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.3),
]

_SPACE = "[ \\t\\n\\x0B\\f\\r]"


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measures(docs: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with all measures of ``text`` in the struct column ``into`` (an old column of this name is replaced)."""
    docs = docs.drop(into)
    # the row travels as one struct, so no column of the input can clash with the steps
    one = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    t = F.col("_t")
    # each step is used several times by the next one, so the optimiser keeps it as a column of its own
    one = one.withColumn("_w", F.filter(F.split(t, _SPACE + "+", -1), lambda w: w != ""))
    one = one.withColumn("_l", F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]")))
    n = F.size("_w")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i"))))
    two = one.withColumn("_s", F.sort_array(F.coalesce(windows, F.array().cast("array<struct<h:bigint,i:int>>"))))
    again = F.filter("_s", lambda x, k: F.coalesce(x["h"] == F.get("_s", k - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get("_s", k + 1)["h"], F.lit(False)))
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    n_lines = F.size("_l")
    three = two.select("_row", F.struct(*[v.alias(k) for k, v in {
        "n_words": n.cast("long"),
        "word_chars": (F.length(t) - _count_chars(t, " \t\n\x0b\x0c\r")).cast("long"),
        "n_symbols": _count_chars(t, SYMBOLS).cast("long"),
        "n_marks": _count_chars(t, MARKS).cast("long"),
        "n_dup_lines": (n_lines - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": covered.cast("long"),
        "n_stop_words": F.size(F.filter("_w", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
        "n_lines": n_lines.cast("long"),
        "n_bullets": F.size(F.filter("_l", lambda x: x.rlike("^[ \\t]*[-*•‣◦]"))).cast("long"),
        "n_ellipses": F.size(F.filter("_l", lambda x: x.rlike("(\\.\\.\\.|…)[ \\t\\r]*$"))).cast("long"),
    }.items()]).alias("_c"))
    counts = ["n_words", "word_chars", "n_symbols", "n_marks", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines",
              "n_bullets", "n_ellipses"]
    c = F.col("_c").getField
    ratios = {
        "repeat_word_ratio": _ratio(c("n_repeat_words"), c("n_words")),
        "mean_word_length": _ratio(c("word_chars"), c("n_words")),
        "symbol_ratio": _ratio(c("n_symbols"), c("n_words")),
        "mark_ratio": _ratio(c("n_marks"), c("n_words")),
        "stop_word_ratio": _ratio(c("n_stop_words"), c("n_words")),
        "dup_line_ratio": _ratio(c("n_dup_lines"), c("n_lines")),
        "bullet_line_ratio": _ratio(c("n_bullets"), c("n_lines")),
        "ellipsis_line_ratio": _ratio(c("n_ellipses"), c("n_lines")),
    }
    return three.select("_row.*", F.struct(*[c(x).alias(x) for x in counts], *[v.alias(k) for k, v in ratios.items()]).alias(into))


def verdict(rules=None, measured: str = "quality") -> Column:
    """The threshold table as one expression over the struct of measures."""
    out = F.lit(True)
    for name, low, high in rules or RULES:
        value = F.col(measured)[name]
        if low is not None:
            out = out & (value >= low)
        if high is not None:
            out = out & (value <= high)
    return out


def judge(docs: DataFrame, text: str = "text", rules=None) -> DataFrame:
    """``docs`` with ``quality`` (all measures) and ``quality_kept``; existing columns of these names are replaced."""
    return measures(docs.drop("quality_kept"), text).withColumn("quality_kept", verdict(rules))
