"""Text column functions.

All are built from JVM-side expressions (``regexp_replace``, ``length``,
``split``, ``transform``, ...): no Python runs per row.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whitespace set of the source runtime's str.strip(): space, \t, \n, \v, \f, \r.
# Written out so both Java regex and RE2 read it the same way.
WS = "[\\t\\n\\x0B\\f\\r ]"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(x: str | Column) -> Column:
    """Remove all leading and trailing whitespace (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(x), f"^{WS}+|{WS}+$", "")


def rstrip_ws(x: str | Column) -> Column:
    """Remove trailing whitespace (used for barcode text, rule 8 of W4)."""
    return F.regexp_replace(_c(x), f"{WS}+$", "")


def searchable_code(text: str | Column, max_junk_share: float = 0.5) -> Column:
    """1 when the text is usable as is, 0 when it needs recognition.

    Runs of non-letters followed by one space become ``@``; spaces are
    removed; an all-blank rest gives 0; a share of ``@`` above
    ``max_junk_share`` gives 0 (a literal ``@`` in the text counts too).
    """
    t = F.replace(F.regexp_replace(F.coalesce(_c(text), F.lit("")), "[^A-Za-z ]+ ", "@"), F.lit(" "), F.lit(""))
    blank = ~t.rlike(f"[^\\t\\n\\x0B\\f\\r ]")
    n_at = F.length(t) - F.length(F.replace(t, F.lit("@"), F.lit("")))
    junk = F.when(F.length(t) > 0, (n_at / F.length(t)) > F.lit(max_junk_share))
    return F.when(blank, F.lit(0)).when(junk, F.lit(0)).otherwise(F.lit(1))


def classify_searchable(docs: DataFrame, text_col: str = "text", max_junk_share: float = 0.5) -> DataFrame:
    """C1 over a table: (doc_id, code, text) with text trimmed for code 1 and '' for code 0."""
    code = searchable_code(text_col, max_junk_share)
    return docs.select("doc_id", code.alias("code"),
                       F.when(code == 1, strip_ws(text_col)).otherwise(F.lit("")).alias("text"))


def search_document(text: str | Column) -> Column:
    """Page text as a search-index document (newlines to spaces, fixed header tags)."""
    body = F.replace(F.coalesce(_c(text), F.lit("")), F.lit("\n"), F.lit(" "))
    return F.concat(F.lit("<h1></h1><h2></h2><h3></h3><h4>"), body, F.lit("</h4>"))


def numeric_tokens(line: str | Column) -> Column:
    """C11: space-separated tokens that parse as a number, as array<double>."""
    toks = F.split(_c(line), " ")
    return F.transform(F.filter(toks, lambda t: t.try_cast("double").isNotNull()),
                       lambda t: t.try_cast("double"))


# HTML escapes applied by the template filter, in this order.
HTML_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;")]


def html_escape(x: str | Column) -> Column:
    out = _c(x)
    for a, b in HTML_ESCAPES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def nl2br(text: str | Column) -> Column:
    """Paragraphs in ``<p>``, single line breaks as ``<br>``; null or '' gives ''.

    The text is trimmed and HTML-escaped, split at runs of two or more line
    breaks (CRLF, CR or LF), ``\\n`` inside a paragraph becomes ``<br>\\n``,
    paragraphs are joined with a blank line.
    """
    t = _c(text)
    esc = html_escape(strip_ws(t))
    paras = F.split(esc, "(?:\\r\\n|\\r|\\n){2,}")
    html = F.array_join(F.transform(paras, lambda p: F.concat(F.lit("<p>"), F.replace(p, F.lit("\n"), F.lit("<br>\n")),
                                                              F.lit("</p>"))), "\n\n")
    return F.when(t.isNull() | (t == ""), F.lit("")).otherwise(html)


# Letters that no decomposition turns into ASCII, lower case.
SPELLED = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ı": "i", "ħ": "h", "ŋ": "ng"}
CYRILLIC = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґ", (
    "a b v g d e e zh z i i k l m n o p r s t u f kh ts ch sh shch  y  e iu ia i i ie g").split(" ")))
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a b g d e z e th i k l m n x o p r s s t y ph ch ps o".split(" ")))


def _folded_letters() -> tuple[str, str, dict[str, str]]:
    """Lower-case letters with a one-letter ASCII form, those forms, and the letters spelled otherwise."""
    spelled = {**SPELLED, **CYRILLIC, **GREEK}
    one = {}
    for code in (*range(0xE0, 0x250), *range(0x370, 0x460), *range(0x1E00, 0x2000)):
        c = chr(code)
        base = unicodedata.normalize("NFKD", c)[0]
        base = spelled.get(base, base)
        if c.islower() and c not in spelled and base != c and base.isascii() and base.isalpha():
            one[c] = base
    one |= {k: v for k, v in spelled.items() if len(v) == 1}
    one = {k: v for k, v in one.items() if len(v) == 1}
    return "".join(one), "".join(one.values()), {k: v for k, v in spelled.items() if len(v) != 1}


ACCENTED, FOLDED, SPELLED_OUT = _folded_letters()


def slugify(x: str | Column) -> Column:
    """Lower-case, fold letters to ASCII, runs of other characters to ``-``, trim ``-``.

    Latin letters lose their marks, Cyrillic and Greek ones are spelled in
    Latin.  A text of other scripts alone gets ``x-`` and eight digits of its
    md5, so that different names keep different slugs.
    """
    text = _c(x)
    low = F.translate(F.lower(text), ACCENTED, FOLDED)
    # the rarer letters of several letters, only where there is one
    spelled = low
    for letter, spelling in SPELLED_OUT.items():
        spelled = F.replace(spelled, F.lit(letter), F.lit(spelling))
    low = F.when(low.rlike("[" + "".join(SPELLED_OUT) + "]"), spelled).otherwise(low)
    dashed = F.regexp_replace(F.regexp_replace(low, "'+", ""), "[^a-z0-9]+", "-")
    slug = F.regexp_replace(dashed, "^-+|-+$", "")
    return F.when((slug == "") & (text != ""), F.concat(F.lit("x-"), F.left(F.md5(text.cast("binary")), F.lit(8)))).otherwise(slug)
