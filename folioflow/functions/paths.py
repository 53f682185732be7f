"""Path and file-name column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import slugify


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def base_name(path: str | Column) -> Column:
    """Last path component."""
    return F.substring_index(_c(path), "/", -1)


def dir_name(path: str | Column) -> Column:
    """Everything before the last ``/`` ('' when there is none)."""
    p = _c(path)
    return F.when(F.instr(p, "/") > 0, F.regexp_replace(p, "/[^/]*$", "")).otherwise(F.lit(""))


def file_stem(path: str | Column) -> Column:
    """Base name cut at the last ``.pdf`` (``a.pdf.pdf`` -> ``a.pdf``, ``x.pdfx`` -> ``x``).

    The match is case-sensitive: ``a.PDF`` keeps its name.
    """
    return F.regexp_replace(base_name(path), "(?s)^(.*)[.]pdf.*$", "$1")


def sub_dir(path: str | Column, root: str) -> Column:
    """C4: folder of ``path`` below the crawl ``root``, with ``/`` trimmed at both ends."""
    d = dir_name(path)
    after = F.when(F.instr(d, F.lit(root)) > 0,
                   F.substring(d, F.instr(d, F.lit(root)) + F.lit(len(root)), F.lit(1 << 30))).otherwise(F.lit(""))
    return F.regexp_replace(after, "^/+|/+$", "")


def page_file_name(stem: str | Column, page_no: str | Column, ext: str | Column) -> Column:
    """``{stem}_{page as 6 digits}.{ext}`` (``ext`` given as text is a literal)."""
    e = F.lit(ext) if isinstance(ext, str) else ext
    return F.format_string("%s_%06d.%s", _c(stem), _c(page_no).cast("int"), e)


def target_dir(target: str, sub: str | Column) -> Column:
    """Output folder mirroring the input sub-folder."""
    s = _c(sub)
    return F.when(s == "", F.lit(target)).otherwise(F.concat(F.lit(target + "/"), s))


def temp_dir(target: str, sub: str | Column, stem: str | Column) -> Column:
    """Scratch folder for page images: ``target[/sub]/slug(stem)/tmp_dir``."""
    return F.concat(target_dir(target, sub), F.lit("/"), slugify(_c(stem)), F.lit("/tmp_dir"))


def renumber_xml_page(xml: str | Column, page_no: str | Column, temp_image: str | Column,
                      source_path: str | Column) -> Column:
    """Page XML gets ``no="{page-1}"``; page 1 also points at the source file."""
    p = _c(page_no).cast("int")
    x = F.replace(_c(xml), F.lit('no="0"'), F.concat(F.lit('no="'), (p - 1).cast("string"), F.lit('"')))
    return F.when(p == 1, F.replace(x, _c(temp_image), _c(source_path))).otherwise(x)
