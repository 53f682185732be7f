"""Projections, filters and predicates.

Each function is DataFrame -> DataFrame (or returns a Column) and uses only
built-in expressions, so predicates reach the parquet scan and stay inside
whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the source system.
TRIGGER_MESSAGE = "pdf process request"   # F1: the queue body that wakes a worker
DEFAULT_PRIORITY = 3                      # F3
MAX_PAGE_WIDTH = 1800.0                   # F10: points
OVERSIZE_IMAGE = "temp/oops/dummy.png"    # F10: placeholder image path
AVATAR_EXTENSIONS = ["png", "jpg", "jpeg", "gif"]  # F17
MIN_IMAGE_BYTES_SERVICE = 12              # F21
MIN_IMAGE_BYTES_TOOL = 20                 # F21
# F16: field limits
NAME_MIN, NAME_MAX = 4, 25
EMAIL_MIN, EMAIL_MAX = 2, 50
PASSWORD_MIN, PASSWORD_MAX = 6, 16
PHONE_MAX, LOCATION_MAX, BIO_MAX = 64, 64, 1024
EMAIL_PATTERN = "^.+@[^.@][^@]+$"
URL_PATTERN = "(?i)^[a-z]+://[^/:]+[.][^/:]+(:[0-9]+)?(/.*)?$"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def wake_messages(msgs: DataFrame, trigger: str = TRIGGER_MESSAGE, col: str = "value") -> DataFrame:
    """keep messages whose body equals the trigger text."""
    return msgs.where(F.col(col) == F.lit(trigger))


def flag_true(x: str | Column, default: str | None = None) -> Column:
    """``'t'`` means true; a missing value takes ``default``."""
    v = _c(x) if default is None else F.coalesce(_c(x), F.lit(default))
    return F.coalesce(v == F.lit("t"), F.lit(False))


def decode_flags(queue: DataFrame) -> DataFrame:
    """F2 + F3: boolean flags and default priority on queue records.

    keep_barcode defaults to true, is_bulk to false, deliver_searchable is
    ``'t'``; has_interactive is ``'t'`` (the source treated any non-empty
    text as true, so ``'f'`` counted as interactive; fixed here).
    """
    return queue.select(
        "*",
        flag_true("keep_barcode_ind", "t").alias("keep_barcode"),
        flag_true("is_bulk").alias("bulk"),
        flag_true("deliver_searchable_pdf").alias("deliver_searchable"),
        flag_true("has_interactive").alias("interactive"),
        F.coalesce(F.col("priority"), F.lit(DEFAULT_PRIORITY)).cast("int").alias("priority_id"),
    )


def needs_search_file(use_sphinx: str | Column, sphinx_db: str | Column) -> Column:
    """``(use_sphinx and sphinx_db == 0) or sphinx_db == 1``, nulls as false."""
    us = F.coalesce(_c(use_sphinx).cast("boolean"), F.lit(False))
    db = _c(sphinx_db)
    return F.coalesce((us & (db == 0)) | (db == 1), F.lit(False))


def split_bulk(queue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bulk, non_bulk) records."""
    bulk = flag_true("is_bulk")
    return queue.where(bulk), queue.where(~bulk)


def route_record(records: DataFrame) -> DataFrame:
    """non-bulk road per record (needs decode_flags + have_sphinx).

    ``ocr`` when a searchable PDF is wanted and the record is not
    interactive; otherwise ``split`` (flattened when interactive).  Text is
    extracted only on the split road when a search file is wanted; page
    images at full size are needed on the ocr road or for a search file.
    """
    ocr = F.col("deliver_searchable") & ~F.col("interactive")
    return records.select(
        "*",
        F.when(ocr, F.lit("ocr")).otherwise(F.lit("split")).alias("route"),
        (~ocr & F.col("interactive")).alias("flatten"),
        (~ocr & F.col("have_sphinx")).alias("extract_text"),
        (ocr | F.col("have_sphinx")).alias("need_temp_image"),
    )


def route_file(files: DataFrame, done: Column, ocr_all: bool = False) -> DataFrame:
    """folder-tool road per file: unreadable, done, ocr_whole, ocr_pages or pass_through.

    ``files`` needs num_pages and code (C1); ``done`` is the J3/J4 result.
    """
    r = (F.when(F.coalesce(F.col("num_pages"), F.lit(0)) == 0, F.lit("unreadable"))
          .when(done, F.lit("done"))
          .when(F.lit(ocr_all), F.lit("ocr_whole"))
          .when(F.col("code") == 0, F.lit("ocr_pages"))
          .otherwise(F.lit("pass_through")))
    return files.withColumn("route", r)


def valid_barcode(barcode: str | Column, prefix: str = "NEU_", min_len: int = 5) -> Column:
    """F8: non-empty, at least ``min_len`` long, contains ``prefix`` (``instr``: ``_`` is literal)."""
    b = _c(barcode)
    return b.isNotNull() & (F.length(b) >= min_len) & (F.instr(b, prefix) > 0)


def valid_barcodes(pages: DataFrame, prefix: str = "NEU_", min_len: int = 5) -> DataFrame:
    return pages.where(valid_barcode("barcode", prefix, min_len))


def has_colour(ink: str | Column, threshold: float = 0.0) -> Column:
    """C, M or Y above the threshold (strict), K ignored."""
    i = _c(ink)
    t = F.lit(threshold)
    return F.coalesce((i[0] > t) | (i[1] > t) | (i[2] > t), F.lit(False))


def color_pages(ink: DataFrame, threshold: float = 0.0, page_col: str = "page_no") -> DataFrame:
    """pages with colour (doc_id, page)."""
    return ink.where(has_colour("ink", threshold)).select("doc_id", page_col)


def oversized_pages(pages: DataFrame, max_width: float = MAX_PAGE_WIDTH,
                    placeholder: str = OVERSIZE_IMAGE) -> DataFrame:
    """image paths per page; pages wider than ``max_width`` get the placeholder.

    Every oversized page is replaced (the source replaced only the first).
    Unreadable width counts as 0.
    """
    w = F.coalesce(F.col("width"), F.lit(0.0))
    over = w > F.lit(max_width)
    stem = F.col("doc_id").cast("string")
    png = F.format_string("png/%s_%06d.png", stem, F.col("page_no"))
    thumb = F.format_string("thumbs/%s_%06d.png", stem, F.col("page_no"))
    return pages.select("doc_id", "page_no", over.alias("oversized"),
                        F.when(over, F.lit(placeholder)).otherwise(png).alias("png_path"),
                        F.when(over, F.lit(placeholder)).otherwise(thumb).alias("thumb_path"))


def upside_down_pages(orient: DataFrame) -> DataFrame:
    """pages reported at 180 degrees (other angles are left alone)."""
    return orient.where(F.col("degrees") == 180).select("doc_id", "page_no", F.lit(180).alias("rotate"))


def wanted_kinds(output_type: str | Column) -> Column:
    """``PDF-TEXT-XML`` style list -> array of output extensions (``text`` -> ``txt``)."""
    parts = F.split(F.lower(_c(output_type)), "-")
    return F.transform(parts, lambda k: F.when(k == "text", F.lit("txt")).otherwise(k))


def wanted_outputs(requests: DataFrame, col: str = "output_type") -> DataFrame:
    """one row per wanted kind with its position, plus the combined PDF+text flag."""
    kinds = wanted_kinds(col)
    x = requests.select("*", F.posexplode(kinds).alias("kind_pos", "kind"))
    return x.withColumn("pdf_and_text", F.array_contains(kinds, "pdf") & F.array_contains(kinds, "txt"))


def user_by_id(users: DataFrame, user_id: int) -> DataFrame:
    """the row with this id (empty when missing: the caller decides)."""
    return users.where(F.col("id") == F.lit(user_id))


def search_users(users: DataFrame, keywords: str) -> DataFrame:
    """every whitespace-separated word matches name or email, anywhere, any case.

    ``%`` and ``_`` in a word act as wildcards (``ilike``).  No words returns
    every row (the source raised an error).
    """
    words = keywords.split()
    if not words:
        return users
    conds = [F.col("name").ilike(f"%{w}%") | F.col("email").ilike(f"%{w}%") for w in words]
    return users.where(reduce(lambda a, b: a & b, conds))


#: parts that the users of one keyword set are dealt over when its searches are joined
SEARCH_PARTS = 16


def _grams(text: Column) -> Column:
    """All distinct runs of one to three characters of a text, and the empty one."""
    cut = lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (k - 1), F.lit(1))),
                                lambda i: F.substring(text, i, F.lit(k)))
    return F.array_distinct(F.concat(F.array(F.lit("")), cut(1), cut(2), cut(3)))


def search_many(users: DataFrame, searches: DataFrame) -> DataFrame:
    """F14 for a table of searches (search_id, keywords): search_id and the columns of each user that it finds.

    A user that matches a word holds all its runs of three characters (of a
    shorter literal part the whole).  Equal keyword sets are searched once; each
    set meets only the users of its rarest run, which are then verified by
    ``ilike`` on all words; a set without any literal character meets all users,
    whom it matches.  The searches of a set are joined to its verified users last.
    """
    words = F.filter(F.split("keywords", r"\s+"), lambda w: w != "")
    asked = searches.select("search_id", words.alias("words")).distinct()
    sets = asked.select("words").distinct()
    # the literal parts of a word stand between wildcards (and escapes)
    parts = F.flatten(F.transform("words", lambda w: F.split(F.lower(w), r"[%_]|\\.?")))
    runs = F.flatten(F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.when(F.length(p) < 3, F.array(p)).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(p) - 2, F.lit(1))), lambda i: F.substring(p, i, F.lit(3))))))
    wanted = sets.select("words", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), runs))).alias("gram"))
    both = F.concat(_grams(F.lower(F.coalesce("name", F.lit("")))), _grams(F.lower(F.coalesce("email", F.lit("")))))
    # users often come in one small file; their runs, and then their rows, are spread over tasks by id
    tasks = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = users.repartition(tasks, "id")
    postings = spread.select("id", F.explode(F.array_distinct(both)).alias("gram")).join(wanted.select("gram").distinct(), "gram", "left_semi")
    counts = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = wanted.join(counts, "gram", "left").groupBy("words").agg(F.min_by("gram", F.struct(
        F.coalesce("n", F.lit(0)).alias("n"), (-F.length("gram")).alias("k"))).alias("gram"))
    found = rarest.join(postings, "gram").select("words", "id").repartition(tasks, "id")
    verified = F.expr("forall(words, w -> coalesce(name ILIKE concat('%', w, '%'), false) OR coalesce(email ILIKE concat('%', w, '%'), false))")
    matched = found.join(spread.hint("merge"), "id").where(verified).withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(SEARCH_PARTS)))
    # few sets with many searches each make most of the result: the users of a set are spread over parts.  Spark takes the
    # copies for as small as the file that the searches come from and would send them all through the driver
    parted = asked.select("search_id", "words", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SEARCH_PARTS - 1).cast("long"))).alias("_part"))
    return matched.join(parted.repartition(tasks, "words", "_part").hint("merge"), ["words", "_part"]).select("search_id", *users.columns)


def admins(users: DataFrame) -> DataFrame:
    """users whose role code is 0."""
    return users.where(F.col("role_code") == 0)


def _len_between(x: Column, lo: int | None, hi: int | None) -> Column:
    n = F.length(x)
    c = F.lit(True)
    if lo is not None:
        c = c & (n >= lo)
    if hi is not None:
        c = c & (n <= hi)
    return c


def validate_users(cands: DataFrame) -> DataFrame:
    """F16: sign-up / profile rule check; adds ``errors`` array<string> (empty = valid).

    Columns used when present: name, email, password, password_again,
    phone, url, location, bio, agree.
    """
    cols = set(cands.columns)
    checks: list[Column] = []

    def req(c: str) -> Column:
        return F.col(c).isNull() | (F.length(F.col(c)) == 0)

    def err(cond: Column, msg: str) -> Column:
        return F.when(cond, F.lit(msg))

    if "name" in cols:
        checks += [err(req("name"), "name required"),
                   err(~req("name") & ~_len_between(F.col("name"), NAME_MIN, NAME_MAX), "name length")]
    if "email" in cols:
        checks += [err(req("email"), "email required"),
                   err(~req("email") & ~F.col("email").rlike(EMAIL_PATTERN), "email invalid"),
                   err(~req("email") & ~_len_between(F.col("email"), EMAIL_MIN, EMAIL_MAX), "email length")]
    if "password" in cols:
        checks += [err(req("password"), "password required"),
                   err(~req("password") & ~_len_between(F.col("password"), PASSWORD_MIN, PASSWORD_MAX),
                       "password length")]
    if "password_again" in cols and "password" in cols:
        checks += [err(~F.col("password_again").eqNullSafe(F.col("password")), "passwords differ")]
    if "phone" in cols:
        checks += [err(req("phone"), "phone required"),
                   err(~_len_between(F.col("phone"), None, PHONE_MAX), "phone length")]
    if "url" in cols:
        checks += [err(~req("url") & ~F.col("url").rlike(URL_PATTERN), "url invalid")]
    if "location" in cols:
        checks += [err(~_len_between(F.coalesce(F.col("location"), F.lit("")), None, LOCATION_MAX),
                       "location length")]
    if "bio" in cols:
        checks += [err(~_len_between(F.coalesce(F.col("bio"), F.lit("")), None, BIO_MAX), "bio length")]
    if "agree" in cols:
        checks += [err(~F.coalesce(F.col("agree"), F.lit(False)), "terms not agreed")]
    errors = F.filter(F.array(*checks), lambda e: e.isNotNull()) if checks else F.array().cast("array<string>")
    return cands.withColumn("errors", errors)


def avatar_allowed(name: str | Column) -> Column:
    """has a dot and the last extension is an allowed image type (case-sensitive)."""
    n = _c(name)
    return F.coalesce((F.instr(n, ".") > 0) & F.substring_index(n, ".", -1).isin(*AVATAR_EXTENSIONS),
                      F.lit(False))


def drop_source_document(artifacts: DataFrame, source_col: str = "source_path",
                         path_col: str = "path") -> DataFrame:
    """artifact paths other than the original document."""
    return artifacts.where(~F.col(path_col).eqNullSafe(F.col(source_col)))


def needs_page_list(state: DataFrame) -> DataFrame:
    """saved jobs whose page list was not registered (flag missing or ``'f'``)."""
    return state.where(F.coalesce(F.col("add_pages"), F.lit("f")) == "f")


def suspect_small_files(files: DataFrame, min_len: int = MIN_IMAGE_BYTES_SERVICE,
                        length_col: str = "length") -> DataFrame:
    """image files too small to be complete (not ready yet)."""
    return files.where(F.col(length_col) < min_len)
