"""The ``opN_*`` queries: each operator with its production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import best_fit_packing
    return best_fit_packing(documents(spark, sf_dir)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op9_token_output")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import shared_folder
    from .token_files import read_token_files, write_token_files
    path = shared_folder(spark, "token_files")
    write_token_files(documents(spark, sf_dir), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


_OP7_SQL = r"""
WITH words AS (
  SELECT kind, id, w FROM (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark)),
items AS (SELECT DISTINCT id AS item_id, least(len(w), 10) AS k,
    array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM words WHERE kind = 'b' AND len(w) > 0)),
lens AS (SELECT DISTINCT k FROM items),
occ AS (SELECT d.id, d.s, i.k, i.item_id
  FROM (SELECT id, k, s, array_to_string(w[s:s + k - 1], ' ') AS win
        FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM words, lens WHERE kind = 'd' AND len(w) >= k)) d
  JOIN items i ON i.k = d.k AND i.win = d.win),
hit AS (SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest(range(s, s + k)) AS p FROM occ) GROUP BY id),
ids AS (SELECT id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS l
  FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS x FROM occ) GROUP BY id)
SELECT w.id AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(ids.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids.l, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit ON hit.id = w.id LEFT JOIN ids ON ids.id = w.id WHERE w.kind = 'd'
"""


@query("op7_decontamination", _OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import find_contamination
    found = find_contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


_OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
c AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(list_aggregate(w, 'string_agg', '')), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(length(t) - length(translate(t, '!#*$%&|<>{}[]^~=_\', '')) AS BIGINT) AS n_marks,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: list_contains([STOP_WORDS], lower(x)))) AS n_stop, len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*[-*•‣◦]'))) AS n_bul,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) AS n_ell
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2 AND 14 AND n_symbols / n_words <= 0.25 AND n_marks / n_words <= 0.35
  AND n_stop / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.3 AND n_bul / n_lines <= 0.9 AND n_ell / n_lines <= 0.3 AS kept
FROM b
"""


def _op3_sql() -> str:
    from .quality_rules import STOP_WORDS
    return _OP3_SQL.replace("STOP_WORDS", ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS)))


@query("op3_quality_rules", _op3_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import MIN_WORDS, measures, verdict
    m = F.col("quality").getField
    base_failed = (m("n_words") < MIN_WORDS) | (100 * m("n_repeat_words") > 50 * m("n_words"))
    return measures(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", *[m(c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed.alias("base_failed"), (~base_failed & verdict()).alias("kept"))


_OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) > 1)
  UNION ALL SELECT doc_id, w[1] FROM w WHERE len(w) = 1),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT a, b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM s p JOIN s q ON p.x = q.x AND p.doc_id <> q.doc_id
    GROUP BY ALL) z JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id,
  w.doc_id = min(reach.b) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id
"""


@query("op2_minhash_near_dedup", _OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates
    return near_duplicates(documents(spark, sf_dir), words=2, percent=80)


@query("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines
    docs = documents(spark, sf_dir).select("doc_id", "text", F.col("text").alias("before"))
    n_lines = lambda c: F.when(F.length(c) > 0, F.length(c) - F.length(F.translate(c, "\n", "")) + 1).otherwise(0)
    return dedup_lines(docs).select(
        "doc_id", n_lines(F.col("before")).cast("long").alias("n_lines"), n_lines(F.col("text")).cast("long").alias("n_kept"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import quality_scores
    return quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity_scores
    return toxicity_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op6_html_extraction")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extraction import extract
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", F.col("main_text").alias("text"),
                                 F.length("main_text").cast("long").alias("n_chars"))


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import cut
    return cut(documents(spark, sf_dir))


_CRC32_SQL = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(TEXT, ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, d: list_reduce(list_concat([xor(c, d)], [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda e, z: xor(e >> 1, 3988292384 * (e & 1)))))"""

_OP11_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, F(doc_id) || F(source) || F(lang) AS head, n_chars, F(text) AS tail,
    CASE WHEN doc_id IS NULL THEN false ELSE CRC % 7 = 0 END AS tampered FROM documents),
l AS (SELECT *, sha256(head || F(n_chars) || tail) AS leaf, sha256(head || F(n_chars + tampered::INT) || tail) AS changed FROM d),
-- a forest climbed node by node: tree 0 is that of a part, tree 1 the one over the parts
t0 AS (SELECT 0 AS lev, coalesce('1' || lang, '0') AS part, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k,
    count(*) OVER (PARTITION BY lang) AS n, leaf AS h FROM l),
up0 AS (SELECT * FROM t0 UNION ALL
  SELECT DISTINCT lev + 1, part, k // 2, (n + 1) // 2,
    sha256(string_agg(h, '' ORDER BY k) OVER (PARTITION BY part, k // 2 ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  FROM up0 WHERE n > 1),
s AS (SELECT part, h AS subroot, lev AS height FROM up0 WHERE n = 1),
t1 AS (SELECT 0 AS lev, row_number() OVER (ORDER BY part) - 1 AS k, count(*) OVER () AS n, subroot AS h FROM s),
up1 AS (SELECT * FROM t1 UNION ALL
  SELECT DISTINCT lev + 1, k // 2, (n + 1) // 2,
    sha256(string_agg(h, '' ORDER BY k) OVER (PARTITION BY k // 2 ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  FROM up1 WHERE n > 1),
root AS (SELECT h AS root FROM up1 WHERE n = 1),
p AS (SELECT part, subroot, height, row_number() OVER (ORDER BY part) - 1 AS place FROM s),
place AS (SELECT l.*, coalesce('1' || lang, '0') AS part, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM l),
-- the siblings of a row's nodes, lowest first, and the fold of the changed leaf
nodes AS (SELECT 0 AS tree, part, lev, k, n, h FROM up0 UNION ALL SELECT 1, '', lev, k, n, h FROM up1),
fold AS (
  SELECT r, 0 AS tree, 0 AS lev, part AS own, k, CASE WHEN tampered THEN changed ELSE leaf END AS h, '' AS proof, false AS done FROM place
  UNION ALL
  SELECT f.r, CASE WHEN a.n > 1 THEN f.tree ELSE f.tree + 1 END, CASE WHEN a.n > 1 THEN f.lev + 1 ELSE 0 END, f.own,
    CASE WHEN a.n > 1 THEN f.k // 2 ELSE p.place END,
    CASE WHEN a.n > 1 THEN CASE WHEN b.h IS NULL THEN sha256(f.h) WHEN f.k % 2 = 0 THEN sha256(f.h || b.h) ELSE sha256(b.h || f.h) END ELSE f.h END,
    CASE WHEN a.n > 1 THEN f.proof || coalesce(b.h, '') ELSE f.proof END, f.tree = 1 AND a.n = 1
  FROM fold f JOIN p ON p.part = f.own
  JOIN nodes a ON a.tree = f.tree AND a.part = CASE WHEN f.tree = 0 THEN f.own ELSE '' END AND a.lev = f.lev AND a.k = f.k
  LEFT JOIN nodes b ON b.tree = a.tree AND b.part = a.part AND b.lev = a.lev AND b.k = xor(a.k, 1)
  WHERE NOT f.done)
SELECT place.doc_id, place.leaf, p.subroot, root.root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = root.root AS verified
FROM place JOIN p ON p.part = place.part JOIN fold f ON f.r = place.r AND f.done, root
"""


def _op11_sql() -> str:
    import re
    value = lambda m: f"coalesce(strlen(CAST({m[1]} AS VARCHAR)) || ':' || {m[1]}, '-')"
    crc = _CRC32_SQL.replace("TEXT", "CAST(doc_id AS VARCHAR)")
    return re.sub(r"\bF\(([^)]*)\)", value, _OP11_SQL).replace("CRC", crc)


@query("op11_merkle_manifest", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import FIELDS, folded, leaf_digest, manifest, proof_digest
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    changed = leaf_digest([F.col(c) + F.when(tampered, 1).otherwise(0) if c == "n_chars" else F.col(c) for c in FIELDS])
    rows = manifest(documents(spark, sf_dir), carry={"changed": F.when(tampered, changed)})
    out = rows.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"),
                      folded(F.coalesce("changed", "leaf")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_OP13_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT r, part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
    {'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w),
     'C': 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t), 'D': regexp_matches(t, '[#$%&*|]'),
     'E': coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)} AS fails
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
fails AS (SELECT r, part, good, toxic, x, CASE x WHEN 'A' THEN fails.A WHEN 'B' THEN fails.B WHEN 'C' THEN fails.C
    WHEN 'D' THEN fails.D ELSE fails.E END AS fail, list_sum([fails.A::INT, fails.B::INT, fails.C::INT, fails.D::INT, fails.E::INT]) AS n FROM f, letters),
firsts AS (SELECT r, o, min(strpos(o, x)) FILTER (WHERE fail) AS gone FROM fails, orders GROUP BY r, o),
rows_ AS (SELECT fails.part, firsts.o AS filter_order, strpos(firsts.o, x) AS step, x, good, toxic, n, fail, gone
  FROM fails JOIN firsts ON firsts.r = fails.r),
steps AS (SELECT part, filter_order, step, x, count(*) FILTER (WHERE gone IS NULL OR gone > step) AS kept,
    count(*) FILTER (WHERE gone = step) AS removed, count(*) FILTER (WHERE fail AND gone < step) AS redundant,
    count(*) FILTER (WHERE fail AND n = 1) AS unique_fails, count(*) FILTER (WHERE gone = step AND good) AS good_lost,
    count(*) FILTER (WHERE gone = step AND toxic) AS toxic_lost FROM rows_ GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM steps
"""


@query("op13_filter_audit", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .survival import filter_audit
    return filter_audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op12_nearest_neighbours")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .cross_polytope import nearest_neighbours
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
