"""The fixture views of :mod:`folioflow.sources.tables` as DuckDB SQL (oracle side).

Each entry is one CTE body; :func:`with_views` prepends the ones a query uses.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "v_pages": """
SELECT l_orderkey AS doc_id,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) AS INTEGER) AS page_no,
       CASE WHEN l_returnflag = 'R' THEN 'NEU_' || CAST(l_partkey AS VARCHAR)
            WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'NEU' END AS barcode,
       l_extendedprice / 20 AS width,
       l_discount AS ink_c, l_tax AS ink_m, 0.0::DOUBLE AS ink_y, l_quantity / 50 AS ink_k,
       l_returnflag AS returnflag, l_linestatus AS linestatus,
       l_linenumber, l_partkey, l_suppkey, l_quantity
FROM lineitem""",
    "v_counts": """
SELECT doc_id, CAST(count(*) AS INTEGER) AS num_pages FROM v_pages GROUP BY doc_id""",
    "v_page_text": """
SELECT conv_id AS doc_id, CAST(turn + 1 AS INTEGER) AS page_no, text FROM conversations""",
    "v_docs": """
SELECT doc_id, text FROM documents""",
    "v_docs_mangled": """
SELECT doc_id,
       CASE WHEN doc_id % 3 = 0 THEN base || ' a@b' ELSE base END AS text
FROM (SELECT doc_id,
             CASE WHEN doc_id % 7 = 0 THEN ''
                  WHEN doc_id % 5 = 0 THEN regexp_replace(text, '[A-Za-z]', '1', 'g')
                  ELSE text END AS base
      FROM documents)""",
    "v_paragraphs": """
SELECT doc_id, replace(text, '. ', '.' || chr(10) || chr(10)) AS text FROM documents""",
    "v_queue": """
SELECT o_orderkey AS queue_id,
       '/scans/' || CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) || '.pdf' AS path,
       CAST(o_custkey AS VARCHAR) AS box_number,
       CAST(year(o_orderdate) AS VARCHAR) AS box_part,
       CASE WHEN substr(o_orderpriority, 1, 1) <> '5' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS priority,
       CASE WHEN o_orderkey % 3 = 0 THEN 't' WHEN o_orderkey % 3 = 1 THEN 'f' END AS keep_barcode_ind,
       CASE WHEN o_orderstatus = 'F' THEN 't' ELSE 'f' END AS is_bulk,
       CASE WHEN o_orderkey % 2 = 0 THEN 't' ELSE 'f' END AS deliver_searchable_pdf,
       CASE WHEN o_orderkey % 5 = 0 THEN 't' WHEN o_orderkey % 5 = 1 THEN NULL WHEN o_orderkey % 5 = 2 THEN ''
            ELSE 'f' END AS has_interactive,
       'PRF' || CAST(o_custkey % 7 AS VARCHAR) AS profile_id,
       'IMG' || CAST(o_orderkey AS VARCHAR) AS image_id,
       CAST(o_custkey % 5 AS INTEGER) AS run_id
FROM orders""",
    "v_context": """
SELECT CAST(r_regionkey AS INTEGER) AS run_id,
       CASE WHEN instr(r_name, ' ') = 0 THEN '/srv/upload/' || lower(r_name) END AS upload_dir,
       '/srv/pkged/' || replace(lower(r_name), ' ', '_') AS pkged,
       (r_regionkey % 2 = 0) AS use_sphinx,
       CAST(r_regionkey % 3 AS INTEGER) AS sphinx_db
FROM region""",
    "v_outputs": """
SELECT doc_id, kind, CASE WHEN kind IN ('source', 'state', 'manifest', 'temp') THEN 0 ELSE page_no END AS page_no
FROM (
  SELECT doc_id, page_no, 'thumbs' AS kind FROM v_pages
  UNION ALL SELECT doc_id, page_no, 'png' FROM v_pages WHERE NOT (returnflag = 'A' AND linestatus = 'F')
  UNION ALL SELECT doc_id, page_no, 'xml' FROM v_pages WHERE NOT (returnflag = 'A' AND linestatus = 'O')
  UNION ALL SELECT doc_id, page_no, 'pdf' FROM v_pages WHERE NOT (returnflag = 'R' AND linestatus = 'F')
  UNION ALL SELECT doc_id, page_no, 'txt' FROM v_pages WHERE NOT (returnflag = 'N' AND linestatus = 'O')
  UNION ALL SELECT doc_id, page_no, 'source' FROM v_pages WHERE page_no = 1
  UNION ALL SELECT doc_id, page_no, 'state' FROM v_pages WHERE page_no = 1
  UNION ALL SELECT doc_id, page_no, 'manifest' FROM v_pages WHERE page_no = 1 AND linestatus = 'O'
  UNION ALL SELECT doc_id, page_no, 'temp' FROM v_pages WHERE page_no = 1 AND returnflag <> 'R')""",
    "v_users": """
SELECT c_custkey AS id, c_name AS name,
       lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
       '' AS phone, '' AS url, '' AS location, '' AS bio,
       CAST(c_acctbal AS DECIMAL(18,2)) AS deposit,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'key' || CAST(c_custkey AS VARCHAR) END AS activation_key,
       CAST(NULL AS VARCHAR) AS avatar,
       CAST(c_nationkey % 3 + 1 AS INTEGER) AS sex,
       CAST(c_custkey % 3 AS SMALLINT) AS role_code,
       CAST(c_custkey % 3 AS SMALLINT) AS status_code
FROM customer""",
    "v_messages": """
SELECT event_id, event_type AS value, ts, props AS body FROM events""",
}

ORDER = list(VIEWS)


def with_views(sql: str, *names: str, ctes: str = "") -> str:
    """``WITH`` the named views (plus what they depend on) and extra ``ctes`` in front of ``sql``."""
    deps = {"v_counts": ["v_pages"], "v_outputs": ["v_pages"]}
    need: list[str] = []

    def add(n: str) -> None:
        for d in deps.get(n, []):
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    need.sort(key=ORDER.index)
    parts = [f"{n} AS ({VIEWS[n]}\n)" for n in need]
    if ctes.strip():
        parts.append(ctes.strip().lstrip(","))
    return f"WITH RECURSIVE {', '.join(parts)}\n{sql}" if parts else sql
