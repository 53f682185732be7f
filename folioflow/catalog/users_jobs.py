"""Jobs of the user table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes
from ..operators import filters as flt
from ..plans import users as U
from ..sources import tables as T
from . import job

RUN_TS = "2024-01-20 12:00:00"

CANDS = """cands AS (
SELECT s_suppkey AS cand_id,
       CASE s_suppkey % 5 WHEN 0 THEN 'Customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0')
                          WHEN 1 THEN substr(s_name, 1, 3) WHEN 2 THEN s_name || s_name ELSE s_name END AS name,
       CASE s_suppkey % 3 WHEN 0 THEN 'user' || CAST(s_suppkey % 50 AS VARCHAR) || '@example.com'
                          WHEN 1 THEN 'no-at-sign' ELSE lower(replace(s_name, '#', '')) || '@example.com' END AS email,
       repeat('p', CAST(4 + s_suppkey % 15 AS INTEGER)) AS password,
       CASE WHEN s_suppkey % 7 = 0 THEN 'x' ELSE repeat('p', CAST(4 + s_suppkey % 15 AS INTEGER)) END AS password_again,
       CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS phone,
       CASE s_suppkey % 4 WHEN 0 THEN 'http://example.com/s' || CAST(s_suppkey AS VARCHAR) WHEN 1 THEN 'notaurl'
                          ELSE '' END AS url,
       (s_suppkey % 9 <> 0) AS agree
FROM supplier)"""


def candidates(spark, sf_dir):
    """Sign-up candidates derived from suppliers: some taken, short, long, mismatched or invalid."""
    s = T.table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    pw = F.repeat(F.lit("p"), (4 + k % 15).cast("int"))
    return s.select(
        k.alias("cand_id"),
        F.when(k % 5 == 0, F.concat(F.lit("Customer#"), F.lpad(k.cast("string"), 9, "0")))
         .when(k % 5 == 1, F.substring("s_name", 1, 3))
         .when(k % 5 == 2, F.concat("s_name", "s_name")).otherwise(F.col("s_name")).alias("name"),
        F.when(k % 3 == 0, F.concat(F.lit("user"), (k % 50).cast("string"), F.lit("@example.com")))
         .when(k % 3 == 1, F.lit("no-at-sign"))
         .otherwise(F.concat(F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit(""))), F.lit("@example.com")))
         .alias("email"),
        pw.alias("password"),
        F.when(k % 7 == 0, F.lit("x")).otherwise(pw).alias("password_again"),
        F.when(k % 11 == 0, F.lit("")).otherwise(F.col("s_nationkey").cast("string")).alias("phone"),
        F.when(k % 4 == 0, F.concat(F.lit("http://example.com/s"), k.cast("string")))
         .when(k % 4 == 1, F.lit("notaurl")).otherwise(F.lit("")).alias("url"),
        (k % 9 != 0).alias("agree"))


EMAIL_RE = "^.+@[^.@][^@]+$"
URL_RE = "(?i)^[a-z]+://[^/:]+[.][^/:]+(:[0-9]+)?(/.*)?$"

VALID = f"""valid AS (
SELECT c.*, list_filter([
  CASE WHEN name IS NULL OR length(name) = 0 THEN 'name required' END,
  CASE WHEN NOT (name IS NULL OR length(name) = 0) AND NOT (length(name) >= 4 AND length(name) <= 25)
       THEN 'name length' END,
  CASE WHEN email IS NULL OR length(email) = 0 THEN 'email required' END,
  CASE WHEN NOT (email IS NULL OR length(email) = 0) AND NOT regexp_matches(email, '{EMAIL_RE}') THEN 'email invalid' END,
  CASE WHEN NOT (email IS NULL OR length(email) = 0) AND NOT (length(email) >= 2 AND length(email) <= 50)
       THEN 'email length' END,
  CASE WHEN password IS NULL OR length(password) = 0 THEN 'password required' END,
  CASE WHEN NOT (password IS NULL OR length(password) = 0) AND NOT (length(password) >= 6 AND length(password) <= 16)
       THEN 'password length' END,
  CASE WHEN password_again IS DISTINCT FROM password THEN 'passwords differ' END,
  CASE WHEN phone IS NULL OR length(phone) = 0 THEN 'phone required' END,
  CASE WHEN NOT (length(phone) <= 64) THEN 'phone length' END,
  CASE WHEN NOT (url IS NULL OR length(url) = 0) AND NOT regexp_matches(url, '{URL_RE}') THEN 'url invalid' END,
  CASE WHEN NOT COALESCE(agree, false) THEN 'terms not agreed' END], lambda e: e IS NOT NULL) AS errors
FROM cands c)"""


@job("read_users", "SELECT * FROM v_users", ("v_users",))
def read_users(spark, sf_dir):
    """The user table."""
    return T.users(spark, sf_dir)


@job("user_by_id", "SELECT id, name, email FROM v_users WHERE id = 7", ("v_users",))
def user_by_id(spark, sf_dir):
    """lookup by key (empty result = not found; the caller raises)."""
    return flt.user_by_id(T.users(spark, sf_dir), 7).select("id", "name", "email")


@job("search_users", """
SELECT id, name, email FROM v_users
WHERE (name ILIKE '%machinery%' OR email ILIKE '%machinery%') AND (name ILIKE '%00001%' OR email ILIKE '%00001%')""",
     ("v_users",))
def search_users(spark, sf_dir):
    """every keyword matches name or email, case-insensitive, anywhere."""
    return flt.search_users(T.users(spark, sf_dir), "MACHINERY 00001").select("id", "name", "email")


@job("search_many", """
SELECT s.search_id, u.id, u.name, u.email FROM v_users u JOIN searches s
  ON (u.name ILIKE '%' || s.a || '%' OR u.email ILIKE '%' || s.a || '%') AND (u.name ILIKE '%' || s.b || '%' OR u.email ILIKE '%' || s.b || '%')""",
     ("v_users",), """searches AS (SELECT s_suppkey AS search_id, CAST(s_suppkey % 97 AS VARCHAR) AS a,
  CASE s_suppkey % 6 WHEN 0 THEN 'machin' WHEN 1 THEN 'BUILD' WHEN 2 THEN 'auto%le' WHEN 3 THEN 'house_old' WHEN 4 THEN '%' ELSE '@Ex' END AS b
  FROM supplier)""")
def search_many(spark, sf_dir):
    """F14 for many searches: one per supplier, two words each, some with wildcards."""
    k = F.col("s_suppkey")
    b = F.element_at(F.array(*[F.lit(w) for w in ("machin", "BUILD", "auto%le", "house_old", "%", "@Ex")]), (k % 6 + 1).cast("int"))
    searches = T.table(spark, sf_dir, "supplier").select(k.alias("search_id"), F.concat_ws(" ", (k % 97).cast("string"), b).alias("keywords"))
    return flt.search_many(T.users(spark, sf_dir).select("id", "name", "email"), searches)


@job("admins", "SELECT id, name FROM v_users WHERE role_code = 0", ("v_users",))
def admins(spark, sf_dir):
    """administrators."""
    return flt.admins(T.users(spark, sf_dir)).select("id", "name")


@job("validate_users", "SELECT cand_id, array_to_string(errors, ';') AS errors FROM valid", (), CANDS + ",\n" + VALID)
def validate_users(spark, sf_dir):
    """F16: sign-up rule check per candidate; errors joined with ';' ('' = valid)."""
    v = flt.validate_users(candidates(spark, sf_dir))
    return v.select("cand_id", F.array_join("errors", ";").alias("errors"))


@job("code_labels", """
SELECT id, CASE role_code WHEN 0 THEN 'admin' WHEN 1 THEN 'staff' WHEN 2 THEN 'user' END AS role,
       CASE status_code WHEN 0 THEN 'inactive' WHEN 1 THEN 'new' WHEN 2 THEN 'active' END AS status,
       CASE sex WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' WHEN 3 THEN 'Other' END AS sex_label
FROM v_users""", ("v_users",))
def code_labels(spark, sf_dir):
    """Role, status and sex labels (unknown role/status would raise)."""
    return codes.code_labels(T.users(spark, sf_dir), strict=True).select("id", "role", "status", "sex_label")


@job("taken_names", """
SELECT c.cand_id,
       EXISTS (SELECT 1 FROM v_users u WHERE u.name = c.name) AS name_taken,
       EXISTS (SELECT 1 FROM v_users u WHERE u.email = c.email) AS email_taken
FROM cands c""", ("v_users",), CANDS)
def taken_names(spark, sf_dir):
    """Candidates whose name or email is already used."""
    return U.taken_names(candidates(spark, sf_dir), T.users(spark, sf_dir)).select("cand_id", "name_taken",
                                                                                    "email_taken")


LOGINS = """logins AS (
SELECT DISTINCT CASE c_custkey % 3 WHEN 0 THEN c_name
                  WHEN 1 THEN lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || '@example.com'
                  ELSE 'nobody' || CAST(c_custkey AS VARCHAR) END AS login
FROM customer)"""


@job("match_logins", """
SELECT l.login, min(u.id) AS user_id FROM logins l JOIN v_users u ON u.name = l.login OR u.email = l.login
GROUP BY l.login""", ("v_users",), LOGINS)
def match_logins(spark, sf_dir):
    """User for each login given as name or email (two equi joins, first = lowest id)."""
    c = T.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    logins = c.select(F.when(k % 3 == 0, F.col("c_name"))
                       .when(k % 3 == 1, F.concat(F.lower("c_mktsegment"), k.cast("string"), F.lit("@example.com")))
                       .otherwise(F.concat(F.lit("nobody"), k.cast("string"))).alias("login")).distinct()
    return U.match_logins(logins, T.users(spark, sf_dir))


@job("match_reset_keys", """
SELECT r.activation_key, r.email, u.id AS user_id
FROM (SELECT 'key' || CAST(c_custkey AS VARCHAR) AS activation_key,
             CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || '@example.com'
                  ELSE 'wrong@example.com' END AS email FROM customer) r
JOIN v_users u ON u.activation_key = r.activation_key AND u.email = r.email""", ("v_users",))
def match_reset_keys(spark, sf_dir):
    """Password-reset requests matched on (activation key, email)."""
    c = T.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    req = c.select(F.concat(F.lit("key"), k.cast("string")).alias("activation_key"),
                   F.when(k % 2 == 0, F.concat(F.lower("c_mktsegment"), k.cast("string"), F.lit("@example.com")))
                    .otherwise(F.lit("wrong@example.com")).alias("email"))
    return U.match_reset_keys(req, T.users(spark, sf_dir))


@job("count_users_with_name", """
SELECT name, count(*) AS n_users FROM (SELECT name FROM v_users UNION ALL SELECT name FROM cands) GROUP BY name""",
     ("v_users",), CANDS)
def count_users_with_name(spark, sf_dir):
    """Rows sharing a name across the user table and the candidates."""
    names = T.users(spark, sf_dir).select("name").unionByName(candidates(spark, sf_dir).select("name"))
    return U.count_users_with_name(names)


@job("name_free_for", """
SELECT r.id, r.name, count_if(u.id IS NOT NULL AND u.id <> r.id) = 0 AS name_free
FROM (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name
             ELSE 'Customer#' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') END AS name FROM customer) r
LEFT JOIN v_users u ON u.name = r.name GROUP BY r.id, r.name""", ("v_users",))
def name_free_for(spark, sf_dir):
    """A13 (profile): a new name is free for a user when no other user has it."""
    c = T.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    req = c.select(k.alias("id"), F.when(k % 2 == 0, F.col("c_name")).otherwise(
        F.concat(F.lit("Customer#"), F.lpad((k + 1).cast("string"), 9, "0"))).alias("name"))
    return U.name_free_for(T.users(spark, sf_dir), req)


# candidates in order; a row is accepted when no accepted row before it has its name or email
SIGNUP = """free AS (
SELECT v.*, row_number() OVER (ORDER BY v.cand_id) AS k FROM valid v
WHERE len(v.errors) = 0 AND NOT EXISTS (SELECT 1 FROM v_users u WHERE u.name = v.name)
  AND NOT EXISTS (SELECT 1 FROM v_users u WHERE u.email = v.email)),
rival AS (
SELECT a.k, list(b.k) AS before FROM free a JOIN free b ON b.k < a.k AND (b.name = a.name OR b.email = a.email) GROUP BY a.k),
turn AS (
SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS refused
UNION ALL
SELECT t.k + 1, CASE WHEN len(list_filter(r.before, lambda x: NOT list_contains(t.refused, x))) > 0
                     THEN list_append(t.refused, t.k + 1) ELSE t.refused END
FROM turn t LEFT JOIN rival r ON r.k = t.k + 1 WHERE t.k < (SELECT count(*) FROM free)),
outcome AS (SELECT refused FROM turn ORDER BY k DESC LIMIT 1)"""


@job("signup_batch", f"""
SELECT (SELECT max(id) FROM v_users) + v.cand_id AS id, v.name, v.email, '' AS phone, '' AS url, '' AS location,
       '' AS bio, CAST(0 AS DECIMAL(18,2)) AS deposit, CAST(1 AS INTEGER) AS sex, CAST(2 AS SMALLINT) AS role_code,
       CAST(0 AS SMALLINT) AS status_code, TIMESTAMP '{RUN_TS}' AS create_at
FROM free v, outcome o WHERE NOT list_contains(o.refused, v.k)""",
     ("v_users",), CANDS + ",\n" + VALID + ",\n" + SIGNUP)
def signup_batch(spark, sf_dir):
    """New user rows for valid, free candidates, accepted in turn."""
    return U.signup_batch(candidates(spark, sf_dir), T.users(spark, sf_dir), RUN_TS)


CHANGES = """changes AS (
SELECT o_custkey AS id, o_orderdate AS changed_at, o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 THEN 'new' || CAST(o_orderkey AS VARCHAR) || '@example.com' END AS email,
       CASE WHEN o_orderkey % 3 = 1 THEN '555-' || CAST(o_orderkey AS VARCHAR) END AS phone,
       CASE WHEN o_orderkey % 4 = 0 THEN 'pw' || CAST(o_orderkey AS VARCHAR) END AS new_password
FROM orders),
latest AS (SELECT id, arg_max(email, (changed_at, o_orderkey)) FILTER (WHERE email IS NOT NULL) AS email,
  arg_max(phone, (changed_at, o_orderkey)) FILTER (WHERE phone IS NOT NULL) AS phone,
  count(new_password) > 0 AS cleared, max(changed_at) AS changed_at FROM changes GROUP BY id)"""


@job("apply_user_changes", """
SELECT u.id, u.name, COALESCE(l.email, u.email) AS email, COALESCE(l.phone, u.phone) AS phone, u.url, u.location,
       u.bio, u.deposit, CASE WHEN l.cleared THEN NULL ELSE u.activation_key END AS activation_key,
       u.avatar, u.sex, u.role_code, u.status_code, l.changed_at AS update_at
FROM v_users u LEFT JOIN latest l ON l.id = u.id""", ("v_users",), CHANGES)
def apply_user_changes(spark, sf_dir):
    """All profile changes of a user applied in turn; a password change clears the reset key."""
    o = T.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ch = o.select(F.col("o_custkey").alias("id"),
                  F.struct(F.col("o_orderdate"), k).alias("changed_at"),
                  F.when(k % 3 == 0, F.concat(F.lit("new"), k.cast("string"), F.lit("@example.com"))).alias("email"),
                  F.when(k % 3 == 1, F.concat(F.lit("555-"), k.cast("string"))).alias("phone"),
                  F.when(k % 4 == 0, F.concat(F.lit("pw"), k.cast("string"))).alias("new_password"))
    out = U.apply_user_changes(T.users(spark, sf_dir), ch, fields=("email", "phone"))
    return out.withColumn("update_at", F.col("update_at.o_orderdate"))


@job("issue_reset_keys")
def issue_reset_keys(spark, sf_dir):
    """D3: fresh reset keys for users whose email asked for one (keys are random: rows-only check)."""
    c = T.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    email = F.concat(F.lower("c_mktsegment"), k.cast("string"), F.lit("@example.com"))
    req = c.select(F.when(k % 10 == 0, F.lit("unknown@example.com")).otherwise(email).alias("email"))
    return U.issue_reset_keys(T.users(spark, sf_dir), req)


@job("first_match", "SELECT sex, arg_min(id, id) AS id, arg_min(name, id) AS name FROM v_users GROUP BY sex",
     ("v_users",))
def first_match(spark, sf_dir):
    """O3: first user per sex code under an explicit order (lowest id)."""
    from ..operators.joins import first_match as fm
    return fm(T.users(spark, sf_dir).select("sex", "id", "name"), "sex", ["id"])
