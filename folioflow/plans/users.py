"""User-table lookups and changes.

Lookups are equi joins (an OR of two keys is two equi joins and a union, not
a nested-loop join); "latest change" and "first candidate" are grouped
``min_by``/``max_by`` aggregations with partial aggregation, so a hot name
or id never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import validate_users
from ..session import materialize

# Defaults of a new user row.
NEW_USER_DEFAULTS = {"phone": "", "url": "", "location": "", "bio": "", "deposit": 0, "sex": 1,
                     "role_code": 2, "status_code": 0}


def taken_names(cands: DataFrame, users: DataFrame) -> DataFrame:
    """Candidates with ``name_taken`` / ``email_taken`` flags (two semi-join style lookups)."""
    names = users.select("name").distinct().withColumn("name_taken", F.lit(True))
    emails = users.select("email").distinct().withColumn("email_taken", F.lit(True))
    x = cands.join(names, "name", "left").join(emails, "email", "left")
    return x.withColumn("name_taken", F.coalesce("name_taken", F.lit(False))) \
            .withColumn("email_taken", F.coalesce("email_taken", F.lit(False)))


def match_logins(logins: DataFrame, users: DataFrame) -> DataFrame:
    """User for each login text equal to a name or an email; first hit = lowest id."""
    by_name = logins.join(users.select(F.col("name").alias("login"), "id"), "login", "inner")
    by_email = logins.join(users.select(F.col("email").alias("login"), "id"), "login", "inner")
    both = by_name.unionByName(by_email)
    return both.groupBy("login").agg(F.min("id").alias("user_id"))


def match_reset_keys(requests: DataFrame, users: DataFrame) -> DataFrame:
    """User for ``(activation_key, email)``; rows without a key never match."""
    u = users.where(F.col("activation_key").isNotNull()).select("activation_key", "email", F.col("id").alias("user_id"))
    return requests.join(u, ["activation_key", "email"], "inner")


def count_users_with_name(users: DataFrame) -> DataFrame:
    """Rows sharing each name (uniqueness check)."""
    return users.groupBy("name").agg(F.count(F.lit(1)).alias("n_users"))


def name_free_for(users: DataFrame, requests: DataFrame) -> DataFrame:
    """A13 (profile form): is ``name`` free for user ``id``, other users only.

    The source compared the email column with the id, so every row counted;
    here the user's own row is excluded.
    """
    # per name the number of users and the lowest and highest id tell whether another user has it
    taken = users.groupBy("name").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi"))
    other = F.col("_lo").isNotNull() & ((F.col("_lo") != F.col("id")) | (F.col("_hi") != F.col("id")))
    return requests.join(taken, "name", "left").select("id", "name", (~other).alias("name_free")).distinct()


def signup_batch(cands: DataFrame, users: DataFrame, run_ts: str, max_rounds: int = 100) -> DataFrame:
    """New user rows for valid, free candidates, taken in ``cand_id`` order.

    A candidate is refused if an *accepted* earlier one has the name or the
    email; a refused candidate blocks nobody.  Candidates that share neither
    with an earlier one are accepted at once; the rest is settled in rounds:
    accept those that are first in their name and their email among the
    undecided, refuse those that share one with an accepted candidate.  The
    rounds follow the longest chain of candidates that wait for each other;
    more than ``max_rounds`` raise an error.  New ids are
    ``max(existing id) + cand_id``; ``create_at`` is the run time.
    """
    v = validate_users(cands).where(F.size("errors") == 0).drop("errors")
    free = taken_names(v, users).where(~F.col("name_taken") & ~F.col("email_taken"))
    left, kept = free.select("cand_id", "name", "email"), None
    for _ in range(max_rounds):
        by_name = left.groupBy("name").agg(F.min("cand_id").alias("_n"))
        by_email = left.groupBy("email").agg(F.min("cand_id").alias("_e"))
        now = materialize(left.join(by_name, "name").join(by_email, "email").where(
            (F.col("cand_id") == F.col("_n")) & (F.col("cand_id") == F.col("_e"))).select("cand_id", "name", "email"), "signup")
        kept = now if kept is None else kept.union(now)
        left = materialize(left.join(now.select("name"), "name", "left_anti").join(now.select("email"), "email", "left_anti"),
                           "signup_left")
        if left.isEmpty():
            break
    else:
        raise RuntimeError(f"sign-up candidates not settled in {max_rounds} rounds")
    keep = free.join(kept.select("cand_id"), "cand_id", "left_semi")
    # the current largest id as a scalar subquery (computed once, no join)
    max_id = users.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    out = keep.withColumn("_max_id", max_id)
    d = NEW_USER_DEFAULTS
    return out.select(
        (F.col("_max_id") + F.col("cand_id")).alias("id"), "name", "email",
        F.lit(d["phone"]).alias("phone"), F.lit(d["url"]).alias("url"),
        F.lit(d["location"]).alias("location"), F.lit(d["bio"]).alias("bio"),
        F.lit(d["deposit"]).cast("decimal(18,2)").alias("deposit"),
        F.lit(d["sex"]).cast("int").alias("sex"),
        F.lit(d["role_code"]).cast("short").alias("role_code"),
        F.lit(d["status_code"]).cast("short").alias("status_code"),
        F.lit(run_ts).cast("timestamp_ntz").alias("create_at"))


def apply_user_changes(users: DataFrame, changes: DataFrame,
                       fields=("email", "phone", "url", "location", "bio")) -> DataFrame:
    """Apply every change of a user in turn and set ``update_at`` to the last one's time.

    A field ends with its latest non-null value; any change with a new password
    clears ``activation_key``.  ``changes``: id, changed_at, the fields (null =
    unchanged), new_password.
    """
    cols = [c for c in fields if c in changes.columns]
    last = changes.groupBy("id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("changed_at"))).alias(f"_new_{c}") for c in cols],
        (F.count("new_password") > 0).alias("_cleared"), F.max("changed_at").alias("update_at"))
    out = []
    for c in users.columns:
        if c in cols:
            out.append(F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c))
        elif c == "activation_key":
            out.append(F.when(~F.coalesce("_cleared", F.lit(False)), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return users.join(last, "id", "left").select(*out, "update_at")


def issue_reset_keys(users: DataFrame, requests: DataFrame, seed: int | None = None) -> DataFrame:
    """D3: a fresh activation key for users whose email asked for a reset."""
    asked = users.join(requests.select("email").distinct(), "email", "left_semi")
    key = F.uuid(seed) if seed is not None else F.uuid()
    return asked.select("id", "email", key.alias("activation_key"))
