"""Fact models: automatic and manual reviews, ratings, root causes, conversations.

Every fact is a projection of one staging table plus N:1 lookups into
the dimensions (``operators.lookup``).  In incremental mode (``target``
given) the reference's filters run *before* the lookups: a high-water
mark for the time-stamped facts, a null-aware new-key filter for the
others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.functions.keys import id_string, joined_key, surrogate_key
from qualis.functions.times import date_key, safe_date, safe_ts, strict_ts
from qualis.lazy import LazyTables
from qualis.operators.incremental import StoredKeys, new_rows_only, since_watermark
from qualis.operators.lookup import lookup


class Dims:
    """Dimension DataFrames plus their exact row counts where measured."""

    def __init__(self, frames, rows: dict[str, int] | None = None):
        self.frames, self.rows = frames, dict(rows or {})

    def __getitem__(self, name: str) -> DataFrame:
        return self.frames[name]


def _lookup(df, dims, name, col, dim_id, dim_key, out=None):
    dim = dims[name]  # sized dimensions measure themselves on access
    rows = getattr(dims, "rows", None) or {}
    return lookup(df, col, dim, dim_id, dim_key, out, rows.get(name))


def _pay(df, dims, col="payment_id"):
    return _lookup(df, dims, "dim_payment", col, "payment_id", "payment_key")


def _team(df, dims, col="team_id"):
    return _lookup(df, dims, "dim_team", col, "team_id", "team_key")


def _user(df, dims, col, out):
    return _lookup(df, dims, "dim_user", col, "user_id", "user_key", out)


def _category(df, dims, col):
    return _lookup(df, dims, "dim_rating_category", col, "category_id", "rating_category_key")


def fact_autoqa_reviews(stg: dict[str, DataFrame], dims: dict[str, DataFrame],
                        target: DataFrame | None = None, mark: str | None = None) -> DataFrame:
    base = stg["autoqa_reviews"].withColumn("updated_at", strict_ts("updated_at"))
    if target is not None:
        base = since_watermark(base, target, mark=mark)
    f = _pay(base, dims)
    f = _team(f, dims)
    f = _user(f, dims, "reviewee_internal_id", "reviewee_key")
    created = safe_ts("created_at")
    conv_dt = safe_date("conversation_created_date")
    return f.select(
        surrogate_key("autoqa_review_id").alias("autoqa_review_key"),
        "autoqa_review_id", "payment_key", "payment_token_id", "team_key", "reviewee_key",
        "external_ticket_id",
        created.alias("created_ts"),
        safe_ts("conversation_created_at").alias("conversation_created_ts"),
        conv_dt.alias("conversation_created_dt"),
        "updated_at",
        date_key(created).alias("date_key_created"),
        date_key("updated_at").alias("date_key_updated"),
        date_key(conv_dt).alias("date_key_conversation"))


def fact_autoqa_ratings(stg: dict[str, DataFrame], dims: dict[str, DataFrame],
                        target: DataFrame | None = None) -> DataFrame:
    base = stg["autoqa_ratings"]
    if target is not None:
        base = new_rows_only(base, target, F.col("autoqa_rating_id"), None, F.col("autoqa_rating_id"))
    f = _pay(base, dims)
    f = _team(f, dims)
    f = _user(f, dims, "reviewee_internal_id", "reviewee_key")
    f = _category(f, dims, "rating_category_id")
    return f.select(
        surrogate_key("autoqa_rating_id").alias("autoqa_rating_key"),
        "autoqa_rating_id",
        surrogate_key("autoqa_review_id").alias("autoqa_review_key"),
        "payment_key", "team_key", "reviewee_key", "rating_category_key",
        "external_ticket_id", "payment_token_id", "rating_scale_score", "score")


def _root_cause_natural(df: DataFrame) -> F.Column:
    return F.concat(df["autoqa_rating_id"], F.coalesce(df["root_cause"], F.lit("")))


def _natural_of(target, natural):
    """A stored table is compared by its key column, the hash of the natural key."""
    return None if isinstance(target, StoredKeys) else natural(target)


def fact_autoqa_root_cause(stg: dict[str, DataFrame], target: DataFrame | None = None) -> DataFrame:
    base = stg["autoqa_root_cause"].filter(F.col("autoqa_rating_id").isNotNull())
    if target is not None:
        natural = _root_cause_natural(base)
        base = new_rows_only(base, target, natural, _natural_of(target, _root_cause_natural), F.md5(natural))
    # both keys follow from the columns that are told apart, so they are hashed after the shuffle
    rows = base.select("autoqa_rating_id", "category", F.col("count").alias("root_cause_count"), "root_cause").distinct()
    return rows.select(
        F.md5(_root_cause_natural(rows)).alias("autoqa_root_cause_key"),
        "autoqa_rating_id",
        surrogate_key("autoqa_rating_id").alias("autoqa_rating_key"),
        "category", "root_cause_count", "root_cause")


def _conversation_key() -> F.Column:
    return joined_key(id_string("payment_id"), id_string("external_ticket_id"),
                      F.coalesce(F.col("conversation_created_at"), F.lit("")), id_string("message_count"))


def fact_conversations(stg: dict[str, DataFrame], dims: dict[str, DataFrame],
                       target: DataFrame | None = None, mark: str | None = None) -> DataFrame:
    base = stg["conversations"].withColumn("updated_at", strict_ts("updated_at"))
    if target is not None:
        base = since_watermark(base, target, mark=mark)
    f = base.withColumn("conversation_key", _conversation_key())
    f = _pay(f, dims)
    f = _user(f, dims, "assignee_id", "assignee_key")
    created = safe_ts("conversation_created_at")
    closed = safe_ts("closed_at")
    return f.select(
        "conversation_key", "payment_key", "payment_token_id", "external_ticket_id", "assignee_key",
        created.alias("conversation_created_ts"),
        safe_date("conversation_created_at_date").alias("conversation_created_dt"),
        "updated_at",
        closed.alias("closed_ts"),
        "channel", "language", "is_closed", "message_count", "private_message_count",
        "public_message_count", "unique_public_agent_count", "agent_most_public_messages",
        "first_response_time", "first_resolution_time_seconds", "full_resolution_time_seconds",
        "last_reply_at", "klaus_sentiment", "deleted_at", "imported_at",
        "public_mean_character_count", "public_mean_word_count", "most_active_internal_user_id",
        date_key(created).alias("date_key_created"),
        date_key("updated_at").alias("date_key_updated"),
        date_key(closed).alias("date_key_closed")).distinct()


def _manual_rating_natural(df: DataFrame) -> F.Column:
    return F.concat(df["review_id"].cast("string"), F.lit("_"), df["category_id"].cast("string"))


def fact_manual_ratings(stg: dict[str, DataFrame], dims: dict[str, DataFrame],
                        target: DataFrame | None = None) -> DataFrame:
    base = stg["manual_rating"]
    if target is not None:
        natural = _manual_rating_natural(base)
        base = new_rows_only(base, target, natural, _natural_of(target, _manual_rating_natural), F.md5(natural))
    f = base.withColumn("manual_rating_key", F.md5(_manual_rating_natural(base)))
    f = _pay(f, dims)
    f = _team(f, dims)
    f = _category(f, dims, "category_id")
    return f.select(
        "manual_rating_key", "review_id", "category_id", "payment_key", "team_key", "rating_category_key",
        "rating", "cause", "rating_max", "weight", "critical", "category_name").distinct()


def fact_manual_reviews(stg: dict[str, DataFrame], dims: dict[str, DataFrame],
                        target: DataFrame | None = None, mark: str | None = None) -> DataFrame:
    """Manual reviews; the user dimension plays two roles (reviewer, reviewee)."""
    base = stg["manual_reviews"].withColumn("updated_at", strict_ts("updated_at"))
    if target is not None:
        base = since_watermark(base, target, mark=mark)
    f = _pay(base, dims)
    f = _team(f, dims)
    f = _user(f, dims, "reviewer_id", "reviewer_key")
    f = _user(f, dims, "reviewee_id", "reviewee_key")
    created = safe_ts("created")
    conv_dt = safe_date("conversation_created_date")
    return f.select(
        F.md5(id_string("review_id")).alias("manual_review_key"),
        "review_id", "payment_key", "payment_token_id", "team_key", "reviewer_key", "reviewee_key",
        created.alias("created_ts"),
        safe_ts("conversation_created_at").alias("conversation_created_ts"),
        conv_dt.alias("conversation_created_dt"),
        "conversation_external_id", "comment_id", "scorecard_id", "scorecard_tag", "score",
        "updated_at", "updated_by", "assignment_review", "seen", "disputed", "review_time_seconds",
        "assignment_name", "imported_at",
        date_key(created).alias("date_key_created"),
        date_key("updated_at").alias("date_key_updated"),
        date_key(conv_dt).alias("date_key_conversation"))


def facts(stg: dict[str, DataFrame], dims: dict[str, DataFrame],
          targets: dict[str, DataFrame] | None = None, marks: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All six facts; with ``targets`` only their new rows (``marks``: recorded high-water marks)."""
    t, m = targets or {}, marks or {}
    builders = {
        "fact_autoqa_reviews": lambda: fact_autoqa_reviews(stg, dims, t.get("fact_autoqa_reviews"),
                                                            m.get("fact_autoqa_reviews")),
        "fact_autoqa_ratings": lambda: fact_autoqa_ratings(stg, dims, t.get("fact_autoqa_ratings")),
        "fact_autoqa_root_cause": lambda: fact_autoqa_root_cause(stg, t.get("fact_autoqa_root_cause")),
        "fact_conversations": lambda: fact_conversations(stg, dims, t.get("fact_conversations"),
                                                          m.get("fact_conversations")),
        "fact_manual_ratings": lambda: fact_manual_ratings(stg, dims, t.get("fact_manual_ratings")),
        "fact_manual_reviews": lambda: fact_manual_reviews(stg, dims, t.get("fact_manual_reviews"),
                                                            m.get("fact_manual_reviews")),
    }
    return LazyTables(builders)
