"""Documented joins: raw-layer relations and star-schema drills.

Raw relations (before modelling): reviews -> ratings -> root causes,
reviews and manual reviews <-> conversations on three columns, manual
reviews -> manual ratings.  Star drills: root cause -> rating -> review,
manual rating -> manual review, and facts -> calendar dimension.

All are equi-joins; Spark picks the strategy (AQE turns a sort-merge
join into a broadcast join when one side materialises small).  The only
explicit broadcast is the calendar dimension, whose size is bounded by
its date range (one row per day), not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.functions.keys import packed, unpacked


def reviews_ratings(reviews: DataFrame, ratings: DataFrame) -> DataFrame:
    r = reviews.select("autoqa_review_id", "created_at", "team_id", F.col("updated_at").alias("review_updated_at"))
    a = ratings.select("autoqa_review_id", "autoqa_rating_id", "external_ticket_id", "rating_category_id",
                       "rating_category_name", "score")
    return r.join(a, "autoqa_review_id")


def ratings_root_causes(ratings: DataFrame, root_causes: DataFrame) -> DataFrame:
    a = ratings.select("autoqa_rating_id", "autoqa_review_id", "rating_category_id", "score")
    c = root_causes.select("autoqa_rating_id", "category", F.col("count").alias("root_cause_count"), "root_cause")
    return a.join(c, "autoqa_rating_id")


def reviews_conversations(reviews: DataFrame, conversations: DataFrame) -> DataFrame:
    keys = ["payment_id", "payment_token_id", "external_ticket_id"]
    r = reviews.select(*keys, "autoqa_review_id", "created_at")
    c = conversations.select(*keys, "channel", "message_count", "is_closed")
    return r.join(c, keys)


def manual_reviews_ratings(manual_reviews: DataFrame, manual_rating: DataFrame) -> DataFrame:
    r = manual_reviews.select("review_id", "reviewer_id", "reviewee_id", F.col("score").alias("review_score"))
    m = manual_rating.select("review_id", "category_id", "rating", "weight", "cause")
    return r.join(m, "review_id")


def manual_reviews_conversations(manual_reviews: DataFrame, conversations: DataFrame) -> DataFrame:
    r = manual_reviews.select("payment_id", "payment_token_id", "conversation_external_id", "review_id", "score")
    c = conversations.select("payment_id", "payment_token_id", "external_ticket_id", "channel", "message_count")
    return (r.join(c, (r["payment_id"] == c["payment_id"]) & (r["payment_token_id"] == c["payment_token_id"])
                   & (r["conversation_external_id"] == c["external_ticket_id"]))
            .select(r["payment_id"], r["payment_token_id"], "conversation_external_id", "review_id", "score",
                    "channel", "message_count"))


def root_cause_drill(root_causes: DataFrame, ratings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Root cause -> automatic rating -> automatic review (fact to fact).

    Ratings meet their reviews first, by the packed key, and then the root
    causes by the rating's id, of which its key is the hash: so a shuffle
    carries at most one key, as 16 bytes.
    """
    c = root_causes.select("autoqa_rating_id", "autoqa_root_cause_key", "autoqa_rating_key", "category", "root_cause")
    a = ratings.select("autoqa_rating_id", packed("autoqa_review_key").alias("__review"), "rating_category_key", "score")
    r = reviews.select(packed("autoqa_review_key").alias("__review"), "team_key", "created_ts")
    return c.join(a.join(r, "__review"), "autoqa_rating_id").select(
        unpacked("__review").alias("autoqa_review_key"), "autoqa_rating_key", "autoqa_root_cause_key", "category",
        "root_cause", "rating_category_key", "score", "team_key", "created_ts")


def manual_rating_drill(manual_ratings: DataFrame, manual_reviews: DataFrame) -> DataFrame:
    """Manual rating -> manual review (fact to fact on the review id)."""
    m = manual_ratings.select("manual_rating_key", "review_id", "rating_category_key", "rating", "weight")
    r = manual_reviews.select("review_id", "manual_review_key", "reviewer_key", "reviewee_key",
                              F.col("score").alias("review_score"))
    return m.join(r, "review_id")


def reviews_by_date(manual_reviews: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Manual reviews per calendar month and weekday through the date dimension.

    Reviews without a creation date, or with one outside the calendar, are
    counted under NULL.
    """
    d = F.broadcast(dim_date.select("date_key", "year", "month", "day_name"))
    j = manual_reviews.select("date_key_created", "score").join(d, manual_reviews["date_key_created"] == d["date_key"],
                                                                      "left")
    return j.groupBy("year", "month", "day_name").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.round(F.avg("score"), 9).alias("avg_score"))
