"""Metric queries (the numbers behind the QA dashboards).

All aggregations are declarative ``groupBy().agg()`` so Spark runs a
partial (map-side) hash aggregate before the shuffle: a ticket or
reviewer holding a third of all rows costs one partial row per input
partition, not a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the rating that means "not applicable".
NOT_APPLICABLE_RATING = 42

# Double-valued metrics are reported to 9 decimals: sums of doubles depend
# on summation order, which depends on partitioning; 9 decimals keep the
# reported value independent of how the cluster split the work.
METRIC_DECIMALS = 9


def _avg(c: str) -> F.Column:
    return F.round(F.avg(c), METRIC_DECIMALS)


def avg_score_per_ticket(autoqa_ratings: DataFrame) -> DataFrame:
    """Average automatic score per ticket (NULL scores skipped)."""
    return autoqa_ratings.groupBy("external_ticket_id").agg(_avg("score").alias("avg_score"))


def avg_score_per_reviewee(manual_reviews: DataFrame, min_reviews: int = 2) -> DataFrame:
    """Review count and average manual score per reviewee with at least ``min_reviews`` reviews."""
    return (manual_reviews.groupBy("reviewee_id")
            .agg(F.count(F.lit(1)).alias("total_reviews"), _avg("score").alias("avg_score"))
            .filter(F.col("total_reviews") >= min_reviews))


def weighted_score(manual_rating: DataFrame) -> DataFrame:
    """Weighted score percentage per review.

    A rating of 42 adds nothing to numerator or weight.  A NULL rating
    drops out of the numerator but its weight stays in the denominator.
    A zero weight sum scores 0; a NULL weight sum stays NULL.
    """
    na = F.col("rating") == NOT_APPLICABLE_RATING
    part = (F.col("rating") / F.col("rating_max")) * F.col("weight")
    sums = manual_rating.groupBy("review_id").agg(
        F.sum(F.when(na, F.lit(0.0)).otherwise(part)).alias("points"),
        F.sum(F.when(na, F.lit(0.0)).otherwise(F.col("weight"))).alias("weights"))
    return sums.select(
        "review_id",
        F.when(F.col("weights") == 0, F.lit(0.0))
        .otherwise(F.round(100 * (F.col("points") / F.col("weights")), METRIC_DECIMALS))
        .alias("final_score_percentage"))


def ticket_scores_auto_vs_manual(autoqa_ratings: DataFrame, manual_reviews: DataFrame) -> DataFrame:
    """Average automatic and manual score per ticket, side by side (full outer join).

    Both sides are aggregated to one row per ticket before the join, so the
    join input is bounded by the number of tickets, not of ratings.
    """
    auto = avg_score_per_ticket(autoqa_ratings).select(
        F.col("external_ticket_id").alias("a_ticket"), F.col("avg_score").alias("auto_avg_score"))
    manual = manual_reviews.groupBy("conversation_external_id").agg(_avg("score").alias("manual_avg_score"))
    j = auto.join(manual, auto["a_ticket"] == manual["conversation_external_id"], "full_outer")
    return j.select(F.coalesce("a_ticket", "conversation_external_id").alias("external_ticket_id"),
                    "auto_avg_score", "manual_avg_score")


def reviewer_performance(fact_manual_reviews: DataFrame) -> DataFrame:
    return fact_manual_reviews.groupBy("reviewer_key").agg(
        _avg("score").alias("avg_score"), F.count(F.lit(1)).alias("review_count"))


def root_cause_breakdown(fact_root_cause: DataFrame, fact_ratings: DataFrame) -> DataFrame:
    """Frequency, total count and severity (mean rating score) per category and root cause."""
    a = fact_ratings.select("autoqa_rating_key", "score")
    j = fact_root_cause.join(a, "autoqa_rating_key", "left")
    return j.groupBy("category", "root_cause").agg(
        F.count(F.lit(1)).alias("frequency"),
        F.sum("root_cause_count").alias("total_count"),
        _avg("score").alias("avg_rating_score"))


def score_series(fact_manual_reviews: DataFrame, fact_ratings: DataFrame, fact_reviews: DataFrame,
                 unit: str) -> DataFrame:
    """Average score and volume per week or month; manual and automatic side by side."""
    def period(ts):
        return F.trunc(F.to_date(ts), unit).alias("period")

    manual = fact_manual_reviews.groupBy(period("created_ts")).agg(
        _avg("score").alias("avg_score"), F.count(F.lit(1)).alias("n")).withColumn("source", F.lit("manual"))
    # ratings are pre-aggregated per review before the join: the join input
    # shrinks to one row per review and a review with many ratings is one row
    per_review = fact_ratings.groupBy("autoqa_review_key").agg(
        F.sum("score").alias("s"), F.count("score").alias("c"), F.count(F.lit(1)).alias("rows"))
    rv = fact_reviews.select("autoqa_review_key", "created_ts")
    auto = (per_review.join(rv, "autoqa_review_key")
            .groupBy(period("created_ts"))
            .agg(F.round(F.sum("s") / F.sum("c"), METRIC_DECIMALS).alias("avg_score"),
                 F.sum("rows").alias("n"))
            .withColumn("source", F.lit("auto")))
    return manual.unionByName(auto).select("source", "period", "avg_score", "n")


def top_agents(fact_manual_reviews: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` reviewees with the best average manual score (ties: more reviews, then key)."""
    g = (fact_manual_reviews.filter(F.col("reviewee_key").isNotNull()).groupBy("reviewee_key")
         .agg(_avg("score").alias("avg_score"), F.count(F.lit(1)).alias("review_count")))
    return g.orderBy(F.desc_nulls_last("avg_score"), F.desc("review_count"), F.asc("reviewee_key")).limit(k)


def top_root_causes(fact_root_cause: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent root causes (ties by name)."""
    g = (fact_root_cause.filter(F.col("root_cause").isNotNull()).groupBy("root_cause")
         .agg(F.count(F.lit(1)).alias("frequency")))
    return g.orderBy(F.desc("frequency"), F.asc("root_cause")).limit(k)


def root_cause_heatmap(fact_root_cause: DataFrame) -> DataFrame:
    """Category x root cause counts, one row per cell that occurs (a missing cause is a NULL one).

    Long form, so no list of causes has to be given or discovered and no
    cause is left out.
    """
    return fact_root_cause.groupBy("category", "root_cause").agg(F.count(F.lit(1)).alias("frequency"))
