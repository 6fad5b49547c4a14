import pytest
from pyspark.errors import ArithmeticException

from qualis.plans.metrics import avg_score_per_reviewee, weighted_score

SCHEMA = "review_id bigint, rating double, rating_max bigint, weight double"


def _score(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.review_id: r.final_score_percentage for r in weighted_score(df).collect()}


def test_all_not_applicable_scores_zero(spark):
    assert _score(spark, [(1, 42.0, 4, 5.0), (1, 42.0, 4, 7.0)]) == {1: 0.0}


def test_not_applicable_leaves_weight(spark):
    assert _score(spark, [(1, 3.0, 4, 2.0), (1, 42.0, 4, 5.0)]) == {1: 75.0}


def test_null_rating_keeps_its_weight(spark):
    assert _score(spark, [(1, 4.0, 4, 1.0), (1, None, 4, 1.0)]) == {1: 50.0}


def test_null_weights_give_null(spark):
    assert _score(spark, [(1, 3.0, 4, None), (1, 2.0, 4, None)]) == {1: None}


def test_zero_rating_max_is_an_error(spark):
    with pytest.raises(ArithmeticException):
        _score(spark, [(1, 3.0, 0, 1.0)])


def test_reviewee_with_one_review_is_absent(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (2, 2.0, 20.0), (3, 2.0, 40.0), (4, None, 5.0), (5, None, 7.0)],
                               "review_id bigint, reviewee_id double, score double")
    got = {r.reviewee_id: (r.total_reviews, r.avg_score) for r in avg_score_per_reviewee(df).collect()}
    assert got == {2.0: (2, 30.0), None: (2, 6.0)}
