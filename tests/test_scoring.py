"""Scores, distances, rounding."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from listrata.functions import measures
from listrata.operators import scoring

COMPANY = "google_id string, rating double, reviews bigint, photos_count bigint, name string"


def test_half_even_like_numpy(spark):
    random.seed(3)
    numbers = [0.125, 0.375, 0.285, 0.575, 1.005, -0.125, 2.675] + [random.uniform(-9, 9) for _ in range(200)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "k int, x double")
    got = [r[0] for r in df.orderBy("k").select(measures.half_even(F.col("x"))).collect()]
    assert got == [float(np.round(x, 2)) for x in numbers]


def test_min_max(spark):
    df = spark.createDataFrame([(0,), (3,), (None,)], "n int")
    got = [r[0] for r in scoring.min_max_log(df, "n", "share").orderBy("n").select("share").collect()]
    assert got == [None, 0.0, 1.0]
    equal = spark.createDataFrame([(4,), (4,)], "n int")
    assert {r.share for r in scoring.min_max_log(equal, "n", "share").collect()} == {None}
    assert {r.share for r in scoring.min_max_log(equal, "n", "share", guarded=True).collect()} == {0.0}
    gap = spark.createDataFrame([(1.0,), (float("nan"),), (7.0,)], "n double")
    assert {r.share for r in scoring.min_max_log(gap, "n", "share").collect()} == {0.0, None, 1.0}


def company(rows):
    """The score by hand."""
    logs = [[math.log(r[i] + 1) for r in rows] for i in (2, 3)]

    def scale(column, x):
        low, high = min(column), max(column)
        return 0.0 if low == high else (x - low) / (high - low)

    return {
        r[0]: 0.6 * (r[1] - 1) / 4 + 0.3 * scale(logs[0], logs[0][i]) + 0.1 * scale(logs[1], logs[1][i])
        for i, r in enumerate(rows)
    }


def test_company_score(spark):
    rows = [("a", 5.0, 10, 0, "x"), ("b", 3.0, 0, 4, "y"), ("c", 0.0, 100, 7, "z")]
    df = spark.createDataFrame(rows, COMPANY)
    moment = datetime(2024, 1, 5, 10, 30)
    scored = scoring.company_score(df, run_time=moment)
    assert scored.columns == ["process_timestamp", *df.columns, "company_profile_score"]
    assert {r.google_id: r.company_profile_score for r in scored.collect()} == pytest.approx(company(rows))
    assert {r.process_timestamp for r in scored.collect()} == {moment}
    parts = scoring.company_score(df, only_features=True, keep_parts=True).columns
    assert parts == [
        "process_timestamp", "google_id", "rating", "reviews", "photos_count", "S1", "log_reviews", "S2",
        "log_photos", "S3", "company_profile_score",
    ]


def test_weights_count_by_share(spark):
    df = spark.createDataFrame([("a", 5.0, 10, 0, "x"), ("b", 3.0, 0, 4, "y")], COMPANY)
    weights = {"rating": 6, "reviews": 3, "photos_count": 1}
    tenfold = scoring.company_score(df, weights=weights).select("google_id", F.round("company_profile_score", 12))
    plain = scoring.company_score(df).select("google_id", F.round("company_profile_score", 12))
    assert sorted(tenfold.collect()) == sorted(plain.collect())


def test_company_without_rating_has_no_score(spark):
    rows = [("a", None, 1, 1, "x"), ("b", float("nan"), 2, 2, "y"), ("c", 4.0, 1, 1, "z")]
    scored = scoring.company_score(spark.createDataFrame(rows, COMPANY))
    kept = scoring.scored_only(scored, "company_profile_score").collect()
    assert [r.google_id for r in kept] == ["c"]
    assert kept[0].company_profile_score == pytest.approx(0.45)


NEWEST = datetime(2024, 3, 10, 12)
REVIEW = (
    "google_id string, review_id string, review_rating float, review_likes bigint, sentiment string, "
    "adjectives string, review_timestamp timestamp"
)


def review(spark, rows, **how):
    words = spark.createDataFrame([("great", 3.1), ("slow", -1.7)], "word string, valence double")
    df = spark.createDataFrame(rows, REVIEW)
    return {r.review_id: r.user_review_score for r in scoring.review_score(df, words, **how).collect()}


def test_review_score(spark):
    rows = [
        ("g", "new", 5.0, 0, "Positive", "great", NEWEST),
        ("g", "old", 4.0, 9, "Negative", "great,slow", NEWEST - timedelta(days=100, hours=23)),
        ("g", "odd", 0.0, 3, "Angry", "slow", NEWEST - timedelta(hours=23)),
        ("g", "none", 3.0, 1, None, "plain", NEWEST),
    ]
    expected = {
        "new": 1.0, "old": float(np.round(math.exp(-0.1) * (0.6 * 0.75), 2)),
        "odd": float(np.round(0.6 * -0.25 + 0.15 - 0.1, 2)), "none": None,
    }
    assert review(spark, rows) == pytest.approx(expected)
    lenient = review(spark, rows, strict=False)
    assert lenient["none"] == pytest.approx(float(np.round(0.6 * 0.5 + 0.15, 2)))


def test_equal_likes_leave_no_strict_score(spark):
    rows = [("g", str(i), 5.0, 2, "Positive", "great", NEWEST) for i in range(3)]
    assert set(review(spark, rows).values()) == {None}
    assert set(review(spark, rows, strict=False).values()) == {1.0}


def test_distance(spark):
    points = [(0.0, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 180.0, math.pi * 6371), (40.7128, -74.006, 51.5074, -0.1278, 5570.2)]
    df = spark.createDataFrame(points, "a double, b double, c double, d double, e double")
    for r in df.withColumn("km", measures.haversine_km(*map(F.col, "abcd"))).collect():
        assert r.km == pytest.approx(r.e, rel=1e-4, abs=1e-9)


def test_repartitioning_changes_nothing(spark):
    rows = [(str(i), float(i % 5 + 1), i * 7 % 31, i % 13, "n") for i in range(300)]
    df = spark.createDataFrame(rows, COMPANY)
    a = scoring.company_score(df.repartition(1), run_time=NEWEST).collect()
    b = scoring.company_score(df.repartition(7), run_time=NEWEST).collect()
    assert sorted(a) == sorted(b)
