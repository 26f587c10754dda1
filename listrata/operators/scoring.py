"""Company and review scores, min-max scaling and recency."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listrata.functions import measures
from listrata.functions.cleaning import missing_as_null
from listrata.functions.times import whole_days
from listrata.operators.columns import project, stamp, where_present
from listrata.operators.texts import add_polarity

# Default weights, and the value of each sentiment.
COMPANY_WEIGHTS = {"rating": 0.6, "reviews": 0.3, "photos_count": 0.1}
REVIEW_WEIGHTS = {"review_rating": 0.6, "sentiment": 0.3, "adjectives_sentiment": 0.1, "review_likes": 0.0}
SENTIMENT_VALUES = {"Negative": 0.0, "Neutral": 0.5, "Positive": 1.0}
OTHER_SENTIMENT = 0.5

# Columns a score is made of.
COMPANY_FEATURES = ("google_id", "rating", "reviews", "photos_count")
REVIEW_FEATURES = (
    "google_id", "review_id", "review_rating", "review_likes", "sentiment", "adjectives", "review_timestamp",
)


def _value(df: DataFrame, name: str) -> Column:
    return missing_as_null(F.col(name), df.schema[name].dataType)


_BOUNDS = "_bounds"


def bounds_of(df: DataFrame, **values: Column) -> DataFrame:
    """The least and greatest value of several expressions over the whole frame.

    One row with the columns ``<name>_low`` and ``<name>_high``; missing values do not count.
    """
    ends = []
    for name, value in values.items():
        ends += [F.min(value).alias(f"{name}_low"), F.max(value).alias(f"{name}_high")]
    return df.agg(*ends)


def with_bounds(df: DataFrame, bounds: DataFrame | None = None, **values: Column) -> DataFrame:
    """Add the least and greatest value of several expressions over the whole frame as the struct ``_bounds``.

    They come from ``bounds`` (see :func:`bounds_of`) or one aggregate: a one-row subquery that is run once
    and reaches the tasks as a constant, without a join.
    """
    ends = bounds_of(df, **values) if bounds is None else bounds
    return df.withColumn(_BOUNDS, ends.select(F.struct(*ends.columns).alias("ends")).scalar())


def _scaled(value: Column, name: str, *, guarded: bool) -> Column:
    ends = F.col(_BOUNDS)
    return measures.min_max(value, ends[f"{name}_low"], ends[f"{name}_high"], guarded=guarded)


def min_max_log(df: DataFrame, column: str, output: str, *, guarded: bool = False) -> DataFrame:
    """Add the log of a count, scaled to 0..1 over the whole frame."""
    log = measures.log1p(_value(df, column))
    return with_bounds(df, x=log).withColumn(output, _scaled(log, "x", guarded=guarded)).drop(_BOUNDS)


def _aged(df: DataFrame, column: str, newest: Column, decay: float) -> DataFrame:
    aged = df.withColumn("delta_t", whole_days(F.col(column), newest))
    return aged.withColumn("W", measures.recency_weight(F.col("delta_t"), decay))


def recency(df: DataFrame, column: str, *, decay: float = 0.001) -> DataFrame:
    """Add ``delta_t``, whole days before the newest row, and the weight ``W`` that falls with it."""
    return _aged(df, column, df.agg(F.max(column)).scalar(), decay)


def _company_logs(df: DataFrame) -> dict[str, Column]:
    return {"reviews": measures.log1p(_value(df, "reviews")), "photos": measures.log1p(_value(df, "photos_count"))}


def company_bounds(df: DataFrame) -> DataFrame:
    """The bounds over all companies that :func:`company_score` scales by."""
    return bounds_of(df, **_company_logs(df))


def company_score(
    df: DataFrame, *, weights: Mapping[str, float] | None = None, only_features: bool = False,
    keep_parts: bool = False, run_time: datetime | None = None, bounds: DataFrame | None = None,
) -> DataFrame:
    """Add ``company_profile_score``: rating, and logs of reviews and photos scaled over all companies.

    ``bounds`` are those of all companies if ``df`` holds only some.
    """
    share = measures.normalised(weights or COMPANY_WEIGHTS)
    if only_features:
        df = project(df, COMPANY_FEATURES)
    logs = _company_logs(df)
    scored = with_bounds(df, bounds, **logs).withColumns(
        {
            "S1": measures.rating_unit(_value(df, "rating")),
            "log_reviews": logs["reviews"],
            "S2": _scaled(logs["reviews"], "reviews", guarded=True),
            "log_photos": logs["photos"],
            "S3": _scaled(logs["photos"], "photos", guarded=True),
        }
    ).withColumn(
        "company_profile_score",
        share["rating"] * F.col("S1") + share["reviews"] * F.col("S2") + share["photos_count"] * F.col("S3"),
    )
    if not keep_parts:
        scored = scored.drop("S1", "S2", "S3", "log_reviews", "log_photos")
    return stamp(scored.drop(_BOUNDS), run_time or datetime.now())


def _review_ends(df: DataFrame) -> dict[str, Column]:
    return {"likes": measures.log1p(_value(df, "review_likes")), "time": F.col("review_timestamp")}


def review_bounds(df: DataFrame) -> DataFrame:
    """The bounds over all reviews that :func:`review_score` depends on."""
    return bounds_of(df, **_review_ends(df))


def review_score(
    df: DataFrame, valences: DataFrame, *, decay: float = 0.001, weights: Mapping[str, float] | None = None,
    only_features: bool = False, keep_parts: bool = False, strict: bool = True,
    run_time: datetime | None = None, bounds: DataFrame | None = None,
) -> DataFrame:
    """Add ``user_review_score``: rating, sentiment, adjectives and likes, weighed down by age.

    ``valences`` is the table (word, valence) that rates the adjectives; ``bounds`` are those of all reviews
    if ``df`` holds only some.
    ``strict`` gives no score to a review without a polar adjective, nor to any review if all
    have equal likes; otherwise the missing part counts 0.
    """
    share = measures.normalised(weights or REVIEW_WEIGHTS)
    if only_features:
        df = project(df, REVIEW_FEATURES)
    ends = _review_ends(df)
    mood = F.lit(OTHER_SENTIMENT)
    for label, value in SENTIMENT_VALUES.items():
        mood = F.when(F.col("sentiment") == label, value).otherwise(mood)
    bounded = with_bounds(df, bounds, **ends)
    scored = _aged(bounded, "review_timestamp", F.col(_BOUNDS)["time_high"], decay).withColumns(
        {
            "S1": measures.rating_unit(_value(df, "review_rating")),
            "log_likes": ends["likes"],
            "L": _scaled(ends["likes"], "likes", guarded=False),
            "S2": mood,
        }
    )
    scored = add_polarity(scored, "adjectives", valences, "S3")
    words, likes = F.col("S3"), F.col("L")
    if not strict:
        words, likes = F.coalesce(words, F.lit(0.0)), F.coalesce(likes, F.lit(0.0))
    total = (
        share["review_rating"] * F.col("S1") + share["sentiment"] * F.col("S2")
        + share["adjectives_sentiment"] * words + share["review_likes"] * likes
    )
    scored = scored.withColumn("user_review_score", measures.half_even(F.col("W") * total, 2))
    if not keep_parts:
        scored = scored.drop("S1", "S2", "S3", "L", "log_likes", "delta_t", "W")
    return stamp(scored.drop(_BOUNDS), run_time or datetime.now())


def scored_only(df: DataFrame, score: str) -> DataFrame:
    """Rows that got a score."""
    return where_present(df, score)
