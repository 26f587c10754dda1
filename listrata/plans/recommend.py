"""Companies near a point for what a customer wants to do, and what reviewers say about them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listrata.functions.measures import haversine_km
from listrata.operators.columns import where_in
from listrata.plans.analysis import mean_review_score
from listrata.sources.workspace import materialize, new_folder

# Company types by what the customer wants.
TYPES_BY_ACTION = {
    "buy": ("Real estate agency", "Real estate consultant", "Real estate agent", "Property investment"),
    "sell": ("Property management company", "Real estate agency", "Real estate consultant", "Real estate agent"),
    "move": ("Moving and storage service", "Mover"),
}
NEAREST = 5
BEST_REVIEWS = 5


def of_action(
    profiles: DataFrame, action: str, types_by_action: Mapping[str, Sequence[str]] = TYPES_BY_ACTION,
) -> DataFrame:
    """Companies of the types that serve an action."""
    if action not in types_by_action:
        raise ValueError(f"action must be one of {sorted(types_by_action)}, not {action!r}")
    return where_in(profiles, type=list(types_by_action[action]))


def add_distance(df: DataFrame, latitude: float, longitude: float, output: str = "distance") -> DataFrame:
    """Add the distance in kilometres to a point."""
    here = F.lit(float(latitude)), F.lit(float(longitude))
    return df.withColumn(output, haversine_km(*here, F.col("latitude"), F.col("longitude")))


def nearby(
    profiles: DataFrame, scores: DataFrame, review_scores: DataFrame, *, action: str,
    latitude: float, longitude: float, limit: int = NEAREST,
    types_by_action: Mapping[str, Sequence[str]] = TYPES_BY_ACTION,
) -> DataFrame:
    """The nearest companies, better score first at equal distance, with their mean review score.

    The mean does not take part in the order, so it is computed for the chosen companies only. These
    few rows are written once, as they choose the reviews and are joined to them.
    """
    scored = of_action(profiles, action, types_by_action).join(
        scores.select("google_id", F.col("company_profile_score").alias("company_score")), "google_id"
    )
    order = [F.col("distance").asc_nulls_last(), F.desc("company_score"), F.col("google_id")]
    best = add_distance(scored, latitude, longitude).orderBy(*order).limit(limit)
    best = materialize(best, new_folder(profiles.sparkSession, "nearest"))
    theirs = review_scores.join(best.select("google_id"), "google_id", "left_semi")
    return best.join(mean_review_score(theirs), "google_id", "left").orderBy(*order)


def best_reviews(
    reviews: DataFrame, review_scores: DataFrame, companies: DataFrame | Sequence[str], *,
    limit: int = BEST_REVIEWS,
) -> DataFrame:
    """The best scored reviews of some companies: a list of keys, or a short frame with them."""
    def theirs(df: DataFrame) -> DataFrame:
        if isinstance(companies, DataFrame):
            return df.join(companies.select("google_id"), "google_id", "left_semi")
        return where_in(df, google_id=list(companies))

    key = ["google_id", "review_id"]
    return (
        theirs(reviews)
        .join(theirs(review_scores).select(*key, "user_review_score"), key)
        .orderBy(F.desc("user_review_score"), *key)
        .limit(limit)
    )
