"""Analytical queries over the curated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listrata.operators.columns import where_in, where_in_any_case, where_present
from listrata.operators.texts import count_items

# Company types the analysis is about.
REAL_ESTATE_TYPES = (
    "Real estate agency",
    "Real estate consultant",
    "Real estate agent",
    "Property investment",
    "Property management company",
)
TOP_COMPANIES = 50
TOP_ITEMS = 10

Wanted = str | Sequence[str] | None


def _of_types(profiles: DataFrame, types: Wanted) -> DataFrame:
    return where_in(profiles, type=types)


def rank_by_locality(
    profiles: DataFrame, scores: DataFrame, *, city: Wanted = None, state: Wanted = None,
    company_type: Wanted = None, limit: int | None = None,
) -> DataFrame:
    """Verified companies by score, best first; filters ignore capitals. Ties go by key."""
    wanted = where_in_any_case(profiles.filter("verified = 1"), type=company_type, city=city, state=state)
    ranked = (
        wanted.select("google_id", "name", "type", "city", "state", "rating", "reviews")
        .join(scores.select("google_id", F.col("company_profile_score").alias("company_score")), "google_id")
        .orderBy(F.desc("company_score"), "google_id")
    )
    if limit is not None:
        ranked = ranked.limit(limit)
    return ranked.drop("google_id")


def flag_share_by_city(profiles: DataFrame, flag: str, output: str, *, types: Wanted = None) -> DataFrame:
    """Percentage of companies with a 0/1 flag per city; a company without the flag counts as one."""
    share = F.sum(flag) / F.count(F.lit(1)) * 100
    return _of_types(profiles, types).groupBy("city").agg(share.alias(output))


def share_of(df: DataFrame, column: str, *, limit: int | None = None) -> DataFrame:
    """Rows per value and their percentage of all rows, two decimals, greatest first."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("total_companies"))
    total = counted.agg(F.sum("total_companies")).scalar()
    share = (F.col("total_companies") * 100).cast("decimal(20,0)") / total.cast("decimal(20,0)")
    shared = counted.withColumn("representation", F.round(share, 2).cast("double")).orderBy(
        F.desc("representation"), F.desc("total_companies"), column
    )
    return shared.limit(limit) if limit is not None else shared


def type_share(profiles: DataFrame, *, types: Wanted = None) -> DataFrame:
    return share_of(_of_types(profiles, types), "type")


def hours_share(
    profiles: DataFrame, hours_column: str, *, types: Wanted = None, limit: int = TOP_ITEMS,
) -> DataFrame:
    """Most common working hours of one of the hours columns."""
    return share_of(where_present(_of_types(profiles, types), hours_column), hours_column, limit=limit)


def mean_review_score(review_scores: DataFrame) -> DataFrame:
    return review_scores.groupBy("google_id").agg(F.avg("user_review_score").alias("review_score"))


def top_reviewed_companies(
    profiles: DataFrame, scores: DataFrame, review_scores: DataFrame, *, types: Wanted = None,
    limit: int = TOP_COMPANIES,
) -> DataFrame:
    """The best companies among those with a review score, as (google_id, company_score).

    A company has a mean review score exactly if it has one scored review, so the distinct keys
    are enough; they are thinned out before the shuffle, however many reviews a company has.
    """
    reviewed = where_present(review_scores, "user_review_score").select("google_id").distinct()
    return (
        _of_types(profiles, types)
        .select("google_id")
        .join(scores.select("google_id", F.col("company_profile_score").alias("company_score")), "google_id")
        .join(reviewed, "google_id", "left_semi")
        .orderBy(F.desc("company_score"), "google_id")
        .limit(limit)
    )


def top_adjectives(
    profiles: DataFrame, scores: DataFrame, reviews: DataFrame, review_scores: DataFrame, *,
    types: Wanted = None, companies: int = TOP_COMPANIES, limit: int = TOP_ITEMS,
) -> DataFrame:
    """Most frequent adjectives over the distinct adjective lists of the best reviewed companies.

    As the companies are few, Spark sends them to the reviews, which are not shuffled.
    """
    best = top_reviewed_companies(profiles, scores, review_scores, types=types, limit=companies)
    lists = reviews.join(best.select("google_id"), "google_id", "left_semi")
    return count_items(lists.select("adjectives").distinct(), "adjectives", limit=limit)


def types_with_reviews(profiles: DataFrame, reviews: DataFrame) -> DataFrame:
    """Distinct types of companies that have reviews."""
    reviewed = reviews.select("google_id").distinct()
    return profiles.join(reviewed, "google_id", "left_semi").select("type").distinct()
