"""Shapes of the physical plans, and hot keys in the analytical queries."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from checks import ORACLES, QUERIES
from checks import views as v
from listrata.plans import analysis, recommend

SMALL = "/root/testdata/sf0.001"
FORBIDDEN = ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval")
READS_ONLY = [n for n in QUERIES if not n.startswith(("layers_", "stream_"))]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", READS_ONLY)
def test_no_python_and_no_cross_joins(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    # Word tables made from a Python list are scanned as an existing RDD; nothing else is Python.
    assert not [word for word in FORBIDDEN if word in plan]


def test_registered_names():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["name", "type", "city", "state", "rating", "reviews", "company_score"]


def curated(spark):
    """Curated tables written once, as the analysis finds them."""
    frames = {
        "profiles": v.curated_profiles(spark, SMALL), "scores": v.scores(spark, SMALL),
        "reviews": v.reviews(spark, SMALL), "review_scores": v.review_scores(spark, SMALL),
    }
    tables = {}
    for name, df in frames.items():
        path = f"{spark.conf.get('spark.checkpoint.dir')}/curated/{name}"
        df.write.mode("overwrite").parquet(path)
        tables[name] = spark.read.parquet(path)
    return tables


@pytest.fixture(scope="module")
def tables(spark):
    return curated(spark)


def test_ranking_is_top_k_with_pushed_filters(spark, tables):
    plan = plan_of(analysis.rank_by_locality(tables["profiles"], tables["scores"], city="nation_1", limit=5))
    assert "TakeOrderedAndProject(limit=5" in plan
    assert "EqualTo(verified,1)" in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert not any("photos_count" in s or "latitude" in s for s in schemas)


def test_recommendation_averages_only_the_chosen(spark, tables):
    plan = plan_of(
        recommend.nearby(
            tables["profiles"], tables["scores"], tables["review_scores"], action="buy", latitude=30, longitude=-90,
            types_by_action=v.SEGMENTS,
        )
    )
    assert re.search(r"BroadcastHashJoin.*LeftSemi", plan)
    assert plan.count("nearest-") >= 2 and "customer" not in plan


def test_shares_need_no_single_partition_of_rows(spark, tables):
    plan = plan_of(analysis.type_share(tables["profiles"]))
    assert "Window" not in plan
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in part.split("\n")[1]


def test_hot_company(spark, tables):
    """A company with a third of all reviews: its reviews are thinned out before any shuffle by company."""
    many = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 150).cast("string")).alias("google_id"),
        F.col("id").cast("string").alias("review_id"), (F.col("id") % 100 / 100).alias("user_review_score"),
        F.when(F.col("id") % 2 == 0, "good,fast").otherwise("slow").alias("adjectives"),
    )
    best = analysis.top_reviewed_companies(tables["profiles"], tables["scores"], many)
    plan = plan_of(best)
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "REPARTITION" not in line]
    assert shuffles
    joined = best.count()
    assert joined == min(50, tables["profiles"].join(tables["scores"], "google_id").select("google_id").distinct().count())
    adjectives = analysis.top_adjectives(tables["profiles"], tables["scores"], many, many)
    assert re.search(r"BroadcastHashJoin.*LeftSemi", plan_of(adjectives))
    counted = adjectives.collect()
    assert {r.adjective for r in counted} == {"good", "fast", "slow"}
    top = recommend.best_reviews(many.drop("user_review_score"), many, ["1"])
    assert {r.user_review_score for r in top.collect()} == {0.99}
    means = {r.google_id: r.review_score for r in analysis.mean_review_score(many).collect()}
    assert len(means) == many.select("google_id").distinct().count()


def test_unknown_action(spark, tables):
    with pytest.raises(ValueError, match="action"):
        recommend.of_action(tables["profiles"], "rent")
    assert recommend.of_action(tables["profiles"], "sell").count() == 0
