"""The test tables seen as business listings: Spark frames and the same as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listrata.operators.columns import to_flags
from listrata.operators.scoring import company_score, review_score, scored_only

# The point that distances are measured from.
HERE = (30.0, -90.0)

# Which customer segments serve which action.
SEGMENTS = {"buy": ("BUILDING", "HOUSEHOLD"), "sell": ("MACHINERY", "FURNITURE"), "move": ("AUTOMOBILE",)}

POLAR_WORDS = [("great", 3.1), ("slow", -1.7), ("faint", 0.1)]
TEXT_WORDS = [("with", 1.9), ("for", 1.3), ("from", -1.5), ("that", -0.9)]
TAGGED_WORDS = [("the", "DT"), ("for", "JJ"), ("les", "JJR"), ("that", "JJS"), ("und", "CC"), ("with", "JJ")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def polar_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POLAR_WORDS, "word string, valence double")


def text_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEXT_WORDS, "word string, valence double")


def tagged_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TAGGED_WORDS, "word string, tag string")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One company per customer; its reviews are the number of its orders."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(orders, key == F.col("o_custkey"), "left")
        .select(
            key.cast("string").alias("google_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("type"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            (1 + key % 5).cast("double").alias("rating"),
            F.coalesce("n_orders", F.lit(0)).alias("reviews"),
            (key % 97).alias("photos_count"),
            (24 + F.col("c_nationkey").cast("double") + (key % 100) / 100).alias("latitude"),
            (-124 + 2 * F.col("c_nationkey").cast("double")).alias("longitude"),
            F.when(key % 10 == 0, "False").otherwise("True").alias("verified"),
            F.when(key % 7 == 0, "CLOSED").otherwise("OPERATIONAL").alias("business_status"),
        )
    )


PROFILES = """(
  SELECT CAST(c_custkey AS VARCHAR) AS google_id, c_name AS name, c_mktsegment AS type, n_name AS city,
    r_name AS state, CAST(1 + c_custkey % 5 AS DOUBLE) AS rating, coalesce(n_orders, 0) AS reviews,
    c_custkey % 97 AS photos_count,
    24e0 + CAST(c_nationkey AS DOUBLE) + CAST(c_custkey % 100 AS DOUBLE) / 100e0 AS latitude,
    -124e0 + 2e0 * CAST(c_nationkey AS DOUBLE) AS longitude,
    CASE WHEN c_custkey % 10 = 0 THEN 'False' ELSE 'True' END AS verified,
    CASE WHEN c_custkey % 7 = 0 THEN 'CLOSED' ELSE 'OPERATIONAL' END AS business_status
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey)"""


def curated_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operational companies with a numeric ``verified``."""
    return to_flags(profiles(spark, sf_dir).filter("business_status = 'OPERATIONAL'"), ["verified"])


CURATED_PROFILES = f"""(
  SELECT * REPLACE (CASE verified WHEN 'True' THEN 1 ELSE 0 END AS verified)
  FROM {PROFILES} p WHERE business_status = 'OPERATIONAL')"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = company_score(curated_profiles(spark, sf_dir), only_features=True)
    return scored_only(scored, "company_profile_score")


SCORES = f"""(
  SELECT google_id, 0.6e0 * (rating - 1) / 4
    + 0.3e0 * (ln(reviews + 1) - min(ln(reviews + 1)) OVER ())
      / (max(ln(reviews + 1)) OVER () - min(ln(reviews + 1)) OVER ())
    + 0.1e0 * (ln(photos_count + 1) - min(ln(photos_count + 1)) OVER ())
      / (max(ln(photos_count + 1)) OVER () - min(ln(photos_count + 1)) OVER ()) AS company_profile_score
  FROM {CURATED_PROFILES} c)"""


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per event of a user."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("review_id"),
        F.col("user_id").cast("string").alias("google_id"),
        (1 + F.col("event_id") % 5).cast("double").alias("review_rating"),
        F.floor("value").alias("review_likes"),
        F.col("ts").alias("review_timestamp"),
        F.concat_ws(" ", "event_type", "props").alias("review_text"),
        F.when(kind.isin("purchase", "signup"), "Positive").when(kind == "error", "Negative").otherwise("Neutral")
        .alias("sentiment"),
        F.element_at(
            F.array(*map(F.lit, ("great", "great,slow", "plain, faint,great", ""))),
            (F.col("event_id") % 4 + 1).cast("int"),
        ).alias("adjectives"),
    )


REVIEWS = """(
  SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS google_id,
    CAST(1 + event_id % 5 AS DOUBLE) AS review_rating, CAST(floor(value) AS BIGINT) AS review_likes,
    ts AS review_timestamp, event_type || ' ' || props AS review_text,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'Positive' WHEN event_type = 'error' THEN 'Negative'
      ELSE 'Neutral' END AS sentiment,
    CASE event_id % 4 WHEN 0 THEN 'great' WHEN 1 THEN 'great,slow' WHEN 2 THEN 'plain, faint,great'
      ELSE '' END AS adjectives
  FROM events)"""


def review_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = review_score(reviews(spark, sf_dir), polar_words(spark), only_features=True)
    return scored_only(scored, "user_review_score")


# Mean polarity by list: great 1, slow -1, faint its own score 0.1 / sqrt(0.01 + 15).
POLARITY = """CASE adjectives WHEN 'great' THEN 1e0 WHEN 'great,slow' THEN 0e0
  WHEN 'plain, faint,great' THEN (1e0 + round(0.1e0 / sqrt(15.01e0), 4)) / 2 END"""

REVIEW_SCORES = f"""(
  SELECT google_id, review_id, round_even(exp(-0.001e0 * days) * (0.6e0 * (review_rating - 1) / 4 + 0.3e0 * mood
      + 0.1e0 * polarity) * 100, 0) / 100 AS user_review_score
  FROM (
    SELECT *, floor(epoch(max(review_timestamp) OVER () - review_timestamp) / 86400) AS days,
      CASE sentiment WHEN 'Positive' THEN 1e0 WHEN 'Negative' THEN 0e0 ELSE 0.5e0 END AS mood,
      {POLARITY} AS polarity
    FROM {REVIEWS} r) t
  WHERE polarity IS NOT NULL)"""


def hours_text(key: Column) -> Column:
    """Working hours of a company as text of a Python dict: whole, without Sunday, with None, missing, mixed quotes."""
    return F.element_at(
        F.array(
            F.concat(F.lit("{'Monday': '"), (key % 12).cast("string"), F.lit("AM-5PM', 'Saturday': 'None, True', 'Sunday': 'Closed'}")),
            F.concat(F.lit("{'Monday': '8AM-"), (key % 7).cast("string"), F.lit("PM', 'Saturday': '9AM-1PM'}")),
            F.lit("{'Monday': 'Open 24 hours', 'Saturday': None, 'Sunday': 'Open 24 hours'}"),
            F.lit(None).cast("string"),
            F.lit("{\"Monday\": \"owner's hours\", 'Saturday': '9\\u202fAM', \"Sunday\": 'by \"call\"'}"),
        ),
        (key % 5 + 1).cast("int"),
    )


HOURS = """CASE k % 5 WHEN 0 THEN 'None, True' WHEN 1 THEN '9AM-1PM' WHEN 4 THEN '9' || chr(8239) || 'AM' END
    AS saturday_working_hours,
  CASE k % 5 WHEN 0 THEN 'Closed' WHEN 1 THEN 'Closed' WHEN 2 THEN 'Open 24 hours' WHEN 4 THEN 'by "call"' END
    AS sunday_working_hours,
  CASE k % 5 WHEN 0 THEN (k % 12) || 'AM-5PM' WHEN 1 THEN '8AM-' || (k % 7) || 'PM' WHEN 2 THEN 'Open 24 hours' WHEN 4 THEN 'owner''s hours' END
    AS weekdays_working_hours"""


def about_text(key: Column) -> Column:
    """Description of a company as JSON: full, partly false, odd categories, malformed, missing, empty."""
    return F.element_at(
        F.array(
            F.lit(
                '{"From the business": {"Identifies as women-owned": true, "Identifies as LGBTQ+ owned": true},'
                ' "Accessibility": {"Wheelchair accessible entrance": true}, "Payments": {"Checks": true},'
                ' "Crowd": {"LGBTQ+ friendly": true, "Transgender safespace": false},'
                ' "Service options": {"Online appointments": true, "Language assistance": "Spanish"}}'
            ),
            F.lit(
                '{"Accessibility": {"Wheelchair accessible entrance": false,'
                ' "Wheelchair accessible parking lot": true},'
                ' "Planning": {"Appointment required": "true"}, "Amenities": {"Gender-neutral restroom": true}}'
            ),
            F.lit('{"Crowd": 5, "Planning": ["x"], "Service options": {"Onsite services": 1}}'),
            F.lit('{"Accessibility": {"Wheelchair'),
            F.lit(None).cast("string"),
            F.lit("{}"),
        ),
        (key % 6 + 1).cast("int"),
    )


# Flags that some row names, as value by k % 6; all others are absent from every row.
ABOUT_CASES = {
    "identifies_as_women_owned": {0: 1},
    "identifies_as_lgbtq_plus_owned": {0: 1},
    "wheelchair_accessible_entrance": {0: 1, 1: 0},
    "wheelchair_accessible_parking_lot": {1: 1},
    "lgbtq_plus_friendly": {0: 1},
    "transgender_safespace": {0: 0},
    "online_appointments": {0: 1},
    "onsite_services": {2: 1},
    "appointment_required": {},
    "gender_neutral_restroom": {1: 1},
}


def about_sql(flags, absent: str) -> str:
    """The flags as SQL; a flag no row names is ``absent``."""
    parts = []
    for name in flags:
        cases = ABOUT_CASES.get(name)
        if cases is None:
            parts.append(f"{absent} AS {name}")
        elif not cases:
            parts.append(f"CAST(NULL AS INTEGER) AS {name}")
        else:
            whens = " ".join(f"WHEN {k} THEN {v}" for k, v in cases.items())
            parts.append(f"CASE k % 6 {whens} END AS {name}")
    parts.append("CASE k % 6 WHEN 0 THEN 'Spanish' END AS language_assistance")
    return ", ".join(parts)
