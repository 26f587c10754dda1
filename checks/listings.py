"""Extraction, scores, texts, analysis and recommendation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from listrata.functions.extraction import ABOUT_FLAGS
from listrata.operators import profiles as prof
from listrata.operators import scoring, texts
from listrata.plans import analysis, recommend


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Extraction


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("type"))


def _with_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _customers(spark, sf_dir).withColumn("working_hours", v.hours_text(F.col("k")))
    return prof.add_working_hours(raw).drop("working_hours")


@query("working_hours", f"SELECT c_custkey AS k, c_mktsegment AS type, {v.HOURS} FROM (SELECT *, c_custkey AS k FROM customer) c")
def working_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_hours(spark, sf_dir)


@query(
    "working_hours_quality",
    """SELECT sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 WHEN c_custkey % 5 <> 3 THEN 1 ELSE 0 END)::BIGINT AS texts,
      sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END)::BIGINT AS malformed FROM customer""",
)
def working_hours_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.when(F.col("type") == "BUILDING", "{'Monday': ").otherwise(v.hours_text(F.col("k")))
    return prof.malformed_hours(_customers(spark, sf_dir).withColumn("working_hours", broken))


def _about(spark: SparkSession, sf_dir: str, absent: str) -> DataFrame:
    raw = _customers(spark, sf_dir).withColumn("about", v.about_text(F.col("k")))
    return prof.add_about_flags(raw, absent=absent).drop("about", "type")


@query(
    "about_flags",
    f"SELECT k, {v.about_sql(ABOUT_FLAGS, 'CAST(NULL AS INTEGER)')} FROM (SELECT c_custkey AS k FROM customer) c",
)
def about_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _about(spark, sf_dir, "null")


@query(
    "about_flags_table",
    f"SELECT k, {v.about_sql(ABOUT_FLAGS, '0')} FROM (SELECT c_custkey AS k FROM customer) c",
)
def about_flags_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _about(spark, sf_dir, "table")


# Scores and distances


@query(
    "minmax_log",
    f"""SELECT google_id, round((ln(reviews + 1) - min(ln(reviews + 1)) OVER ())
      / (max(ln(reviews + 1)) OVER () - min(ln(reviews + 1)) OVER ()), 6) AS share FROM {v.PROFILES} p""",
)
def minmax_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = scoring.min_max_log(v.profiles(spark, sf_dir).select("google_id", "reviews"), "reviews", "share")
    return _rounded(scaled.select("google_id", "share"), "share")


@query("company_score", f"SELECT google_id, round(company_profile_score, 6) AS score FROM {v.SCORES} s")
def company_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = v.scores(spark, sf_dir)
    return _rounded(scored.select("google_id", F.col("company_profile_score").alias("score")), "score")


@query("review_score", f"SELECT google_id, review_id, user_review_score FROM {v.REVIEW_SCORES} s")
def review_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.review_scores(spark, sf_dir).select("google_id", "review_id", "user_review_score")


@query(
    "review_score_lenient",
    f"""SELECT review_id, round(S1, 6) AS S1, S2, round(coalesce(S3, -9), 6) AS S3, round(L, 6) AS L, delta_t,
      round_even(exp(-0.01e0 * delta_t) * (0.5e0 * S1 + 0.25e0 * coalesce(S3, 0) + 0.25e0 * L) * 100, 0) / 100 AS score
    FROM (SELECT review_id, (review_rating - 1) / 4 AS S1, {v.POLARITY} AS S3,
      CASE sentiment WHEN 'Positive' THEN 1e0 WHEN 'Negative' THEN 0e0 ELSE 0.5e0 END AS S2,
      (ln(review_likes + 1) - min(ln(review_likes + 1)) OVER ())
        / (max(ln(review_likes + 1)) OVER () - min(ln(review_likes + 1)) OVER ()) AS L,
      CAST(floor(epoch(max(review_timestamp) OVER () - review_timestamp) / 86400) AS BIGINT) AS delta_t
      FROM {v.REVIEWS} r) t""",
)
def review_score_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = {"review_rating": 2, "sentiment": 0, "adjectives_sentiment": 1, "review_likes": 1}
    scored = scoring.review_score(
        v.reviews(spark, sf_dir), v.polar_words(spark), decay=0.01, weights=weights, keep_parts=True, strict=False
    )
    parts = scored.withColumn("S3", F.coalesce("S3", F.lit(-9.0))).withColumn("score", F.col("user_review_score"))
    return _rounded(parts.select("review_id", "S1", "S2", "S3", "L", "delta_t", "score"), "S1", "S3", "L")


_AGED = f"""SELECT review_id, CAST(floor(epoch(max(review_timestamp) OVER () - review_timestamp) / 86400) AS BIGINT)
    AS delta_t FROM {v.REVIEWS} r"""


@query("recency_days", _AGED)
def recency_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.recency(v.reviews(spark, sf_dir), "review_timestamp").select("review_id", "delta_t")


@query("recency_weight", f"SELECT review_id, round(exp(-0.02e0 * delta_t), 6) AS W FROM ({_AGED}) a")
def recency_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    aged = scoring.recency(v.reviews(spark, sf_dir), "review_timestamp", decay=0.02)
    return _rounded(aged.select("review_id", "W"), "W")


def _distance(latitude: str, longitude: str) -> str:
    """Great-circle distance by the angle between unit vectors."""
    north, east = v.HERE
    return f"""6371 * 2 * asin(sqrt(pow(sin(radians({latitude} - {north}) / 2), 2)
      + cos(radians({north})) * cos(radians({latitude})) * pow(sin(radians({longitude} - {east}) / 2), 2)))"""


@query("haversine", f"SELECT google_id, round({_distance('latitude', 'longitude')}, 6) AS distance FROM {v.PROFILES} p")
def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    far = recommend.add_distance(v.profiles(spark, sf_dir), *v.HERE)
    return _rounded(far.select("google_id", "distance"), "distance")


# Texts

_LEXICON = "(VALUES " + ", ".join(f"('{w}', {x}e0)" for w, x in v.TEXT_WORDS) + ") AS lex(word, valence)"
_SPACE = r"[\t-\r\x1c- \x{85}\p{Z}]+"
_MARKS = r"[!-/:-@\[-`{-~]+"


_NEGATIONS = "not never none nor nothing nowhere neither without cannot rarely seldom despite"
_STRONGER = "very really so most more quite extremely especially highly greatly totally completely absolutely"
_WEAKER = "almost barely hardly less little partly slightly somewhat occasionally"


def sentiment_oracle(source: str, key: str, text: str) -> str:
    """Sentiment by rows of tokens and window functions: valence, capitals, and "but".

    Written from the published rules, with its own words: the commonest boosters and negations.
    Rules on rarer words do not come up in the test texts and are tested by hand-made sentences.
    """

    def words(items: str) -> str:
        return ", ".join(f"'{w}'" for w in items.split())

    def boost(w: str) -> str:
        return f"CASE WHEN {w} IN ({words(_STRONGER)}) THEN 0.293e0 WHEN {w} IN ({words(_WEAKER)}) THEN -0.293e0 END"

    steps, last = [], "r0"
    for k, damping in ((1, 1), (2, 0.95), (3, 0.9)):
        steps.append(
            f"""r{k} AS (SELECT *, CASE WHEN w{k} IS NULL OR v{k} IS NOT NULL THEN x{k - 1} ELSE
              (x{k - 1} + coalesce(({boost(f'w{k}')} + CASE WHEN loud AND up{k} THEN 0.733e0 ELSE 0 END) * sign(x{k - 1})
                * {damping}, 0))
              * CASE WHEN w{k} IN ({words(_NEGATIONS)}) OR contains(w{k}, 'n''t') THEN -0.74e0 ELSE 1 END
              END AS x{k} FROM {last})"""
        )
        last = f"r{k}"
    lags = ", ".join(f"lag({c}, {k}) OVER seq AS {c}{k}" for k in (1, 2, 3) for c in ("w", "v", "up"))
    return f"""
    WITH parts AS (SELECT {key} AS k, regexp_split_to_array({text}, '{_SPACE}') AS l FROM {source}),
    raw AS (SELECT k, generate_subscripts(l, 1) AS pos, unnest(l) AS t FROM parts),
    bare AS (SELECT k, pos, t, regexp_replace(t, '^{_MARKS}|{_MARKS}$', '', 'g') AS b FROM raw WHERE t <> ''),
    tok AS (SELECT k, pos, CASE WHEN length(b) > 2 THEN b ELSE t END AS t FROM bare),
    hit AS (SELECT k, pos, lower(t) AS w, lex.valence AS v, t = upper(t) AND t <> lower(t) AS up
      FROM tok LEFT JOIN {_LEXICON} ON lex.word = lower(t)),
    ctx AS (SELECT *, {lags}, count(*) OVER doc AS n, sum(CASE WHEN up THEN 1 ELSE 0 END) OVER doc AS n_up,
      min(CASE WHEN w = 'but' THEN pos END) OVER doc AS but FROM hit
      WINDOW seq AS (PARTITION BY k ORDER BY pos), doc AS (PARTITION BY k)),
    r0 AS (SELECT *, n_up > 0 AND n_up < n AS loud,
      v + CASE WHEN up AND n_up < n THEN 0.733e0 * sign(v) ELSE 0 END AS x0 FROM ctx WHERE v IS NOT NULL),
    {", ".join(steps)},
    total AS (SELECT k, sum(x3 * CASE WHEN but IS NULL OR pos = but THEN 1 WHEN pos < but THEN 0.5e0 ELSE 1.5e0 END) AS s
      FROM r3 GROUP BY k),
    marks AS (SELECT {key} AS k, coalesce(s, 0) AS s,
      least(length({text}) - length(replace({text}, '!', '')), 4) * 0.292e0 AS bang,
      length({text}) - length(replace({text}, '?', '')) AS asks FROM {source} LEFT JOIN total ON total.k = {key}),
    amp AS (SELECT k, s + sign(s) * (bang + CASE WHEN asks > 3 THEN 0.96e0 WHEN asks > 1 THEN 0.18e0 * asks ELSE 0 END)
      AS s FROM marks),
    compound AS (SELECT k, round(s / sqrt(s * s + 15), 4) AS score FROM amp)
    SELECT k AS {key}, score, CASE WHEN score >= 0.05 THEN 'Positive' WHEN score <= -0.05 THEN 'Negative' ELSE 'Neutral' END
      AS sentiment FROM compound"""


@query("sentiment_label", f"SELECT doc_id, sentiment FROM ({sentiment_oracle('documents', 'doc_id', 'text')}) s")
def sentiment_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = v.table(spark, sf_dir, "documents").select("doc_id", "text")
    return texts.add_sentiment(documents, "text", v.text_words(spark)).drop("text")


@query(
    "sentiment_label_joined",
    f"SELECT doc_id, sentiment FROM ({sentiment_oracle('documents', 'doc_id', 'text')}) s",
)
def sentiment_label_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way for word tables too large for a subquery."""
    documents = v.table(spark, sf_dir, "documents").select("doc_id", "text")
    return texts.add_sentiment(documents, "text", v.text_words(spark), most_bytes=0).drop("text")


@query(
    "sentiment_repeated_keys",
    f"""SELECT CASE WHEN doc_id % 7 <> 0 THEN doc_id % 7 END AS company, sentiment
    FROM ({sentiment_oracle('documents', 'doc_id', 'text')}) s""",
)
def sentiment_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose own columns do not tell them apart, by the way for large word tables."""
    company = F.when(F.col("doc_id") % 7 != 0, F.col("doc_id") % 7).alias("company")
    documents = v.table(spark, sf_dir, "documents").select(company, "text")
    return texts.add_sentiment(documents, "text", v.text_words(spark), most_bytes=0).drop("text")


_ADJECTIVES = ", ".join(f"'{w}'" for w, tag in v.TAGGED_WORDS if tag.startswith("JJ"))


def adjective_oracle(source: str, key: str, text: str) -> str:
    return f"""
    WITH parts AS (SELECT {key} AS k, regexp_extract_all({text}, '\\p{{L}}+(?:[''’-]\\p{{L}}+)*') AS l FROM {source}),
    raw AS (SELECT k, generate_subscripts(l, 1) AS pos, unnest(l) AS t FROM parts),
    kept AS (SELECT k, string_agg(t, ',' ORDER BY pos) AS a FROM raw WHERE lower(t) IN ({_ADJECTIVES}) GROUP BY k)
    SELECT {key}, coalesce(a, '') AS adjectives FROM {source} LEFT JOIN kept ON kept.k = {key}"""


@query("adjective_list", adjective_oracle("documents", "doc_id", "text"))
def adjective_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = v.table(spark, sf_dir, "documents").select("doc_id", "text")
    return texts.add_adjectives(documents, "text", v.tagged_words(spark)).drop("text")


@query(
    "adjective_polarity",
    f"SELECT review_id, round(polarity, 6) AS polarity FROM (SELECT review_id, {v.POLARITY} AS polarity FROM {v.REVIEWS} r) t",
)
def adjective_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = texts.add_polarity(v.reviews(spark, sf_dir), "adjectives", v.polar_words(spark))
    return _rounded(rated.select("review_id", "polarity"), "polarity")


@query(
    "token_counts",
    f"""SELECT trim(item) AS adjective, count(*) AS count
    FROM (SELECT unnest(string_split(adjectives, ',')) AS item FROM {v.REVIEWS} r) t GROUP BY trim(item)""",
)
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.count_items(v.reviews(spark, sf_dir), "adjectives")


# Analysis


@query(
    "avg_review_score",
    f"SELECT google_id, round(avg(user_review_score), 6) AS review_score FROM {v.REVIEW_SCORES} s GROUP BY google_id",
)
def avg_review_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.mean_review_score(v.review_scores(spark, sf_dir)), "review_score")


@query(
    "flag_share_by_city",
    f"""SELECT city, round(sum(CASE photos_count % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END) * 100e0 / count(*), 6)
      AS wheelchair_share FROM {v.PROFILES} p WHERE type IN ('BUILDING', 'MACHINERY') GROUP BY city""",
)
def flag_share_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("photos_count") % 3 == 0, 1).when(F.col("photos_count") % 3 == 1, 0)
    flagged = v.profiles(spark, sf_dir).withColumn("wheelchair_accessible_entrance", flag)
    shares = analysis.flag_share_by_city(
        flagged, "wheelchair_accessible_entrance", "wheelchair_share", types=["BUILDING", "MACHINERY"]
    )
    return _rounded(shares, "wheelchair_share")


def _share_sql(column: str, source: str, where: str) -> str:
    return f"""SELECT {column}, count(*) AS total_companies,
      CAST(round(CAST(count(*) * 100 AS DECIMAL(18, 0)) / sum(count(*)) OVER (), 2) AS DOUBLE) AS representation
    FROM {source} WHERE {where} GROUP BY {column}"""


@query("type_share", _share_sql("type", f"{v.PROFILES} p", "type IN ('BUILDING', 'MACHINERY', 'FURNITURE')"))
def type_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.type_share(v.profiles(spark, sf_dir), types=["BUILDING", "MACHINERY", "FURNITURE"])


def _hours_sql(column: str) -> str:
    source = f"(SELECT type, {v.HOURS} FROM (SELECT c_custkey AS k, c_mktsegment AS type FROM customer) c) h"
    return f"""SELECT '{column}' AS kind, {column} AS hours, total_companies, representation FROM (
      {_share_sql(column, source, f"type <> 'FURNITURE' AND {column} IS NOT NULL")}
      ORDER BY representation DESC, total_companies DESC, {column} LIMIT 10) s"""


_HOURS_COLUMNS = ("weekdays_working_hours", "saturday_working_hours", "sunday_working_hours")


@query("hours_share", " UNION ALL ".join(f"({_hours_sql(c)})" for c in _HOURS_COLUMNS))
def hours_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = _with_hours(spark, sf_dir)
    types = ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"]
    tops = [
        analysis.hours_share(companies, c, types=types)
        .withColumnRenamed(c, "hours").withColumn("kind", F.lit(c))
        for c in _HOURS_COLUMNS
    ]
    return tops[0].unionByName(tops[1]).unionByName(tops[2])


@query(
    "distinct_types",
    f"SELECT DISTINCT type FROM {v.PROFILES} p JOIN {v.REVIEWS} r ON p.google_id = r.google_id",
)
def distinct_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.types_with_reviews(v.profiles(spark, sf_dir), v.reviews(spark, sf_dir))


_RANKED = f"""SELECT name, type, city, state, rating, reviews, round(company_profile_score, 6) AS company_score
    FROM {v.CURATED_PROFILES} p JOIN {v.SCORES} s ON p.google_id = s.google_id WHERE verified = 1"""


@query(
    "rank_by_locality",
    f"""{_RANKED} AND city IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_7') AND type IN ('BUILDING', 'MACHINERY')
    ORDER BY company_profile_score DESC, p.google_id LIMIT 5""",
)
def rank_by_locality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = analysis.rank_by_locality(
        v.curated_profiles(spark, sf_dir), v.scores(spark, sf_dir),
        city=["nation_1", "Nation_2", "NATION_3", "nation_7"], company_type=["building", "Machinery"], limit=5,
    )
    return _rounded(ranked, "company_score")


@query("rank_all", _RANKED)
def rank_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = analysis.rank_by_locality(v.curated_profiles(spark, sf_dir), v.scores(spark, sf_dir))
    return _rounded(ranked, "company_score")


_BEST = f"""SELECT p.google_id, company_profile_score AS company_score
    FROM {v.PROFILES} p JOIN {v.SCORES} s ON p.google_id = s.google_id
    JOIN (SELECT google_id, avg(user_review_score) AS review_score FROM {v.REVIEW_SCORES} x GROUP BY google_id) r
      ON r.google_id = p.google_id
    WHERE review_score IS NOT NULL AND type IN ('BUILDING', 'MACHINERY', 'FURNITURE')
    ORDER BY company_profile_score DESC, p.google_id LIMIT 50"""


@query("top50_with_reviews", f"SELECT google_id, round(company_score, 6) AS company_score FROM ({_BEST}) b")
def top50_with_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = analysis.top_reviewed_companies(
        v.profiles(spark, sf_dir), v.scores(spark, sf_dir), v.review_scores(spark, sf_dir),
        types=["BUILDING", "MACHINERY", "FURNITURE"],
    )
    return _rounded(best, "company_score")


@query(
    "top50_adjectives",
    f"""SELECT trim(item) AS adjective, count(*) AS count FROM (
      SELECT unnest(string_split(adjectives, ',')) AS item FROM (
        SELECT DISTINCT adjectives FROM ({_BEST}) b LEFT JOIN {v.REVIEWS} f ON b.google_id = f.google_id) d
      WHERE adjectives IS NOT NULL) t
    GROUP BY trim(item) ORDER BY count(*) DESC, trim(item) LIMIT 10""",
)
def top50_adjectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.top_adjectives(
        v.profiles(spark, sf_dir), v.scores(spark, sf_dir), v.reviews(spark, sf_dir), v.review_scores(spark, sf_dir),
        types=["BUILDING", "MACHINERY", "FURNITURE"],
    )


# Recommendation

_NEAR = f"""SELECT p.google_id, name, city, type, rating, reviews, company_profile_score AS company_score, review_score,
      {_distance('latitude', 'longitude')} AS distance
    FROM {v.CURATED_PROFILES} p JOIN {v.SCORES} s ON p.google_id = s.google_id
    LEFT JOIN (SELECT google_id, avg(user_review_score) AS review_score FROM {v.REVIEW_SCORES} x GROUP BY google_id) r
      ON r.google_id = p.google_id
    WHERE type IN ('BUILDING', 'HOUSEHOLD') ORDER BY round(distance, 9), company_score DESC, p.google_id LIMIT 5"""


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.nearby(
        v.curated_profiles(spark, sf_dir), v.scores(spark, sf_dir), v.review_scores(spark, sf_dir),
        action="buy", latitude=v.HERE[0], longitude=v.HERE[1], types_by_action=v.SEGMENTS,
    )


@query(
    "recommend_nearby",
    f"""SELECT google_id, name, city, type, rating, reviews, round(company_score, 6) AS company_score,
      round(review_score, 6) AS review_score, round(distance, 6) AS distance FROM ({_NEAR}) n""",
)
def recommend_nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = _near(spark, sf_dir).select(
        "google_id", "name", "city", "type", "rating", "reviews", "company_score", "review_score", "distance"
    )
    return _rounded(near, "company_score", "review_score", "distance")


_MOST_REVIEWED = f"""SELECT google_id FROM {v.REVIEWS} r GROUP BY google_id ORDER BY count(*) DESC, google_id LIMIT 5"""


@query(
    "best_reviews",
    f"""SELECT r.google_id, r.review_id, review_text, review_rating, user_review_score
    FROM {v.REVIEWS} r JOIN {v.REVIEW_SCORES} s ON r.review_id = s.review_id AND r.google_id = s.google_id
    WHERE r.google_id IN ({_MOST_REVIEWED}) ORDER BY user_review_score DESC, r.google_id, r.review_id LIMIT 5""",
)
def best_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = v.reviews(spark, sf_dir)
    busiest = (
        reviews.groupBy("google_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "google_id").limit(5)
    )
    best = recommend.best_reviews(reviews, v.review_scores(spark, sf_dir), busiest)
    return best.select("google_id", "review_id", "review_text", "review_rating", "user_review_score")


@query(
    "recommended_reviews",
    f"""SELECT r.google_id, r.review_id, review_text, user_review_score
    FROM {v.REVIEWS} r JOIN {v.REVIEW_SCORES} s ON r.review_id = s.review_id AND r.google_id = s.google_id
    WHERE r.google_id IN (SELECT google_id FROM ({_NEAR}) n)
    ORDER BY user_review_score DESC, r.google_id, r.review_id LIMIT 5""",
)
def recommended_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = recommend.best_reviews(v.reviews(spark, sf_dir), v.review_scores(spark, sf_dir), _near(spark, sf_dir))
    return best.select("google_id", "review_id", "review_text", "user_review_score")
