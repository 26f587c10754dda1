"""Hand-made rows for cleaning, casts and dates."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from listrata.functions import times
from listrata.operators import columns as cols
from listrata.operators import rows


def values(df, column):
    return [r[0] for r in df.orderBy("k").select(column).collect()]


def frame(spark, items, kind):
    return spark.createDataFrame(list(enumerate(items)), f"k int, x {kind}")


def test_numbers_from_text(spark):
    texts = [" 12 ", "1e3", "1,000", "0x10", "5d", "5f", "inf", "-Infinity", "", "nan", None, ".5", "5.", "+7", "1 2"]
    got = values(cols.to_numbers(frame(spark, texts, "string"), ["x"]), "x")
    assert got == [12.0, 1000.0, None, None, None, None, math.inf, -math.inf, None, None, None, 0.5, 5.0, 7.0, None]


def test_numbers_stay_numbers(spark):
    assert values(cols.to_numbers(frame(spark, [1.5, float("nan"), None], "double"), ["x"]), "x") == [1.5, None, None]
    assert values(cols.to_numbers(frame(spark, [7, None], "bigint"), ["x"]), "x") == [7, None]


def test_id_text(spark):
    floats = [1234567.0, 123456789012345680.0, 2.5, 3.5, float("nan"), None]
    assert values(cols.to_id_text(frame(spark, floats, "double"), ["x"]), "x") == [
        "1234567", "123456789012345680", "2", "4", None, None,
    ]
    assert values(cols.to_id_text(frame(spark, ["0x89:0xab", "007", None], "string"), ["x"]), "x") == [
        "0x89:0xab", "007", None,
    ]
    assert values(cols.to_id_text(frame(spark, [42, None], "int"), ["x"]), "x") == ["42", None]


def test_raw_ids_lose_float_endings(spark):
    raw = ["123.0", "123.50", "12345678901234567890.00", "a.0", "5.", None]
    assert values(cols.raw_ids(frame(spark, raw, "string"), ["x"]), "x") == [
        "123", "123.50", "12345678901234567890", "a.0", "5", None,
    ]


def test_flags(spark):
    texts = ["True", "true", "False", "false", None, "5"]
    assert values(cols.to_flags(frame(spark, texts, "string"), ["x"]), "x") == [1, 1, 0, 0, 0, 5]
    assert values(cols.to_flags(frame(spark, [True, False, None], "boolean"), ["x"]), "x") == [1, 0, 0]
    assert values(cols.to_flags(frame(spark, [1.0, 7.0, float("nan"), None], "double"), ["x"]), "x") == [1, 7, 0, 0]
    with pytest.raises(Exception, match="neither truth value nor number: abc"):
        cols.to_flags(frame(spark, ["abc"], "string"), ["x"]).collect()


def test_flag_texts(spark):
    texts = ["True", "false", None, "maybe"]
    assert values(cols.to_flag_texts(frame(spark, texts, "string"), ["x"], "y", "n"), "x") == ["y", "n", "", "maybe"]
    truth = frame(spark, [True, False, None], "boolean")
    assert values(cols.to_flag_texts(truth, ["x"], "y", "n", "?"), "x") == ["y", "n", "?"]


def test_fill(spark):
    assert values(cols.fill_missing(frame(spark, [1.0, float("nan"), None], "double"), ["x"], 0), "x") == [1.0, 0.0, 0.0]
    assert values(cols.fill_missing(frame(spark, ["a", None], "string"), ["x", "absent"], 0), "x") == ["a", "0"]
    untouched = frame(spark, [None], "string")
    assert cols.fill_missing(untouched, ["x"], None) is untouched


def test_strict_casts(spark):
    assert values(cols.cast_columns(frame(spark, ["12.0", "-3.7", "1e3"], "string"), {"x": "int64"}), "x") == [12, -3, 1000]
    assert values(cols.cast_columns(frame(spark, [9007199254740993], "bigint"), {"x": "Int64"}), "x") == [9007199254740993]
    assert values(cols.cast_columns(frame(spark, [None, 4.0], "double"), {"x": "Int64"}), "x") == [None, 4]
    for bad, kind, target in (
        ("x1", "string", "int64"), (None, "string", "int64"), (float("nan"), "double", "int32"),
        (3e9, "double", "int32"), ("many", "string", "float64"),
    ):
        with pytest.raises(Exception):
            cols.cast_columns(frame(spark, [bad], kind), {"x": target}).collect()
    with pytest.raises(KeyError, match="absent"):
        cols.cast_columns(frame(spark, [1], "int"), {"absent": "int64"})


def test_strictness_does_not_depend_on_the_session(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not of type bigint: x1"):
            cols.cast_columns(frame(spark, ["x1"], "string"), {"x": "Int64"}).collect()
        with pytest.raises(Exception, match="not of type int"):
            cols.cast_columns(frame(spark, [3e9], "double"), {"x": "int32"}).collect()
        with pytest.raises(Exception, match="neither truth"):
            cols.to_flags(frame(spark, ["abc"], "string"), ["x"]).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_epochs(spark):
    moment = datetime(2023, 11, 14, 22, 13, 20)
    for unit, count in (("s", 1_700_000_000), ("ms", 1_700_000_000_000), ("ns", 1_700_000_000_000_000_000)):
        got = values(cols.to_timestamps(frame(spark, [count, None], "bigint"), ["x"], unit=unit), "x")
        assert got == [moment, None]
    early = cols.to_timestamps(frame(spark, [-1_500_000_001], "bigint"), ["x"], unit="ns")
    assert values(early, "x") == [datetime(1969, 12, 31, 23, 59, 58, 499999)]
    with pytest.raises(ValueError, match="unit"):
        times.from_epoch(F.lit(1), "h")


def test_dates(spark):
    texts = ["2024-01-05", "2024-01-05T10:30:00", "2024-01-05 10:30:00.25", "01/05/2024 10:30:00", "01/05/2024", None]
    got = values(cols.to_timestamps(frame(spark, texts, "string"), ["x"]), "x")
    day, noon = datetime(2024, 1, 5), datetime(2024, 1, 5, 10, 30)
    assert got == [day, noon, noon.replace(microsecond=250000), noon, day, None]
    lenient = frame(spark, ["junk", "05.01.2024"], "string")
    assert values(cols.to_timestamps(lenient, ["x"], format="dd.MM.yyyy", strict=False), "x") == [None, day]
    with pytest.raises(Exception, match="not a date: "):
        cols.to_timestamps(lenient, ["x"]).collect()
    with pytest.raises(ValueError, match="only one"):
        times.parse_time(F.lit("x"), format="yyyy", unit="s")


def test_whole_days(spark):
    newest = datetime(2024, 3, 10, 12, 0)
    items = [datetime(2024, 3, 9, 12, 1), datetime(2024, 3, 9, 12, 0), newest, None]
    df = frame(spark, items, "timestamp").withColumn("d", times.whole_days(F.col("x"), F.lit(newest).cast("timestamp")))
    assert values(df, "d") == [0, 1, 0, None]


def test_empty_columns(spark):
    rows_ = [(1, None, float("nan"), None), (2, None, None, "late")]
    df = spark.createDataFrame(rows_, "a int, b string, c double, d string")
    assert rows.drop_empty_columns(df).columns == ["a", "d"]
    assert rows.drop_empty_columns(df, keep=["b"]).columns == ["a", "b", "d"]
    assert rows.drop_empty_columns(df.filter("a > 5")).columns == []


def test_empty_columns_beyond_the_probe(spark):
    many = spark.range(rows.PROBE_ROWS * 20).select("id", F.when(F.col("id") == 19_999, 1).alias("rare"), F.lit(None).alias("none"))
    assert rows.drop_empty_columns(many).columns == ["id", "rare"]


def test_empty_rows_and_duplicates(spark):
    items = [(1, "a"), (1, "a"), (None, None), (2, None), (2, None)]
    df = spark.createDataFrame(items, "a int, b string")
    assert sorted(map(tuple, rows.drop_empty_rows(df).collect()), key=str) == [(1, "a"), (1, "a"), (2, None), (2, None)]
    assert rows.drop_duplicate_rows(df).count() == 3
    ordered = df.withColumn("n", F.when(F.col("a") == 1, 7).otherwise(3) + F.rand(1))
    first = {(r.a, r.b): r.n for r in rows.drop_duplicate_rows(ordered, "n").collect()}
    assert first[(1, "a")] == ordered.filter("a = 1").agg(F.min("n")).first()[0]


def test_filters(spark):
    df = spark.createDataFrame([("miami", 1.0), ("MIAMI", float("nan")), ("New York", None)], "city string, x double")
    assert cols.where_in_any_case(df, city="Miami").count() == 2
    assert cols.where_in_any_case(df, city=["new york", "FL"], state=None).count() == 1
    assert cols.where_in(df, city=["miami", "New York"], x=None).count() == 2
    assert cols.where_in(df, city="miami").count() == 1
    assert cols.where_present(df, "x").count() == 1
    assert cols.filter_rows(df, "x > 0 AND NOT isnan(x)").count() == 1
    assert cols.filter_rows(df, lambda d: d["city"].startswith("N")).count() == 1


def test_projection_and_columns(spark):
    df = spark.createDataFrame([(1, "a")], "k int, x string")
    assert cols.project(df, ["x", "gone"]).schema.simpleString() == "struct<x:string,gone:string>"
    assert cols.drop_columns(df, ["x", "gone"]).columns == ["k"]
    assert cols.add_column(df, "y", "k + 1").first()["y"] == 2
    assert cols.add_column(df, "k", lambda d: d["k"] * 10).first()["k"] == 10
    moment = datetime(2024, 1, 1)
    assert tuple(cols.stamp(df, moment).first()) == (moment, 1, "a")
    assert cols.stamp(df, moment).columns[0] == "process_timestamp"


def test_empty_columns_from_footers(spark, tmp_path):
    """The same columns as by rows; counts of values come from the files' footers."""
    df = spark.range(5000).selectExpr(
        "id", "cast(null as string) as nothing", "if(id = 4999, 'x', null) as rare", "cast('NaN' as double) as nan",
        "if(id = 1, 1D, double('NaN')) as some", "named_struct('a', cast(null as int)) as nested", "cast(null as date) as `no.day`",
    )
    path = str(tmp_path / "t")
    df.repartition(3).write.parquet(path)
    assert rows.empty_columns_of_files(spark, path) == rows.empty_columns(spark.read.parquet(path))
    assert {"nothing", "nan", "no.day"} <= set(rows.empty_columns_of_files(spark, path))
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = other.read.parquet(path).agg(F.count("rare"), F.count("nothing"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(rare), COUNT(nothing)]" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # the caller's session is as it was
