"""Merging by key against a plain Python model, ties, null keys, hot keys, and the table on disk."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listrata.operators import upsert
from listrata.sources import files

SCHEMA = f"k string, m int, v int, {files.ROW_ORDER} bigint"


def model(existing, new, by_modification):
    """Rows (k, m, v); later rows of the batch win, null keys are equal, a null modification loses."""
    kept = {}
    for batch, rows in ((0, existing), (1, new)):
        for place, (k, m, v) in enumerate(rows):
            rank = ((m is not None, m or 0) if by_modification else (), batch, place)
            if k not in kept or rank > kept[k][0]:
                kept[k] = (rank, (k, m, v))
    return sorted((row for _, row in kept.values()), key=str)


def frames(spark, existing, new):
    old = spark.createDataFrame(existing, "k string, m int, v int")
    batch = spark.createDataFrame([(*r, i) for i, r in enumerate(new)], SCHEMA)
    return old, batch.repartition(3, "v")


def rows(df):
    return sorted(map(tuple, df.select("k", "m", "v").collect()), key=str)


keys = st.sampled_from(["a", "b", "c", "d", None])
moments = st.one_of(st.none(), st.integers(0, 3))
batches = st.lists(st.tuples(keys, moments, st.integers(0, 99)), max_size=12)
tables = st.dictionaries(keys, st.tuples(moments, st.integers(0, 99)), max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(existing=tables, new=batches)
def test_against_model(spark, existing, new):
    existing = [(k, m, v) for k, (m, v) in existing.items()]
    old, batch = frames(spark, existing, new)
    for strategy, column in ((upsert.BY_ID, None), (upsert.BY_ID_AND_MODIFICATION, "m")):
        expected = model(existing, new, column is not None)
        for merge in (upsert.upsert, upsert.upsert_increment):
            merged = merge(old, batch, strategy, "k", column, order_column=files.ROW_ORDER)
            assert files.ROW_ORDER not in merged.columns
            assert rows(merged) == expected


def test_size_of_the_batch_does_not_matter(spark, monkeypatch):
    """A table with repeated keys: what the batch does not name stays as it is, either way."""
    old, batch = frames(
        spark, [("a", 1, 1), ("z", 1, 1), ("z", 1, 2), (None, 1, 1)], [("a", 2, 2), ("b", 1, 3), ("b", 0, 4), (None, 5, 5)]
    )
    for strategy, column in ((upsert.BY_ID, None), (upsert.BY_ID_AND_MODIFICATION, "m")):
        results = []
        for bounds in ({}, {"BROADCAST_KEYS": 0}, {"BROADCAST_BYTES": 0}):
            with monkeypatch.context() as patch:
                for name, value in bounds.items():
                    patch.setattr(upsert, name, value)
                results.append(rows(upsert.upsert_increment(old, batch, strategy, "k", column, order_column=files.ROW_ORDER)))
        assert results[0] == results[1] == results[2]
        assert sum(r[0] == "z" for r in results[0]) == 2


def test_hot_key(spark):
    """A third of all rows has one key: the plan drops its losers before the shuffle."""
    n = 300_000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    batch = spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("m"), F.col("id").alias(files.ROW_ORDER))
    merged = upsert.deduplicate(batch, "k", modification_column="m", order_column=files.ROW_ORDER)
    assert merged.count() == n - n // 3 + 1
    assert merged.filter("k = 'hot'").first()["m"] == n - 3
    plan = merged._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_new_and_missing_columns(spark):
    old = spark.createDataFrame([("a", 1)], "k string, old int")
    new = spark.createDataFrame([("b", 2)], "k string, fresh int")
    merged = upsert.upsert(old, new, upsert.BY_ID, "k")
    assert merged.columns == ["k", "old", "fresh"]
    assert sorted(map(tuple, merged.collect())) == [("a", 1, None), ("b", None, 2)]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1)], "k string, m int")
    for args, message in (
        (("by_magic", "k"), "strategy"), ((upsert.BY_ID, "gone"), "existing frame lacks"),
        ((upsert.BY_ID, ["k", "gone"]), "lacks"), ((upsert.BY_ID_AND_MODIFICATION, "k"), "modification column"),
        ((upsert.BY_ID_AND_MODIFICATION, "k", "gone"), "lacks"),
    ):
        with pytest.raises(ValueError, match=message):
            upsert.upsert(df, df, *args)
    with pytest.raises(ValueError, match="new frame lacks"):
        upsert.upsert(df, df.drop("k"), upsert.BY_ID, "k")


def test_table(spark, tmp_path):
    path = str(tmp_path / "deep" / "table")
    old, batch = frames(spark, [], [("a", 1, 1), ("a", 1, 2), (None, 1, 3)])
    how = {"strategy": upsert.BY_ID, "id_columns": "k", "order_column": files.ROW_ORDER}
    assert rows(upsert.upsert_table(spark, batch, path, **how)) == [("a", 1, 2), (None, 1, 3)]
    for unique in (False, True, True):
        _, more = frames(spark, [], [("b", 5, 5), (None, 6, 6)])
        assert rows(upsert.upsert_table(spark, more, path, unique=unique, **how)) == [
            ("a", 1, 2), ("b", 5, 5), (None, 6, 6),
        ]
    _, single = frames(spark, [], [("a", 9, 9), ("c", 9, 9)])
    merged = upsert.upsert_table(spark, single, path, unique=True, new_unique=True, **how)
    assert rows(merged) == [("a", 9, 9), ("b", 5, 5), ("c", 9, 9), (None, 6, 6)]
    assert sorted(p.name for p in (tmp_path / "deep").iterdir()) == ["table"]


def test_order_of_batches_does_not_matter(spark):
    a = [("a", 1, 1), ("b", 4, 2)]
    b = [("a", 2, 3), ("c", 1, 4)]
    empty = spark.createDataFrame([], "k string, m int, v int")
    results = []
    for first, second in ((a, b), (b, a)):
        table = empty
        for batch in (first, second, second):
            _, new = frames(spark, [], batch)
            table = upsert.upsert(table, new, upsert.BY_ID_AND_MODIFICATION, "k", "m", order_column=files.ROW_ORDER)
        results.append(rows(table))
    assert results[0] == results[1] == [("a", 2, 3), ("b", 4, 2), ("c", 1, 4)]


def test_timestamps_as_modification(spark):
    old = spark.createDataFrame([("a", datetime(2024, 1, 2))], "k string, t timestamp")
    new = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("a", None)], "k string, t timestamp")
    merged = upsert.upsert(old, new, upsert.BY_ID_AND_MODIFICATION, "k", "t")
    assert merged.first()["t"] == datetime(2024, 1, 2)
