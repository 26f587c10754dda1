"""Files, landing, warehouse tables and the incremental stream."""

from datetime import datetime

import pytest

from listrata.sources import files, landing, records, warehouse, workspace
from listrata.streaming.landing import land_new_files

TRICKY = [(1, 'say "hi", ok'), (2, "two\nlines"), (3, "back\\slash \\"), (4, "tab\tcr\r\nlf"), (5, " space "), (6, ""), (7, None), (8, "NA")]


@pytest.mark.parametrize("escape", ['"', "\\"])
def test_csv_roundtrip(spark, tmp_path, escape):
    path = str(tmp_path / "t.csv")
    files.write_csv(spark.createDataFrame(TRICKY, "id int, text string"), path, escape=escape)
    back = files.read_csv(spark, path, escape=escape)
    assert dict(back.dtypes) == {"id": "string", "text": "string"}
    got = {int(r.id): r.text for r in back.collect()}
    assert got == {k: (v if v not in ("", "NA") else None) for k, v in TRICKY}


def test_quote_styles(spark, tmp_path):
    texts = {
        "doubled": ('a,b\n"x ""y"" z",""\n,"p"\n', '"'),
        "start": ('a,b\n1,"""y"" z"\n', '"'),
        "plain": ('a,b\n"",2\n1,""\n', '"'),
        "backslash": ('a,b\n"x \\"y\\" z",""\n', "\\"),
        "backslash at the end": ('a,b\n"x \\"y\\"","\\"z\\""\n', "\\"),
        "path": ('a,b\n"c:\\\\x\\\\",""\n', '"'),
        "both": ('a\n"x ""y"" z"\n"x \\"y\\" z"\n', '"'),
    }
    for name, (text, escape) in texts.items():
        (tmp_path / name).write_text(text)
        assert records.style(records.lines(spark, [str(tmp_path / name)])) == escape, name
    for name in ("doubled", "backslash", "both"):
        assert {'x "y" z'} <= {r.a for r in files.read_csv(spark, str(tmp_path / name), escape=None).collect()}
    assert [r.a for r in files.read_csv(spark, str(tmp_path / "both"), escape=None).collect()] == ['x "y" z'] * 2


MIXED = r'''id,text,more
1,"{""say"": ""say \""hi\"" ok""}",a
2,"ends in a backslash \",b
3,"by \"backslash\", with a comma",c
4,"two
lines ""doubled"", and
three",d
5,"two
lines \"escaped\", \"and
three",e
6,5" pipe,f

7,"",g
8,"a \" quote",h
9,""",",i
'''


@pytest.mark.parametrize("split", [1 << 20, 7, 23])
def test_both_quote_styles_and_many_tasks(spark, tmp_path, split):
    """Every record is parsed in its own way, however the file is split."""
    (tmp_path / "m.csv").write_text(MIXED, newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = files.read_csv(spark, str(tmp_path / "m.csv"), escape=None, row_order=True)
        rows = df.orderBy(files.ROW_ORDER).collect()
        tasks = records.lines(spark, [str(tmp_path / "m.csv")]).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert tasks > 5 or split == 1 << 20
    assert [(r.id, r.text, r.more) for r in rows] == [
        ("1", r'{"say": "say \"hi\" ok"}', "a"), ("2", "ends in a backslash \\", "b"), ("3", 'by "backslash", with a comma', "c"),
        ("4", 'two\nlines "doubled", and\nthree', "d"), ("5", 'two\nlines "escaped", "and\nthree', "e"), ("6", '5" pipe', "f"),
        ("7", None, "g"), ("8", 'a " quote', "h"), ("9", '",', "i"),
    ]


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_split_file_reads_as_a_whole_one(spark, tmp_path, ends):
    """Random fields with line breaks, many tasks: the rows and their order are those of a reader of the whole file."""
    import csv
    import random

    random.seed(3)
    rows = [[str(i), "".join(random.choices(['"', ",", "\n", "a", "b", " ", "\r\n", "\\"], k=random.randint(0, 12)))] for i in range(400)]
    with open(tmp_path / "r.csv", "w", newline="") as out:
        csv.writer(out, lineterminator=ends).writerows([["id", "text"], *rows])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = files.read_csv(spark, str(tmp_path / "r.csv"), row_order=True, na_texts=()).orderBy(files.ROW_ORDER).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [[r.id, r.text or ""] for r in got] == rows


def test_parts_of_a_block_read_as_the_block(spark, tmp_path, monkeypatch):
    """Lines are put in order by runs of a few, not by whole blocks, whatever the files and blocks are."""
    monkeypatch.setattr(records, "_PART_BITS", 1)
    (tmp_path / "a.csv").write_text("\n\n\n" + MIXED, newline="")
    (tmp_path / "b.csv").write_text("more,id\n\n" + "".join(f'"x\n\n""{i}"" ,y\n",{i}\n' for i in range(9)), newline="")
    got = files.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], escape=None, row_order=True)
    widths = [r.n for r in records._told(records.lines(spark, [str(tmp_path / "b.csv")]), '"', False).groupBy("block", "part").count().selectExpr("count AS n").collect()]
    assert max(widths) == 2
    rows = got.orderBy(files.ROW_ORDER).collect()
    assert [r.id for r in rows] == [str(i) for i in [*range(1, 10), *range(9)]]
    assert [r.text for r in rows][3:5] == ['two\nlines "doubled", and\nthree', 'two\nlines "escaped", "and\nthree']
    assert [r.more for r in rows][9:] == [f'x\n\n"{i}" ,y\n' for i in range(9)]


def test_a_record_is_parsed_once(spark, tmp_path):
    """Not once for each of its columns."""
    (tmp_path / "wide.csv").write_text('a,b,c,d\n1,"x\ny",2,"p ""q"" r"\n')
    for escape in ('"', None):
        rows = files.read_csv(spark, str(tmp_path / "wide.csv"), escape=escape)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert 1 <= plan.count("from_csv(") <= 4  # by either way of quoting, for records of one line and of several
        assert [tuple(r) for r in rows.collect()] == [("1", "x\ny", "2", 'p "q" r')]


def test_headers_of_several_files(spark, tmp_path):
    for name, text in (("a", "id,x\n1,p\n"), ("b", "\ufeffx,y,id\nq,r,2\n"), ("c", "id,x\n3,s\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    df = files.read_csv(spark, [str(tmp_path / f"{n}.csv") for n in "abc"], row_order=True).orderBy(files.ROW_ORDER)
    assert [(r.id, r.x, r.y) for r in df.collect()] == [("1", "p", None), ("2", "q", "r"), ("3", "s", None)]


def test_csv_by_header_name_and_row_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,a\nx,1\ny,2\nNaN,3\n')
    df = files.read_csv(spark, str(tmp_path / "a.csv"), row_order=True)
    ordered = df.orderBy(files.ROW_ORDER).collect()
    assert [(r.a, r.b) for r in ordered] == [("1", "x"), ("2", "y"), ("3", None)]
    raw = files.read_csv(spark, str(tmp_path / "a.csv"), na_texts=())
    assert {r.b for r in raw.collect()} == {"x", "y", "NaN"}


def test_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "whole,gaps,real,truth,text,none,big\n1, 2,1.5,True,x,,12345678901234567890\n-3,NA,2,false,5,,1\n"
    )
    df = files.read_csv(spark, str(tmp_path / "a.csv"), infer=True)
    assert [t for _, t in df.dtypes] == ["bigint", "bigint", "double", "boolean", "string", "double", "double"]
    assert {tuple(r)[:6] for r in df.collect()} == {(1, 2, 1.5, True, "x", None), (-3, None, 2.0, False, "5", None)}


def test_dispatch_and_load(spark, tmp_path):
    df = spark.range(3)
    for name in ("t.csv", "t.parquet"):
        files.write_table(df, str(tmp_path / name))
        files.write_table(df, str(tmp_path / name))
        assert files.read_table(spark, str(tmp_path / name)).count() == 3
    with pytest.raises(ValueError, match="unsupported"):
        files.read_table(spark, "x.json")
    with pytest.raises(ValueError, match="unsupported"):
        files.write_table(df, "x.txt")
    assert files.load(spark, df) is df
    assert files.load(spark, str(tmp_path / "t.csv")).count() == 3
    with pytest.raises(TypeError):
        files.load(spark, 5)
    assert files.lake_path("s3a://lake/", "/silver/x.parquet") == "s3a://lake/silver/x.parquet"
    assert files.lake_path("s3a://lake", "hdfs://other/x.csv") == "hdfs://other/x.csv"


def test_replace_reads_its_own_input(spark, tmp_path):
    path = str(tmp_path / "table")
    assert files.read_if_exists(spark, path) is None
    files.replace_table(spark.range(3), path)
    doubled = files.replace_table(spark.read.parquet(path).union(spark.read.parquet(path)), path)
    assert doubled.count() == 6


def test_interrupted_replacement_is_rolled_back(spark, tmp_path):
    path = tmp_path / "table"
    files.replace_table(spark.range(3), str(path))
    path.rename(tmp_path / "table__previous")
    assert files.read_if_exists(spark, str(path)).count() == 3
    assert not (tmp_path / "table__previous").exists()


def test_failed_write_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    files.replace_table(spark.range(3), path)
    with pytest.raises(Exception):
        files.replace_table(spark.sql("SELECT raise_error('no') AS id"), path)
    assert files.read_if_exists(spark, path).count() == 3


def test_unreadable_table_is_no_missing_table(spark, tmp_path):
    (tmp_path / "table").mkdir()
    (tmp_path / "table" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        files.read_if_exists(spark, str(tmp_path / "table")).count()


def test_landing(spark, tmp_path):
    path = str(tmp_path / "bronze")
    assert landing.run_id(datetime(2024, 1, 5, 9, 7, 59)) == "2024-01-05_09-07"
    landing.land(spark.range(3), path, "2024-01-05_09-07")
    landing.land(spark.range(5), path, "2024-01-05_09-08")
    landing.land(spark.range(4), path, "2024-01-05_09-07")
    assert landing.read_landed(spark, path, "2024-01-05_09-07").count() == 4
    assert landing.read_landed(spark, path, "2024-01-05_09-08").count() == 5
    with pytest.raises(ValueError, match="run id"):
        landing.land(spark.range(1), path, "../x")


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.5, "a", True)], "i int, f float, s string, b boolean")
    assert warehouse.sink_columns(df.schema) == [("i", "bigint"), ("f", "double"), ("s", "string"), ("b", "boolean")]
    where = str(tmp_path / "t")
    warehouse.save_table(df, "sink_t", "replace", path=where)
    warehouse.save_table(df, "sink_t", "append")
    assert spark.table("sink_t").dtypes == [("i", "bigint"), ("f", "double"), ("s", "string"), ("b", "boolean")]
    assert spark.table("sink_t").count() == 2
    warehouse.save_table(df, "sink_t", "replace", path=where)
    assert spark.table("sink_t").count() == 1
    with pytest.raises(ValueError, match="action"):
        warehouse.save_table(df, "sink_t", "upsert")
    df.createOrReplaceTempView("a_view")
    listed = [tuple(r) for r in warehouse.list_tables(spark).collect()]
    assert ("default", "sink_t") in listed and "a_view" not in {name for _, name in listed}
    spark.sql("DROP TABLE sink_t")


def test_buckets_spare_the_shuffle(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast(id % 100 AS string) AS k", "id")
    for name in ("bucket_a", "bucket_b"):
        warehouse.save_table(df, name, "replace", path=str(tmp_path / name), bucket_by=(4, ["k"]))
    a, b = spark.table("bucket_a"), spark.table("bucket_b").groupBy("k").count()
    plan = a.hint("merge").join(b, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("DROP TABLE bucket_a")
    spark.sql("DROP TABLE bucket_b")


def test_jdbc_options(spark):
    df = spark.createDataFrame([(1, "a", 1.0, True)], "i int, s string, f double, b boolean")
    options = warehouse.jdbc_options(df, "jdbc:x", "t", batch_size=5, connections=2)
    assert options == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "5", "numPartitions": "2",
        "createTableColumnTypes": "`i` BIGINT, `f` DOUBLE PRECISION, `b` BOOLEAN",
    }
    with pytest.raises(ValueError, match="action"):
        warehouse.save_jdbc(df, "jdbc:x", "t", "drop")


def test_sql(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    assert warehouse.run_sql(spark, "SELECT k FROM {t} WHERE s = :s", {"s": "b"}, t=df).first()[0] == 2
    assert warehouse.run_sql(spark, "SELECT ? + 1 AS x", [4]).first()[0] == 5


def test_workspace(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_folder(spark, "x").startswith(f"{shared}/listrata/x-")
    df = workspace.materialize(spark.range(4), str(tmp_path / "m"))
    assert df.count() == 4 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_stream_lands_each_file_once(spark, tmp_path):
    incoming, bronze, check = (str(tmp_path / n) for n in ("in", "bronze", "check"))
    seen = []

    def call():
        land_new_files(
            spark, incoming, bronze, check, ["a", "b"], "run", after=lambda rows, name: seen.append((name, rows.count()))
        )

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text('a,b\n1,"x\ny"\n2,NA\n')
    call()
    call()
    (tmp_path / "in" / "2.csv").write_text("b,a\nz,3\n")
    call()
    assert [n for _, n in seen] == [2, 1]
    assert tuple(landing.read_landed(spark, bronze, seen[1][0]).select("a", "b").first()) == ("3", "z")
    (tmp_path / "in" / "2b.csv").write_text('extra,b,more,a\nq,"w\nv",p,5\n')  # wider, in another order
    call()
    assert tuple(landing.read_landed(spark, bronze, seen[2][0]).select("a", "b").first()) == ("5", "w\nv")
    (tmp_path / "in" / "3.csv").write_text("a,c\n4,y\n")
    with pytest.raises(Exception, match="no column b"):
        call()
    names = [name for name, _ in seen]
    assert landing.read_landed(spark, bronze, names[0]).filter("b IS NULL").count() == 1
