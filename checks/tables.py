"""Sources, sinks, projections, filters and cleaning."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import query
from checks.views import PROFILES, SEGMENTS, profiles, table
from listrata.functions import times
from listrata.operators import columns as cols
from listrata.operators import rows, upsert
from listrata.plans.recommend import of_action
from listrata.sources import files, landing, warehouse
from listrata.sources.workspace import materialize, new_folder

NULL_WORDS = ", ".join(f"'{w}'" for w in files.NA_TEXTS)


# Sources and sinks


@query("parquet_scan", "SELECT * FROM orders")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.load(spark, files.read_table(spark, f"{sf_dir}/orders.parquet"))


@query(
    "csv_roundtrip",
    f"""SELECT doc_id, CASE WHEN text NOT IN ({NULL_WORDS}) THEN text END AS text, lang, source, n_chars
    FROM documents""",
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = new_folder(spark, "csv") + "/documents.csv"
    files.write_table(documents, path)
    return files.conform(files.read_table(spark, path), documents.schema)


@query("parquet_roundtrip", "SELECT * FROM lineitem")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "parquet") + "/lineitem.parquet"
    files.write_table(table(spark, sf_dir, "lineitem"), path)
    return files.read_table(spark, path)


@query(
    "bronze_landing",
    """SELECT '2024-01-05_10-30' AS run_id, o_orderkey, o_orderstatus, o_totalprice + 2 AS price FROM orders
    UNION ALL SELECT '2024-01-06_10-30', o_orderkey, o_orderstatus, o_totalprice + 3 FROM orders""",
)
def bronze_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = new_folder(spark, "bronze")
    moments = datetime(2024, 1, 5, 10, 30, 59), datetime(2024, 1, 6, 10, 30)
    for extra, moment in ((1, moments[0]), (2, moments[0]), (3, moments[1])):
        raw = orders.select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") + extra).alias("price"))
        landing.land(raw, path, landing.run_id(moment))
    landed = []
    for moment in moments:
        run = landing.run_id(moment)
        landed.append(landing.read_landed(spark, path, run).withColumn("run_id", F.lit(run)))
    return upsert.union_by_name(*landed)


def _then(df: DataFrame, statement: str) -> DataFrame:
    """``df``, which has found its files by now, after a statement that drops what names them."""
    df.sparkSession.sql(statement)
    return df


@query(
    "table_append",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
)
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").drop("o_orderpriority")
    name, folder = f"orders_{uuid.uuid4().hex}", new_folder(spark, "append")
    old = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    warehouse.save_table(orders.filter(old), name, "append", path=folder)
    warehouse.save_table(orders.filter(~old), name, "append")
    return _then(spark.table(name), f"DROP TABLE {name}")


@query("table_replace", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, folder = f"replaced_{uuid.uuid4().hex}", new_folder(spark, "replace")
    warehouse.save_table(table(spark, sf_dir, "orders"), name, "replace", path=folder)
    source = new_folder(spark, "layer") + "/customer.parquet"
    files.write_table(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), source)
    warehouse.load_table(spark, source, name, "replace", path=folder, bucket_by=(4, ["c_custkey"]))
    return _then(spark.table(name), f"DROP TABLE {name}")


_SINK_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "bigint",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp",
}


@query(
    "sink_type_map",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS sink_type, count({c}) AS n_values FROM lineitem"
        for c, t in _SINK_TYPES.items()
    ),
)
def sink_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = warehouse.to_sink(table(spark, sf_dir, "lineitem"))
    counts = sink.agg(*[F.count(c).alias(c) for c in sink.columns])
    kinds = F.create_map(*[F.lit(x) for pair in warehouse.sink_columns(sink.schema) for x in pair])
    long = counts.unpivot([], sink.columns, "column_name", "n_values")
    return long.select("column_name", kinds[F.col("column_name")].alias("sink_type"), "n_values")


def _bootstrap(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """Bring tables through CSV files into a database of their own; returns its name."""
    database, folder = f"raw_{uuid.uuid4().hex}", new_folder(spark, "raw")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/database'")
    for name in names:
        files.write_table(table(spark, sf_dir, name), f"{folder}/in/{name}.csv")
    warehouse.bootstrap(
        spark, [f"{folder}/in/{name}.csv" for name in names], database=database, folder=f"{folder}/out"
    )
    return database


@query(
    "raw_bootstrap",
    """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment, o_orderkey,
      o_totalprice, o_orderstatus FROM customer LEFT JOIN orders ON o_custkey = c_custkey""",
)
def raw_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _bootstrap(spark, sf_dir, ["customer", "orders"])
    customers, orders = spark.table(f"{database}.customer"), spark.table(f"{database}.orders")
    joined = customers.join(orders, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "o_orderkey", "o_totalprice",
        "o_orderstatus",
    )
    return _then(joined, f"DROP DATABASE {database} CASCADE")


@query(
    "sql_params",
    """SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 1000 GROUP BY o_custkey""",
)
def sql_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM {orders}
        WHERE o_orderstatus = :status AND o_totalprice > :price GROUP BY o_custkey"""
    return warehouse.run_sql(
        spark, text, {"status": "F", "price": 1000.0}, orders=table(spark, sf_dir, "orders")
    )


@query(
    "list_tables",
    """SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier""",
)
def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _bootstrap(spark, sf_dir, ["supplier", "customer", "part"])
    listed = warehouse.list_tables(spark, [database])
    sizes = [
        spark.table(f"{database}.{name}").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name in ("customer", "part", "supplier")
    ]
    counted = listed.join(reduce(DataFrame.unionByName, sizes), "table_name", "left").select("table_name", "n_rows")
    return _then(counted, f"DROP DATABASE {database} CASCADE")


# Projections and filters


@query(
    "project_fixed",
    """SELECT c_name, c_custkey, CAST(NULL AS DOUBLE) AS rating, CAST(c_nationkey AS BIGINT) AS c_nationkey
    FROM customer""",
)
def project_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = T.StructType.fromDDL("c_name string, c_custkey bigint, rating double, c_nationkey bigint")
    return cols.project(table(spark, sf_dir, "customer"), wanted)


@query("drop_columns", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    unwanted = [
        "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "not_there",
    ]
    return cols.drop_columns(table(spark, sf_dir, "lineitem"), unwanted)


@query("filter_equals", f"SELECT * FROM {PROFILES} p WHERE business_status = 'OPERATIONAL' AND verified = 'True'")
def filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_ones = cols.filter_rows(profiles(spark, sf_dir), lambda df: df["business_status"] == "OPERATIONAL")
    return cols.filter_rows(open_ones, F.col("verified") == "True")


@query("filter_sql_expr", "SELECT * FROM lineitem WHERE l_quantity > 25 AND l_discount BETWEEN 0.02 AND 0.05")
def filter_sql_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cols.filter_rows(table(spark, sf_dir, "lineitem"), "l_quantity > 25 AND l_discount BETWEEN 0.02 AND 0.05")


@query(
    "filter_in",
    f"""SELECT google_id, type, city, state FROM {PROFILES} p
    WHERE type IN ('BUILDING', 'HOUSEHOLD') AND city IN ('NATION_1', 'NATION_2', 'NATION_7') AND verified = 'True'""",
)
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitting = of_action(profiles(spark, sf_dir), "buy", SEGMENTS)
    cities = ["NATION_1", "NATION_2", "NATION_7"]
    chosen = cols.where_in(fitting, city=cities, verified="True", state=None)
    return chosen.select("google_id", "type", "city", "state")


@query(
    "filter_not_null",
    """SELECT event_id, value FROM events WHERE event_type NOT IN ('error', 'click')""",
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    gaps = F.when(kind == "error", F.lit(float("nan"))).when(kind != "click", F.col("value"))
    return cols.where_present(table(spark, sf_dir, "events").select("event_id", gaps.alias("value")), "value")


@query(
    "create_column",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 6) AS revenue
    FROM lineitem""",
)
def create_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    priced = cols.add_column(
        items, "revenue", lambda df: F.round(df["l_extendedprice"] * (1 - df["l_discount"]), 6)
    )
    return priced.select("l_orderkey", "l_linenumber", "l_partkey", "revenue")


@query(
    "create_column_sql",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'large' ELSE 'small' END AS o_orderstatus FROM orders""",
)
def create_column_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = "CASE WHEN o_totalprice > 200000 THEN 'large' ELSE 'small' END"
    return cols.add_column(table(spark, sf_dir, "orders"), "o_orderstatus", size).select("o_orderkey", "o_orderstatus")


@query(
    "apply_function",
    """SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice * (1 - l_discount) * 1.5), 2) AS charge,
      count(*) AS n_items FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def apply_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    def charged(df: DataFrame, factor: float) -> DataFrame:
        total = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * factor)
        return df.groupBy("l_returnflag", "l_linestatus").agg(
            F.round(total, 2).alias("charge"), F.count(F.lit(1)).alias("n_items")
        )

    return cols.apply(table(spark, sf_dir, "lineitem"), charged, factor=1.5)


# Cleaning


@query(
    "drop_null_columns",
    """SELECT o_orderkey, o_orderstatus, o_totalprice,
      CASE WHEN o_totalprice = (SELECT max(o_totalprice) FROM orders) THEN 'top' END AS rare FROM orders""",
)
def drop_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    highest = orders.agg(F.max("o_totalprice")).scalar()
    gappy = orders.select(
        "o_orderkey", F.lit(None).cast("string").alias("nothing"), "o_orderstatus",
        (F.col("o_totalprice") * float("nan")).alias("not_a_number"), "o_totalprice",
        F.when(F.col("o_totalprice") == highest, "top").alias("rare"),
    )
    return rows.drop_empty_columns(gappy)


@query(
    "drop_null_rows",
    "SELECT user_id, value, event_type FROM events WHERE event_type <> 'error' UNION ALL "
    "SELECT user_id, value, event_type FROM events WHERE event_type <> 'error'",
)
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "value", "event_type")
    bad = F.col("event_type") == "error"
    gappy = events.select(
        F.when(~bad, F.col("user_id")).alias("user_id"),
        F.when(bad, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.when(~bad, F.col("event_type")).alias("event_type"),
    )
    return rows.drop_empty_rows(upsert.union_by_name(events.filter(~bad), gappy))


@query(
    "drop_duplicates",
    """SELECT DISTINCT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag
    FROM lineitem""",
)
def drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag")
    return rows.drop_duplicate_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", flag))


@query(
    "drop_duplicates_first",
    """SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type""",
)
def drop_duplicates_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return rows.drop_duplicate_rows(events, order_column="event_id")


@query(
    "fill_nulls",
    """SELECT c_custkey, coalesce(total, -1) AS total, coalesce(last_status, '0') AS last_status,
      CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE -1 END AS balance
    FROM customer LEFT JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS total, max(o_orderstatus) AS last_status
      FROM orders WHERE o_orderdate >= TIMESTAMP '1999-06-01' GROUP BY o_custkey) o ON o_custkey = c_custkey""",
)
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = (
        table(spark, sf_dir, "orders")
        .filter("o_orderdate >= timestamp_ntz '1999-06-01'")
        .groupBy("o_custkey")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderstatus").alias("last_status"))
    )
    balance = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).otherwise(F.lit(float("nan")))
    joined = table(spark, sf_dir, "customer").join(recent, F.col("c_custkey") == F.col("o_custkey"), "left")
    gappy = joined.select("c_custkey", "total", "last_status", balance.alias("balance"))
    return cols.fill_missing(cols.fill_missing(gappy, ["total", "balance", "not_there"], -1), ["last_status"], 0)


@query(
    "coerce_numeric",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL
      WHEN '2-HIGH' THEN CAST(o_orderkey AS DOUBLE) * 10 WHEN '3-MEDIUM' THEN CAST(o_orderkey AS DOUBLE) + 0.5
      WHEN '4-NOT SPECIFIED' THEN NULL ELSE CASE WHEN o_orderstatus = 'F' THEN NULL ELSE -CAST(o_orderkey AS DOUBLE) END
      END + 0 AS amount
    FROM orders""",
)
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    text = (
        F.when(kind == "1-URGENT", F.concat(key, F.lit("d")))
        .when(kind == "2-HIGH", F.concat(key, F.lit("e1")))
        .when(kind == "3-MEDIUM", F.concat(F.lit(" "), key, F.lit(".5 ")))
        .when(kind == "4-NOT SPECIFIED", F.concat(F.lit("1,"), key))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("0x"), key))
        .otherwise(F.concat(F.lit("-"), key))
    )
    numbers = cols.to_numbers(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("amount")), ["amount"])
    return numbers.withColumn("amount", F.col("amount") + 0)


@query(
    "cast_map",
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice,
      CAST(trunc(l_quantity) AS INTEGER) AS l_quantity, CAST(l_discount AS FLOAT) AS l_discount, l_tax FROM lineitem""",
)
def cast_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_quantity", "l_discount", F.col("l_tax").cast("string").alias("l_tax")
    )
    targets = {
        "l_orderkey": "str", "l_extendedprice": "int64", "l_quantity": "int32", "l_discount": "float32",
        "l_tax": "float64",
    }
    return cols.cast_columns(items, targets)


@query(
    "clean_ids",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey * 100003 AS VARCHAR) END AS as_float,
      CAST(o_custkey AS VARCHAR) AS as_whole, '0x' || o_custkey || '.0' AS as_text FROM orders""",
)
def clean_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_custkey")
    ids = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", (key * 100003).cast("double")).alias("as_float"),
        key.alias("as_whole"),
        F.concat(F.lit("0x"), key.cast("string"), F.lit(".0")).alias("as_text"),
    )
    return cols.to_id_text(ids, ["as_float", "as_whole", "as_text", "not_there"])


def _mixed_truth(df: DataFrame) -> DataFrame:
    """Truth values of the companies as text with gaps, as booleans, and as numbers."""
    gap = F.col("photos_count") % 3 == 0
    return df.select(
        "google_id",
        F.when(~gap, F.col("verified")).alias("as_text"),
        F.when(~gap, F.col("verified") == "True").alias("as_truth"),
        F.when(~gap, F.col("reviews")).alias("as_number"),
    )


@query(
    "bool_to_int",
    f"""SELECT google_id, CASE WHEN photos_count % 3 <> 0 AND verified = 'True' THEN 1 ELSE 0 END AS as_text,
      CASE WHEN photos_count % 3 <> 0 AND verified = 'True' THEN 1 ELSE 0 END AS as_truth,
      CASE WHEN photos_count % 3 <> 0 THEN CAST(reviews AS INTEGER) ELSE 0 END AS as_number FROM {PROFILES} p""",
)
def bool_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cols.to_flags(_mixed_truth(profiles(spark, sf_dir)), ["as_text", "as_truth", "as_number"])


@query(
    "bool_to_text",
    f"""SELECT google_id, CASE WHEN photos_count % 3 = 0 THEN '' WHEN verified = 'True' THEN 'yes' ELSE 'no' END AS as_text,
      CASE WHEN photos_count % 3 = 0 THEN '' WHEN verified = 'True' THEN 'yes' ELSE 'no' END AS as_truth,
      CASE WHEN photos_count % 3 = 0 THEN '' ELSE CAST(reviews AS VARCHAR) END AS as_number FROM {PROFILES} p""",
)
def bool_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cols.to_flag_texts(
        _mixed_truth(profiles(spark, sf_dir)), ["as_text", "as_truth", "as_number"], "yes", "no"
    )


# Dates and times


@query(
    "epoch_to_ts",
    """SELECT event_id, date_trunc('second', ts) AS from_s, date_trunc('millisecond', ts) AS from_ms, ts AS from_ns,
      CASE WHEN event_type <> 'click' THEN date_trunc('second', ts) END AS gappy FROM events""",
)
def epoch_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = F.floor(micros / 1_000_000)
    counts = table(spark, sf_dir, "events").select(
        "event_id", seconds.alias("from_s"), F.floor(micros / 1000).alias("from_ms"), (micros * 1000).alias("from_ns"),
        F.when(F.col("event_type") != "click", seconds).alias("gappy"),
    )
    counts = cols.to_timestamps(counts, ["from_s", "gappy"], unit="s")
    return cols.to_timestamps(cols.to_timestamps(counts, ["from_ms"], unit="ms"), ["from_ns"], unit="ns")


def _date_text(orders: DataFrame, bad: Column) -> DataFrame:
    kind, day = F.col("o_orderpriority"), F.col("o_orderdate")
    text = (
        F.when(bad, F.concat(F.lit("day "), F.col("o_orderkey").cast("string")))
        .when(kind == "1-URGENT", F.date_format(day, "MM/dd/yyyy HH:mm:ss"))
        .when(kind == "2-HIGH", F.date_format(day, "MM/dd/yyyy"))
        .when(kind == "3-MEDIUM", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind != "5-LOW", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    )
    return orders.select(
        "o_orderkey", text.alias("several"), F.date_format(day, "dd.MM.yyyy HH-mm").alias("one"),
    )


@query(
    "parse_ts",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS several, o_orderdate AS one
    FROM orders""",
)
def parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _date_text(table(spark, sf_dir, "orders"), F.lit(False))
    return cols.to_timestamps(cols.to_timestamps(texts, ["several"]), ["one"], format="dd.MM.yyyy HH-mm")


@query(
    "parse_ts_multi",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
      THEN o_orderdate END AS several FROM orders""",
)
def parse_ts_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _date_text(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "P")
    formats = ["MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy"]
    return texts.select("o_orderkey", times.parse_time(F.col("several"), formats=formats, strict=False).alias("several"))


# Set operations and upsert


@query(
    "union_by_name",
    """SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer""",
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "s_name AS name", "s_acctbal AS balance")
    customers = table(spark, sf_dir, "customer").selectExpr("c_mktsegment AS segment", "c_name AS name", "c_custkey AS key")
    return upsert.union_by_name(suppliers, customers)


def _orders_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders up to the end of 1998, the table that exists already."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return orders.filter("o_orderdate < timestamp_ntz '1999-01-01'")


def _orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from 1997 on, each twice, the later one dearer and with one column more."""
    return _twice(table(spark, sf_dir, "orders").filter("o_orderdate >= timestamp_ntz '1997-01-01'"))


def _twice(orders: DataFrame) -> DataFrame:
    both = orders.withColumn(files.ROW_ORDER, F.explode(F.array(F.lit(1), F.lit(2)).cast("array<bigint>")))
    return both.select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + F.col(files.ROW_ORDER)).alias("o_totalprice"),
        "o_orderdate", "o_orderstatus", files.ROW_ORDER,
    )


_UPSERTED = """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderstatus
    FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice + 2, o_orderdate, o_orderstatus
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'"""


@query("upsert_by_id", _UPSERTED)
def upsert_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert(
        _orders_history(spark, sf_dir), _orders_batch(spark, sf_dir), upsert.BY_ID, "o_orderkey",
        order_column=files.ROW_ORDER,
    )


@query("upsert_increment", _UPSERTED)
def upsert_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "increment")
    how = {"strategy": upsert.BY_ID, "id_columns": "o_orderkey", "unique": True}
    upsert.upsert_table(spark, _orders_history(spark, sf_dir), path, **how)
    batch = _orders_batch(spark, sf_dir)
    return upsert.upsert_table(spark, batch, path, order_column=files.ROW_ORDER, **how)


@query("upsert_buckets", _UPSERTED)
def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a versioned table in hash buckets, batch by batch."""
    path = new_folder(spark, "buckets")
    how = {"strategy": upsert.BY_ID, "id_columns": "o_orderkey"}
    upsert.upsert_buckets(spark, _orders_history(spark, sf_dir), path, buckets=8, **how)
    batch = materialize(_orders_batch(spark, sf_dir), new_folder(spark, "batch"))
    return upsert.upsert_buckets(spark, batch, path, order_column=files.ROW_ORDER, **how)


_NEWEST = """SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey, max(batch) AS batch FROM (
    SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, batch DESC, seq DESC) AS r
    FROM (
      SELECT o_custkey, o_orderdate, o_orderkey, 'old' AS batch, 0 AS seq, 0 AS b FROM orders
        WHERE o_orderdate < TIMESTAMP '1999-01-01' AND o_orderkey IN (SELECT max(o_orderkey) FROM orders
          WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY o_custkey)
      UNION ALL SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END, o_orderkey, 'renewed',
        o_orderkey, 1 FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01') u) t
    WHERE r = 1 GROUP BY o_custkey, o_orderdate"""


def _last_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order per customer up to 1998: the one with the greatest key."""
    history = _orders_history(spark, sf_dir)
    last = upsert.deduplicate(history, "o_custkey", order_column="o_orderkey")
    return last.select("o_custkey", "o_orderdate", "o_orderkey", F.lit("old").alias("batch"))


def _renewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders from 1997 on, some without a date."""
    orders = table(spark, sf_dir, "orders").filter("o_orderdate >= timestamp_ntz '1997-01-01'")
    return orders.select(
        "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderkey", F.lit("renewed").alias("batch"), F.col("o_orderkey").alias(files.ROW_ORDER),
    )


@query("upsert_latest", _NEWEST)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert(
        _last_orders(spark, sf_dir), _renewed(spark, sf_dir), upsert.BY_ID_AND_MODIFICATION, ["o_custkey"],
        "o_orderdate", order_column=files.ROW_ORDER,
    )


@query("upsert_latest_increment", _NEWEST)
def upsert_latest_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert_increment(
        _last_orders(spark, sf_dir), _renewed(spark, sf_dir), upsert.BY_ID_AND_MODIFICATION, ["o_custkey"],
        "o_orderdate", order_column=files.ROW_ORDER,
    )


@query(
    "upsert_first_load", "SELECT o_orderkey, o_custkey, o_totalprice + 2 AS o_totalprice, o_orderdate, o_orderstatus FROM orders"
)
def upsert_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _twice(table(spark, sf_dir, "orders"))
    path = new_folder(spark, "first")
    return upsert.upsert_table(spark, batch, path, upsert.BY_ID, "o_orderkey", order_column=files.ROW_ORDER)


@query(
    "upsert_repeated_keys",
    """SELECT o_custkey, o_orderkey FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def upsert_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in which keys repeat: what the batch does not name stays as it is."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    building = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    batch = building.select(F.col("c_custkey").alias("o_custkey"), F.lit(-1).cast("bigint").alias("o_orderkey"))
    return upsert.upsert_increment(orders, batch, upsert.BY_ID, "o_custkey")


@query(
    "upsert_many_files",
    """SELECT 'short file last' AS files, CAST(o_orderkey AS VARCHAR) AS id,
      CASE o_orderstatus WHEN 'F' THEN 'later' ELSE o_orderpriority END AS priority FROM orders
    UNION ALL SELECT 'short file first', CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders""",
)
def upsert_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the rows of several files the last by path wins, however long the files are."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), "o_orderstatus")
    whole, short = orders.drop("o_orderstatus"), orders.filter("o_orderstatus = 'F'").select("id", F.lit("later").alias("priority"))
    results = []
    for label, first, last in (("short file last", whole, short), ("short file first", short, whole)):
        folder = new_folder(spark, "files")
        for name, rows in (("a", first), ("b", last)):
            files.write_csv(rows.coalesce(1), f"{folder}/{name}.csv")
        batch = files.read_csv(spark, [f"{folder}/a.csv", f"{folder}/b.csv"], row_order=True)
        results.append(upsert.deduplicate(batch, "id", order_column=files.ROW_ORDER).select(F.lit(label).alias("files"), "id", "priority"))
    return results[0].unionByName(results[1])
