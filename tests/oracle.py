"""Runs a query and its SQL and compares the rows."""

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(map(plain, row)) for row in df.select(*columns).collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    places = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted(tuple(plain(row[i]) for i in places) for row in cursor.fetchall())
