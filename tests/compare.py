"""Order-free comparison of a Spark result with a DuckDB result."""

import datetime
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return value


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(body, key=repr)


def spark_rows(df):
    return normalised(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(con, sql):
    cursor = con.execute(sql)
    return normalised([item[0] for item in cursor.description], cursor.fetchall())
