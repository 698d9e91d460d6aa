"""Order-insensitive, exact comparison of a Spark result with DuckDB SQL on the same parquet tables."""

import datetime
import glob
import os

import duckdb

TESTDATA = "/root/testdata"


def duck(sf_dir):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normalised(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, int):
        return value
    return float(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    result = [tuple(normalised(row[i]) for i in order) for row in rows]
    return sorted(result, key=lambda row: tuple((v is None, str(v)) for v in row))


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())
