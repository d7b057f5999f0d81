"""Rows of a query on Spark against rows of its SQL on DuckDB."""

import datetime
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda index: names[index])
    return sorted(tuple(plain(row[index]) for index in order) for row in values)


def kind(name):
    name = str(name).lower()
    return {"integer": "int", "varchar": "string"}.get(name, name)
