"""Run a registered query and its SQL, and compare the rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connection(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(db, sql):
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows_of(names, result.fetchall())
