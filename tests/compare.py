"""Run a query in Spark and its SQL in DuckDB and compare the rows without order."""

import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        plain_number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return str(float(value)) if plain_number else str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def assert_same(df, con, sql):
    relation = con.sql(sql)
    assert sorted(df.columns) == sorted(relation.columns)
    spark_rows = normal([tuple(r) for r in df.collect()], df.columns)
    duck_rows = normal(relation.fetchall(), relation.columns)
    assert len(spark_rows) == len(duck_rows)
    wrong = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    assert not wrong, wrong[:3]
