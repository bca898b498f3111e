"""Compare a registered query with its SQL on the same files."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def rows(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(pdf.columns)
    values = pdf[names].astype(object).where(pdf[names].notna(), None)
    return names, sorted(map(tuple, values.itertuples(index=False)), key=repr)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs in column names, types, number of rows or values; the order of rows and columns does not count."""
    types = {name: TYPES.get(kind, kind) for name, kind in spark_df.dtypes}
    expected = {name: kind for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}
    if types != expected:
        return [f"schema {sorted(set(types.items()) ^ set(expected.items()))}"]
    ours, theirs = spark_df.toPandas(), con.execute(sql).fetchdf()
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}"]
    left, right = rows(ours)[1], rows(theirs)[1]
    return [] if left == right else [f"values differ, e.g. {[(x, y) for x, y in zip(left, right) if x != y][:3]}"]
