"""Compare a Spark result with a DuckDB result: names, types, row count and exact values."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(value)
    return "null" if value is None else str(value)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in values)


def compare(df, con, sql):
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    for field in df.schema:
        mine, theirs = field.dataType.simpleString(), types[field.name]
        kinds = {"int": "INTEGER", "double": "DOUBLE", "bigint": "BIGINT", "date": "DATE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}
        assert kinds.get(mine) == theirs.upper(), (field.name, mine, theirs)
    expected = rows(names, result.fetchall())
    actual = rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(actual) == len(expected), (len(actual), len(expected))
    differing = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not differing, (len(differing), differing[:3])
    return len(actual)
