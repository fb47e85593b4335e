"""Compare a query's rows with DuckDB's, regardless of order."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def norm(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [tuple(norm(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(named, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, con, sql):
    """A list of differences, empty where both agree in columns, types of values and rows."""
    result = con.execute(sql)
    expected = rows_of([d[0] for d in result.description], result.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if expected[0] != actual[0]:
        return [f"columns {actual[0]} != {expected[0]}"]
    if len(expected[1]) != len(actual[1]):
        return [f"{len(actual[1])} rows != {len(expected[1])}"]
    problems = [f"{a} != {e}" for a, e in zip(actual[1], expected[1]) if a != e]
    kinds = [
        f"type of {name}: {type(a).__name__} != {type(e).__name__}"
        for actual_row, expected_row in zip(actual[1][:50], expected[1][:50])
        for name, a, e in zip(actual[0], actual_row, expected_row)
        if type(a) is not type(e)
    ]
    return problems[:3] + sorted(set(kinds))[:3]
