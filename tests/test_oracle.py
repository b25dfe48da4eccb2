"""Every registered query against its DuckDB SQL on the small tables."""

import math
from pathlib import Path

import duckdb
import pytest

from creaseline.queries import ORACLE_SQL, QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for file in Path(small).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(rows):
    def value(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return None
        return x if isinstance(x, (bool, str)) else float(x)

    return sorted(([value(x) for x in row] for row in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_match(spark, duck, small, name):
    got = QUERIES[name](spark, small)
    columns = sorted(got.columns)
    rows = [tuple(r) for r in got.select(columns).collect()]
    expected = duck.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(d[0] for d in duck.execute(ORACLE_SQL[name]).description) == columns
    assert comparable(rows) == comparable(expected)
