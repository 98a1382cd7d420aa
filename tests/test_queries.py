"""Every registered query of the series engine against its SQL, on a small scale."""

import duckdb
import pytest

from tidewell.plans.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(data):
    from pathlib import Path

    c = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    rows = df.collect()
    assert rows
    if name in ORACLE_SQL:
        found = duck.execute(ORACLE_SQL[name])
        columns = [x[0] for x in found.description]
        assert sorted(columns) == sorted(df.columns)
        key = sorted(columns)
        assert sorted(repr(tuple(r[c] for c in key)) for r in rows) == sorted(repr(tuple(r[columns.index(c)] for c in key)) for r in found.fetchall())


def test_entry_imports():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
