"""Every registered query that has SQL gives the rows that DuckDB gives, on the smallest tables."""

import duckdb
import pytest

from vocalake import queries, registry  # noqa: F401
from vocalake.adapters import TABLES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def _rows(rows):
    return sorted((tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    if name not in registry.ORACLE_SQL:
        assert got
        return
    expected = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(expected.columns) == columns
    assert _rows(got) == _rows(expected.project(", ".join(f'"{c}"' for c in columns)).fetchall())
