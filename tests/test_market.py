"""Every market query against DuckDB on the smallest tables."""

import duckdb
import pytest

from tidemark.plans import registry, roles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    own = duckdb.connect()
    for t in roles.TABLES:
        own.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return own


def plain(rows):
    def cell(v):
        if v is None or v != v:
            return ""
        return str(v)[:10] if hasattr(v, "year") else v if isinstance(v, str) else f"{float(v) + 0.0:.5g}"

    return sorted(tuple(map(cell, r)) for r in rows)


@pytest.mark.parametrize("name", list(registry.ORACLE))
def test_same_as_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert plain(got.select(*columns).collect()) == plain(want.fetchall())
