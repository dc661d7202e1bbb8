"""Every query with SQL gives the rows DuckDB gives; the others run."""

import duckdb
import pytest

from reuselens import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, list):
        return tuple(map(_plain, v))
    return str(v) if hasattr(v, "isoformat") else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted((tuple(_plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = duck.sql(registry.ORACLE_SQL[name])
    want = _rows(want.columns, want.fetchall())
    assert got[0] == want[0]
    assert (sorted(set(got[1]) - set(want[1]), key=repr)[:3], sorted(set(want[1]) - set(got[1]), key=repr)[:3]) == ([], [])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
