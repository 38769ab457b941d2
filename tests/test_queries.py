"""Every registered query of the reference's operators against its SQL, over the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from foliant.plans import catalog, storage  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    sql = catalog.ORACLES.get(name)
    if sql is None:
        assert got
        return
    rel = duck.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = [tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall()]
    key = lambda r: [(v is None, str(v)) for v in r]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
