"""Every query that has SQL gives the rows that DuckDB gives."""

import duckdb
import pytest

from agrolith.plans import oracle
from agrolith.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents".split()


def rows(df):
    """Rows as text, whatever the order; whole floats and ints alike, dates and midnights alike."""

    def cell(x):
        if x is None or x != x:
            return None
        if isinstance(x, float) or type(x).__name__.startswith(("int", "float")):
            return repr(float(x))
        return str(x).replace(" 00:00:00", "")

    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(str(cell(x)) for x in r) for r in df.where(df.notna(), None).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query(spark, sf, duck, name):
    ours, theirs = QUERIES[name](spark, sf).toPandas(), duck.sql(oracle.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.SQL)
