import duckdb
import pytest

import __spark_entry__ as E
from strata.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 12 and set(df.columns) == {"label", "column", "mean"}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6)
    return v


def _rows(pairs_list):
    rows = [tuple((k, _norm(v)) for k, v in sorted(r)) for r in pairs_list]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for _, v in r))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_agrees_sf0001(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = _rows(r.asDict().items() for r in sdf.collect())
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    drows = _rows(zip(cols, r) for r in res.fetchall())
    assert len(srows) == len(drows)
    assert srows == drows
