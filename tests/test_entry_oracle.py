"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tripflow.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return float(v) if type(v).__name__ == "Decimal" else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue_zone" in df.columns


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, sf_small, name):
    got = E.queries()[name](spark, sf_small).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    cs, rs = _rows(got)
    cd, rd = _rows(want)
    assert cs == cd
    assert len(rs) == len(rd)
    assert rs == rd
