"""Every registered query against its DuckDB oracle on the smallest supplied scale."""

from __future__ import annotations

import datetime
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from rows import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if hasattr(v, "item") and not isinstance(v, pd.Timestamp):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else (int(v) if v.is_integer() else round(v, 9))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        return datetime.datetime(v.year, v.month, v.day)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False)),
                        key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_of_the_library_has_an_oracle():
    from lakeledger.plans.oracle import ORACLE as own
    from lakeledger.plans.registry import QUERIES

    assert set(own) == set(QUERIES) and set(own) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 600


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLE[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
