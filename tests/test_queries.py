"""Every registered query with SQL equals DuckDB's result on the same tables, whatever the order of rows."""

from concurrent.futures import ThreadPoolExecutor

import duckdb
import numpy as np
import pandas as pd
import pytest

from benchbook.plans import ORACLE_SQL, QUERIES
from tests.conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(v):
    if v is None or (not hasattr(v, "__len__") and pd.isna(v)):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.number)):
        return round(float(v), 6)
    return str(v).replace(" 00:00:00", "")


def rows(df):
    names = sorted(df.columns)
    return sorted((tuple(value(v) for v in r) for r in zip(*[df[c].astype(object).tolist() for c in names], strict=True)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def found(spark):
    """Results of all queries with SQL, a few at a time: most of a small query's time is planning."""
    with ThreadPoolExecutor(4) as pool:
        yield {n: pool.submit(lambda n=n: QUERIES[n](spark, DATA).toPandas()) for n in sorted(ORACLE_SQL)}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(duck, found, name):
    mine, theirs = found[name].result(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs_over_whole_tables(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_names_and_sql_go_together():
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert len(QUERIES) > 190
