"""Every registered query against its DuckDB oracle at sf0.001 (the driver's gate in small)."""

import hashlib

import pytest

import __spark_entry__ as E
from conftest import SF001

ORACLES = {k: v for k, v in E.oracle_sql().items() if k not in E.LLM_QUERIES}


def _norm(df):
    df = df[sorted(df.columns)]
    rows = [tuple(round(v, 9) if isinstance(v, float) else (None if v is None else str(v)) for v in t)
            for t in df.itertuples(index=False)]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF001).toPandas()
    want = duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    a, b = _norm(got), _norm(want)
    assert hashlib.sha1(repr(a).encode()).digest() == hashlib.sha1(repr(b).encode()).digest()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(ORACLES) - set(E.LLM_QUERIES)))
def test_rows_only_query_runs(spark, name):
    assert E.queries()[name](spark, SF001).count() > 0
