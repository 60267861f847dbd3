"""Every registered query against its DuckDB SQL on the smallest data set."""

import importlib.util
import os

import pytest

from moodline import oracle, queries
from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


ENTRY = _load("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
CHECK = _load("check_oracle", os.path.join(ROOT, "tools", "check_oracle.py"))
SQL = oracle.oracle_sql()
QUERIES = queries.queries()


@pytest.fixture(scope="module")
def duck():
    return CHECK.duck_connect(SF_SMALL)


def test_every_query_has_oracle_or_reason():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(ENTRY.queries()) and set(SQL) <= set(ENTRY.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    idx = [dcols.index(c) for c in df.columns]
    drows = [tuple(r[i] for i in idx) for r in cur.fetchall()]
    assert CHECK.rows_key(srows) == CHECK.rows_key(drows)


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() == 31  # FIXTURES.md: high_risk_customers at sf0.001
