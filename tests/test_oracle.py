"""Every registered query against its DuckDB SQL on the smallest tables."""

import os
import sys
from collections import Counter

import pytest

from conftest import ROOT, SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import duck, norm  # noqa: E402

from ordersmith.plans.registry import QUERIES as OWN  # noqa: E402

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    """All order queries; queries added to them may be beyond SQL and have tests of their own."""
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    rows = df.collect()
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(dcols)
    si = [df.columns.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    assert Counter(tuple(norm(r[i]) for i in si) for r in rows) == \
        Counter(tuple(norm(r[i]) for i in di) for r in drows)
    assert len(rows) > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue" in df.columns and "aov" in df.columns
