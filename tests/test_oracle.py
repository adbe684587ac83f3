"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck_connect
from visitlens.plans import catalog

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql().get(name), SF_SMALL)
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and len(df.columns) == 17
