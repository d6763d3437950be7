"""Every query against its SQL, run by another engine on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from cellflux.plans.catalogue import QUERIES
from cellflux.plans.oracles import ORACLES


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert entry_point.queries().items() >= QUERIES.items()
    assert entry_point.oracle_sql().items() >= ORACLES.items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    answer = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(answer.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    picks = [answer.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in picks) for r in answer.fetchall()), key=repr)
    assert got == want
    assert got


def test_entry(spark):
    first, second = entry_point.entry(spark), entry_point.entry(spark)
    assert first.schema == second.schema
    assert first.count() == 894
