"""Registered queries of the subpackage: names, and equality with SQL."""

import re

import pytest

import __spark_entry__ as entry_mod
from goldleaf.llm import queries
from goldleaf.plans.compare import duck_connect, frame_digest, run_oracle

from ..conftest import SF_MID


def test_registered():
    names = entry_mod.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, len(queries.QUERIES) + 1))
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(queries.ORACLES) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_MID)
    cols, rows = run_oracle(duck_connect(SF_MID), queries.ORACLES[name])
    assert sorted(df.columns) == sorted(cols)
    assert frame_digest(df.columns, [tuple(r) for r in df.collect()]) == frame_digest(list(cols), rows)
