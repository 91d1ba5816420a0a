"""The registered queries: all present, and those with SQL equal to it."""

import re

import pytest

import __spark_entry__ as entry
from leadscope.llm import oracles, queries
from tests.oracle_harness import compare, duck


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {int(m[1]) for n in queries.QUERIES if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= names and set(oracles.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    result = compare(spark, name, sf, duck(sf))
    assert result["ok"], result
