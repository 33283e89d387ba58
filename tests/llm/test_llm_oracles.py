"""Queries that have an oracle, against DuckDB at the smallest scale."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows

from stationflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck_rows(connect(SF), ORACLES[name])
