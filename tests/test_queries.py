"""Every registered query against DuckDB at the smallest scale."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows
from frames import SF

from stationflow.plans.oracles import ORACLES
from stationflow.plans.queries import QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, name):
    got = spark_rows(QUERIES[name](spark, SF))
    assert got == duck_rows(connect(SF), ORACLES[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
