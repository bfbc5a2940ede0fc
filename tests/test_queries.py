"""Every query of the engine runs, and agrees with its SQL."""

from __future__ import annotations

import pytest
from compare import agree
from conftest import DATA

from tallgrass.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, oracle, name):
    agree(QUERIES[name](spark, DATA), oracle.sql(ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) <= set(e.queries())


def test_order_of_input_does_not_matter(spark):
    from pyspark.sql import functions as F

    from tallgrass.operators import discover, extract
    from tallgrass.plans import fixtures as fx

    docs = fx.documents(spark, DATA)
    mixed = docs.repartition(5, F.rand(3))
    for f in (lambda d: extract.extras_cover(d, fx.aliases(fx.SERVICES)), lambda d: extract.hospital_cover(d, fx.aliases(fx.CATEGORIES)), lambda d: discover.top_phrases(d).drop("first")):
        assert sorted(map(str, f(docs).collect())) == sorted(map(str, f(mixed).collect()))


@pytest.mark.parametrize("name", ["extras_cover", "extras_rows_v2", "limit_group_rows_v2", "extract_payloads", "payload_keys"])
def test_no_broadcast_by_estimate(spark, name):
    """Tables of services grow with the documents' lines, which estimates don't count: the driver must hold none of them."""
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan
