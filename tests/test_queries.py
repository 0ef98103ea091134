"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from compare import compare, duck

from tillroll import oracles, registry

QUERIES, SQL = registry.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, folder, name):
    assert compare(spark, con, folder, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize(("name", "key"), [
    ("weekday_load", lambda r: (["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"].index(r.day_name),)),
    ("inventory_gap", lambda r: (-abs(r.financial_impact_rub), r.sku)),
    ("return_rate", lambda r: (-r.return_rate_percent, r.category)),
    ("top_customers", lambda r: (-r.total_spent, r.customer_id)),
    ("basket_size", lambda r: (r.n_items,)),
    ("revenue_share_pie", lambda r: (-r.revenue, r.coffee_name)),
])
def test_reports_are_ordered(spark, folder, name, key):
    got = [key(r) for r in QUERIES[name](spark, folder).collect()]
    assert len(got) > 1 and got == sorted(got)


def test_frequencies_put_nulls_last_among_ties(spark):
    from tillroll.operators.quality import value_counts

    df = spark.createDataFrame([("b",), (None,), ("a",), ("c",), ("c",)], "v string")
    assert [tuple(r) for r in value_counts(df, "v").collect()] == [("c", 2), ("a", 1), ("b", 1), (None, 1)]
