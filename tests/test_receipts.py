import datetime as dt
from decimal import Decimal as M

import pytest

from tillroll.operators import quality as Q
from tillroll.operators.receipts import dedup, items_per_receipt

D1, D2 = dt.date(2025, 7, 1), dt.date(2025, 7, 2)
DIRTY = [
    ("T1", D1, M(100)), ("T1", D1, M(120)),  # two totals
    ("T2", D1, M(50)), ("T2", D2, M(50)),  # two dates
    ("T3", D1, None), ("T3", D2, M(90)),  # no total on the first line
    ("T4", D1, M(30)),
]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(DIRTY, "transaction_id string, sale_date date, total_cost decimal(10,2)")


def test_rules_differ_on_dirty_data(lines, rows):
    order = {"columns": ("total_cost",), "order": ("sale_date",)}
    assert rows(dedup(lines, "max")) == [("T1", M(120)), ("T2", M(50)), ("T3", M(90)), ("T4", M(30))]
    assert len(rows(dedup(lines, "max_by_date"))) == 6
    assert rows(dedup(lines, "distinct")) == [
        ("T1", M(100)), ("T1", M(120)), ("T2", M(50)), ("T3", M(90)), ("T3", None), ("T4", M(30))]
    assert rows(dedup(lines, "consistent")) == [("T2", M(50)), ("T3", M(90)), ("T4", M(30))]
    assert rows(dedup(lines, "first_row", **order)) == [("T1", M(100)), ("T2", M(50)), ("T3", None), ("T4", M(30))]
    assert rows(dedup(lines, "last_row", **order)) == [("T1", M(120)), ("T2", M(50)), ("T3", M(90)), ("T4", M(30))]
    assert rows(dedup(lines, "first_value", **order))[2] == ("T3", M(90))
    assert rows(dedup(lines, "row_number", **order)) == rows(dedup(lines, "last_row", **order))


def test_rules_need_an_order(lines):
    with pytest.raises(ValueError):
        dedup(lines, "first_row")
    with pytest.raises(ValueError):
        dedup(lines, "newest", order=("sale_date",))


def test_audits(lines, rows):
    assert rows(Q.audit_unique(lines)) == [(4, 4)]
    assert rows(Q.audit_repeated(lines)) == []
    assert rows(Q.audit_repeated(lines, "max_by_date")) == [("T2", 2), ("T3", 2)]
    assert rows(Q.audit_before_after(lines)) == [(7, 4, 4)]
    assert Q.multi_line_receipts(lines).count() == 6
    assert rows(Q.audit_totals(lines)) == [(M(440), M(290))]
    assert rows(Q.inconsistent_receipts(lines)) == [("T1", M(100), M(120))]
    same = {"columns": ("sale_date", "total_cost"), "order": ("sale_date",)}
    assert rows(Q.audit_methods(dedup(lines, "last_row", **same), dedup(lines, "row_number", **same), same["columns"])) == []
    differ = Q.audit_methods(dedup(lines, "first_row", **same), dedup(lines, "max"), ("total_cost",))
    assert rows(differ) == [("T1", M(100), M(120)), ("T3", None, M(90))]


def test_order_sizes(lines, rows):
    assert rows(Q.order_sizes(lines)) == [(4, 1, 2, 1.75, 2.0, 2, 25.0)]
    reduced = items_per_receipt(lines)
    assert rows(Q.order_sizes(reduced)) == rows(Q.order_sizes(lines))


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, None), (3, "b")], "n int, s string")
    assert rows(Q.validate(df)) == [("n", "int", 1, 5, 1), ("s", "string", 1, 5, 1)]
    assert rows(Q.describe_categorical(df)) == [("s", 4, 2, "a", 2)]
    assert rows(Q.describe_numeric(df)) == [("n", 4, 1.75, 0.9574, 1.0, 1.0, 1.5, 2.25, 3.0)]
    assert [tuple(r) for r in Q.value_counts(df, "s").collect()] == [("a", 2), ("b", 2), (None, 1)]
    checks = Q.constraint_violations(df, ["n"], ["s"], {"n < 3": df.n < 3})
    assert rows(checks) == [("check n < 3", 1), ("not null s", 1), ("primary key n", 1)]


def test_profile_of_an_empty_frame(spark, rows):
    df = spark.createDataFrame([], "n int, s string")
    assert rows(Q.row_counts(df)) == [(0, 0, 2)]
    assert rows(Q.constraint_violations(df, ["n"])) == [("primary key n", 0)]
