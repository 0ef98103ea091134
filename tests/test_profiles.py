"""Profiles of wide tables, duplicates by digest, and encodings and lists without a bound."""

import numpy as np
import pandas as pd
import pytest
from plans import plan_of
from pyspark.sql import functions as F

from tillroll.operators import ordered, pivots
from tillroll.operators import prep as P
from tillroll.operators import quality as Q
from tillroll.operators.calendar import data_dictionary, with_comments
from tillroll.plans import sales


@pytest.fixture
def wide(spark):
    """Repeated rows, rows that differ in the place of a null only, signed zeros and NaN."""
    rows = [(1, None, "a", 0.0), (None, 1, "a", 0.0), (1, None, "a", -0.0), (2, 2, None, float("nan")), (2, 2, None, float("nan")), (3, 3, "", None)]
    return spark.createDataFrame(rows * 2, "a int, b int, `c.d` string, e double")


def test_duplicates_by_digest(wide, rows):
    distinct = wide.distinct().count()
    assert rows(Q.row_counts(wide)) == [(12, 12 - distinct, 4)] and distinct == 4
    assert rows(Q.row_counts(wide.filter("a = 99"))) == [(0, 0, 4)]
    assert rows(Q.row_counts(wide.select("a").distinct())) == [(4, 0, 1)]


@pytest.mark.parametrize("digest", [lambda df: [F.lit(7), F.lit(7)], lambda df: [F.xxhash64("a"), F.lit(0)]])
def test_different_rows_of_one_digest_are_told_apart(wide, rows, monkeypatch, digest):
    monkeypatch.setattr(Q, "row_digest", digest)
    assert rows(Q.row_counts(wide)) == [(12, 8, 4)]


def test_only_digests_are_shuffled_for_the_count(wide):
    plan = plan_of(Q.row_counts(wide))
    assert "keys=[_d1#" in plan and "partial_count" in plan


@pytest.mark.parametrize("few", [100_000, 50])
def test_numeric_profile_equals_numpy(spark, monkeypatch, few):
    if few == 50:  # windows, on a sketch coarse enough for few rows
        for name, value in (("FEW", few), ("ACCURACY", 2000), ("MARGIN", 2.5e-3)):
            monkeypatch.setattr(ordered, name, value)
    rng = np.random.default_rng(2)
    n = 20_000
    pdf = pd.DataFrame({
        "money": rng.exponential(50, n).round(2), "ties": rng.integers(0, 4, n), "big": rng.integers(-(1 << 40), 1 << 40, n),
        "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.normal(0, 1, n)),
    })
    got = Q.describe_numeric(spark.createDataFrame(pdf).repartition(5)).toPandas().set_index("column_name")
    want = pdf.describe().T
    for name, column in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        np.testing.assert_allclose(got.loc[want.index, name].to_numpy(float), want[column].to_numpy(float), rtol=1e-12, atol=6e-5)


def test_numeric_profile_without_known_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a double, b int")
    got = {r.column_name: r for r in Q.describe_numeric(df).collect()}
    assert (got["a"]["count"], got["a"].mean, got["a"].q50, got["b"].q50) == (0, None, None, 1.5)
    empty = Q.describe_numeric(df.filter("b > 5")).collect()
    assert [(r["count"], r.max) for r in empty] == [(0, None)] * 2


def test_numeric_profile_reads_twice_and_joins_no_row(spark, folder):
    df = Q.describe_numeric(spark.read.parquet(f"{folder}/orders.parquet"))
    df.collect()
    plan = plan_of(df).split("== Initial Plan ==")[0]
    assert "partial_count(1)" in plan and plan.count("/orders.parquet") <= 3  # two scans, one of them reused by the statistics
    before_shuffle = [b for a, b in zip(plan.split("\n"), plan.split("\n")[1:]) if "Exchange hashpartitioning(_i" in a]
    assert before_shuffle and all("Aggregate" in b or "Window" in b or "Codegen" in b for b in before_shuffle)


def test_sparse_vectors(spark):
    fit = spark.createDataFrame([("b", 1), ("a", 2), (None, None), ("b", 2)], "k string, n int")
    use = spark.createDataFrame([(1, "a", 2), (2, "z", 1), (3, None, None), (4, "b", 7)], "i int, k string, n int")
    got = {r.i: [(e["index"], e["value"]) for e in r.features] for r in P.encode_categorical(use, ["k", "n"], "onehot_sparse", fit_on=fit).collect()}
    assert got == {1: [(0, 1.0), (3, 1.0)], 2: [(2, 1.0)], 3: [], 4: [(1, 1.0)]}
    wide = P.encode_categorical(use, ["k"], "onehot", fit_on=fit)
    assert wide.columns == ["i", "n", "k_a", "k_b", "k_None"]


def test_preparation_with_a_million_categories(spark):
    n = 1_000_000
    df = spark.range(n).select("id", (F.col("id") % 7).alias("x"), F.concat(F.lit("sku-"), F.col("id")).alias("sku"))
    got = P.preprocess(df, ["x"], ["sku"], sparse=True)
    row = got.agg(F.countDistinct("features"), F.min(F.get("features", F.lit(0))["index"]), F.max(F.get("features", F.lit(0))["index"]), F.avg("x")).first()
    assert tuple(row)[:3] == (n, 0, n - 1) and row[3] == pytest.approx(0, abs=1e-9)


def test_values_that_become_columns_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(pivots, "MOST_COLUMNS", 5)
    df = spark.range(6).select("id", F.col("id").cast("string").alias("k"))
    with pytest.raises(ValueError, match="onehot_sparse"):
        P.fit_onehot(df, ["k"])
    with pytest.raises(ValueError, match="declare"):
        pivots.distinct_values(df, "k")
    assert len(pivots.distinct_values(df.filter("id < 5"), "k")) == 5


def shop(spark, big):
    """Many receipts of one line and one with `big`."""
    small = spark.range(200).select(F.concat(F.lit("T"), "id").alias("transaction_id"), F.lit("x").alias("coffee_name"), F.lit(10).alias("total_cost"))
    names = F.array(*map(F.lit, ["latte", "espresso", "tea"]))
    large = spark.range(big).select(F.lit("BIG"), F.get(names, (F.col("id") % 3).cast("int")), F.lit(5000))
    return small.union(large).select(
        "*", F.col("total_cost").cast("decimal(10,2)").alias("drink_price"), F.lit("2025-07-01").cast("date").alias("sale_date"), F.lit("Morning").alias("time_of_day")
    ).withColumn("total_cost", F.col("total_cost").cast("decimal(10,2)"))


@pytest.mark.parametrize("per_piece", [1, 2, 4, 1000])
def test_item_pieces_make_the_whole_list(spark, per_piece):
    lines = shop(spark, 20)
    whole = sales.outlier_receipts(lines).first()
    pieces = sales.outlier_receipt_items(lines, per_piece=per_piece).orderBy("piece").collect()
    assert [p.piece for p in pieces] == list(range(-(-20 // per_piece)))
    assert all(p.items_count == per_piece for p in pieces[:-1]) and sum(p.items_count for p in pieces) == whole.items_count
    assert ", ".join(p.items_list for p in pieces) == whole.items_list


def test_items_of_a_receipt_of_ten_million_lines(spark):
    got = sales.outlier_receipt_items(shop(spark, 10_000_000)).agg(
        F.count("*"), F.sum("items_count"), F.max("items_count"), F.max(F.length("items_list"))
    ).first()
    assert tuple(got) == (10_000, 10_000_000, 1000, 9998)


def test_dictionary_reads_comments_from_the_schema(spark, rows):
    df = with_comments(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), {"b": "It's b"})
    assert rows(data_dictionary(df)) == [("a", "int", 0, None), ("b", "string", 1, "It's b")]
