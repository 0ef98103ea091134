"""Blocked order operators against numpy and pandas, with many blocks and hot groups."""

import datetime as dt
import uuid
from decimal import Decimal as M

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.operators import ordered
from tillroll.operators.ordered import distribution, interpolate, running_total, with_value_block
from tillroll.operators.prep import fit_ordinal

PROBS = {"p10": 0.1, "q1": 0.25, "q2": 0.5, "q3": 0.75, "p90": 0.9}


@pytest.mark.parametrize("make", [
    lambda r: r.exponential(200.0, 4000).round(2),
    lambda r: np.concatenate([np.full(3000, 42.0), r.normal(0, 1e6, 1000).round(2)]),  # a hot value, negatives
    lambda r: np.array([5.0]),
    lambda r: r.integers(0, 3, 999).astype(float),
])
def test_quantiles_equal_numpy(spark, make):
    values = make(np.random.default_rng(7))
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(4)
    got = distribution(df, "v", PROBS).first()
    assert got.n == len(values)
    assert float(got.total) == pytest.approx(values.sum())
    assert (got.min_value, got.max_value) == (values.min(), values.max())
    for name, p in PROBS.items():
        assert got[name] == pytest.approx(np.quantile(values, p), abs=1e-3)


def test_quantiles_per_group(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["hot", "a", "b", None], 3000, p=[0.9, 0.05, 0.04, 0.01]), "v": rng.integers(0, 5000, 3000)})
    got = {r.g: r for r in distribution(spark.createDataFrame(pdf), "v", PROBS, by=("g",)).collect()}
    for g, part in pdf.groupby("g", dropna=False):
        key = None if pd.isna(g) else g
        for name, p in PROBS.items():
            assert got[key][name] == pytest.approx(part.v.quantile(p), abs=1e-4)


def test_quantiles_of_nothing(spark):
    got = distribution(spark.createDataFrame([(None,)], "v double"), "v", {"q2": 0.5}).first()
    assert (got.n, got.q2) == (0, None)
    got = distribution(spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double"), "v", {"q2": 0.5}).first()
    assert (got.n, got.q2) == (2, 2.0)


@pytest.mark.parametrize("value", [
    "cast(id * 7919 % 40000 + 1000000000000000000 as bigint)", "exp(id * 7919 % 40000 / 1000 - 20)", "if(id = 0, -1e15, id % 40000)",
    "if(id % 3 = 0, 42, id * 7919 % 40000)", "cast(id * 7919 % 40000 / 100 as decimal(18,2))", "if(id % 5 = 0, null, cast(id % 40000 as double))",
])
@pytest.mark.parametrize("parts", [1, 60])
def test_quantiles_from_windows(spark, monkeypatch, value, parts):
    """Groups too large to be counted value by value, of many sketches."""
    monkeypatch.setattr(ordered, "FEW", 2000)
    monkeypatch.setattr(ordered, "ACCURACY", 2000)
    monkeypatch.setattr(ordered, "MARGIN", 2.5e-3)
    df = spark.range(0, 60_000, 1, parts).select(F.expr(value).alias("v"), (F.col("id") % 10 < 7).alias("g"))
    pdf = df.toPandas()
    for by, groups in ((), [((), pdf)]), (("g",), list(pdf.groupby(["g"]))):
        got = {r[:-1]: r[-1] for r in ((*[x[c] for c in by], x) for x in distribution(df, "v", PROBS, by=by).collect())}
        for key, part in groups:
            known = part.v.dropna().astype(float)
            row = got[tuple(key)]
            assert (row.n, row.n_rows) == (len(known), len(part))
            for name, p in PROBS.items():
                assert row[name] == pytest.approx(np.quantile(known, p), rel=1e-12, abs=1e-4)


def test_quantiles_off_the_windows_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FEW", 10)
    monkeypatch.setattr(ordered, "ACCURACY", 5)
    monkeypatch.setattr(ordered, "MARGIN", 1e-9)
    with pytest.raises(Exception, match="off its bound"):
        distribution(spark.range(60_000).select(F.expr("id * 7919 % 60000").alias("v")), "v", PROBS).collect()


@pytest.mark.parametrize("build", [
    lambda df: distribution(df, "v", PROBS), lambda df: running_total(df, "v", "v"), lambda df: fit_ordinal(df, "w"),
    lambda df: interpolate(df, "v", "id"), lambda df: interpolate(df, "v", "id", ("w",)),
])
def test_no_job_starts_when_built(spark, build):
    context, df = spark.sparkContext, spark.range(1000).select("id", F.col("id").alias("v"), F.col("id").cast("string").alias("w"))
    group = str(uuid.uuid4())
    context.setJobGroup(group, "")
    got = build(df)
    assert not context.statusTracker().getJobIdsForGroup(group)
    got.collect()
    assert context.statusTracker().getJobIdsForGroup(group)
    context.setJobGroup("", "")


def test_value_blocks_follow_the_order(spark):
    values = sorted([-1e9, -3.5, -0.01, 0.0, 0.01, 1.0, 2.0, 99.99, 100.0, 1e6, 1e12])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    blocks = [r._block for r in with_value_block(df, "v").orderBy("v").collect()]
    assert blocks == sorted(blocks)
    words = spark.createDataFrame([(w,) for w in ["", "A", "Brand#10", "Brand#2", "b", "я"]], "v string")
    blocks = [r._block for r in with_value_block(words, "v").orderBy("v").collect()]
    assert blocks == sorted(blocks)


@pytest.mark.parametrize("value", [
    "cast(id + 1000000000000000000 as bigint)", "1000 + id / 20000", "id / 200000", "concat('Customer#', lpad(id, 9, '0'))",
    "timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id)", "if(id = 0, -1e15, id)",
    "if(id = 0, 'A', concat('Customer#', lpad(id, 9, '0')))", "if(id = 0, 'zz', concat('Customer#', lpad(id, 9, '0')))",
    "cast(id as decimal(38,0)) * 100000000000000000000", "date_add(date '1970-01-01', cast(id as int))",
])
@pytest.mark.parametrize("n", [20_000, 200_000])
def test_blocks_follow_the_data(spark, monkeypatch, value, n):
    """Narrow bands, surrogate keys, texts with a common start and outliers are spread like any other values, and blocks
    grow in number, not in size."""
    monkeypatch.setattr(ordered, "ROWS", 2048)
    df = spark.range(n).select(F.expr(value).alias("v"))
    sizes = [r["count"] for r in with_value_block(df, "v").groupBy("_block").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * 2048 and len(sizes) >= n / 2048 / 1.5


def test_samples_of_large_tables_are_bounded(spark, monkeypatch):
    """Beyond MARKS sampled values blocks grow instead."""
    monkeypatch.setattr(ordered, "ROWS", 64)
    monkeypatch.setattr(ordered, "MARKS", 1024)
    df = spark.range(100_000).select(F.col("id").alias("v"))
    assert 0.8 * 1024 < len(ordered._marks(df, "v", ("v",)).first().marks) < 1.2 * 1024
    blocks = with_value_block(df, "v").groupBy("_block").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
    rows = blocks.orderBy("_block").collect()
    assert 24 <= len(rows) <= 40 and sum(r.n for r in rows) == 100_000 and all(r.b - r.a + 1 == r.n for r in rows)


def test_blocks_of_few_values_or_none(spark, monkeypatch):
    """A hot value stays whole, null is in the first block, an empty table has none."""
    monkeypatch.setattr(ordered, "ROWS", 256)
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id")).alias("v"), "id")
    got = with_value_block(df, "v", ("id",))
    assert got.filter("v = 5").select("_block").distinct().count() == 1
    assert [r._block for r in got.filter("v is null").select("_block").distinct().collect()] == [0]
    assert with_value_block(df.filter("id < 0"), "v").count() == 0
    assert with_value_block(df.filter("v is null"), "v").filter("_block = 0").count() == 10_000


@pytest.mark.parametrize("rows", [64, 1 << 17])
@pytest.mark.parametrize("descending", [False, True])
def test_running_total_steps_ties_together(spark, monkeypatch, descending, rows):
    monkeypatch.setattr(ordered, "ROWS", rows)
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": range(800), "v": rng.integers(1, 200, 800) * 1000})
    got = running_total(spark.createDataFrame(pdf), "v", "v", descending=descending).toPandas().sort_values("k")
    steps = pdf.groupby("v").v.sum().sort_index(ascending=not descending).cumsum()
    assert (got.running.to_numpy() == pdf.v.map(steps).to_numpy()).all()
    assert (got.grand_total == pdf.v.sum()).all()


def test_ordinal_codes_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS", 64)
    words = [f"Customer#{i:09d}" for i in range(5000)] + ["A", "zz", "", "я"]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(5)
    got = {r.category: r.code for r in fit_ordinal(df, "w").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}


def test_ordinal_dictionary_is_sorted(spark):
    words = ["pear", "apple", "fig", "apples", "äpfel", "Zoo"]
    df = spark.createDataFrame([(w,) for w in words * 3] + [(None,)], "w string")
    got = {r.category: r.code for r in fit_ordinal(df, "w").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}


@pytest.mark.parametrize("rows", [32, 128, 1 << 17])
def test_interpolation_equals_pandas(spark, monkeypatch, rows):
    monkeypatch.setattr(ordered, "ROWS", rows)
    rng = np.random.default_rng(11)
    keys = rng.choice(["hot", "a", "b"], 600, p=[0.8, 0.15, 0.05])
    values = np.where(rng.random(600) < 0.6, np.nan, rng.integers(0, 1000, 600).astype(float))
    values[-40:] = np.nan
    values[:25] = np.nan
    pdf = pd.DataFrame({"k": keys, "t": np.cumsum(rng.integers(1, 50, 600)), "v": values})
    df = spark.createDataFrame(pdf).repartition(4)
    got = interpolate(df, "v", "t", ("k",)).toPandas().sort_values("t").v.to_numpy(float)
    want = pdf.groupby("k").v.transform(lambda s: s.interpolate(method="linear")).to_numpy(float)
    np.testing.assert_allclose(got, want, atol=1e-9)


@pytest.mark.parametrize("rows", [32, 1 << 17])
def test_interpolation_with_equal_times(spark, monkeypatch, rows):
    monkeypatch.setattr(ordered, "ROWS", rows)
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"t": rng.integers(0, 20, 400), "e": rng.permutation(400), "v": np.where(rng.random(400) < 0.5, np.nan, rng.random(400))})
    pdf = pdf.sort_values(["t", "e"], ignore_index=True)
    df = spark.createDataFrame(pdf).repartition(7)
    got = interpolate(df, "v", ("t", "e")).toPandas().sort_values(["t", "e"]).v.to_numpy(float)
    np.testing.assert_allclose(got, pdf.v.interpolate(method="linear").to_numpy(float), atol=1e-9)


def test_interpolation_edges(spark):
    day = lambda i: dt.date(2025, 1, i)
    df = spark.createDataFrame([(day(1), None), (day(2), 1.0), (day(3), None), (day(9), 3.0), (day(10), None)], "d date, v double")
    got = [r.v for r in interpolate(df, "v", "d").orderBy("d").collect()]
    assert got == [None, 1.0, 2.0, 3.0, 3.0]


def test_money_quantiles_are_exact(spark):
    df = spark.createDataFrame([(M("0.10"),), (M("0.20"),), (M("0.31"),), (M("0.40"),)], "v decimal(18,2)")
    got = distribution(df, "v", {"q1": 0.25, "q2": 0.5}).first()
    assert (got.q1, got.q2, got.total) == (0.175, 0.255, M("1.01"))
