import datetime as dt
from decimal import Decimal as M

import pytest
from pyspark.sql import functions as F

from tillroll.operators import allocate as A
from tillroll.operators import prep as P
from tillroll.operators.pivots import histogram, percent_rank_average, with_row_total
from tillroll.operators.quality import null_counts
from tillroll.plans import dashboards
from tillroll.sources import tables
from tillroll.constants import WEEKDAY_SHARES, WEEKEND_SHARES


@pytest.fixture
def air(spark):
    rows = [(10.0, 15.0, "Moscow"), (20.0, None, "SPB"), (None, 35.0, None), (40.0, 45.0, "Moscow")]
    return spark.createDataFrame(rows, "pm25 double, pm10 double, city string")


def test_fill(air, rows):
    means = P.handle_missing(air, "mean", ["pm25", "pm10"]).collect()
    assert means[2].pm25 == pytest.approx(23.3333, abs=1e-3) and means[1].pm10 == pytest.approx(31.6667, abs=1e-3)
    assert P.handle_missing(air, "median", ["pm25"]).collect()[2].pm25 == 20.0
    assert P.handle_missing(air, "most_frequent", ["city"]).collect()[2].city == "Moscow"
    assert P.handle_missing(air, "drop", ["pm25", "city"]).count() == 3
    with pytest.raises(ValueError):
        P.handle_missing(air, "interpolate", ["pm25"])
    with pytest.raises(ValueError):
        P.handle_missing(air, "zero", ["pm25"])


def test_mode_prefers_the_smallest_of_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert P.mode_of(df, "v").first()[0] == "a"


def test_duplicates_and_empty_rows(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, None)], "a int, b string")
    assert P.remove_duplicates(df).count() == 3
    assert P.remove_duplicates(df, ["a"], order=("b",)).count() == 2
    assert P.drop_empty_rows(df).count() == 3


def test_outliers_are_moved_to_the_fences(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "v double")
    got = sorted(r.v for r in P.handle_outliers(df, "v").collect() if r.v is not None)
    assert got == [1.0, 2.0, 3.0, 4.0, 7.0]


def test_fence_of_the_published_quartiles(spark):
    df = spark.createDataFrame([(320.0,), (320.0,), (450.0,), (580.0,), (580.0,)], "v double")
    assert P.iqr_limits(df, "v").first().upper == 970.0


def test_encoders(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    use = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "i int, k string")
    hot = P.encode_categorical(use, ["k"], "onehot", fit_on=fit)
    assert hot.columns == ["i", "k_a", "k_b", "k_c"]
    assert [tuple(r) for r in hot.orderBy("i").collect()] == [(1, 1.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0), (3, 0.0, 0.0, 0.0)]
    codes = P.encode_categorical(use, ["k"], "ordinal", fit_on=fit)
    assert [r.k for r in codes.orderBy("i").collect()] == [0, -1, None]


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert [tuple(r) for r in P.standard_scale(df, ["x", "y"]).orderBy("x").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_pipeline(air):
    got = P.preprocess(air, ["pm25", "pm10"], ["city"])
    assert got.columns == ["pm25", "pm10", "city_Moscow", "city_SPB"]
    rows = got.collect()
    assert rows[2].pm25 == pytest.approx(0.0) and rows[2].city_Moscow == 1.0 and rows[1].city_SPB == 1.0


def test_line_fit(spark):
    df = spark.createDataFrame([(1, 150), (5, 350), (10, 600)], "x int, y int")
    got = P.predict_line(P.fit_line(df, "x", "y"), 20).first()
    assert tuple(round(v, 6) for v in got) == (50.0, 100.0, 1100.0)


def test_split_keeps_the_total(spark):
    df = spark.range(0, 200).select(F.col("id").alias("n"))
    for shares in (WEEKDAY_SHARES, WEEKEND_SHARES):
        parts = df.select("n", F.inline(A.split_total(F.col("n"), shares)))
        wrong = parts.groupBy("n").agg(F.sum("cnt").alias("s"), F.min("cnt").alias("m")).filter("s <> n or m < 0")
        assert wrong.count() == 0
    row = spark.range(1).select(F.inline(A.split_total(F.lit(42), WEEKDAY_SHARES))).collect()
    assert {r.part: r.cnt for r in row} == {"morning": 17, "afternoon": 21, "evening": 4}


def test_expand(spark):
    df = spark.createDataFrame([("a", 3), ("b", 0), ("c", -1), ("d", 250), ("e", None)], "k string, n int")
    got = A.expand_by_count(df, "n", chunk=100)
    counts = {r.k: (r.c, r.lo, r.hi, r.u) for r in got.groupBy("k").agg(
        F.count("*").alias("c"), F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.countDistinct("seq").alias("u")).collect()}
    assert counts == {"a": (3, 1, 3, 3), "d": (250, 1, 250, 250)}


def test_interval_lookup(spark):
    bands = [("low", 10), ("mid", 20), ("high", None)]
    df = spark.createDataFrame([(v,) for v in (-5.0, 9.99, 10.0, 19.0, 20.0, 1e9, None)], "v double")
    got = [r[0] for r in df.select(A.interval_lookup(F.col("v"), bands)).collect()]
    assert got == ["low", "low", "mid", "mid", "high", "high", None]
    assert df.select(A.interval_lookup(F.col("v"), bands[:2]).alias("b")).filter("b is null").count() == 3


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None), (4, 3.0)], "i int, v double")
    values = lambda d: [r.v for r in d.orderBy("i").collect()]
    assert values(P.handle_missing(df, "mean", ["v"])) == [1.0, 2.0, 2.0, 3.0]
    assert values(P.handle_missing(df, "median")) == [1.0, 2.0, 2.0, 3.0]
    assert values(P.handle_missing(df, "most_frequent", ["v"])) == [1.0, 1.0, 1.0, 3.0]
    assert values(P.handle_missing(df, "drop")) == [1.0, 3.0]
    assert values(P.handle_missing(df, "interpolate", order="i")) == pytest.approx([1.0, 5 / 3, 7 / 3, 3.0])
    assert values(P.standard_scale(df, ["v"])) == [-1.0, None, None, 1.0]
    assert null_counts(df).filter("column_name = 'v'").first().missing == 2


def test_missing_categories(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "i int, k string")
    rows = lambda d: [tuple(r) for r in d.orderBy("i").collect()]
    assert rows(P.encode_categorical(df, ["k"], "ordinal")) == [(1, 1), (2, None), (3, 0)]
    got = P.encode_categorical(df, ["k"], "onehot")
    assert got.columns == ["i", "k_a", "k_b", "k_None"]
    assert rows(got) == [(1, 0.0, 1.0, 0.0), (2, 0.0, 0.0, 1.0), (3, 1.0, 0.0, 0.0)]
    assert rows(P.encode_categorical(df, ["k"], "onehot_index")) == [(1, 1), (2, 2), (3, 0)]
    seen = df.filter("k = 'a'")
    assert rows(P.encode_categorical(df, ["k"], "onehot_index", fit_on=seen)) == [(1, None), (2, None), (3, 0)]
    for method in ("ordinal", "onehot"):
        with pytest.raises(Exception, match="unknown category b"):
            rows(P.encode_categorical(df, ["k"], method, fit_on=df.filter("k is null or k = 'a'"), handle_unknown="error"))
        assert len(rows(P.encode_categorical(df, ["k"], method, handle_unknown="error"))) == 3
    many = spark.range(1500).select(F.col("id").alias("i"), F.concat(F.lit("c"), F.col("id")).alias("k"))
    assert P.encode_categorical(many, ["k"], "onehot_index").agg(F.max("k")).first()[0] == 1499
    assert len(P.fit_onehot(many, ["k"])["k"]) == 1500


def test_first_row_of_a_subset(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 1, 2), ("a", 1, 3), ("b", 9, 4), (None, 1, 5)], "k string, t int, i int")
    got = P.remove_duplicates(df.repartition(4), ["k"], order=("t", "i"))
    assert sorted(r.i for r in got.collect()) == [2, 4, 5]
    with pytest.raises(ValueError):
        P.remove_duplicates(df, ["k"])


def test_no_product_is_lost(spark):
    rows = [("2025-07-07", f"p{i:03}", M(i + 1)) for i in range(150)] + [("2025-07-08", None, M(5))]
    lines = spark.createDataFrame(rows, "sale_date string, coffee_name string, drink_price decimal(18,2)")
    lines = lines.withColumn("sale_date", F.col("sale_date").cast("date"))
    pie = dashboards.revenue_share_pie(lines)
    assert pie.count() == 151 and pie.agg(F.sum("contribution")).first()[0] == pytest.approx(1.0, abs=1e-4)
    best = dashboards.revenue_share_pie(lines, limit=2).collect()
    assert [r.coffee_name for r in best] == ["p149", "p148"] and best[0].contribution == pytest.approx(150 / 11330, abs=1e-6)
    assert dashboards.drinks_by_week(lines, ["p000", "p001"]).collect()[0].asDict() == {
        "week_start": dt.date(2025, 7, 7), "p000": 1, "p001": 1, "other": 149}
    assert len(dashboards.drinks_by_week(lines).columns) == 151


def test_union(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, k string"), spark.createDataFrame([("y", 2), ("y", 2)], "k string, i int")
    got = tables.union_all(a, b, spark.createDataFrame([(3,)], "i int"))
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "x"), (2, "y"), (2, "y"), (3, None)]


def test_histogram_and_pivot_helpers(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 10]], "v double")
    got = histogram(df, "v", 5).collect()
    assert [r.n for r in got] == [2, 2, 2, 2, 2] and got[-1].bin_end == 10.0
    flat = spark.createDataFrame([(7.0,), (7.0,)], "v double")
    assert [r.n for r in histogram(flat, "v", 2).collect()] == [2, 0]
    cells = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (4.0,)], "v double")
    assert sorted(r["rank"] for r in percent_rank_average(cells, "v").collect()) == [0.25, 0.625, 0.625, 1.0]
    row = with_row_total(spark.createDataFrame([(1.5, None)], "a double, b double"), ["a", "b"]).first()
    assert row.row_total == 1.5
