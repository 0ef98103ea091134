"""Columns packed into one number, against the order of structs."""

import datetime as dt
import random
from decimal import Decimal as M

import pytest
from pyspark.sql import functions as F

from tillroll.functions.packing import packed, unpacked
from tillroll.operators.receipts import dedup

KINDS = {
    "tinyint": [-128, 127, 0, None], "smallint": [-32768, 32767, None], "int": [-(2**31), 2**31 - 1, 0, None],
    "bigint": [-(2**63), 2**63 - 1, -1, 0, None], "date": [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(9999, 12, 31), None],
    "decimal(18,2)": [M("-9999999999999999.99"), M("9999999999999999.99"), M("0.01"), M("-0.01"), M("0.00"), None],
    "decimal(5,0)": [M(-99999), M(99999), None], "decimal(4,4)": [M("0.9999"), M("-0.9999"), M("0.0001"), None],
    "timestamp_ntz": [dt.datetime(1900, 1, 1, 0, 0, 0, 1), dt.datetime(2024, 2, 29, 23, 59, 59, 999999), None],
    "timestamp": [dt.datetime(1971, 1, 1, 0, 0, 0, 1), dt.datetime(2024, 2, 29, 23, 59, 59, 999999), None],
}


@pytest.mark.parametrize("kind", list(KINDS))
def test_values_come_back_and_keep_their_order(spark, kind):
    df = spark.createDataFrame([(v,) for v in KINDS[kind]], f"v {kind}")
    number = packed(df, ["v"])[0]
    got = df.select("v", unpacked(number, df.schema["v"].dataType).alias("back"), number.alias("n")).orderBy(F.asc_nulls_first("v")).collect()
    assert all(r.v == r.back for r in got)
    assert [r.n for r in got] == sorted({r.n for r in got}) and got[0].n == 0


def test_types_that_do_not_fit(spark):
    df = spark.createDataFrame([], "a bigint, b timestamp, c decimal(18,2), s string, w decimal(30,2), x double")
    assert len(packed(df, ["a", "c"])) == 2 and len(packed(df, ["b", "c"])) == 2
    assert packed(df, ["a", "b", "c"]) is None
    assert packed(df, ["s"]) is None and packed(df, ["w"]) is None and packed(df, ["x"]) is None


@pytest.mark.parametrize("how", ["first_row", "last_row", "first_value"])
@pytest.mark.parametrize("when", ["date", "timestamp_ntz", "bigint", "string"])
def test_dedup_equals_sorting(spark, how, when):
    """Packed, and for text by struct, against rows sorted in Python with missing values first."""
    rng = random.Random(3)
    stamps = {
        "date": lambda i: dt.date(2025, 1, 1 + i), "timestamp_ntz": lambda i: dt.datetime(2025, 1, 1, i), "bigint": lambda i: i - 2, "string": str,
    }[when]
    rows = [
        (rng.choice(["a", "b", "c", None]), None if (i := rng.randrange(5)) == 4 else stamps(i), rng.choice([M("-1.50"), M("0.00"), M("7.25"), None]))
        for _ in range(200)
    ]
    rows += [("only missing", None, None)]
    df = spark.createDataFrame(rows, f"transaction_id string, sold {when}, total_cost decimal(18,2)").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in dedup(df, how, ("sold", "total_cost"), order=("sold",)).collect()}
    first = lambda x: (x is not None, x) if x is not None else (False,)
    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == key), key=lambda r: tuple(map(first, r)))
        if how == "first_value":
            want[key] = tuple(next((r[c] for r in mine if r[c] is not None), None) for c in (0, 1))
        else:
            want[key] = mine[0 if how == "first_row" else -1]
    assert got == want
