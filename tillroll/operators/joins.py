"""Joins."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join where null keys match each other; the left side's key columns are kept.

    Also the way to join an aggregate back to its rows: a null-safe key is not the key the
    aggregate is partitioned by, so both sides are shuffled for the join, and only then can
    adaptive execution split the rows of a hot key over several tasks.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])
