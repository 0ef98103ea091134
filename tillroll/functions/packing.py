"""A few short columns as one number whose order is theirs.

The first or last row of a group is then the least or greatest number, which a hash aggregate keeps; over a struct it would
be a sort of all rows. A missing value has code 0 and comes first, as in a struct.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers of up to 38 digits can be held.
_ROOM, _NUMBER = 10**38, "decimal(38,0)"
_BITS = {
    T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.DateType: 32, T.LongType: 64, T.TimestampType: 64, T.TimestampNTZType: 64
}


def _shift(kind: T.DataType) -> int | None:
    """What makes the least value's code 1; None for types that are not short."""
    if isinstance(kind, T.DecimalType):
        return 10**kind.precision if kind.precision <= 18 else None
    bits = _BITS.get(type(kind))
    return (1 << (bits - 1)) + 1 if bits else None


def _codes(kind: T.DataType) -> int:
    """How many codes a type has, the one of a missing value included."""
    return 2 * _shift(kind)


def _number(x: int) -> Column:
    return F.lit(Decimal(x)).cast(_NUMBER)


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def _code(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        col = col * F.lit(Decimal(10**kind.scale))
    elif isinstance(kind, T.DateType):
        col = F.unix_date(col)
    elif isinstance(kind, T.TimestampType):
        col = F.unix_micros(col)
    elif isinstance(kind, T.TimestampNTZType):
        col = F.timestamp_diff("MICROSECOND", _epoch(), col)
    return F.coalesce(col.cast(_NUMBER) + _number(_shift(kind)), _number(0))


def packed(df: DataFrame, names: list[str]) -> list[Column] | None:
    """For each name the number of it and all names before it, or None if a type is not short or they do not fit together.

    The least number of `names[:k]` begins the least of `names[:k + 1]`, so the columns of a first row are read off by
    `unpacked` from the least of each.
    """
    kinds = [df.schema[c].dataType for c in names]
    if any(_shift(k) is None for k in kinds):
        return None
    room, numbers = 1, []
    for name, kind in zip(names, kinds):
        room *= _codes(kind)
        code = _code(F.col(f"`{name}`"), kind)
        numbers.append((numbers[-1] * _number(_codes(kind)) + code).cast(_NUMBER) if numbers else code)
    return numbers if room < _ROOM else None


def unpacked(number: Column, kind: T.DataType) -> Column:
    """The value of the last name in a number."""
    code = (number % _number(_codes(kind))).cast(_NUMBER)
    value = code - _number(_shift(kind))
    if isinstance(kind, T.DecimalType):
        value = value.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-kind.scale))
    elif isinstance(kind, T.DateType):
        value = F.date_from_unix_date(value.cast("int"))
    elif isinstance(kind, T.TimestampType):
        value = F.timestamp_micros(value.cast("bigint"))
    elif isinstance(kind, T.TimestampNTZType):
        value = F.timestamp_add("MICROSECOND", value.cast("bigint"), _epoch())
    return F.when(code > 0, value.cast(kind))
