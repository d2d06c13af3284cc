"""Casts for dirty text. ANSI mode stays on, so junk becomes null explicitly."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lenient_double(value: Column) -> Column:
    """Text to double; anything that is not a number is null."""
    return value.try_cast("double")


def lenient_long(value: Column) -> Column:
    """Text to bigint; also takes decimal text such as ``86400000.0``."""
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))


def known_or_zero(value: Column) -> Column:
    """Null and NaN both become 0."""
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(0.0))


def lenient(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.LongType):
        return lenient_long(value)
    return value.try_cast(data_type)
