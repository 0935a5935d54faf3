"""Explicit sort specifications.

The source SQL follows PostgreSQL null ordering (ASC puts nulls last, DESC puts
them first); Spark's defaults are the reverse, so every order used by this
library is spelled out through :class:`Order`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.cleanse import as_col


@dataclass(frozen=True)
class Order:
    """One sort key.  ``nulls_last=None`` means PostgreSQL's default for the
    direction (ASC -> nulls last, DESC -> nulls first)."""

    col: Column | str
    desc: bool = False
    nulls_last: bool | None = None

    @property
    def nulls_go_last(self) -> bool:
        return (not self.desc) if self.nulls_last is None else self.nulls_last

    def sort_col(self) -> Column:
        c = as_col(self.col)
        if self.desc:
            return c.desc_nulls_last() if self.nulls_go_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_go_last else c.asc_nulls_first()


def asc(c: Column | str, nulls_last: bool | None = None) -> Order:
    return Order(c, False, nulls_last)


def desc(c: Column | str, nulls_last: bool | None = None) -> Order:
    return Order(c, True, nulls_last)


def as_orders(order: Sequence[Order | str | Column]) -> list[Order]:
    return [o if isinstance(o, Order) else Order(o) for o in order]


def numeric_first(c: Column | str) -> list[Order]:
    """WIN-2 id preference: numeric-looking ids first, then numerically, then as text."""
    x = as_col(c).cast("string")
    return [asc(F.when(F.regexp_like(x, F.lit("^[0-9]+$")), F.lit(0)).otherwise(F.lit(1))),
            asc(x.try_cast("decimal(38,0)")),
            asc(x)]


def _negate(c: Column, dtype: T.DataType) -> Column | None:
    """An expression whose ascending order is the descending order of ``c``,
    or None when no such order-reversing map exists for the type."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return -c.cast("long")
    if isinstance(dtype, (T.LongType, T.FloatType, T.DoubleType, T.DecimalType)):
        return -c
    if isinstance(dtype, T.BooleanType):
        return ~c
    if isinstance(dtype, T.DateType):
        return -F.unix_date(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    return None


def ascending_key(df: DataFrame, order: Sequence[Order]) -> Column | None:
    """Encode a mixed-direction sort as one struct whose natural ascending
    order equals the requested order, so that places in it can be compared.
    Returns None when a descending key has no order-reversing encoding
    (e.g. descending text)."""
    fields: list[Column] = []
    for i, o in enumerate(order):
        c = as_col(o.col)
        dtype = df.select(c).schema[0].dataType
        null_flag = F.when(c.isNull(), F.lit(1 if o.nulls_go_last else 0)) \
                     .otherwise(F.lit(0 if o.nulls_go_last else 1))
        v = _negate(c, dtype) if o.desc else c
        if v is None:
            return None
        fields += [null_flag.alias(f"n{i}"), v.alias(f"v{i}")]
    return F.struct(*fields)
