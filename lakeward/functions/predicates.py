"""Filter predicates (FLT-1..9)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeward.functions.cleanse import as_col, blank_to_null

__all__ = ["non_blank", "matches_key", "in_list", "not_in_list", "is_false",
           "is_true", "distinct_from", "non_zero"]


def non_blank(c: Column | str) -> Column:
    """FLT-1."""
    return blank_to_null(c).isNotNull()


def matches_key(c: Column | str, regex: str) -> Column:
    """FLT-2: case-sensitive, unanchored unless the pattern anchors itself."""
    return F.coalesce(F.regexp_like(as_col(c), F.lit(regex)), F.lit(False))


def in_list(c: Column | str, values: Iterable) -> Column:
    """FLT-5: a null operand is neither in nor out (three-valued)."""
    return as_col(c).isin(list(values))


def not_in_list(c: Column | str, values: Iterable) -> Column:
    return ~as_col(c).isin(list(values))


def is_true(c: Column | str) -> Column:
    """``x is true``: null -> false."""
    return F.coalesce(as_col(c), F.lit(False))


def is_false(c: Column | str, nulls_as_false: bool = False) -> Column:
    """FLT-4: ``x = false`` drops nulls, ``coalesce(x,false) = false`` keeps them."""
    x = as_col(c)
    return (F.coalesce(x, F.lit(False)) == F.lit(False)) if nulls_as_false else (x == F.lit(False))


def distinct_from(a: Column | str, b: Column | str) -> Column:
    """FLT-9: ``a is distinct from b``."""
    return ~as_col(a).eqNullSafe(as_col(b))


def non_zero(c: Column | str) -> Column:
    """FLT-8: ``coalesce(x, 0) <> 0``."""
    return F.coalesce(as_col(c), F.lit(0)) != F.lit(0)
