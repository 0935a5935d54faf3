"""Cleansing expressions for raw text columns (PRJ-1..20)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "WHITESPACE_CLASS", "as_col", "blank_to_null", "safe_cast", "lenient_cast",
    "collapse_spaces", "sentinel_to_null", "default_member", "coalesce_priority",
    "status_case", "bucketize", "currency_heuristic", "digits_only_number",
    "decimal_comma", "build_url", "concat_skip_null", "json_locale_pick",
    "json_or_text", "ratio", "typed_null", "flag",
]

# The characters treated as white space by the text cleaners
# (ASCII tab, line feed, vertical tab, form feed, carriage return, space, next
# line U+0085, no-break space U+00A0, ogham space U+1680, en quad .. hair space
# U+2000-U+200A, line/paragraph separators U+2028/U+2029, narrow no-break space
# U+202F, medium mathematical space U+205F, ideographic space U+3000).  Spelled
# out as literal characters so that Java regex and RE2 (the SQL oracle) agree.
WHITESPACE_CHARS = ("\t\n\x0b\x0c\r \x85\xa0\u1680"
                    + "".join(chr(c) for c in range(0x2000, 0x200B))
                    + "\u2028\u2029\u202f\u205f\u3000")
WHITESPACE_CLASS = "[" + WHITESPACE_CHARS + "]"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """PRJ-1: ``nullif(trim(cast(x as string)), '')`` (space-only trim)."""
    return F.nullif(F.trim(as_col(c).cast("string")), F.lit(""))


def safe_cast(c: Column | str, dtype: str | T.DataType) -> Column:
    """PRJ-2: blank -> null, then a strict cast (bad text raises under ANSI)."""
    return blank_to_null(c).cast(dtype)


def lenient_cast(c: Column | str, dtype: str | T.DataType) -> Column:
    """Blank -> null, unparseable -> null (``try_cast``), for coercing readers."""
    return blank_to_null(c).try_cast(dtype)


# The same set as Unicode's White_Space property, which Java regex matches
# natively (much faster than the spelled-out class on long texts).
JAVA_WHITESPACE = "\\p{IsWhite_Space}"


def collapse_spaces(c: Column | str) -> Column:
    """Collapse every run of white space to one ASCII space, then trim."""
    return F.trim(F.regexp_replace(as_col(c), JAVA_WHITESPACE + "+", " "))


def sentinel_to_null(c: Column | str, tokens: Iterable[str]) -> Column:
    """PRJ-6: spreadsheet error/placeholder tokens (compared trimmed and
    upper-cased) become null; blanks become null as well."""
    v = blank_to_null(c)
    toks = [t.upper() for t in tokens]
    return F.when(F.upper(v).isin(toks), F.lit(None).cast("string")).otherwise(v)


def default_member(c: Column | str, default: str, synonyms: Iterable[str] = ()) -> Column:
    """PRJ-7: null/blank or any synonym (case-insensitive) -> the named default."""
    v = blank_to_null(c)
    syn = [s.lower() for s in synonyms]
    cond = v.isNull()
    if syn:
        cond = cond | F.lower(v).isin(syn)
    return F.when(cond, F.lit(default)).otherwise(v)


def coalesce_priority(*cols: Column | str) -> Column:
    """PRJ-8: first non-blank value, in priority order."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def status_case(branches: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """PRJ-9: searched CASE from (condition, value) pairs."""
    expr = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return expr.otherwise(d)


def bucketize(c: Column | str, bounds: Sequence[float], labels: Sequence[str],
              null_label: str) -> tuple[Column, Column]:
    """PRJ-10: value -> (band label, band sort key).  ``bounds`` are inclusive
    upper bounds of the first ``len(bounds)`` bands; values above the last bound
    fall in the last label; null falls in ``null_label`` with sort key 0."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one more label than bounds")
    x = as_col(c)
    label = F.when(x.isNull(), F.lit(null_label))
    sort = F.when(x.isNull(), F.lit(0))
    for i, b in enumerate(bounds):
        label = label.when(x <= F.lit(b), F.lit(labels[i]))
        sort = sort.when(x <= F.lit(b), F.lit(i + 1))
    return label.otherwise(F.lit(labels[-1])), sort.otherwise(F.lit(len(bounds) + 1))


def currency_heuristic(c: Column | str, threshold: float, rate: float = 25000.0,
                       dtype: str = "decimal(20,8)", in_type: str = "decimal(18,2)") -> Column:
    """PRJ-11: amounts above ``threshold`` are taken to be in local currency
    and divided by ``rate``.  Decimal arithmetic throughout (input cast to
    ``in_type`` keeps Spark's result scale wide enough to stay exact)."""
    x = as_col(c).cast(in_type)
    r = F.lit(rate).cast("decimal(18,6)")
    return F.when(x > F.lit(threshold), x / r).otherwise(x).cast(dtype)


def digits_only_number(c: Column | str, keep_dot: bool = False,
                       dtype: str = "decimal(38,2)", default: object = None) -> Column:
    """PRJ-12: strip every character but digits (and optionally '.'), then
    cast; empty -> ``default``.  Note that sign and decimal comma are removed."""
    pattern = "[^0-9.]" if keep_dot else "[^0-9]"
    v = F.nullif(F.regexp_replace(as_col(c).cast("string"), pattern, ""), F.lit(""))
    out = v.cast(dtype)
    return out if default is None else F.coalesce(out, F.lit(default).cast(dtype))


def decimal_comma(c: Column | str, thousands: bool = False) -> Column:
    """PRJ-13: ``thousands=False``: decimal comma -> dot;  ``True``: remove
    thousands separators (commas)."""
    x = as_col(c).cast("string")
    return F.replace(x, F.lit(","), F.lit("")) if thousands else F.replace(x, F.lit(","), F.lit("."))


def build_url(prefix: str, c: Column | str) -> Column:
    """PRJ-14: literal prefix + id; null id -> null url."""
    return F.concat(F.lit(prefix), as_col(c).cast("string"))


def concat_skip_null(*cols: Column | str) -> Column:
    """PRJ-15: variadic concat that ignores nulls."""
    return F.concat_ws("", *[as_col(c).cast("string") for c in cols])


def json_locale_pick(c: Column | str, locales: Sequence[str]) -> Column:
    """PRJ-16: first present locale value of a JSON object text."""
    return F.coalesce(*[F.get_json_object(as_col(c), f"$.{loc}") for loc in locales])


def json_or_text(c: Column | str, field: str) -> Column:
    """PRJ-17: JSON object text -> one field; any other text -> itself."""
    x = as_col(c)
    return F.when(F.left(x, F.lit(1)) == F.lit("{"), F.get_json_object(x, f"$.{field}")).otherwise(x)


def ratio(num: Column | str, den: Column | str, scale: float = 1.0,
          on_zero: object = None) -> Column:
    """PRJ-18: ``num / den * scale`` as double; zero or null denominator ->
    ``on_zero`` (null by default).  Never raises under ANSI."""
    n, d = as_col(num).cast("double"), as_col(den).cast("double")
    z = on_zero if isinstance(on_zero, Column) else F.lit(on_zero).cast("double")
    return F.when(d.isNull() | (d == 0), z).otherwise(n / d * F.lit(scale))


def typed_null(dtype: str | T.DataType) -> Column:
    """PRJ-19: a typed null for aligning union branches."""
    return F.lit(None).cast(dtype)


def flag(cond: Column) -> Column:
    """PRJ-20: predicate materialised as a non-null boolean column."""
    return F.coalesce(cond, F.lit(False))


def rename_map(mapping: Mapping[str, str]) -> list[Column]:
    return [F.col(f"`{s}`").alias(t) for s, t in mapping.items()]
