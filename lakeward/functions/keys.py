"""Keys and Unicode text normalisation (PRJ-3, PRJ-4, PRJ-5)."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.cleanse import as_col, collapse_spaces

__all__ = ["SURROGATE_NULL", "surrogate_key", "nfc", "normalize_text", "match_key"]

# Fixed value: the placeholder the widely used surrogate-key macro writes for a
# null field before hashing, so keys stay comparable with warehouse keys.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """PRJ-3: md5 over '-'-joined text fields, nulls replaced by a sentinel."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


@F.pandas_udf(T.StringType())
def _nfc_batch(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFC")


@functools.lru_cache(maxsize=1)
def nfc_suspect_class() -> str:
    """Java regex class covering every character that can make a string
    non-NFC (Unicode quick check): non-zero combining class, changed by NFC on
    its own (singletons, excluded compositions), or second part of a
    canonical composition.  Generated by rule from ``unicodedata``: marks are
    matched with ``\\p{M}`` and the remaining characters as a few merged
    ranges (a superset is harmless; it only sends more values to the exact
    Python step).  A string with none of them is already NFC (UAX #15)."""
    sus: set[int] = set()
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if unicodedata.combining(ch) or unicodedata.normalize("NFC", ch) != ch:
            sus.add(cp)
            continue
        sus.update(ord(x) for x in unicodedata.normalize("NFD", ch)[1:])
    rest = sorted(cp for cp in sus if not unicodedata.category(chr(cp)).startswith("M"))
    ranges: list[list[int]] = []
    for cp in rest:
        if ranges and cp - ranges[-1][1] <= 0x100:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    return "[\\p{M}" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def nfc(c: Column | str) -> Column:
    """Unicode NFC, computed in the JVM by the ICU4J library that ships with
    Spark (``Normalizer.compose(text, false)`` through ``reflect``), and only
    for values that hold a character NFC could change; every other value is
    returned as is after one regex test.  Use :func:`nfc_python` where ICU4J
    is not on the classpath."""
    x = as_col(c)
    icu = F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(False))
    return F.when(F.regexp_like(x, F.lit(nfc_suspect_class())), icu).otherwise(x)


def nfc_python(c: Column | str) -> Column:
    """Same as :func:`nfc` through an Arrow pandas UDF (Python workers)."""
    x = as_col(c)
    return F.when(F.regexp_like(x, F.lit(nfc_suspect_class())), _nfc_batch(x)).otherwise(x)


def normalize_text(c: Column | str) -> Column:
    """PRJ-4: NFC, trim, collapse white space; blank -> null."""
    return F.nullif(collapse_spaces(nfc(c)), F.lit(""))


def match_key(c: Column | str) -> Column:
    """PRJ-5: lower-cased normalised text used only for equality joins."""
    return F.lower(normalize_text(c))
