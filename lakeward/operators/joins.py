"""Join verbs (JN-1..20).

Physical strategy is left to Catalyst and AQE, which broadcast a side by its
known or measured size in bytes, and split skewed partitions; no verb hints.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.cleanse import as_col
from lakeward.functions.keys import match_key


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi join on ``keys`` where null keys match each other (``<=>``);
    the right-hand key columns are dropped."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = e if cond is None else cond & e
    out = left.join(r, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def join_aggregated(left: DataFrame, agg: DataFrame, on: Sequence[tuple[str, str]], how: str = "left",
                    null_safe: bool = False) -> DataFrame:
    """Join rows with a table aggregated by the very join key, a hot key split.

    Spark would take the shuffle below the aggregate for the join's own, and a
    partition that is also aggregated cannot be split.  The join asks for one
    more column, a hash of the key, by which the aggregate is not dealt; so both
    sides are shuffled as they are, and the runtime splits a hot partition of
    ``left`` and reads the few aggregated rows with each piece.  ``on`` gives
    (column of ``left``, column of ``agg``); the latter are dropped."""
    right = agg.select(*[F.col(f"`{r}`").alias(f"__on{i}") for i, (_, r) in enumerate(on)],
                       F.xxhash64(*[F.col(f"`{r}`") for _, r in on]).alias("__on"),
                       *[F.col(f"`{c}`") for c in agg.columns if c not in {r for _, r in on}])
    types = [agg.schema[r].dataType for _, r in on]
    pairs = [(F.col(f"`{l}`").cast(t), F.col(f"__on{i}")) for i, ((l, _), t) in enumerate(zip(on, types))]
    same = [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs]
    same.append(F.xxhash64(*[x for x, _ in pairs]) == F.col("__on"))
    return left.join(right, same, how).drop("__on", *[f"__on{i}" for i in range(len(on))])


def lookup(left: DataFrame, dim: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """JN-2: left outer dimension lookup returning only ``cols`` of the dim."""
    return left.join(dim.select(*on, *cols), list(on), "left")


def full_outer_coalesce(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """JN-3: full outer join whose key is the first non-null of both sides."""
    l = left.withColumnRenamed(key, "__lk")
    r = right.withColumnRenamed(key, "__rk")
    out = l.join(r, F.col("__lk") == F.col("__rk"), "full")
    return out.select(F.coalesce("__lk", "__rk").alias(key),
                      *[c for c in out.columns if c not in ("__lk", "__rk")])


def exists(left: DataFrame, right: DataFrame, on: Sequence[str] | Column) -> DataFrame:
    """JN-4: rows of ``left`` with a match in ``right`` (left semi join)."""
    return left.join(right, on if isinstance(on, Column) else list(on), "left_semi")


def not_exists(left: DataFrame, right: DataFrame, on: Sequence[str] | Column) -> DataFrame:
    """JN-5: rows of ``left`` without a match (left anti join); rows whose key
    is null are kept, as NOT EXISTS keeps them."""
    return left.join(right, on if isinstance(on, Column) else list(on), "left_anti")


def exclude_keys(df: DataFrame, excluded: DataFrame, key: str, excluded_key: str | None = None) -> DataFrame:
    """JN-6: drop rows whose key is on an exclusion list (one hash anti join)."""
    ek = excluded_key or key
    ex = excluded.select(F.col(ek).alias("__ex"))
    return df.join(ex, F.col(key) == F.col("__ex"), "left_anti")


def left_filtered(left: DataFrame, right: DataFrame, on: Sequence[str], right_pred: Column) -> DataFrame:
    """JN-7: extra predicate in ON: filter the right side first, then left join."""
    return left.join(right.filter(right_pred), list(on), "left")


def left_residual(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                  residual: Column, how: str = "left") -> DataFrame:
    """JN-8: equi keys AND a residual (e.g. ``r.b is null or r.b = l.c``); the
    equi conjunct keeps the plan a hash/sort-merge join."""
    cond = residual
    for lk, rk in on:
        cond = cond & (left[lk] == right[rk])
    return left.join(right, cond, how)


def join_on_match_key(left: DataFrame, right: DataFrame, left_name: str, right_name: str,
                      how: str = "left", key_col: str = "__mk") -> DataFrame:
    """JN-9: join on normalised name keys materialised once on each side."""
    l = left.withColumn(key_col, match_key(left_name))
    r = right.withColumn(key_col, match_key(right_name))
    return l.join(r, key_col, how)


def join_cast(left: DataFrame, right: DataFrame, lk: str, rk: str, dtype: str = "string",
              upper: bool = False, how: str = "inner") -> DataFrame:
    """JN-11: explicit casts (and optional case folding) on both sides."""
    def key(df, c):
        x = df[c].cast(dtype)
        return F.upper(x) if upper else x
    return left.join(right, key(left, lk) == key(right, rk), how)


def bridge(left: DataFrame, bridge_df: DataFrame, right: DataFrame, k1: str, k2: str,
           distinct: bool = True) -> DataFrame:
    """JN-14: many-to-many through a bridge table."""
    out = left.join(bridge_df, k1).join(right, k2)
    return out.distinct() if distinct else out


def lookup_cascade(df: DataFrame, key_col: str, candidates: Sequence[tuple[DataFrame, str, str]],
                   out: str) -> DataFrame:
    """JN-16: first hit of several (dim, dim_key, dim_value) lookups on the
    same key: direct match, then alias, then globally unique name ..."""
    cur = df
    vals = []
    for i, (dim, dk, dv) in enumerate(candidates):
        d = dim.select(F.col(dk).alias(f"__ck{i}"), F.col(dv).alias(f"__cv{i}"))
        cur = cur.join(d, cur[key_col] == F.col(f"__ck{i}"), "left").drop(f"__ck{i}")
        vals.append(F.col(f"__cv{i}"))
    return cur.withColumn(out, F.coalesce(*vals)).drop(*[f"__cv{i}" for i in range(len(candidates))])


def as_of_lookup(df: DataFrame, key: str, ts: str, at: Column) -> DataFrame:
    """JN-20: per key, the newest row with ``ts <= at`` (max_by, partial-aggregated);
    of rows at the same time, the one with the largest values in column order."""
    cols = df.columns
    best = (df.filter(F.col(ts) <= at).groupBy(key)
            .agg(F.max_by(F.struct(*cols), F.struct(F.col(ts), *cols)).alias("__r")))
    return best.select("__r.*")


def explode_list(df: DataFrame, list_col: str | Column, sep_regex: str = ",",
                 pos: str = "pos", item: str = "item") -> DataFrame:
    """GEN-3: ``posexplode(split(nullif(x,''), sep))`` with trimmed items;
    null or empty lists yield no rows."""
    x = F.nullif(as_col(list_col), F.lit(""))
    return df.select("*", F.posexplode(F.split(x, sep_regex)).alias(pos, "__it")) \
             .withColumn(item, F.trim("__it")).drop("__it")


def list_lookup_agg(df: DataFrame, row_id: str, list_col: str, dim: DataFrame, dim_key: str,
                    dim_name: str, out: str, sep: str = ", ") -> DataFrame:
    """JN-18 / AGG-7: resolve a comma id list to names joined in list order
    (unknown ids skipped; no resolvable id -> null).  The names depend only on
    the list text, so they are resolved once per distinct list value (one
    explode, one join, one partial aggregation) and joined back on it; a list
    value shared by many rows is one row on the names side, and its rows are
    split (:func:`join_aggregated`).  ``row_id`` is kept
    for callers that key the result by row."""
    lists = df.select(F.col(list_col).alias("__list")).filter(F.col("__list").isNotNull()).distinct()
    items = explode_list(lists, "__list")
    d = dim.select(F.col(dim_key).cast("string").alias("item"), F.col(dim_name).alias("__name"))
    named = items.join(d, "item")
    agg = (named.groupBy("__list")
           .agg(F.array_sort(F.collect_list(F.struct(F.col("pos"), F.col("__name")))).alias("__l"))
           .select("__list", F.array_join(F.transform("__l", lambda s: s["__name"]), sep).alias(out)))
    return join_aggregated(df, agg, [(list_col, "__list")])
