"""Row generators, unpivot and set verbs (GEN-1..7, SET-1..4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.cleanse import as_col


def values_relation(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """GEN-1: an inline VALUES relation (alias maps, overrides).  Small by
    construction."""
    return spark.createDataFrame(list(rows), schema)


def unnest(df: DataFrame, arr: str | Column, out: str, pos: str | None = None) -> DataFrame:
    """GEN-2: one row per array element (nulls/empty arrays produce no row)."""
    if pos:
        return df.select("*", F.posexplode(as_col(arr)).alias(pos, out))
    return df.select("*", F.explode(as_col(arr)).alias(out))


def split_to_rows(df: DataFrame, c: str | Column, regex: str, out: str) -> DataFrame:
    """GEN-3: regex split to rows, items trimmed, blank items dropped."""
    x = F.explode(F.split(as_col(c), regex)).alias("__s")
    return (df.select("*", x).withColumn(out, F.nullif(F.trim("__s"), F.lit("")))
            .drop("__s").filter(F.col(out).isNotNull()))


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str,
            value_type: str | None = None) -> DataFrame:
    """GEN-4: wide -> long in one scan (Expand), instead of a union per column."""
    src = df.select(*ids, *[(F.col(c).cast(value_type) if value_type else F.col(c)).alias(c) for c in cols])
    return src.unpivot(list(ids), list(cols), name, value)


def lateral_values(df: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """GEN-5: one input row -> several output rows given as column dicts
    (``explode(array(struct(...)))``, i.e. LATERAL VALUES)."""
    structs = [F.struct(*[v.alias(k) for k, v in r.items()]) for r in rows]
    return df.select("*", F.inline(F.array(*structs)))


def series(spark: SparkSession, start: Column, end: Column, step: Column | None = None,
           out: str = "value") -> DataFrame:
    """GEN-6: integer/date series as a one-row sequence exploded."""
    seq = F.sequence(start, end, step) if step is not None else F.sequence(start, end)
    return spark.range(1).select(F.explode(seq).alias(out))


def add_default_member(children: DataFrame, parents: DataFrame, parent_key: str, child_name: str,
                       default_name: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """GEN-7: append one default child per parent that lacks it (anti join +
    union; a parent that already has the default keeps just its own row)."""
    have = children.filter(F.col(child_name) == F.lit(default_name)).select(parent_key)
    missing = parents.select(parent_key).distinct().join(have, parent_key, "left_anti")
    cols = {c: F.lit(None).cast(t) for c, t in children.dtypes}
    cols[parent_key] = F.col(parent_key)
    cols[child_name] = F.lit(default_name)
    for k, v in (extra or {}).items():
        cols[k] = v
    defaults = missing.select(*[cols[c].cast(dict(children.dtypes)[c]).alias(c) for c in children.columns])
    return children.unionByName(defaults)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-1: union all by name; columns missing in a branch become nulls."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET-2."""
    return a.unionByName(b).distinct()


def key_set_diff(a: DataFrame, b: DataFrame, key: str, a_name: str = "left",
                 b_name: str = "right") -> DataFrame:
    """SET-4: keys present on one side only, labelled with the side holding
    them; empty when the key sets are equal."""
    ka, kb = a.select(key).distinct(), b.select(key).distinct()
    only_a = ka.join(kb, key, "left_anti").select(F.lit(a_name).alias("only_in"), key)
    only_b = kb.join(ka, key, "left_anti").select(F.lit(b_name).alias("only_in"), key)
    return only_a.unionByName(only_b)
