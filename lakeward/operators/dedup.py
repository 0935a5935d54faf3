"""Deduplication and ranking (WIN-1..11, AGG-10/11, FLT-7).

Skew: any key may hold a large share of all rows, so the operators here do not
send a whole group to one task, but for numbering where that is asked for.

* top-1 per key (``first_by`` and friends) is ``row_number() = 1``, which Spark
  plans with a partial WindowGroupLimit: one row per key leaves a map task.
* running numbers within a key (``sequence_within``) are a plain window, the one
  place where a key's rows meet in a task; with ``spread`` a crowded key is cut
  into pieces along its order, which are numbered apart and moved on by the
  number of rows before them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.operators.joins import join_aggregated
from lakeward.operators.ordering import Order, as_orders, ascending_key


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Order | str | Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (DISTINCT ON).  Give a
    total order for deterministic output (WIN-4).

    ``row_number() = 1``: Spark sorts each task's rows and keeps one a key before
    the shuffle (WindowGroupLimit), so a key of any size costs a row a task.  In
    ``min_by`` the whole rows would be compared in an interpreted sort aggregate."""
    if set(df.columns) <= set(keys):
        return df.distinct()
    return _ranked_first(df, keys, order).drop("__rn")


def _ranked_first(df: DataFrame, keys: Sequence[str], order: Sequence[Order | str | Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[o.sort_col() for o in as_orders(order)])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1)


def latest_by(df: DataFrame, keys: Sequence[str], ts: str | Column,
              tie_break: Sequence[Order | str | Column] = ()) -> DataFrame:
    """WIN-1: newest row per key by ``ts`` (DESC, nulls first as in the source
    SQL), then ``tie_break``."""
    return first_by(df, keys, [Order(ts, desc=True)] + as_orders(tie_break))


def earliest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Order | str | Column]) -> DataFrame:
    """WIN-11: stable earliest row per key."""
    return first_by(df, keys, order)


def pick_first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Order | str | Column]) -> DataFrame:
    """WIN-2/3/4: DISTINCT ON with a declared priority order."""
    return first_by(df, keys, order)


def top1_value(df: DataFrame, keys: Sequence[str], value: str | Column,
               order: Sequence[Order | str | Column], out: str) -> DataFrame:
    """AGG-8: ``(array_agg(v order by ...))[1]`` per key as one column."""
    v = value if isinstance(value, Column) else F.col(value)
    return _ranked_first(df, keys, order).select(*keys, v.alias(out))


def mutual_best_match(df: DataFrame, a: str, b: str, order: Sequence[Order | str | Column],
                      a_tie: Sequence[Order | str | Column] = (),
                      b_tie: Sequence[Order | str | Column] = ()) -> DataFrame:
    """WIN-5: keep (a, b) pairs that are each other's first choice under
    ``order`` (greedy: a pair whose partner prefers someone else is dropped,
    this is not a maximum matching)."""
    best_for_a = first_by(df, [a], as_orders(order) + as_orders(a_tie)).select(a, b)
    best_for_b = first_by(df, [b], as_orders(order) + as_orders(b_tie)).select(a, b)
    pairs = best_for_a.join(best_for_b, [a, b], "inner")
    return df.join(pairs, [a, b], "left_semi")


def unique_name_lookup(df: DataFrame, name: str | Column, id_col: str, name_out: str = "name_key",
                       id_out: str = "resolved_id") -> DataFrame:
    """AGG-11 / FLT-7: names that map to exactly one non-null id.  ``min = max``
    is ``count(distinct id) = 1`` without a distinct aggregation, so the
    whole lookup is one partially aggregated shuffle."""
    n = name if isinstance(name, Column) else F.col(name)
    g = (df.select(n.alias(name_out), F.col(id_col).alias("__id"))
         .filter(F.col(name_out).isNotNull())
         .groupBy(name_out).agg(F.min("__id").alias("__lo"), F.max("__id").alias("__hi")))
    return g.filter(F.col("__lo") == F.col("__hi")).select(name_out, F.col("__lo").alias(id_out))


def partition_size(df: DataFrame, keys: Sequence[str], out: str = "partition_rows") -> DataFrame:
    """WIN-8: ``count(*) over (partition by keys)`` as aggregate + join back
    (partial counts before the shuffle; a hot key's rows are split)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return join_aggregated(df, counts, [(k, k) for k in keys], "inner", null_safe=True)


#: One row in so many, taken by a hash of its content, is looked at to find crowded keys.
SAMPLED = 64
#: A crowded key is cut at this many of its sampled rows.
CUTS = 256
#: Rows from about which a key counts as crowded.
CROWD = 1 << 20


def sequence_within(df: DataFrame, keys: Sequence[str], order: Sequence[Order | str | Column],
                    out: str = "position", spread: bool = False, crowd: int = CROWD, unique: bool = False) -> DataFrame:
    """WIN-6/7: ``row_number() over (partition by keys order by order)``, of the
    different rows with ``unique``.

    A plain window, for keys whose rows fit one task (lines of an order,
    placements of an editing).  With ``spread`` a key may be of any size, see
    :func:`sequence_within_cut`.  Give a total order: ties are numbered in an
    arbitrary but fixed order."""
    if spread:
        return sequence_within_cut(df, keys, order, out, crowd, unique=unique)
    df = df.distinct() if unique else df
    w = Window.partitionBy(*keys).orderBy(*[o.sort_col() for o in as_orders(order)])
    return df.withColumn(out, F.row_number().over(w).cast("long"))


def sequence_within_cut(df: DataFrame, keys: Sequence[str], order: Sequence[Order | str | Column],
                        out: str = "position", crowd: int = CROWD, cuts: int = CUTS, unique: bool = False) -> DataFrame:
    """Row numbers within keys of any size, by prefix counts over pieces of a key.

    1. Of the rows whose content hash falls to the sample, each key's are counted
       and thinned to at most ``cuts`` places in the order; keys of about
       ``crowd`` rows or more are crowded, and these places cut them into pieces.
    2. The rows of crowded keys are counted by piece; running sums over a key's
       pieces, at most ``cuts + 1``, say how many rows come before each piece.
    3. Every row is joined with its key's places and sums, numbered within
       (key, piece) and moved on by the sum.  Other keys are one piece.

    Rows are shuffled once, by (key, piece), without the place, which is made again
    behind the shuffle; with ``unique``, repeated rows are dropped there.  The
    crowded keys' places and sums are broadcast: there are at most ``cuts`` places
    for ``crowd`` rows, so they are small whatever the table.

    The sample, the places and the counts depend on the rows' content only, so a
    task that runs again after the loss of an executor gives the same numbers, and
    nothing has to be written before.  Null keys are keys.  Rows that are alike in
    the order are told apart by the content hash; rows alike in every column stay
    in one piece.  Columns of a type without a hash (maps) do not count for it."""
    orders = as_orders(order)
    okey = ascending_key(df, orders)
    if okey is None:
        raise ValueError("an order by descending text cannot be cut; number it with spread=False")
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()
             and f.dataType.typeName() != "variant"]
    h = F.xxhash64(*plain)
    place = F.struct(okey.alias("o"), h.alias("h"))
    at = df.select(*keys, place.alias("__at")).filter(F.pmod("__at.h", F.lit(SAMPLED)) == 0)
    sampled = ((at.distinct() if unique else at).groupBy(*keys, F.pmod(F.shiftright("__at.h", 8), F.lit(cuts)).alias("__slot"))
               .agg(F.count(F.lit(1)).alias("__n"), F.min_by("__at", "__at.h").alias("__at")))
    crowded = (sampled.groupBy(*keys).agg(F.sum("__n").alias("__n"), F.array_sort(F.collect_list("__at")).alias("__cuts"))
               .filter(F.col("__n") >= max(crowd // SAMPLED, 1)).drop("__n"))

    def with_piece(rows: DataFrame, known: DataFrame, how: str) -> DataFrame:
        right = known.select(*[F.col(f"`{k}`").alias(f"__on{i}") for i, k in enumerate(keys)],
                             *[c for c in known.columns if c not in keys])
        same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"__on{i}")) for i, k in enumerate(keys)])
        n = F.size(F.filter("__cuts", lambda c: c < place))
        return (rows.join(F.broadcast(right), same, how).withColumn("__piece", F.coalesce(n, F.lit(0)))
                .drop("__cuts", *[f"__on{i}" for i in range(len(keys))]))
    pieces = with_piece(df, crowded, "inner")
    counts = (pieces.distinct() if unique else pieces).groupBy(*keys, "__piece").agg(F.count(F.lit(1)).alias("__n"))
    sums = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1))
    before = (counts.withColumn("__n", F.coalesce(sums, F.lit(0)))
              .groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__piece", "__n"))).alias("__before")))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    cut = crowded.alias("a").join(before.alias("b"), reduce(and_, same)).select(*[f"a.{k}" for k in keys], "__cuts", "__before")
    rows = with_piece(df, cut, "left")
    rows = rows.withColumn("__before", F.coalesce(F.try_element_at("__before", F.col("__piece")), F.lit(0)))
    rows = rows.repartition(*keys, "__piece")
    rows = (rows.distinct() if unique else rows).withColumn("__at", place)
    w = Window.partitionBy(*keys, "__piece").orderBy("__at")
    return (rows.withColumn(out, (F.row_number().over(w) + F.col("__before")).cast("long"))
            .drop("__at", "__piece", "__before"))


def distinct_by_group(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-10: GROUP BY with no aggregate."""
    return df.select(*keys).distinct()
