"""Allocation verbs: positional weights and even split over a calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.dates import month_start
from lakeward.operators.dedup import partition_size, sequence_within
from lakeward.operators.ordering import Order

# The ten-point positional weights used to split one parent
# amount over its first five children, by number of children n
# (n = 1: 10; n = 2: 5, 5; n = 3: 6, 3, 1; n = 4: 6, 2, 1, 1;
#  n >= 5: 5, 2, 1, 1, 1; positions after the fifth get nothing).
POSITION_WEIGHTS = {1: (10,), 2: (5, 5), 3: (6, 3, 1), 4: (6, 2, 1, 1), 5: (5, 2, 1, 1, 1)}
WEIGHT_TOTAL = 10


def position_weight(n: Column, pos: Column) -> Column:
    """Weight of child ``pos`` among ``n`` children; null beyond position 5."""
    table = F.array(*[F.array(*[F.lit(w) for w in POSITION_WEIGHTS[k]])
                      for k in sorted(POSITION_WEIGHTS)])
    row = F.try_element_at(table, F.least(n, F.lit(max(POSITION_WEIGHTS))).cast("int"))
    return F.try_element_at(row, pos.cast("int"))


def allocate_by_weight(children: DataFrame, parent_keys: Sequence[str], order: Sequence[Order | str],
                       parents: DataFrame, amount: str, out: str = "allocated",
                       amount_type: str = "decimal(18,2)", out_type: str = "decimal(21,3)") -> DataFrame:
    """Split each parent's ``amount`` over its children by POSITION_WEIGHTS.

    Children are numbered within their parent (a plain window: a parent's children
    fit one task), counted (partial aggregate), joined to the parent amount and weighted; the
    weights of the first min(n, 5) positions sum to 10, so allocation keeps
    each parent total exactly."""
    pos = sequence_within(children, parent_keys, order, out="position")
    sized = partition_size(pos, parent_keys, out="n_children")
    w = position_weight(F.col("n_children"), F.col("position"))
    weighted = sized.withColumn("weight", w).filter(F.col("weight").isNotNull())
    p = parents.select(*parent_keys, F.col(amount).cast(amount_type).alias("__amt"))
    out_df = weighted.join(p, list(parent_keys), "inner")
    alloc = (F.col("__amt") * F.col("weight") / F.lit(WEIGHT_TOTAL)).cast(out_type)
    return out_df.withColumn(out, alloc).drop("__amt")


def month_calendar(starts: DataFrame, start_col: str, end: Column, out: str = "month") -> DataFrame:
    """JN-12/13, GEN-6: one row per (input row, month) from the row's start
    month through ``end`` (inclusive), generated per row with
    ``explode(sequence(...))`` - no cross join; a start after the end has no month; a null start means active
    from ``calendar_start`` (column ``__cal_start`` on the input)."""
    s = month_start(F.col(start_col))
    e = month_start(end)
    return starts.filter(s <= e).withColumn(out, F.explode(F.sequence(s, e, F.expr("interval 1 month"))))


def allocate_evenly_over_calendar(resources: DataFrame, group_keys: Sequence[str], resource_key: str,
                                  start_col: str, costs: DataFrame, cost_col: str,
                                  calendar_start: Column, calendar_end: Column,
                                  month: str = "month", out: str = "allocated") -> DataFrame:
    """Divide each (group, month) cost evenly over the group's resources that
    are active that month (active from their start month on; a null start is
    active from ``calendar_start``).

    ``costs`` holds (group_keys..., month, cost_col).  Output: one row per
    active (resource, month) with a cost, with ``active_resources`` and the
    share as double."""
    r = resources.select(*group_keys, resource_key,
                         F.coalesce(F.col(start_col).cast("date"), calendar_start.cast("date")).alias("__start"))
    active = month_calendar(r, "__start", calendar_end, out=month).drop("__start")
    counts = active.groupBy(*group_keys, month).agg(F.count(F.lit(1)).alias("active_resources"))
    shares = (costs.join(counts, [*group_keys, month], "inner")
              .withColumn(out, F.col(cost_col).cast("double") / F.col("active_resources")))
    return active.join(shares, [*group_keys, month], "inner")
