"""Mart-building verbs: daily totals, growth, funnel steps, age bands."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.functions.cleanse import blank_to_null, bucketize
from lakeward.functions.dates import as_date_lit, days_between
from lakeward.operators.dedup import latest_by
from lakeward.operators.ordering import desc


def sales_fact(staged: DataFrame, key: str = "sale_id", amount: str = "amount",
               day: str = "sale_date", loaded_at: str = "_loaded_at",
               extra: Sequence[str] = ()) -> DataFrame:
    """Typed sales fact from text staging: blank -> null, strict casts
    (amount decimal(18,2), date), rows with a null key dropped, latest
    ``_loaded_at`` wins per key (ties: larger batch id)."""
    typed = staged.select(
        blank_to_null(key).alias(key),
        *[blank_to_null(c).alias(c) for c in extra],
        blank_to_null(amount).cast("decimal(18,2)").alias(amount),
        blank_to_null(day).cast("date").alias(day),
        F.col(loaded_at),
        F.col("_batch_id"),
    ).filter(F.col(key).isNotNull())
    return latest_by(typed, [key], loaded_at, tie_break=[desc("_batch_id")])


def daily_totals(fact: DataFrame, day: str = "sale_date", amount: str = "amount",
                 count_out: str = "order_count", sum_out: str = "total_amount") -> DataFrame:
    """AGG-1: rows and exact decimal total per day (partial + final aggregate)."""
    return fact.groupBy(day).agg(F.count(F.lit(1)).alias(count_out),
                                 F.sum(F.col(amount).cast("decimal(38,2)")).cast("decimal(38,2)").alias(sum_out))


def growth_vs_previous(df: DataFrame, keys: Sequence[str], month: str, value: str,
                       prev_out: str = "prev_value", growth_out: str = "growth") -> DataFrame:
    """WIN-9: (cur - prev) / prev against the previous *present* month per key;
    null when there is no previous month or it is 0.  Feed a pre-aggregated
    (keys, month) frame: the window then sees one row per month, so a hot key
    costs at most one calendar's worth of rows."""
    w = Window.partitionBy(*keys).orderBy(F.col(month).asc())
    prev = F.lag(F.col(value)).over(w)
    cur_d, prev_d = F.col(value).cast("double"), F.col(prev_out).cast("double")
    return (df.withColumn(prev_out, prev)
              .withColumn(growth_out, F.when(prev_d.isNull() | (prev_d == 0), F.lit(None).cast("double"))
                          .otherwise((cur_d - prev_d) / prev_d)))


def latest_growth(growth: DataFrame, keys: Sequence[str], month: str) -> DataFrame:
    """WIN-10: the newest month's row per key, after the lag was computed."""
    return latest_by(growth, keys, month)


def funnel_steps(steps: Sequence[tuple[int, str, DataFrame]], item: str,
                 done: str = "is_done") -> DataFrame:
    """SET-1: one row per (step, item) with a done flag, union of all steps.
    Each step frame carries ``item`` and a boolean ``done`` column."""
    out = None
    for no, name, df in steps:
        part = df.select(F.lit(no).alias("step_no"), F.lit(name).alias("step_name"),
                         F.col(item), F.coalesce(F.col(done), F.lit(False)).alias(done))
        out = part if out is None else out.unionByName(part)
    return out


# Age bands in days (inclusive upper bounds) and their labels.
AGE_BOUNDS = (30, 90, 180, 365)
AGE_LABELS = ("0-30", "31-90", "91-180", "181-365", ">365")


def age_bands(df: DataFrame, date_col: str, as_of: dt.date | str, null_label: str = "unknown",
              days_out: str = "age_days", band_out: str = "age_band",
              sort_out: str = "age_band_sort") -> DataFrame:
    """PRJ-10: age in days at ``as_of`` and its band (null date -> ``null_label``)."""
    age = days_between(as_date_lit(as_of), F.col(date_col))
    label, sort = bucketize(age, AGE_BOUNDS, AGE_LABELS, null_label)
    return df.withColumn(days_out, age).withColumn(band_out, label).withColumn(sort_out, sort)
