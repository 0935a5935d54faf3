"""Layer reconciliation (REC-1, REC-2).

Each layer is reduced to one row of metrics (rows, exact decimal total) by one
aggregate.  Checks are rows ``(check_name, actual, expected, success)``; the
only joins of metrics are equi joins between small frames on the metric name.

Key sets are compared by digests: every layer's distinct keys are dealt to key
ranges by the first digits of their MD5, and a range is one row a layer, its
number of keys and the xor of their hashes.  Only the keys of ranges that differ
are looked at one by one, so layers that agree cost one aggregate each and no
join, and a difference says where it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decimal_sum(c: Column | str, scale: int = 2) -> Column:
    """REC-2: exact total (no floating point)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.sum(x.cast(f"decimal(18,{scale})")).cast(f"decimal(38,{scale})")


def layer_metrics(name: str, df: DataFrame, amount: str | None, count_col: str | None = None) -> DataFrame:
    """Long-format metrics of one layer: (layer, metric, value text)."""
    rows = F.sum(F.col(count_col)).cast("long") if count_col else F.count(F.lit(1))
    m = [F.struct(F.lit("rows").alias("metric"), rows.cast("string").alias("value"))]
    if amount:
        m.append(F.struct(F.lit("amount").alias("metric"), decimal_sum(amount).cast("string").alias("value")))
    return df.agg(F.array(*m).alias("__m")).select(F.lit(name).alias("layer"), F.inline("__m"))


def key_gap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Number of keys present on exactly one side (0 = equal key sets); nulls are no keys."""
    sides = (a.select(F.col(key).alias("k"), F.lit(1).alias("side"))
             .unionByName(b.select(F.col(key).alias("k"), F.lit(2).alias("side"))).filter(F.col("k").isNotNull()))
    one = sides.groupBy("k").agg(F.bit_or("side").alias("sides")).filter(F.col("sides") != 3)
    return one.agg(F.count(F.lit(1)).alias("n"))


def reconcile(metrics: DataFrame, checks: Sequence[tuple[str, str, str, str]],
              key_checks: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """REC-1: ``checks`` = (check_name, metric, actual_layer, expected_layer);
    ``key_checks`` = check_name -> key_gap frame (expected 0)."""
    spec = metrics.sparkSession.createDataFrame(list(checks), "check_name string, metric string, a string, e string")
    act = metrics.select(F.col("layer").alias("a"), "metric", F.col("value").alias("actual"))
    exp = metrics.select(F.col("layer").alias("e"), "metric", F.col("value").alias("expected"))
    out = (spec.join(act, ["a", "metric"], "left").join(exp, ["e", "metric"], "left")
           .select("check_name", "actual", "expected",
                   F.coalesce(F.col("actual") == F.col("expected"), F.lit(False)).alias("success")))
    for name, gap in (key_checks or {}).items():
        out = out.unionByName(gap.select(F.lit(name).alias("check_name"), F.col("n").cast("string").alias("actual"),
                                         F.lit("0").alias("expected"), (F.col("n") == 0).alias("success")))
    return out


#: Hexadecimal digits of a key's MD5 that name its range: 4,096 ranges.
RANGE_DIGITS = 3


def layer_keys(layer: str, df: DataFrame, key: str | Column) -> DataFrame:
    """Keys of one layer as (layer, key): trimmed text, nulls left out."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    return df.select(F.lit(layer).alias("layer"), F.trim(k).alias("key")).filter(F.col("key").isNotNull())


def _range(digits: int) -> Column:
    return F.substring(F.md5(F.col("key")), 1, digits)


def key_digests(keys: DataFrame, digits: int = RANGE_DIGITS) -> DataFrame:
    """(layer, key_range, n_keys, digest) of rows (layer, key): per layer and
    range the number of distinct keys and the xor of 60 bits of their hashes.  At
    most ``16 ** digits`` rows a layer; repeated keys are dropped before."""
    bits = F.conv(F.substring(F.md5(F.col("key")), 17, 15), 16, 10).cast("long")
    return (keys.distinct().groupBy("layer", _range(digits).alias("key_range"))
            .agg(F.count(F.lit(1)).alias("n_keys"), F.bit_xor(bits).alias("digest")))


def _sides(spark, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    rows = [(name, layer, side) for name, a, e in checks for layer, side in ((a, 1), (e, 2))]
    return spark.createDataFrame(rows, "check_name string, layer string, side int")


def differing_ranges(digests: DataFrame, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(check_name, key_range) whose digests or counts are unlike; ``checks`` =
    (check_name, actual layer, expected layer)."""
    sign = F.when(F.col("side") == 1, F.col("n_keys")).otherwise(-F.col("n_keys"))
    return (digests.join(F.broadcast(_sides(digests.sparkSession, checks)), "layer")
            .groupBy("check_name", "key_range").agg(F.sum(sign).alias("n"), F.bit_xor("digest").alias("x"))
            .filter((F.col("n") != 0) | (F.col("x") != 0)).select("check_name", "key_range"))


def key_differences(keys: DataFrame, checks: Sequence[tuple[str, str, str]], digits: int = RANGE_DIGITS,
                    ranges: DataFrame | None = None) -> DataFrame:
    """(check_name, key_range, n_missing, n_extra) for each range in which the
    key sets of two layers differ: keys the actual layer lacks, and keys only it
    has.  No rows if all sets are equal, also of empty layers.

    ``checks`` are bounded by hand and the ranges by ``16 ** digits`` a check, so
    both are broadcast; of the keys, those of differing ranges are shuffled again."""
    unlike = differing_ranges(key_digests(keys, digits), checks) if ranges is None else ranges
    of = (keys.withColumn("key_range", _range(digits))
          .join(F.broadcast(_sides(keys.sparkSession, checks)), "layer")
          .join(F.broadcast(unlike), ["check_name", "key_range"], "left_semi"))
    one = of.groupBy("check_name", "key_range", "key").agg(F.bit_or("side").alias("sides")).filter(F.col("sides") != 3)
    return one.groupBy("check_name", "key_range").agg(F.count_if(F.col("sides") == 2).alias("n_missing"),
                                                      F.count_if(F.col("sides") == 1).alias("n_extra"))


#: REC-1: (check, what is compared, actual layer, expected layer), from the ledger to the mart.
BATCH_CHECKS = [
    ("bronze_rows_of_ledger", "rows", "bronze", "ledger"),
    ("staged_batch_rows", "rows", "staging_batch", "bronze"),
    ("silver_batch_rows", "rows", "silver_batch", "staging_batch"),
    ("staged_batch_keys", "keys", "staging_batch", "bronze"),
    ("silver_batch_keys", "keys", "silver_batch", "staging_batch"),
    ("staged_batch_amount", "amount", "staging_batch", "bronze"),
    ("silver_batch_amount", "amount", "silver_batch", "staging_batch"),
    ("staged_rows", "rows", "staging", "source"),
    ("silver_rows", "rows", "silver", "staging"),
    ("gold_rows", "rows", "gold", "silver"),
    ("staged_keys", "keys", "staging", "source"),
    ("silver_keys", "keys", "silver", "staging"),
    ("staged_amount", "amount", "staging", "source"),
    ("silver_amount", "amount", "silver", "staging"),
    ("gold_amount", "amount", "gold", "silver"),
]
KEY_CHECKS = [(name, a, e) for name, kind, a, e in BATCH_CHECKS if kind == "keys"]


def newest_batch(staging: DataFrame, batch: str = "_batch_id", loaded_at: str = "_loaded_at") -> DataFrame:
    """One row, the batch staged last (of batches loaded at once, the larger id)."""
    return staging.agg(F.max(F.struct(F.col(loaded_at), F.col(batch))).alias("b")).select(F.col(f"b.{batch}").alias(batch))


def batch_layers(source: DataFrame, bronze: DataFrame, staging: DataFrame, silver: DataFrame,
                 batch: str = "_batch_id", loaded_at: str = "_loaded_at") -> dict[str, DataFrame]:
    """The layers with keys: the source and its snapshots, and of bronze, staging
    and silver what belongs to the newest staged batch."""
    now = newest_batch(staging, batch, loaded_at).scalar()
    of = lambda df: df.filter(F.col(batch) == now)
    return {"source": source, "bronze": of(bronze), "staging": staging, "staging_batch": of(staging),
            "silver": silver, "silver_batch": of(silver)}


def reconcile_batch(events: DataFrame, source_id: str, layers: Mapping[str, DataFrame], gold: DataFrame, key: str,
                    amount: str, gold_rows: str, gold_amount: str, batch: str = "_batch_id",
                    loaded_at: str = "_loaded_at") -> DataFrame:
    """REC-1: the newest batch and the whole snapshot followed from the ledger
    through bronze, staging and silver to gold: (check_name, actual, expected,
    success) for each of :data:`BATCH_CHECKS`.

    ``layers`` come from :func:`batch_layers`; ``events`` is the ledger.  Row
    and amount checks show both values, key checks the number of keys on one side
    only, expected 0.  A batch that the ledger does not know as loaded has no row
    count there (null) and fails; an amount over no rows is 0."""
    spark = events.sparkSession
    now = newest_batch(layers["staging"], batch, loaded_at).scalar()
    known = (events.filter((F.col("source_id") == source_id) & (F.col("batch_id") == now))
             .agg(F.max_by(F.struct("status", "row_count"), F.col("event_at")).alias("e")))
    metrics = [known.select(F.lit("ledger").alias("layer"), F.lit("rows").alias("metric"),
                            F.when(F.col("e.status") == "loaded", F.col("e.row_count")).cast("string").alias("value"))]
    metrics += [layer_metrics(name, df, amount) for name, df in layers.items()]
    metrics.append(layer_metrics("gold", gold, gold_amount, count_col=gold_rows))
    metrics = reduce(DataFrame.unionByName, metrics)
    zero = F.when(F.col("metric") == "amount", F.lit("0.00")).when(F.col("layer") != "ledger", F.lit("0"))
    metrics = metrics.withColumn("value", F.coalesce("value", zero))
    values = reconcile(metrics, [(name, kind, a, e) for name, kind, a, e in BATCH_CHECKS if kind != "keys"])
    keys = reduce(DataFrame.unionByName, [layer_keys(name, df, key) for name, df in layers.items()])
    gaps = key_differences(keys, KEY_CHECKS).groupBy("check_name").agg(F.sum(F.col("n_missing") + F.col("n_extra")).alias("n"))
    names = spark.createDataFrame([(name,) for name, _, _ in KEY_CHECKS], "check_name string")
    n = F.coalesce(F.col("n"), F.lit(0))
    return values.unionByName(names.join(gaps, "check_name", "left")
                              .select("check_name", n.cast("string").alias("actual"), F.lit("0").alias("expected"), (n == 0).alias("success")))
