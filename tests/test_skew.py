"""Joins whose plan lets the runtime split a hot key (Parquet input, low thresholds, no broadcast)."""

import re

import pytest
from pyspark.sql import functions as F

from lakeward.operators.dedup import partition_size, sequence_within
from lakeward.operators.joins import exclude_keys, exists, join_aggregated, list_lookup_agg, not_exists
from lakeward.sources.grid import grid_to_table
from lakeward.sources.store import merge_by_key

CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def low(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("verb", ["exists", "not_exists", "exclude_keys", "merge_by_key"])
def test_a_hot_key_is_split(low, workdir, verb):
    spark = low
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("v"))
    rows.repartition(8).write.parquet(f"{workdir}/rows")
    spark.range(0, 60_000, 5).select(F.col("id").alias("k"), F.lit("x").alias("v")).repartition(4).write.parquet(f"{workdir}/keys")
    left, right = spark.read.parquet(f"{workdir}/rows"), spark.read.parquet(f"{workdir}/keys")
    if verb == "merge_by_key":
        out = merge_by_key(left, right, ["k"])
    elif verb == "exclude_keys":
        out = exclude_keys(left, right, "k", "k")
    else:
        out = (exists if verb == "exists" else not_exists)(left, right, ["k"])
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"skew=true", plan), plan[:3000]


@pytest.mark.parametrize("verb", ["partition_size", "list_lookup_agg", "grid_to_table"])
def test_rows_of_a_hot_key_are_split_against_an_aggregate(low, workdir, verb):
    spark = low
    k = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 4000)
    rows = spark.range(60_000).select("id", k.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    if verb == "list_lookup_agg":
        rows = rows.select("id", F.concat_ws(",", k, k + 1).alias("list"), "v")
    elif verb == "grid_to_table":
        first = spark.range(4000).select("id", F.array(F.lit("A"), F.lit(" Name ")).alias("cells"))
        rows = rows.select(k.alias("file"), (F.col("id") + 1).alias("row_no"), F.array("v", F.col("id").cast("string")).alias("cells"))
        rows = rows.unionByName(first.select(F.col("id").alias("file"), F.lit(0).cast("long").alias("row_no"), "cells"))
    rows.repartition(8).write.parquet(f"{workdir}/rows")
    rows = spark.read.parquet(f"{workdir}/rows")
    if verb == "partition_size":
        out, want = partition_size(rows, ["k"]), 60_000
    elif verb == "list_lookup_agg":
        names = spark.range(4100).select("id", F.concat(F.lit("n"), "id").alias("name"))
        out, want = list_lookup_agg(rows, "id", "list", names, "id", "name", "names"), 60_000
    else:
        out, want = grid_to_table(rows, ["name", "a"], header_key="NAME"), 60_000
    assert len(out.collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"skew=true", plan), plan[:3000]


def test_join_with_an_aggregate_keeps_nulls_types_and_ties(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (1, "a")], "k int, v string")
    agg = spark.createDataFrame([(1, 10), (None, 20), (3, 30)], "key bigint, n int")
    got = lambda **kw: sorted(map(str, (tuple(r) for r in join_aggregated(left, agg, [("k", "key")], **kw).collect())))
    assert got() == sorted(map(str, [(1, "a", 10), (1, "a", 10), (None, "b", None), (2, "c", None)]))
    assert got(null_safe=True, how="inner") == sorted(map(str, [(1, "a", 10), (1, "a", 10), (None, "b", 20)]))
    assert join_aggregated(left, agg.limit(0), [("k", "key")], "inner").count() == 0


def test_numbering_cuts_a_hot_key(low, workdir):
    """A key with a third of all rows: no task of the numbering has more than twice the rows of the median task."""
    spark = low
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id",
                                      F.sha2(F.col("id").cast("string"), 256).alias("v"))
    rows.repartition(8).write.parquet(f"{workdir}/rows")
    rows = spark.read.parquet(f"{workdir}/rows")
    out = sequence_within(rows, ["k"], ["id"], spread=True, crowd=4096)
    per_task = out.groupBy(F.spark_partition_id()).agg(F.count("position").alias("n"), F.sum("position").alias("s"))
    tasks = [r.n for r in per_task.collect()]
    assert sum(tasks) == 60_000 and max(tasks) <= 2 * sorted(tasks)[len(tasks) // 2], tasks
    hot = sorted((r.id, r.position) for r in out.filter("k = 7").select("id", "position").collect())
    assert [p for _, p in hot] == list(range(1, 20_002))
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "__piece" in plan
