import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeward.operators.dedup import (first_by, latest_by, mutual_best_match, partition_size, sequence_within,
                                      sequence_within_cut, top1_value, unique_name_lookup)
from lakeward.operators.ordering import asc, desc, numeric_first


def test_latest_by_desc_puts_nulls_first_like_postgres(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", None, "b"), ("k", 3, "c"), ("j", 2, "d")],
                               "key string, ts int, v string")
    got = {r.key: r.v for r in latest_by(df, ["key"], "ts").collect()}
    assert got == {"k": "b", "j": "d"}
    got = {r.key: r.v for r in first_by(df, ["key"], [desc("ts", nulls_last=True)]).collect()}
    assert got == {"k": "c", "j": "d"}


def test_first_by_ties_broken_and_null_partition_key(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 1, "a"), ("k", 5, "z"), ("k", 5, "b")],
                               "key string, o int, v string")
    got = {r.key: r.v for r in first_by(df, ["key"], [asc("o"), asc("v")]).collect()}
    assert got == {None: "a", "k": "b"}


def test_one_row_a_key_leaves_a_task(spark, workdir):
    """The plan keeps one row per key before the shuffle, and has no sort aggregate."""
    spark.range(1000).select((F.col("id") % 3).alias("k"), "id", F.lit("x").alias("v")).write.parquet(f"{workdir}/t")
    df = spark.read.parquet(f"{workdir}/t")
    for out in (first_by(df, ["k"], [desc("id")]), top1_value(df, ["k"], "v", [asc("id")], "first")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit"), plan
        assert "Partial" in plan and "SortAggregate" not in plan
        assert out.count() == 3
    assert top1_value(df, ["k"], F.col("id") + 1, [desc(F.col("id") % 10), asc("v"), desc("id")], "top").columns == ["k", "top"]


def test_descending_text(spark):
    df = spark.createDataFrame([("k", "a"), ("k", "c"), ("k", "b")], "key string, v string")
    assert first_by(df, ["key"], [desc("v")]).collect()[0].v == "c"


def test_numeric_first_id_preference(spark):
    df = spark.createDataFrame([("n", "abc"), ("n", "10"), ("n", "9"), ("n", "0x1")], "name string, id string")
    assert first_by(df, ["name"], numeric_first("id")).collect()[0].id == "9"


def test_sequence_within_matches_window_on_hot_key(spark):
    rnd = random.Random(7)
    rows = [("hot", rnd.randint(0, 10_000), i) for i in range(6000)] + \
           [(f"k{i % 50}", rnd.randint(0, 100), i) for i in range(3000)] + [(None, 1, -1), (None, 0, -2)]
    df = spark.createDataFrame(rows, "key string, o int, id int")
    w = Window.partitionBy("key").orderBy("o", "id")
    want = df.withColumn("position", F.row_number().over(w).cast("long"))
    for crowd in (1, 256, 4096, 1 << 20):
        got = sequence_within(df, ["key"], [asc("o"), asc("id")], spread=True, crowd=crowd)
        assert got.columns == want.columns and got.count() == df.count()
        assert got.exceptAll(want).count() == 0
    got = sequence_within(df, ["key"], [asc("o"), asc("id")])
    assert got.exceptAll(want).count() == 0
    assert sequence_within(df.limit(0), ["key"], ["o"], spread=True).count() == 0


def test_sequence_of_a_cut_key_with_ties_nulls_and_descending_order(spark):
    df = spark.range(4000).select(F.lit(1).alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"),
                                  F.when(F.col("id") % 7 != 0, F.col("id") % 10).alias("o"), "id")
    got = sequence_within_cut(df, ["a", "b"], [desc("o", nulls_last=True)], crowd=1, cuts=8)
    w = Window.partitionBy("a", "b").orderBy(F.col("o").desc_nulls_last(), "position")
    # the numbers are 1 to n, in the order, and the same on a second run
    assert got.withColumn("want", F.row_number().over(w)).filter("want <> position").count() == 0
    assert got.exceptAll(sequence_within_cut(df.repartition(5), ["a", "b"], [desc("o", nulls_last=True)], crowd=1, cuts=8)).count() == 0
    alike = spark.range(300).select(F.lit("k").alias("k"), F.lit(1).alias("o"))
    got = sequence_within_cut(alike, ["k"], ["o"], crowd=1)
    assert sorted(r.position for r in got.collect()) == list(range(1, 301))


def test_partition_size_with_null_keys(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    got = sorted((r.k or "", r.partition_rows) for r in partition_size(df, ["k"]).collect())
    assert got == [("", 2), ("", 2), ("a", 1)]


def test_mutual_best_match_is_greedy(spark):
    df = spark.createDataFrame([(1, "x", 10), (1, "y", 9), (2, "x", 11), (2, "y", 1)], "a int, b string, s int")
    got = sorted((r.a, r.b) for r in mutual_best_match(df, "a", "b", [desc("s")], [asc("b")], [asc("a")]).collect())
    # a=1 prefers x, but x prefers a=2; a=2 prefers x and x prefers 2 -> only (2, x)
    assert got == [(2, "x")]


def test_unique_name_lookup(spark):
    df = spark.createDataFrame([("n1", 1), ("n1", 1), ("n2", 1), ("n2", 2), ("n3", None), (None, 5)],
                               "name string, id int")
    got = sorted((r.name_key, r.resolved_id) for r in unique_name_lookup(df, "name", "id").collect())
    assert got == [("n1", 1)]
