"""How often rows are shuffled, and that it changes no result."""

import re

from pyspark.sql import functions as F

from lakeward.models import gold
from lakeward.operators.dedup import sequence_within
from lakeward.operators.ordering import asc


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)


def test_numbering_of_unique_rows(spark):
    """Repeated rows are dropped and numbered as without cutting; null keys are keys."""
    rows = spark.range(6000).select(F.expr("CASE WHEN id % 7 = 0 THEN NULL ELSE id % 3 END").alias("k"), (F.col("id") % 500).alias("o"),
                                    (F.col("id") % 1500).cast("string").alias("t"))
    plain = sequence_within(rows.distinct(), ["k"], [asc("o"), asc("t")], out="n")
    for crowd in (64, 1 << 20):
        cut = sequence_within(rows, ["k"], [asc("o"), asc("t")], out="n", spread=True, crowd=crowd, unique=True)
        assert sorted(map(repr, cut.collect())) == sorted(map(repr, plain.collect()))
    assert sequence_within(rows, ["k"], [asc("o"), asc("t")], out="n", unique=True).count() == plain.count() < rows.count()


def test_numbering_shuffles_whole_rows_once(spark):
    """Only the shuffle by key and piece carries all rows; sampled rows and crowded keys have their own."""
    rows = spark.range(1000).select((F.col("id") % 5).alias("k"), F.col("id").alias("o"))
    cut = sequence_within(rows, ["k"], [asc("o")], out="n", spread=True, unique=True)
    by = exchanges(cut)
    assert sum("__piece" in x and x.startswith("k") and "__at" not in x for x in by) >= 1
    assert not any("xxhash64" in x or "__on" in x for x in by)


def test_amounts_in_parts(spark):
    """Sums of parts times counts are the sums of the amounts, also of large and negative ones."""
    amounts = ["0.000001", "-0.000001", "123456789012345678901234.654321", "-999999999.999999", "1000000000", "-1000000000.5", None, "0"]
    rows = spark.createDataFrame([(i % 2, a, i + 1) for i, a in enumerate(amounts * 3)], "g int, a string, n long")
    rows = rows.withColumn("a", F.col("a").cast("decimal(38,6)"))
    want = rows.groupBy("g").agg(F.sum(F.col("a") * F.col("n")).cast("decimal(38,6)").alias("a")).orderBy("g").collect()
    parts = rows.select("g", "n", *gold._parts("a")).groupBy("g").agg(*gold._part_sums("a", F.col("n")))
    assert parts.select("g", gold._whole("a").alias("a")).orderBy("g").collect() == want
    none = rows.where("a is null").select("g", "n", *gold._parts("a")).groupBy("g").agg(*gold._part_sums("a", F.col("n")))
    assert none.select(gold._whole("a").alias("a")).first()["a"] is None


def test_items_without_a_code_are_split(spark):
    """The items' rows meet what is aggregated by code or ISRC by one more column, so that the runtime can split them."""
    from lakeward.plans.production import flow_context
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by = exchanges(flow_context(spark, "/root/testdata/sf0.001").ref("fact_hao_hut"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for key in ("own_hg", "released_isrc"):
        mine = [x for x in by if re.search(rf"\b{key}#", x) and len(x.split(", ")) <= 2]
        assert mine and all(len(x.split(", ")) > 1 for x in mine)


def test_months_of_a_video_travel_as_one_row(spark):
    """Packed months give back their amounts, also large, negative and missing ones; a key without months has a row without one."""
    amounts = ["0.000001", "-0.000001", "123456789012345678901234.654321", "-999999999.999999", "1000000", "-1000000.5", None, "0", "999999.999999"]
    rows = spark.createDataFrame([(f"v{i % 4}", i, a, i % 3 == 0) for i, a in enumerate(amounts * 2)], "v string, month int, a string, has_a boolean")
    rows = rows.withColumn("a", F.col("a").cast("decimal(38,6)"))
    packed = gold._packed(rows.select("v", "month", *gold._parts("a"), "has_a"), "v", ["a"], ["has_a"])
    assert packed.count() == 4
    packed = packed.unionByName(spark.createDataFrame([("w",)], "v string"), allowMissingColumns=True)
    got = gold._unpacked(packed, ["v"], ["a"], ["has_a"]).groupBy("v", "month", "has_a").agg(*gold._part_sums("a", F.lit(1)))
    got = got.select("v", "month", gold._whole("a").alias("a"), "has_a").collect()
    want = [*rows.collect(), ("w", None, None, None)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


def test_team_usage_does_not_deal_months_of_stocks(spark):
    """A video's months go to its stocks and on to the teams, without a shuffle of every stock's months by stock and month."""
    from lakeward.plans.warehouse import driver_context
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by = exchanges(driver_context(spark, "/root/testdata/sf0.001").ref("mart_team_usage"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert any(re.fullmatch(r"hg_stock_id#\d+", x) for x in by)
    assert not any(re.fullmatch(r"hg_stock_id#\d+, month#\d+", x) for x in by)
