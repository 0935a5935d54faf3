"""Dedup, ranking and allocation queries (WIN-*, AGG-1, allocation)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.dates import month_start
from lakeward.operators.allocate import allocate_by_weight
from lakeward.operators.dedup import (first_by, latest_by, mutual_best_match, partition_size,
                                      sequence_within)
from lakeward.operators.marts import daily_totals, growth_vs_previous, latest_growth, sales_fact
from lakeward.operators.ordering import asc, desc
from lakeward.plans.registry import query
from lakeward.plans.tables import Tables

# Load times stamped on the two staged copies of the events table.
STALE_LOAD = dt.datetime(2024, 2, 1)
FRESH_LOAD = dt.datetime(2024, 2, 2)

# Total order of lineitem rows inside one order (ties are identical rows).
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_ORDER_SQL = ", ".join(LINE_ORDER)


def staged_sales(t: Tables) -> DataFrame:
    """Events landed twice as text staging: a stale copy (earlier load, other
    amount) and the fresh copy; the fact must keep the fresh one."""
    ev = t.events

    def copy(value, loaded, batch):
        return ev.select(F.col("event_id").cast("string").alias("sale_id"),
                         value.cast("string").alias("amount"),
                         F.date_format("ts", "yyyy-MM-dd").alias("sale_date"),
                         F.lit(loaded).alias("_loaded_at"), F.lit(batch).alias("_batch_id"))

    return copy(F.col("value") + F.lit(1.0), STALE_LOAD, "events_b1").unionByName(
        copy(F.col("value"), FRESH_LOAD, "events_b2"))


@query("daily_sales_mart", "PRJ-1/2, WIN-1, AGG-1", sql="""
WITH staged AS (
  SELECT CAST(event_id AS VARCHAR) AS sale_id, value AS amount, CAST(ts AS DATE) AS sale_date,
         TIMESTAMP '2024-02-02 00:00:00' AS loaded_at FROM events
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), value + 1.0, CAST(ts AS DATE),
         TIMESTAMP '2024-02-01 00:00:00' FROM events
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY loaded_at DESC) AS rn FROM staged
)
SELECT sale_date, CAST(count(*) AS BIGINT) AS order_count,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_amount
FROM ranked WHERE rn = 1 GROUP BY sale_date
""")
def daily_sales_mart(spark: SparkSession, sf: str) -> DataFrame:
    return daily_totals(sales_fact(staged_sales(Tables(spark, sf))))


@query("latest_by", "WIN-1", sql="""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS last_order_date, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
""")
def q_latest_by(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    best = latest_by(o, ["o_custkey"], "o_orderdate", tie_break=[desc("o_orderkey")])
    return best.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("last_order_date"),
                       "o_totalprice")


@query("pick_first_priority", "WIN-2/3, SRT-4", sql=f"""
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS ship_date
FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
        ORDER BY (l_returnflag = 'R') DESC NULLS LAST, l_shipdate DESC NULLS LAST, l_orderkey, {LINE_ORDER_SQL}) AS rn
      FROM lineitem) WHERE rn = 1
""")
def pick_first_priority(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    best = first_by(li, ["l_partkey"],
                    [desc(F.col("l_returnflag") == F.lit("R"), nulls_last=True),
                     desc("l_shipdate", nulls_last=True), asc("l_orderkey")] + [asc(c) for c in LINE_ORDER])
    return best.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag",
                       F.col("l_shipdate").cast("date").alias("ship_date"))


def part_supplier_qty(t: Tables) -> DataFrame:
    return (t.lineitem.groupBy("l_partkey", "l_suppkey")
            .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_qty")))


@query("mutual_best_match", "WIN-5, AGG-12", sql="""
WITH q AS (SELECT l_partkey, l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_qty
           FROM lineitem GROUP BY l_partkey, l_suppkey),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY total_qty DESC, l_suppkey) AS ra,
               row_number() OVER (PARTITION BY l_suppkey ORDER BY total_qty DESC, l_partkey) AS rb FROM q)
SELECT l_partkey, l_suppkey, total_qty FROM r WHERE ra = 1 AND rb = 1
""")
def q_mutual_best_match(spark: SparkSession, sf: str) -> DataFrame:
    q = part_supplier_qty(Tables(spark, sf))
    return mutual_best_match(q, "l_partkey", "l_suppkey", [desc("total_qty")],
                             a_tie=[asc("l_suppkey")], b_tie=[asc("l_partkey")])


@query("position_in_parent", "WIN-6/7", sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS BIGINT) AS position
FROM lineitem
""")
def position_in_parent(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    pos = sequence_within(li, ["l_orderkey"], [asc(c) for c in LINE_ORDER])
    return pos.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                      "l_extendedprice", "position")


@query("partition_size", "WIN-8", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(count(*) OVER (PARTITION BY l_orderkey) AS BIGINT) AS lines_in_order
FROM lineitem
""")
def q_partition_size(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return partition_size(li, ["l_orderkey"], out="lines_in_order")


def segment_month_revenue(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return (o.join(c, "o_custkey")
            .groupBy("c_mktsegment", month_start("o_orderdate").alias("month"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("revenue")))


def _segment_growth(t: Tables) -> DataFrame:
    g = growth_vs_previous(segment_month_revenue(t), ["c_mktsegment"], "month", "revenue",
                           prev_out="prev_revenue", growth_out="growth")
    return g.withColumn("growth", F.round("growth", 6))


GROWTH_SQL = """
WITH m AS (SELECT c_mktsegment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
g AS (SELECT c_mktsegment, month, revenue,
             lag(revenue) OVER (PARTITION BY c_mktsegment ORDER BY month) AS prev_revenue FROM m)
SELECT c_mktsegment, month, revenue, prev_revenue,
       CASE WHEN prev_revenue IS NULL OR prev_revenue = 0 THEN NULL
            ELSE round((CAST(revenue AS DOUBLE) - CAST(prev_revenue AS DOUBLE)) / CAST(prev_revenue AS DOUBLE), 6)
       END AS growth
FROM g"""


@query("growth_vs_previous", "WIN-9, PRJ-18", sql=GROWTH_SQL)
def q_growth(spark: SparkSession, sf: str) -> DataFrame:
    return _segment_growth(Tables(spark, sf))


@query("latest_growth", "WIN-10", sql=f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY month DESC) AS rn
               FROM ({GROWTH_SQL})) WHERE rn = 1
""".replace("SELECT * FROM (SELECT *, row_number()", "SELECT c_mktsegment, month, revenue, prev_revenue, growth FROM (SELECT *, row_number()"))
def q_latest_growth(spark: SparkSession, sf: str) -> DataFrame:
    return latest_growth(_segment_growth(Tables(spark, sf)), ["c_mktsegment"], "month")


@query("allocate_by_weight", "WIN-6/8, JN-14, position weights", sql=f"""
WITH p AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS position,
         count(*) OVER (PARTITION BY l_orderkey) AS n_children
  FROM lineitem),
w AS (
  SELECT *, CASE
      WHEN n_children = 1 THEN CASE position WHEN 1 THEN 10 END
      WHEN n_children = 2 THEN CASE position WHEN 1 THEN 5 WHEN 2 THEN 5 END
      WHEN n_children = 3 THEN CASE position WHEN 1 THEN 6 WHEN 2 THEN 3 WHEN 3 THEN 1 END
      WHEN n_children = 4 THEN CASE position WHEN 1 THEN 6 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 1 END
      ELSE CASE position WHEN 1 THEN 5 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN 1 END
    END AS weight
  FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(position AS BIGINT) AS position,
       CAST(n_children AS BIGINT) AS n_children, CAST(weight AS INTEGER) AS weight,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * weight / 10 AS DECIMAL(21,3)) AS allocated
FROM w JOIN orders ON o_orderkey = l_orderkey
WHERE weight IS NOT NULL
""")
def q_allocate_by_weight(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    parents = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    out = allocate_by_weight(t.lineitem, ["l_orderkey"], [asc(c) for c in LINE_ORDER], parents,
                             "o_totalprice")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "position", "n_children",
                      "weight", "allocated")
