"""Projection, generator, aggregate and mart queries (PRJ-*, GEN-*, AGG-*,
SET-*, allocation over a calendar)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.cleanse import (WHITESPACE_CLASS, concat_skip_null, currency_heuristic,
                                        json_or_text, ratio, sentinel_to_null)
from lakeward.functions.dates import month_end, month_key, month_start, parse_dmy
from lakeward.functions.keys import SURROGATE_NULL, normalize_text, surrogate_key
from lakeward.operators.allocate import allocate_evenly_over_calendar
from lakeward.operators.dedup import top1_value
from lakeward.operators.generate import key_set_diff, lateral_values, union_distinct, unpivot
from lakeward.operators.marts import age_bands, funnel_steps
from lakeward.operators.ordering import asc, desc
from lakeward.plans.ranking import LINE_ORDER, LINE_ORDER_SQL
from lakeward.plans.registry import query
from lakeward.plans.tables import Tables

AS_OF = dt.date(2001, 9, 1)
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("unpivot_measures", "GEN-4", sql=" UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '{m}' AS measure, {m} AS value FROM lineitem"
    for m in MEASURES))
def unpivot_measures(spark: SparkSession, sf: str) -> DataFrame:
    return unpivot(Tables(spark, sf).lineitem, LINE_IDS, MEASURES, "measure", "value", "double")


def order_quantities(t: Tables) -> DataFrame:
    q = F.col("l_quantity").cast("decimal(18,2)")
    return (t.lineitem.groupBy("l_orderkey")
            .agg(F.sum(q).cast("decimal(38,2)").alias("total_qty"),
                 F.coalesce(F.sum(F.when(F.col("l_linestatus") == "F", q)), F.lit(0))
                 .cast("decimal(38,2)").alias("shipped_qty")))


@query("lateral_status_rows", "GEN-5, AGG-4, FLT-8", sql="""
WITH a AS (SELECT l_orderkey,
                  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_qty,
                  CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_linestatus = 'F'), 0)
                       AS DECIMAL(38,2)) AS shipped_qty
           FROM lineitem GROUP BY l_orderkey)
SELECT * FROM (
  SELECT l_orderkey, 'done' AS status, CAST(least(shipped_qty, total_qty) AS DECIMAL(38,2)) AS quantity FROM a
  UNION ALL
  SELECT l_orderkey, 'not_done', CAST(greatest(total_qty - shipped_qty, 0) AS DECIMAL(38,2)) FROM a)
WHERE coalesce(quantity, 0) <> 0
""")
def lateral_status_rows(spark: SparkSession, sf: str) -> DataFrame:
    a = order_quantities(Tables(spark, sf))
    rows = lateral_values(a, [
        {"status": F.lit("done"), "quantity": F.least("shipped_qty", "total_qty").cast("decimal(38,2)")},
        {"status": F.lit("not_done"),
         "quantity": F.greatest(F.col("total_qty") - F.col("shipped_qty"), F.lit(0)).cast("decimal(38,2)")},
    ])
    return rows.filter(F.coalesce("quantity", F.lit(0)) != 0).select("l_orderkey", "status", "quantity")


@query("funnel_steps", "SET-1, PRJ-15", sql="""
WITH f AS (SELECT l_orderkey, bool_or(l_linestatus = 'F') AS has_shipped, bool_or(l_returnflag = 'R') AS has_return
           FROM lineitem GROUP BY l_orderkey),
o AS (SELECT o_orderkey, o_orderstatus, concat(o_orderpriority, '/', o_orderstatus) AS flow_key,
             coalesce(has_shipped, false) AS has_shipped, coalesce(has_return, false) AS has_return
      FROM orders LEFT JOIN f ON l_orderkey = o_orderkey)
SELECT 1 AS step_no, 'placed_to_finalised' AS step_name, o_orderkey, flow_key, o_orderstatus = 'F' AS is_done FROM o
UNION ALL
SELECT 2, 'finalised_to_shipped', o_orderkey, flow_key, has_shipped FROM o WHERE o_orderstatus = 'F'
UNION ALL
SELECT 3, 'shipped_to_kept', o_orderkey, flow_key, NOT has_return FROM o WHERE has_shipped
""")
def q_funnel_steps(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    flags = (t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
             .agg(F.max(F.col("l_linestatus") == "F").alias("has_shipped"),
                  F.max(F.col("l_returnflag") == "R").alias("has_return")))
    o = (t.orders.select("o_orderkey", "o_orderstatus",
                         concat_skip_null("o_orderpriority", F.lit("/"), "o_orderstatus").alias("flow_key"))
         .join(flags, "o_orderkey", "left")
         .withColumn("has_shipped", F.coalesce("has_shipped", F.lit(False)))
         .withColumn("has_return", F.coalesce("has_return", F.lit(False))))
    steps = [
        (1, "placed_to_finalised", o.withColumn("is_done", F.col("o_orderstatus") == "F")),
        (2, "finalised_to_shipped", o.filter(F.col("o_orderstatus") == "F").withColumn("is_done", F.col("has_shipped"))),
        (3, "shipped_to_kept", o.filter(F.col("has_shipped")).withColumn("is_done", ~F.col("has_return"))),
    ]
    out = funnel_steps([(n, s, df.select("o_orderkey", "flow_key", "is_done")) for n, s, df in steps], "o_orderkey")
    return out.join(o.select("o_orderkey", "flow_key"), "o_orderkey") \
              .select("step_no", "step_name", "o_orderkey", "flow_key", "is_done")


@query("age_bands", "PRJ-10, JN-2", sql="""
WITH l AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_order_date FROM orders GROUP BY 1),
a AS (SELECT c_custkey, last_order_date, CAST(DATE '2001-09-01' - last_order_date AS INTEGER) AS age_days
      FROM customer LEFT JOIN l ON o_custkey = c_custkey)
SELECT c_custkey, last_order_date, age_days,
       CASE WHEN age_days IS NULL THEN 'unknown' WHEN age_days <= 30 THEN '0-30' WHEN age_days <= 90 THEN '31-90'
            WHEN age_days <= 180 THEN '91-180' WHEN age_days <= 365 THEN '181-365' ELSE '>365' END AS age_band,
       CAST(CASE WHEN age_days IS NULL THEN 0 WHEN age_days <= 30 THEN 1 WHEN age_days <= 90 THEN 2
            WHEN age_days <= 180 THEN 3 WHEN age_days <= 365 THEN 4 ELSE 5 END AS INTEGER) AS age_band_sort
FROM a
""")
def q_age_bands(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    last = (t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.max(F.col("o_orderdate").cast("date")).alias("last_order_date")))
    c = t.customer.select("c_custkey").join(last, "c_custkey", "left")
    return age_bands(c, "last_order_date", AS_OF, null_label="unknown")


@query("ratio_metrics", "PRJ-18, AGG-1", sql="""
WITH a AS (SELECT l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue,
                  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS quantity
           FROM lineitem GROUP BY l_partkey)
SELECT l_partkey, revenue, quantity,
       CASE WHEN quantity IS NULL OR quantity = 0 THEN NULL
            ELSE CAST(revenue AS DOUBLE) / CAST(quantity AS DOUBLE) * 1.0 END AS revenue_per_unit,
       CASE WHEN quantity IS NULL OR quantity = 0 THEN 0
            ELSE CAST(revenue AS DOUBLE) / CAST(quantity AS DOUBLE) * 1000.0 END AS revenue_per_thousand
FROM a
""")
def ratio_metrics(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    a = li.groupBy("l_partkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("revenue"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(38,2)").alias("quantity"))
    return a.select("l_partkey", "revenue", "quantity",
                    ratio("revenue", "quantity").alias("revenue_per_unit"),
                    ratio("revenue", "quantity", 1000.0, on_zero=0.0).alias("revenue_per_thousand"))


@query("currency_heuristic", "PRJ-11", sql="""
SELECT o_orderkey, o_totalprice,
       CAST(CASE WHEN o_totalprice > 400000 THEN CAST(o_totalprice AS DECIMAL(18,2)) / 25000
                 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(20,8)) AS amount_usd
FROM orders
""")
def q_currency(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", "o_totalprice", currency_heuristic("o_totalprice", 400000).alias("amount_usd"))


@query("surrogate_key", "PRJ-3", sql=f"""
SELECT c_custkey, md5(concat_ws('-', coalesce(CAST(c_custkey AS VARCHAR), '{SURROGATE_NULL}'),
                                     coalesce(CAST(c_nationkey AS VARCHAR), '{SURROGATE_NULL}'),
                                     coalesce(nullif(c_mktsegment, 'BUILDING'), '{SURROGATE_NULL}'))) AS customer_sk
FROM customer
""")
def q_surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    c = Tables(spark, sf).customer
    seg = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return c.select("c_custkey", surrogate_key("c_custkey", "c_nationkey", seg).alias("customer_sk"))


@query("normalize_text", "PRJ-4, PRJ-1", sql=f"""
WITH n AS (SELECT doc_id,
                  nullif(regexp_replace(regexp_replace(nfc_normalize(text), '{WHITESPACE_CLASS}+', ' ', 'g'),
                                        '^ | $', '', 'g'), '') AS t
           FROM documents)
SELECT doc_id, CAST(length(t) AS INTEGER) AS norm_chars, md5(t) AS norm_md5 FROM n
""")
def q_normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    d = Tables(spark, sf).documents
    n = d.select("doc_id", normalize_text("text").alias("t"))
    return n.select("doc_id", F.length("t").alias("norm_chars"), F.md5("t").alias("norm_md5"))


# Spreadsheet error / placeholder tokens treated as missing.
SENTINEL_TOKENS = ["#N/A", "#REF!", "#VALUE!", "N/A", "NULL", "-"]


@query("sentinels", "PRJ-6, PRJ-1, GEN-3", sql=f"""
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE nullif(trim(line, ' '), '') IS NULL
                             OR upper(trim(line, ' ')) IN ({", ".join("'" + s + "'" for s in SENTINEL_TOKENS)}))
            AS BIGINT) AS n_missing_lines
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
GROUP BY doc_id
""")
def q_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    d = Tables(spark, sf).documents
    lines = d.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    v = sentinel_to_null("line", SENTINEL_TOKENS)
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.count(F.when(v.isNull(), F.lit(1))).alias("n_missing_lines"))


@query("json_pick", "PRJ-16", sql="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def json_pick(spark: SparkSession, sf: str) -> DataFrame:
    from lakeward.functions.cleanse import json_locale_pick
    e = Tables(spark, sf).events
    return e.select("event_id", json_locale_pick("props", ["k"]).cast("int").alias("k"))


@query("json_or_text", "PRJ-17", sql="""
WITH m AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'error at ' || CAST(user_id AS VARCHAR)
                                 ELSE props END AS comment FROM events)
SELECT event_id, CASE WHEN left(comment, 1) = '{' THEN json_extract_string(comment, '$.k') ELSE comment END AS picked
FROM m
""")
def q_json_or_text(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).events
    comment = F.when(F.col("event_type") == "error",
                     F.concat(F.lit("error at "), F.col("user_id").cast("string"))).otherwise(F.col("props"))
    return e.select("event_id", json_or_text(comment, "k").alias("picked"))


@query("month_format_dates", "scalar date functions", sql="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_key,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       last_day(CAST(o_orderdate AS DATE)) AS month_end,
       CAST(last_day(CAST(o_orderdate AS DATE)) - CAST(o_orderdate AS DATE) AS INTEGER) AS days_left,
       CAST(o_orderdate AS DATE) AS parsed_dmy
FROM orders
""")
def month_format_dates(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    dmy = F.date_format("o_orderdate", "d/M/yyyy")
    return o.select("o_orderkey", month_key("o_orderdate").alias("month_key"),
                    month_start("o_orderdate").alias("month_start"), month_end("o_orderdate").alias("month_end"),
                    F.datediff(month_end("o_orderdate"), F.col("o_orderdate").cast("date")).alias("days_left"),
                    parse_dmy(dmy).alias("parsed_dmy"))


@query("union_distinct", "SET-2", sql="""
SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'
UNION
SELECT c_custkey FROM customer WHERE c_acctbal < 0
""")
def q_union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    a = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("custkey"))
    b = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("custkey"))
    return union_distinct(a, b)


@query("key_set_diff", "SET-4", sql="""
SELECT 'orders' AS only_in, o_orderkey FROM (SELECT DISTINCT o_orderkey FROM orders
                                            EXCEPT SELECT DISTINCT l_orderkey FROM lineitem)
UNION ALL
SELECT 'lineitem', o_orderkey FROM (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem
                                   EXCEPT SELECT DISTINCT o_orderkey FROM orders)
""")
def q_key_set_diff(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return key_set_diff(t.orders.select("o_orderkey"),
                        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")),
                        "o_orderkey", "orders", "lineitem")


@query("conditional_aggs", "AGG-2/3/4/5, JN-1", sql="""
SELECT l_suppkey,
       CAST(max(l_shipdate) FILTER (WHERE l_linestatus = 'F') AS DATE) AS last_shipped_date,
       avg(CASE WHEN l_shipdate IS NOT NULL AND o_orderdate IS NOT NULL
                THEN CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) END) AS avg_ship_days,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = 'R') AS DECIMAL(38,2)) AS returned_qty,
       CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS BIGINT) AS open_lines,
       min(l_discount) AS min_discount, max(l_discount) AS max_discount,
       CAST(count(DISTINCT l_partkey) AS BIGINT) AS distinct_parts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY l_suppkey
""")
def conditional_aggs(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    j = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    both = F.col("l_shipdate").isNotNull() & F.col("o_orderdate").isNotNull()
    return j.groupBy("l_suppkey").agg(
        F.max(F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))).cast("date").alias("last_shipped_date"),
        F.avg(F.when(both, F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))))
        .alias("avg_ship_days"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("decimal(18,2)")))
        .cast("decimal(38,2)").alias("returned_qty"),
        F.count(F.when(F.col("l_linestatus") == "O", F.lit(1))).alias("open_lines"),
        F.min("l_discount").alias("min_discount"), F.max("l_discount").alias("max_discount"),
        F.count_distinct("l_partkey").alias("distinct_parts"))


@query("ordered_first", "AGG-8, SRT-4", sql=f"""
SELECT l_partkey, first_suppkey FROM (
  SELECT l_partkey, l_suppkey AS first_suppkey,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC, l_shipdate ASC NULLS LAST,
                                                             l_orderkey, {LINE_ORDER_SQL}) AS rn
  FROM lineitem) WHERE rn = 1
""")
def ordered_first(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return top1_value(li, ["l_partkey"], "l_suppkey",
                      [desc("l_quantity"), asc("l_shipdate", nulls_last=True), asc("l_orderkey")]
                      + [asc(c) for c in LINE_ORDER], "first_suppkey")


@query("allocate_evenly_calendar", "JN-12/13, GEN-6, AGG-3", sql="""
WITH b AS (SELECT CAST(date_trunc('month', min(l_shipdate)) AS DATE) AS cal_start,
                  CAST(date_trunc('month', max(l_shipdate)) AS DATE) AS cal_end FROM lineitem),
st AS (SELECT s_suppkey, s_nationkey, CAST(date_trunc('month', min(l_shipdate)) AS DATE) AS start_month
       FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_nationkey),
act AS (SELECT s_suppkey, s_nationkey,
               CAST(unnest(generate_series(CAST(coalesce(start_month, cal_start) AS TIMESTAMP),
                                           CAST(cal_end AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
        FROM st, b),
cnt AS (SELECT s_nationkey, month, count(*) AS active FROM act GROUP BY 1, 2),
cost AS (SELECT s_nationkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
                sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS cost
         FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT a.s_nationkey, a.s_suppkey, a.month, CAST(cnt.active AS BIGINT) AS active_resources,
       CAST(cost.cost AS DOUBLE) / cnt.active AS allocated
FROM act a JOIN cnt ON a.s_nationkey = cnt.s_nationkey AND a.month = cnt.month
           JOIN cost ON a.s_nationkey = cost.s_nationkey AND a.month = cost.month
""")
def allocate_evenly_calendar(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    li = t.lineitem
    # one-row summary: the calendar bounds
    lo, hi = li.agg(F.min(month_start("l_shipdate")), F.max(month_start("l_shipdate"))).first()
    starts = li.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.min("l_shipdate").alias("first_ship"))
    res = t.supplier.select("s_suppkey", "s_nationkey").join(starts, "s_suppkey", "left")
    costs = (li.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
             .groupBy("s_nationkey", month_start("l_shipdate").alias("month"))
             .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("cost")))
    out = allocate_evenly_over_calendar(res, ["s_nationkey"], "s_suppkey", "first_ship", costs, "cost",
                                        F.lit(lo), F.lit(hi))
    return out.select("s_nationkey", "s_suppkey", "month", "active_resources", "allocated")


@query("content_checksum", "2.10 surrogate hash over whole texts", sql="""
SELECT doc_id, sha256(text) AS sha256, CAST(strlen(text) AS INTEGER) AS n_bytes FROM documents
""")
def content_checksum(spark: SparkSession, sf: str) -> DataFrame:
    d = Tables(spark, sf).documents
    return d.select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").alias("n_bytes"))
