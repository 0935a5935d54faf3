"""Reconciliation of a batch from the ledger to the mart (REC-1, REC-2): agreeing
layers, and layers with seeded faults."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.marts import daily_totals, sales_fact
from lakeward.plans.registry import query
from lakeward.plans.tables import Tables
from lakeward.quality.reconcile import (BATCH_CHECKS, KEY_CHECKS, batch_layers, key_differences, layer_keys,
                                        reconcile_batch)
from lakeward.sources.ledger import LEDGER_SCHEMA

SOURCE = "orders"
FIRST, SECOND = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)


def staged_orders(t: Tables) -> DataFrame:
    """Orders as text staging in two batches, the pending ones last, with status and priority."""
    pending = F.col("o_orderstatus") == "P"
    amount = F.col("o_totalprice").cast("string").cast("decimal(18,2)")
    return t.orders.select(F.col("o_orderkey").cast("string").alias("sale_id"), amount.cast("string").alias("amount"),
                           F.date_format("o_orderdate", "yyyy-MM-dd").alias("sale_date"),
                           F.when(pending, "orders_b2").otherwise("orders_b1").alias("_batch_id"),
                           F.when(pending, F.lit(SECOND)).otherwise(F.lit(FIRST)).alias("_loaded_at"),
                           F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))


def ledger_events(rows: DataFrame, surplus: int = 0) -> DataFrame:
    """What the loads of the two batches left in the ledger: extracted, then loaded."""
    counted = rows.groupBy(F.col("_batch_id").alias("batch_id"), F.col("_loaded_at").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    states = F.explode(F.array(F.struct(F.lit("extracted").alias("status"), F.lit(0).alias("hours")),
                               F.struct(F.lit("loaded").alias("status"), F.lit(1).alias("hours"))))
    known = {"source_id": F.lit(SOURCE), "source_type": F.lit("csv"), "batch_id": F.col("batch_id"), "status": F.col("s.status"),
             "row_count": F.col("n") + F.lit(surplus), "event_at": F.col("at") + F.make_interval(hours=F.col("s.hours"))}
    return counted.withColumn("s", states).select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                                                    for f in LEDGER_SCHEMA.fields])


def faulty_layers(t: Tables) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(layers, gold, ledger) in which every check but two fails: the ledger
    counts one row too many, bronze has other amounts of urgent orders, staging
    lacks finished orders of high priority, silver lacks the batch's orders without
    a priority and has those of low priority twice, gold starts in 1993."""
    staged = staged_orders(t)
    cent = (F.col("amount").cast("decimal(18,2)") + F.lit("0.01").cast("decimal(18,2)")).cast("decimal(18,2)").cast("string")
    bronze = staged.withColumn("amount", F.when(F.col("priority") == "1-URGENT", cent).otherwise(F.col("amount")))
    staging = staged.filter(~((F.col("status") == "F") & (F.col("priority") == "2-HIGH")))
    again = (staging.filter((F.col("status") == "P") & (F.col("priority") == "5-LOW"))
             .withColumn("sale_id", (F.col("sale_id").cast("long") + 1_000_000_000).cast("string")))
    left = staging.filter(~((F.col("status") == "P") & (F.col("priority") == "4-NOT SPECIFIED")))
    silver = sales_fact(left.unionByName(again))
    gold = daily_totals(silver.filter(F.col("sale_date") >= dt.date(1993, 1, 1)))
    return batch_layers(staged, bronze, staging, silver), gold, ledger_events(staged, surplus=1)


@query("reconcile_batch", "REC-1, REC-2, REG-1", sql="""
WITH d AS (SELECT o_orderstatus = 'P' AS pending, CAST(o_totalprice AS DECIMAL(18,2)) AS amt FROM orders),
v AS (SELECT CAST(count(*) AS VARCHAR) AS n, CAST(CAST(coalesce(sum(amt), 0) AS DECIMAL(38,2)) AS VARCHAR) AS a,
             CAST(count(*) FILTER (WHERE pending) AS VARCHAR) AS bn,
             CAST(CAST(coalesce(sum(amt) FILTER (WHERE pending), 0) AS DECIMAL(38,2)) AS VARCHAR) AS ba FROM d)
""" + "\nUNION ALL\n".join(
    "SELECT '%s' AS check_name, %s AS actual, %s AS expected, true AS success FROM v" % (
        name, *(["'0'"] * 2 if kind == "keys" else
                [("b" if {a, e} & {"bronze", "staging_batch"} else "") + {"rows": "n", "amount": "a"}[kind]] * 2))
    for name, kind, a, e in BATCH_CHECKS))
def q_reconcile_batch(spark: SparkSession, sf: str) -> DataFrame:
    """All fifteen checks over orders that arrive in two batches."""
    staged = staged_orders(Tables(spark, sf))
    silver = sales_fact(staged)
    layers = batch_layers(staged, staged, staged, silver)
    return reconcile_batch(ledger_events(staged), SOURCE, layers, daily_totals(silver), "sale_id", "amount",
                           "order_count", "total_amount")


FAULTY_SQL = """
WITH src AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS amt, CAST(o_orderdate AS DATE) AS day,
                    o_orderstatus AS status, o_orderpriority AS priority FROM orders),
stg AS (SELECT * FROM src WHERE NOT (status = 'F' AND priority = '2-HIGH')),
slv AS (SELECT * FROM stg WHERE NOT (status = 'P' AND priority = '4-NOT SPECIFIED')
        UNION ALL SELECT k + 1000000000, amt, day, status, priority FROM stg WHERE status = 'P' AND priority = '5-LOW'),
lay AS (SELECT 'source' AS layer, k, amt FROM src
        UNION ALL SELECT 'bronze', k, CASE WHEN priority = '1-URGENT' THEN amt + 0.01 ELSE amt END FROM src WHERE status = 'P'
        UNION ALL SELECT 'staging', k, amt FROM stg
        UNION ALL SELECT 'staging_batch', k, amt FROM stg WHERE status = 'P'
        UNION ALL SELECT 'silver', k, amt FROM slv
        UNION ALL SELECT 'silver_batch', k, amt FROM slv WHERE status = 'P'
        UNION ALL SELECT 'gold', k, amt FROM slv WHERE day >= DATE '1993-01-01'),
spec AS (SELECT * FROM (VALUES """ + ", ".join("('%s', '%s', '%s', '%s')" % c for c in BATCH_CHECKS) + """) s(check_name, kind, act, expd)),
vals AS (SELECT layer, 'rows' AS kind, CAST(count(*) AS VARCHAR) AS v FROM lay GROUP BY layer
         UNION ALL SELECT layer, 'amount', CAST(CAST(sum(amt) AS DECIMAL(38,2)) AS VARCHAR) FROM lay GROUP BY layer
         UNION ALL SELECT 'ledger', 'rows', CAST(count(*) + 1 AS VARCHAR) FROM src WHERE status = 'P'),
keys AS (SELECT DISTINCT layer, CAST(k AS VARCHAR) AS k FROM lay),
missing AS (SELECT s.check_name, e.k FROM spec s JOIN keys e ON e.layer = s.expd
            WHERE s.kind = 'keys' AND NOT EXISTS (SELECT 1 FROM keys a WHERE a.layer = s.act AND a.k = e.k)),
extra AS (SELECT s.check_name, a.k FROM spec s JOIN keys a ON a.layer = s.act
          WHERE s.kind = 'keys' AND NOT EXISTS (SELECT 1 FROM keys e WHERE e.layer = s.expd AND e.k = a.k))
"""


@query("reconcile_faulty_batch", "REC-1, REC-2, REG-1", sql=FAULTY_SQL + """
SELECT s.check_name, a.v AS actual, e.v AS expected, a.v = e.v AS success
FROM spec s JOIN vals a ON a.layer = s.act AND a.kind = s.kind JOIN vals e ON e.layer = s.expd AND e.kind = s.kind
UNION ALL
SELECT s.check_name, CAST(n AS VARCHAR), '0', n = 0
FROM (SELECT s.check_name, (SELECT count(*) FROM missing m WHERE m.check_name = s.check_name)
                         + (SELECT count(*) FROM extra x WHERE x.check_name = s.check_name) AS n
      FROM spec s WHERE s.kind = 'keys') s
""")
def q_reconcile_faulty_batch(spark: SparkSession, sf: str) -> DataFrame:
    layers, gold, events = faulty_layers(Tables(spark, sf))
    return reconcile_batch(events, SOURCE, layers, gold, "sale_id", "amount", "order_count", "total_amount")


@query("reconcile_key_ranges", "REC-1, SET-4", sql=FAULTY_SQL + """
SELECT check_name, key_range, CAST(sum(m) AS BIGINT) AS n_missing, CAST(sum(x) AS BIGINT) AS n_extra
FROM (SELECT check_name, md5(k)[1:3] AS key_range, 1 AS m, 0 AS x FROM missing
      UNION ALL SELECT check_name, md5(k)[1:3], 0, 1 FROM extra)
GROUP BY check_name, key_range
""")
def q_reconcile_key_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Where the key sets of the faulty layers differ."""
    layers, _, _ = faulty_layers(Tables(spark, sf))
    keys = reduce(DataFrame.unionByName, [layer_keys(name, df, "sale_id") for name, df in layers.items()])
    return key_differences(keys, KEY_CHECKS)
