"""Ingestion, ledger, landed-payload, data-quality and reconciliation
queries (SRC-*, SNK-5, REG-*, DQ-*, REC-*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.dates import month_start, ts_text
from lakeward.operators.marts import daily_totals, sales_fact
from lakeward.plans.registry import query
from lakeward.plans.tables import Tables
from lakeward.quality import rules as R
from lakeward.quality.reconcile import key_gap, layer_metrics, reconcile
from lakeward.sources.grid import grid_to_table
from lakeward.sources.jdbc import watermark_summary
from lakeward.sources.landing import coerce_time_suffix, field_mapping, scan_csv_incremental
from lakeward.sources.ledger import history, last_success, rollback_target
from lakeward.sources.pages import (flatten_pages, flatten_search_hits, month_partitions,
                                    page_chain_check)
from lakeward.sources.store import merge_by_key

LAST_EVENT_WATERMARK = "2024-01-20 00:00:00"
ROLLBACK_DAY = dt.date(1998, 6, 30)
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@query("upsert_merge", "SNK-5", sql="""
WITH delta AS (
  SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders
  WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'P')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta)
UNION ALL
SELECT * FROM delta
""")
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select(*ORDER_COLS)
    changed = (o.filter(F.col("o_orderstatus") == "O")
               .select("o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"),
                       (F.col("o_totalprice") + F.lit(1)).alias("o_totalprice")))
    new = o.filter(F.col("o_orderstatus") == "P").withColumn("o_orderkey", F.col("o_orderkey") + F.lit(1_000_000_000))
    return merge_by_key(o, changed.unionByName(new), ["o_orderkey"])


@query("incremental_delta", "SRC-2", sql="""
SELECT event_id, user_id, value FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'
""")
def incremental_delta(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events
    delta, _ = scan_csv_incremental(ev, "ts", LAST_EVENT_WATERMARK)
    return delta.select("event_id", "user_id", "value")


@query("max_watermark", "SRC-5, SRC-6", sql="""
SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS watermark_value,
       CAST(count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-20 00:00:00') AS BIGINT) AS newer_rows,
       count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-20 00:00:00') > 0 AS changed
FROM events
""")
def max_watermark_q(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events
    return watermark_summary(ev, "ts", F.lit(LAST_EVENT_WATERMARK).cast("timestamp_ntz"))


def orders_ledger(t: Tables) -> DataFrame:
    """A batch ledger derived from orders: one batch per order, the priority
    as source, the order date as extraction time, the status mapped to a
    ledger status."""
    status = (F.when(F.col("o_orderstatus") == "F", "loaded").when(F.col("o_orderstatus") == "O", "failed")
              .otherwise("extracted"))
    return t.orders.select(F.col("o_orderpriority").alias("source_id"),
                           F.concat(F.lit("b_"), F.col("o_orderkey").cast("string")).alias("batch_id"),
                           status.alias("status"), F.col("o_orderdate").alias("extracted_at"),
                           F.col("o_totalprice").alias("row_count"))


LEDGER_PICK_SQL = """
SELECT source_id, batch_id, strftime(extracted_at, '%Y-%m-%d %H:%M:%S.%f') AS extracted_at FROM (
  SELECT o_orderpriority AS source_id, 'b_' || CAST(o_orderkey AS VARCHAR) AS batch_id, o_orderdate AS extracted_at,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, 'b_' || CAST(o_orderkey AS VARCHAR) DESC) AS rn
  FROM orders WHERE o_orderstatus = 'F' {extra}) WHERE rn = 1
"""


@query("ledger_last_success", "REG-2, SRT-2", sql=LEDGER_PICK_SQL.format(extra=""))
def ledger_last_success(spark: SparkSession, sf: str) -> DataFrame:
    best = last_success(orders_ledger(Tables(spark, sf)))
    return best.select("source_id", "batch_id", ts_text("extracted_at").alias("extracted_at"))


@query("ledger_history", "REG-5, SRT-3", sql="""
SELECT source_id, batch_id, strftime(extracted_at, '%Y-%m-%d %H:%M:%S.%f') AS extracted_at FROM (
  SELECT o_orderpriority AS source_id, 'b_' || CAST(o_orderkey AS VARCHAR) AS batch_id, o_orderdate AS extracted_at
  FROM orders WHERE o_orderpriority = '1-URGENT'
  ORDER BY o_orderdate DESC NULLS LAST, 'b_' || CAST(o_orderkey AS VARCHAR) DESC LIMIT 20)
""")
def ledger_history(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 newest batches of one source (a top-k report: the limit is the feature)."""
    h = history(orders_ledger(Tables(spark, sf)), "1-URGENT", 20)
    return h.select("source_id", "batch_id", ts_text("extracted_at").alias("extracted_at"))


@query("ledger_as_of", "REG-4, JN-20", sql=LEDGER_PICK_SQL.format(
    extra="AND CAST(o_orderdate AS DATE) <= DATE '1998-06-30'"))
def ledger_as_of(spark: SparkSession, sf: str) -> DataFrame:
    best = rollback_target(orders_ledger(Tables(spark, sf)), ROLLBACK_DAY)
    return best.select("source_id", "batch_id", ts_text("extracted_at").alias("extracted_at"))


ITEM = T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                     T.StructField("text", T.StringType()),
                     T.StructField("conv", T.StructType([T.StructField("id", T.LongType())]))])
PAGE = T.StructType([T.StructField("data", T.ArrayType(ITEM)), T.StructField("hasMore", T.BooleanType()),
                     T.StructField("scrollId", T.StringType())])
TURNS_PER_PAGE = 2


def conversation_pages(t: Tables) -> DataFrame:
    """Conversations landed as a paged API would return them: pages of two
    turns, a has-more flag and a cursor to the next page."""
    c = t.conversations.withColumn("page_no", F.floor(F.col("turn") / TURNS_PER_PAGE))
    last = c.groupBy("conv_id").agg(F.max("page_no").alias("last_page"))
    item = F.struct("turn", "role", "text", F.struct(F.col("conv_id").alias("id")).alias("conv"))
    pages = c.groupBy("conv_id", "page_no").agg(F.array_sort(F.collect_list(item)).alias("data"))
    more = F.col("page_no") < F.col("last_page")
    cursor = F.when(more, F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("page_no") + 1).cast("string")))
    return pages.join(last, "conv_id").select(
        "conv_id", "page_no", F.to_json(F.struct("data", more.alias("hasMore"), cursor.alias("scrollId"))).alias("payload"))


@query("flatten_pages", "SRC-8", sql="SELECT conv_id, turn, role, text FROM conversations")
def q_flatten_pages(spark: SparkSession, sf: str) -> DataFrame:
    flat = flatten_pages(conversation_pages(Tables(spark, sf)), "data", payload_schema=PAGE)
    return flat.select(F.col("`conv.id`").alias("conv_id"), "turn", "role", "text")


@query("page_chain_check", "SRC-9", sql="""
WITH p AS (SELECT DISTINCT conv_id, turn // 2 AS n, max(turn // 2) OVER (PARTITION BY conv_id) AS last FROM conversations),
landed AS (
  SELECT conv_id, n, n < last OR conv_id % 7 = 4 AS more,
         CASE WHEN n >= last OR conv_id % 7 = 2 THEN NULL WHEN conv_id % 7 = 3 THEN 'again' ELSE conv_id || '-' || (n + 1) END AS cur
  FROM p WHERE NOT (conv_id % 7 = 1 AND n = 1 AND last > 1)),
found AS (
  SELECT conv_id, count(*) AS pages, count(*) FILTER (more AND cur IS NULL) AS missing_cursor,
         count(cur) - count(DISTINCT cur) AS repeated_cursor, CAST(arg_max(more, n) AS BIGINT) AS dangling_has_more,
         CAST(max(n) - min(n) + 1 - count(*) AS BIGINT) AS page_gaps
  FROM landed GROUP BY conv_id)
SELECT *, pages > 100 AS over_cap,
       pages <= 100 AND missing_cursor + repeated_cursor + dangling_has_more + page_gaps = 0 AS ok
FROM found
""")
def q_page_chain_check(spark: SparkSession, sf: str) -> DataFrame:
    """Chains with every kind of damage, by conversation id: a page lost (1), cursors
    lost (2), a cursor repeated (3), a last page that says more follow (4)."""
    kind = F.col("conv_id") % 7
    meta = conversation_pages(Tables(spark, sf)).select(
        "conv_id", "page_no", F.max("page_no").over(Window.partitionBy("conv_id")).alias("last_page"),
        (F.get_json_object("payload", "$.hasMore").cast("boolean") | (kind == 4)).alias("has_more"),
        F.get_json_object("payload", "$.scrollId").alias("cursor"))
    meta = meta.where(~((kind == 1) & (F.col("page_no") == 1) & (F.col("last_page") > 1))).withColumn(
        "cursor", F.when(kind == 2, None).when((kind == 3) & F.col("cursor").isNotNull(), "again").otherwise(F.col("cursor")))
    return page_chain_check(meta, "conv_id", "page_no", "has_more", "cursor", max_pages=100)


HIT_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("_source", T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        T.StructField("createdAt", T.StringType())]))])


@query("flatten_hits", "SRC-12, SRC-13", sql="""
SELECT CAST(doc_id AS VARCHAR) AS _es_id, doc_id, lang, source, n_chars,
       CAST(DATE '2000-01-01' + CAST(n_chars AS INTEGER) AS DATE) AS createdAt
FROM documents WHERE n_chars >= 366
""")
def q_flatten_hits(spark: SparkSession, sf: str) -> DataFrame:
    d = Tables(spark, sf).documents
    created = F.date_format(F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("n_chars").cast("int")), "yyyy-MM-dd")
    hit = F.struct(F.col("doc_id").cast("string").alias("_id"),
                   F.struct("doc_id", "lang", "source", "n_chars", created.alias("createdAt")).alias("_source"))
    landed = d.select(F.to_json(hit).alias("raw")).select(F.from_json("raw", HIT_SCHEMA).alias("hit"))
    flat = coerce_time_suffix(flatten_search_hits(landed, "hit", "createdAt", "2001-01-01"))
    return flat.withColumn("createdAt", F.col("createdAt").cast("date"))


def customer_grids(t: Tables) -> DataFrame:
    """Customer lists landed as one spreadsheet per nation: a title row, a
    blank row, a header row with irregular case/spacing, then ragged data
    rows (household customers lack the balance cell)."""
    c = t.customer
    file = F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"), F.lit(".xlsx"))
    files = c.select(file.alias("file")).distinct()
    title = files.select("file", F.lit(0).cast("long").alias("row_no"),
                         F.array(F.lit("Customer list"), F.col("file")).alias("cells"))
    blank = files.select("file", F.lit(1).cast("long").alias("row_no"), F.array(F.lit(""), F.lit("")).alias("cells"))
    header = files.select("file", F.lit(2).cast("long").alias("row_no"),
                          F.array(F.lit(" Cust Key"), F.lit("NAME "), F.lit("Segment"), F.lit("Balance")).alias("cells"))
    bal = F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    cells = F.when(F.col("c_mktsegment") == "HOUSEHOLD",
                   F.array(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")) \
             .otherwise(F.array(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment", bal))
    body = c.select(file.alias("file"), (F.col("c_custkey") + 3).alias("row_no"), cells.alias("cells"))
    return title.unionByName(blank).unionByName(header).unionByName(body)


@query("grid_to_table", "SRC-15, SRC-17", sql="""
SELECT 'nation_' || CAST(c_nationkey AS VARCHAR) || '.xlsx' AS file, CAST(c_custkey AS VARCHAR) AS c_custkey,
       c_name, c_mktsegment,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS c_acctbal,
       '' AS note
FROM customer
""")
def q_grid_to_table(spark: SparkSession, sf: str) -> DataFrame:
    g = customer_grids(Tables(spark, sf))
    tbl = grid_to_table(g, ["cust key", "name", "segment", "balance", "note"], header_key="name")
    return field_mapping(tbl, {"file": "file", "cust key": "c_custkey", "name": "c_name",
                               "segment": "c_mktsegment", "balance": "c_acctbal", "note": "note"})


@query("month_partitions", "SRC-10, GEN-6, JN-5", sql="""
WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
m AS (SELECT CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE)
             AS month_from FROM b),
c AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_from, count(*) AS n FROM orders GROUP BY 1)
SELECT m.month_from, CAST(m.month_from + INTERVAL 1 MONTH AS DATE) AS month_to,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_orders, coalesce(c.n, 0) = 0 AS is_missing
FROM m LEFT JOIN c ON m.month_from = c.month_from
""")
def q_month_partitions(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    lo, hi = o.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()   # one-row summary
    months = month_partitions(spark, F.lit(lo), F.lit(hi))
    counts = o.groupBy(month_start("o_orderdate").alias("month_from")).agg(F.count(F.lit(1)).alias("n_orders"))
    out = months.join(counts, "month_from", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))
    return out.select("month_from", "month_to", "n_orders", (F.col("n_orders") == 0).alias("is_missing"))


def order_rules(t: Tables) -> list[R.Rule]:
    return [
        R.expect_row_count("R01", min_value=1, severity="critical"),
        R.expect_not_null("R02", "o_orderkey", severity="critical"),
        R.expect_unique("R03", "o_orderkey", severity="critical"),
        R.expect_in_set("R04", "o_orderstatus", ["F", "O", "P"]),
        R.expect_regex("R05", "o_orderpriority", "^[1-5]-[A-Z ]+$"),
        R.expect_in_set("R06", "o_orderpriority", ["1-URGENT", "2-HIGH"], mostly=0.3),
        R.expect_unique("R07", "o_custkey"),
        R.expect_expr("R08", "o_totalprice > 0", severity="critical"),
        R.expect_not_null("R09", "o_comment"),
        R.expect_fk("R10", "o_custkey", t.customer, "c_custkey", severity="critical"),
        R.Rule("R11", R.KNOWN[1], {"column": "o_orderkey"}, "critical", enabled=False),
        R.Rule("R12", "expect_magic", {}, "warning"),
    ]


DQ_SQL = """
WITH n AS (SELECT count(*) AS n FROM orders),
dup_key AS (SELECT coalesce(sum(c), 0) AS bad FROM (SELECT count(*) AS c FROM orders WHERE o_orderkey IS NOT NULL
                                                 GROUP BY o_orderkey HAVING count(*) > 1)),
dup_cust AS (SELECT coalesce(sum(c), 0) AS bad FROM (SELECT count(*) AS c FROM orders WHERE o_custkey IS NOT NULL
                                                  GROUP BY o_custkey HAVING count(*) > 1)),
b AS (SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS r02,
             count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O', 'P')) AS r04,
             count(*) FILTER (WHERE o_orderpriority IS NOT NULL AND NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$')) AS r05,
             count(*) FILTER (WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS r06,
             count(o_orderpriority) AS nn06,
             count(*) FILTER (WHERE NOT coalesce(o_totalprice > 0, false)) AS r08
      FROM orders),
fk AS (SELECT count(*) AS bad FROM orders WHERE o_custkey IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)),
res AS (
  SELECT 'R01' AS rule_id, 'expect_table_row_count_to_be_between' AS expectation_type, NULL AS column_name,
         'critical' AS severity, n >= 1 AS success, n AS element_count, NULL AS unexpected_count,
         NULL AS unexpected_percent, CAST(n AS VARCHAR) AS observed_value, NULL AS raw_result FROM n
  UNION ALL SELECT 'R02', 'expect_column_values_to_not_be_null', 'o_orderkey', 'critical', r02 = 0, n, r02,
         round(r02 * 100.0 / n, 4), CAST(r02 AS VARCHAR), NULL FROM b, n
  UNION ALL SELECT 'R03', 'expect_column_values_to_be_unique', 'o_orderkey', 'critical', bad = 0, n, bad,
         round(bad * 100.0 / n, 4), CAST(bad AS VARCHAR), NULL FROM dup_key, n
  UNION ALL SELECT 'R04', 'expect_column_values_to_be_in_set', 'o_orderstatus', 'warning', r04 = 0, n, r04,
         round(r04 * 100.0 / n, 4), CAST(r04 AS VARCHAR), NULL FROM b, n
  UNION ALL SELECT 'R05', 'expect_column_values_to_match_regex', 'o_orderpriority', 'warning', r05 = 0, n, r05,
         round(r05 * 100.0 / n, 4), CAST(r05 AS VARCHAR), NULL FROM b, n
  UNION ALL SELECT 'R06', 'expect_column_values_to_be_in_set', 'o_orderpriority', 'warning',
         CAST(nn06 - r06 AS DECIMAL(38, 0)) >= CAST(nn06 AS DECIMAL(38, 0)) * 0.3, n, r06,
         round(r06 * 100.0 / n, 4), CAST(r06 AS VARCHAR), NULL FROM b, n
  UNION ALL SELECT 'R07', 'expect_column_values_to_be_unique', 'o_custkey', 'warning', bad = 0, n, bad,
         round(bad * 100.0 / n, 4), CAST(bad AS VARCHAR), NULL FROM dup_cust, n
  UNION ALL SELECT 'R08', 'expect_expression_true', NULL, 'critical', r08 = 0, n, r08,
         round(r08 * 100.0 / n, 4), CAST(r08 AS VARCHAR), NULL FROM b, n
  UNION ALL SELECT 'R09', 'expect_column_values_to_not_be_null', 'o_comment', 'warning', false, NULL, NULL, NULL,
         NULL, '{"exception": "column o_comment not found"}'
  UNION ALL SELECT 'R10', 'expect_foreign_key', 'o_custkey', 'critical', bad = 0, n, bad,
         round(bad * 100.0 / n, 4), CAST(bad AS VARCHAR), NULL FROM fk, n
  UNION ALL SELECT 'R12', 'expect_magic', NULL, 'warning', false, NULL, NULL, NULL, NULL,
         '{"exception": "unknown expectation expect_magic"}')
"""


@query("dq_results", "DQ-1..6, DQ-12, DQ-13", sql=DQ_SQL + """
SELECT rule_id, expectation_type, CAST(column_name AS VARCHAR) AS column_name, severity, success,
       CAST(element_count AS BIGINT) AS element_count, CAST(unexpected_count AS BIGINT) AS unexpected_count,
       CAST(unexpected_percent AS DOUBLE) AS unexpected_percent, CAST(observed_value AS VARCHAR) AS observed_value,
       CAST(raw_result AS VARCHAR) AS raw_result
FROM res
""")
def dq_results(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return R.validate(t.orders, order_rules(t))


@query("dq_gate", "DQ-7", sql=DQ_SQL + """
SELECT CASE WHEN count(*) FILTER (WHERE NOT success AND severity = 'critical') > 0 THEN 'failed'
            WHEN count(*) FILTER (WHERE NOT success) > 0 THEN 'passed_with_warnings' ELSE 'passed' END AS status,
       CAST(count(*) AS BIGINT) AS total_rules, CAST(count(*) FILTER (WHERE success) AS BIGINT) AS passed_rules,
       CAST(count(*) FILTER (WHERE NOT success) AS BIGINT) AS failed_rules,
       CAST(round(count(*) FILTER (WHERE success) * 100.0 / count(*), 2) AS DECIMAL(5,2)) AS success_percent
FROM res
""")
def dq_gate(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return R.gate(R.validate(t.orders, order_rules(t)))


def order_layers(t: Tables) -> dict[str, DataFrame]:
    """bronze (all text) -> staging (typed) -> silver (latest per key) -> gold (daily)."""
    o = t.orders
    bronze = o.select(*[F.col(c).cast("string").alias(c) for c in o.columns]) \
              .withColumn("_batch_id", F.lit("orders_b1"))
    staged = bronze.select(F.col("o_orderkey").alias("sale_id"), F.col("o_totalprice").alias("amount"),
                           F.substring("o_orderdate", 1, 10).alias("sale_date"),
                           F.lit(dt.datetime(2024, 2, 1)).alias("_loaded_at"), "_batch_id")
    staging = staged.select(F.col("sale_id").cast("long").alias("sale_id"),
                            F.col("amount").cast("decimal(18,2)").alias("amount"),
                            F.col("sale_date").cast("date").alias("sale_date"))
    silver = sales_fact(staged)
    gold = daily_totals(silver)
    return {"bronze": bronze, "staging": staging, "silver": silver, "gold": gold}


@query("reconcile_layers", "REC-1, REC-2, SET-4", sql="""
WITH m AS (SELECT CAST(count(*) AS VARCHAR) AS n,
                  CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS VARCHAR) AS amt FROM orders)
SELECT 'bronze_vs_staging_rows' AS check_name, n AS actual, n AS expected, true AS success FROM m
UNION ALL SELECT 'bronze_vs_staging_amount', amt, amt, true FROM m
UNION ALL SELECT 'staging_vs_silver_rows', n, n, true FROM m
UNION ALL SELECT 'staging_vs_silver_amount', amt, amt, true FROM m
UNION ALL SELECT 'silver_vs_gold_rows', n, n, true FROM m
UNION ALL SELECT 'silver_vs_gold_amount', amt, amt, true FROM m
UNION ALL SELECT 'bronze_vs_silver_keys', '0', '0', true
""")
def reconcile_layers(spark: SparkSession, sf: str) -> DataFrame:
    L = order_layers(Tables(spark, sf))
    metrics = (layer_metrics("bronze", L["bronze"], "o_totalprice")
               .unionByName(layer_metrics("staging", L["staging"], "amount"))
               .unionByName(layer_metrics("silver", L["silver"], "amount"))
               .unionByName(layer_metrics("gold", L["gold"], "total_amount", count_col="order_count")))
    checks = [("bronze_vs_staging_rows", "rows", "staging", "bronze"),
              ("bronze_vs_staging_amount", "amount", "staging", "bronze"),
              ("staging_vs_silver_rows", "rows", "silver", "staging"),
              ("staging_vs_silver_amount", "amount", "silver", "staging"),
              ("silver_vs_gold_rows", "rows", "gold", "silver"),
              ("silver_vs_gold_amount", "amount", "gold", "silver")]
    keys = key_gap(L["bronze"].select(F.col("o_orderkey").cast("long").alias("k")),
                   L["silver"].select(F.col("sale_id").cast("long").alias("k")), "k")
    return reconcile(metrics, checks, {"bronze_vs_silver_keys": keys})
