"""Queries that load tables through the store, and further warehouse models on
the driver-derived staging tables (SNK-*, SRC-1, RUN-*, 2.14)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.plans.registry import query
from lakeward.plans.tables import Tables
from lakeward.plans.warehouse import DEAL_RECEIVED_BELOW_NATION, EXCLUDED_BRAND, L, OURS, RATE, SEATS, STOCK, driver_context
from lakeward.session import ensure_checkpoint_dir
from lakeward.sources.checksum import changed_folders, file_tree
from lakeward.sources.control import SourceSpec, rollback_source, run_extract, run_load
from lakeward.sources.landing import scan_csv
from lakeward.sources.store import TableStore


def _root(spark: SparkSession) -> str:
    """A store of its own for each run, in the session's shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/store-{uuid.uuid4().hex}"


@query("upsert_partial_columns", "SNK-5: columns that the batch lacks keep their values", sql="""
SELECT c_custkey, c_name, CASE WHEN c_nationkey < 12 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT c_custkey + 100000000, NULL, c_acctbal, NULL FROM customer WHERE c_nationkey = 3
""")
def upsert_partial_columns(spark: SparkSession, sf: str) -> DataFrame:
    c, store = Tables(spark, sf).customer, TableStore(spark, _root(spark))
    store.load(c.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), "silver.customer", "truncate")
    changed = c.where("c_nationkey < 12").select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    new = c.where("c_nationkey = 3").select((F.col("c_custkey") + 100000000).alias("c_custkey"), "c_acctbal")
    store.load(changed.unionAll(new), "silver.customer", "upsert", ["c_custkey"])
    return store.read("silver.customer")


@query("append_schema_drift", "SNK-3/4/6: a batch without a column, and one of another type", sql="""
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, o_custkey, NULL FROM orders WHERE o_orderpriority = '2-HIGH'
UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def append_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    o, store = Tables(spark, sf).orders, TableStore(spark, _root(spark))
    o = o.select("o_orderkey", "o_custkey", "o_orderpriority")
    store.load(o, "silver.orders", "append", batch_id="b1")
    store.load(o.where("o_orderpriority = '2-HIGH'").drop("o_orderpriority"), "silver.orders", "append", batch_id="b2")
    as_text = o.where("o_orderpriority = '1-URGENT'").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    for _ in range(2):                      # the second time the batch is known
        store.load(as_text, "silver.orders", "append", batch_id="b3")
    return store.read("silver.orders")


@query("replayed_batches", "SNK-3/4/5: batches that come again after an upsert, and another full load", sql="""
SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal FROM customer
""")
def replayed_batches(spark: SparkSession, sf: str) -> DataFrame:
    c, store = Tables(spark, sf).customer.select("c_custkey", "c_acctbal", "c_nationkey"), TableStore(spark, _root(spark))
    low, high = (c.where(p).drop("c_nationkey") for p in ("c_nationkey < 12", "c_nationkey >= 12"))
    doubled = c.where("c_nationkey < 5").select("c_custkey", (F.col("c_acctbal") * 2).alias("c_acctbal"))
    steps = [("b1", "truncate", low), ("b2", "append", high), ("b3", "upsert", doubled),
             ("b1", "append", low), ("b3", "upsert", doubled), ("b2", "append", high)]      # the last three are known
    for batch_id, mode, rows in steps:
        store.load(rows, "silver.customer", mode, ["c_custkey"], batch_id)
    return store.read("silver.customer")


@query("csv_scan", "SRC-1/18: all columns as text from quoted CSV files", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ' "the" ' || c_mktsegment || ', Ltd' AS name FROM customer
""")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{_root(spark)}/customer"
    name = F.concat("c_name", F.lit(' "the" '), "c_mktsegment", F.lit(", Ltd"))
    Tables(spark, sf).customer.select("c_custkey", name.alias("name")).write.option("escape", '"').csv(path, header=True)
    return scan_csv(spark, path)


@query("extract_load_rollback", "RUN-1/2/4, SNK-1/2, REG-1/2/4: two loads, then back to the first", sql="""
SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_nationkey < 10
""")
def extract_load_rollback(spark: SparkSession, sf: str) -> DataFrame:
    s, root = Tables(spark, sf).supplier, _root(spark)
    spec = SourceSpec("supplier", "database", "silver.supplier")
    for day, part in ((1, "s_nationkey < 10"), (2, "s_nationkey >= 10")):
        rows = s.where(part).select("s_suppkey", "s_name", "s_acctbal")
        batch = run_extract(spark, spec, lambda last, rows=rows: rows, root, now=dt.datetime(2024, 1, day))
        if batch is not None:               # a source without rows is skipped
            run_load(spark, spec, batch, root)
    rollback_source(spark, spec, dt.date(2024, 1, 1), root)
    return TableStore(spark, root).read("silver.supplier").select("s_suppkey", "s_name", "s_acctbal")


@query("file_tree_changes", "SRC-7: folders of files changed since an earlier hash tree", sql="""
SELECT CAST(c_nationkey AS INTEGER) AS nation, count(*) AS n_customers,
       CASE WHEN c_nationkey % 5 = 0 THEN 'changed' WHEN c_nationkey % 5 = 1 THEN 'removed'
            WHEN c_nationkey % 5 = 2 THEN 'added' ELSE 'unchanged' END AS change
FROM customer GROUP BY c_nationkey
""")
def file_tree_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A folder a nation; of the folders that stay some are written anew with the same bytes (4)."""
    c, root = Tables(spark, sf).customer.select("c_nationkey", "c_custkey", "c_acctbal"), _root(spark)

    def write(rows: DataFrame) -> None:
        (rows.withColumn("nation", F.col("c_nationkey")).repartition("nation").sortWithinPartitions("nation", "c_custkey")
         .write.partitionBy("nation").option("partitionOverwriteMode", "dynamic").mode("overwrite").csv(f"{root}/files"))

    write(c.where("c_nationkey % 5 <> 2"))
    file_tree(spark, f"{root}/files").write.parquet(f"{root}/tree")
    known = spark.read.parquet(f"{root}/tree")
    write(c.where("c_nationkey % 5 in (0, 2, 4)")
          .withColumn("c_acctbal", F.when(F.expr("c_nationkey % 5 = 0"), F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))))
    gone = F.regexp_extract("folder", "nation=([0-9]+)$", 1).cast("int")
    tree = file_tree(spark, f"{root}/files", known).where(gone % 5 != 1)
    n = c.groupBy(F.col("c_nationkey").cast("int").alias("nation")).agg(F.count(F.lit(1)).alias("n_customers"))
    return changed_folders(tree, known).select(gone.alias("nation"), "change").join(n, "nation")


def _model(name: str, ops: str, sql: str):
    """Register a warehouse model by its name."""
    @query(f"wh_{name}", f"2.14 {name}: {ops}", sql=sql)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return driver_context(spark, sf).ref(name)
    return run


#: Daily metrics of orders whose customers have a live deal.
LIVE = "lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0"

_model("dim_usd", "2.10 casts", "SELECT CAST(o_orderdate AS DATE) AS record_date, CAST(o_totalprice AS DOUBLE) AS exchange_rate FROM orders")
_model("dim_artist_distro", "SET-3, PRJ-3", """
SELECT DISTINCT md5('A' || l_suppkey) AS dim_artist_distro_sk, 'A' || l_suppkey AS artist_id, s_name AS artist_name
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""")
_model("dim_platform", "SET-3, PRJ-3", """
SELECT md5(n_name) AS dim_platform_sk, md5(n_name) AS artist_id, n_name AS artist_name FROM nation
WHERE n_nationkey IN (SELECT s_nationkey FROM supplier JOIN lineitem ON l_suppkey = s_suppkey)""")
_model("dim_distributed_employee", "PRJ-19", """
SELECT md5(CAST(s_suppkey AS VARCHAR)) AS dim_distributed_employee_sk, CAST(s_suppkey AS VARCHAR) AS emp_id, s_name AS emp_name,
       CAST(NULL AS VARCHAR) AS department_id, CAST(NULL AS VARCHAR) AS team, CAST(NULL AS VARCHAR) AS role FROM supplier""")
_model("int_excluded_stock_codes", "PRJ-1, SET-3", f"SELECT DISTINCT {STOCK} AS hg_stock_id FROM part WHERE p_brand = '{EXCLUDED_BRAND}'")
_model("bridge_bt_vid", "PRJ-1/3", """
SELECT md5('V' || o_orderkey || '-E' || o_orderkey) AS bridge_bt_vid_sk, 'E' || o_orderkey AS editing_code, 'V' || o_orderkey AS video_id
FROM orders""")
_model("int_stock_video", "JN-14, SET-3", f"SELECT DISTINCT stock AS hg_stock_id, 'V' || o AS video_id FROM ({SEATS})")
_model("fact_view_yt", "JN-4, PRJ-18", f"""
SELECT md5('V' || l_orderkey || '-' || CAST(l_shipdate AS TIMESTAMP)) AS fact_view_yt_sk, 'V' || l_orderkey AS video_id,
       CAST(l_quantity AS DECIMAL(38,6)) AS view_count, CAST(l_shipdate AS TIMESTAMP) AS recorded_date,
       l_extendedprice / l_quantity AS rpm FROM {LIVE}""")
_model("fact_revenue_yt", "JN-4/19", f"""
SELECT md5('V' || l_orderkey || '-' || CAST(l_shipdate AS TIMESTAMP)) AS fact_revenue_yt_sk, 'V' || l_orderkey AS video_id,
       CAST(l_extendedprice AS DECIMAL(38,6)) AS revenue_amount, CAST(l_shipdate AS TIMESTAMP) AS revenue_date, rate AS exchange_rate
FROM {LIVE} LEFT JOIN {RATE} ON first_day = CAST(l_shipdate AS DATE) WHERE c_nationkey < {DEAL_RECEIVED_BELOW_NATION}""")
_model("fact_revenue_view_youtube", "JN-4, WIN-1, PRJ-18", f"""
SELECT md5(concat_ws('-', 'UC' || o_custkey, 'V' || o_orderkey, CAST(l_shipdate AS DATE))) AS fact_revenue_view_youtube_sk,
       'V' || o_orderkey AS video_id, 'UC' || o_custkey AS channel_id, '{L.VIDEO_URL_PREFIX}V' || o_orderkey AS video_url,
       CAST(o_orderdate AS TIMESTAMP) AS published_date, nullif(trim(o_orderpriority), '') AS video_name,
       CAST(l_extendedprice AS DECIMAL(38,6)) AS revenue_amount, CAST(l_quantity AS DECIMAL(38,6)) AS view,
       1000.0 * (l_extendedprice / l_quantity) AS rpm, CAST(l_shipdate AS DATE) AS revenue_date
FROM {OURS} JOIN lineitem ON l_orderkey = o_orderkey""")
_model("fact_distribution", "JN-18 list lookups, JN-5", f"""
WITH hands AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_quantity * 100) AS BIGINT),
                   CAST(round(l_extendedprice * 100) AS BIGINT)) AS id, *
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey WHERE p_brand <> '{EXCLUDED_BRAND}')
SELECT md5(id) AS fact_distribution_sk, id AS distribution_id, {STOCK} AS hg_stock_id, CAST(l_shipdate AS TIMESTAMP) AS distribution_date,
       '{L.SHARED_RECIPIENT}' AS recipient_company, a.n_name || ', ' || b.n_name AS department, r_name AS team, s_name AS employee,
       l_suppkey AS distributed_employee_id
FROM hands JOIN nation a ON a.n_nationkey = s_nationkey JOIN nation b ON b.n_nationkey = a.n_regionkey
JOIN region ON r_regionkey = a.n_regionkey""")
