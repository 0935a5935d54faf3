"""Resources and their production flow on staging tables derived from the driver tables (2.14).

Nations are projects with a default and a BUILDING sub-project; suppliers are
repositories of their nation's default sub-project.  Orders are songs of the
order system, rows of the performance sheet (every 11th) and added files (every
13th); parts are catalogue files, customers the sheet before the order system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.models import ModelContext
from lakeward.models import labels as L
from lakeward.plans.registry import query
from lakeward.plans.tables import Tables
from lakeward.plans.warehouse import AS_OF

CODE = L.STOCK_PREFIX


def _text(sql: str) -> F.Column:
    return F.expr(sql).cast("string")


def production_context(spark: SparkSession, sf: str) -> ModelContext:
    t = Tables(spark, sf)
    subs = t.nation.select(F.explode(F.array(
        F.struct(_text("concat('D', n_nationkey)").alias("sub_project_id"), F.lit(L.DEFAULT_SUB_PROJECT).alias("sub_project_name")),
        F.struct(_text("concat('B', n_nationkey)").alias("sub_project_id"), F.lit("Building").alias("sub_project_name")))).alias("s"),
        _text("n_nationkey").alias("project_id")).select("s.*", "project_id")
    dims = {
        "dim_project": t.nation.select(_text("n_nationkey").alias("project_id"), F.col("n_name").alias("project_name")),
        "dim_sub_project": subs,
        "dim_repository": subs.select(_text("concat('R', sub_project_id)").alias("repository_id"), "sub_project_id",
                                      F.lit(L.DEFAULT_REPOSITORY).alias("repository_name")).unionByName(
            t.supplier.select(_text("s_suppkey").alias("repository_id"), _text("concat('D', s_nationkey)").alias("sub_project_id"),
                              F.col("s_name").alias("repository_name"))),
        "int_excluded_stock_codes": t.part.where("p_partkey % 13 = 0").select(_text(f"concat('{CODE}', p_partkey)").alias("hg_stock_id")),
    }
    where = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    home = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    nothing = F.lit(None).cast("string")
    sheets = {
        "purchase_order_line": t.lineitem.select(
            F.expr("l_orderkey * 10 + l_linenumber").alias("id"), F.expr("CASE WHEN l_returnflag = 'R' THEN l_orderkey END").alias("x_song_id"),
            F.col("l_shipdate").alias("write_date")),
        "x_music_song": t.orders.select(
            F.col("o_orderkey").alias("id"), F.expr("o_orderkey % 7 <> 0").alias("active"), _text("concat('S', o_orderkey)").alias("name"),
            F.col("o_orderpriority").alias("song_name"), F.expr("o_custkey % 150").alias("subgenre_id"), nothing.alias("review_score"),
            F.expr("cast(floor(o_totalprice) as bigint)").alias("review_price"), _text("cast(o_orderdate as date)").alias("review_date"),
            nothing.alias("detail_line_id"),
            F.expr("CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'draft' ELSE 'rejected' END").alias("state"),
            F.expr("o_orderkey % 8").alias("produce_state"), F.col("o_custkey").alias("sale_order_id"),
            F.expr("CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey END").alias("purchase_order_line_id"),
            F.expr(f"CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN lower(concat('{CODE}', o_orderkey)) "
                   f"ELSE concat('{CODE}', o_orderkey) END").alias("hg_code")),
        "purchased_resource": t.part.join(t.supplier, F.expr("p_partkey % 120 + 1 = s_suppkey"), "left").select(
            _text(f"concat('{CODE}', p_partkey)").alias(L.PURCHASED_CODE_COL), F.col("p_name").alias(L.TITLE_COL),
            F.expr("CASE WHEN p_partkey % 4 = 0 THEN concat('FILE  ', s_suppkey) ELSE s_name END").alias(L.PURCHASED_REPO_COL)),
        "repository_partner_map": t.supplier.where("s_suppkey % 2 = 0").select(
            F.col("s_name").alias("partner_name"), _text("concat('File ', s_suppkey, '.xlsx')").alias("kho_name")),
        "partner_projects": home.where("s_suppkey % 3 <> 0").select(F.col("s_name").alias("partner_name"), F.col("n_name").alias("project_name")),
        "partners_without_repository": t.supplier.where("s_suppkey % 10 = 0").select(F.col("s_name").alias("partner_name")),
        "partners": t.supplier.select(F.col("s_name").alias(L.PARTNER_REPO_COL),
                                      F.expr("CASE WHEN s_suppkey % 5 = 0 THEN ' ' ELSE concat('Rate ', s_suppkey % 4) END").alias(L.PRICING_COL)),
        "resource_before_odoo": t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            _text("concat('IS', c_custkey)").alias(L.RBO_ISRC_COL), _text("concat('M', c_custkey)").alias(L.SONG_CODE_COL),
            F.col("c_name").alias(L.RBO_TITLE_COL), _text("c_custkey % 10").alias(L.AVG_SCORE_COL),
            _text("concat(c_custkey * 7, ',5')").alias(L.UNIT_COST_COL),
            F.expr(f"CASE WHEN c_custkey % 9 = 0 THEN '{L.STOCK_NOT_FOUND}' ELSE concat('{CODE}', c_custkey * 2) END").alias(L.RBO_STOCK_COL),
            F.lower("n_name").alias(L.GENRE_COL), F.lit(" BUILDING ").alias(L.SUBGENRE_COL),
            F.expr("CASE WHEN c_custkey % 4 = 0 THEN '2026-01-01' ELSE '2025-08-31' END").alias(L.RBO_ACCEPTED_COL),
            F.expr(f"CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE '{L.STATUS_ACCEPTED} 1' END").alias(L.RBO_STATUS_COL)),
        "resource_performance": where.where("o_orderkey % 11 = 0").select(
            _text(f"concat('{CODE}', o_orderkey)").alias(L.PERF_STOCK_COL), *[nothing.alias(c) for c in L.PERF_ISRC_COLS[:2]],
            F.expr("CASE WHEN o_orderkey % 2 = 0 THEN concat('IS', o_orderkey) END").alias(L.PERF_ISRC_COLS[2]), nothing.alias(L.PERF_SONG_COL),
            F.col("o_orderpriority").alias(L.PERF_NAME_COL), F.lower("n_name").alias(L.PERF_PROJECT_COL),
            F.expr("CASE WHEN o_custkey % 2 = 0 THEN 'building' ELSE '#N/A' END").alias(L.PERF_SUB_PROJECT_COL), nothing.alias(L.PERF_REPO_COL),
            F.lit("n").alias(L.PERF_SCORE_COL), _text("concat('$', cast(floor(o_totalprice) as bigint) * 10)").alias(L.PERF_COST_COL),
            _text("cast(o_orderdate as date)").alias(L.RBO_ACCEPTED_COL)),
        "resource_infomation_add": where.join(t.supplier, F.expr("o_custkey % 100 + 1 = s_suppkey"), "left").where("o_orderkey % 13 = 0").select(
            _text(f"lower(concat('{CODE}', o_orderkey))").alias(L.RESOURCE_FILE_COL), _text("concat('A', o_orderkey)").alias(L.TITLE_COL),
            F.col("n_name").alias(L.PROJECT_COL), F.lit("không có").alias(L.SUB_PROJECT_COL), F.col("s_name").alias(L.REPO_COL)),
    }
    return ModelContext(spark, sheets, AS_OF, provided=dims)


#: Amounts in cents, halves rounded up, as DECIMAL.
def _cents(x: str) -> str:
    return f"(CAST({x} AS BIGINT) / 100.0)::DECIMAL(18,2)"


RESOURCES_SQL = f"""
WITH repo AS (
  SELECT 'R' || x || n_nationkey AS id, NULL AS name FROM nation, (VALUES ('D'), ('B')) v(x)
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier),
line AS (SELECT l_orderkey AS k, CAST(arg_max(l_orderkey * 10 + l_linenumber, (l_shipdate, l_orderkey * 10 + l_linenumber)) AS VARCHAR) AS line
         FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
song AS (
  SELECT 'odoo' AS src, CAST(o_orderkey AS VARCHAR) AS sid, CAST(o_orderkey AS VARCHAR) AS odoo, 'S' || o_orderkey AS song, o_orderpriority AS title,
         CAST(o_custkey % 150 AS VARCHAR) AS repo, '{L.PRODUCTION_REPOSITORY}' AS kind, NULL::DECIMAL(18,2) AS score,
         CASE WHEN floor(o_totalprice) > 1000 THEN {_cents('(2 * 100 * floor(o_totalprice)::BIGINT + 25000) // 50000')}
              ELSE floor(o_totalprice)::DECIMAL(18,2) END AS cost,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day,
         CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 8 = 6 THEN '{L.STATUS_NOT_ACCEPTED}' ELSE '{L.STATUS_ACCEPTED}' END
              WHEN 'O' THEN '{L.STATUS_IN_PRODUCTION}' ELSE '{L.STATUS_NOT_ACCEPTED}' END AS status,
         CAST(o_custkey AS VARCHAR) AS so, CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_orderkey AS VARCHAR) ELSE line END AS po,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN lower('{CODE}' || o_orderkey) ELSE '{CODE}' || o_orderkey END AS code
  FROM orders LEFT JOIN line ON k = o_orderkey WHERE o_orderkey % 7 <> 0),
named AS (SELECT p_partkey, p_name, p_partkey % 4 = 0 AS file, s_suppkey AS s, s_nationkey AS n
          FROM part LEFT JOIN supplier ON s_suppkey = p_partkey % 120 + 1),
bought AS (
  SELECT 'purchased', '{CODE}' || p_partkey, NULL, NULL, p_name,
         CASE WHEN file THEN CASE WHEN s % 2 = 0 THEN CAST(s AS VARCHAR) END
              WHEN s % 3 <> 0 AND s % 10 = 0 THEN 'RD' || n ELSE CAST(s AS VARCHAR) END,
         CASE WHEN s % 5 <> 0 AND (NOT file OR s % 2 = 0) THEN 'Rate ' || (s % 4) END,
         NULL, NULL, NULL, '{L.STATUS_ACCEPTED}', NULL, NULL, '{CODE}' || p_partkey FROM named),
older AS (
  SELECT 'before_odoo', 'IS' || c_custkey, NULL, 'M' || c_custkey, c_name, 'RB' || c_nationkey, '{L.PRODUCTION_REPOSITORY}',
         (c_custkey % 10)::DECIMAL(18,2),
         CASE WHEN c_custkey * 7 + 0.5 > 1000 THEN {_cents('(2 * (c_custkey * 700 + 50) + 25000) // 50000')} ELSE (c_custkey * 7 + 0.5)::DECIMAL(18,2) END,
         TIMESTAMP '2025-08-31', '{L.STATUS_ACCEPTED} 1', NULL, NULL, '{CODE}' || (c_custkey * 2)
  FROM customer WHERE c_custkey % 9 <> 0 AND c_custkey % 4 <> 0 AND c_custkey % 3 <> 0),
base AS (FROM song UNION ALL FROM bought UNION ALL FROM older),
perf AS (
  SELECT 'performance' AS src, CASE WHEN o_orderkey % 2 = 0 THEN 'IS' ELSE '{CODE}' END || o_orderkey AS sid, o_orderpriority AS title,
         CASE WHEN o_custkey % 2 = 0 THEN 'RB' ELSE 'RD' END || c_nationkey AS repo, 0::DECIMAL(18,2) AS score,
         CASE WHEN floor(o_totalprice) * 10 > 1000000 THEN {_cents('(2 * 1000 * floor(o_totalprice)::BIGINT + 25000) // 50000')}
              ELSE (floor(o_totalprice) * 10)::DECIMAL(18,2) END AS cost,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day, '{CODE}' || o_orderkey AS code
  FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 11 = 0),
added AS (
  SELECT lower('{CODE}' || o_orderkey) AS sid, 'A' || o_orderkey AS title, '{CODE}' || o_orderkey AS key,
         CASE WHEN s_suppkey IS NULL THEN 'RD' || c_nationkey ELSE CAST(s_suppkey AS VARCHAR) END AS repo
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = o_custkey % 100 + 1 WHERE o_orderkey % 13 = 0),
every AS (
  SELECT b.src, b.sid, b.odoo, b.song, coalesce(a.title, b.title) AS title, coalesce(p.repo, a.repo, b.repo) AS repo, b.kind,
         coalesce(b.score, p.score) AS score, coalesce(b.cost, p.cost) AS cost, coalesce(b.day, p.day) AS day,
         CASE WHEN p.code IS NOT NULL OR a.sid IS NOT NULL THEN '{L.STATUS_ACCEPTED}' ELSE b.status END AS status, b.so, b.po, b.code
  FROM base b LEFT JOIN perf p ON p.code = b.code LEFT JOIN added a ON a.key = upper(b.code)
  UNION ALL
  SELECT p.src, p.sid, NULL, NULL, coalesce(a.title, p.title), coalesce(p.repo, a.repo), NULL, p.score, p.cost, p.day, '{L.STATUS_ACCEPTED}', NULL, NULL, p.code
  FROM perf p LEFT JOIN added a ON a.key = p.code WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.code = p.code)
  UNION ALL
  SELECT 'resource_information_add', a.sid, NULL, NULL, a.title, a.repo, NULL, NULL, NULL, NULL, '{L.STATUS_ACCEPTED}', NULL, NULL, a.sid
  FROM added a WHERE NOT EXISTS (SELECT 1 FROM base b WHERE upper(b.code) = a.key) AND NOT EXISTS (SELECT 1 FROM perf p WHERE p.code = a.key))
SELECT md5(src || '-' || sid) AS dim_resources_sk, src AS resource_source, odoo AS odoo_id, song AS song_code, title AS resource_name,
       r.id AS repository_id, kind AS repository_type, score AS acceptance_score, cost AS acceptance_cost, day AS acceptance_date,
       CAST(NULL AS VARCHAR) AS production_plan_detail_id, status, so AS so_id, po AS po_detail_id, code AS hg_stock_id
FROM every LEFT JOIN repo r ON r.id = every.repo
WHERE code IS NULL OR NOT EXISTS (SELECT 1 FROM part WHERE p_partkey % 13 = 0 AND '{CODE}' || p_partkey = upper(code))
"""


@query("wh_dim_resources", "2.14 dim_resources: PRJ-6/7/8/9/11/12, FLT-2/5/6, JN-2/5/6/15/16, AGG-11, WIN-2/3, SET-1", sql=RESOURCES_SQL)
def wh_dim_resources(spark: SparkSession, sf: str) -> DataFrame:
    return production_context(spark, sf).ref("dim_resources")


def flow_context(spark: SparkSession, sf: str) -> ModelContext:
    """Orders are resources of 20 order lines, parts are stock: a part's code is
    its resource's, its ISRC that of the orders released with it."""
    t = Tables(spark, sf)
    null = lambda kind: F.lit(None).cast(kind)
    stamp = lambda c: F.col(c).cast("date").cast("timestamp")
    part = "o_orderkey % 400 + 1"
    dims = {
        "dim_repository": t.supplier.select(_text("s_suppkey").alias("repository_id"), _text("s_nationkey").alias("sub_project_id")),
        "dim_sub_project": t.nation.select(_text("n_nationkey").alias("sub_project_id"), _text("n_regionkey").alias("project_id")),
        "dim_so": t.customer.select(_text("c_custkey").alias("so_id"), _text("c_custkey % 40").alias("po_id")),
        "dim_po": t.nation.select(_text("n_nationkey").alias("po_id"), F.col("n_name").alias("ordering_company")),
        "fact_so_detail": t.customer.select(
            _text("CASE WHEN c_custkey % 5 <> 0 THEN c_custkey * 3 END").alias("so_detail_id"), _text("c_custkey").alias("so_id"),
            _text("CASE WHEN c_custkey % 7 = 0 THEN '' ELSE string(c_custkey % 150) END").alias("repository"),
            F.expr("c_custkey % 4").alias("production_qty"), F.expr("c_custkey % 6").alias("song_qty")),
        "dim_resource": t.orders.select(
            _text("o_orderkey").alias("resource_id"),
            F.expr(f"CASE WHEN o_orderstatus = 'F' THEN '{L.STATUS_ACCEPTED}' WHEN o_orderstatus = 'O' THEN '{L.STATUS_IN_PRODUCTION}' END").alias("status"),
            _text("o_custkey").alias("so_id"), _text("o_orderkey * 2").alias("po_detail_id"), null("string").alias("production_plan_detail_id"),
            _text("o_custkey % 150").alias("repository_id")),
        "fact_label_operation": t.orders.where("o_orderkey % 2 = 0").select(
            _text("o_orderkey").alias("resource_id"), _text(f"concat('IS', {part})").alias("isrc"),
            F.expr("CASE WHEN o_orderkey % 4 = 0 THEN 'sent' ELSE 'draft' END").alias("release_status"),
            F.expr("CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate END").cast("timestamp").alias("release_date")),
        "dim_resources": t.orders.where("o_orderkey % 3 = 0").select(
            _text("o_orderkey").alias("odoo_id"), _text(f"concat('{CODE}', {part} + 50)").alias("hg_stock_id")),
        "dim_stock": t.part.select(
            _text(f"concat('{CODE}', p_partkey)").alias("hg_stock_id"), _text("concat('IS', p_partkey % 300)").alias("isrc"),
            F.expr("make_date(2020, p_size % 12 + 1, 1)").cast("timestamp").alias("stock_stored_date"),
            F.expr(f"CASE WHEN p_partkey % 3 = 0 THEN '{L.STOCK_IN_USE}' ELSE '{L.STOCK_COLD}' END").alias("status")),
        "fact_youtube_operation": t.part.where("p_partkey % 4 = 0").select(
            _text(f"concat('{CODE}', p_partkey)").alias("hg_stock_id"), _text("p_partkey % 60").alias("channel_id"), F.lit("net").alias("net")),
        "dim_channel": t.customer.where("c_custkey < 50").select(
            _text("c_custkey").alias("channel_id"), F.col("c_mktsegment").alias("company_id"), _text("c_nationkey").alias("project_id"),
            null("string").alias("sub_project_id"), _text("CASE WHEN c_custkey % 2 = 0 THEN c_custkey END").alias("network_id")),
        "fact_revenue_distro": t.lineitem.select(_text("concat('IS', l_partkey)").alias("isrc"), F.col("l_returnflag").alias("platform")).where("platform in ('A', 'R')"),
        "fact_view_stream_distro": t.lineitem.where("l_quantity > 49").select(_text("concat('IS', l_partkey)").alias("isrc"), F.lit("A").alias("platform")),
        "fact_revenue_by_resources": t.lineitem.where("l_linenumber = 1").select(
            _text(f"concat('{CODE}', l_partkey)").alias("resource_id"), stamp("l_shipdate").alias("recorded_date"),
            F.expr("CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE 0 END").alias("view"), null("double").alias("revenue_amount")),
    }
    return ModelContext(spark, {}, AS_OF, provided=dims)


FLOW_SQL = f"""
WITH repo AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, CAST(s_nationkey AS VARCHAR) AS sub, CAST(n_regionkey AS VARCHAR) AS project
              FROM supplier JOIN nation ON n_nationkey = s_nationkey),
so AS (SELECT CAST(c_custkey AS VARCHAR) AS so, CAST(c_custkey % 40 AS VARCHAR) AS po, n_name AS company
       FROM customer LEFT JOIN nation ON n_nationkey = c_custkey % 40),
ordered AS (
  SELECT 1 AS step, 'OD->SX' AS name, 'OD_SX' AS prefix, o AS st, coalesce(CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey * 3 AS VARCHAR) END, so) AS item,
         so, po, repo.id AS repo, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 150 AS VARCHAR) END AS repo_id, sub, project, company,
         CASE o WHEN 1 THEN least(c_custkey % 4, c_custkey % 6) ELSE greatest(c_custkey % 6 - c_custkey % 4, 0) END AS amount
  FROM customer JOIN so ON so = CAST(c_custkey AS VARCHAR), (VALUES (1), (2)) v(o)
  LEFT JOIN repo ON repo.id = CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 150 AS VARCHAR) END),
stock AS (SELECT '{CODE}' || p_partkey AS hg, 'IS' || (p_partkey % 300) AS isrc, CAST(make_date(2020, p_size % 12 + 1, 1) AS TIMESTAMP) AS stored,
                 p_partkey % 3 = 0 AS used FROM part),
best AS (SELECT isrc, first(hg ORDER BY NOT used, stored, hg) AS hg, min(stored) AS stored, bool_or(used) AS used FROM stock GROUP BY isrc),
res AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS rid, CASE o_orderstatus WHEN 'F' THEN true ELSE false END AS accepted, CAST(o_custkey AS VARCHAR) AS so,
         CAST(o_orderkey * 2 AS VARCHAR) AS po_detail, CAST(o_custkey % 150 AS VARCHAR) AS repo_id,
         o_orderkey % 2 = 0 AND (o_orderkey % 4 = 0 OR o_orderkey % 6 = 0) AS published,
         CASE WHEN o_orderkey % 3 = 0 THEN '{CODE}' || (o_orderkey % 400 + 51) END AS own, 'IS' || (o_orderkey % 400 + 1) AS released
  FROM orders),
item AS (
  SELECT r.rid, r.accepted, r.so, so.po, so.company, r.po_detail, r.repo_id, repo.sub, repo.project, r.published,
         coalesce(r.own, b.hg) AS hg, coalesce(CASE WHEN published THEN released END, s.isrc) AS isrc,
         coalesce(s.stored, b.stored) AS stored, coalesce(s.used, false) OR coalesce(b.used, false) AS used
  FROM res r LEFT JOIN repo ON repo.id = r.repo_id LEFT JOIN so ON so.so = r.so
  LEFT JOIN stock s ON s.hg = r.own LEFT JOIN best b ON r.published AND b.isrc = r.released),
tube AS (SELECT DISTINCT '{CODE}' || p_partkey AS hg, CAST(p_partkey % 60 AS VARCHAR) AS channel, c_mktsegment AS company, CAST(c_nationkey AS VARCHAR) AS project,
                CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'net' END AS net
         FROM part LEFT JOIN customer ON c_custkey = p_partkey % 60 AND c_custkey < 50 WHERE p_partkey % 4 = 0),
air AS (SELECT DISTINCT 'IS' || l_partkey AS isrc, CASE WHEN l_returnflag IN ('A', 'R') THEN l_returnflag END AS platform FROM lineitem
        UNION SELECT 'IS' || l_partkey, 'A' FROM lineitem WHERE l_quantity > 49),
plat AS (SELECT DISTINCT hg, platform FROM stock JOIN air USING (isrc) WHERE platform IS NOT NULL),
users AS (SELECT coalesce(t.hg, p.hg) AS hg, channel, company, project, net, platform FROM tube t FULL JOIN plat p ON p.hg = t.hg),
earned AS (SELECT '{CODE}' || l_partkey AS hg, min(CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)) AS first FROM lineitem
           WHERE l_linenumber = 1 AND l_partkey % 2 = 0 GROUP BY 1),
all_of AS (SELECT i.*, u.channel, u.company AS s_company, u.project AS s_project, u.net, u.platform, e.first
           FROM item i LEFT JOIN users u ON u.hg = i.hg LEFT JOIN earned e ON e.hg = i.hg),
steps AS (
  SELECT *, 2 AS step, 'SX->NT' AS name, 'SX_NT' AS prefix, accepted AS done, NULL::TIMESTAMP AS recorded FROM all_of
  UNION ALL SELECT *, 3, 'NT->PP', 'NT_PP', published, NULL FROM all_of WHERE accepted
  UNION ALL SELECT *, 4, 'PP->SD', 'PP_SD', used, NULL FROM all_of WHERE published
  UNION ALL SELECT *, 5, 'SD->KQ', 'SD_KQ', first IS NOT NULL, first FROM all_of WHERE published AND used AND hg IS NOT NULL)
SELECT step AS step_order, name AS buoc, st AS status_order, CASE st WHEN 1 THEN '{L.DONE}' ELSE '{L.NOT_DONE}' END AS tinh_trang,
       prefix || ':' || st || ':' || item AS flow_item_key, NULL::VARCHAR AS resource_id, NULL::VARCHAR AS hg_stock_id, NULL::VARCHAR AS isrc,
       so AS so_id, po AS po_id, NULL::VARCHAR AS po_detail_id, NULL::VARCHAR AS channel_id, repo_id AS repository_id,
       sub AS production_sub_project_id, project AS production_project_id, NULL::VARCHAR AS stock_sub_project_id, NULL::VARCHAR AS stock_project_id,
       sub AS sub_project_id, project AS project_id, company AS order_company_id, NULL::VARCHAR AS stock_company_id, company AS company_id,
       NULL::VARCHAR AS net_id, NULL::VARCHAR AS platform, NULL::TIMESTAMP AS stock_stored_date, NULL::TIMESTAMP AS recorded_date,
       amount::DECIMAL(38,6) AS so_luong FROM ordered WHERE amount <> 0
UNION ALL
SELECT step, name, CASE WHEN done THEN 1 ELSE 2 END, CASE WHEN done THEN '{L.DONE}' ELSE '{L.NOT_DONE}' END,
       prefix || ':' || CASE WHEN done THEN 1 ELSE 2 END || ':' || rid, rid, hg, isrc, so, po, po_detail, channel, repo_id, sub, project, NULL, s_project,
       sub, coalesce(s_project, project), company, s_company, coalesce(s_company, company), net, platform, stored, recorded, 1 FROM steps
"""


@query("wh_fact_hao_hut", "2.14 fact_hao_hut: PRJ-8/15/19/20, FLT-6/8, JN-2/3, AGG-4/8, SET-1/2/3, GEN-5", sql=FLOW_SQL)
def wh_fact_hao_hut(spark: SparkSession, sf: str) -> DataFrame:
    return flow_context(spark, sf).ref("fact_hao_hut")
