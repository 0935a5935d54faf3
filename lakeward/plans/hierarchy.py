"""Sub-projects and repositories on staging sheets derived from the driver tables (2.14).

Nations and regions are projects (regions with ids that are no numbers);
suppliers are sub-projects of their nation in the order system, part brands,
customer segments and order priorities name further ones on the sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.models import ModelContext
from lakeward.models import labels as L
from lakeward.plans.registry import query
from lakeward.plans.tables import Tables
from lakeward.plans.warehouse import AS_OF


def hierarchy_context(spark: SparkSession, sf: str) -> ModelContext:
    t = Tables(spark, sf)
    text = lambda c: F.col(c).cast("string")
    projects = t.nation.select(text("n_nationkey").alias("project_id"), F.col("n_name").alias("project_name")).unionByName(
        t.region.select(F.concat(F.lit("R"), "r_regionkey").alias("project_id"), F.col("r_name").alias("project_name")))
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    fourth, third = F.col("c_custkey") % 4, F.col("c_custkey") % 3
    sheets = {
        "x_project": t.nation.select(F.col("n_nationkey").alias("id"), F.concat(F.lit("  "), "n_name").alias("name")),
        "x_product_genre": t.supplier.select(
            F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("project_id"), F.col("s_name").alias("name"),
            F.lit(None).cast("string").alias("description"),
            F.when(F.col("s_suppkey") % 5 == 0, "film").otherwise("music").alias("order_type")),
        "resource_before_odoo": t.part.join(t.region, F.col("p_size") % 5 == F.col("r_regionkey")).select(
            F.upper("r_name").alias(L.GENRE_COL), F.regexp_replace("p_brand", "#", "  # ").alias(L.SUBGENRE_COL)),
        "resource_performance": people.select(
            F.col("n_name").alias(L.PERF_PROJECT_COL),
            F.when(fourth == 0, "#N/A").when(fourth == 1, "Không có").otherwise(F.col("c_mktsegment")).alias(L.PERF_SUB_PROJECT_COL),
            F.when(third == 1, "AUDIOJUNGLE").when(third == 2, F.col("c_mktsegment")).alias(L.PERF_REPO_COL)),
        "distro_infomation": t.orders.join(t.region, F.col("o_custkey") % 5 == F.col("r_regionkey")).select(
            F.col("r_name").alias(L.PROJECT_COL), F.col("o_orderpriority").alias(L.SUB_PROJECT_COL),
            F.col("o_orderstatus").alias(L.REPO_COL)),
        "resource_infomation_add": people.select(
            F.lower("n_name").alias(L.PROJECT_COL), F.lower("c_mktsegment").alias(L.SUB_PROJECT_COL),
            F.col("c_mktsegment").alias(L.REPO_COL)),
        "x_product_subgenre": t.part.select(
            F.col("p_partkey").alias("id"), (F.col("p_partkey") % 50 + 1).alias("product_genre_id"), F.col("p_name").alias("name"),
            F.lit("music").alias("order_type")),
        "partners": t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_name").alias(L.PARTNER_NAME_COL), F.col("n_name").alias(L.PROJECT_COL)),
    }
    return ModelContext(spark, sheets, AS_OF, provided={"dim_project": projects})


#: Who names what under whom: sub-projects (id, parent, name, note).
SUBS = f"""
WITH seen AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id, CAST(s_nationkey AS VARCHAR) AS parent, s_name AS name, CAST(NULL AS VARCHAR) AS note
  FROM supplier WHERE s_suppkey % 5 <> 0
  UNION SELECT NULL, 'R' || (p_size % 5), replace(p_brand, '#', ' # '), NULL FROM part
  UNION SELECT NULL, CAST(c_nationkey AS VARCHAR), CASE WHEN c_custkey % 4 < 2 THEN '{L.DEFAULT_SUB_PROJECT}' ELSE c_mktsegment END, NULL
  FROM customer),
known AS (SELECT coalesce(id, md5(parent || '-' || name)) AS id, parent, name, note FROM seen),
late AS (SELECT DISTINCT 'R' || (o_custkey % 5) AS parent, o_orderpriority AS name FROM orders
         UNION SELECT CAST(c_nationkey AS VARCHAR), lower(c_mktsegment) FROM customer),
named AS (
  FROM known UNION ALL
  SELECT md5(parent || '-' || lower(name)), parent, name, NULL FROM late l
  WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.parent = l.parent AND lower(k.name) = lower(l.name)))
FROM named UNION ALL
SELECT md5(parent || '-{L.DEFAULT_SUB_PROJECT}'), parent, '{L.DEFAULT_SUB_PROJECT}', NULL
FROM (SELECT CAST(n_nationkey AS VARCHAR) AS parent FROM nation UNION SELECT 'R' || r_regionkey FROM region)
WHERE parent NOT IN (SELECT parent FROM named WHERE name = '{L.DEFAULT_SUB_PROJECT}')
"""

SUB_SQL = f"""
SELECT md5(id) AS dim_sub_project_sk, id AS sub_project_id, parent AS project_id, name AS sub_project_name, note AS description
FROM ({SUBS})"""

REPO_SQL = f"""
WITH subs AS ({SUBS}),
sheet AS (
  SELECT DISTINCT s.id AS parent, CASE c_custkey % 3 WHEN 0 THEN '{L.DEFAULT_REPOSITORY}' WHEN 1 THEN '{L.AUDIOJUNGLE}' ELSE c_mktsegment END AS name
  FROM customer JOIN subs s ON s.parent = CAST(c_nationkey AS VARCHAR)
   AND s.name = CASE WHEN c_custkey % 4 < 2 THEN '{L.DEFAULT_SUB_PROJECT}' ELSE c_mktsegment END),
partner AS (SELECT DISTINCT s.id AS parent, s_name AS name FROM supplier JOIN subs s ON s.parent = CAST(s_nationkey AS VARCHAR)
            WHERE s.name = '{L.DEFAULT_SUB_PROJECT}'),
known AS (
  SELECT CAST(min(p_partkey) AS VARCHAR) AS id, CAST(p_partkey % 50 + 1 AS VARCHAR) AS parent, arg_min(p_name, p_partkey) AS name
  FROM part GROUP BY p_partkey % 50 + 1, lower(p_name)
  UNION ALL SELECT md5(name || '-' || parent), parent, name FROM (FROM sheet UNION FROM partner)),
late AS (
  SELECT DISTINCT s.id AS parent, o_orderstatus AS name FROM orders JOIN subs s
  ON s.parent = 'R' || (o_custkey % 5) AND s.name = o_orderpriority
  UNION SELECT s.id, c_mktsegment FROM customer JOIN subs s ON s.parent = CAST(c_nationkey AS VARCHAR) AND lower(s.name) = lower(c_mktsegment)),
named AS (
  FROM known UNION ALL
  SELECT md5(parent || '-' || lower(name)), parent, name FROM late l
  WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.parent = l.parent AND lower(k.name) = lower(l.name))),
every AS (
  FROM named UNION ALL SELECT md5(id || '-{L.DEFAULT_REPOSITORY}'), id, '{L.DEFAULT_REPOSITORY}' FROM subs
  WHERE id NOT IN (SELECT parent FROM named WHERE name = '{L.DEFAULT_REPOSITORY}'))
SELECT md5(id) AS dim_repository_sk, id AS repository_id, parent AS sub_project_id, name AS repository_name FROM every
"""


@query("wh_dim_sub_project", "2.14 dim_sub_project: WIN-2, JN-5/9/17, PRJ-4/7, GEN-7", sql=SUB_SQL)
def wh_dim_sub_project(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy_context(spark, sf).ref("dim_sub_project")


@query("wh_dim_repository", "2.14 dim_repository: WIN-2, JN-5/9, PRJ-7, GEN-7", sql=REPO_SQL)
def wh_dim_repository(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy_context(spark, sf).ref("dim_repository")
