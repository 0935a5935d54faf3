"""Join, lookup and entity-resolution queries (JN-*, AGG-6/7/11, GEN-1/7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.dedup import first_by, unique_name_lookup
from lakeward.operators.entities import canonicalise_entities, resolve_level
from lakeward.operators.generate import add_default_member, values_relation
from lakeward.operators.joins import (exclude_keys, exists, full_outer_coalesce,
                                      left_residual, list_lookup_agg, not_exists)
from lakeward.operators.ordering import asc
from lakeward.plans.ranking import LINE_ORDER, LINE_ORDER_SQL
from lakeward.plans.registry import query
from lakeward.plans.tables import Tables

# The quarter used by the EXISTS / NOT EXISTS demonstrations.
Q_START, Q_END = dt.datetime(1998, 1, 1), dt.datetime(1998, 4, 1)


def ntz(d: dt.datetime):
    return F.lit(d).cast("timestamp_ntz")


def orders_in_quarter(t: Tables) -> DataFrame:
    return (t.orders.filter((F.col("o_orderdate") >= ntz(Q_START)) & (F.col("o_orderdate") < ntz(Q_END)))
            .select(F.col("o_custkey").alias("c_custkey")))


@query("semi_exists", "JN-4", sql="""
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
              AND o.o_orderdate >= TIMESTAMP '1998-01-01' AND o.o_orderdate < TIMESTAMP '1998-04-01')
""")
def semi_exists(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return exists(t.customer.select("c_custkey", "c_name"), orders_in_quarter(t), ["c_custkey"])


@query("anti_not_exists", "JN-5", sql="""
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_orderdate >= TIMESTAMP '1998-01-01' AND o.o_orderdate < TIMESTAMP '1998-04-01')
""")
def anti_not_exists(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return not_exists(t.customer.select("c_custkey", "c_name"), orders_in_quarter(t), ["c_custkey"])


@query("exclude_keys", "JN-6", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
LEFT JOIN (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0) x
  ON o.o_custkey = x.c_custkey
WHERE x.c_custkey IS NULL
""")
def q_exclude_keys(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    excluded = t.customer.filter((F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_acctbal") < 0))
    return exclude_keys(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), excluded,
                        "o_custkey", "c_custkey")


@query("full_outer_coalesce", "JN-3", sql="""
WITH c AS (SELECT c_nationkey AS n_nationkey, CAST(count(*) AS BIGINT) AS customers FROM customer
           WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 9000 GROUP BY 1),
s AS (SELECT s_nationkey AS n_nationkey, CAST(count(*) AS BIGINT) AS suppliers FROM supplier
      WHERE s_acctbal > 5000 GROUP BY 1)
SELECT CAST(coalesce(c.n_nationkey, s.n_nationkey) AS INTEGER) AS n_nationkey, customers, suppliers
FROM c FULL OUTER JOIN s ON c.n_nationkey = s.n_nationkey
""")
def q_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    c = (t.customer.filter((F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_acctbal") > 9000))
         .groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers")))
    s = (t.supplier.filter(F.col("s_acctbal") > 5000)
         .groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers")))
    return full_outer_coalesce(c, s, "n_nationkey").select("n_nationkey", "customers", "suppliers")


# Priorities that have a reference row of their own.
RULED_PRIORITIES = ("1-URGENT", "2-HIGH")


@query("or_residual_join", "JN-8, JN-7, WIN-3", sql="""
WITH oc AS (SELECT o_orderkey, o_orderpriority, o_totalprice, c_nationkey
            FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT c_nationkey AS r_nation, o_orderpriority AS r_priority, avg(o_totalprice) AS r_avg
      FROM oc WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2
      UNION ALL
      SELECT c_nationkey, NULL, avg(o_totalprice) FROM oc GROUP BY 1),
m AS (SELECT oc.o_orderkey, r.r_priority, r.r_avg,
             row_number() OVER (PARTITION BY oc.o_orderkey ORDER BY r.r_priority IS NULL) AS rn
      FROM oc JOIN r ON oc.c_nationkey = r.r_nation
                    AND (r.r_priority IS NULL OR r.r_priority = oc.o_orderpriority))
SELECT o_orderkey, CASE WHEN r_priority IS NULL THEN 'nation' ELSE 'priority' END AS rule_level,
       round(r_avg, 2) AS reference_avg
FROM m WHERE rn = 1
""")
def or_residual_join(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    oc = (t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
          .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"))
    by_pri = (oc.filter(F.col("o_orderpriority").isin(*RULED_PRIORITIES))
              .groupBy(F.col("c_nationkey").alias("r_nation"), F.col("o_orderpriority").alias("r_priority"))
              .agg(F.avg("o_totalprice").alias("r_avg")))
    by_nat = oc.groupBy(F.col("c_nationkey").alias("r_nation")).agg(F.avg("o_totalprice").alias("r_avg")) \
               .select("r_nation", F.lit(None).cast("string").alias("r_priority"), "r_avg")
    rules = by_pri.unionByName(by_nat)
    residual = F.col("r_priority").isNull() | (F.col("r_priority") == F.col("o_orderpriority"))
    m = left_residual(oc, rules, [("c_nationkey", "r_nation")], residual, how="inner")
    best = first_by(m.select("o_orderkey", "r_priority", "r_avg"), ["o_orderkey"],
                    [asc(F.col("r_priority").isNull())])
    return best.select("o_orderkey",
                       F.when(F.col("r_priority").isNull(), "nation").otherwise("priority").alias("rule_level"),
                       F.round("r_avg", 2).alias("reference_avg"))


@query("unique_name_lookup", "AGG-11, FLT-7", sql="""
SELECT p_name || '|' || p_brand || '|' || CAST(p_size AS VARCHAR) AS name_key, min(p_partkey) AS resolved_id
FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) = 1
""")
def q_unique_name_lookup(spark: SparkSession, sf: str) -> DataFrame:
    p = Tables(spark, sf).part
    key = F.concat_ws("|", "p_name", "p_brand", F.col("p_size").cast("string"))
    return unique_name_lookup(p, key, "p_partkey")


@query("correlated_top1", "JN-17, JN-2", sql=f"""
WITH best AS (
  SELECT l_partkey, l_orderkey, l_extendedprice / l_quantity AS unit_price,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice / l_quantity, l_orderkey, {LINE_ORDER_SQL}) AS rn
  FROM lineitem)
SELECT p_partkey, p_name, b.l_orderkey AS best_orderkey, b.unit_price AS best_unit_price
FROM part LEFT JOIN best b ON b.l_partkey = p_partkey AND b.rn = 1
""")
def correlated_top1(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    li = t.lineitem.withColumn("unit_price", F.col("l_extendedprice") / F.col("l_quantity"))
    best = first_by(li, ["l_partkey"], [asc("unit_price"), asc("l_orderkey")] + [asc(c) for c in LINE_ORDER])
    b = best.select(F.col("l_partkey").alias("p_partkey"), F.col("l_orderkey").alias("best_orderkey"),
                    F.col("unit_price").alias("best_unit_price"))
    return t.part.select("p_partkey", "p_name").join(b, "p_partkey", "left")


@query("list_lookup_agg", "JN-18, GEN-3, AGG-7", sql="""
WITH l AS (SELECT l_orderkey, array_to_string(list_sort(list(l_suppkey)), ',') AS supplier_ids
           FROM lineitem GROUP BY l_orderkey),
e AS (SELECT l_orderkey, supplier_ids, pos,
             trim(string_split(supplier_ids, ',')[pos]) AS item
      FROM (SELECT *, unnest(generate_series(1, len(string_split(supplier_ids, ',')))) AS pos FROM l)),
n AS (SELECT l_orderkey, string_agg(s_name, ', ' ORDER BY pos) AS supplier_names
      FROM e JOIN supplier ON CAST(s_suppkey AS VARCHAR) = e.item GROUP BY l_orderkey)
SELECT l.l_orderkey, l.supplier_ids, n.supplier_names FROM l LEFT JOIN n ON l.l_orderkey = n.l_orderkey
""")
def q_list_lookup_agg(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    # the raw comma-separated id list column, as landed from the source system
    lists = (t.lineitem.groupBy("l_orderkey")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list("l_suppkey")),
                                           lambda x: x.cast("string")), ",").alias("supplier_ids")))
    return list_lookup_agg(lists, "l_orderkey", "supplier_ids", t.supplier, "s_suppkey", "s_name",
                           "supplier_names")


@query("string_agg_distinct", "AGG-6", sql="""
SELECT c_mktsegment, array_to_string(list_sort(list_distinct(list(n_name))), ', ') AS nation_names
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment
""")
def string_agg_distinct(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (t.customer.select("c_mktsegment", "c_nationkey").join(nation, "c_nationkey")
            .groupBy("c_mktsegment")
            .agg(F.array_join(F.array_sort(F.collect_set("n_name")), ", ").alias("nation_names")))


# Alternative spellings of the region names, as a hand-kept
# alias map (alias -> canonical name).
REGION_ALIASES = [("Afrika", "AFRICA"), ("The Americas", "AMERICA"), ("Asia Pacific", "ASIA"),
                  ("Europa", "EUROPE"), ("Mid-East", "MIDDLE EAST")]


def _messy_names(df: DataFrame, segment_col: str, region_col: str, nation_col: str) -> DataFrame:
    """Landed free-text region/nation names: lower-case with doubled and
    no-break spaces for one segment, alias spellings for another."""
    alias_of = F.create_map(*[x for a, c in REGION_ALIASES for x in (F.lit(c), F.lit(a))])
    region_txt = (F.when(F.col(segment_col) == "BUILDING",
                         F.concat(F.lit("  "), F.lower(F.regexp_replace(region_col, " ", "  ")), F.lit(" ")))
                  .when(F.col(segment_col) == "MACHINERY", F.element_at(alias_of, F.col(region_col)))
                  .otherwise(F.col(region_col)))
    nation_txt = (F.when(F.col(segment_col) == "FURNITURE", F.lower(nation_col))
                  .when(F.col(segment_col) == "HOUSEHOLD", F.concat(F.col(nation_col), F.lit("　")))
                  .otherwise(F.col(nation_col)))
    return df.withColumn("region_text", region_txt).withColumn("nation_text", nation_txt)


@query("resolve_hierarchy", "JN-15/16, JN-9, PRJ-5", sql="""
SELECT 'customer' AS entity, c_custkey AS entity_key, n_regionkey AS region_key, c_nationkey AS nation_key
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT 'supplier', s_suppkey, n_regionkey, s_nationkey
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def resolve_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    region, nation = t.region, t.nation
    names = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    cust = (t.customer.select(F.lit("customer").alias("entity"), F.col("c_custkey").alias("entity_key"),
                              F.col("c_nationkey").alias("nk"), F.col("c_mktsegment").alias("seg")))
    supp = (t.supplier.select(F.lit("supplier").alias("entity"), F.col("s_suppkey").alias("entity_key"),
                              F.col("s_nationkey").alias("nk"), F.lit("BUILDING").alias("seg")))
    raw = cust.unionByName(supp).join(names, F.col("nk") == F.col("n_nationkey"))
    raw = _messy_names(raw, "seg", "r_name", "n_name").select("entity", "entity_key", "region_text", "nation_text")
    aliases = values_relation(spark, REGION_ALIASES, "alias string, canonical string")
    lvl1 = resolve_level(raw, "region_text", region, "r_name", "r_regionkey", "region_key", aliases=aliases)
    lvl2 = resolve_level(lvl1, "nation_text", nation, "n_name", "n_nationkey", "nation_key",
                         parent=("region_key", "n_regionkey"))
    return lvl2.select("entity", "entity_key", "region_key", "nation_key")


# Alias spellings of part names (alias -> canonical name).
PART_NAME_ALIASES = [("crimson anvil", "red anvil"), ("crimson bolt", "red bolt"),
                     ("crimson gear", "red gear"), ("crimson gizmo", "red gizmo"),
                     ("crimson plate", "red plate"), ("crimson ring", "red ring"),
                     ("crimson rod", "red rod"), ("crimson widget", "red widget")]


def part_sources(t: Tables) -> DataFrame:
    """Three overlapping sources describing the same parts: the master list
    (numeric ids), a catalogue export (upper case, padded, prefixed ids) and a
    supplier sheet using alias names (hash-like ids)."""
    p = t.part
    master = p.select(F.lit(1).alias("source_priority"), F.col("p_partkey").cast("string").alias("id"),
                      F.col("p_name").alias("name"))
    export = p.select(F.lit(2).alias("source_priority"),
                      F.concat(F.lit("CAT-"), F.col("p_partkey").cast("string")).alias("id"),
                      F.concat(F.lit(" "), F.upper(F.regexp_replace("p_name", " ", "  ")), F.lit("\t")).alias("name"))
    sheet = p.select(F.lit(3).alias("source_priority"),
                     F.md5(F.col("p_partkey").cast("string")).alias("id"),
                     F.regexp_replace("p_name", "^red ", "crimson ").alias("name"))
    return master.unionByName(export).unionByName(sheet)


@query("canonicalise_entities", "PRJ-4/5, WIN-2, GEN-1, SET-1", sql="""
SELECT lower(p_name) AS name_key, CAST(min(p_partkey) AS VARCHAR) AS canonical_id, lower(p_name) AS canonical_name,
       CAST(3 * count(*) AS BIGINT) AS member_ids
FROM part GROUP BY p_name
""")
def q_canonicalise(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    aliases = values_relation(spark, PART_NAME_ALIASES, "alias string, canonical string")
    entities, _ = canonicalise_entities(part_sources(t), aliases=aliases)
    return entities


@query("default_member", "GEN-7, JN-5, AGG-10", sql="""
SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 9500 GROUP BY 1, 2
UNION ALL
SELECT DISTINCT c_nationkey, 'UNASSIGNED' FROM customer
""")
def q_default_member(spark: SparkSession, sf: str) -> DataFrame:
    c = Tables(spark, sf).customer
    children = c.filter(F.col("c_acctbal") > 9500).select("c_nationkey", "c_mktsegment").distinct()
    return add_default_member(children, c, "c_nationkey", "c_mktsegment", "UNASSIGNED")


@query("fx_lookup", "JN-19, AGG-12", sql="""
WITH rates AS (SELECT CAST(l_shipdate AS DATE) AS rate_date, CAST(20000 + count(*) AS BIGINT) AS rate
               FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, r.rate,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * r.rate AS DECIMAL(38,2)) AS total_local
FROM orders LEFT JOIN rates r ON r.rate_date = CAST(o_orderdate AS DATE)
""")
def fx_lookup(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    # a synthetic daily rate with gaps: only days that have shipments carry a rate
    rates = (t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("order_date"))
             .agg((F.lit(20000) + F.count(F.lit(1))).alias("rate")))
    o = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice")
    out = o.join(rates, "order_date", "left")
    return out.select("o_orderkey", "order_date", "rate",
                      (F.col("o_totalprice").cast("decimal(18,2)") * F.col("rate")).cast("decimal(38,2)")
                      .alias("total_local"))
