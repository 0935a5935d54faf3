"""Warehouse models run end to end on staging tables derived from the driver
tables (SURVEY 2.14 through ``lakeward.models``).

The music-label staging tables do not exist in the driver data, so each one
is derived from a driver table with the same grain and keys; the model
functions then run unchanged.  The same derivations are written once more as
DuckDB CTEs (``STAGING_SQL``) for the oracles.

* customers are channels (``UC<custkey>``), owned by the company named by
  their market segment (the target company is BUILDING), deleted links where
  the account balance is negative;
* orders are videos (``V<orderkey>``) with one editing project each
  (``E<orderkey>``) published at the order date;
* line items are daily video metrics (ship date, price as revenue, quantity
  as views) and placements of a part in the order's editing (start = line
  number, end = line number + quantity);
* parts are catalogue files (stock code = prefix + 32 hex digits of the key;
  parts larger than size 45 are not file resources), parts of Brand#13 are
  on the manual exclusion list;
* line items are also distributor sales (retailer = supplier nation, ISRC =
  ``IS<partkey>``, artist = supplier) and daily stream reports (quantity in
  thousands written with thousands commas); every order is an FX quote of
  its day (several per day: the model takes the smallest).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.models import ModelContext
from lakeward.models import labels as L
from lakeward.plans.registry import query
from lakeward.plans.tables import Tables

TARGET_COMPANY = "BUILDING"
EXCLUDED_BRAND = "Brand#13"
NON_FILE_SIZE = 45
AS_OF = dt.date(2002, 1, 1)
# Channels of nations below this key have a received deal (revenue facts).
DEAL_RECEIVED_BELOW_NATION = 20
DEAL_RECEIVED_AT = dt.datetime(1994, 1, 1)


def _id(prefix: str, c: str) -> F.Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _money_text(c: str) -> F.Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def _day_text(c: str) -> F.Column:
    return F.col(c).cast("date").cast("string")


class _Staging(dict):
    """Staging frames built on first use (each derivation reads Parquet
    footers, so only the tables a model asks for are opened)."""

    def __init__(self, makers):
        super().__init__()
        self._makers = makers

    def __missing__(self, name):
        if name not in self._makers:
            raise KeyError(name)
        self[name] = self._makers[name]()
        return self[name]

    def __contains__(self, name):
        return name in self._makers


def driver_staging(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Lazy staging frames derived from the driver tables (see module doc)."""
    t = Tables(spark, sf)
    return _Staging({name: (lambda name=name: _DERIVE[name](t)) for name in _DERIVE})


def _cents(c: str) -> F.Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _stock_code(c: str) -> F.Column:
    return F.concat(F.lit(L.STOCK_PREFIX.lower()), F.lpad(F.upper(F.hex(c)), 32, "0"))


def _supplier_lines(t: Tables) -> DataFrame:
    """Line items with supplier name and nation, joined one table at a time:
    each joined table is a bare scan, whose size in bytes the planner knows."""
    return (t.lineitem.join(t.supplier.select("s_suppkey", "s_name", "s_nationkey"),
                            F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t.nation.select("n_nationkey", "n_name", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
            .drop("n_nationkey"))


_DERIVE = {
    "channel": lambda t: t.customer.select(
        F.col("c_custkey").alias("Id"), _id("UC", "c_custkey").alias("YoutubeChannelId"),
        F.col("c_name").alias("Title"), F.lit(False).alias("IsDeleted"),
        F.lit(None).cast("timestamp").alias("SuspendedTimeUtc")),
    "channel_company": lambda t: t.customer.select(
        F.col("c_custkey").alias("ChannelId"), F.col("c_mktsegment").alias("CompanyId"),
        (F.col("c_acctbal") < 0).alias("IsDeleted"), F.lit(None).cast("string").alias("Type")),
    "channel_video_info": lambda t: t.orders.select(
        _id("V", "o_orderkey").alias("YoutubeVideoId"), _id("UC", "o_custkey").alias("YoutubeChannelId"),
        _id("E", "o_orderkey").alias("Code"), F.col("o_orderdate").cast("timestamp").alias("PublishedAt"),
        F.col("o_orderpriority").alias("Title")),
    "channel_video_metric": lambda t: t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"),
                                                      F.col("l_orderkey") == F.col("o_orderkey")).select(
        _id("V", "l_orderkey").alias("YoutubeVideoId"), _id("UC", "o_custkey").alias("YoutubeChannelId"),
        F.col("l_shipdate").cast("timestamp").alias("Date"), F.col("l_extendedprice").alias("EstimatedRevenue"),
        F.col("l_quantity").alias("Views")),
    "editings": lambda t: t.orders.select(
        F.col("o_orderkey").alias("Id"), _id("E", "o_orderkey").alias("EditingFileId")),
    "resource_editings": lambda t: t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _cents("l_quantity"),
                    _cents("l_extendedprice")).alias("Id"),
        F.col("l_orderkey").alias("EditingId"), F.col("l_partkey").alias("ResourcesId"),
        F.col("l_linenumber").cast("double").alias("StartTime"),
        (F.col("l_linenumber") + F.col("l_quantity")).alias("EndTime")),
    "resource": lambda t: t.part.select(
        F.col("p_partkey").alias("Id"), _stock_code("p_partkey").alias("ResourceFileId"),
        F.when(F.col("p_size") > NON_FILE_SIZE, 1).otherwise(0).alias("ResourceType")),
    "manual_excluded_stock_codes": lambda t: t.part.filter(F.col("p_brand") == EXCLUDED_BRAND)
        .select(_stock_code("p_partkey").alias("hg_stock_id")),
    "sale": lambda t: _supplier_lines(t).select(
        F.col("n_name").alias("retailer"), _id("IS", "l_partkey").alias("isrc"), F.col("s_name").alias("artist"),
        _day_text("l_shipdate").alias("reportingPeriod"), _money_text("l_extendedprice").alias("revenue")),
    "stream_distro": lambda t: _supplier_lines(t).select(
        _id("IS", "l_partkey").alias("isrc"), F.format_number(F.col("l_quantity") * 1000, 0).alias("dailyStream"),
        _day_text("l_shipdate").alias("reportingDate"), _id("A", "l_suppkey").alias("idArtist"),
        F.col("s_name").alias("mainArtist")),
    "distribution_media_history": lambda t: _supplier_lines(t).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _cents("l_quantity"),
                    _cents("l_extendedprice")).alias("Id"),
        F.col("l_partkey").alias("ResourceFileInfoId"), F.col("l_shipdate").cast("timestamp").alias("CreatedDate"),
        F.col("l_suppkey").alias("CreatedByUserId"),
        F.concat_ws(",", "s_nationkey", "n_regionkey").alias("DepartmentData"),
        F.col("n_regionkey").cast("string").alias("GroupData"), F.col("l_suppkey").cast("string").alias("UserData")),
    "resource_file_info": lambda t: t.part.select(
        F.col("p_partkey").alias("Id"), _stock_code("p_partkey").alias("ResourceFileId"),
        _id("IS", "p_partkey").alias("ISRC"), F.lit(1).alias("MediaType")),
    "department": lambda t: t.nation.select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Name")),
    "groups": lambda t: t.region.select(F.col("r_regionkey").alias("Id"), F.col("r_name").alias("Name")),
    "users": lambda t: t.supplier.select(F.col("s_suppkey").alias("Id"), F.col("s_name").alias("DisplayName")),
    "channel_deal": lambda t: t.customer.select(
        F.col("c_custkey").alias("ChannelId"), F.col("c_nationkey").alias("CmsId"), F.lit(False).alias("IsDeleted"),
        (F.col("c_acctbal") < 0).alias("IsOutNet"),
        F.when(F.col("c_nationkey") < DEAL_RECEIVED_BELOW_NATION, F.lit(DEAL_RECEIVED_AT)).alias("ReceiveTimeUtc"),
        F.lit(None).cast("timestamp").alias("OutNetTimeUtc")),
    "usd_rate": lambda t: t.orders.select(
        _day_text("o_orderdate").alias("record_date"), F.col("o_totalprice").alias("exchange_rate")),
}


def driver_context(spark: SparkSession, sf: str) -> ModelContext:
    return ModelContext(spark, driver_staging(spark, sf), AS_OF, vars={"target_company_id": TARGET_COMPANY})


# --- oracles, in terms of the driver tables ----------------------------------------------------

STOCK = f"'{L.STOCK_PREFIX}' || lpad(upper(hex(p_partkey)), 32, '0')"
#: Orders whose customer's channel belongs to the target company.
OURS = f"(SELECT * FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = '{TARGET_COMPANY}' AND c_acctbal >= 0)"
#: Each order's catalogue files in the order of their lines: seat 1, 2, ...
SEATS = f"""
SELECT *, row_number() OVER (PARTITION BY o ORDER BY line, tag) AS seat FROM (
  SELECT DISTINCT l_orderkey AS o, l_linenumber AS line, l_quantity AS qty, {STOCK} AS stock,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_quantity * 100) AS BIGINT),
                   CAST(round(l_extendedprice * 100) AS BIGINT)) AS tag
  FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE p_size <= {NON_FILE_SIZE} AND p_brand <> '{EXCLUDED_BRAND}' AND l_orderkey IN (SELECT o_orderkey FROM orders))
"""


@query("wh_fact_editing", "2.14 fact_editing: JN-1/5, SET-3, WIN-6 (skew-safe numbering)", sql=f"""
SELECT md5(tag) AS fact_editing_sk, o AS editing_id, 'E' || o AS editing_code, stock AS hg_stock_id,
       CAST(seat AS INTEGER) AS position, CAST(qty AS DECIMAL(38,6)) AS duration
FROM ({SEATS})""")
def wh_fact_editing(spark: SparkSession, sf: str) -> DataFrame:
    return driver_context(spark, sf).ref("fact_editing")


@query("wh_fact_revenue_by_resources",
       "2.14 fact_revenue_by_resources: JN-4/14, AGG-12, WIN-8, positional weights", sql=f"""
WITH tenths(n, seat, w) AS (VALUES (1, 1, 10), (2, 1, 5), (2, 2, 5), (3, 1, 6), (3, 2, 3), (3, 3, 1), (4, 1, 6), (4, 2, 2),
                            (4, 3, 1), (4, 4, 1), (5, 1, 5), (5, 2, 2), (5, 3, 1), (5, 4, 1), (5, 5, 1)),
front AS (SELECT o, stock, seat FROM ({SEATS}) WHERE seat <= 5),
filled AS (SELECT o, max(seat) AS n FROM front GROUP BY o),
days AS (SELECT o_orderkey AS o, any_value(nullif(trim(o_orderpriority), '')) AS title, CAST(l_shipdate AS DATE) AS day,
                sum(CAST(l_extendedprice AS DECIMAL(38,6))) AS money, sum(CAST(l_quantity AS DECIMAL(38,6))) AS seen
         FROM {OURS} JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, CAST(l_shipdate AS DATE))
SELECT md5(concat_ws('-', 'V' || o, 'E' || o, stock, seat, day)) AS revenue_id, 'V' || o AS video_id, title AS video_name,
       '{L.VIDEO_URL_PREFIX}V' || o AS video_url, 'E' || o AS editing_code, stock AS resource_id,
       CAST(seat AS INTEGER) AS position, CAST(money * w / 10.0 AS DECIMAL(38,6)) AS revenue_amount,
       CAST(day AS TIMESTAMP) AS recorded_date, CAST(seen * w / 10.0 AS DECIMAL(38,6)) AS view
FROM days JOIN front USING (o) JOIN filled USING (o) JOIN tenths USING (n, seat)""")
def wh_fact_revenue_by_resources(spark: SparkSession, sf: str) -> DataFrame:
    return driver_context(spark, sf).ref("fact_revenue_by_resources")


#: Money by shop (nation), track (part), artist (supplier) and month, and the rate of its first day.
MONEY = """
SELECT n_name AS shop, 'IS' || l_partkey AS track, s_name AS who, strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS month,
       l_partkey AS part, min(CAST(l_shipdate AS DATE)) AS first_day,
       sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,6))) AS money
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL
"""
RATE = "(SELECT CAST(o_orderdate AS DATE) AS first_day, CAST(min(o_totalprice) AS DOUBLE) AS rate FROM orders GROUP BY 1)"


@query("wh_fact_revenue_distro", "2.14 fact_revenue_distro: AGG-1/9, JN-19 (FX on first date)", sql=f"""
SELECT md5(concat_ws('-', shop, track, who, month)) AS fact_revenue_distro_sk, money AS revenue_amount,
       month AS revenue_month, shop AS platform, track AS isrc, who AS artist, rate AS exchange_rate
FROM ({MONEY}) LEFT JOIN {RATE} USING (first_day)""")
def wh_fact_revenue_distro(spark: SparkSession, sf: str) -> DataFrame:
    return driver_context(spark, sf).ref("fact_revenue_distro")


@query("wh_fact_revenue_stream_distro", "2.14 fact_revenue_stream_distro: AGG-12, JN-10/19, PRJ-13/18", sql=f"""
WITH played AS (
  SELECT l_partkey AS part, strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS month,
         CAST(sum(CAST(l_quantity * 1000 AS BIGINT)) AS DECIMAL(38,6)) AS plays
  FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY ALL)
SELECT md5(concat_ws('-', shop, track, who, month)) AS fact_revenue_stream_distro_sk, money AS revenue_amount,
       coalesce(plays, 0) AS stream_count, coalesce(1000.0 * (CAST(money AS DOUBLE) / nullif(CAST(plays AS DOUBLE), 0)), 0.0) AS rpm,
       month AS revenue_month, shop AS platform, track AS isrc, who AS artist, rate AS exchange_rate
FROM ({MONEY}) LEFT JOIN played USING (part, month) LEFT JOIN {RATE} USING (first_day)""")
def wh_fact_revenue_stream_distro(spark: SparkSession, sf: str) -> DataFrame:
    return driver_context(spark, sf).ref("fact_revenue_stream_distro")


@query("wh_fact_view_stream_distro", "2.14 fact_view_stream_distro: JN-2 fan-out to platforms, PRJ-13", sql="""
WITH shops AS (SELECT DISTINCT l_partkey AS part, n_name AS shop FROM lineitem
               JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
SELECT md5(concat_ws('-', 'IS' || l_partkey, CAST(l_shipdate AS DATE), 'A' || l_suppkey, shop)) AS fact_view_stream_distro_sk,
       CAST(CAST(l_quantity * 1000 AS BIGINT) AS DECIMAL(38,6)) AS stream_count, CAST(l_shipdate AS DATE) AS recorded_date,
       shop AS platform, 'IS' || l_partkey AS isrc, 'A' || l_suppkey AS artist
FROM lineitem SEMI JOIN supplier ON s_suppkey = l_suppkey JOIN shops ON part = l_partkey""")
def wh_fact_view_stream_distro(spark: SparkSession, sf: str) -> DataFrame:
    return driver_context(spark, sf).ref("fact_view_stream_distro")


@query("wh_dim_video", "2.14 dim_video: JN-4 (EXISTS), WIN-1 (DESC nulls first), PRJ-14", sql=f"""
SELECT md5('V' || o_orderkey) AS dim_video_sk, 'V' || o_orderkey AS video_id, 'UC' || o_custkey AS channel_id,
       '{L.VIDEO_URL_PREFIX}V' || o_orderkey AS video_url, 'E' || o_orderkey AS editing_code,
       CAST(o_orderdate AS TIMESTAMP) AS published_date, nullif(trim(o_orderpriority), '') AS video_name
FROM {OURS}""")
def wh_dim_video(spark: SparkSession, sf: str) -> DataFrame:
    return driver_context(spark, sf).ref("dim_video")


# A team is the names of the nations numbered by a supplier's nation and by its region.  Every line hands the
# line's part to the team of its supplier; what the part earns in the orders that hold it counts once a hand-out.
TEAM_USAGE_SQL = f"""
WITH hands AS (
  SELECT a.n_name || ', ' || b.n_name AS team, {STOCK} AS stock, count(*) AS times
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation a ON a.n_nationkey = s_nationkey JOIN nation b ON b.n_nationkey = a.n_regionkey
  WHERE p_brand <> '{EXCLUDED_BRAND}' GROUP BY ALL),
held AS (SELECT DISTINCT stock, o FROM ({SEATS})),
earned AS (
  SELECT stock, kind, date_trunc('month', CAST(l_shipdate AS TIMESTAMP)) AS month,
         sum(CAST(CASE kind WHEN 'v' THEN l_quantity ELSE l_extendedprice END AS DECIMAL(38,6))) AS amount
  FROM held JOIN orders ON o_orderkey = o JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o
  JOIN (VALUES ('v'), ('m')) kinds(kind) ON kind = 'v' OR c_nationkey < {DEAL_RECEIVED_BELOW_NATION}
  WHERE c_acctbal >= 0 GROUP BY ALL),
monthly AS (
  SELECT team, kind, month, sum(times * amount) AS amount, lag(CAST(sum(times * amount) AS DOUBLE)) OVER (
           PARTITION BY team, kind ORDER BY month) AS before
  FROM hands JOIN earned USING (stock) GROUP BY team, kind, month),
facts AS (
  SELECT team, sum(amount) FILTER (kind = 'v') AS seen, sum(amount) FILTER (kind = 'm') AS money,
         arg_max_null((CAST(amount AS DOUBLE) - before) / nullif(before, 0), month) FILTER (kind = 'v') AS more_seen,
         arg_max_null((CAST(amount AS DOUBLE) - before) / nullif(before, 0), month) FILTER (kind = 'm') AS more_money
  FROM monthly GROUP BY team),
shown AS (SELECT DISTINCT stock FROM held WHERE o IN (SELECT o_orderkey FROM {OURS}))
SELECT md5(team) AS mart_team_usage_sk, team, CAST(sum(times) AS BIGINT) AS distributed_resources,
       count(DISTINCT stock) FILTER (stock IN (FROM shown)) AS usage_resources,
       CAST(coalesce(any_value(seen), 0) AS DECIMAL(38,6)) AS view, CAST(coalesce(any_value(money), 0) AS DECIMAL(38,6)) AS revenue,
       any_value(more_seen) AS growth_view, any_value(more_money) AS growth_revenue
FROM hands LEFT JOIN facts USING (team) GROUP BY team
"""


@query("wh_mart_team_usage", "2.14 mart_team_usage: JN-18 list lookups, AGG-3/12, WIN-9/10", sql=TEAM_USAGE_SQL)
def wh_mart_team_usage(spark: SparkSession, sf: str) -> DataFrame:
    return driver_context(spark, sf).ref("mart_team_usage")
