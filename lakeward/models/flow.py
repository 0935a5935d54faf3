"""The production flow: every item's hand-over through five steps.

Ordered songs count by order line, done and not done.  From production on an
item is a resource with one state row: what it reached, where it is kept and who
uses it.  The steps that an item has entered are read off its state, so that the
many lookups happen once an item and not once a step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.cleanse import concat_skip_null, typed_null
from lakeward.models import labels as L
from lakeward.models.base import ModelContext, model
from lakeward.operators.dedup import top1_value
from lakeward.operators.joins import join_aggregated
from lakeward.operators.ordering import asc

#: Output columns, in order.
COLUMNS = {"step_order": "int", "buoc": "string", "status_order": "int", "tinh_trang": "string", "flow_item_key": "string",
           "resource_id": "string", "hg_stock_id": "string", "isrc": "string", "so_id": "string", "po_id": "string",
           "po_detail_id": "string", "channel_id": "string", "repository_id": "string", "production_sub_project_id": "string",
           "production_project_id": "string", "stock_sub_project_id": "string", "stock_project_id": "string",
           "sub_project_id": "string", "project_id": "string", "order_company_id": "string", "stock_company_id": "string",
           "company_id": "string", "net_id": "string", "platform": "string", "stock_stored_date": "timestamp",
           "recorded_date": "timestamp", "so_luong": L.NUMERIC}


def _filled(c: str) -> Column:
    return F.nullif(F.col(c).cast("string"), F.lit(""))


def _step(number: int, done: Column, item: Column, amount: Column, recorded: Column | None = None) -> Column:
    """One row of a step, as a struct."""
    name, prefix = L.FLOW_STEPS[number - 1]
    order = F.when(done, 1).otherwise(2)
    return F.struct(F.lit(number).alias("step_order"), F.lit(name).alias("buoc"), order.alias("status_order"),
                    F.when(done, F.lit(L.DONE)).otherwise(F.lit(L.NOT_DONE)).alias("tinh_trang"),
                    concat_skip_null(F.lit(f"{prefix}:"), order, F.lit(":"), item).alias("flow_item_key"),
                    (typed_null("timestamp") if recorded is None else recorded.cast("timestamp")).alias("recorded_date"),
                    amount.cast(L.NUMERIC).alias("so_luong"))


def _shaped(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else typed_null(t)).cast(t).alias(c) for c, t in COLUMNS.items()])


def _repositories(ctx: ModelContext) -> DataFrame:
    subs = ctx.ref("dim_sub_project").select("sub_project_id", F.col("project_id").alias("production_project_id"))
    return (ctx.ref("dim_repository").select(F.col("repository_id").alias("__repo"), "sub_project_id").join(subs, "sub_project_id", "left")
            .withColumnRenamed("sub_project_id", "production_sub_project_id"))


def _orders(ctx: ModelContext) -> DataFrame:
    po = ctx.ref("dim_po").select("po_id", F.col("ordering_company").alias("order_company_id"))
    return ctx.ref("dim_so").select("so_id", "po_id").join(po, "po_id", "left")


def ordered_items(ctx: ModelContext) -> DataFrame:
    """Songs of every order line, those produced and those still missing."""
    lines = ctx.ref("fact_so_detail").select("so_detail_id", "so_id", "repository", "production_qty", "song_qty")
    rows = (lines.withColumn("repository_id", _filled("repository")).join(_repositories(ctx), F.col("repository_id") == F.col("__repo"), "left")
            .join(_orders(ctx), "so_id", "left"))
    item = F.coalesce(*[F.col(c).cast("string") for c in ("so_detail_id", "so_id", "repository")], F.lit("unknown"))
    made, wanted = (F.coalesce(F.col(c).cast(L.NUMERIC), F.lit(0).cast(L.NUMERIC)) for c in ("production_qty", "song_qty"))
    steps = F.array(_step(1, F.lit(True), item, F.least(made, wanted)),
                    _step(1, F.lit(False), item, F.greatest(wanted - made, F.lit(0).cast(L.NUMERIC))))
    rows = rows.select("*", F.inline(steps)).withColumns({
        "company_id": F.col("order_company_id"), "sub_project_id": F.col("production_sub_project_id"),
        "project_id": F.col("production_project_id")})
    return _shaped(rows)


def _kept(stock: DataFrame, key: str) -> list[Column]:
    in_use = F.when(F.col("status") == L.STOCK_IN_USE, F.col("status"))
    return [F.min("stock_stored_date").alias(f"{key}_stored"), F.max(in_use).alias(f"{key}_used"), F.max("status").alias(f"{key}_any")]


def item_states(ctx: ModelContext) -> DataFrame:
    """One row a resource and combination of what is known of it: acceptance,
    release, stock by code (or else by ISRC), order and repository."""
    released = ctx.ref("fact_label_operation").where(_filled("resource_id").isNotNull() & (
        (F.col("release_status") == L.RELEASE_SENT) | F.col("release_date").isNotNull()))
    released = released.groupBy(F.col("resource_id").alias("__released")).agg(F.min(_filled("isrc")).alias("released_isrc"))
    codes = ctx.ref("dim_resources").select(_filled("odoo_id").alias("__odoo"), _filled("hg_stock_id").alias("__hg")).where("__odoo is not null")
    codes = codes.groupBy("__odoo").agg(F.max("__hg").alias("own_hg"))
    stock = ctx.ref("dim_stock").select("hg_stock_id", _filled("isrc").alias("isrc"), "stock_stored_date", "status").where(_filled("hg_stock_id").isNotNull())
    by_hg = stock.groupBy(F.col("hg_stock_id").alias("__by_hg")).agg(F.max("isrc").alias("hg_isrc"), *_kept(stock, "hg"))
    with_isrc = stock.where("isrc is not null")
    chosen = top1_value(with_isrc, ["isrc"], "hg_stock_id", [
        asc(F.when(F.col("status") == L.STOCK_IN_USE, 0).otherwise(1)), asc("stock_stored_date", nulls_last=True), asc("hg_stock_id")], "isrc_hg")
    by_isrc = (with_isrc.groupBy("isrc").agg(F.lit(True).alias("__there"), *_kept(with_isrc, "isrc")).drop("__there")
               .join(chosen, "isrc").withColumnRenamed("isrc", "__by_isrc"))

    r = ctx.ref("dim_resource").where(_filled("resource_id").isNotNull()).select(
        "resource_id", "status", "so_id", "po_detail_id", "production_plan_detail_id", "repository_id")
    r = (r.join(_repositories(ctx), F.col("repository_id") == F.col("__repo"), "left").join(_orders(ctx), "so_id", "left")
         .join(released, F.col("resource_id") == F.col("__released"), "left").join(codes, F.col("resource_id") == F.col("__odoo"), "left"))
    # many items have no code or ISRC, or share one: the tables are aggregated by it, the items' rows are split
    r = join_aggregated(r, by_hg, [("own_hg", "__by_hg")])
    r = join_aggregated(r, by_isrc.withColumn("isrc_known", F.col("__by_isrc")), [("released_isrc", "__by_isrc")])
    return r.select(
        "resource_id", "status", "so_id", "po_id", "po_detail_id", "production_plan_detail_id", "repository_id", "production_sub_project_id",
        "production_project_id", "order_company_id", F.coalesce("own_hg", "isrc_hg").alias("hg_stock_id"),
        F.coalesce("released_isrc", "hg_isrc", F.when(F.col("isrc_hg").isNotNull(), F.col("isrc_known"))).alias("isrc"),
        F.coalesce("hg_stored", "isrc_stored").alias("stock_stored_date"),
        F.coalesce("hg_used", "isrc_used", "hg_any", "isrc_any").alias("stock_status"),
        F.col("__released").isNotNull().alias("is_published")).distinct()


def stock_users(ctx: ModelContext) -> DataFrame:
    """Who uses a stock code: its channels and the platforms that report it."""
    ch = ctx.ref("dim_channel").select(F.col("channel_id").alias("__ch"), F.col("company_id").alias("stock_company_id"),
                                       F.col("project_id").alias("stock_project_id"), F.col("sub_project_id").alias("stock_sub_project_id"), "network_id")
    used = ctx.ref("fact_youtube_operation").where(_filled("hg_stock_id").isNotNull()).select("hg_stock_id", "channel_id", "net").distinct()
    channels = used.join(ch, F.col("channel_id") == F.col("__ch"), "left").select(
        F.col("hg_stock_id").alias("__code"), "channel_id", "stock_company_id", "stock_project_id", "stock_sub_project_id",
        F.coalesce("network_id", "net").alias("net_id")).distinct()
    # the reports are reduced to the platforms of an ISRC before they meet the stock
    reports = [ctx.ref(m).select(F.col("isrc").alias("__isrc"), _filled("platform").alias("platform")).where("platform is not null").distinct()
               for m in ("fact_revenue_distro", "fact_view_stream_distro")]
    stock = ctx.ref("dim_stock").where(_filled("hg_stock_id").isNotNull()).select("hg_stock_id", "isrc").distinct()
    on = stock.join(reports[0].unionByName(reports[1]).distinct(), F.col("isrc") == F.col("__isrc")).select("hg_stock_id", "platform").distinct()
    return (channels.join(on, F.col("__code") == F.col("hg_stock_id"), "full").withColumn("__user_of", F.coalesce("__code", "hg_stock_id"))
            .drop("__code", "hg_stock_id").distinct())


@model("fact_hao_hut", "gold")
def fact_hao_hut(ctx: ModelContext) -> DataFrame:
    """Production flow with what is done and not done at each step: ordered to
    produced, produced to accepted, accepted to published, published to used, used
    to a result.  An item enters a step when it is done with the one before."""
    earned = ctx.ref("fact_revenue_by_resources").where(_filled("resource_id").isNotNull() & (
        (F.coalesce(F.col("view"), F.lit(0)) > 0) | (F.coalesce(F.col("revenue_amount"), F.lit(0)) > 0)))
    earned = earned.groupBy(F.col("resource_id").alias("__earned")).agg(F.min("recorded_date").alias("first_recorded"))
    items = item_states(ctx).join(stock_users(ctx), F.col("hg_stock_id") == F.col("__user_of"), "left")
    items = join_aggregated(items, earned.withColumn("is_earned", F.lit(True)), [("hg_stock_id", "__earned")])
    accepted = F.coalesce(F.col("status") == L.STATUS_ACCEPTED, F.lit(False))
    used = F.coalesce(F.col("stock_status") == L.STOCK_IN_USE, F.lit(False))
    result, one, item = F.col("is_earned").isNotNull(), F.lit(1), F.col("resource_id")
    entered = [(F.lit(True), _step(2, accepted, item, one)), (accepted, _step(3, F.col("is_published"), item, one)),
               (F.col("is_published"), _step(4, used, item, one)),
               (F.col("is_published") & used & _filled("hg_stock_id").isNotNull(), _step(5, result, item, one, F.col("first_recorded")))]
    steps = F.filter(F.array(*[F.when(cond, step) for cond, step in entered]), lambda s: s.isNotNull())
    items = items.select("*", F.inline(steps)).withColumns({
        "company_id": F.coalesce("stock_company_id", "order_company_id"),
        "sub_project_id": F.coalesce("stock_sub_project_id", "production_sub_project_id"),
        "project_id": F.coalesce("stock_project_id", "production_project_id")})
    return ordered_items(ctx).unionByName(_shaped(items)).where(F.coalesce("so_luong", F.lit(0).cast(L.NUMERIC)) != 0)
