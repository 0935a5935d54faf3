"""Gold marts.

Team and resource marts join distributions -> stock/video bridge -> daily
video metrics.  Written literally that is a three-way fan-out (every
distribution row times every metric day of every video of the stock); here
each side is aggregated to its join key first (metric sums per video,
distribution row counts per (team, stock)) and the totals are multiplied back,
which gives the same sums with inputs that shrink before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.functions.cleanse import blank_to_null as b2n
from lakeward.functions.cleanse import typed_null
from lakeward.functions.dates import as_date_lit, days_between, month_start
from lakeward.functions.keys import surrogate_key as sk
from lakeward.models import labels as L
from lakeward.models.base import ModelContext, model
from lakeward.models.silver_facts import distributions, editing_placements, net_metrics
from lakeward.operators.joins import join_aggregated
from lakeward.operators.marts import daily_totals, growth_vs_previous, latest_growth


@model("mart_phase6_daily_sales", "gold")
def mart_phase6_daily_sales(ctx: ModelContext) -> DataFrame:
    """Sales count and exact total per day (AGG-1)."""
    return daily_totals(ctx.ref("fact_phase6_sales"), count_out="sale_count")


@model("int_stock_video", "silver")
def int_stock_video(ctx: ModelContext) -> DataFrame:
    """Distinct stock code x video through the editing code (JN-14, SET-3)."""
    fe = editing_placements(ctx).select("hg_stock_id", "editing_code")
    b = ctx.ref("bridge_bt_vid").select("editing_code", "video_id")
    return fe.join(b, "editing_code").select("hg_stock_id", "video_id").distinct()


def _last_growth(monthly: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Growth of the newest month vs the previous present month (WIN-9/10)."""
    g = growth_vs_previous(monthly, [key], "month", value, prev_out="__prev", growth_out=out)
    return latest_growth(g, [key], "month").select(key, out)


KINDS = {"view": ("viewed", "Views"), "revenue": ("earned", "EstimatedRevenue")}


def _growth(kind: str) -> Column:
    """Growth of a month over the one before that has rows of this kind; null without one."""
    before = Window.partitionBy("team").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    now = F.col(kind).cast("double")
    last = F.last(F.when(F.col(f"has_{kind}"), F.struct(now.alias("v"))), ignorenulls=True).over(before)["v"]
    return (now - last) / F.nullif(last, F.lit(0.0))


#: An amount is summed in three parts: millionths, whole units below LOW, and the rest, which is rare.
MICRO, LOW = 10 ** 6, 10 ** 6


def _parts(k: str) -> list[Column]:
    """The amount ``k`` in parts: two small longs and a decimal, null if it is 0.
    Sums of the longs times counts stay below LOW times the rows counted."""
    whole = F.floor(F.col(k))
    low = F.pmod(whole, F.lit(LOW).cast("decimal(10,0)"))
    return [((F.col(k) - whole) * F.lit(MICRO)).cast("long").alias(f"{k}_micro"), low.cast("long").alias(f"{k}_low"),
            F.nullif(whole - low, F.lit(0).cast("decimal(33,0)")).cast("decimal(38,0)").alias(f"{k}_high")]


def _part_sums(k: str, times: Column) -> list[Column]:
    return [F.sum(F.col(f"{k}_{part}") * times).alias(f"{k}_{part}") for part in ("micro", "low", "high")]


def _packed(rows: DataFrame, key: str, kinds: list[str], flags: list[str]) -> DataFrame:
    """The months of each ``key`` with their parts of amounts as one row of short arrays; the rare part is null without any."""
    fields = [F.col("month"), *flags]
    for k in kinds:
        fields += [(F.col(f"{k}_low") * F.lit(MICRO) + F.col(f"{k}_micro")).alias(k), f"{k}_high"]
    out = rows.groupBy(key).agg(F.collect_list(F.struct(*fields)).alias("m"))
    rare = [F.when(F.exists(F.col(f"m.{k}_high"), lambda x: x.isNotNull()), F.col(f"m.{k}_high")).alias(f"{k}_high") for k in kinds]
    return out.select(key, *[F.col(f"m.{c}").alias(c) for c in ("month", *flags, *kinds)], *rare)


def _unpacked(rows: DataFrame, keep: list[str], kinds: list[str], flags: list[str]) -> DataFrame:
    """A row for each month of :func:`_packed`, one without a month for a row that has none."""
    rows = rows.select(*keep, *flags, *kinds, *[f"{k}_high" for k in kinds], F.posexplode_outer("month").alias("__at", "month"))
    rows = rows.select(*keep, "month", *[F.get(c, F.col("__at")).alias(c) for c in (*flags, *kinds, *[f"{k}_high" for k in kinds])])
    return rows.select(*keep, "month", *flags, *[f"{k}_high" for k in kinds],
                       *[c for k in kinds for c in ((F.col(k) % F.lit(MICRO)).alias(f"{k}_micro"), F.expr(f"{k} div {MICRO}").alias(f"{k}_low"))])


def _whole(k: str) -> Column:
    """The amount of summed parts."""
    micro = F.col(f"{k}_micro").cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(6,6)")
    return (micro + F.col(f"{k}_low") + F.coalesce(f"{k}_high", F.lit(0).cast("decimal(38,0)"))).cast(L.NUMERIC)


@model("mart_team_usage", "gold")
def mart_team_usage(ctx: ModelContext) -> DataFrame:
    """Per team (department text of a distribution): distributed resources,
    used resources (edited into a published video), total views and revenue
    of the videos using its resources, and newest month-over-month growth."""
    fd = distributions(ctx, ["department"]).filter(F.col("department").isNotNull()) \
        .select(F.col("department").alias("team"), "hg_stock_id")
    team_dist = fd.groupBy("team").agg(F.count("hg_stock_id").alias("distributed_resources"))
    fd_counts = fd.filter(F.col("hg_stock_id").isNotNull()).groupBy("team", "hg_stock_id").agg(F.count(F.lit(1)).alias("__rows"))

    # the metric table once, both kinds side by side: sums per (video, month), whose months go as one row to
    # the stocks of the video, and from there to the teams of the stock; teams' months are added up after that
    kinds = list(KINDS)
    parts = [f"{k}_{part}" for k in kinds for part in ("micro", "low", "high")]
    flags = [f"has_{k}" for k in kinds]
    m = net_metrics(ctx)
    per_video = m.groupBy(F.col("__v").alias("video_id"), month_start("Date").alias("month")).agg(
        *[F.sum(F.when(F.col(flag), F.col(value).cast(L.NUMERIC))).alias(k) for k, (flag, value) in KINDS.items()],
        *[F.max(F.col(flag)).alias(f"has_{k}") for k, (flag, _) in KINDS.items()])
    per_video = _packed(per_video.select("video_id", "month", *[c for k in kinds for c in _parts(k)], *flags), "video_id", kinds, flags)
    # a stock is used when one of its (stock, video) pairs has a published video:
    # these videos go with the metrics as rows without a month
    published = ctx.ref("dim_video").filter(F.col("published_date").isNotNull()).select("video_id")
    sv = ctx.ref("int_stock_video").filter(F.col("hg_stock_id").isNotNull())
    per_stock = sv.join(per_video.unionByName(published, allowMissingColumns=True), "video_id").drop("video_id")
    # the widest step, teams x months of a stock's video, adds longs
    monthly = _unpacked(fd_counts.join(per_stock, "hg_stock_id"), ["team", "hg_stock_id", "__rows"], kinds, flags).groupBy("team", "month").agg(
        F.count_distinct(F.when(F.col("month").isNull(), F.col("hg_stock_id"))).alias("stocks"),
        *[c for k in kinds for c in _part_sums(k, F.col("__rows"))], *[F.max(f).alias(f) for f in flags])
    usage = F.max(F.when(F.col("month").isNull(), F.col("stocks"))).alias("usage_resources")
    # a handful of rows from here on; rows without a month have no amounts and come first
    monthly = monthly.withColumns({k: _whole(k) for k in kinds}).drop(*parts)
    monthly = monthly.withColumns({f: F.coalesce(f, F.lit(False)) for f in flags}).withColumns({f"growth_{k}": _growth(k) for k in kinds})
    facts = monthly.groupBy("team").agg(
        usage, *[F.sum(k).alias(f"total_{k}") for k in kinds],
        *[F.max_by(F.struct(f"growth_{k}"), F.when(F.col(f"has_{k}"), F.col("month")))[f"growth_{k}"].alias(f"growth_{k}") for k in kinds])
    out = team_dist.join(facts, "team", "left")
    zero = F.lit(0).cast(L.NUMERIC)
    return out.select(sk("team").alias("mart_team_usage_sk"), "team", "distributed_resources",
                      F.coalesce("usage_resources", F.lit(0)).alias("usage_resources"),
                      F.coalesce(F.col("total_view").cast(L.NUMERIC), zero).alias("view"),
                      F.coalesce(F.col("total_revenue").cast(L.NUMERIC), zero).alias("revenue"),
                      "growth_view", "growth_revenue")


@model("mart_resource_channel", "gold")
def mart_resource_channel(ctx: ModelContext) -> DataFrame:
    """Per stock item: project chain, acceptance score, purchased or produced,
    total views/revenue with newest monthly growth, and channel/video use."""
    fr = ctx.ref("fact_revenue_by_resources")
    svr = fr.groupBy("resource_id").agg(F.sum("view").alias("total_view"), F.sum("revenue_amount").alias("total_revenue"))
    monthly = fr.groupBy("resource_id", month_start("recorded_date").alias("month")) \
        .agg(F.sum("view").alias("mv"), F.sum("revenue_amount").alias("mr"))
    gview = _last_growth(monthly.select("resource_id", "month", "mv"), "resource_id", "mv", "growth_view")
    grev = _last_growth(monthly.select("resource_id", "month", "mr"), "resource_id", "mr", "growth_revenue")

    bridge = ctx.source("x_music_song").filter(F.col("hg_code").isNotNull()) \
        .select(F.col("hg_code").cast("string").alias("__b_stock"), F.col("id").cast("string").alias("__b_res"))
    dr = ctx.ref("dim_resource").select(F.col("resource_id").alias("__dr_id"), F.col("repository_id").alias("__repo"),
                                        "acceptance_score")
    repo = ctx.ref("dim_repository").select(F.col("repository_id").alias("__r_id"), F.col("sub_project_id").alias("__sp"))
    dsp = ctx.ref("dim_sub_project").select(F.col("sub_project_id").alias("__sp_id"), F.col("project_id").alias("__p"),
                                            F.col("sub_project_name").alias("sub_project"))
    dp = ctx.ref("dim_project").select(F.col("project_id").alias("__p_id"), F.col("project_name").alias("project"))
    pr = ctx.ref("dim_purchased_resource").select(F.col("hg_stock_id").alias("__pr_stock"))

    dv = ctx.ref("dim_video").filter(F.col("published_date").isNotNull()).select("video_id", "channel_id")
    cv = (ctx.ref("int_stock_video").join(dv, "video_id")
          .groupBy(F.col("hg_stock_id").alias("__cv_stock"))
          .agg(F.count_distinct("channel_id").alias("channel_use"), F.count_distinct("video_id").alias("video_use")))

    ds = ctx.ref("dim_stock")
    j = (ds.join(bridge, ds["hg_stock_id"] == F.col("__b_stock"), "left")
         .join(dr, F.col("__b_res") == F.col("__dr_id"), "left")
         .join(repo, F.col("__repo") == F.col("__r_id"), "left")
         .join(dsp, F.col("__sp") == F.col("__sp_id"), "left")
         .join(dp, F.col("__p") == F.col("__p_id"), "left")
         .join(pr, ds["hg_stock_id"] == F.col("__pr_stock"), "left")
         .join(svr, ds["hg_stock_id"] == svr["resource_id"], "left")
         .join(gview.withColumnRenamed("resource_id", "__gv"), ds["hg_stock_id"] == F.col("__gv"), "left")
         .join(grev.withColumnRenamed("resource_id", "__gr"), ds["hg_stock_id"] == F.col("__gr"), "left")
         .join(cv, ds["hg_stock_id"] == F.col("__cv_stock"), "left"))
    zero = F.lit(0).cast(L.NUMERIC)
    return j.select(sk(ds["hg_stock_id"]).alias("mart_resource_channel_sk"), ds["hg_stock_id"].alias("resource_id"),
                    ds["name"].alias("resource_name"), "project", "sub_project", "acceptance_score",
                    F.when(F.col("__pr_stock").isNotNull(), F.lit(L.RESOURCE_PURCHASED))
                     .otherwise(F.lit(L.RESOURCE_PRODUCED)).alias("resource_type"),
                    F.coalesce(F.col("total_view").cast(L.NUMERIC), zero).alias("view"),
                    F.coalesce(F.col("total_revenue").cast(L.NUMERIC), zero).alias("revenue"),
                    "growth_view", "growth_revenue",
                    F.coalesce("channel_use", F.lit(0)).alias("channel_use"),
                    F.coalesce("video_use", F.lit(0)).alias("video_use"))


@model("mart_resources_video_channel", "gold")
def mart_resources_video_channel(ctx: ModelContext) -> DataFrame:
    """Resource x video x channel x network x company links."""
    er = ctx.ref("fact_editing").filter(F.col("hg_stock_id").isNotNull()) \
        .select(F.col("editing_code").cast("string").alias("editing_code"),
                F.col("hg_stock_id").cast("string").alias("resource_id"), "position")
    v = ctx.ref("dim_video").select(F.col("video_id").cast("string").alias("video_id"),
                                    F.col("channel_id").cast("string").alias("__v_ch"),
                                    F.col("editing_code").cast("string").alias("editing_code"), "video_url")
    ch = ctx.ref("dim_channel").select(F.col("channel_id").cast("string").alias("__ch"),
                                       F.col("company_id").cast("string").alias("__co"),
                                       F.col("network_id").cast("string").alias("__net"),
                                       F.col("link").alias("link_channel"), "employee_name")
    net = ctx.ref("dim_net").select(F.col("net_id").cast("string").alias("__n_id"), F.col("net_name").alias("network"))
    co = ctx.ref("dim_company_stock").select(F.col("company_id").cast("string").alias("__c_id"),
                                             F.col("company_name").alias("company"))
    j = (er.join(v, "editing_code").join(ch, F.col("__v_ch") == F.col("__ch"), "left")
         .join(net, F.col("__net") == F.col("__n_id"), "left").join(co, F.col("__co") == F.col("__c_id"), "left"))
    return j.select(F.col("video_url").alias("link_video"), "link_channel", "resource_id", "position", "network",
                    "company", typed_null("string").alias("department"), F.col("employee_name").alias("employee"))


@model("mart_ton_kho", "gold")
def mart_ton_kho(ctx: ModelContext) -> DataFrame:
    """Inventory age of distributed catalogue items at ``as_of``: days since
    the last use in a published video, else since the last distribution;
    age and acceptance-score bands; usage status."""
    fd = ctx.ref("fact_distribution")
    dm = (fd.filter(b2n("hg_stock_id").isNotNull() & F.col("hg_stock_id").startswith(L.STOCK_PREFIX))
          .groupBy("hg_stock_id").agg(F.max("distribution_date").cast("date").alias("last_distribution_date")))
    fe = ctx.ref("fact_editing").filter(b2n("hg_stock_id").isNotNull() & F.col("hg_stock_id").startswith(L.STOCK_PREFIX)
                                        & b2n("editing_code").isNotNull()).select("hg_stock_id", "editing_code")
    bv = ctx.ref("bridge_bt_vid").filter(b2n("video_id").isNotNull()).select("editing_code", "video_id")
    dv = ctx.ref("dim_video").filter(F.col("published_date").isNotNull()).select("video_id", "published_date")
    # newest publish per editing code first, so the stock join sees one row per code
    per_code = bv.join(dv, "video_id").groupBy("editing_code").agg(F.max("published_date").alias("__pub"))
    lu = fe.join(per_code, "editing_code").groupBy("hg_stock_id") \
        .agg(F.max("__pub").cast("date").alias("last_published_date"))

    st = ctx.ref("dim_stock").filter(b2n("hg_stock_id").isNotNull() & F.col("hg_stock_id").startswith(L.STOCK_PREFIX))
    flo = ctx.ref("fact_label_operation").select(F.col("isrc").alias("__f_isrc"), F.col("resource_id").alias("__f_res"))
    dr = ctx.ref("dim_resource").select(F.col("resource_id").alias("__d_res"), "acceptance_score")
    sbs = (st.join(flo, F.nullif(st["isrc"], F.lit("")).isNotNull() & (F.col("__f_isrc") == st["isrc"]), "left")
           .join(dr, F.col("__d_res") == F.col("__f_res"), "left")
           .groupBy("hg_stock_id").agg(F.max("acceptance_score").alias("acceptance_score")))

    base = dm.join(lu, "hg_stock_id", "left").join(sbs, "hg_stock_id", "left")
    start = F.coalesce("last_published_date", "last_distribution_date")
    base = base.filter(start.isNotNull()).withColumn("inventory_start_date", start) \
        .withColumn("inventory_age_days", days_between(as_date_lit(ctx.as_of), start))
    age = F.col("inventory_age_days")
    a_sort = F.when(age <= L.INVENTORY_AGE_BOUNDS[0], 1).when(age <= L.INVENTORY_AGE_BOUNDS[1], 2).otherwise(3)
    a_label = (F.when(age <= L.INVENTORY_AGE_BOUNDS[0], L.INVENTORY_AGE_LABELS[0])
               .when(age <= L.INVENTORY_AGE_BOUNDS[1], L.INVENTORY_AGE_LABELS[1])
               .otherwise(L.INVENTORY_AGE_LABELS[2]))
    score = F.col("acceptance_score")
    s_sort, s_label = None, None
    for i, b in enumerate(L.SCORE_BOUNDS):
        cond = score >= F.lit(b)
        s_sort = F.when(cond, i + 1) if s_sort is None else s_sort.when(cond, i + 1)
        s_label = F.when(cond, L.SCORE_LABELS[i]) if s_label is None else s_label.when(cond, L.SCORE_LABELS[i])
    s_sort = s_sort.otherwise(len(L.SCORE_BOUNDS) + 1)
    s_label = s_label.otherwise(L.SCORE_LABELS[-1])
    return base.filter(age >= 0).select(
        "hg_stock_id", "last_distribution_date", "last_published_date", "inventory_start_date", "inventory_age_days",
        a_sort.alias("inventory_age_sort"), a_label.alias("inventory_age_group"), "acceptance_score",
        s_sort.alias("score_sort"), s_label.alias("score_group"),
        F.when(F.col("last_published_date").isNotNull(), F.lit(L.USED)).otherwise(F.lit(L.NEVER_USED))
         .alias("usage_status"))


@model("mart_avg_sla_ord_disribution", "gold")
def mart_avg_sla_ord_disribution(ctx: ModelContext) -> DataFrame:
    """Per repository with produced resources: number of resources and the
    average days from purchase-order confirmation to distribution (0 -> null)."""
    approved = str(ctx.vars.get("po_approved_column", "date_approve"))
    res = ctx.ref("dim_resources").filter((F.col("resource_source") == F.lit("odoo")) & F.col("hg_stock_id").isNotNull())
    produced = res.select(F.col("hg_stock_id").cast("string").alias("hg_stock_id"),
                          F.col("repository_id").cast("string").alias("repository_id"),
                          F.col("po_detail_id").cast("string").alias("po_detail_id")).distinct()
    pol = ctx.source("purchase_order_line").select(F.col("id").cast("string").alias("po_detail_id"),
                                                   F.col("order_id").cast("string").alias("__po"))
    po = ctx.source("purchase_order").filter(F.col(approved).isNotNull()) \
        .select(F.col("id").cast("string").alias("__po"), F.col(approved).alias("__approved"))
    poc = pol.join(po, "__po").groupBy("po_detail_id").agg(F.min("__approved").alias("po_confirmed_date"))
    rpc = produced.join(poc, "po_detail_id", "left").groupBy("hg_stock_id") \
        .agg(F.min("po_confirmed_date").alias("po_confirmed_date"))
    psr = produced.select("hg_stock_id", "repository_id").distinct()
    fd = ctx.ref("fact_distribution").select(F.col("hg_stock_id").cast("string").alias("hg_stock_id"),
                                             "distribution_date")
    days = F.when(F.col("po_confirmed_date").isNotNull() & F.col("distribution_date").isNotNull(),
                  days_between("distribution_date", "po_confirmed_date").cast("decimal(38,6)"))
    sla = (join_aggregated(fd, rpc, [("hg_stock_id", "hg_stock_id")]).join(psr, "hg_stock_id")
           .groupBy("repository_id").agg(F.avg(days).alias("sla_ord_distribution")))
    rc = psr.groupBy("repository_id").agg(F.count_distinct("hg_stock_id").alias("number_resources"))
    repo = ctx.ref("dim_repository").select(F.col("repository_id").cast("string").alias("repository_id"),
                                            F.col("sub_project_id").cast("string").alias("__sp"))
    dsp = ctx.ref("dim_sub_project").select(F.col("sub_project_id").cast("string").alias("__sp_id"),
                                            F.col("project_id").cast("string").alias("__p"),
                                            F.col("sub_project_name").alias("sub_project"))
    dp = ctx.ref("dim_project").select(F.col("project_id").cast("string").alias("__p_id"),
                                       F.col("project_name").alias("project"))
    j = (repo.join(dsp, F.col("__sp") == F.col("__sp_id"), "left").join(dp, F.col("__p") == F.col("__p_id"), "left")
         .join(rc, "repository_id", "left").join(sla, "repository_id", "left"))
    return j.filter(F.col("number_resources") > 0).select(
        "repository_id", "sub_project", "project", "number_resources",
        F.nullif(F.col("sla_ord_distribution"), F.lit(0)).alias("sla_ord_distribution"))


def _agg_distinct_text(c: F.Column) -> F.Column:
    """AGG-6: distinct non-null values joined with ', ' in sorted order (the
    source's order is unspecified); no value -> null."""
    s = F.array_sort(F.collect_set(c))
    return F.when(F.size(s) > 0, F.array_join(s, ", "))


@model("mart_resource_usage", "gold")
def mart_resource_usage(ctx: ModelContext) -> DataFrame:
    """Per stock item: best resource row (with a repository, then with a
    production id, then newest acceptance, then key), its repository /
    sub-project / project, stock facts, distribution teams, A&R and SEO
    owners, video use, and three ages at ``as_of`` (since stored, since last
    use for cold/in-use items, unused days for inventory items)."""
    from lakeward.operators.dedup import first_by
    from lakeward.operators.ordering import asc, desc
    res = ctx.ref("dim_resources").filter(b2n("hg_stock_id").isNotNull())
    best = first_by(res.select("hg_stock_id", "resource_name", "resource_source", "repository_type", "repository_id",
                               "production_plan_detail_id", "odoo_id", "acceptance_date", "dim_resources_sk"),
                    ["hg_stock_id"],
                    [asc(F.when(F.col("repository_id").isNotNull(), 0).otherwise(1)),
                     asc(F.when(F.col("odoo_id").isNotNull(), 0).otherwise(1)),
                     desc("acceptance_date", nulls_last=True), asc("dim_resources_sk")])
    repo = ctx.ref("dim_repository").select(F.col("repository_id").alias("__r_id"),
                                            F.col("repository_name").alias("repository"),
                                            F.col("sub_project_id").alias("__r_sp"))
    sp = ctx.ref("dim_sub_project").select("sub_project_id", "sub_project_name", F.col("project_id").alias("__sp_p"))
    pj = ctx.ref("dim_project").select("project_id", F.col("project_name").alias("project"))
    rh = (best.join(repo, F.col("repository_id") == F.col("__r_id"), "left")
          .join(sp, F.col("__r_sp") == sp["sub_project_id"], "left")
          .join(pj, F.col("__sp_p") == pj["project_id"], "left")
          .select(F.col("hg_stock_id").alias("resource_id"), "resource_name",
                  F.col("resource_source").alias("resource_origin"), F.col("repository_type").alias("source"),
                  "repository_id", "repository", "sub_project_id", "sub_project_name", "project_id", "project",
                  "production_plan_detail_id"))

    si = ctx.ref("dim_stock").filter(b2n("hg_stock_id").isNotNull()).select(
        F.col("hg_stock_id").alias("__si_id"), F.col("name").alias("stock_name"), "isrc", "stock_stored_date",
        F.col("status").alias("stock_status"))
    dt_ = (ctx.ref("fact_distribution").filter(b2n("hg_stock_id").isNotNull())
           .groupBy(F.col("hg_stock_id").alias("__dt_id"))
           .agg(_agg_distinct_text(b2n("team")).alias("distribution_team"),
                F.max("distribution_date").cast("date").alias("last_distribution_date")))
    ar = ctx.ref("dim_ar").select(F.col(f"`{L.AR_ID_COL}`").alias("__ar_id"), F.col(f"`{L.AR_NAME_COL}`").alias("__ar_name"))
    ar_by = (rh.select(F.col("resource_id").alias("__ar_res"), "production_plan_detail_id")
             .join(ar, F.col("production_plan_detail_id") == F.col("__ar_id"), "left")
             .groupBy("__ar_res").agg(_agg_distinct_text(b2n("__ar_name")).alias("ar_name")))
    xms = ctx.source("x_music_song").filter(F.col("employee_id").isNotNull()) \
        .select(F.col("id").cast("string").alias("__x_id"), F.col("employee_id").cast("bigint").alias("__emp"))
    he = ctx.source("hr_employee").select(F.col("id").cast("bigint").alias("__he_id"), F.col("name").alias("__he_name"))
    seo = (res.select("hg_stock_id", b2n("odoo_id").alias("__odoo")).join(xms, F.col("__odoo") == F.col("__x_id"))
           .join(he, F.col("__he_id") == F.col("__emp"), "left")
           .groupBy(F.col("hg_stock_id").alias("__seo_id"))
           .agg(_agg_distinct_text(F.col("__emp").cast("string")).alias("seo_employee_id"),
                _agg_distinct_text(b2n("__he_name")).alias("seo_name")))
    fe = ctx.ref("fact_editing").filter(b2n("hg_stock_id").isNotNull() & b2n("editing_code").isNotNull()) \
        .select("hg_stock_id", "editing_code")
    b = ctx.ref("bridge_bt_vid").filter(b2n("video_id").isNotNull()).select("editing_code", "video_id")
    dv = ctx.ref("dim_video").select(F.col("video_id").alias("__dv_id"), "published_date")
    # distinct (stock, video) pairs counted with a partial aggregate; newest
    # publish per editing code first, so the stock join sees one row per code
    vcount = (fe.join(b, "editing_code").groupBy(F.col("hg_stock_id").alias("__vu_id"))
              .agg(F.count_distinct("video_id").alias("used_video_count")))
    per_code = (b.join(dv, F.col("video_id") == F.col("__dv_id"), "left").groupBy("editing_code")
                .agg(F.max("published_date").alias("__pub")))
    vlast = (fe.join(per_code, "editing_code").groupBy(F.col("hg_stock_id").alias("__vl_id"))
             .agg(F.max("__pub").cast("date").alias("last_used_published_date")))
    vu = vcount.join(vlast, F.col("__vu_id") == F.col("__vl_id"), "left")

    j = (rh.join(si, F.col("resource_id") == F.col("__si_id"), "left")
         .join(dt_, F.col("resource_id") == F.col("__dt_id"), "left")
         .join(ar_by, F.col("resource_id") == F.col("__ar_res"), "left")
         .join(seo, F.col("resource_id") == F.col("__seo_id"), "left")
         .join(vu, F.col("resource_id") == F.col("__vu_id"), "left"))
    as_of = as_date_lit(ctx.as_of)
    stored = F.col("stock_stored_date").cast("date")
    return j.select(
        sk("resource_id").alias("mart_resource_usage_sk"), "resource_id", "resource_name", "stock_name", "isrc",
        "resource_origin", "source", "repository", "repository_id", "sub_project_name", "sub_project_id", "project",
        "project_id", "stock_status", stored.alias("stock_stored_date"),
        F.when(stored.isNotNull(), days_between(as_of, stored)).alias("resource_age_days"),
        "distribution_team", "last_distribution_date", "ar_name", "seo_employee_id", "seo_name",
        F.coalesce("used_video_count", F.lit(0)).alias("used_video_count"), "last_used_published_date",
        F.when(F.col("stock_status").isin(L.STOCK_COLD, L.STOCK_IN_USE) & F.col("last_used_published_date").isNotNull(),
               days_between(as_of, "last_used_published_date")).alias("days_since_last_usage"),
        F.when((F.col("stock_status") == L.STOCK_IN_INVENTORY) & stored.isNotNull(),
               days_between(as_of, stored)).alias("inventory_unused_days"))
