"""Silver dimension models (SURVEY 2.14: simple projections, lookups,
latest-wins and priority picks).

Conventions shared by every model:
* ``b2n(x)`` = ``nullif(trim(cast(x as string)), '')`` on every raw field;
* surrogate keys are md5 over the '-'-joined fields (PRJ-3);
* DISTINCT ON without a full tie-break in the source SQL gets a declared
  total order here (WIN-4), written next to each pick.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.cleanse import blank_to_null as b2n
from lakeward.functions.cleanse import build_url, json_locale_pick, typed_null
from lakeward.functions.keys import surrogate_key as sk
from lakeward.functions.predicates import distinct_from, is_false, is_true
from lakeward.models import labels as L
from lakeward.models.base import ModelContext, model
from lakeward.operators.dedup import first_by, latest_by, mutual_best_match
from lakeward.operators.ordering import asc, desc


def _text(df: DataFrame, key: str, out: dict[str, str], sk_name: str) -> DataFrame:
    """Surrogate key on ``key`` plus blank-to-null text columns."""
    return df.select(sk(key).alias(sk_name), *[b2n(src).alias(dst) for dst, src in out.items()])


@model("dim_usd", "silver")
def dim_usd(ctx: ModelContext) -> DataFrame:
    """Daily USD rate: date and rate as double (the stored order is not kept)."""
    return ctx.source("usd_rate").select(F.col("record_date").cast("date").alias("record_date"),
                                         F.col("exchange_rate").cast("double").alias("exchange_rate"))


@model("dim_ar", "silver")
def dim_ar(ctx: ModelContext) -> DataFrame:
    """Employees as A&R owners (output names are the warehouse's own)."""
    return _text(ctx.source("hr_employee"), "id", {L.AR_ID_COL: "id", L.AR_NAME_COL: "name"}, "dim_ar_sk")


@model("dim_company", "silver")
def dim_company(ctx: ModelContext) -> DataFrame:
    return _text(ctx.source("res_company"), "id", {"company_id": "id", "company_name": "name"},
                 "dim_company_sk")


@model("dim_artist", "silver")
def dim_artist(ctx: ModelContext) -> DataFrame:
    """Partners; the column names are the warehouse's (platform_*), kept for
    compatibility although the rows are artists (hazard H12)."""
    return _text(ctx.source("res_partner"), "id", {"platform_id": "id", "platform_name": "name"},
                 "dim_artist_sk")


@model("dim_artist_distro", "silver")
def dim_artist_distro(ctx: ModelContext) -> DataFrame:
    """Distinct (artist id, artist name) of the stream reports (GROUP BY on raw values)."""
    raw = (ctx.source("stream_distro").filter(b2n("idArtist").isNotNull())
           .select("idArtist", "mainArtist").distinct())
    return raw.select(sk("idArtist").alias("dim_artist_distro_sk"),
                      b2n("idArtist").alias("artist_id"), b2n("mainArtist").alias("artist_name"))


@model("dim_net", "silver")
def dim_net(ctx: ModelContext) -> DataFrame:
    return _text(ctx.source("network"), "Id", {"net_id": "Id", "net_name": "Name"}, "dim_net_sk")


@model("dim_partners", "silver")
def dim_partners(ctx: ModelContext) -> DataFrame:
    """One row per raw partner name (every output column is a function of it)."""
    raw = (ctx.source("partners").filter(b2n(L.PARTNER_NAME_COL).isNotNull())
           .select(F.col(f"`{L.PARTNER_NAME_COL}`").alias("__n")).distinct())
    return raw.select(sk("__n").alias("partner_id"), b2n("__n").alias("partner_name"))


@model("dim_platform", "silver")
def dim_platform(ctx: ModelContext) -> DataFrame:
    """Distinct retailers; the key is derived from the name (emitted as artist_*,
    the warehouse's names, hazard H12)."""
    raw = ctx.source("sale").filter(b2n("retailer").isNotNull()).select("retailer").distinct()
    return raw.select(sk("retailer").alias("dim_platform_sk"), sk("retailer").alias("artist_id"),
                      b2n("retailer").alias("artist_name"))


def _project_level(ctx: ModelContext, root: bool, prefix: str) -> DataFrame:
    p = ctx.source("project")
    p = p.filter(F.col("ParentId").isNull() if root else F.col("ParentId").isNotNull())
    return _text(p, "Id", {f"{prefix}_id": "Id", f"{prefix}_name": "ProjectName"}, f"dim_{prefix.replace('_', '')}_stock_sk")


@model("dim_project_stock", "silver")
def dim_project_stock(ctx: ModelContext) -> DataFrame:
    """Root projects of the stock system (no parent)."""
    return _project_level(ctx, True, "project")


@model("dim_subproject_stock", "silver")
def dim_subproject_stock(ctx: ModelContext) -> DataFrame:
    """Child projects of the stock system (with a parent)."""
    return _project_level(ctx, False, "sub_project")


@model("dim_editing", "silver")
def dim_editing(ctx: ModelContext) -> DataFrame:
    """Editing files: distinct raw (code, title, software, created) rows."""
    raw = (ctx.source("editings").filter(b2n("EditingFileId").isNotNull())
           .select("EditingFileId", "Title", "EditingSoftware", "CreatedDate").distinct())
    return raw.select(sk("EditingFileId").alias("dim_editing_sk"),
                      b2n("EditingFileId").alias("editing_code"),
                      b2n("Title").alias("editing_name"),
                      F.nullif(F.col("EditingSoftware").cast("string"), F.lit("")).alias("software"),
                      b2n("CreatedDate").cast("timestamp").alias("date"))


@model("dim_khsx", "silver")
def dim_khsx(ctx: ModelContext) -> DataFrame:
    """Production plans."""
    return _text(ctx.source("x_music_plan"), "id",
                 {"production_plan_id": "id", "plan_name": "name", "created_date": "create_date",
                  "production_month": "date", "status": "state", "created_by": "create_uid"},
                 "dim_khsx_sk")


@model("dim_po", "silver")
def dim_po(ctx: ModelContext) -> DataFrame:
    """Purchase order headers (the approval column name is a variable, hazard H4)."""
    po = ctx.source("purchase_order")
    approved = str(ctx.vars.get("po_approved_column", "date_approve"))
    return po.select(sk("id").alias("dim_po_sk"), b2n("id").alias("po_id"),
                     b2n("create_date").cast("timestamp").alias("po_created_date"),
                     b2n("user_id").alias("order_employee_id"), b2n("company_id").alias("ordering_company"),
                     b2n("state").alias("status"), b2n(approved).cast("timestamp").alias("po_confirmed_date"),
                     b2n("name").alias("po_name"))


@model("dim_so", "silver")
def dim_so(ctx: ModelContext) -> DataFrame:
    """Sale order *lines* with their header name (left lookup)."""
    sol = ctx.source("sale_order_line").alias("sol")
    so = ctx.source("sale_order").select(F.col("id").alias("__so_id"), F.col("name").alias("__so_name"))
    j = sol.join(so, F.col("sol.order_id") == F.col("__so_id"), "left")
    return j.select(sk("sol.id").alias("dim_so_sk"), b2n("sol.id").alias("so_id"),
                    b2n("__so_name").alias("so_name"), b2n("sol.x_purchase_line_id").alias("po_id"),
                    b2n("sol.create_date").cast("timestamp").alias("so_created_date"),
                    b2n("sol.write_date").cast("timestamp").alias("so_confirmed_date"),
                    b2n("sol.state").alias("status"))


@model("dim_distributed_employee", "silver")
def dim_distributed_employee(ctx: ModelContext) -> DataFrame:
    """Users of the distribution system; department, team and role are not
    resolved in the warehouse either (typed null columns)."""
    return ctx.source("users").select(
        sk("Id").alias("dim_distributed_employee_sk"), b2n("Id").alias("emp_id"),
        b2n("DisplayName").alias("emp_name"), typed_null("string").alias("department_id"),
        typed_null("string").alias("team"), typed_null("string").alias("role"))


@model("dim_department", "silver")
def dim_department(ctx: ModelContext) -> DataFrame:
    """Departments; the name is a JSON object of translations: Vietnamese
    first, then English (PRJ-16)."""
    hd = ctx.source("hr_department")
    return hd.select(sk("id").alias("dim_department_sk"), b2n("id").alias("department_id"),
                     b2n("company_id").alias("company_id"),
                     b2n(json_locale_pick(F.col("name").cast("string"), ["vi_VN", "en_US"])).alias("department_name"))


def resource_status(state, produce_state):
    """PRJ-9 status CASE of a produced song."""
    s = F.col(state)
    ps = F.col(produce_state)
    return (F.when((s == "approved") & (ps == F.lit(L.REJECTED_PRODUCE_STATE)), F.lit(L.STATUS_NOT_ACCEPTED))
            .when((s == "approved") & distinct_from(ps, F.lit(L.REJECTED_PRODUCE_STATE)), F.lit(L.STATUS_ACCEPTED))
            .when(s == "draft", F.lit(L.STATUS_IN_PRODUCTION))
            .when(s == "rejected", F.lit(L.STATUS_NOT_ACCEPTED))
            .otherwise(typed_null("string")))


@model("dim_resource", "silver")
def dim_resource(ctx: ModelContext) -> DataFrame:
    """Produced songs with typed score/cost/date and status.  The key hashes
    the song id (the warehouse hashes a per-source constant, hazard H1)."""
    s = ctx.source("x_music_song")
    return s.select(sk("id").alias("dim_resource_sk"), b2n("id").alias("resource_id"),
                    b2n("subgenre_id").alias("repository_id"), b2n("song_name").alias("resource_name"),
                    b2n("name").alias("song_code"),
                    b2n("review_score").cast("decimal(18,2)").alias("acceptance_score"),
                    b2n("review_price").cast("decimal(18,2)").alias("acceptance_cost"),
                    b2n("review_date").cast("timestamp").alias("acceptance_date"),
                    b2n("detail_line_id").alias("production_plan_detail_id"),
                    resource_status("state", "produce_state").alias("status"),
                    b2n("sale_order_id").alias("so_id"), b2n("purchase_order_line_id").alias("po_detail_id"))


@model("dim_company_stock", "silver")
def dim_company_stock(ctx: ModelContext) -> DataFrame:
    """Departments whose level is the company level (inner join on a filtered level table)."""
    levels = (ctx.source("departmentlevel").filter(F.trim("Name") == F.lit(L.COMPANY_LEVEL_NAME))
              .select(F.col("Id").alias("__lvl")))
    d = ctx.source("department")
    j = d.join(levels, d["DepartmentLevelId"] == F.col("__lvl"), "inner")
    return j.select(sk(d["Id"]).alias("dim_company_stock_sk"), b2n(d["Id"]).alias("company_id"),
                    b2n(d["Name"]).alias("company_name"))


def company_channels(ctx: ModelContext, require_not_deleted: bool = False) -> DataFrame:
    """Channels (id, trimmed channel id) owned by the target company
    (``var target_company_id``): EXISTS on channel_company, as a semi join."""
    ch = ctx.source("channel")
    cc = ctx.source("channel_company").filter(
        is_false("IsDeleted", nulls_as_false=True) & (F.col("CompanyId") == F.lit(ctx.var("target_company_id"))))
    ch = ch.filter(b2n("YoutubeChannelId").isNotNull())
    if require_not_deleted:
        ch = ch.filter(is_false("IsDeleted", nulls_as_false=True))
    owned = ch.join(cc.select(F.col("ChannelId").alias("__cid")), ch["Id"] == F.col("__cid"), "left_semi")
    return owned.select(F.col("Id").alias("channel_pk"), b2n("YoutubeChannelId").alias("channel_id"))


@model("dim_video", "silver")
def dim_video(ctx: ModelContext) -> DataFrame:
    """Videos of company channels, newest publish per video id (WIN-1; DESC
    puts a null publish time first, as in the source SQL)."""
    cm = company_channels(ctx).select(F.col("channel_id").alias("__ch"))
    cvi = ctx.source("channel_video_info").filter(b2n("YoutubeVideoId").isNotNull())
    cvi = cvi.join(cm, b2n(cvi["YoutubeChannelId"]) == F.col("__ch"), "left_semi")
    cvi = cvi.select("YoutubeVideoId", "YoutubeChannelId", "Code", "PublishedAt", "Title")
    best = latest_by(cvi, ["YoutubeVideoId"], "PublishedAt",
                     tie_break=[asc("YoutubeChannelId"), asc("Code"), asc("Title")])
    return best.select(sk("YoutubeVideoId").alias("dim_video_sk"), b2n("YoutubeVideoId").alias("video_id"),
                       b2n("YoutubeChannelId").alias("channel_id"),
                       build_url(L.VIDEO_URL_PREFIX, F.col("YoutubeVideoId")).alias("video_url"),
                       b2n("Code").alias("editing_code"),
                       F.col("PublishedAt").cast("timestamp").alias("published_date"),
                       b2n("Title").alias("video_name"))


@model("dim_channel", "silver")
def dim_channel(ctx: ModelContext) -> DataFrame:
    """Channels with project, newest assigned user, network and company.

    Picks (declared orders for the source's DISTINCT ON, hazard H21):
    user per channel = newest ``CreatedTimeUtc`` (nulls first), then user name;
    company per channel = smallest company id; row per YouTube channel id =
    smallest (project, sub-project, network, company, employee, title)."""
    cu = ctx.source("channel_user").filter(F.col("IsDeleted") == F.lit(False))
    users = ctx.source("user").select(F.col("Id").alias("__uid"), F.col("FullName").alias("employee_name"))
    cu = cu.join(users, cu["UserId"] == F.col("__uid"), "left").select(
        F.col("ChannelId").alias("channel_id"), "CreatedTimeUtc", "employee_name")
    user_map = latest_by(cu, ["channel_id"], "CreatedTimeUtc", tie_break=[asc("employee_name")]) \
        .select(F.col("channel_id").alias("__cu_ch"), "employee_name")

    deal = ctx.source("channel_deal").filter((F.col("IsDeleted") == F.lit(False)) & (F.col("IsOutNet") == F.lit(False)))
    cms = ctx.source("cms").select(F.col("Id").alias("__cms"), F.col("NetworkId").alias("__net_ref"))
    net = ctx.source("network").select(F.col("Id").alias("network_id"))
    net_map = (deal.join(cms, deal["CmsId"] == F.col("__cms"), "left")
               .join(net, F.col("__net_ref") == F.col("network_id"), "left")
               .select(F.col("ChannelId").alias("__nm_ch"), "network_id"))

    cdep = ctx.source("channeldepartment")
    dept = ctx.source("department").select(F.col("Id").alias("__dep"), F.col("DepartmentLevelId").alias("__lvl_ref"))
    lvl = (ctx.source("departmentlevel").filter(F.col("Name").like(f"%{L.COMPANY_LEVEL_NAME}%"))
           .select(F.col("Id").alias("__lvl")))
    comp = (cdep.join(dept, cdep["DepartmentId"] == F.col("__dep"), "inner")
            .join(lvl, F.col("__lvl_ref") == F.col("__lvl"), "inner")
            .select(F.col("ChannelId").alias("__cc_ch"), F.col("__dep").alias("company_id")))
    comp_map = first_by(comp, ["__cc_ch"], [asc("company_id")])

    c = ctx.source("channel")
    cp = ctx.source("channel_project").select(F.col("ChannelId").alias("__cp_ch"), F.col("ProjectId").alias("__pid"))
    proj = ctx.source("project").select(F.col("Id").alias("__proj"), F.col("ParentId").alias("__parent"))
    j = (c.join(cp, c["Id"] == F.col("__cp_ch"), "left")
         .join(proj, F.col("__pid") == F.col("__proj"), "left")
         .join(user_map, c["Id"] == F.col("__cu_ch"), "left")
         .join(net_map, c["Id"] == F.col("__nm_ch"), "left")
         .join(comp_map, c["Id"] == F.col("__cc_ch"), "left"))
    rows = j.select(
        F.col("YoutubeChannelId").alias("__ytc"),
        sk("YoutubeChannelId").alias("dim_channel_sk"),
        b2n("YoutubeChannelId").alias("channel_id"), b2n("Title").alias("channel_name"),
        b2n("company_id").alias("company_id"), b2n("employee_name").alias("employee_name"),
        b2n("__pid").alias("project_id"), b2n("__parent").alias("sub_project_id"),
        F.when(b2n("YoutubeChannelId").isNotNull(),
               F.concat(F.lit(L.CHANNEL_URL_PREFIX), F.trim(F.col("YoutubeChannelId").cast("string"))))
         .alias("link"),
        b2n("network_id").alias("network_id"))
    order = [asc(c_) for c_ in ("project_id", "sub_project_id", "network_id", "company_id",
                                 "employee_name", "channel_name")]
    return first_by(rows, ["__ytc"], order).drop("__ytc")


@model("dim_order_employee", "silver")
def dim_order_employee(ctx: ModelContext) -> DataFrame:
    """Users that placed purchase orders, with their first employee record
    (lowest employee id per user, WIN-11 as a top-1 aggregate)."""
    po_users = ctx.source("purchase_order").filter(F.col("user_id").isNotNull()) \
        .select(F.col("user_id").alias("__u")).distinct()
    hu = ctx.source("res_users").select(F.col("id").alias("__hu"))
    he = ctx.source("hr_employee").filter(F.col("user_id").isNotNull()) \
        .select("id", "user_id", "department_id", "name", "job_title", "company_id")
    first_emp = first_by(he, ["user_id"], [asc("id")])
    base = (po_users.join(hu, F.col("__u") == F.col("__hu"), "inner")
            .join(first_emp, F.col("__hu") == first_emp["user_id"], "left"))
    return base.select(sk("__hu").alias("dim_order_employee_sk"), b2n("id").alias("order_employee_id"),
                       b2n("__hu").alias("employee_id"), b2n("department_id").alias("department_id"),
                       b2n("name").alias("employee_name"), typed_null("string").alias("team_name"),
                       b2n("job_title").alias("position"), b2n("company_id").alias("company_id"))


@model("dim_isrc", "silver")
def dim_isrc(ctx: ModelContext) -> DataFrame:
    """Stock code <-> ISRC one-to-one mapping from two prioritised sources
    (songs = 1, legacy sheet = 2), kept where the pair is each side's first
    choice (WIN-5), restricted to ISRCs that earn distributor revenue."""
    songs = (ctx.source("x_music_song").filter(is_true("active"))
             .select(b2n("name").alias("hg_stock_id"), b2n("isrc").alias("isrc"), F.lit(1).alias("source_priority")))
    legacy = ctx.source("resource_before_odoo").select(
        b2n(F.col(f"`{L.SONG_CODE_COL}`")).alias("hg_stock_id"), b2n("ISRC").alias("isrc"),
        F.lit(2).alias("source_priority"))
    maps = songs.unionByName(legacy).filter(F.col("hg_stock_id").isNotNull() & F.col("isrc").isNotNull())
    # A pair listed by both sources is ranked by its better priority in both
    # windows; its second copy never ranks first, so one row per pair is exact.
    maps = maps.groupBy("hg_stock_id", "isrc").agg(F.min("source_priority").alias("source_priority"))
    pairs = mutual_best_match(maps, "hg_stock_id", "isrc", [asc("source_priority")],
                              a_tie=[asc("isrc")], b_tie=[asc("hg_stock_id")])
    distro = ctx.ref("fact_revenue_distro").select(b2n("isrc").alias("isrc")) \
        .filter(F.col("isrc").isNotNull()).distinct()
    out = pairs.join(distro, "isrc", "inner")
    return out.select(sk("hg_stock_id", "isrc").alias("dim_isrc_sk"), "hg_stock_id", "isrc")


@model("dim_resource_before_odoo", "silver")
def dim_resource_before_odoo(ctx: ModelContext) -> DataFrame:
    """Legacy sheet of songs, one row per trimmed ISRC (error tokens
    dropped), with the sub-project resolved by name.  Declared pick among
    rows of one ISRC: raw ISRC, song code, sub-project id, then the rest."""
    rbo = ctx.source("resource_before_odoo")
    rbo = rbo.filter(b2n("ISRC").isNotNull() & ~F.trim("ISRC").isin(list(L.SHEET_ERRORS)))
    dsp = ctx.ref("dim_sub_project").select(F.col("sub_project_name").alias("__spn"), "sub_project_id")
    j = rbo.join(dsp, b2n("Subgenre") == F.col("__spn"), "left")
    rows = j.select(F.trim("ISRC").alias("__isrc_key"), F.col("ISRC").alias("__raw"),
                    sk("ISRC").alias("dim_resource_before_odoo_sk"), b2n("ISRC").alias("isrc"),
                    b2n(F.col(f"`{L.SONG_CODE_COL}`")).alias("resource_name"),
                    b2n(F.col(f"`{L.AVG_SCORE_COL}`")).cast("decimal(18,2)").alias("aceptance_score"),
                    b2n(F.col(f"`{L.UNIT_COST_COL}`")).cast("decimal(18,2)").alias("aceptance_price"),
                    b2n(F.col(f"`{L.AR_IN_CHARGE_COL}`")).alias("ar"),
                    b2n(F.col(f"`{L.ARTIST_COL}`")).alias("artist"), "sub_project_id")
    order = [asc(c) for c in ("__raw", "resource_name", "sub_project_id", "aceptance_score",
                              "aceptance_price", "ar", "artist")]
    return first_by(rows, ["__isrc_key"], order).drop("__isrc_key", "__raw")


def _stock_candidates(ctx: ModelContext) -> DataFrame:
    """The five prioritised stock sources (SET-1), one schema."""
    from pyspark.sql import types as T
    rf = ctx.source("resource_files").filter(b2n("Id").isNotNull() & (F.col("MediaType") == F.lit(1)))
    rfi = ctx.source("resource_file_info").select(b2n("ResourceFileId").alias("__rfi_file"),
                                                  b2n("Id").alias("__rfi_id"), F.col("ISRC").alias("__rfi_isrc"))
    prefix = ctx.vars.get("stock_link_prefix")
    suffix = str(ctx.vars.get("stock_link_suffix", "/0"))
    link = (F.when(F.col("__rfi_id").isNotNull(), F.concat(F.lit(prefix), F.col("__rfi_id"), F.lit(suffix)))
            if prefix is not None else typed_null("string"))
    base = rf.join(rfi, b2n(rf["Id"]) == F.col("__rfi_file"), "left").select(
        b2n(rf["Id"]).alias("hg_stock_id"), rf["FileName"].cast("string").alias("name"),
        b2n("__rfi_isrc").alias("isrc"), rf["CreatedDate"].cast("timestamp").alias("created"),
        link.alias("stock_link"), F.lit(1).alias("source_priority"))

    def col(name):
        return F.col(f"`{name}`")

    def sheet(df, code, name, isrc, priority, extra=None):
        cond = b2n(code).isNotNull() & F.regexp_like(F.trim(code), F.lit(L.STOCK_CODE_LOOSE))
        if extra is not None:
            cond = cond & extra
        return df.filter(cond).select(b2n(code).alias("hg_stock_id"), b2n(name).alias("name"), isrc.alias("isrc"),
                                      typed_null(T.TimestampType()).alias("created"),
                                      typed_null("string").alias("stock_link"), F.lit(priority).alias("source_priority"))

    perf = ctx.source("resource_performance")
    proj = col(L.PERF_PROJECT_COL)
    from lakeward.functions.keys import nfc
    perf_ok = (b2n(proj).isNotNull() & (F.upper(F.trim(proj)) != F.lit("#N/A"))
               & (F.lower(nfc(F.trim(proj))) != F.lit(L.UNKNOWN_PROJECT)))
    p = sheet(perf, col(L.PERF_STOCK_COL), col(L.PERF_NAME_COL),
              F.coalesce(*[b2n(col(c)) for c in L.PERF_ISRC_COLS]), 2, perf_ok)
    rbo = ctx.source("resource_before_odoo")
    r = sheet(rbo, col(L.RBO_STOCK_COL), col(L.RBO_TITLE_COL),
              F.when(F.trim("ISRC").isin(list(L.SHEET_ERRORS)), typed_null("string")).otherwise(b2n("ISRC")), 3)
    pr = sheet(ctx.source("purchased_resource"), col(L.PURCHASED_CODE_COL), col(L.TITLE_COL),
               typed_null("string"), 4)
    add = sheet(ctx.source("resource_infomation_add"), col("ResourceFileId"), col(L.TITLE_COL), b2n("ISRC"), 5)
    return base.unionByName(p).unionByName(r).unionByName(pr).unionByName(add)


@model("dim_stock", "silver")
def dim_stock(ctx: ModelContext) -> DataFrame:
    """Catalogue stock items from five prioritised sources (stored files,
    performance sheet, legacy sheet, purchased list, additions), minus the
    exclusion list; one row per code: best source, then a name that is not a
    ``.wav`` file name, then the earliest stored date (then name, ISRC, link);
    first/last use in a published video, age at ``as_of`` and lifecycle
    status (archived / never used / cold after 30 days / in use).  The admin
    link is ``var stock_link_prefix`` + file-info id + ``stock_link_suffix``."""
    excluded = ctx.ref("int_excluded_stock_codes").filter(b2n("hg_stock_id").isNotNull()) \
        .select(F.upper(F.trim("hg_stock_id")).alias("__ex"))
    cand = _stock_candidates(ctx).join(excluded, F.upper(F.trim("hg_stock_id")) == F.col("__ex"), "left_anti")
    not_wav = F.when(~F.col("name").ilike("%.wav"), F.lit(0)).otherwise(F.lit(1))
    best = first_by(cand.withColumn("__wav", not_wav), ["hg_stock_id"],
                    [asc("source_priority"), asc("__wav"), asc("created"), asc("name"), asc("isrc"),
                     asc("stock_link")]).drop("__wav", "source_priority")

    fe = ctx.ref("fact_editing").select("hg_stock_id", "editing_code")
    b = ctx.ref("bridge_bt_vid").select("editing_code", "video_id")
    v = ctx.ref("dim_video").filter(F.col("published_date").isNotNull()) \
        .select("video_id", F.col("published_date").cast("date").alias("__d"))
    per_code = b.join(v, "video_id").groupBy("editing_code").agg(F.min("__d").alias("__lo"), F.max("__d").alias("__hi"))
    vid = (fe.join(per_code, "editing_code").groupBy(F.col("hg_stock_id").alias("__v_stock"))
           .agg(F.min("__lo").alias("first_published_date"), F.max("__hi").alias("last_published_date")))

    h = ctx.source("resource_storage_history").filter(F.col("ToStatus") == F.lit(L.ARCHIVED_STATUS)) \
        .select(b2n("ResourceFileInfoId").alias("__h_info"))
    rfi = ctx.source("resource_file_info").select(b2n("Id").alias("__h_info"), b2n("ResourceFileId").alias("__h_file"))
    rf = ctx.source("resource_files").filter((F.col("MediaType") == F.lit(1)) & b2n("Id").isNotNull()) \
        .select(b2n("Id").alias("__h_file"))
    archived = h.join(rfi, "__h_info").join(rf, "__h_file").select(F.col("__h_file").alias("__a_stock")).distinct()

    as_of = F.lit(ctx.as_of).cast("date")
    j = (best.join(vid, best["hg_stock_id"] == F.col("__v_stock"), "left")
         .join(archived, best["hg_stock_id"] == F.col("__a_stock"), "left"))
    status = (F.when(F.col("__a_stock").isNotNull(), F.lit(L.STOCK_ARCHIVED))
              .when(F.col("__v_stock").isNull(), F.lit(L.STOCK_IN_INVENTORY))
              .when(F.col("last_published_date") < F.date_sub(as_of, L.COLD_AFTER_DAYS), F.lit(L.STOCK_COLD))
              .otherwise(F.lit(L.STOCK_IN_USE)))
    return j.select(sk("hg_stock_id").alias("dim_stock_sk"), "hg_stock_id", b2n("name").alias("name"), "isrc",
                    "stock_link", F.col("created").cast("timestamp").alias("stock_stored_date"),
                    "first_published_date",
                    F.datediff(as_of, F.col("created").cast("date")).alias("resource_age_days"),
                    status.alias("status"))


def _first_name_per_key(names: DataFrame) -> DataFrame:
    """DISTINCT ON (name key) ORDER BY key, name over (project_name) rows."""
    from lakeward.functions.keys import match_key
    keyed = names.filter(F.col("project_name").isNotNull()) \
        .withColumn("project_name_key", match_key("project_name"))
    return first_by(keyed.select("project_name_key", "project_name"), ["project_name_key"], [asc("project_name")])


@model("dim_project", "silver")
def dim_project(ctx: ModelContext) -> DataFrame:
    """Projects from six sources resolved by normalised name (NFC, trimmed,
    white space collapsed, compared lower case): one canonical id per name
    (numeric ids first, numerically, then text; JN-16/WIN-2), then one row
    per id.  Sheet-only names get a hashed id, or the id already stored for
    the same name: the previous build is an optional input
    ``provided['dim_project_previous']`` (hazard H3; empty on a first build).
    Distro names listing several projects split on '/', and an optional
    ``project_name_aliases`` table (source_project_name_key,
    target_project_name_key) maps a distro name onto a stored project."""
    from lakeward.functions.cleanse import JAVA_WHITESPACE
    from lakeward.functions.keys import match_key, nfc, normalize_text
    from lakeward.operators.ordering import numeric_first
    spark = ctx.spark
    null_s = typed_null("string")

    def col(name):
        return F.col(f"`{name}`")

    odoo = ctx.source("x_project").select(b2n("id").alias("project_id"), normalize_text(F.col("name").cast("string"))
                                          .alias("project_name"), b2n("state").alias("status"))
    partners = ctx.source("partners").filter(b2n(col(L.PROJECT_COL)).isNotNull()).select(
        sk(col(L.PROJECT_COL)).alias("project_id"), normalize_text(col(L.PROJECT_COL)).alias("project_name"),
        null_s.alias("status"))

    def hashed(named):
        return named.select(sk("project_name_key").alias("project_id"), "project_name", null_s.alias("status"))

    rbo = ctx.source("resource_before_odoo").filter(b2n(col(L.GENRE_COL)).isNotNull()) \
        .select(normalize_text(col(L.GENRE_COL)).alias("project_name"))
    perf_col = col(L.PERF_PROJECT_COL)
    perf = ctx.source("resource_performance").filter(
        b2n(perf_col).isNotNull() & (F.upper(F.trim(perf_col)) != F.lit("#N/A"))
        & (F.lower(nfc(F.trim(perf_col))) != F.lit(L.UNKNOWN_PROJECT))) \
        .select(normalize_text(perf_col).alias("project_name"))

    prev = ctx.provided.get("dim_project_previous")
    if prev is None:
        prev = spark.createDataFrame([], "project_id string, project_name string, status string")
    prev = prev.select(b2n("project_id").alias("project_id"), normalize_text("project_name").alias("project_name"),
                       F.col("status").cast("string").alias("status"))
    prev = prev.filter(F.col("project_id").isNotNull() & F.col("project_name").isNotNull()) \
        .withColumn("project_name_key", match_key("project_name"))
    existing = first_by(prev, ["project_name_key"], numeric_first("project_id")) \
        .select(F.col("project_name_key").alias("__x_key"), F.col("project_id").alias("__x_id"),
                F.col("project_name").alias("__x_name"), F.col("status").alias("__x_status"))

    def via_existing(named, key_col="project_name_key"):
        j = named.join(existing, F.col(key_col) == F.col("__x_key"), "left")
        return j.select(F.coalesce("__x_id", sk("project_name_key")).alias("project_id"),
                        F.coalesce("__x_name", "project_name").alias("project_name"),
                        F.col("__x_status").alias("status"))

    sep = f"{JAVA_WHITESPACE}*/{JAVA_WHITESPACE}*"
    distro = ctx.source("distro_infomation").filter(b2n(col(L.PROJECT_COL)).isNotNull()) \
        .select(F.explode(F.split(col(L.PROJECT_COL).cast("string"), sep)).alias("__v")) \
        .select(normalize_text("__v").alias("project_name"))
    distro = _first_name_per_key(distro.filter(F.lower("project_name") != F.lit(L.PROJECT_HEADER)))
    if "project_name_aliases" in ctx.sources:
        al = ctx.source("project_name_aliases").select(F.col("source_project_name_key").alias("__a_src"),
                                                       F.col("target_project_name_key").alias("__a_tgt"))
        distro = distro.join(al, F.col("project_name_key") == F.col("__a_src"), "left") \
            .withColumn("__lookup", F.coalesce("__a_tgt", "project_name_key"))
    else:
        distro = distro.withColumn("__lookup", F.col("project_name_key"))

    add_col = col(L.PROJECT_COL)
    add = ctx.source("resource_infomation_add").filter(
        b2n(add_col).isNotNull() & (F.upper(F.trim(add_col.cast("string"))) != F.lit("#N/A"))
        & ~F.lower(nfc(F.trim(add_col.cast("string")))).isin(list(L.NOT_PROJECTS))) \
        .select(normalize_text(add_col.cast("string")).alias("project_name"))

    combined = (odoo.unionByName(partners).unionByName(hashed(_first_name_per_key(rbo)))
                .unionByName(hashed(_first_name_per_key(perf)))
                .unionByName(via_existing(distro, "__lookup"))
                .unionByName(via_existing(_first_name_per_key(add))))
    norm = combined.filter(F.col("project_id").isNotNull() & b2n("project_name").isNotNull()).select(
        "project_id", normalize_text("project_name").alias("project_name"), "status",
        match_key("project_name").alias("project_name_key"))
    by_name = first_by(norm, ["project_name_key"],
                       numeric_first("project_id") + [asc("project_name"), asc("status", nulls_last=True)])
    by_id = first_by(by_name.select("project_id", "project_name", "status"), ["project_id"],
                     [asc("project_name"), asc("status", nulls_last=True)])
    return by_id.select(sk("project_id").alias("dim_project_sk"), "project_id", "project_name", "status")


@model("dim_purchased_resource", "silver")
def dim_purchased_resource(ctx: ModelContext) -> DataFrame:
    """Purchased catalogue items with their partner (alias map applied to the
    partner / repository names), the partner's newest sheet row (contract
    date, pricing), the project's default sub-project when the project name
    resolves to exactly one project (AGG-11), and candidate repositories of
    the same name within that sub-project (JN-8: equi key AND (no
    sub-project OR same sub-project)).  One row per stock code: a repository
    of the default sub-project first, then any repository, then one with the
    sub-project only; ties by partner, name and repository id."""
    from lakeward.functions.keys import match_key, normalize_text
    from lakeward.operators.dedup import unique_name_lookup

    def col(name):
        return F.col(f"`{name}`")

    nm = ctx.ref("int_purchase_name_map").select(match_key("alias_key").alias("__alias"),
                                                  normalize_text("canonical_name").alias("__canon"))
    pr = ctx.source("purchased_resource")
    pr = pr.filter(F.regexp_like(F.trim(col(L.PURCHASED_CODE_COL)), F.lit(L.STOCK_CODE_PATTERN))
                   & b2n(col(L.PURCHASED_REPO_COL)).isNotNull())
    # keys are materialised before each join (NFC runs through reflect, which
    # Spark treats as non-deterministic and refuses inside a join condition)
    pr = pr.withColumn("__repo_key", match_key(col(L.PURCHASED_REPO_COL)))
    pr = pr.join(nm, F.col("__repo_key") == F.col("__alias"), "left")
    partner = F.coalesce(F.col("__canon"), col(L.PURCHASED_REPO_COL))
    res = pr.select(b2n(col(L.PURCHASED_CODE_COL)).alias("hg_stock_id"),
                    b2n(col(L.TITLE_COL)).alias("resources_name"),
                    normalize_text(partner).alias("partner_name"), match_key(partner).alias("partner_key")).distinct()

    p = ctx.source("partners").filter(b2n(col(L.PARTNER_NAME_COL)).isNotNull())
    nm_p = nm.select(F.col("__alias").alias("__ap"), F.col("__canon").alias("__cp"))
    nm_r = nm.select(F.col("__alias").alias("__ar"), F.col("__canon").alias("__cr"))
    p = p.withColumn("__pn", match_key(col(L.PARTNER_NAME_COL))).withColumn("__pr", match_key(col(L.PARTNER_REPO_COL)))
    p = (p.join(nm_p, F.col("__pn") == F.col("__ap"), "left")
         .join(nm_r, F.col("__pr") == F.col("__ar"), "left"))
    pname = F.coalesce("__cp", "__cr", col(L.PARTNER_NAME_COL))
    prepared = p.select(normalize_text(pname).alias("__p_name"), match_key(pname).alias("__p_key"),
                        b2n(col(L.CONTRACT_DATE_COL)).alias("buy_date"),
                        b2n(col(L.PRICING_COL)).alias("repository_type"),
                        match_key(col(L.PROJECT_COL)).alias("__project_key"),
                        F.col("_loaded_at")).filter(F.col("__p_key").isNotNull())
    # newest sheet row per partner (nulls last); declared tie-break on the other columns
    partner_src = first_by(prepared, ["__p_key"], [desc("_loaded_at", nulls_last=True), asc("__p_name"),
                                                   asc("buy_date"), asc("repository_type"), asc("__project_key")])

    projects = ctx.ref("dim_project").filter(b2n("project_name").isNotNull())
    uniq = unique_name_lookup(projects, match_key("project_name"), "project_id", "__up_key", "__up_id")
    dsp = ctx.ref("dim_sub_project").filter(match_key("sub_project_name") == F.lit(L.DEFAULT_SUB_PROJECT_KEY)) \
        .select(F.col("sub_project_id"), F.col("project_id").alias("__dsp_project"))
    repo = ctx.ref("dim_repository").filter(b2n("repository_name").isNotNull()).select(
        F.col("repository_id"), F.col("sub_project_id").alias("__r_sub"),
        match_key("repository_name").alias("__r_key"))

    j = (res.join(partner_src.drop("_loaded_at"), F.col("partner_key") == F.col("__p_key"), "left")
         .join(uniq, F.col("__project_key") == F.col("__up_key"), "left")
         .join(dsp, F.col("__up_id") == F.col("__dsp_project"), "left"))
    j = j.join(repo, (F.col("__r_key") == F.col("partner_key"))
               & (F.col("sub_project_id").isNull() | (F.col("__r_sub") == F.col("sub_project_id"))), "left")
    in_default = F.col("repository_id").isNotNull() & (F.col("__r_sub") == F.col("sub_project_id"))
    rank = (F.when(in_default, 1).when(F.col("repository_id").isNotNull(), 2)
            .when(F.col("sub_project_id").isNotNull(), 3).otherwise(4))
    kept = ["hg_stock_id", "resources_name", "repository_id", "partner_name", "partner_key", "buy_date",
            "repository_type", "sub_project_id"]
    j = first_by(j.select(rank.alias("__rank"), *kept), ["hg_stock_id"],
                 [asc("__rank"), asc("partner_key"), asc("resources_name", nulls_last=True), asc("repository_id"),
                  asc("sub_project_id"), asc("partner_name"), asc("buy_date"), asc("repository_type")])
    return j.select(sk("hg_stock_id").alias("dim_purchased_resource_sk"), "hg_stock_id", "resources_name",
                    F.col("repository_id").alias("repository"), "partner_name", "partner_key",
                    sk("partner_key").alias("partner_id"), "buy_date", "repository_type", "sub_project_id")
