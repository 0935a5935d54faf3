"""Silver fact, bridge and helper models.

Deliberate departures from the source SQL, each listed in SURVEY 7.5:
* metric facts keep a metric row when *some* info row of its video is in a
  qualifying channel (EXISTS) instead of joining every duplicate info row
  (H10, no fan-out);
* surrogate keys include every grain column (H7);
* string lists resolved to names keep the list order (AGG-7);
* a rate table with several rates for one day uses the smallest (WIN-4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.cleanse import JAVA_WHITESPACE, json_or_text, ratio
from lakeward.functions.cleanse import blank_to_null as b2n
from lakeward.functions.cleanse import digits_only_number
from lakeward.functions.dates import month_end, month_key, month_start, strict_dmy
from lakeward.functions.keys import surrogate_key as sk
from lakeward.functions.predicates import is_true, matches_key
from lakeward.models import labels as L
from lakeward.models.base import ModelContext, model
from lakeward.models.silver_dims import company_channels
from lakeward.operators.allocate import position_weight
from lakeward.operators.dedup import first_by, latest_by, sequence_within
from lakeward.operators.generate import unpivot
from lakeward.operators.joins import explode_list, join_aggregated
from lakeward.operators.ordering import asc, desc


def upper_trim(c) -> F.Column:
    return F.upper(F.trim(F.col(c).cast("string") if isinstance(c, str) else c.cast("string")))


@model("int_excluded_stock_codes", "silver")
def int_excluded_stock_codes(ctx: ModelContext) -> DataFrame:
    """Distinct upper-cased stock codes of the manual exclusion seed."""
    seed = ctx.source("manual_excluded_stock_codes")
    return seed.filter(b2n("hg_stock_id").isNotNull()).select(upper_trim("hg_stock_id").alias("hg_stock_id")).distinct()


@model("int_purchase_name_map", "intermediate")
def int_purchase_name_map(ctx: ModelContext) -> DataFrame:
    """Canonical partner name x alias key (GEN-1/2, PRJ-5).  The alias list is
    an input table ``purchase_name_aliases`` with ``canonical_name`` and either
    an ``aliases`` array or one ``alias_name`` per row."""
    raw = ctx.source("purchase_name_aliases")
    if "aliases" in raw.columns:
        raw = raw.select("canonical_name", F.explode("aliases").alias("alias_name"))
    key = F.lower(F.regexp_replace(F.trim("alias_name"), JAVA_WHITESPACE + "+", " "))
    return raw.select("canonical_name", key.alias("alias_key")).distinct()


def _excluded(ctx: ModelContext) -> DataFrame:
    ex = ctx.ref("int_excluded_stock_codes")
    return ex.filter(b2n("hg_stock_id").isNotNull()).select(upper_trim("hg_stock_id").alias("__ex"))


@model("fact_po_detail", "silver")
def fact_po_detail(ctx: ModelContext) -> DataFrame:
    pol = ctx.source("purchase_order_line")
    return pol.select(sk("id").alias("fact_po_detail_sk"), b2n("id").alias("po_detail_id"),
                      b2n("order_id").alias("po_id"), b2n("product_qty").alias("qty_order"),
                      b2n("x_subgenre_id").alias("repository"))


@model("fact_khsx_detail", "silver")
def fact_khsx_detail(ctx: ModelContext) -> DataFrame:
    d = ctx.source("x_music_plan_detail")
    return d.select(sk("id").alias("fact_khsx_detail_sk"), b2n("id").alias("production_plan_detail_id"),
                    b2n("plan_id").alias("production_plan_id"), b2n("produce_manager").alias("production_manager"),
                    b2n("ar_id").alias("ar_manager"), b2n("state").alias("status"))


@model("fact_so_detail", "silver")
def fact_so_detail(ctx: ModelContext) -> DataFrame:
    sol = ctx.source("sale_order_line")
    return sol.select(sk("id").alias("fact_so_detail_sk"), b2n("id").alias("so_detail_id"),
                      b2n("order_id").alias("so_id"), b2n("x_subgenre_id").alias("repository"),
                      b2n("product_uom_qty").cast(L.NUMERIC).alias("song_qty"),
                      b2n("x_deadline").alias("deadline"),
                      b2n("x_expected_score").cast("decimal(18,2)").alias("expected_score"),
                      b2n("x_produce_qty").cast(L.NUMERIC).alias("production_qty"),
                      b2n("x_qty_in_stock").cast(L.NUMERIC).alias("pending_qty"))


@model("fact_artist_assignment", "silver")
def fact_artist_assignment(ctx: ModelContext) -> DataFrame:
    x = ctx.source("x_music_plan_detail_price")
    rp = ctx.source("res_partner").select(F.col("id").alias("__pid"), F.col("name").alias("__pname"))
    j = x.join(rp, x["partner_id"] == F.col("__pid"), "left")
    return j.select(sk(x["id"]).alias("fact_artist_assignment_sk"),
                    b2n(x["detail_id"]).alias("production_plan_detail_id"),
                    b2n(x["partner_id"]).alias("artist_id"), b2n("__pname").alias("artist_name"))


@model("fact_evaluation_assignment", "silver")
def fact_evaluation_assignment(ctx: ModelContext) -> DataFrame:
    """Reviews with their reviewer (ids compared as text, JN-11)."""
    r = ctx.source("review")
    u = ctx.source("review_user").select(F.col("Id").cast("string").alias("__uid"), F.col("FullName").alias("__fn"))
    j = r.join(u, r["CreatedByUserId"].cast("string") == F.col("__uid"), "left")
    return j.select(sk(r["Id"]).alias("music_evaluation_id"), b2n(r["CreatedByUserId"]).alias("reviewer_id"),
                    r["Rating"].cast(L.NUMERIC).alias("score"), b2n("__fn").alias("reviewer_name"))


@model("bridge_bt_vid", "silver")
def bridge_bt_vid(ctx: ModelContext) -> DataFrame:
    """Video x editing code (not deduplicated, as stored by the warehouse)."""
    cvi = ctx.source("channel_video_info").select("YoutubeVideoId", b2n("Code").alias("editing_code"))
    cvi = cvi.filter(b2n("editing_code").isNotNull())
    return cvi.select(sk("YoutubeVideoId", "editing_code").alias("bridge_bt_vid_sk"), "editing_code",
                      b2n("YoutubeVideoId").alias("video_id"))


@model("fact_phase6_sales", "silver")
def fact_phase6_sales(ctx: ModelContext) -> DataFrame:
    """Typed sales, latest ``_loaded_at`` per sale id (WIN-1; ties: larger batch id)."""
    s = ctx.source("phase6_sales").select(
        b2n("sale_id").alias("sale_id"), b2n("customer_name").alias("customer_name"),
        b2n("amount").cast("decimal(18,2)").alias("amount"), b2n("sale_date").cast("date").alias("sale_date"),
        "_source_id", "_batch_id", "_loaded_at").filter(F.col("sale_id").isNotNull())
    return latest_by(s, ["sale_id"], "_loaded_at", tie_break=[desc("_batch_id")])


@model("fact_label_operation", "silver")
def fact_label_operation(ctx: ModelContext) -> DataFrame:
    """Earliest active song per ISRC with its acceptance certificate link
    (ties between several certificates: smallest link)."""
    b = ctx.source("x_music_song").filter(is_true(F.col("active") == F.lit(True)) & b2n("isrc").isNotNull())
    ac = ctx.source("x_acceptance_cert").select(F.col("purchase_order_id").cast("bigint").alias("__po"),
                                                F.col("acceptance_link").alias("__link"))
    j = b.join(ac, b["purchase_order_id"].cast("bigint") == F.col("__po"), "left")
    rows = j.select(F.col("isrc").alias("__isrc"), F.col("id").alias("__id"),
                    sk("id").alias("fact_label_operation_sk"), b2n("id").alias("resource_id"),
                    b2n("release_state").alias("release_status"),
                    b2n("release_date").cast("timestamp").alias("release_date"),
                    b2n("__link").alias("acceptance_url"), b2n("isrc").alias("isrc"),
                    b2n("distro").alias("distributor"))
    return first_by(rows, ["__isrc"], [asc("__id"), asc("acceptance_url")]).drop("__isrc", "__id")


def net_videos(ctx: ModelContext) -> DataFrame:
    """Videos of channels in the network: ``__v``, and whether a live deal of one
    has not ended (``viewed``) or is received (``earned``).  A live deal is
    neither out of the network nor deleted, its company link has no type, and
    its channel is not suspended."""
    deals = ctx.source("channel_deal").filter((F.col("IsOutNet") == F.lit(False)) & (F.col("IsDeleted") == F.lit(False)))
    links = ctx.source("channel_company").filter(F.col("Type").isNull()).select(F.col("ChannelId").alias("__cc"))
    channels = ctx.source("channel").filter(F.col("SuspendedTimeUtc").isNull()) \
        .select(F.col("Id").alias("__c"), F.col("YoutubeChannelId").alias("__ytc"))
    flags = [F.max(F.col("OutNetTimeUtc").isNull()).alias("viewed"), F.max(F.col("ReceiveTimeUtc").isNotNull()).alias("earned")]
    live = (deals.join(links, deals["ChannelId"] == F.col("__cc"), "left_semi")
            .join(channels, deals["ChannelId"] == F.col("__c")).groupBy("__ytc").agg(*flags))
    return (ctx.source("channel_video_info").select(F.col("YoutubeVideoId").alias("__v"), "YoutubeChannelId")
            .join(live, F.col("YoutubeChannelId") == F.col("__ytc")).groupBy("__v")
            .agg(F.max("viewed").alias("viewed"), F.max("earned").alias("earned")))


def net_metrics(ctx: ModelContext) -> DataFrame:
    """Dated metrics of the network's videos with the flags of :func:`net_videos`."""
    m = ctx.source("channel_video_metric")
    m = m.filter(F.col("YoutubeVideoId").isNotNull() & (F.trim("YoutubeVideoId") != F.lit(""))
                 & F.col("Date").isNotNull())
    return m.join(net_videos(ctx), m["YoutubeVideoId"] == F.col("__v"))


def usd_by_day(ctx: ModelContext) -> DataFrame:
    """One rate per day from dim_usd (smallest rate when a day repeats)."""
    u = ctx.ref("dim_usd").select("record_date", "exchange_rate")
    return u.groupBy("record_date").agg(F.min("exchange_rate").alias("exchange_rate"))


@model("fact_view_yt", "silver")
def fact_view_yt(ctx: ModelContext) -> DataFrame:
    """Daily views of in-network videos (deal not ended) and revenue per view."""
    m = net_metrics(ctx).filter("viewed")
    return m.select(sk("YoutubeVideoId", "Date").alias("fact_view_yt_sk"), F.col("YoutubeVideoId").alias("video_id"),
                    F.col("Views").cast(L.NUMERIC).alias("view_count"),
                    F.col("Date").cast("timestamp").alias("recorded_date"),
                    ratio(F.col("EstimatedRevenue"), F.col("Views")).alias("rpm"))


@model("fact_revenue_yt", "silver")
def fact_revenue_yt(ctx: ModelContext) -> DataFrame:
    """Daily revenue of in-network videos (deal received) with the day's USD rate."""
    m = net_metrics(ctx).filter("earned")
    u = usd_by_day(ctx)
    j = m.join(u, F.col("Date").cast("date") == u["record_date"], "left")
    return j.select(sk("YoutubeVideoId", "Date").alias("fact_revenue_yt_sk"), F.col("YoutubeVideoId").alias("video_id"),
                    F.col("EstimatedRevenue").cast(L.NUMERIC).alias("revenue_amount"),
                    F.col("Date").cast("timestamp").alias("revenue_date"), "exchange_rate")


def _revenue_by_month(ctx: ModelContext) -> DataFrame:
    """Distributor revenue per (retailer, isrc, artist, month) with the first reporting date."""
    s = ctx.source("sale").filter(b2n("isrc").isNotNull())
    d = F.col("reportingPeriod").cast("date")
    base = s.select("retailer", "isrc", b2n("artist").alias("artist"), month_key(d).alias("revenue_month"),
                    d.alias("reporting_date"), F.col("revenue").cast(L.NUMERIC).alias("earning"))
    return base.groupBy("retailer", "isrc", "artist", "revenue_month").agg(
        F.min("reporting_date").alias("first_date"), F.sum("earning").alias("revenue_amount"))


@model("fact_revenue_distro", "silver")
def fact_revenue_distro(ctx: ModelContext) -> DataFrame:
    """Monthly distributor revenue with the USD rate of the first reporting day."""
    a = _revenue_by_month(ctx)
    j = a.join(usd_by_day(ctx), a["first_date"] == F.col("record_date"), "left")
    return j.select(sk("retailer", "isrc", "artist", "revenue_month").alias("fact_revenue_distro_sk"),
                    "revenue_amount", "revenue_month", b2n("retailer").alias("platform"), "isrc", "artist",
                    "exchange_rate")


def stream_count(c) -> F.Column:
    """Stream counts are text with thousands commas."""
    return F.replace(F.col(c).cast("string"), F.lit(","), F.lit("")).cast(L.NUMERIC)


@model("fact_revenue_stream_distro", "silver")
def fact_revenue_stream_distro(ctx: ModelContext) -> DataFrame:
    """Monthly revenue joined with monthly streams; revenue per 1000 streams
    (0 when there are no streams)."""
    r = _revenue_by_month(ctx)
    sd = ctx.source("stream_distro").filter(b2n("isrc").isNotNull() & b2n("reportingDate").isNotNull())
    s = (sd.select(b2n("isrc").alias("__s_isrc"),
                   month_key(b2n("reportingDate").cast("date")).alias("__s_month"),
                   stream_count("dailyStream").alias("__streams"))
         .groupBy("__s_isrc", "__s_month").agg(F.sum("__streams").alias("__stream_count")))
    j = (r.join(s, (r["isrc"] == F.col("__s_isrc")) & (r["revenue_month"] == F.col("__s_month")), "left")
         .join(usd_by_day(ctx), F.col("first_date") == F.col("record_date"), "left"))
    streams = F.coalesce(F.col("__stream_count"), F.lit(0).cast(L.NUMERIC))
    return j.select(sk("retailer", "isrc", "artist", "revenue_month").alias("fact_revenue_stream_distro_sk"),
                    "revenue_amount", streams.alias("stream_count"),
                    ratio(F.col("revenue_amount"), streams, 1000.0, on_zero=0.0).alias("rpm"),
                    "revenue_month", b2n("retailer").alias("platform"), "isrc", "artist", "exchange_rate")


@model("fact_view_stream_distro", "silver")
def fact_view_stream_distro(ctx: ModelContext) -> DataFrame:
    """Daily streams x the retailers that sell the ISRC (a deliberate fan-out:
    one row per platform)."""
    sd = ctx.source("stream_distro").filter(b2n("isrc").isNotNull())
    plat = (ctx.source("sale").filter(b2n("iSRC").isNotNull())
            .select(F.col("iSRC").alias("__p_isrc"), "retailer").distinct())
    j = sd.join(plat, F.trim(sd["isrc"]) == F.trim(F.col("__p_isrc")), "left")
    return j.select(sk(sd["isrc"], "reportingDate", "idArtist", "retailer").alias("fact_view_stream_distro_sk"),
                    stream_count("dailyStream").alias("stream_count"),
                    b2n("reportingDate").cast("date").alias("recorded_date"),
                    b2n("retailer").alias("platform"), b2n(sd["isrc"]).alias("isrc"),
                    b2n("idArtist").alias("artist"))


@model("fact_revenue_view_youtube", "silver")
def fact_revenue_view_youtube(ctx: ModelContext) -> DataFrame:
    """Daily revenue and views of company channels' videos, with the video's
    newest info row; revenue per 1000 views (0 on no views)."""
    cvi = ctx.source("channel_video_info").filter(b2n("YoutubeVideoId").isNotNull())
    newest = latest_by(cvi.select("YoutubeVideoId", "PublishedAt", "Title"), ["YoutubeVideoId"], "PublishedAt",
                       tie_break=[asc("Title")])
    vd = newest.select(b2n("YoutubeVideoId").alias("__dv_id"),
                       F.concat(F.lit(L.VIDEO_URL_PREFIX), F.col("YoutubeVideoId")).alias("video_url"),
                       F.col("PublishedAt").cast("timestamp").alias("published_date"),
                       b2n("Title").alias("video_name"))
    cm = company_channels(ctx, require_not_deleted=True).select(F.col("channel_id").alias("__ch"))
    m = ctx.source("channel_video_metric").filter(b2n("YoutubeVideoId").isNotNull() & F.col("Date").isNotNull())
    m = m.join(cm, b2n(m["YoutubeChannelId"]) == F.col("__ch"), "left_semi")
    m = m.select(b2n("YoutubeVideoId").alias("video_id"), b2n("YoutubeChannelId").alias("channel_id"),
                 F.col("Date").cast("date").alias("revenue_date"),
                 F.col("EstimatedRevenue").cast(L.NUMERIC).alias("__rev"), F.col("Views").cast(L.NUMERIC).alias("__views"))
    j = m.join(vd, F.col("video_id") == F.col("__dv_id"), "left")
    rev = F.coalesce(F.col("__rev"), F.lit(0).cast(L.NUMERIC))
    views = F.coalesce(F.col("__views"), F.lit(0).cast(L.NUMERIC))
    return j.select(sk("channel_id", "video_id", "revenue_date").alias("fact_revenue_view_youtube_sk"),
                    "video_id", "channel_id", "video_url", "published_date", "video_name",
                    rev.alias("revenue_amount"), views.alias("view"),
                    ratio(rev, views, 1000.0, on_zero=0.0).alias("rpm"), "revenue_date")


def editing_placements(ctx: ModelContext) -> DataFrame:
    """Catalogue resources placed in editing projects, each once, without the
    excluded stock codes (anti join)."""
    re_ = ctx.source("resource_editings")
    e = ctx.source("editings").select(F.col("Id").alias("__e_id"), F.col("EditingFileId").alias("editing_code"))
    r = ctx.source("resource").filter(F.col("ResourceType") == F.lit(0)) \
        .select(F.col("Id").alias("__r_id"), upper_trim("ResourceFileId").alias("hg_stock_id")) \
        .filter(F.col("hg_stock_id").startswith(L.STOCK_PREFIX)) \
        .join(_excluded(ctx), F.col("hg_stock_id") == F.col("__ex"), "left_anti")   # few rows: before the placements
    return (re_.join(e, re_["EditingId"] == F.col("__e_id"), "inner")
            .join(r, re_["ResourcesId"] == F.col("__r_id"), "inner")
            .select(F.col("Id").alias("resource_editing_id"), F.col("EditingId").alias("editing_id"),
                    "editing_code", "hg_stock_id", F.col("StartTime").alias("start_time"),
                    F.col("EndTime").alias("end_time")))


@model("fact_editing", "silver")
def fact_editing(ctx: ModelContext) -> DataFrame:
    """Placements numbered by start time within the editing (WIN-6), after
    removing duplicate joined rows.  An editing may have any number of placements."""
    numbered = sequence_within(editing_placements(ctx), ["editing_id"],
                               [asc("start_time"), asc("resource_editing_id")], out="position", spread=True, unique=True)
    return numbered.select(sk("resource_editing_id").alias("fact_editing_sk"), "editing_id", "editing_code",
                           "hg_stock_id", F.col("position").cast("int").alias("position"),
                           (F.col("end_time").cast(L.NUMERIC) - F.col("start_time").cast(L.NUMERIC)).alias("duration"))


@model("fact_youtube_operation", "silver")
def fact_youtube_operation(ctx: ModelContext) -> DataFrame:
    """Audio publishes per stock code enriched by ISRC from the song table;
    per stock: newest submission (falling back to the publish day), then
    newest publish, then largest video id, nulls last; remaining ties by the
    other columns."""
    t = ctx.source("tracking_video_publish_infos").filter(F.col("ResourceFileId").isNotNull())
    rfi = ctx.source("resource_file_info").filter(F.col("MediaType") == F.lit(1)) \
        .select(F.col("Id").alias("__rfi_id"), F.col("ResourceFileId").alias("__rfi_file"), F.col("ISRC").alias("__isrc"))
    audio = (t.join(rfi, (t["ResourceFileId"] == F.col("__rfi_file")) & (t["ResourceFileInfoId"] == F.col("__rfi_id")),
                    "inner")
             .select(F.col("ResourceFileInfoId").alias("resource_info_id"), F.col("ResourceFileId").alias("hg_stock_id"),
                     F.col("VideoPublishId").alias("youtube_video_id"), F.col("ChannelId").alias("channel_id"),
                     F.col("CreatedDate").alias("published_date"), F.col("VideoType").alias("video_type"),
                     b2n("__isrc").alias("isrc")).distinct())
    s = ctx.source("x_music_song").select(F.upper(b2n("isrc")).alias("__s_isrc"), b2n("cid_state").alias("cid"),
                                          b2n("net_cid").alias("net"), b2n("hg_link").alias("stock_url"),
                                          b2n("ytb_sent_date").cast("date").alias("__sent"))
    en = audio.join(s, F.upper(F.col("isrc")) == F.col("__s_isrc"), "left")
    en = en.withColumn("submitted_date", F.coalesce("__sent", F.col("published_date").cast("date")))
    order = [desc("submitted_date", nulls_last=True), desc("published_date", nulls_last=True),
             desc("youtube_video_id", nulls_last=True)] + \
            [asc(c) for c in ("resource_info_id", "isrc", "cid", "net", "stock_url", "channel_id", "video_type")]
    best = first_by(en.drop("__s_isrc", "__sent"), ["hg_stock_id"], order)
    return best.select(sk("hg_stock_id").alias("fact_youtube_operation_sk"), "hg_stock_id", "resource_info_id",
                       "isrc", "cid", "net", "stock_url", "submitted_date", "youtube_video_id", "channel_id",
                       "video_type")


@model("fact_music_evaluation", "silver")
def fact_music_evaluation(ctx: ModelContext) -> DataFrame:
    """Reviews with version number of the reviewed recording (WIN-7),
    internal score (reviews by ``var internal_reviewer_id``), average
    marketing score of other users, conclusion label and comment text."""
    internal = str(ctx.var("internal_reviewer_id"))
    ver = ctx.source("recording_sound_version").select("Id", "RecordingSoundId", "CreatedDate")
    ver = sequence_within(ver, ["RecordingSoundId"], [asc("CreatedDate"), asc("Id")], out="version_no")
    ver = ver.select(F.col("Id").cast("string").alias("__v_id"), F.col("RecordingSoundId").cast("string").alias("__rs"),
                     "version_no")
    ucv = ctx.source("user_comment_version").filter(F.col("UserId").cast("string") != F.lit(internal))
    vnc = ctx.source("version_needs_comment").select(F.col("Id").cast("string").alias("__vnc"),
                                                     F.col("RecordingSoundVersionId").alias("__vid"))
    mkt = (ucv.join(vnc, ucv["VersionNeedsCommentId"].cast("string") == F.col("__vnc"), "inner")
           .groupBy(F.col("__vid").cast("string").alias("__m_vid"))
           .agg(F.avg(F.col("Rating").cast(L.NUMERIC)).alias("marketing_score")))
    rs = ctx.source("recording_sound").select(F.col("Id").cast("string").alias("__rs_id"),
                                              F.col("SongCode").alias("resource_id"),
                                              F.col("CreatedDate").alias("__rs_created"))
    r = ctx.source("review")
    rv = r["RecordingSoundVersionId"].cast("string")
    j = (r.join(ver, rv == F.col("__v_id"), "left")
         .join(rs, F.col("__rs") == F.col("__rs_id"), "left")
         .join(mkt, rv == F.col("__m_vid"), "left"))
    status_vi = None
    for code, label in L.CONCLUSION_LABELS.items():
        cond = F.col("Concluding") == F.lit(code)
        status_vi = F.when(cond, F.lit(label)) if status_vi is None else status_vi.when(cond, F.lit(label))
    return j.select(sk(r["Id"]).alias("music_evaluation_id"), "resource_id",
                    F.col("version_no").cast("int").alias("version"),
                    F.when(r["CreatedByUserId"].cast("string") == F.lit(internal), r["Rating"].cast(L.NUMERIC))
                     .alias("internal_score"),
                    "marketing_score", F.col("Concluding").alias("status"), status_vi.alias("status_vi"),
                    json_or_text(r["Comment"], "Comment").alias("comment"),
                    r["CreatedDate"].cast("timestamp").alias("review_date"),
                    F.col("__rs_created").cast("timestamp").alias("uploaded_date"))


def _names_for_lists(rows: DataFrame, list_col: str, dim: DataFrame, dim_key: str, dim_name: str,
                     out: str) -> DataFrame:
    """JN-18: comma id list -> names joined with ', ' in list order; unknown
    ids skipped; nothing resolved -> null.  The names depend on the list text
    alone, so they are resolved once per distinct list value (far fewer than
    rows); callers join them back on that value."""
    lists = rows.select(F.col(list_col).alias("__list")).filter(F.col("__list").isNotNull()).distinct()
    items = explode_list(lists, "__list")
    d = dim.select(F.col(dim_key).cast("string").alias("item"), F.col(dim_name).alias("__name"))
    named = items.join(d, "item")
    return (named.groupBy("__list")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "__name"))).alias("__l"))
            .select(F.col("__list").alias(f"__{out}_list"),
                    F.array_join(F.transform("__l", lambda s: s["__name"]), ", ").alias(out)))


LISTS = {"department": ("DepartmentData", "department", "Name"), "team": ("GroupData", "groups", "Name"),
         "employee": ("UserData", "users", "DisplayName")}


def distributions(ctx: ModelContext, resolve: Sequence[str]) -> DataFrame:
    """Distributions of catalogue files with the asked-for names resolved from
    comma id lists (per distinct list value: one explode + join + aggregate,
    never a per-row subquery); excluded stock codes removed (anti join on the
    code; rows without a catalogue file are kept with a null code)."""
    d = ctx.source("distribution_media_history")
    rfi = ctx.source("resource_file_info").select(F.col("Id").alias("__rfi_id"),
                                                  upper_trim("ResourceFileId").alias("hg_stock_id"))
    rfi = rfi.filter(F.col("hg_stock_id").startswith(L.STOCK_PREFIX))
    out = d.join(rfi, d["ResourceFileInfoId"] == F.col("__rfi_id"), "left")
    out = out.join(_excluded(ctx), F.col("hg_stock_id") == F.col("__ex"), "left_anti")
    for alias in resolve:
        list_col, dim, name = LISTS[alias]
        names = _names_for_lists(d, list_col, ctx.source(dim), "Id", name, alias)  # lists of the raw source
        out = join_aggregated(out, names, [(list_col, f"__{alias}_list")])
    return out


@model("fact_distribution", "silver")
def fact_distribution(ctx: ModelContext) -> DataFrame:
    """Distributions with department, team and employee names."""
    out = distributions(ctx, list(LISTS))
    return out.select(sk("Id").alias("fact_distribution_sk"), F.col("Id").alias("distribution_id"), "hg_stock_id",
                      F.col("CreatedDate").cast("timestamp").alias("distribution_date"),
                      F.lit(L.SHARED_RECIPIENT).alias("recipient_company"), "department", "team", "employee",
                      F.col("CreatedByUserId").alias("distributed_employee_id"))


def editing_weight(n_res: F.Column, position: F.Column) -> F.Column:
    """Ten-point share of a resource in a video: a single resource takes all
    10 whatever its position; otherwise the positional weights (0 beyond)."""
    return F.when(n_res == F.lit(1), F.lit(10)).otherwise(F.coalesce(position_weight(n_res, position), F.lit(0)))


@model("fact_revenue_by_resources", "silver")
def fact_revenue_by_resources(ctx: ModelContext) -> DataFrame:
    """Daily video revenue/views split over the video's first five
    resources by positional weights (sum 10).  Metrics are aggregated per
    (video, day) before the fan-out to at most five resources."""
    cm = company_channels(ctx).select(F.col("channel_id").alias("__ch"))
    m = ctx.source("channel_video_metric").filter(b2n("YoutubeVideoId").isNotNull() & F.col("Date").isNotNull())
    m = m.join(cm, b2n(m["YoutubeChannelId"]) == F.col("__ch"), "left_semi")
    metric = (m.groupBy(b2n("YoutubeVideoId").alias("video_id"), F.col("Date").cast("date").alias("recorded_date"))
              .agg(F.sum(F.col("EstimatedRevenue").cast(L.NUMERIC)).alias("revenue"),
                   F.sum(F.col("Views").cast(L.NUMERIC)).alias("views")))
    bridge = (ctx.ref("bridge_bt_vid").select(b2n("video_id").alias("video_id"), b2n("editing_code").alias("editing_code"))
              .filter(F.col("video_id").isNotNull() & F.col("editing_code").isNotNull()).distinct())
    er = (ctx.ref("fact_editing").filter(F.col("editing_code").isNotNull() & F.col("hg_stock_id").isNotNull()
                                         & F.col("position").between(1, 5))
          .select("editing_code", "hg_stock_id", "position").distinct())
    # The bridge is distinct on (video, code), so a (video, code) pair holds
    # exactly the code's resources: n_res is a per-code count, taken on the
    # small distinct resource list (partial aggregate, plain equi join).
    n_res = er.groupBy("editing_code").agg(F.count(F.lit(1)).alias("n_res"))
    vr = bridge.join(er.join(n_res, "editing_code"), "editing_code")
    w = vr.withColumn("w", editing_weight(F.col("n_res"), F.col("position"))).filter(F.col("w") > 0)
    vd = first_by(ctx.ref("dim_video").select(b2n("video_id").alias("__dv_id"), "video_name", "video_url",
                                              "published_date").filter(F.col("__dv_id").isNotNull()),
                  ["__dv_id"], [desc("published_date", nulls_last=True), asc("video_name"), asc("video_url")])
    j = w.join(metric, "video_id").join(vd, F.col("video_id") == F.col("__dv_id"), "left")
    share = F.col("w").cast("decimal(4,1)") / F.lit(10).cast("decimal(4,1)")
    return j.select(sk("video_id", "editing_code", "hg_stock_id", F.col("position").cast("string"),
                       F.col("recorded_date").cast("string")).alias("revenue_id"),
                    "video_id", "video_name", "video_url", "editing_code", F.col("hg_stock_id").alias("resource_id"),
                    "position", (F.col("revenue") * share).cast(L.NUMERIC).alias("revenue_amount"),
                    F.col("recorded_date").cast("timestamp").alias("recorded_date"),
                    (F.col("views") * share).cast(L.NUMERIC).alias("view"))


@model("fact_purchase_cost", "silver")
def fact_purchase_cost(ctx: ModelContext) -> DataFrame:
    """Yearly partner cost sheets (12 month columns, unpivoted in one scan)
    spread evenly over the partner's purchased resources active in each month.

    The calendar is every month of every year present in the sheets; a
    resource is active from its purchase month on (always when the date is
    missing).  Months are generated per resource with ``explode(sequence)``
    between the first and last calendar month (two scalars from a one-row
    aggregate) and kept when their year is a sheet year - no cross join.  Date
    text that is no date is an error.  Costs are local currency / 25000; months
    without cost get 0 (the year total repeats on every month with cost,
    hazard H9)."""
    name_col = F.col(f"`{L.PARTNER_NAME_COL}`")
    nm = ctx.ref("int_purchase_name_map")
    c = ctx.source("purchase_cost").filter(matches_key(F.trim("_year"), "^[0-9]{4}$") & b2n(name_col).isNotNull())
    alias_key = F.lower(F.regexp_replace(F.trim(name_col), JAVA_WHITESPACE + "+", " "))
    c = c.join(nm, alias_key == nm["alias_key"], "left")
    pname = F.coalesce(F.col("canonical_name"), F.trim(name_col))
    month_cols = [f"{L.MONTH_COST_PREFIX}{m}" for m in range(1, 13)]
    cost = c.select(pname.alias("partner_name"), F.lower(pname).alias("partner_key"),
                    F.trim("_year").cast("int").alias("year_no"),
                    F.col(f"`{L.YEAR_TOTAL_COL}`").cast("string").alias("total_year_raw"),
                    *[F.col(f"`{mc}`").cast("string").alias(f"m{i + 1}") for i, mc in enumerate(month_cols)])

    long = unpivot(cost, ["partner_key", "year_no", "total_year_raw"], [f"m{i}" for i in range(1, 13)],
                   "__m", "month_cost_raw")
    parsed = (long.withColumn("month_no", F.substring("__m", 2, 2).cast("int"))
              .groupBy("partner_key", "year_no", "month_no")
              .agg(F.sum(digits_only_number("total_year_raw", dtype="decimal(38,0)", default=0)).alias("total_year_num"),
                   F.sum(digits_only_number("month_cost_raw", dtype="decimal(38,0)", default=0)).alias("month_cost_num")))

    d = ctx.ref("dim_purchased_resource")
    res = d.filter(matches_key(F.trim("hg_stock_id"), L.STOCK_CODE_PATTERN) & b2n("partner_key").isNotNull()) \
        .select("dim_purchased_resource_sk", "hg_stock_id", "partner_id", "partner_name", "partner_key",
                strict_dmy("buy_date").alias("buy_date"))
    years = cost.select("year_no").distinct()
    lo, hi = years.agg(F.min("year_no"), F.max("year_no")).first()
    if lo is None:
        return ctx.spark.createDataFrame([], "cost_id string, purchased_resource_sk string, resource_id string, "
                                             "partner_id string, partner_name string, total_cost decimal(38,6), "
                                             "additional_cost decimal(38,6), incurred_datetime date")
    first_m = F.make_date(F.lit(lo), F.lit(1), F.lit(1))
    last_m = F.make_date(F.lit(hi), F.lit(12), F.lit(1))
    start = F.when(F.col("buy_date").isNull(), first_m).otherwise(F.greatest(first_m, month_start("buy_date")))
    # bought after the last sheet year: in no month of the calendar
    rm = (res.filter(start <= last_m).withColumn("month_start", F.explode(F.sequence(start, last_m, F.expr("interval 1 month"))))
          .withColumn("year_no", F.year("month_start")).withColumn("month_no", F.month("month_start"))
          .join(years, "year_no", "left_semi")
          .withColumn("month_end", month_end("month_start")))
    counts = rm.groupBy("partner_key", "year_no", "month_no").agg(
        F.count_distinct("dim_purchased_resource_sk").alias("n_res"))
    month = [(k, k) for k in ("partner_key", "year_no", "month_no")]
    j = join_aggregated(join_aggregated(rm, counts, month, "inner"), parsed, month)
    rate = F.lit(L.LOCAL_CURRENCY_RATE).cast("decimal(7,1)")
    has_cost = F.coalesce(F.col("month_cost_num"), F.lit(0)) > 0
    zero = F.lit(0).cast(L.NUMERIC)
    total = F.when(has_cost, (F.col("total_year_num") / F.col("n_res")) / rate).otherwise(zero)
    extra = F.when(has_cost, (F.col("month_cost_num") / F.col("n_res")) / rate).otherwise(zero)
    return j.select(sk("dim_purchased_resource_sk", "year_no", "month_no").alias("cost_id"),
                    F.col("dim_purchased_resource_sk").alias("purchased_resource_sk"),
                    F.col("hg_stock_id").alias("resource_id"), "partner_id", "partner_name",
                    total.cast(L.NUMERIC).alias("total_cost"), extra.cast(L.NUMERIC).alias("additional_cost"),
                    F.col("month_end").alias("incurred_datetime"))
