"""Resources of all sources, one survivor per attribute.

Four sources know the same stock codes: the order system, the purchased
catalogue and the sheet before the order system hold resources, the performance
and added sheets correct them or hold more.  Each source is cleaned to the same
columns with its repository resolved; they meet by stock code once, and every
attribute then takes the first of the sources that it trusts, in an order of its
own (``TRUST``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.cleanse import blank_to_null as b2n
from lakeward.functions.cleanse import currency_heuristic, decimal_comma, digits_only_number, lenient_cast, typed_null
from lakeward.functions.keys import match_key, nfc, normalize_text
from lakeward.functions.keys import surrogate_key as sk
from lakeward.models import labels as L
from lakeward.models.base import ModelContext, model
from lakeward.operators.dedup import first_by, unique_name_lookup
from lakeward.operators.joins import exclude_keys
from lakeward.operators.ordering import asc, desc, numeric_first

MONEY = "decimal(18,2)"
COLUMNS = {"resource_source": "string", "source_resource_id": "string", "odoo_id": "string", "song_code": "string",
           "resource_name": "string", "repository_id": "string", "repository_type": "string", "acceptance_score": MONEY,
           "acceptance_cost": MONEY, "acceptance_date": "timestamp", "production_plan_detail_id": "string", "status": "string",
           "so_id": "string", "po_detail_id": "string", "hg_stock_id": "string"}
#: Which source an attribute is taken from, first non-null: b the resource
#: itself, p the performance sheet, a the added sheet.
TRUST = {c: "bpa" for c in COLUMNS} | {"resource_name": "abp", "repository_id": "pab"}


def _col(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def _rows(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    given = {"resource_source": F.lit(source), **columns}
    return df.select(*[given.get(c, typed_null(t)).cast(t).alias(c) for c, t in COLUMNS.items()])


def _plain(c: Column) -> Column:
    return F.lower(nfc(F.trim(c)))


def _or_default(c: Column, default: str, none: Sequence[str] = ()) -> Column:
    """A sheet's name, or the default for blanks, '#N/A' and words for none."""
    absent = b2n(c).isNull() | (F.upper(F.trim(c)) == F.lit("#N/A")) | F.coalesce(_plain(c).isin(list(none)), F.lit(False))
    return F.when(absent, F.lit(default)).otherwise(normalize_text(c))


def _keyed(dim: DataFrame, id_col: str, name_col: str, *parents: str) -> DataFrame:
    return dim.where(F.col(id_col).isNotNull() & b2n(name_col).isNotNull()).select(id_col, *parents, match_key(name_col).alias("__key"))


def places(ctx: ModelContext) -> DataFrame:
    """Every repository by the names that lead to it: ``pkey``, ``skey``, ``rkey``
    (project, sub-project, repository) and ``place``; a null ``place`` for a
    sub-project without repositories.  Of equal names the numeric ids come first."""
    p = _keyed(ctx.ref("dim_project"), "project_id", "project_name")
    first = first_by(p, ["__key"], numeric_first("project_id")).select(F.col("__key").alias("pkey"), F.col("project_id").alias("__canon"))
    s = _keyed(ctx.ref("dim_sub_project"), "sub_project_id", "sub_project_name", "project_id").withColumnRenamed("__key", "skey")
    s = s.join(p.withColumnRenamed("__key", "pkey"), "project_id").join(first, "pkey")
    s = first_by(s.withColumn("__far", (F.col("project_id") != F.col("__canon")).cast("int")), ["pkey", "skey"],
                 [asc("__far"), *numeric_first("sub_project_id")]).select("pkey", "skey", "sub_project_id")
    r = _keyed(ctx.ref("dim_repository"), "repository_id", "repository_name", "sub_project_id")
    r = first_by(r, ["sub_project_id", "__key"], numeric_first("repository_id"))
    return s.join(r, "sub_project_id", "left").select("pkey", "skey", F.col("__key").alias("rkey"), F.col("repository_id").alias("place"))


def _ordered(ctx: ModelContext) -> DataFrame:
    """The order system's songs, with the order line that names a song if it names none."""
    lines = ctx.source("purchase_order_line").where("x_song_id is not null")
    lines = first_by(lines.select("x_song_id", "id", "write_date"), ["x_song_id"], [desc("write_date", nulls_last=True), desc("id")])
    songs = ctx.source("x_music_song").where("active = true").join(
        lines.select(F.col("x_song_id").alias("__song"), b2n("id").alias("__line")), F.col("id") == F.col("__song"), "left")
    refused = F.col("produce_state") == L.REJECTED_PRODUCE_STATE
    status = (F.when((F.col("state") == "approved") & refused, L.STATUS_NOT_ACCEPTED).when(F.col("state") == "approved", L.STATUS_ACCEPTED)
              .when(F.col("state") == "draft", L.STATUS_IN_PRODUCTION).when(F.col("state") == "rejected", L.STATUS_NOT_ACCEPTED))
    return _rows(songs, L.SOURCE_ODOO, source_resource_id=b2n("id"), odoo_id=b2n("id"), song_code=b2n("name"), resource_name=b2n("song_name"),
                 repository_id=b2n("subgenre_id"), repository_type=F.lit(L.PRODUCTION_REPOSITORY),
                 acceptance_score=b2n("review_score").cast(MONEY), acceptance_cost=currency_heuristic(b2n("review_price"), 1000, dtype=MONEY),
                 acceptance_date=b2n("review_date").cast("timestamp"), production_plan_detail_id=b2n("detail_line_id"), status=status,
                 so_id=b2n("sale_order_id"), po_detail_id=F.coalesce(b2n("purchase_order_line_id"), F.col("__line")), hg_stock_id=b2n("hg_code"))


def _alias_rows(ctx: ModelContext) -> DataFrame:
    """Partner and repository names that stand for each other, the file names also without their ending."""
    rows = ctx.source("repository_partner_map").select("partner_name", b2n("kho_name").alias("kho_name")).where("kho_name is not null")
    bare = rows.withColumn("kho_name", b2n(F.regexp_replace("kho_name", r"(?i)\.(xlsx|xlsm)$", "")))
    return rows.unionByName(bare).select(match_key("partner_name").alias("partner"), match_key("kho_name").alias("kho")).dropna().distinct()


def partner_repositories(ctx: ModelContext, names: DataFrame) -> DataFrame:
    """``key``, ``repository_id``, ``repository_type`` and ``target`` (the name found
    by) of the catalogue's repository names, ``key`` of ``names``.

    A partner's own repository under its project's default sub-project, else
    the one that an alias names there, else the only one of that name anywhere.
    The partner sheet's pricing follows by name, alias or partner.  The lists of
    partners are the tables ``repository_partner_map`` (partner_name, kho_name),
    ``partner_projects`` (partner_name, project_name) and
    ``partners_without_repository`` (partner_name)."""
    alias = _alias_rows(ctx)
    named = ctx.ref("dim_repository").where(F.col("repository_id").isNotNull() & b2n("repository_name").isNotNull())
    anywhere = unique_name_lookup(named.select(match_key("repository_name").alias("__n"), b2n("repository_id").alias("__i")), "__n", "__i", "__ukey", "__uid")
    projects = first_by(_keyed(ctx.ref("dim_project"), "project_id", "project_name"), ["__key"], [asc("project_id")])
    subs = ctx.ref("dim_sub_project").select("project_id", "sub_project_id", match_key("sub_project_name").alias("__key"))
    subs = first_by(subs.where(F.col("__key") == L.DEFAULT_SUB_PROJECT_KEY).dropna().drop("__key"), ["project_id"], [asc("sub_project_id")])
    homes = ctx.source("partner_projects").select(match_key("partner_name").alias("key"), match_key("project_name").alias("__key")).distinct()
    homes = homes.join(projects, "__key").join(subs, "project_id").select("key", F.col("sub_project_id").alias("__home"))
    under = first_by(_keyed(named, "repository_id", "repository_name", "sub_project_id"), ["sub_project_id", "__key"], [asc("repository_id")])
    under = under.select(F.col("sub_project_id").alias("__home"), F.col("__key").alias("__name"), "repository_id")
    without = ctx.source("partners_without_repository").select(match_key("partner_name").alias("key"), F.lit(True).alias("__none")).distinct()

    rows = (names.select("key").distinct().join(alias.select(F.col("kho").alias("key"), F.col("partner").alias("__alias")), "key", "left")
            .join(homes, "key", "left").join(without, "key", "left"))
    rows = rows.withColumn("__own", F.when(F.col("__none"), F.lit(L.DEFAULT_REPOSITORY.lower())).otherwise(F.col("key")))
    rows = rows.withColumn("target", F.coalesce("__alias", "key"))
    rows = (rows.join(under.toDF("__home", "__own", "__direct"), ["__home", "__own"], "left")
            .join(under.toDF("__home", "__alias", "__by_alias"), ["__home", "__alias"], "left")
            .join(anywhere, F.col("target") == F.col("__ukey"), "left"))
    found = rows.select("key", F.coalesce("__direct", "__by_alias", "__uid").alias("repository_id"), "target")
    found = first_by(found, ["key"], [asc(F.col("repository_id").isNull().cast("int")), asc("repository_id"), asc("target")])

    price = _col(L.PRICING_COL)
    sheet = ctx.source("partners").select(match_key(_col(L.PARTNER_REPO_COL)).alias("__sheet"), price.alias("__price")).where("__sheet is not null")
    # of several rows a filled one; a blank one only where there is no other
    sheet = sheet.groupBy("__sheet").agg(F.coalesce(F.min(b2n("__price")), F.min("__price")).alias("__price"))
    known = found.select("key")
    ways = (known.select("key", F.col("key").alias("__sheet"), F.lit(1).alias("way"))
            .unionByName(known.join(alias, F.col("key") == F.col("kho")).select("key", F.col("partner").alias("__sheet"), F.lit(2).alias("way")))
            .unionByName(known.join(alias, F.col("key") == F.col("partner")).select("key", F.col("kho").alias("__sheet"), F.lit(3).alias("way"))))
    priced = first_by(ways.join(sheet, "__sheet").where("__price is not null").select("key", "way", "__price"), ["key"], [asc("way"), asc(b2n("__price"), nulls_last=True)])
    return found.join(priced, "key", "left").select("key", "repository_id", b2n("__price").alias("repository_type"), "target")


def _purchased(ctx: ModelContext) -> DataFrame:
    """Catalogue codes, each with the best repository that its rows name; ties by
    the name found by, then title."""
    code = F.trim(_col(L.PURCHASED_CODE_COL))
    rows = ctx.source("purchased_resource").where(F.regexp_like(code, F.lit(L.STOCK_CODE_LOOSE))).select(
        code.alias("code"), b2n(_col(L.TITLE_COL)).alias("title"), match_key(_col(L.PURCHASED_REPO_COL)).alias("key"))
    rows = rows.join(partner_repositories(ctx, rows.where("key is not null")), "key", "left")
    best = first_by(rows, ["code"], [asc(F.col("repository_id").isNull().cast("int")), asc("repository_id"),
                                     asc("target"), asc("title", nulls_last=True), asc("repository_type", nulls_last=True)])
    return _rows(best, L.SOURCE_PURCHASED, source_resource_id=F.col("code"), resource_name=F.col("title"), repository_id=F.col("repository_id"),
                 repository_type=F.col("repository_type"), status=F.lit(L.STATUS_ACCEPTED), hg_stock_id=F.col("code"))


def _before(ctx: ModelContext, place: DataFrame) -> DataFrame:
    """Accepted resources of the sheet before the order system, in the default
    repository of their sub-project; ties of an ISRC by stock code and song."""
    isrc, stock, status = F.trim(_col(L.RBO_ISRC_COL)), b2n(_col(L.RBO_STOCK_COL)), F.trim(_col(L.RBO_STATUS_COL))
    rows = ctx.source("resource_before_odoo").withColumn("__accepted", lenient_cast(_col(L.RBO_ACCEPTED_COL), "timestamp")).where(
        b2n(isrc).isNotNull() & ~isrc.isin(list(L.SHEET_ERRORS)) & stock.isNotNull() & (stock != L.STOCK_NOT_FOUND)
        & (F.col("__accepted") <= F.lit(L.LAST_ACCEPTED_BEFORE_ODOO).cast("timestamp")) & status.contains(L.STATUS_ACCEPTED))
    rows = rows.select(isrc.alias("isrc"), stock.alias("stock"), b2n(status).alias("status"), b2n(_col(L.SONG_CODE_COL)).alias("song"),
                       b2n(_col(L.RBO_TITLE_COL)).alias("title"), b2n(_col(L.AVG_SCORE_COL)).try_cast(MONEY).alias("score"),
                       b2n(decimal_comma(F.trim(_col(L.UNIT_COST_COL)))).try_cast(MONEY).alias("cost"), "__accepted",
                       match_key(_col(L.GENRE_COL)).alias("pkey"), match_key(_col(L.SUBGENRE_COL)).alias("skey"))
    rows = first_by(rows, ["isrc"], [asc(c, nulls_last=True) for c in ("stock", "song", "title", "__accepted", "score", "cost", "status", "pkey", "skey")])
    default = place.where(F.col("rkey") == F.lit(L.DEFAULT_REPOSITORY.lower())).select("pkey", "skey", "place")
    rows = rows.join(default, ["pkey", "skey"], "left")
    return _rows(rows, L.SOURCE_BEFORE_ODOO, source_resource_id=F.col("isrc"), song_code=F.col("song"), resource_name=F.col("title"),
                 repository_id=F.col("place"), repository_type=F.lit(L.PRODUCTION_REPOSITORY), acceptance_score=F.col("score"),
                 acceptance_cost=currency_heuristic("cost", 1000, dtype=MONEY), acceptance_date=F.col("__accepted"), status=F.col("status"),
                 hg_stock_id=F.col("stock"))


def _performance(ctx: ModelContext, place: DataFrame) -> DataFrame:
    """The performance sheet's codes whose project and sub-project exist: in the
    repository named, else the default one; best evidence first."""
    code, project, repo = F.trim(_col(L.PERF_STOCK_COL)), _col(L.PERF_PROJECT_COL), _col(L.PERF_REPO_COL)
    rows = ctx.source("resource_performance").where(
        F.regexp_like(code, F.lit(L.STOCK_CODE_LOOSE)) & b2n(project).isNotNull() & (F.upper(F.trim(project)) != "#N/A")
        & (_plain(project) != L.UNKNOWN_PROJECT))
    song, score = F.trim(_col(L.PERF_SONG_COL)), F.trim(_col(L.PERF_SCORE_COL))
    cost = F.regexp_replace(F.trim(_col(L.PERF_COST_COL)), "[^0-9.]", "")
    folded = F.when(_plain(repo).isin(list(L.AUDIOJUNGLE_SPELLINGS)), F.lit(L.AUDIOJUNGLE)).otherwise(_or_default(repo, L.DEFAULT_REPOSITORY))
    rows = rows.select(
        code.alias("code"), F.coalesce(*[b2n(_col(c)) for c in L.PERF_ISRC_COLS]).alias("isrc"),
        F.when(F.regexp_like(song, F.lit(L.SONG_CODE_PATTERN)), song).alias("song"), b2n(_col(L.PERF_NAME_COL)).alias("title"),
        match_key(project).alias("pkey"), F.lower(_or_default(_col(L.PERF_SUB_PROJECT_COL), L.DEFAULT_SUB_PROJECT, L.NO_SUB_PROJECT[:1])).alias("skey"),
        F.lower(folded).alias("rkey"), F.coalesce(F.when(F.regexp_like(score, F.lit(L.NUMBER_PATTERN)), score.try_cast(MONEY)), F.lit(0).cast(MONEY)).alias("score"),
        F.when(F.regexp_like(cost, F.lit(L.NUMBER_PATTERN)), digits_only_number(cost, keep_dot=True, dtype=MONEY)).alias("cost"),
        lenient_cast(_col(L.RBO_ACCEPTED_COL), "timestamp").alias("accepted"))
    default = F.max(F.when(F.col("rkey") == F.lit(L.DEFAULT_REPOSITORY.lower()), F.col("place")))
    home = place.groupBy("pkey", "skey").agg(default.alias("__default"))
    rows = rows.join(home, ["pkey", "skey"]).join(place.where("place is not null"), ["pkey", "skey", "rkey"], "left")
    best = first_by(rows, ["code"], [asc(F.col(c).isNull().cast("int")) for c in ("place", "song", "accepted")]
                    + [desc("accepted", nulls_last=True)] + [asc(c, nulls_last=True) for c in ("isrc", "song", "title", "place", "__default", "score", "cost")])
    return _rows(best, L.SOURCE_PERFORMANCE, source_resource_id=F.coalesce("isrc", "code"), song_code=F.col("song"), resource_name=F.col("title"),
                 repository_id=F.coalesce("place", "__default"), acceptance_score=F.col("score"),
                 acceptance_cost=currency_heuristic("cost", 1_000_000, dtype=MONEY), acceptance_date=F.col("accepted"),
                 status=F.lit(L.STATUS_ACCEPTED), hg_stock_id=F.col("code"))


def _added(ctx: ModelContext, place: DataFrame) -> DataFrame:
    """The added sheet's files that name a project: in the repository named under
    their sub-project, else the only one of that name anywhere."""
    file, project = b2n(_col(L.RESOURCE_FILE_COL)), normalize_text(_col(L.PROJECT_COL))
    rows = ctx.source("resource_infomation_add").withColumns({"__file": file, "__project": F.lower(project)})
    rows = rows.where(F.col("__file").isNotNull() & F.col("__project").isNotNull() & ~F.col("__project").isin(list(L.DROPPED_PROJECTS)))
    rows = rows.select(F.col("__file").alias("file"), b2n(_col(L.TITLE_COL)).alias("title"), F.col("__project").alias("pkey"),
                       F.lower(_or_default(_col(L.SUB_PROJECT_COL), L.DEFAULT_SUB_PROJECT, L.NO_SUB_PROJECT)).alias("skey"),
                       F.lower(_or_default(_col(L.REPO_COL), L.DEFAULT_REPOSITORY, L.NO_SUB_PROJECT)).alias("rkey"))
    named = ctx.ref("dim_repository").select(match_key("repository_name").alias("__n"), b2n("repository_id").alias("__i")).dropna()
    rows = (rows.join(place.where("place is not null"), ["pkey", "skey", "rkey"], "left")
            .join(unique_name_lookup(named, "__n", "__i", "rkey", "only"), "rkey", "left"))
    best = first_by(rows, ["file"], [asc(F.col(c).isNull().cast("int")) for c in ("place", "only", "title")]
                    + [asc(c, nulls_last=True) for c in ("title", "place", "only")])
    return _rows(best, L.SOURCE_ADDED, source_resource_id=F.col("file"), resource_name=F.col("title"), repository_id=F.coalesce("place", "only"),
                 status=F.lit(L.STATUS_ACCEPTED), hg_stock_id=F.col("file"))


def survivors(base: DataFrame, performance: DataFrame, added: DataFrame) -> DataFrame:
    """The three sides by stock code, attributes by ``TRUST``.

    Rows of any side that the others do not know stay.  Base rows without a code
    meet nobody and take no part in the shuffles, so that they are never one
    group.  The performance sheet's codes must be equal, the added sheet's equal
    in upper case; whoever is on either sheet is accepted."""
    key = F.upper(F.trim("hg_stock_id"))
    sides = {}
    for tag, df in (("b", base.where("hg_stock_id is not null")), ("p", performance), ("a", added)):
        sides[tag] = df.select(*[F.col(c).alias(f"{tag}_{c}") for c in COLUMNS], key.alias(f"{tag}_key"))
    met = sides["b"].join(sides["p"], (F.col("b_key") == F.col("p_key")) & (F.col("b_hg_stock_id") == F.col("p_hg_stock_id")), "full")
    met = met.withColumn("key", F.coalesce("b_key", "p_key")).join(sides["a"], F.col("key") == F.col("a_key"), "full")
    values = {c: F.coalesce(*[F.col(f"{tag}_{c}") for tag in order]) for c, order in TRUST.items()}
    # from a sheet an attribute that a resource lacks is filled in only where the sheet may know it
    seen = F.col("p_hg_stock_id").isNotNull() | F.col("a_hg_stock_id").isNotNull()
    values["status"] = F.when(seen, F.lit(L.STATUS_ACCEPTED)).otherwise(F.col("b_status"))
    return met.select(*[values[c].alias(c) for c in COLUMNS]).unionByName(base.where("hg_stock_id is null"))


@model("dim_resources", "silver")
def dim_resources(ctx: ModelContext) -> DataFrame:
    """All resources with the attributes that survive, without the excluded
    stock codes; repository ids that the dimension does not know become null."""
    place = places(ctx)
    base = _ordered(ctx).unionByName(_purchased(ctx)).unionByName(_before(ctx, place))
    rows = survivors(base, _performance(ctx, place), _added(ctx, place)).withColumn("__code", F.upper(F.trim("hg_stock_id")))
    excluded = ctx.ref("int_excluded_stock_codes").select(F.upper(F.trim("hg_stock_id")).alias("__ex"))
    rows = exclude_keys(rows, excluded, "__code", "__ex").drop("__code")
    known = ctx.ref("dim_repository").select(F.col("repository_id").alias("__known")).dropna()
    rows = rows.join(known, F.col("repository_id") == F.col("__known"), "left").withColumn("repository_id", F.col("__known"))
    return rows.select(sk("resource_source", "source_resource_id").alias("dim_resources_sk"),
                       *[c for c in COLUMNS if c != "source_resource_id"])
