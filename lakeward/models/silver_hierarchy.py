"""Sub-projects of projects and repositories of sub-projects.

Both come about in the same way: children named by several sources are resolved
under their parent.  Base sources carry ids; supplements only names, which find
the child of that name or make a new one with a hashed id; a parent without the
default child gets one.  Names are compared under their parent only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.cleanse import blank_to_null as b2n
from lakeward.functions.keys import match_key, nfc, normalize_text
from lakeward.functions.keys import surrogate_key as sk
from lakeward.models import labels as L
from lakeward.models.base import ModelContext, model
from lakeward.operators.dedup import first_by
from lakeward.operators.ordering import asc, numeric_first

CHILD = ("id", "parent", "name", "note")


def _col(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def _plain(c: Column | str) -> Column:
    """Lower-case NFC of the trimmed text, inner spaces as they are."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(nfc(F.trim(c)))


def resolve_children(base: DataFrame, named: DataFrame, parents: DataFrame, default: str) -> DataFrame:
    """``id, parent, name, note``, one row per id.

    ``base`` holds these and ``priority``; ``named`` holds the supplements:
    ``parent``, ``name``, the ``key`` that the name goes by and the sheet's
    ``turn`` (1 before 2); ``parents`` all ``parent`` ids.  All are put together
    with the default children, and the first of each parent and key stays: base
    rows (numeric ids, by number), then supplements, then the default.  A name
    that goes by another key gives way to a child of its own name."""
    null = F.lit(None).cast("string")
    clean = base.select("id", "parent", normalize_text("name").alias("name"), "note", F.lit(0).alias("turn"), "priority").dropna(
        subset=["id", "parent", "name"]).withColumn("key", F.lower("name"))
    late = named.select("parent", "name", "key", "turn").dropna().select(
        sk("parent", "key").alias("id"), "parent", "name", null.alias("note"), "turn", F.lit(0).alias("priority"), "key")
    filled = parents.select("parent").distinct().select(
        sk("parent", F.lit(default)).alias("id"), "parent", F.lit(default).alias("name"), null.alias("note"), F.lit(9).alias("turn"),
        F.lit(0).alias("priority"), F.lit(default.lower()).alias("key"))
    flag, number, text = numeric_first("id")
    rows = first_by(clean.unionByName(late).unionByName(filled), ["parent", "key"],
                    [asc("turn"), flag, number, asc("priority"), text, asc("name"), asc("note")])
    rows = first_by(rows.withColumn("__own", F.lower(nfc("name"))), ["parent", "__own"], [flag, number, text, asc("name"), asc("note")])
    return first_by(rows.select(*CHILD), ["id"], [asc("parent"), asc("name"), asc("note")])


def _overridden(c: Column) -> Column:
    """The fixed project id overrides applied to an id."""
    out = c
    for old, new in L.PROJECT_ID_OVERRIDES.items():
        out = F.when(c == F.lit(old), F.lit(new)).otherwise(out)
    return out


def _projects(ctx: ModelContext) -> DataFrame:
    """``__project`` (id after overrides), its own id, and the keys of its name."""
    return ctx.ref("dim_project").select(
        F.col("project_id").alias("__own"), _overridden(F.col("project_id")).alias("__project"),
        match_key("project_name").alias("__name"), _plain("project_name").alias("__plain"))


def _project_ids(ctx: ModelContext) -> DataFrame:
    """Every id a project is known by (``__source``) and the id it stands for."""
    p = _projects(ctx)
    odoo = ctx.source("x_project").select(b2n("id").alias("__source"), match_key(F.col("name").cast("string")).alias("__x"))
    by_name = odoo.join(p, F.col("__x") == F.col("__name")).select(
        "__source", F.when(_overridden(F.col("__source")) != F.col("__source"), _overridden(F.col("__source")))
        .otherwise(F.col("__own")).alias("__canon"))
    every = by_name.unionByName(p.select(F.col("__own").alias("__source"), F.col("__project").alias("__canon")))
    return first_by(every.dropna(), ["__source"], numeric_first("__canon"))


def _sub_project_name(c: Column, no_value: Sequence[str] = ()) -> Column:
    """A sheet's sub-project, or the default for blanks, '#N/A' and words for none."""
    none = b2n(c).isNull() | (F.upper(F.trim(c)) == F.lit("#N/A")) | _plain(c).isin(list(no_value))
    return F.when(none, F.lit(L.DEFAULT_SUB_PROJECT)).otherwise(normalize_text(c))


def _performance(ctx: ModelContext) -> DataFrame:
    """Rows of the performance sheet that name a project: project key, sub-project, repository."""
    project, sub, repo = (_col(c) for c in (L.PERF_PROJECT_COL, L.PERF_SUB_PROJECT_COL, L.PERF_REPO_COL))
    rows = ctx.source("resource_performance")
    rows = rows.where(b2n(project).isNotNull() & (F.upper(F.trim(project)) != F.lit("#N/A"))
                      & (_plain(project) != F.lit(L.UNKNOWN_PROJECT)))
    no_repo = b2n(repo).isNull() | (F.upper(F.trim(repo)) == F.lit("#N/A")) if L.PERF_REPO_COL in rows.columns else F.lit(True)
    named = normalize_text(repo) if L.PERF_REPO_COL in rows.columns else F.lit(None).cast("string")
    folded = F.when(_plain(repo).isin(list(L.AUDIOJUNGLE_SPELLINGS)), F.lit(L.AUDIOJUNGLE)).otherwise(named) \
        if L.PERF_REPO_COL in rows.columns else named
    return rows.select(F.lower(normalize_text(project)).alias("__pkey"), _sub_project_name(sub, L.NO_SUB_PROJECT[:1]).alias("sub"),
                       F.when(no_repo, F.lit(L.DEFAULT_REPOSITORY)).otherwise(folded).alias("repo")).distinct()


def _distro(ctx: ModelContext) -> DataFrame:
    """Distributor rows: project key, sub-project with the key it goes by, repository."""
    rows = ctx.source("distro_infomation")
    repo = normalize_text(_col(L.REPO_COL)) if L.REPO_COL in rows.columns else F.lit(None).cast("string")
    rows = rows.select(match_key(_col(L.PROJECT_COL)).alias("__pkey"), normalize_text(_col(L.SUB_PROJECT_COL)).alias("sub"),
                       repo.alias("repo")).dropna(subset=["__pkey", "sub"])
    key = F.lower("sub")
    for project, spelling, name in L.SUB_PROJECT_ALIASES:
        key = F.when((F.col("__pkey") == F.lit(project)) & (F.lower("sub") == F.lit(spelling)), F.lit(name)).otherwise(key)
    return rows.where((F.col("__pkey") != F.lit(L.PROJECT_HEADER)) & (F.lower("sub") != F.lit(L.SUB_PROJECT_HEADER))) \
        .withColumn("__skey", key)


@model("dim_sub_project", "silver")
def dim_sub_project(ctx: ModelContext) -> DataFrame:
    """Sub-projects of music projects: the order system's genres (numeric ids),
    two sheets, then distributor and added-resource sheets as supplements, and a
    default sub-project for every project without one."""
    p, ids = _projects(ctx), _project_ids(ctx)
    note = F.lit(None).cast("string").alias("note")

    # the order system: by project id (overridden, or as known), else a project of the genre's own name
    x = ctx.source("x_project").select(F.col("id").alias("__xid"), b2n("id").alias("__same"), _plain(F.col("name").cast("string")).alias("__xn"))
    same = first_by(x.where(F.col("__xn").isNotNull()), ["__xn"], [asc("__xid")]).select("__xn", "__same")
    genre = ctx.source("x_product_genre").where("order_type = 'music'").select(
        b2n("id").alias("id"), b2n("project_id").alias("__pid"), F.col("name").cast("string").alias("__n"), b2n("description").alias("note"))
    genre = genre.withColumn("__gn", _plain("__n"))
    genre = genre.join(ids, F.col("__pid") == F.col("__source"), "left").join(same, F.col("__gn") == F.col("__xn"), "left")
    override = F.when(_overridden(F.col("__pid")) != F.col("__pid"), _overridden(F.col("__pid")))
    odoo = genre.select("id", F.coalesce(override, "__canon", "__pid", "__same").alias("parent"),
                        F.coalesce(normalize_text("__n"), F.lit(L.DEFAULT_SUB_PROJECT)).alias("name"), "note",
                        F.lit(1).alias("priority"))

    # resources before the order system: the project of that name, or its hashed name
    rbo = ctx.source("resource_before_odoo").where(b2n(_col(L.SUBGENRE_COL)).isNotNull()).select(
        _col(L.GENRE_COL).alias("__g"), normalize_text(_col(L.SUBGENRE_COL)).alias("name"))
    rbo = rbo.withColumns({"__gp": _plain("__g"), "__gk": match_key("__g")})
    first = first_by(p.select("__plain", F.col("__own").alias("__p1")).dropna(), ["__plain"], numeric_first("__p1"))
    second = first_by(ctx.source("x_project").select(b2n("id").alias("__xs"), match_key(F.col("name").cast("string")).alias("__k2"))
                      .join(ids, F.col("__xs") == F.col("__source")).select("__k2", F.col("__canon").alias("__p2")).dropna(),
                      ["__k2"], numeric_first("__p2"))
    rbo = rbo.join(first, F.col("__gp") == F.col("__plain"), "left").join(second, F.col("__gk") == F.col("__k2"), "left")
    rbo = rbo.select(_overridden(F.coalesce("__p1", "__p2", sk("__gk"))).alias("parent"),
                     F.coalesce("name", F.lit(L.DEFAULT_SUB_PROJECT)).alias("name")).distinct()
    rbo = rbo.select(sk("parent", "name").alias("id"), "parent", "name", note, F.lit(2).alias("priority"))

    # the sheets that name a project; turn 0 is the performance sheet, a base source
    a_project, a_sub = _col(L.PROJECT_COL), _col(L.SUB_PROJECT_COL)
    none = b2n(a_sub).isNull() | (F.upper(F.trim(a_sub)) == F.lit("#N/A")) | _plain(a_sub).isin(list(L.NO_SUB_PROJECT))
    add = ctx.source("resource_infomation_add").where(
        b2n(a_project).isNotNull() & (F.upper(F.trim(a_project)) != F.lit("#N/A")) & ~_plain(a_project).isin(list(L.NOT_PROJECTS)) & ~none)
    add = add.select(F.lower(normalize_text(a_project)).alias("__pkey"), normalize_text(a_sub).alias("name")).withColumn(
        "key", F.lower("name")).where(F.col("key") != F.lit(L.SUB_PROJECT_HEADER))
    sheets = (_performance(ctx).select("__pkey", F.col("sub").alias("name"), F.lower("sub").alias("key"), F.lit(0).alias("turn"))
              .unionByName(_distro(ctx).select("__pkey", F.col("sub").alias("name"), F.col("__skey").alias("key"), F.lit(1).alias("turn")))
              .unionByName(add.withColumn("turn", F.lit(2))).distinct())
    found = sheets.join(p, F.col("__pkey") == F.col("__name")).select(F.col("__project").alias("parent"), "name", "key", "turn").distinct()

    # the performance sheet counts unless the order system has the sub-project
    have = odoo.select(F.col("parent").alias("__op"), F.lower(normalize_text("name")).alias("__on"))
    perf = found.where("turn = 0").join(have, (F.col("parent") == F.col("__op")) & (F.col("key") == F.col("__on")), "left_anti")
    perf = perf.select(sk("parent", "name").alias("id"), "parent", "name", note, F.lit(3).alias("priority"))

    rows = resolve_children(odoo.unionByName(rbo).unionByName(perf), found.where("turn > 0"),
                            p.select(F.col("__project").alias("parent")), L.DEFAULT_SUB_PROJECT)
    return rows.select(sk("id").alias("dim_sub_project_sk"), F.col("id").alias("sub_project_id"), F.col("parent").alias("project_id"),
                       F.col("name").alias("sub_project_name"), F.col("note").alias("description"))


@model("dim_repository", "silver")
def dim_repository(ctx: ModelContext) -> DataFrame:
    """Repositories of sub-projects: the order system's sub-genres (numeric ids),
    partners under their project's default sub-project, the performance sheet,
    then distributor and added-resource sheets as supplements, and a default
    repository for every sub-project without one."""
    p = ctx.ref("dim_project").where(F.col("project_id").isNotNull() & b2n("project_name").isNotNull()).select(
        F.col("project_id").alias("__project"), match_key("project_name").alias("__pname"))
    subs = ctx.ref("dim_sub_project").where(F.col("sub_project_id").isNotNull() & F.col("project_id").isNotNull()
                                            & b2n("sub_project_name").isNotNull())
    subs = first_by(subs.select("sub_project_id", "project_id", normalize_text("sub_project_name").alias("__sname"),
                                _plain("sub_project_name").alias("__splain")), ["project_id", "__splain"], numeric_first("sub_project_id"))
    tree = subs.withColumn("__skey_of", F.lower("__sname")).join(p, F.col("project_id") == F.col("__project")).select(
        F.col("sub_project_id").alias("parent"), "__pname", "__skey_of")
    note = F.lit(None).cast("string").alias("note")

    odoo = ctx.source("x_product_subgenre").where("order_type = 'music'").select(
        b2n("id").alias("id"), b2n("product_genre_id").alias("parent"), normalize_text(F.col("name").cast("string")).alias("name"),
        note, F.lit(1).alias("priority")).where(F.col("parent").isNotNull())

    # all sheets, by the keys of project and sub-project; turns -2 and -1 are partners and performance, base sources
    partner = _col(L.PARTNER_NAME_COL)
    a_repo, a_project, a_sub = (_col(c) for c in (L.REPO_COL, L.PROJECT_COL, L.SUB_PROJECT_COL))
    none = b2n(a_sub).isNull() | _plain(a_sub).isin(list(L.NO_SUB_PROJECT))
    raw = F.lit(None).cast("string").alias("raw")
    part = ctx.source("partners").where(b2n(partner).isNotNull()).select(
        _plain(_col(L.PROJECT_COL)).alias("__pkey"), F.lit(L.DEFAULT_SUB_PROJECT_KEY).alias("__skey"),
        normalize_text(partner).alias("name"), _plain(partner).alias("key"), F.lit(-2).alias("turn"), partner.alias("raw"))
    perf = _performance(ctx).select("__pkey", F.lower("sub").alias("__skey"), F.col("repo").alias("name"), F.lower("repo").alias("key"),
                                    F.lit(-1).alias("turn"), raw)
    distro = _distro(ctx).where(F.col("repo").isNotNull() & (F.lower("repo") != F.lit(L.REPO_HEADER))).select(
        "__pkey", "__skey", F.col("repo").alias("name"), F.lower("repo").alias("key"), F.lit(1).alias("turn"), raw)
    add = ctx.source("resource_infomation_add").where(
        b2n(a_repo).isNotNull() & ~_plain(a_repo).isin(list(L.NO_SUB_PROJECT)) & b2n(a_project).isNotNull())
    add = add.select(F.lower(normalize_text(a_project)).alias("__pkey"),
                     F.lower(F.when(none, F.lit(L.DEFAULT_SUB_PROJECT)).otherwise(normalize_text(a_sub))).alias("__skey"),
                     normalize_text(a_repo).alias("name"), F.lit(2).alias("turn"), raw).withColumn("key", F.lower("name"))
    sheets = part.unionByName(perf).unionByName(distro).unionByName(add).distinct()
    found = sheets.join(tree, (F.col("__pkey") == F.col("__pname")) & (F.col("__skey") == F.col("__skey_of"))).select(
        "parent", "name", "key", "turn", "raw")

    # partners and performance count unless the order system has the repository
    have = odoo.select(F.col("parent").alias("__op"), F.lower("name").alias("__on"))
    more = found.where("turn < 0").join(have, (F.col("parent") == F.col("__op")) & (F.col("key") == F.col("__on")), "left_anti")
    more = more.select(sk(F.when(F.col("turn") == -2, F.col("raw")).otherwise(F.col("name")), "parent").alias("id"), "parent", "name", note,
                       F.when(F.col("turn") == -2, 2).otherwise(3).alias("priority"))
    rows = resolve_children(odoo.unionByName(more), found.where("turn > 0"), subs.select(F.col("sub_project_id").alias("parent")),
                            L.DEFAULT_REPOSITORY)
    return rows.select(sk("id").alias("dim_repository_sk"), F.col("id").alias("repository_id"), F.col("parent").alias("sub_project_id"),
                       F.col("name").alias("repository_name"))
