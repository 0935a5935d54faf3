"""Resources of several sources and the flow of items through the production steps."""

import pytest
from pyspark.sql import functions as F

from lakeward.models import labels as L
from lakeward.models.resources import COLUMNS, places, survivors
from lakeward.plans.production import flow_context, production_context

SF = "/root/testdata/sf0.001"


def side(spark, *rows):
    schema = ", ".join(f"{c} {t}" for c, t in COLUMNS.items())
    return spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in rows], schema)


def test_each_attribute_survives_from_the_source_it_trusts(spark):
    base = side(spark, {"resource_source": "odoo", "source_resource_id": "1", "hg_stock_id": "HGFA1", "resource_name": "base", "repository_id": "rb", "status": "x"},
                {"resource_source": "odoo", "source_resource_id": "2", "hg_stock_id": "hgfa2", "resource_name": None, "repository_id": "rb", "status": "x"},
                {"resource_source": "odoo", "source_resource_id": "3", "hg_stock_id": None, "status": "x"},
                {"resource_source": "odoo", "source_resource_id": "4", "hg_stock_id": None, "status": "x"},
                {"resource_source": "odoo", "source_resource_id": "5", "hg_stock_id": "HGFA1", "song_code": "own", "status": "x"})
    perf = side(spark, {"resource_source": "performance", "source_resource_id": "p1", "hg_stock_id": "HGFA1", "resource_name": "perf", "repository_id": "rp", "song_code": "sp"},
                {"resource_source": "performance", "source_resource_id": "p2", "hg_stock_id": "HGFA2", "resource_name": "perf", "repository_id": None},
                {"resource_source": "performance", "source_resource_id": "p9", "hg_stock_id": "HGFA9", "resource_name": "perf", "repository_id": "rp"})
    added = side(spark, {"resource_source": "added", "source_resource_id": "a1", "hg_stock_id": " hgfa1", "resource_name": "add", "repository_id": "ra"},
                 {"resource_source": "added", "source_resource_id": "a2", "hg_stock_id": "HGFA2", "resource_name": None, "repository_id": "ra"},
                 {"resource_source": "added", "source_resource_id": "a7", "hg_stock_id": "hgfa7", "resource_name": "add", "repository_id": "ra"})
    got = {r.source_resource_id: (r.resource_name, r.repository_id, r.song_code, r.status, r.hg_stock_id) for r in survivors(base, perf, added).collect()}
    done = L.STATUS_ACCEPTED
    assert got == {
        "1": ("add", "rp", "sp", done, "HGFA1"), "5": ("add", "rp", "own", done, "HGFA1"),     # two resources of one code
        "2": (None, "ra", None, done, "hgfa2"),             # the performance sheet wants the same code, the added sheet not
        "3": (None, None, None, "x", None), "4": (None, None, None, "x", None),
        "p2": ("perf", "ra", None, done, "HGFA2"), "p9": ("perf", "rp", None, done, "HGFA9"), "a7": ("add", "ra", None, done, "hgfa7")}


@pytest.fixture(scope="module")
def resources(spark):
    return production_context(spark, SF)


def test_resources_know_only_repositories_that_exist(resources):
    rows = resources.ref("dim_resources").cache()
    known = {r.repository_id for r in resources.ref("dim_repository").collect()}
    found = {r.repository_id for r in rows.select("repository_id").distinct().collect()}
    assert found <= known | {None} and None in found and len(found) > 5
    excluded = {r.hg_stock_id for r in resources.ref("int_excluded_stock_codes").collect()}
    assert excluded and not excluded & {(r.hg_stock_id or "").upper() for r in rows.select("hg_stock_id").collect()}
    assert rows.count() == rows.select("dim_resources_sk").distinct().count()


def test_places_of_equal_names_go_to_the_numeric_id(spark):
    from lakeward.models import ModelContext
    table = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    import datetime as dt
    ctx = ModelContext(spark, {}, dt.date(2024, 1, 1), provided={
        "dim_project": table("project_id string, project_name string", ("x", "Jazz"), ("12", " JAZZ"), ("3", "jazz")),
        "dim_sub_project": table("sub_project_id string, sub_project_name string, project_id string",
                                 ("7", "Slow", "12"), ("9", "slow ", "3"), ("b", "Fast", "x")),
        "dim_repository": table("repository_id string, repository_name string, sub_project_id string",
                                ("q", "Main", "9"), ("10", "main", "9"), ("11", "main", "7"))})
    assert sorted(tuple(r) for r in places(ctx).collect()) == [("jazz", "fast", None, None), ("jazz", "slow", "main", "10")]


def test_every_item_enters_a_step_when_the_step_before_is_done(spark):
    ctx = flow_context(spark, SF)
    rows = ctx.ref("fact_hao_hut").cache()
    items = {(r.step_order, r.status_order): r.n for r in rows.groupBy("step_order", "status_order").agg(
        F.countDistinct("resource_id").alias("n")).collect()}
    assert items[3, 1] + items.get((3, 2), 0) == items[2, 1]
    with_code = rows.where("step_order = 4 and status_order = 1 and hg_stock_id is not null").select("resource_id").distinct().count()
    assert items.get((5, 1), 0) + items.get((5, 2), 0) == with_code > 0
    ordered = rows.where("step_order = 1").agg(F.sum("so_luong")).first()[0]
    wanted = ctx.ref("fact_so_detail").agg(F.sum(F.greatest("song_qty", F.lit(0)))).first()[0]
    assert ordered == wanted                                # what is made and what is missing are what was ordered
    assert rows.where("coalesce(so_luong, 0) = 0").count() == 0
    assert rows.where("flow_item_key not like '%\\_%:%:%'").count() == 0


def test_a_flow_without_rows(spark):
    ctx = flow_context(spark, SF)
    empty = type(ctx)(spark, {}, ctx.as_of, provided={k: v.limit(0) for k, v in ctx.provided.items()})
    assert empty.ref("fact_hao_hut").count() == 0
