import datetime as dt
import decimal
import unicodedata

from pyspark.sql import functions as F

from lakeward.operators.allocate import POSITION_WEIGHTS, allocate_by_weight, allocate_evenly_over_calendar
from lakeward.operators.entities import canonicalise_entities, resolve_level
from lakeward.operators.generate import (add_default_member, key_set_diff, lateral_values, split_to_rows,
                                         union_sources, unpivot, values_relation)
from lakeward.operators.joins import explode_list, full_outer_coalesce, list_lookup_agg
from lakeward.operators.marts import growth_vs_previous
from lakeward.operators.ordering import asc


def test_weights_sum_to_ten():
    for n, ws in POSITION_WEIGHTS.items():
        assert sum(ws) == 10 and len(ws) == n


def test_allocate_by_weight_keeps_totals(spark):
    rows = []
    for parent, n in [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 8)]:
        rows += [(parent, i) for i in range(n)]
    kids = spark.createDataFrame(rows, "p int, i int")
    parents = spark.createDataFrame([(p, float(p * 100)) for p in range(1, 7)], "p int, amount double")
    out = allocate_by_weight(kids, ["p"], [asc("i")], parents, "amount")
    tot = {r.p: r.t for r in out.groupBy("p").agg(F.sum("allocated").alias("t")).collect()}
    assert tot == {p: decimal.Decimal(p * 100) for p in range(1, 7)}
    assert out.filter(F.col("p") == 6).count() == 5            # positions after the fifth get nothing
    w = {r.position: r.weight for r in out.filter(F.col("p") == 3).collect()}
    assert w == {1: 6, 2: 3, 3: 1}


def test_even_calendar_split(spark):
    res = spark.createDataFrame([("g", "r1", dt.date(2024, 1, 15)), ("g", "r2", dt.date(2024, 3, 2)),
                                 ("g", "r3", None)], "g string, r string, start date")
    costs = spark.createDataFrame([("g", dt.date(2024, 1, 1), 90.0), ("g", dt.date(2024, 3, 1), 90.0),
                                   ("g", dt.date(2024, 4, 1), 0.0)], "g string, month date, cost double")
    out = allocate_evenly_over_calendar(res, ["g"], "r", "start", costs, "cost",
                                        F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 4, 1)))
    got = sorted((r.r, r.month.month, r.allocated) for r in out.collect())
    assert (got[0][0], got[0][1], got[0][2]) == ("r1", 1, 45.0)        # r1 and r3 active in January
    march = [x for x in got if x[1] == 3]
    assert [x[2] for x in march] == [30.0, 30.0, 30.0]
    assert sum(x[2] for x in got if x[1] in (1, 3)) == 180.0


def test_canonicalise_entities_nfc_alias_numeric_first(spark):
    nfd = unicodedata.normalize("NFD", "Dự án Một")
    src = spark.createDataFrame([(1, "abc123", "Dự án Một"), (2, "17", nfd + "  "), (3, "9", "DỰ ÁN MỘT"),
                                 (2, "x1", "Project One"), (1, "5", "Other")],
                                "source_priority int, id string, name string")
    aliases = values_relation(spark, [("project one", "Dự án Một")], "alias string, canonical string")
    ent, idmap = canonicalise_entities(src, aliases=aliases)
    got = {r.name_key: (r.canonical_id, r.member_ids) for r in ent.collect()}
    assert got == {"dự án một": ("9", 4), "other": ("5", 1)}
    assert idmap.filter(F.col("canonical_id") == "9").count() == 4


def test_resolve_level_with_parent_and_alias(spark):
    regions = spark.createDataFrame([(0, "MIDDLE EAST"), (1, "EUROPE")], "rk int, rname string")
    nations = spark.createDataFrame([(10, "EGYPT", 0), (11, "FRANCE", 1), (12, "EGYPT", 1)],
                                    "nk int, nname string, nrk int")
    raw = spark.createDataFrame([("mid-east", "egypt"), (" europe ", "Egypt "), ("nowhere", "x")],
                                "rt string, nt string")
    aliases = values_relation(spark, [("Mid-East", "MIDDLE EAST")], "alias string, canonical string")
    a = resolve_level(raw, "rt", regions, "rname", "rk", "region_key", aliases=aliases)
    b = resolve_level(a, "nt", nations, "nname", "nk", "nation_key", parent=("region_key", "nrk"))
    got = sorted((r.rt, r.region_key, r.nation_key) for r in b.collect())
    assert got == [(" europe ", 1, 12), ("mid-east", 0, 10), ("nowhere", None, None)]


def test_default_member_added_once(spark):
    kids = spark.createDataFrame([(1, "a"), (2, "No repository")], "parent int, name string")
    parents = spark.createDataFrame([(1,), (2,), (3,)], "parent int")
    out = add_default_member(kids, parents, "parent", "name", "No repository")
    got = sorted((r.parent, r.name) for r in out.collect())
    assert got == [(1, "No repository"), (1, "a"), (2, "No repository"), (3, "No repository")]


def test_list_lookup_keeps_list_order(spark):
    df = spark.createDataFrame([(1, "3, 1,3"), (2, ""), (3, None), (4, "99")], "rid int, ids string")
    dim = spark.createDataFrame([(1, "one"), (3, "three")], "k int, name string")
    got = {r.rid: r.names for r in list_lookup_agg(df, "rid", "ids", dim, "k", "name", "names").collect()}
    assert got == {1: "three, one, three", 2: None, 3: None, 4: None}
    assert explode_list(df, "ids").filter(F.col("rid") == 1).count() == 3


def test_generators_and_sets(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, a double, b double")
    assert unpivot(df, ["id"], ["a", "b"], "m", "v").count() == 2
    lv = lateral_values(df, [{"s": F.lit("x"), "q": F.col("a")}, {"s": F.lit("y"), "q": F.col("b")}])
    assert sorted((r.s, r.q) for r in lv.collect()) == [("x", 2.0), ("y", 3.0)]
    s = spark.createDataFrame([("a / b /  ",)], "v string")
    assert [r.item for r in split_to_rows(s, "v", "/", "item").collect()] == ["a", "b"]
    u = union_sources([spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2, "x")], "k int, z string")])
    assert u.count() == 2 and "z" in u.columns
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted((r.only_in, r.k) for r in key_set_diff(a, b, "k").collect()) == [("left", 1), ("right", 3)]
    f = full_outer_coalesce(a.withColumn("x", F.lit(1)), b.withColumn("y", F.lit(2)), "k")
    assert sorted(r.k for r in f.collect()) == [1, 2, 3]


def test_growth_uses_previous_present_month(spark):
    df = spark.createDataFrame([("s", dt.date(2024, 1, 1), 100.0), ("s", dt.date(2024, 3, 1), 150.0),
                                ("s", dt.date(2024, 4, 1), 0.0), ("s", dt.date(2024, 5, 1), 10.0)],
                               "k string, m date, v double")
    got = [r.growth for r in growth_vs_previous(df, ["k"], "m", "v").orderBy("m").collect()]
    assert got == [None, 0.5, -1.0, None]
