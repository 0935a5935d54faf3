import collections
import datetime as dt
import decimal
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from lakeward.operators.marts import daily_totals, sales_fact
from lakeward.quality import rules as R
from lakeward.quality.reconcile import (BATCH_CHECKS, batch_layers, key_differences, key_gap, layer_keys, layer_metrics,
                                        reconcile, reconcile_batch)
from lakeward.sources.store import TableStore
from lakeward.streaming.microbatch import microbatch_load


def test_dq_edge_cases(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, None, "z"), (None, None, "a")],
                               "id int, empty string, s string")
    rules = [R.expect_not_null("n1", "empty"),
             R.expect_unique("u1", "id", severity="critical"),
             R.expect_in_set("m1", "s", ["a", "b"], mostly=0.75),      # 3 of 4 -> exactly met
             R.expect_in_set("m2", "s", ["a", "b"], mostly=0.76),
             R.expect_not_null("x1", "nope"),
             R.Rule("x2", "expect_magic"),
             R.Rule("d1", R.KNOWN[1], {"column": "id"}, enabled=False),
             R.expect_row_count("c1", 1, 3)]
    res = {r.rule_id: r for r in R.validate(df, rules).collect()}
    assert set(res) == {"n1", "u1", "m1", "m2", "x1", "x2", "c1"}
    assert not res["n1"].success and res["n1"].unexpected_count == 4
    assert not res["u1"].success and res["u1"].unexpected_count == 2      # both copies of id 2
    assert res["m1"].success and not res["m2"].success
    assert not res["x1"].success and "not found" in res["x1"].raw_result
    assert not res["x2"].success and not res["c1"].success
    g = R.gate(R.validate(df, rules)).first()
    assert g.status == "failed"
    with pytest.raises(RuntimeError):
        R.enforce(R.gate(R.validate(df, rules)))
    warn_only = [R.expect_in_set("w", "s", ["a"])]
    assert R.gate(R.validate(df, warn_only)).first().status == "passed_with_warnings"
    assert R.gate(R.validate(df, [R.expect_row_count("ok", 1)])).first().status == "passed"
    assert R.gate(R.validate(df, []), load_done=False).first().status == "skipped"
    assert R.gate(R.validate(df, []), enabled=False).first().status == "disabled"


def test_dq_fk_and_record(spark, workdir):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    r = R.validate(facts, [R.expect_fk("fk", "k", dim, "k")]).first()
    assert not r.success and r.unexpected_count == 1
    rules = [R.expect_not_null("a", "k")]
    h = R.record_run(R.validate(facts, rules), workdir, "run1", "src", "stg.t", "b1", rules).first()
    assert h.status == "passed_with_warnings" and h.total_rules == 1
    assert spark.read.parquet(os.path.join(workdir, "_dq/results")).count() == 1
    assert R.config_hash(rules) == R.config_hash(list(rules))


def test_key_rules_over_types_nulls_and_empty_tables(spark):
    at = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame(
        [(1, 0.0, b"x", at, "1", [1]), (1, -0.0, b"y", at, "2", [1]), (3, 2.5, b"x", None, None, None), (None, None, None, None, "x", None)],
        "k int, f double, b binary, t timestamp, s string, a array<int>")
    dim = spark.createDataFrame([(1,), (1,), (None,), (2 ** 40,)], "id bigint")
    names = spark.createDataFrame([("x",), ("1",)], "`a.b` string")
    rules = [R.expect_unique(c, c) for c in "kfbts"] + [
        R.expect_unique("a", "a"), R.expect_fk("fk", "k", dim, "id"), R.expect_fk("names", "s", names, "a.b"),
        R.expect_fk("gone", "s", names, "b"), R.expect_row_count("n", 4, 4), R.expect_expr("e", "k < 3")]
    got = {r.rule_id: (r.success, r.unexpected_count) for r in R.validate(df, rules).collect()}
    assert got == {"k": (False, 2), "f": (False, 2), "b": (False, 2), "t": (False, 2), "s": (True, 0),
                   "a": (False, None), "fk": (False, 1), "names": (False, 1), "gone": (False, None),
                   "n": (True, None), "e": (False, 2)}
    none = {r.rule_id: (r.success, r.element_count) for r in R.validate(df.limit(0), rules).collect()}
    assert none["k"] == none["fk"] == none["e"] == (True, 0) and none["n"] == (False, 0)


def test_one_scan_for_any_number_of_rules(spark, workdir):
    path = f"{workdir}/facts"
    spark.range(3000).selectExpr("id", "id % 7 as hot", "cast(id as string) as s").write.parquet(path)
    dim = spark.range(5).withColumnRenamed("id", "k")
    facts = spark.read.parquet(path)
    rules = [R.expect_unique("u1", "id"), R.expect_unique("u2", "hot"), R.expect_unique("u3", "s"),
             R.expect_fk("f1", "hot", dim, "k"), R.expect_fk("f2", "id", dim, "k"), R.expect_not_null("n1", "s")]
    out = R.validate(facts, rules)
    bad = {r.rule_id: r.unexpected_count for r in out.collect()}
    assert bad == {"u1": 0, "u2": 3000, "u3": 0, "f1": sum(1 for i in range(3000) if i % 7 > 4), "f2": 2995, "n1": 0}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1, plan


def test_current_batch(spark):
    df = spark.createDataFrame([("b1", dt.datetime(2026, 1, 1)), ("b2", dt.datetime(2026, 1, 2)),
                                ("b3", dt.datetime(2026, 1, 2))], "_batch_id string, _loaded_at timestamp")
    assert sorted(r[0] for r in R.current_batch(df).collect()) == ["b2", "b3"]
    assert R.current_batch(df.limit(0)).collect() == []


def test_golden_sales_slice_reconciles(spark):
    # invented golden sample: 5 sales on 5 days, total 9,600,000
    rows = [("S1", "Ann", "1200000", "2026-09-01"), ("S2", "Bao", "2400000", "2026-09-02"),
            ("S3", "Chi", "1800000", "2026-09-03"), ("S4", "Dan", "3000000", "2026-09-04"),
            ("S5", "Eve", "1200000", "2026-09-05")]
    bronze = spark.createDataFrame([r + ("b1", dt.datetime(2026, 9, 6)) for r in rows] +
                                   [("S1", "Ann", "1", "2026-09-01", "b0", dt.datetime(2026, 9, 5))],
                                   "sale_id string, customer_name string, amount string, sale_date string, "
                                   "_batch_id string, _loaded_at timestamp")
    silver = sales_fact(bronze)
    gold = daily_totals(silver)
    assert gold.count() == 5
    assert gold.agg(F.sum("total_amount")).first()[0] == decimal.Decimal("9600000.00")
    current = bronze.filter(F.col("_batch_id") == "b1")
    m = (layer_metrics("bronze", current, "amount").unionByName(layer_metrics("silver", silver, "amount"))
         .unionByName(layer_metrics("gold", gold, "total_amount", count_col="order_count")))
    checks = [("rows", "rows", "silver", "bronze"), ("amount", "amount", "silver", "bronze"),
              ("gold_rows", "rows", "gold", "silver"), ("gold_amount", "amount", "gold", "silver")]
    res = reconcile(m, checks, {"keys": key_gap(current, silver, "sale_id")}).collect()
    assert len(res) == 5 and all(r.success for r in res)


def test_microbatch_load_resumes_and_is_idempotent(spark, workdir):
    land = os.path.join(workdir, "landing")
    schema = "id long, v string"
    for i in range(3):
        spark.createDataFrame([(i * 10 + j, f"v{j}") for j in range(5)], schema).coalesce(1) \
             .write.mode("append").parquet(land)
    ck = os.path.join(workdir, "ckpt")
    st_schema = spark.read.parquet(land).schema
    microbatch_load(spark, land, st_schema, workdir, "stg.stream", "feed", checkpoint=ck, max_files_per_trigger=1)
    st = TableStore(spark, workdir)
    assert st.read("stg.stream").count() == 15
    assert st.read("stg.stream").select("_batch_id").distinct().count() == 3
    spark.createDataFrame([(99, "new")], schema).coalesce(1).write.mode("append").parquet(land)
    microbatch_load(spark, land, st_schema, workdir, "stg.stream", "feed", checkpoint=ck)
    assert st.read("stg.stream").count() == 16


def test_key_differences_name_the_ranges(spark):
    checks = [("b_of_a", "b", "a"), ("c_of_a", "c", "a")]
    a = [(str(i),) for i in range(500)] + [("7",), (None,), (" 8 ",)]
    b = [(str(i),) for i in range(500)] + [("9",)] * 3
    c = [(str(i),) for i in range(3, 500)] + [("new",), ("new",)]
    frame = lambda name, rows: layer_keys(name, spark.createDataFrame(rows, "k string"), "k")
    keys = frame("a", a).unionByName(frame("b", b)).unionByName(frame("c", c))
    got = key_differences(keys, checks, digits=1).collect()
    where = lambda k: hashlib.md5(k.encode()).hexdigest()[0]
    want = collections.Counter(("m", where(k)) for k in "012") + collections.Counter([("x", where("new"))])
    assert {r.check_name for r in got} == {"c_of_a"}
    assert collections.Counter({("m", r.key_range): r.n_missing for r in got}) + \
        collections.Counter({("x", r.key_range): r.n_extra for r in got}) == want
    # one layer is empty: all keys of the other are missing
    assert key_differences(frame("a", a), checks[:1]).agg(F.sum("n_missing")).first()[0] == 500
    assert key_differences(keys.limit(0), checks).count() == 0


def test_equal_layers_shuffle_no_key_twice(spark, workdir):
    """The keys are shuffled for the digests; below the drill-down only those of ranges that differ."""
    spark.range(20_000).select(F.col("id").cast("string").alias("k")).write.parquet(f"{workdir}/k")
    k = spark.read.parquet(f"{workdir}/k")
    keys = layer_keys("a", k, "k").unionByName(layer_keys("b", k, "k"))
    out = key_differences(keys, [("b_of_a", "b", "a")])
    assert out.collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan.split("== Initial Plan ==")[0] and "LeftAnti" not in plan


def test_batch_checks_without_a_loaded_batch(spark):
    rows = spark.createDataFrame([("1", "2.00", "2026-09-01", "b1", dt.datetime(2026, 9, 2))],
                                 "sale_id string, amount string, sale_date string, _batch_id string, _loaded_at timestamp")
    events = spark.createDataFrame([("s", "b1", "extracted", 1, dt.datetime(2026, 9, 2))],
                                   "source_id string, batch_id string, status string, row_count long, event_at timestamp")
    def failed(rows, events):
        silver = sales_fact(rows)
        layers = batch_layers(rows, rows, rows, silver)
        res = reconcile_batch(events, "s", layers, daily_totals(silver), "sale_id", "amount", "order_count", "total_amount").collect()
        assert len(res) == len(BATCH_CHECKS) == 15
        return [r.check_name for r in res if not r.success]
    assert failed(rows, events) == ["bronze_rows_of_ledger"]
    loaded = events.withColumn("status", F.lit("loaded")).withColumn("event_at", F.lit(dt.datetime(2026, 9, 3)))
    assert failed(rows, events.unionByName(loaded)) == []
    assert failed(rows.limit(0), events) == ["bronze_rows_of_ledger"]
