"""Loads, extracts and checks that must not lose or change data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.operators.allocate import month_calendar
from lakeward.operators.joins import as_of_lookup
from lakeward.quality import rules as R
from lakeward.sources import store as store_module
from lakeward.sources.checksum import table_fingerprint
from lakeward.sources.control import SourceSpec, rollback_source, run_extract, run_load
from lakeward.sources.landing import scan_csv
from lakeward.sources.ledger import Ledger
from lakeward.sources.pages import fx_daily_series, page_chain_check
from lakeward.sources.store import TableStore
from lakeward.streaming.microbatch import microbatch_load


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_append_keeps_columns_and_types(spark, workdir):
    st = TableStore(spark, workdir)
    st.load_append(spark.createDataFrame([(1, "a")], "id int, v string"), "s.t")
    st.load_append(spark.createDataFrame([(2,)], "id int"), "s.t")
    st.load_append(spark.createDataFrame([("3", 7)], "id string, v int"), "s.t")
    assert rows(st.read("s.t")) == [(1, "a"), (2, None), (3, "7")]
    with pytest.raises(Exception, match="is no int"):
        st.load_append(spark.createDataFrame([("x", "b")], "id string, v string"), "s.t")
    assert st.read("s.t").count() == 3
    st.load_truncate(spark.createDataFrame([(9,)], "id int"), "s.t")
    assert rows(st.read("s.t")) == [(9, None)]


def test_upsert_leaves_columns_that_the_batch_lacks(spark, workdir):
    st = TableStore(spark, workdir)
    st.load_truncate(spark.createDataFrame([(1, "x", "y"), (2, "z", "w"), (None, "n", "n")], "id int, a string, b string"), "s.t")
    st.load_upsert(spark.createDataFrame([(2, "new"), (3, "add")], "id int, a string"), "s.t", ["id"])
    want = [(1, "x", "y"), (2, "new", "w"), (3, "add", None), (None, "n", "n")]
    assert rows(st.read("s.t")) == sorted(want, key=str)
    st.load_upsert(spark.createDataFrame([(1,), (4,)], "id int"), "s.t", ["id"])
    assert rows(st.read("s.t")) == sorted(want + [(4, None, None)], key=str)


@pytest.mark.parametrize("step", ["files", "manifest"])
def test_a_crash_leaves_the_old_version(spark, workdir, monkeypatch, step):
    st = TableStore(spark, workdir)
    st.load_append(spark.createDataFrame([(1,)], "id int"), "s.t", "b1")

    def crash(*a, **k):
        raise OSError("crash")
    with monkeypatch.context() as m:
        m.setattr(TableStore, "_write_files", crash) if step == "files" else m.setattr(store_module, "_write_text", crash)
        with pytest.raises(OSError):
            st.load_append(spark.createDataFrame([(2,)], "id int"), "s.t", "b2")
    assert rows(st.read("s.t")) == [(1,)]
    st.load_append(spark.createDataFrame([(2,)], "id int"), "s.t", "b2")
    assert rows(st.read("s.t")) == [(1,), (2,)]


def test_a_version_is_published_once(spark, workdir):
    st = TableStore(spark, workdir)
    st.load_append(spark.createDataFrame([(1,)], "id int"), "s.t")
    with pytest.raises(OSError):
        store_module._write_text(spark, f"{workdir}/s/t/_manifests/{1:020d}.json", "{}")


SPEC = SourceSpec("src", "database", "s.t", "append", incremental=True, watermark_column="at")


def test_watermark_is_that_of_the_landed_rows(spark, workdir):
    source = [(1, "2024-01-01 00:00:00")]

    def read(last):
        df = spark.createDataFrame(source, "id int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
        return df if last is None else df.where(F.col("at") > F.lit(last).cast("timestamp_ntz"))
    b = run_extract(spark, SPEC, read, workdir, now=dt.datetime(2024, 1, 2))
    run_load(spark, SPEC, b, workdir)
    source.append((2, "2024-01-03 00:00:00"))
    calls = []

    def read_while_rows_come_in(last):
        calls.append(last)
        df = read(last)
        if last is not None:            # a row that comes in after the delta was read
            source.append((3, "2024-01-05 00:00:00"))
        return df
    b = run_extract(spark, SPEC, read_while_rows_come_in, workdir, now=dt.datetime(2024, 1, 4))
    run_load(spark, SPEC, b, workdir)
    b = run_extract(spark, SPEC, read, workdir, now=dt.datetime(2024, 1, 6))
    run_load(spark, SPEC, b, workdir)
    assert sorted(r["id"] for r in TableStore(spark, workdir).read("s.t").collect()) == [1, 2, 3]
    assert run_extract(spark, SPEC, read, workdir, now=dt.datetime(2024, 1, 7)) is None
    forced = run_extract(spark, SPEC, read, workdir, force=True, now=dt.datetime(2024, 1, 8))
    assert forced.rows == 3


def test_rollback_writes_events(spark, workdir):
    spec = SourceSpec("full", "database", "s.f", "truncate")
    for day, n in ((1, 1), (2, 2), (3, 3)):
        b = run_extract(spark, spec, lambda last, n=n: spark.range(n), workdir, now=dt.datetime(2024, 1, day))
        run_load(spark, spec, b, workdir)
    assert rollback_source(spark, spec, dt.date(2024, 1, 1), workdir) == 1
    state = {r["extracted_at"].day: r["status"] for r in Ledger(spark, workdir).current().collect()}
    assert state == {1: "loaded", 2: "rolled_back", 3: "rolled_back"}


def test_a_broken_ledger_is_an_error(spark, workdir, tmp_path):
    assert Ledger(spark, workdir).events().count() == 0
    (tmp_path / "_ledger").mkdir()
    (tmp_path / "_ledger" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        Ledger(spark, workdir).events().count()


def test_a_streamed_batch_is_rolled_back_to_its_own_rows(spark, workdir):
    land, schema = f"{workdir}/land", T.StructType([T.StructField("id", T.LongType())])
    for start, end in ((0, 1), (1, 3)):
        spark.range(start, end).coalesce(1).write.mode("append").parquet(land)
        microbatch_load(spark, land, schema, workdir, "s.stream", "feed", checkpoint=f"{workdir}/ck")
    assert TableStore(spark, workdir).read("s.stream").count() == 3
    events = Ledger(spark, workdir).current().orderBy("batch_id").collect()
    assert [e["row_count"] for e in events] == [1, 2]
    first = spark.read.parquet(events[0]["minio_path"])
    assert [r["id"] for r in first.collect()] == [0] and "_batch_id" in first.columns


def test_csv_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"say ""hi"" now"\n2,"two\nlines"\n')
    got = scan_csv(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert rows(got) == [("1", 'say "hi" now'), ("2", "two\nlines")]


def test_fingerprint_heeds_where_nulls_are(spark):
    a = spark.createDataFrame([(None, "a")], "x string, y string")
    b = spark.createDataFrame([("a", None)], "x string, y string")
    assert table_fingerprint(a) != table_fingerprint(b)


def test_page_gaps_and_open_ends(spark):
    pages = spark.createDataFrame([("ok", 0, True, "c0"), ("ok", 1, False, None), ("gap", 0, True, "a"), ("gap", 2, False, None),
                                   ("open", 0, True, "b"), ("twice", 0, True, "d"), ("twice", 1, True, "d"), ("twice", 2, False, None)],
                                  "s string, n int, more boolean, c string")
    got = {r["s"]: r for r in page_chain_check(pages, "s", "n", "more", "c", 10).collect()}
    assert {k: r["ok"] for k, r in got.items()} == {"ok": True, "gap": False, "open": False, "twice": False}
    assert got["gap"]["page_gaps"] == 1 and got["open"]["dangling_has_more"] == 1 and got["twice"]["repeated_cursor"] == 1


def test_ties_are_declared(spark):
    fx = spark.createDataFrame([("2024-01-01", '{"usd":{"vnd":2.0}}'), ("2024-01-01", '{"usd":{"vnd":3.0}}')], "d string, p string")
    assert [r["rate"] for r in fx_daily_series(fx, "d", "p", "vnd", dt.date(2024, 1, 1), dt.date(2024, 1, 1)).collect()] == [3.0]
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 9, "c")], "k int, t int, v string")
    assert [r["v"] for r in as_of_lookup(df.repartition(3), "k", "t", F.lit(6)).collect()] == ["b"]


def test_calendar_after_its_end_has_no_months(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 5, 2)), (2, dt.date(2024, 1, 2))], "k int, s date")
    assert rows(month_calendar(df, "s", F.lit(dt.date(2024, 2, 1))).select("k", "month")) == [
        (2, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1))]


def test_a_broken_rule_is_a_failed_row(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    known = R.KNOWN
    got = {r["rule_id"]: r["success"] for r in R.validate(df, [
        R.Rule("re", known[4], kwargs={"column": "v", "regex": "("}), R.Rule("ex", known[5], kwargs={"expression": "nope > 1"}),
        R.Rule("no", known[5], kwargs={"expression": "id + 1"}), R.Rule("ok", known[5], kwargs={"expression": "id = 1"})]).collect()}
    assert got == {"re": False, "ex": False, "no": False, "ok": True}
