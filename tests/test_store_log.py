"""The store's log: replays in every mode, buckets, costs a batch, crashes of the stream."""

import datetime as dt
import os

import pytest

from lakeward.sources import store as store_module
from lakeward.sources.control import SourceSpec, retry_batch, rollback_source, run_extract, run_load
from lakeward.sources.ledger import Ledger
from lakeward.sources.pages import fx_daily_series, month_partitions
from lakeward.sources.store import TableStore
from lakeward.streaming import microbatch
from lakeward.streaming.microbatch import microbatch_load


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def make(spark, *data):
    return spark.createDataFrame(list(data), "id int, v string")


def test_a_batch_is_applied_once_whatever_came_between(spark, workdir):
    st = TableStore(spark, workdir, buckets=4)
    st.load_append(make(spark, (1, "a")), "s.t", "b1")
    st.load_upsert(make(spark, (2, "b")), "s.t", ["id"], "b2")
    assert st.load_append(make(spark, (1, "a")), "s.t", "b1") == 0
    st.load_truncate(make(spark, (3, "c"), (1, "x")), "s.t", "b3")
    assert st.load_upsert(make(spark, (2, "b")), "s.t", ["id"], "b2") == 0 == st.load_append(make(spark, (1, "a")), "s.t", "b1")
    assert rows(st.read("s.t")) == [(1, "x"), (3, "c")]
    assert st.applied("s.t", "b2")["version"] == 2 and st.applied("s.t", "b9") is None


def test_a_rolled_back_batch_can_be_loaded_again(spark, workdir):
    spec = SourceSpec("src", "database", "s.t", "append")
    for day in (1, 2):
        run_load(spark, spec, run_extract(spark, spec, lambda last, d=day: make(spark, (d, "v")), workdir, now=dt.datetime(2024, 1, day)), workdir)
    st = TableStore(spark, workdir)
    assert st.read("s.t").count() == 2
    rollback_source(spark, spec, dt.date(2024, 1, 1), workdir)
    assert [r.id for r in st.read("s.t").collect()] == [1]
    later = Ledger(spark, workdir).current().where("status = 'rolled_back'").first()
    assert retry_batch(spark, spec, later["batch_id"], workdir) == 1
    assert sorted(r.id for r in st.read("s.t").collect()) == [1, 2]


def test_upsert_leaves_the_files_of_other_buckets(spark, workdir):
    st = TableStore(spark, workdir, buckets=16)
    st.load_truncate(spark.range(2000).selectExpr("cast(id as int) id", "'old' v").union(make(spark, (None, "n"), (None, "m"))), "s.t")
    st.load_upsert(make(spark, (0, "new")), "s.t", ["id"])
    before = st.manifest("s.t")
    assert len(before["parts"]) == 16 and before["rows"] == 2002
    st.load_upsert(make(spark, (5, "new"), (5000, "add")), "s.t", ["id"])
    after = st.manifest("s.t")
    touched = {b for p, b in before["parts"].items() if p not in after["parts"]}
    assert 1 <= len(touched) <= 2 and touched == {b for p, b in after["parts"].items() if p not in before["parts"]}
    assert after["rows"] == 2003 == st.read("s.t").count()
    # an append is dealt out by the next upsert, beside what is there
    st.load_append(make(spark, (6000, "later"), (7, "again")), "s.t")
    st.load_upsert(make(spark, (6000, "merged")), "s.t", ["id"])
    kept = [p for p in after["parts"] if p in st.manifest("s.t")["parts"]]
    assert len(kept) >= 15 and None not in st.manifest("s.t")["parts"].values()
    got = {(r.id, r.v) for r in st.read("s.t").collect()}
    assert {(0, "new"), (5, "new"), (5000, "add"), (6000, "merged"), (7, "old"), (7, "again"), (None, "n"), (None, "m")} <= got
    assert st.read("s.t").count() == 2005 == st.manifest("s.t")["rows"]
    # another key: everything is dealt anew
    st.load_upsert(make(spark, (1, "n")), "s.t", ["v"])
    assert st.manifest("s.t")["keys"] == ["v"] and (1, "n") in {(r.id, r.v) for r in st.read("s.t").collect()}


def test_a_commit_costs_the_same_however_many_came_before(spark, workdir):
    st, sizes = TableStore(spark, workdir), []
    schema = make(spark).schema.json()
    for i in range(300):
        old = st.manifest("s.t") if i % 50 == 0 or i < 2 else {**old, "version": i, "recent": [0] * (i % 32), "parts": old["parts"]}  # noqa: F821
        st._publish("s.t", old, {f"p{i:06d}": None}, [], schema, i, f"b{i:06d}")
        sizes.append(os.path.getsize(f"{workdir}/s/t/_manifests/{i + 1:020d}.json"))
    assert max(sizes) - min(sizes) <= 16
    m = st.manifest("s.t")
    assert len(m["parts"]) == 300 and m["version"] == 300 and m["rows"] == 299
    assert all(st.applied("s.t", f"b{i:06d}") for i in (0, 7, 150, 299)) and not st.applied("s.t", "b000300")


def test_snapshots_sum_up(spark, workdir, monkeypatch):
    monkeypatch.setattr(store_module, "SNAPSHOT_AFTER", 3)
    st = TableStore(spark, workdir, buckets=2)
    for i in range(8):
        st.load(make(spark, (i, "v")), "s.t", "upsert" if i in (3, 6) else "append", ["id"], f"b{i}")
    names = os.listdir(f"{workdir}/s/t/_manifests")
    assert any(n.endswith(".snapshot") for n in names) and len(st.manifest("s.t")["recent"]) < 8
    assert rows(st.read("s.t")) == [(i, "v") for i in range(8)]
    for i in range(8):
        assert st.load(make(spark, (i, "v")), "s.t", "append", batch_id=f"b{i}") == 0


@pytest.mark.parametrize("crash_at", ["_write_text", "load", "append"])
@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_the_stream_leaves_table_and_ledger_agreeing(spark, workdir, monkeypatch, crash_at, mode):
    make(spark, (1, "a"), (2, "b")).coalesce(1).write.parquet(f"{workdir}/in")
    schema = make(spark).schema
    run = dict(mode=mode, keys=["id"], checkpoint=f"{workdir}/ckpt")

    def crash(*a, **k):
        raise OSError("crash")
    with monkeypatch.context() as m:
        if crash_at == "load":
            m.setattr(TableStore, "load", crash)            # before anything is committed
        elif crash_at == "append":
            m.setattr(Ledger, "append", crash)              # after the commit
        else:
            m.setattr(store_module, "_write_text", crash)   # in the commit
        with pytest.raises(Exception, match="crash"):
            microbatch_load(spark, f"{workdir}/in", schema, workdir, "s.t", "src", **run)
    assert TableStore(spark, workdir).exists("s.t") == (crash_at == "append")
    microbatch_load(spark, f"{workdir}/in", schema, workdir, "s.t", "src", **run)
    assert [(r[0], r[1]) for r in rows(TableStore(spark, workdir).read("s.t").select("id", "v"))] == [(1, "a"), (2, "b")]
    state = Ledger(spark, workdir).events().collect()
    assert [(e.status, e.row_count, e.batch_id) for e in state] == [("loaded", 2, "src_epoch_0000000000")]
    assert microbatch.read_bronze(spark, state[0].minio_path).count() == 2


def test_calendars_that_end_before_they_start_are_empty(spark):
    assert month_partitions(spark, dt.date(2024, 5, 1), dt.date(2024, 3, 1)).count() == 0
    assert month_partitions(spark, dt.date(2024, 5, 20), dt.date(2024, 5, 1)).count() == 1
    pay = spark.createDataFrame([(f"2024-01-0{i}", '{"usd": {"vnd": 1.5}}') for i in (1, 2, 3)], "d string, p string")
    assert fx_daily_series(pay, "d", "p", "vnd", dt.date(2024, 1, 2), dt.date(2024, 1, 1)).count() == 0
    assert fx_daily_series(pay, "d", "p", "vnd", dt.date(2024, 1, 2), dt.date(2024, 1, 3)).count() == 2
