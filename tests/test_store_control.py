import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeward.sources.control import SourceSpec, retry_batch, rollback_source, run_extract, run_load
from lakeward.sources.ledger import Ledger, current_state, history, last_success, rollback_target
from lakeward.sources.landing import scan_csv, scan_csv_incremental
from lakeward.sources.store import TableStore, new_batch_id, read_bronze, write_bronze


def test_truncate_is_atomic_on_schema_mismatch(spark, workdir):
    st = TableStore(spark, workdir)
    st.load_truncate(spark.createDataFrame([(1, "a"), (2, "b")], "id int, value string"), "stg.safety")
    bad = spark.createDataFrame([(3, "c", 1)], "id int, value string, unexpected int")
    with pytest.raises(ValueError):
        st.load_truncate(bad, "stg.safety")
    assert sorted(r.id for r in st.read("stg.safety").collect()) == [1, 2]
    assert st.load_truncate(spark.createDataFrame([(9, "z")], "id int, value string"), "stg.safety") == 1
    assert [r.id for r in st.read("stg.safety").collect()] == [9]


def test_append_is_idempotent_per_batch(spark, workdir):
    st = TableStore(spark, workdir)
    df = spark.createDataFrame([(1,)], "id int")
    assert st.load_append(df, "stg.a", "b1") == 1
    assert st.load_append(df, "stg.a", "b1") == 0
    assert st.load_append(df, "stg.a", "b2") == 1
    assert st.read("stg.a").count() == 2


def test_upsert_rules(spark, workdir):
    st = TableStore(spark, workdir)
    st.load_truncate(spark.createDataFrame([(1, "old"), (2, "same")], "id int, v string"), "stg.u")
    n = st.load_upsert(spark.createDataFrame([(1, "new"), (3, "added")], "id int, v string"), "stg.u", ["id"])
    assert n == 2
    assert sorted((r.id, r.v) for r in st.read("stg.u").collect()) == [(1, "new"), (2, "same"), (3, "added")]
    with pytest.raises(ValueError):
        st.load_upsert(spark.createDataFrame([(4, "x"), (4, "y")], "id int, v string"), "stg.u", ["id"])
    with pytest.raises(KeyError):
        st.load_upsert(spark.createDataFrame([("x",)], "v string"), "stg.u", ["id"])
    with pytest.raises(ValueError):
        st.load_upsert(spark.createDataFrame([(5, "x", 1)], "id int, v string, extra int"), "stg.u", ["id"])
    assert st.load_upsert(spark.createDataFrame([], "id int, v string"), "stg.u", ["id"]) == 0
    assert st.read("stg.u").count() == 3
    with pytest.raises(ValueError):
        st.load(spark.createDataFrame([(1,)], "id int"), "stg.u", "merge")


def test_bronze_is_immutable(spark, workdir):
    df = spark.createDataFrame([(1,)], "id int")
    bid = new_batch_id("src", dt.datetime(2026, 9, 1, 12, 0, 0, 5))
    assert bid == "src_20260901_120000_000005"
    p = write_bronze(df, workdir, "src", bid)
    with pytest.raises(Exception):
        write_bronze(df, workdir, "src", bid)
    assert read_bronze(spark, p).count() == 1


def test_ledger_lookups(spark, workdir):
    L = Ledger(spark, workdir)
    t = lambda d, h=0: dt.datetime(2026, 9, d, h)
    for bid, day, status in [("b1", 1, "loaded"), ("b2", 1, "loaded"), ("b3", 2, "loaded"), ("b4", 3, "failed")]:
        L.append(source_id="s", batch_id=bid, status="extracted", extracted_at=t(day, int(bid[1])),
                 event_at=t(day, int(bid[1])))
        L.append(source_id="s", batch_id=bid, status=status, extracted_at=t(day, int(bid[1])),
                 event_at=t(day, int(bid[1]) + 1), error_message="x" * 5000 if status == "failed" else None)
    state = current_state(L.events())
    assert state.count() == 4
    assert last_success(state, "s").first().batch_id == "b3"
    assert rollback_target(state, dt.date(2026, 9, 1), "s").first().batch_id == "b2"
    assert rollback_target(state, dt.date(2026, 8, 1), "s").first() is None
    assert [r.batch_id for r in history(state, "s", 2).collect()] == ["b4", "b3"]
    assert len(state.filter(F.col("batch_id") == "b4").first().error_message) == 2000


def _csv(path, rows):
    with open(path, "w") as f:
        f.write("sale_id,amount,sale_date\n" + "".join(f"{a},{b},{c}\n" for a, b, c in rows))


def test_run_extract_load_retry_rollback(spark, workdir):
    land = os.path.join(workdir, "landing.csv")
    spec = SourceSpec("sales_csv", "csv", "stg.sales", "append", incremental=True, watermark_column="sale_date")

    def read(last):
        df = scan_csv(spark, land)
        return df if last is None else scan_csv_incremental(df, "sale_date", last)[0]

    _csv(land, [(1, 100, "2026-09-01"), (2, 200, "2026-09-02")])
    b1 = run_extract(spark, spec, read, workdir, now=dt.datetime(2026, 9, 2, 1))
    assert b1.rows == 2 and b1.mode == "append"
    assert run_load(spark, spec, b1, workdir) == 2
    # unchanged file -> skipped
    assert run_extract(spark, spec, read, workdir, now=dt.datetime(2026, 9, 2, 2)) is None
    # a new row -> only the delta above the stored watermark
    _csv(land, [(1, 100, "2026-09-01"), (2, 200, "2026-09-02"), (3, 300, "2026-09-03")])
    b2 = run_extract(spark, spec, read, workdir, now=dt.datetime(2026, 9, 3, 1))
    assert b2.rows == 1 and b2.mode == "append"
    run_load(spark, spec, b2, workdir)
    assert TableStore(spark, workdir).read("stg.sales").count() == 3
    # an old row edited, no newer rows -> full snapshot, truncate
    _csv(land, [(1, 150, "2026-09-01"), (2, 200, "2026-09-02"), (3, 300, "2026-09-03")])
    b3 = run_extract(spark, spec, read, workdir, now=dt.datetime(2026, 9, 4, 1))
    assert b3.rows == 3 and b3.mode == "truncate"
    run_load(spark, spec, b3, workdir)
    tbl = TableStore(spark, workdir).read("stg.sales")
    assert sorted(r.amount for r in tbl.collect()) == ["150", "200", "300"]
    # retry reloads a known batch (an append of an already applied batch is a
    # no-op); a batch of another source is refused
    assert retry_batch(spark, spec, b3.batch_id, workdir) == 0
    full = SourceSpec("sales_csv", "csv", "stg.sales", "truncate")
    assert retry_batch(spark, full, b3.batch_id, workdir) == 3
    with pytest.raises(ValueError):
        retry_batch(spark, SourceSpec("other", "csv", "stg.x"), b3.batch_id, workdir)
    # rollback to the first day restores the first batch only
    assert rollback_source(spark, spec, dt.date(2026, 9, 2), workdir) == 2
    assert TableStore(spark, workdir).read("stg.sales").count() == 2
    assert rollback_source(spark, spec, dt.date(2026, 8, 1), workdir) is None


def test_balanced_scan_spreads_only_unsplit_inputs(spark, workdir, monkeypatch):
    import lakeward.session as S
    path = f"{workdir}/one"
    spark.range(5000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert df.rdd.getNumPartitions() == 1
    assert S.balanced_scan(df) is df                     # below the size threshold: untouched
    monkeypatch.setattr(S, "UNSPLIT_SCAN_BYTES", 1)
    spread = S.balanced_scan(df)
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r[0] for r in spread.collect()) == list(range(5000))
    split = spark.range(5000).repartition(spark.sparkContext.defaultParallelism)
    split.write.parquet(f"{workdir}/many")
    many = spark.read.parquet(f"{workdir}/many")
    if many.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism:
        assert S.balanced_scan(many) is many             # already split: untouched
