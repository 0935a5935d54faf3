import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.sources.checksum import changed_folders, file_checksums, file_tree, table_fingerprint, tree_digest
from lakeward.sources.grid import grid_to_table
from lakeward.sources.jdbc import month_bounds, scan_jdbc, source_predicate, has_changed_watermark, max_watermark
from lakeward.sources.landing import (add_audit_columns, coerce_time_suffix, field_mapping, nested_to_json,
                                      sanitize_names, scan_csv, scan_csv_incremental, tag_from_source_name,
                                      validate_identifier, validate_table_name)
from lakeward.sources.pages import (all_or_nothing_union, flatten_pages, fx_daily_series, month_partitions,
                                    page_chain_check, page_errors)


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_sanitize_names():
    assert sanitize_names(["a\nb", " x ", "", "x", "x"]) == ["a b", "x", "col_2", "x_1", "x_2"]


def test_scan_csv_quoting_short_and_long_rows(spark, workdir):
    p = write(os.path.join(workdir, "s.csv"),
              ' id , name ,amount\n1,"Doe, Jane",10\n2,Short\n3,Long,5,EXTRA\n4,Ok,7\n')
    df = scan_csv(spark, p)
    assert df.columns == ["id", "name", "amount"]
    got = sorted((r.id, r.name, r.amount) for r in df.collect())
    assert got == [("1", "Doe, Jane", "10"), ("2", "Short", None), ("4", "Ok", "7")]
    assert all(t == "string" for _, t in df.dtypes)


def test_scan_csv_incremental_watermark_before_filter(spark, workdir):
    p = write(os.path.join(workdir, "d.csv"),
              "sale_id,amount,sale_date\n1,5,2026-09-01\n2,6,2026-09-02\n3,7,not a date\n")
    df = scan_csv(spark, p)
    delta, wm = scan_csv_incremental(df, "sale_date", "2026-09-01")
    assert [r.sale_id for r in delta.collect()] == ["2"]
    assert wm.first()[0] == dt.datetime(2026, 9, 2)
    with pytest.raises(KeyError):
        scan_csv_incremental(df, "missing", None)


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, {"a": 1}, [1, 2], "2024-01-01 10:00:00", "junk")],
                               "id int, m map<string,int>, arr array<int>, createdAt string, updatedUtc string")
    j = nested_to_json(df)
    assert j.first().m == '{"a":1}' and j.first().arr == "[1,2]"
    c = coerce_time_suffix(df)
    assert dict(c.dtypes)["createdAt"] == "timestamp" and c.first().updatedUtc is None
    assert field_mapping(df, {"id": "key", "nope": "x"}).columns == ["key"]
    a = add_audit_columns(df, "src", "src_1", dt.datetime(2024, 1, 1))
    assert a.first()._batch_id == "src_1"
    t = tag_from_source_name(df, r"20\d{2}", "_year", source=F.lit("Costs 2025 sheet"))
    assert t.first()._year == "2025"


def test_identifiers_and_predicates():
    assert validate_identifier("updated_at") == "updated_at"
    for bad in ["1x", "a;drop", "a b", ""]:
        with pytest.raises(ValueError):
            validate_identifier(bad)
    with pytest.raises(ValueError):
        validate_table_name("nodot")
    assert month_bounds("2026-02") == (dt.date(2026, 2, 1), dt.date(2026, 3, 1))
    assert month_bounds("2026-12") == (dt.date(2026, 12, 1), dt.date(2027, 1, 1))
    with pytest.raises(ValueError):
        source_predicate("x;1")


def test_jdbc_scan_with_pushdown(spark):
    url = "jdbc:derby:memory:lakeward_t1;create=true"
    rows = [(i, f"n{i}", dt.datetime(2026, 1 + i % 3, 5)) for i in range(30)]
    src = spark.createDataFrame(rows, "id int, name string, updated_at timestamp")
    src.write.format("jdbc").option("url", url).option("dbtable", "APP.ITEMS").mode("overwrite").save()
    df = scan_jdbc(spark, url, table="APP.ITEMS", partition_column="ID", lower=0, upper=30, num_partitions=3)
    df = df.toDF(*[c.lower() for c in df.columns])
    pred = source_predicate("updated_at", month="2026-02", last=dt.datetime(2026, 1, 1))
    got = df.filter(pred)
    assert got.count() == 10
    assert has_changed_watermark(df, "updated_at", dt.datetime(2026, 3, 1)) is True
    assert has_changed_watermark(df, "updated_at", dt.datetime(2026, 3, 6)) is False
    assert max_watermark(df, "updated_at").first()[0] == "2026-03-05 00:00:00.000000"


PAGE_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("meta", T.StructType([T.StructField("score", T.LongType())]))]))),
    T.StructField("hasMore", T.BooleanType()), T.StructField("scrollId", T.StringType())])


def test_flatten_pages_and_errors(spark):
    raw = [(1, '{"data": [{"id": 1, "meta": {"score": 5}}, {"id": 2}], "hasMore": true, "scrollId": "c1"}'),
           (2, '{"data": null, "hasMore": false, "scrollId": null}'),
           (3, '{"items": [], "hasMore": false}'),
           (4, '{"data": {"id": 9}, "hasMore": false}')]
    pages = spark.createDataFrame(raw, "page_no int, payload string")
    flat = flatten_pages(pages, "data", payload_schema=PAGE_SCHEMA)
    assert sorted(flat.columns) == ["id", "meta.score"]
    assert sorted(r.id for r in flat.collect()) == [1, 2]
    assert sorted(r.page_no for r in page_errors(pages, "data").collect()) == [3, 4]


def test_page_chain_violations(spark):
    meta = spark.createDataFrame([("s", 1, True, "c1"), ("s", 2, True, "c1"), ("s", 3, True, None),
                                  ("t", 1, True, "x"), ("u", 1, False, None)],
                                 "src string, p int, more boolean, cur string")
    got = {r.src: r for r in page_chain_check(meta, "src", "p", "more", "cur", max_pages=2).collect()}
    assert got["s"].repeated_cursor == 1 and got["s"].missing_cursor == 1 and got["s"].over_cap and not got["s"].ok
    assert got["t"].dangling_has_more == 1 and not got["t"].ok
    assert got["u"].ok


def test_month_partitions_and_all_or_nothing(spark):
    m = month_partitions(spark, dt.date(2026, 1, 17), dt.date(2026, 3, 2)).collect()
    assert [(r.month_from, r.month_to) for r in m] == [
        (dt.date(2026, 1, 1), dt.date(2026, 2, 1)), (dt.date(2026, 2, 1), dt.date(2026, 3, 1)),
        (dt.date(2026, 3, 1), dt.date(2026, 4, 1))]
    exp = month_partitions(spark, dt.date(2026, 1, 1), dt.date(2026, 2, 1))
    got = spark.createDataFrame([(dt.date(2026, 1, 1), 1)], "month_from date, x int")
    with pytest.raises(RuntimeError):
        all_or_nothing_union(exp, got, "month_from")


def test_fx_series_keeps_gaps(spark):
    p = spark.createDataFrame([("2026-01-01", json.dumps({"usd": {"vnd": 25000.0}})),
                               ("2026-01-03", json.dumps({"usd": {"eur": 0.9}})),
                               ("2026-01-04", json.dumps({"usd": {"vnd": 25100.0}}))], "day string, payload string")
    got = fx_daily_series(p, "day", "payload", "vnd", dt.date(2026, 1, 1), dt.date(2026, 1, 5)).orderBy("date")
    assert [(r.date.day, r.rate) for r in got.collect()] == [(1, 25000.0), (4, 25100.0)]


def test_grid_header_detection(spark):
    grid = spark.createDataFrame([
        ("a.xlsx", 0, ["Report", ""]), ("a.xlsx", 1, [" Code ", "Title", "Cost"]),
        ("a.xlsx", 2, ["S1", "Song"]), ("a.xlsx", 3, ["", "", ""]), ("a.xlsx", 4, ["S2", "B", "5", "x"]),
        ("b.xlsx", 0, ["no header here"])], "file string, row_no int, cells array<string>")
    t = grid_to_table(grid, ["code", "cost", "missing"], header_key="CODE")
    got = sorted((r.file, r.code, r.cost, r.missing) for r in t.collect())
    assert got == [("a.xlsx", "S1", "", ""), ("a.xlsx", "S2", "5", "")]


def test_checksums(spark, workdir):
    p = write(os.path.join(workdir, "c.txt"), "abc")
    r = file_checksums(spark, p).first()
    assert r.sha256 == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert table_fingerprint(a) == table_fingerprint(a.repartition(3).orderBy(F.desc("k")))
    assert table_fingerprint(a) != table_fingerprint(a.limit(1))


def test_file_tree_reads_changed_files_only(spark, workdir, monkeypatch):
    for f, text in (("a/1.csv", "x,1"), ("a/2.csv", ""), ("b/1.csv", "y,2")):
        os.makedirs(os.path.join(workdir, "in", os.path.dirname(f)), exist_ok=True)
        write(os.path.join(workdir, "in", f), text)
    src = os.path.join(workdir, "in")
    file_tree(spark, src).write.parquet(f"{workdir}/tree")
    known = spark.read.parquet(f"{workdir}/tree")
    assert known.count() == 2 and known.where("digest is null").count() == 0
    # what the known tree says of files with the same length and time is believed, so they are not read
    marked = known.withColumn("digest", F.concat(F.lit("kept "), "digest"))
    assert file_tree(spark, src, marked).where("digest like 'kept %'").count() == 2
    os.utime(os.path.join(src, "a/1.csv"), (1, 1))                # touched, the same bytes
    touched = file_tree(spark, src, known)
    assert tree_digest(touched) == tree_digest(known)
    assert file_tree(spark, src, marked).where("digest like 'kept %'").count() == 1
    write(os.path.join(src, "b/1.csv"), "y,3")
    os.utime(os.path.join(src, "b/1.csv"), (2, 2))                # the same length
    tree = file_tree(spark, src, known)
    assert tree_digest(tree) != tree_digest(known)
    got = {r.folder.rsplit("/", 1)[1]: r.change for r in changed_folders(tree, known).collect()}
    assert got == {"a": "unchanged", "b": "changed"}
    monkeypatch.setattr("lakeward.sources.checksum.WHOLE_BYTES", 2)    # files above it: by their lines
    lines = file_tree(spark, src)
    assert lines.where("digest is null").count() == 0
    assert sorted(r.change for r in changed_folders(lines, file_tree(spark, src)).collect()) == ["unchanged"] * 2


def test_unchanged_files_are_skipped_without_their_rows(spark, workdir):
    import datetime as dt

    from lakeward.sources.control import SourceSpec, run_extract, run_load
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    write(os.path.join(src, "1.csv"), "1")
    reads = []
    spec = SourceSpec("s", "csv", "stg.s", options={"files": src})

    def read(last):
        seen = F.udf(lambda v: open(os.path.join(workdir, "rows"), "a").write("r") and v)
        reads.append(last)
        return spark.read.schema("v string").csv(src).withColumn("v", seen("v"))
    size = lambda: os.path.getsize(os.path.join(workdir, "rows"))
    run_load(spark, spec, run_extract(spark, spec, read, workdir, now=dt.datetime(2026, 1, 1)), workdir)
    before = size()
    assert run_extract(spark, spec, read, workdir, now=dt.datetime(2026, 1, 2)) is None
    assert size() == before and len(reads) == 2
    write(os.path.join(src, "1.csv"), "2")
    os.utime(os.path.join(src, "1.csv"), (5, 5))
    assert run_extract(spark, spec, read, workdir, now=dt.datetime(2026, 1, 3)).rows == 1
