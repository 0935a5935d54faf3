"""Paged JSON payloads, search hits, month ranges and FX series landed as
files (SRC-8..12, SRC-14).  The network clients are out of scope; these verbs
work on what was landed, one payload per row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_landed_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One JSON document per file (``multiLine``)."""
    r = spark.read.option("multiLine", "true")
    return (r.schema(schema) if schema is not None else r).json(path)


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct columns -> dotted top-level columns, recursively."""
    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(f.dataType, path + [f.name])
        else:
            expr = F.col(".".join(f"`{p}`" for p in path))
            yield expr.alias(sep.join(path))
    cols = []
    for f in df.schema.fields:
        cols.extend(walk(f.dataType, [f.name]))
    return df.select(*cols)


def flatten_pages(pages: DataFrame, data_key: str | None, payload: str = "payload",
                  payload_schema: T.DataType | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC-8: page payload -> rows.  ``data_key`` names the list inside an
    object payload; ``None`` means the payload is the list itself.  A null
    list yields no rows; a payload lacking the key is an error (reported by
    :func:`page_errors`).  Nested objects are flattened to dotted columns;
    ``keep`` columns of the page row are carried along."""
    doc = F.from_json(F.col(payload), payload_schema) if payload_schema is not None else F.col(payload)
    items = doc if data_key is None else doc.getField(data_key)
    rows = pages.select(*keep, F.explode(items).alias("__item")).select(*keep, "__item.*")
    return flatten_struct(rows)


def page_errors(pages: DataFrame, data_key: str, raw_payload: str = "payload") -> DataFrame:
    """Pages whose object payload lacks ``data_key`` or holds a non-list there."""
    kind = F.expr(f"json_object_keys({raw_payload})")
    has = F.array_contains(kind, data_key)
    val = F.get_json_object(F.col(raw_payload), f"$.{data_key}")
    bad = (~F.coalesce(has, F.lit(False))) | (val.isNotNull() & ~F.startswith(F.ltrim(val), F.lit("[")))
    return pages.filter(bad)


def page_chain_check(pages: DataFrame, source: str, page_no: str, has_more: str, cursor: str,
                     max_pages: int) -> DataFrame:
    """SRC-9: cursor-protocol violations per source: a page that says more
    pages follow but carries no (or an empty) cursor, a cursor seen twice,
    too many pages, a last page that says more follow, gaps or repeats in the
    page numbers.  One row per source with counts and ``ok``, from one
    aggregate that keeps no page list."""
    missing_cursor = F.col(has_more) & (F.col(cursor).isNull() | (F.trim(F.col(cursor)) == ""))
    span = F.max(page_no) - F.min(page_no) + 1
    agg = pages.groupBy(source).agg(
        F.count(F.lit(1)).alias("pages"),
        F.count(F.when(missing_cursor, 1)).alias("missing_cursor"),
        (F.count(F.col(cursor)) - F.count_distinct(F.col(cursor))).alias("repeated_cursor"),
        F.when(F.max_by(has_more, page_no), 1).otherwise(0).cast("long").alias("dangling_has_more"),
        F.abs(span - F.count(F.lit(1))).cast("long").alias("page_gaps"),
    )
    return agg.withColumn("over_cap", F.col("pages") > F.lit(max_pages)).withColumn(
        "ok", (F.col("missing_cursor") == 0) & (F.col("repeated_cursor") == 0)
        & (F.col("dangling_has_more") == 0) & (F.col("page_gaps") == 0) & ~F.col("over_cap"))


def month_partitions(spark: SparkSession, start: dt.date | Column, as_of: dt.date | Column) -> DataFrame:
    """SRC-10: half-open month ranges [from, to) from the start month (snapped
    to day 1) through the month of ``as_of``; none if that is earlier."""
    s = start if isinstance(start, Column) else F.lit(start)
    e = as_of if isinstance(as_of, Column) else F.lit(as_of)
    first, last = F.trunc(s.cast("date"), "MM"), F.trunc(e.cast("date"), "MM")
    seq = F.when(first <= last, F.sequence(first, F.greatest(first, last), F.expr("interval 1 month")))
    return (spark.range(1).select(F.explode(seq).alias("month_from"))
            .withColumn("month_to", F.add_months("month_from", 1)))


def all_or_nothing_union(expected: DataFrame, received: DataFrame, part_col: str) -> DataFrame:
    """SRC-11: publish the concatenation only when every expected part
    arrived; otherwise raise, naming the missing parts (checked with a capped
    anti join on the driver - only the missing keys are fetched, at most 20)."""
    missing = expected.select(part_col).join(received.select(part_col).distinct(), part_col, "left_anti")
    miss = [r[0] for r in missing.limit(20).collect()]
    if miss:
        raise RuntimeError(f"parts missing, batch rejected: {miss}")
    return received


def flatten_search_hits(hits: DataFrame, hit: str = "hit", date_field: str | None = None,
                        date_from: object = None) -> DataFrame:
    """SRC-12: ``_source.*`` plus ``_es_id``; optional ``date_field >= from``."""
    out = hits.select(F.col(f"{hit}._id").alias("_es_id"), f"{hit}._source.*")
    if date_field and date_from is not None:
        out = out.filter(F.col(date_field) >= F.lit(date_from))
    return out


def fx_daily_series(payloads: DataFrame, day: str, payload: str, currency: str,
                    start: dt.date, as_of: dt.date, base: str = "usd") -> DataFrame:
    """SRC-14: one row per day start..as_of that has a payload with the
    currency; missing or failed days stay missing (inner join to the calendar)."""
    m = F.from_json(F.get_json_object(F.col(payload), f"$.{base}"), T.MapType(T.StringType(), T.DoubleType()))
    rates = payloads.select(F.col(day).cast("date").alias("date"),
                            F.element_at(m, F.lit(currency)).alias("rate")).filter(F.col("rate").isNotNull())
    cal = payloads.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(max(start, as_of)))).alias("date")).where(F.col("date") <= F.lit(as_of))
    # of several rates for a day the largest counts
    return cal.join(rates.groupBy("date").agg(F.max("rate").alias("rate")), "date", "inner")
