"""Scans of landed files and column hygiene (SRC-1, 2, 13, 16-20)."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OVERFLOW_COL = "__overflow"


def sanitize_names(names: Sequence[str]) -> list[str]:
    """SRC-18: newline -> space, trim, blank -> ``col_<i>``, repeated names ->
    ``name_1``, ``name_2`` ... (first occurrence keeps its name)."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for i, n in enumerate(names):
        s = (n or "").replace("\r\n", " ").replace("\n", " ").replace("\r", " ").strip()
        if not s:
            s = f"col_{i}"
        if s in seen:
            seen[s] += 1
            s = f"{s}_{seen[s]}"
        else:
            seen[s] = 0
        out.append(s)
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitize_names(df.columns))


def scan_csv(spark: SparkSession, path: str, sep: str = ",", quote: str = '"',
             encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """SRC-1: all columns as text, header trimmed/sanitised, quoted separators
    honoured, doubled quotes read as one, short rows null-padded, rows with *more* fields than the header
    dropped (read with one extra overflow column, keep rows where it is null).
    ``multi_line`` reads quoted line breaks as part of a field; a file is then
    one task, so set it only for sources that need it."""
    def reader():
        return (spark.read.option("sep", sep).option("quote", quote).option("escape", quote)
                .option("encoding", encoding).option("multiLine", multi_line))
    header = reader().csv(path).limit(1).collect()
    if not header:
        return spark.createDataFrame([], T.StructType([]))
    names = sanitize_names([c if c is not None else "" for c in header[0]])
    schema = T.StructType([T.StructField(f"__c{i}", T.StringType()) for i in range(len(names))]
                          + [T.StructField(OVERFLOW_COL, T.StringType())])
    raw = (reader().option("header", "true").option("mode", "PERMISSIVE").schema(schema).csv(path))
    return (raw.filter(F.col(OVERFLOW_COL).isNull()).drop(OVERFLOW_COL)
            .toDF(*names))


def watermark_value(c: str) -> F.Column:
    """Coerced watermark: text -> timestamp, unparseable -> null."""
    return F.try_to_timestamp(F.col(f"`{c}`").cast("string"))


def scan_csv_incremental(df: DataFrame, wm_col: str, last: str | dt.datetime | None
                         ) -> tuple[DataFrame, DataFrame]:
    """SRC-2: rows with watermark > ``last`` (all rows when ``last`` is None),
    plus a one-row frame holding the new watermark = max over the *whole*
    input, before filtering.  Missing column -> error."""
    if wm_col not in df.columns:
        raise KeyError(f"watermark column {wm_col!r} not in source")
    # a typed column is compared as it is, so that the filter reaches the scan
    typed = isinstance(df.schema[wm_col].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
    wm = F.col(f"`{wm_col}`") if typed else watermark_value(wm_col)
    if last is None:
        delta = df
    elif typed:
        delta = df.filter(wm > F.lit(str(last)).cast(df.schema[wm_col].dataType))
    else:
        lit = F.lit(last if isinstance(last, dt.datetime) else str(last))
        delta = df.filter(wm > F.try_to_timestamp(lit.cast("string")))
    new_wm = df.agg(F.max(wm).alias("watermark_value"))
    return delta, new_wm


def field_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """SRC-17: keep only mapped columns that are present, renamed."""
    present = [(s, t) for s, t in mapping.items() if s in df.columns]
    return df.select(*[F.col(f"`{s}`").alias(t) for s, t in present])


def nested_to_json(df: DataFrame) -> DataFrame:
    """SRC-19: struct / array / map columns -> JSON text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# Name suffixes marking time columns in search documents.
TIME_SUFFIXES = ("At", "Date", "Time", "Utc", "UTC")


def coerce_time_suffix(df: DataFrame, suffixes: Sequence[str] = TIME_SUFFIXES) -> DataFrame:
    """SRC-13: columns whose name ends with a time suffix -> timestamp (bad -> null)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if any(f.name.endswith(s) for s in suffixes) and isinstance(f.dataType, T.StringType):
            c = F.try_to_timestamp(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def tag_from_source_name(df: DataFrame, pattern: str, out: str, group: int = 0,
                         source: F.Column | None = None) -> DataFrame:
    """SRC-16: value extracted from the landed file name (``_metadata``) or a
    given source-name column, e.g. the year ``20\\d{2}`` of a sheet title or
    the file stem as repository name."""
    src = source if source is not None else F.col("_metadata.file_name")
    return df.withColumn(out, F.nullif(F.regexp_extract(src, pattern, group), F.lit("")))


def file_stem(path_col: F.Column) -> F.Column:
    return F.regexp_extract(path_col, r"([^/]+?)(\.[^./]*)?$", 1)


def add_audit_columns(df: DataFrame, source_id: str, batch_id: str, loaded_at: dt.datetime,
                      connection: str | None = None, sheet: str | None = None) -> DataFrame:
    """SRC-20: one fixed literal per batch (never ``current_timestamp`` per row)."""
    cols = {"_source_id": F.lit(source_id), "_batch_id": F.lit(batch_id),
            "_loaded_at": F.lit(loaded_at).cast("timestamp_ntz")}
    if connection is not None:
        cols["_source_connection"] = F.lit(connection)
    if sheet is not None:
        cols["_source_sheet"] = F.lit(sheet)
    return df.withColumns(cols)


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def validate_identifier(name: str) -> str:
    """Configured identifiers must look like ``[A-Za-z_][A-Za-z0-9_]*``."""
    if not _IDENT.match(name or ""):
        raise ValueError(f"invalid identifier: {name!r}")
    return name


def validate_table_name(name: str) -> tuple[str, str]:
    """``schema.table`` with both parts valid identifiers."""
    parts = (name or "").split(".")
    if len(parts) != 2:
        raise ValueError(f"table name must be schema.table: {name!r}")
    return validate_identifier(parts[0]), validate_identifier(parts[1])
