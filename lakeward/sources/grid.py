"""Spreadsheet grids landed as (file, row_no, cells) rows (SRC-15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.operators.joins import join_aggregated


def grid_to_table(grid: DataFrame, columns: Sequence[str], header_key: str | None = None,
                  header_row: int | None = None, file: str = "file", row_no: str = "row_no",
                  cells: str = "cells") -> DataFrame:
    """Per file: find the header (fixed ``header_row`` or the first row having
    a cell equal to ``header_key``, case-insensitive, trimmed); files without a
    header are skipped.  Wanted ``columns`` are matched case-insensitively;
    absent ones become ''.  Ragged rows are padded with ''; all-blank rows
    are dropped.  Output columns keep the requested names plus ``file``.

    One aggregate finds the headers with their cells, one row a file; a file may
    hold any share of the rows, as these are split."""
    norm = F.transform(F.col(cells), lambda x: F.lower(F.trim(F.coalesce(x, F.lit("")))))
    if header_row is not None:
        heads = F.col(row_no) == F.lit(header_row)
    else:
        heads = F.array_contains(norm, header_key.strip().lower())
    hdr = (grid.filter(heads).groupBy(file)
           .agg(F.min(F.struct(F.col(row_no).alias("row"), norm.alias("names"))).alias("__h"))
           .select(file, F.col("__h.row").alias("__hrow"), F.col("__h.names").alias("__hdr")))
    body = join_aggregated(grid.select(file, row_no, cells), hdr, [(file, file)], "inner")
    body = body.filter(F.col(row_no) > F.col("__hrow"))
    out = [F.col(file)]
    for c in columns:
        idx = F.array_position("__hdr", c.strip().lower())
        val = F.when(idx > 0, F.coalesce(F.try_element_at(F.col(cells), idx.cast("int")), F.lit(""))) \
               .otherwise(F.lit(""))
        out.append(F.trim(val).alias(c))
    nonblank = F.exists(F.col(cells), lambda x: F.trim(F.coalesce(x, F.lit(""))) != "")
    return body.filter(nonblank).select(*out)
