"""Helpers shared by the operators: reading tables and cutting lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from lakeward.plans.tables import table
from lakeward.session import ensure_checkpoint_dir

#: ASCII white space, as the queries' contracts split words.
SPACES = r"[\x20\x09-\x0D]+"


#: A table below a folder: ``read(spark, folder, name)``.
read = table


def cut(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the session's checkpoint folder and read it
    back.  Later jobs start from the files, which every executor can read, so a
    lost executor costs no more than its own tasks; the file sizes also give the
    planner true statistics for its join choices."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, df: DataFrame) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
