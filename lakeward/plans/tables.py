"""Reading the driver tables (one Parquet file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeward.session import SPREAD_SCANS, balanced_scan

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return balanced_scan(df) if spark.conf.get(SPREAD_SCANS, "false") == "true" else df


class Tables:
    """Attribute access to the driver tables: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:      # one Parquet footer read per table
            self._read[name] = table(self._spark, self._dir, name)
        return self._read[name]
