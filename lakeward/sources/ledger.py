"""Batch ledger as an append-only Parquet event table (REG-1..5).

Each status change is one appended event row; the current state of a batch
is its newest event.  Lookups are aggregates (``max_by``) over the events, so
the driver only ever receives single rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.sources.store import path_exists

LEDGER_SCHEMA = T.StructType([
    T.StructField("source_id", T.StringType()), T.StructField("source_type", T.StringType()),
    T.StructField("connection_name", T.StringType()), T.StructField("batch_id", T.StringType()),
    T.StructField("minio_path", T.StringType()), T.StructField("checksum", T.StringType()),
    T.StructField("watermark_value", T.StringType()), T.StructField("row_count", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("extracted_at", T.TimestampNTZType()),
    T.StructField("loaded_at", T.TimestampNTZType()), T.StructField("error_message", T.StringType()),
    T.StructField("event_at", T.TimestampNTZType()),
])
STATUSES = ("pending", "extracted", "loaded", "failed", "rolled_back")
MAX_ERROR_CHARS = 2000


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/_ledger"

    def events(self) -> DataFrame:
        """All events; none before the first is written.  A ledger that is there
        but cannot be read is an error, not an empty one."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    # REG-1
    def append(self, **event) -> None:
        if event.get("status") not in STATUSES:
            raise ValueError(f"bad status {event.get('status')!r}")
        if event.get("error_message"):
            event["error_message"] = str(event["error_message"])[:MAX_ERROR_CHARS]
        event.setdefault("event_at", dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        row = tuple(event.get(f.name) for f in LEDGER_SCHEMA.fields)
        self.spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def append_all(self, events: DataFrame) -> None:
        """Append many events at once (REG-1)."""
        events.select(*LEDGER_SCHEMA.names).write.mode("append").parquet(self.path)

    def register_extracted(self, source_id, source_type, batch_id, path, checksum, watermark, rows,
                           extracted_at, connection=None):
        self.append(source_id=source_id, source_type=source_type, connection_name=connection,
                    batch_id=batch_id, minio_path=path, checksum=checksum, watermark_value=watermark,
                    row_count=rows, status="extracted", extracted_at=extracted_at)

    def mark(self, batch: dict, status: str, error: str | None = None, loaded_at=None):
        b = dict(batch)
        b.update(status=status, error_message=error, event_at=None,
                 loaded_at=loaded_at if status == "loaded" else b.get("loaded_at"))
        self.append(**{k: v for k, v in b.items() if v is not None or k in ("error_message",)})

    def current(self) -> DataFrame:
        return current_state(self.events())


def current_state(events: DataFrame) -> DataFrame:
    """Newest event per batch (partial aggregate, no window over a batch)."""
    cols = [c for c in events.columns if c != "batch_id"]
    best = events.groupBy("batch_id").agg(
        F.max_by(F.struct(*cols), F.struct("event_at", "status")).alias("__e"))
    return best.select("batch_id", "__e.*").select(*events.columns)


def last_success(state: DataFrame, source_id: str | None = None) -> DataFrame:
    """REG-2: newest ``loaded`` batch per source by ``extracted_at`` (ties:
    larger batch id)."""
    s = state.filter(F.col("status") == "loaded")
    if source_id is not None:
        s = s.filter(F.col("source_id") == source_id)
    cols = [c for c in s.columns if c != "source_id"]
    return (s.groupBy("source_id").agg(F.max_by(F.struct(*cols), F.struct("extracted_at", "batch_id")).alias("__b"))
            .select("source_id", "__b.*"))


def get_batch(state: DataFrame, batch_id: str) -> DataFrame:
    """REG-3."""
    return state.filter(F.col("batch_id") == batch_id).limit(1)


def rollback_target(state: DataFrame, day: dt.date | str, source_id: str | None = None) -> DataFrame:
    """REG-4: newest loaded batch per source with ``date(extracted_at) <= day``."""
    d = F.lit(day if isinstance(day, dt.date) else dt.date.fromisoformat(day))
    return last_success(state.filter(F.col("extracted_at").cast("date") <= d), source_id)


def history(state: DataFrame, source_id: str, limit: int = 20) -> DataFrame:
    """REG-5: the ``limit`` newest batches of a source (TakeOrdered)."""
    return (state.filter(F.col("source_id") == source_id)
            .orderBy(F.col("extracted_at").desc_nulls_last(), F.col("batch_id").desc()).limit(limit))
