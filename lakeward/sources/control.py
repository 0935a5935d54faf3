"""Run control: extract / load / retry / rollback (RUN-1..4).

The decisions are made on the driver from one-row aggregates (checksum,
watermark, counts); data moves only between executors and storage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.sources.jdbc import has_changed_watermark
from lakeward.sources.landing import add_audit_columns
from lakeward.sources.ledger import Ledger, get_batch, last_success, rollback_target
from lakeward.sources.checksum import file_tree, table_fingerprint, tree_digest
from lakeward.sources.store import TableStore, new_batch_id, path_exists, read_bronze, write_bronze


@dataclass(frozen=True)
class SourceSpec:
    source_id: str
    source_type: str                      # csv | sheet | database | search | api | fx
    target_table: str                     # schema.table
    load_mode: str = "truncate"           # truncate | append | upsert
    upsert_key: tuple[str, ...] = ()
    incremental: bool = False
    watermark_column: str | None = None
    connection: str | None = None
    options: dict = field(default_factory=dict)


@dataclass
class Batch:
    batch_id: str
    path: str
    rows: int
    mode: str


def _wm_text(df: DataFrame, col: str | None) -> str | None:
    if not col or col not in df.columns:
        return None
    v = df.agg(F.max(F.col(col)).cast("string")).first()[0]
    return v


def _tree_path(root: str, source_id: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/_trees/source_id={source_id}/batch_id={batch_id}"


def _file_tree(spark: SparkSession, folder: str, root: str, source_id: str, last_batch: str | None) -> DataFrame:
    """The files' hash tree, by way of the one kept with the last batch, if there is one."""
    path = _tree_path(root, source_id, last_batch or "")
    known = spark.read.parquet(path) if last_batch and path_exists(spark, path) else None
    return file_tree(spark, folder, known)


def run_extract(spark: SparkSession, spec: SourceSpec, read: Callable[[object], DataFrame], root: str,
                force: bool = False, now: dt.datetime | None = None) -> Batch | None:
    """RUN-1.  ``read(last_watermark)`` returns the source rows newer than the
    watermark (all rows when None).  Change detection: content checksum for
    file-like sources, the watermark otherwise (checksum when there is none);
    ``force`` bypasses both.  With the option ``files``, the folder that ``read``
    reads, the checksum is that of a hash tree kept beside the ledger: only files of
    another length or time are read, and rows of an unchanged source never.  A changed file-like source with no newer rows
    means old rows were edited: re-extract the full snapshot and load it in
    truncate mode.  Zero rows -> skip.  Writes bronze, then the ledger row."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    ledger = Ledger(spark, root)
    prev = last_success(ledger.current(), spec.source_id).first()
    last_wm = prev["watermark_value"] if prev else None
    mode = spec.load_mode
    file_like = spec.source_type in ("csv", "sheet")
    full = read(None)
    by_content = file_like or not spec.watermark_column
    folder = spec.options.get("files") if by_content else None
    tree = _file_tree(spark, folder, root, spec.source_id, prev["batch_id"] if prev else None) if folder else None
    # only sources without a usable watermark are read for their content
    checksum = (tree_digest(tree) if folder else table_fingerprint(full)) if by_content else None
    if not force:
        if by_content:
            if prev is not None and prev["checksum"] == checksum:
                return None
        elif not has_changed_watermark(full, spec.watermark_column, last_wm, spec.incremental):
            return None
    newer = spec.incremental and spec.watermark_column and last_wm and not force
    data = read(last_wm) if newer else full
    if newer and file_like and data.limit(1).isEmpty():
        data, mode = full, "truncate"
    batch_id = new_batch_id(spec.source_id, now)
    staged = add_audit_columns(data, spec.source_id, batch_id, now, connection=spec.connection)
    if staged.limit(1).isEmpty():
        return None
    path = write_bronze(staged, root, spec.source_id, batch_id)
    landed = read_bronze(spark, path)
    rows = landed.count()
    if folder:
        tree.write.mode("overwrite").parquet(_tree_path(root, spec.source_id, batch_id))
    # the watermark of what has landed: rows that came in since stay for the next run
    ledger.register_extracted(spec.source_id, spec.source_type, batch_id, path, checksum,
                              _wm_text(landed, spec.watermark_column) or last_wm, rows, now, spec.connection)
    return Batch(batch_id, path, rows, mode)


def run_load(spark: SparkSession, spec: SourceSpec, batch: Batch, root: str, mode: str | None = None) -> int:
    """RUN-2: bronze -> staging; ledger ``loaded``, or ``failed`` and re-raise."""
    ledger = Ledger(spark, root)
    state = get_batch(ledger.current(), batch.batch_id).first()
    record = state.asDict() if state else {"source_id": spec.source_id, "batch_id": batch.batch_id}
    try:
        n = TableStore(spark, root).load(read_bronze(spark, batch.path), spec.target_table,
                                          mode or batch.mode or spec.load_mode, spec.upsert_key, batch.batch_id)
    except Exception as e:
        ledger.mark(record, "failed", error=str(e))
        raise
    ledger.mark(record, "loaded", loaded_at=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    return n


def retry_batch(spark: SparkSession, spec: SourceSpec, batch_id: str, root: str) -> int:
    """RUN-3: reload a known batch from bronze; it must belong to the source."""
    row = get_batch(Ledger(spark, root).current(), batch_id).first()
    if row is None:
        raise KeyError(f"unknown batch {batch_id}")
    if row["source_id"] != spec.source_id:
        raise ValueError(f"batch {batch_id} belongs to {row['source_id']}, not {spec.source_id}")
    return run_load(spark, spec, Batch(batch_id, row["minio_path"], row["row_count"] or 0, spec.load_mode), root)


def rollback_source(spark: SparkSession, spec: SourceSpec, day: dt.date, root: str) -> int | None:
    """RUN-4: reload the newest batch loaded on or before ``day`` in truncate
    mode; None (and nothing changed) when there is no such batch.  The batches
    loaded after it get a ``rolled_back`` event."""
    ledger = Ledger(spark, root)
    state = ledger.current()
    row = rollback_target(state, day, spec.source_id).first()
    if row is None:
        return None
    n = TableStore(spark, root).load_truncate(read_bronze(spark, row["minio_path"]), spec.target_table,
                                              row["batch_id"], forget=True)
    later = state.where((F.col("source_id") == spec.source_id) & (F.col("status") == "loaded")
                        & (F.struct("extracted_at", "batch_id") > F.struct(
                            F.lit(row["extracted_at"]).cast("timestamp_ntz"), F.lit(row["batch_id"]))))
    ledger.append_all(later.withColumns({
        "status": F.lit("rolled_back"), "error_message": F.lit(None).cast("string"),
        "event_at": F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")}))
    return n
