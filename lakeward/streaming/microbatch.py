"""SNK-7: chunked loading re-expressed as Structured Streaming.

New files under a landing folder are picked up by ``readStream``; each
micro-batch is stamped with audit columns and loaded with the table store.
The streaming checkpoint (in the session's shared checkpoint folder) replaces
the source system's running watermark: a restarted query resumes after the
last committed batch.  The commit that applies a batch carries the ledger event
that goes with it; an epoch replayed after a crash finds the commit, loads
nothing again and writes the event if the ledger lacks it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeward.session import ensure_checkpoint_dir
from lakeward.sources.landing import add_audit_columns
from lakeward.sources.ledger import Ledger
from lakeward.sources.store import TableStore, path_exists, read_bronze


def microbatch_load(spark: SparkSession, landing_dir: str, schema: T.StructType, root: str, table: str,
                    source_id: str, fmt: str = "parquet", mode: str = "append", keys: Sequence[str] = (),
                    checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                    ledger: bool = True, options: dict | None = None, wait: bool = True) -> StreamingQuery:
    """Load every file landed so far (``availableNow``) in micro-batches.

    Each epoch's rows land in a bronze folder of their own with their audit
    columns, and are loaded from there, so that a rollback or retry of a batch
    finds exactly its rows.  The first batch replaces the table when it does not exist yet (truncate),
    later batches append (or upsert on ``keys`` when ``mode='upsert'``)."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{source_id}"
    reader = spark.readStream.schema(schema).format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_dir)
    store = TableStore(spark, root)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        batch_id = f"{source_id}_epoch_{epoch_id:010d}"
        path = f"{root.rstrip('/')}/bronze/source_id={source_id}/batch_id={batch_id}"
        done = store.applied(table, batch_id)
        if done is None:
            if not path_exists(spark, f"{path}/_SUCCESS"):
                add_audit_columns(batch, source_id, batch_id, now).write.mode("overwrite").parquet(path)
            staged = read_bronze(spark, path)
            # the ledger's event is in the commit itself: whoever finds the batch applied can complete the ledger
            event = {"source_id": source_id, "source_type": "stream", "batch_id": batch_id, "minio_path": path,
                     "row_count": staged.count(), "status": "loaded", "extracted_at": now.isoformat(), "loaded_at": now.isoformat()}
            store.load(staged, table, mode if store.exists(table) or mode == "upsert" else "truncate", keys, batch_id, event)
            done = {"event": event}
        if ledger and done["event"]:
            book = Ledger(spark, root)
            if book.events().where((F.col("batch_id") == batch_id) & (F.col("status") == "loaded")).isEmpty():
                times = {k: dt.datetime.fromisoformat(done["event"][k]) for k in ("extracted_at", "loaded_at")}
                book.append(**done["event"] | times)

    q = (stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q
