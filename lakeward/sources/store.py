"""Bronze batches and staging tables on plain Parquet (SNK-1..6).

Without a table format, a staging table is a log of numbered *commits* over
immutable Parquet directories.  Every load writes new data files first and then
adds the next commit in one rename: the files it adds and takes away, the batch
and, if there is one, the ledger event that belongs to it.  A commit holds what
changed only; when as many have been added as the table has parts, a snapshot
beside the last one sums them up, so that a batch costs the same however many
came before.  Nothing is ever deleted or overwritten on the way, so a crash at
any point leaves readers on the old version.  One writer per table is assumed,
as in the source system; a second one that publishes the same number fails.

An upsert deals its table to buckets by key hash and writes only the buckets
that the batch touches."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.sources.landing import validate_table_name

LOAD_MODES = ("truncate", "append", "upsert")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file atomically: temp file, then rename.  Fails if
    the file is already there."""
    fs, p, jvm = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(path + f".tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.exists(p) or not fs.rename(tmp, p):
        fs.delete(tmp, False)
        raise OSError(f"could not publish {path}")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def _names(spark: SparkSession, folder: str) -> list[str]:
    """File names in a folder, in order; none if it is not there."""
    fs, p, _ = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    lines = []
    line = reader.readLine()
    while line is not None:
        lines.append(line)
        line = reader.readLine()
    reader.close()
    return "\n".join(lines)


def new_batch_id(source_id: str, at: dt.datetime) -> str:
    """``<source>_<UTC yyyymmdd_HHMMSS_micros>``."""
    return f"{source_id}_{at.strftime('%Y%m%d_%H%M%S_%f')}"


def write_bronze(df: DataFrame, root: str, source_id: str, batch_id: str) -> str:
    """SNK-1: one immutable Parquet directory per batch; refuses to overwrite."""
    path = f"{root.rstrip('/')}/bronze/source_id={source_id}/batch_id={batch_id}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """SNK-2: read one landed batch back, without touching the source."""
    return spark.read.parquet(path)


#: Commits after which a snapshot is written at the earliest.
SNAPSHOT_AFTER = 32
BUCKET = "__bucket"


class TableStore:
    """Staging/silver tables under ``root/<schema>/<table>/``; ``buckets`` is what
    a table is dealt to at its first upsert."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _dir(self, table: str) -> str:
        schema, name = validate_table_name(table)
        return f"{self.root}/{schema}/{name}"

    def manifest(self, table: str) -> dict | None:
        """The table as it is: ``version``, ``schema``, ``rows``, ``parts`` (path ->
        bucket, or null), ``keys`` and ``n`` of the buckets, ``generation``, and
        ``recent``, the commits since the last snapshot."""
        folder = f"{self._dir(table)}/_manifests"
        names = _names(self.spark, folder)
        commits = [n for n in names if n.endswith(".json")]
        if not commits:
            return None
        summed = [n for n in names if n.endswith(".snapshot")]
        state = {"version": 0, "parts": {}, "rows": 0, "keys": None, "n": None, "generation": 0}
        if summed:
            state = json.loads(_read_text(self.spark, f"{folder}/{summed[-1]}"))
        state["recent"] = []
        for name in commits[state["version"]:]:
            c = json.loads(_read_text(self.spark, f"{folder}/{name}"))
            for path in (list(state["parts"]) if c["drop"] is None else c["drop"]):
                del state["parts"][path]
            state["parts"].update(c["add"])
            state.update({k: c[k] for k in ("version", "schema", "rows", "keys", "n", "generation")})
            state["recent"].append(c)
        return state

    def exists(self, table: str) -> bool:
        return self.manifest(table) is not None

    def _read_parts(self, m: dict, paths: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, table: str) -> DataFrame:
        m = self.manifest(table)
        if m is None:
            raise KeyError(f"table {table} does not exist")
        return self._read_parts(m, list(m["parts"]))

    def _write_files(self, df: DataFrame, table: str, by: Sequence[str] = ()) -> str:
        path = f"{self._dir(table)}/data/{uuid.uuid4().hex}"
        df.write.mode("errorifexists").partitionBy(*by).parquet(path)
        return path

    def _publish(self, table: str, old: dict | None, add: dict, drop: Sequence[str] | None, schema: str, rows: int,
                 batch_id: str | None, event: dict | None = None, keys: Sequence[str] | None = None, n: int | None = None,
                 forget: bool = False) -> None:
        """Add the next commit; ``drop`` None takes all older parts away, and
        ``forget`` what batches were applied."""
        version, generation = (old["version"], old["generation"]) if old else (0, 0)
        commit = {"version": version + 1, "add": add, "drop": drop, "schema": schema, "rows": rows, "batch_id": batch_id,
                  "event": event, "keys": list(keys) if keys else None, "n": n, "generation": generation + bool(forget)}
        folder = f"{self._dir(table)}/_manifests"
        _write_text(self.spark, f"{folder}/{version + 1:020d}.json", json.dumps(commit))
        self._mark(table, commit)
        parts = len(old["parts"]) if old else 0
        if old and len(old["recent"]) + 1 >= max(SNAPSHOT_AFTER, parts):
            self._sum_up(table)

    def _sum_up(self, table: str) -> None:
        """Write a snapshot of the table as it is; commits and marks stay."""
        m = self.manifest(table)
        for c in m.pop("recent"):
            self._mark(table, c)            # one that a crash has left out
        path = f"{self._dir(table)}/_manifests/{m['version']:020d}.snapshot"
        if not path_exists(self.spark, path):
            _write_text(self.spark, path, json.dumps(m))

    def _marker(self, table: str, generation: int, batch_id: str) -> str:
        return f"{self._dir(table)}/_batches/{generation}/{quote(batch_id, safe='')}"

    def _mark(self, table: str, commit: dict) -> None:
        """Note an applied batch under its name, for loads long after."""
        if commit["batch_id"]:
            path = self._marker(table, commit["generation"], commit["batch_id"])
            if not path_exists(self.spark, path):
                _write_text(self.spark, path, json.dumps({k: commit[k] for k in ("version", "batch_id", "event")}))

    def applied(self, table: str, batch_id: str | None) -> dict | None:
        """The commit (``version``, ``batch_id``, ``event``) that applied a batch, in
        whatever mode; None if it is not in the table, or was rolled back."""
        m = self.manifest(table) if batch_id else None
        if m is None:
            return None
        for c in reversed(m["recent"]):
            if c["batch_id"] == batch_id and c["generation"] == m["generation"]:
                return c
        text = _read_text(self.spark, self._marker(table, m["generation"], batch_id))
        return json.loads(text) if text else None

    def _schema(self, table: str) -> T.StructType | None:
        m = self.manifest(table)
        return T.StructType.fromJson(json.loads(m["schema"])) if m else None

    def _conform(self, df: DataFrame, table: str, absent_as_null: bool = True) -> DataFrame:
        """The batch in the table's columns and types: absent columns become
        typed nulls, other types are cast (a value that does not fit fails the
        load), unknown columns are an error.  A new table takes the batch as it is."""
        schema = self._schema(table)
        if schema is None:
            return df
        extra = [c for c in df.columns if c not in schema.names]
        if extra:
            raise ValueError(f"columns not in {table}: {extra}")
        cols = []
        for f in schema.fields:
            if f.name not in df.columns:
                if absent_as_null:
                    cols.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            c = F.col(f"`{f.name}`")
            if df.schema[f.name].dataType == f.dataType:
                cols.append(c)
                continue
            fitted = c.try_cast(f.dataType)
            misfit = F.raise_error(F.concat(F.lit(f"value of {table}.{f.name} is no {f.dataType.simpleString()}: "),
                                            c.cast("string")))
            cols.append(F.when(c.isNotNull() & fitted.isNull(), misfit).otherwise(fitted).alias(f.name))
        return df.select(*cols)

    def _count_while_writing(self, df: DataFrame, table: str, by: Sequence[str] = ()) -> tuple[str, int]:
        """Write the files and count rows in the same job (``observe``)."""
        from pyspark.sql import Observation
        obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
        path = self._write_files(df.observe(obs, F.count(F.lit(1)).alias("n")), table, by)
        return path, int(obs.get["n"])

    # SNK-3
    def load_truncate(self, df: DataFrame, table: str, batch_id: str | None = None, event: dict | None = None,
                      forget: bool = False) -> int:
        """Atomic full replace in the table's columns and types; a mismatch
        fails before anything is published.  With ``forget`` (a rollback) the
        batches applied so far may be applied again."""
        df, old = self._conform(df, table), self.manifest(table)
        path, n = self._count_while_writing(df, table)
        self._publish(table, old, {path: None}, None, df.schema.json(), n, batch_id, event, forget=forget)
        return n

    # SNK-4
    def load_append(self, df: DataFrame, table: str, batch_id: str | None = None, event: dict | None = None) -> int:
        """Plain append in the table's columns and types.  Idempotent per
        ``batch_id``: a batch already applied in any mode (e.g. a micro-batch
        replayed after a failure) is skipped."""
        if self.applied(table, batch_id):
            return 0
        df, old = self._conform(df, table), self.manifest(table)
        path, n = self._count_while_writing(df, table)
        self._publish(table, old, {path: None}, [], df.schema.json(), (old["rows"] if old else 0) + n, batch_id, event,
                      *((old["keys"], old["n"]) if old else ()))
        return n

    # SNK-5
    def load_upsert(self, df: DataFrame, table: str, keys: Sequence[str], batch_id: str | None = None, event: dict | None = None) -> int:
        """Key merge: the batch's columns replace those of target rows with the
        same key, columns that the batch lacks keep their values; new keys are
        added.  Missing key column or a key repeated inside the batch is an
        error; a batch of keys only leaves rows whose key exists unchanged.  A
        batch already applied is skipped.

        Only the buckets that hold a key of the batch are read and written anew;
        rows appended since are dealt to their buckets beside what is there."""
        if not keys:
            raise ValueError("upsert needs a key")
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise KeyError(f"upsert key not in batch: {missing}")
        if self.applied(table, batch_id):
            return 0
        stats = (df.groupBy(*keys).count()
                 .agg(F.sum("count").alias("rows"), F.max("count").alias("dup")).first())
        if stats["dup"] is not None and stats["dup"] > 1:
            raise ValueError(f"duplicate key in batch for {table}")
        batch_rows = int(stats["rows"] or 0)
        if not self.exists(table):
            return self.load_truncate(df, table, batch_id, event)
        old, batch = self.manifest(table), self._conform(df, table, absent_as_null=False)
        n = old["n"] if old["keys"] == list(keys) else self.buckets
        touched = {r[0] for r in batch.select(_bucket(batch, keys, n).alias("b")).distinct().collect()}       # n at most
        open_parts = [p for p, b in old["parts"].items() if b is None or b in touched or old["keys"] != list(keys)]
        target = self._read_parts(old, open_parts)
        merged = merge_by_key(target, batch, keys)
        merged = merged.withColumn(BUCKET, _bucket(merged, keys, n)).repartition(F.col(BUCKET))
        # new files are written before the commit, so reading the old version while writing the new one is safe
        path, written = self._count_while_writing(merged, table, [BUCKET])
        parts = {f"{path}/{name}": int(name.split("=")[1]) for name in _names(self.spark, path) if name.startswith(BUCKET)}
        rows = old["rows"] - target.count() + written
        self._publish(table, old, parts, open_parts, old["schema"], rows, batch_id, event, keys, n)
        return batch_rows

    # SNK-6
    def load(self, df: DataFrame, table: str, mode: str, keys: Sequence[str] = (),
             batch_id: str | None = None, event: dict | None = None) -> int:
        if mode not in LOAD_MODES:
            raise ValueError(f"unknown load mode {mode!r}")
        if mode == "upsert":
            return self.load_upsert(df, table, keys, batch_id, event)
        if mode == "append":
            return self.load_append(df, table, batch_id, event)
        return self.load_truncate(df, table, batch_id, event)


def _bucket(df: DataFrame, keys: Sequence[str], n: int) -> Column:
    """Bucket of a row by its key; rows without a whole key meet nobody and are
    dealt by all their columns, so that they do not fill one bucket."""
    whole = [F.col(f"`{k}`").isNotNull() for k in keys]
    by_key = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    by_row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return F.pmod(F.when(reduce(Column.__and__, whole), by_key).otherwise(by_row), F.lit(n)).cast("int")


def merge_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-5 as a plan: target rows whose key is not in the batch, plus the
    batch.  Columns that the batch lacks come from the target row of the same
    key, and are null for new keys.  Both joins are on bare rows, so a skewed
    key can be split."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    absent = [c for c in target.columns if c not in batch.columns]
    if absent:
        batch = batch.join(target.select(*keys, *absent), list(keys), "left")
    return kept.unionByName(batch.select(*target.columns))
