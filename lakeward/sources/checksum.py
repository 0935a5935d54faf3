"""Content checksums and change detection (SRC-7).

A source of files is known by a hash tree: a row a file with its length, its
time of change and a digest of its bytes; above them a digest a folder and one
of all.  A later run lists the files and reads only those whose length or time
is another than in the tree it knows."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each landed file's bytes (``binaryFile`` source)."""
    return (spark.read.format("binaryFile").load(path)
            .select("path", "length", F.sha2(F.col("content"), 256).alias("sha256")))


#: Files above this size are digested by their lines, which many tasks read.
WHOLE_BYTES = 256 << 20


def _digest(whole: Column, what: Column) -> Column:
    """Order-insensitive digest of a group: its size and the exact sum of 64-bit
    hashes, so that partial aggregates keep every group to one row a task."""
    return F.concat_ws(":", F.count(what).cast("string"), F.sum(F.xxhash64(whole).cast("decimal(38,0)")).cast("string"))


def file_tree(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """One row a file below ``path``: ``path``, ``folder``, ``length``, ``modified`` and
    ``digest`` (SHA-256 of its bytes; of files above 256 MB a digest of their lines
    in any order).  Digests of files that ``known``, an earlier tree, has with the
    same length and time are taken from there.  Empty files hold no rows of a
    source and are left out, as Spark's readers do; an empty folder gives no rows.  Only the paths of changed files come to the driver, which lists all
    files in any case when a table is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "length", F.col("modificationTime").alias("modified")))
    files = files.withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    if known is None:
        kept, new = None, files
    else:
        same = known.select("path", "length", "modified", "digest")
        files = files.join(same, ["path", "length", "modified"], "left")
        kept, new = files.where("digest is not null"), files.where("digest is null").drop("digest")
    todo = [(r["path"], r["length"] > WHOLE_BYTES) for r in new.select("path", "length").collect()]
    read = spark.createDataFrame([], "path string, digest string")
    small, large = ([p for p, big in todo if big == wanted] for wanted in (False, True))
    if small:
        read = read.unionAll(spark.read.format("binaryFile").load(small)
                             .select("path", F.sha2(F.col("content"), 256).alias("digest")))
    if large:
        lines = spark.read.text(large).select(F.col("_metadata.file_path").alias("path"), "value")
        read = read.unionAll(lines.groupBy("path").agg(_digest(F.col("value"), F.lit(1)).alias("digest")))
    cols = ["path", "folder", "length", "modified", "digest"]
    tree = new.join(read, "path", "left").select(*cols)
    return tree if kept is None else kept.select(*cols).unionAll(tree)


def folder_digests(tree: DataFrame) -> DataFrame:
    """The tree's inner nodes: ``folder``, ``n_files`` and ``digest``, which is the same
    for the same contents whatever the files are called."""
    return tree.groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"), _digest(F.col("digest"), F.lit(1)).alias("digest"))


def tree_digest(tree: DataFrame) -> str:
    """The root: SHA-256 of the folders' names and digests; one row comes to the driver."""
    r = folder_digests(tree).agg(_digest(F.concat_ws("|", "folder", "digest"), F.lit(1)).alias("d")).first()
    return hashlib.sha256((r["d"] or "").encode()).hexdigest()


def changed_folders(tree: DataFrame, known: DataFrame) -> DataFrame:
    """``folder`` and ``change`` of a tree against an earlier one: ``added``,
    ``removed``, ``changed`` or ``unchanged``."""
    now, then = folder_digests(tree), folder_digests(known)
    both = now.select("folder", F.col("digest").alias("now")).join(
        then.select("folder", F.col("digest").alias("then")), "folder", "full")
    change = (F.when(F.col("then").isNull(), "added").when(F.col("now").isNull(), "removed")
              .when(F.col("now") == F.col("then"), "unchanged").otherwise("changed"))
    return both.select("folder", change.alias("change"))


def table_fingerprint(df: DataFrame) -> str:
    """Order-insensitive fingerprint of a table's content: row count plus the
    exact decimal sum of a 64-bit row hash (one partial aggregate; equal
    tables give equal fingerprints whatever their partitioning).  Which values
    are null is hashed with them, as a null by itself leaves a hash unchanged."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    h = F.xxhash64(*[x for c in cols for x in (c.isNull(), c)]).cast("decimal(38,0)")
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("s")).first()
    return f"{r['n']}:{r['s']}"
