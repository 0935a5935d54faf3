"""Sharding by extendible hashing.

A directory of shards is indexed by prefixes of a row's hash bits.  It starts
with one shard; a shard of more bytes than the limit is split on its next bit,
again and again until all fit, while the others stay as they are.  A round
handles ``STEP`` bits: the bytes of the still oversized shards' rows are summed
by prefix once, and every level of the directory within these bits is added up
from those sums.  Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.shared import cut

#: Bits of each of the two hashes, and bits of the directory added in a round.
HASH_BITS, STEP = 60, 10


def key_hash(key: Column) -> Column:
    """60 bits of the key's MD5 (of its text; a null key counts as empty)."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _levels(rows: DataFrame, base: int, limit: int) -> DataFrame:
    """For each cell (``base + STEP`` bits) of the rows, the directory's entry:
    the first depth at which its prefix has at most ``limit`` bytes or one row."""
    second, end = base >= HASH_BITS, base + STEP
    cells = rows.groupBy("c1", "c2").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    depths = F.sequence(F.lit(base + (base > 0)), F.lit(end))
    up = F.expr(f"{end} - depth")
    level = (cells.select("*", F.explode(depths).alias("depth"))
             .select("*", (F.col("c1") if second else F.call_function("shiftright", F.col("c1"), up)).alias("p1"),
                     (F.call_function("shiftright", F.col("c2"), up) if second else F.col("c2")).alias("p2")))
    sums = level.groupBy("depth", "p1", "p2").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
    return (level.join(fits, ["depth", "p1", "p2"]).groupBy("c1", "c2")
            .agg(F.min(F.struct("depth", "shard_bytes", "shard_rows")).alias("entry")))


def assign(rows: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """Give every row its shard: the key column, ``bytes``, ``shard`` (the bits of
    its prefix, '' for the only one), ``depth``, ``shard_bytes``, ``shard_rows``.

    Rows go by 60 bits of their key's MD5.  Where equal keys alone exceed the
    limit, 60 more bits follow, hashed from each row's place in the table that
    the first step writes, so that a key of any number of rows is split as well.
    A single row above the limit has a shard of its own.  Null keys count as
    empty text, null sizes as 0; an empty table gives an empty result.

    Only key, hashes and sizes are shuffled; the sums of a cell are combined
    before they are, and the directory stays a table that is joined."""
    kept = cut(rows.select(F.col(key).alias("key"), key_hash(F.col(key)).alias("h1"),
                           F.coalesce(size, F.lit(0)).cast("long").alias("bytes")), "rows")
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.row_index"))
                                     .cast("binary")), 1, 15), 16, 10).cast("long")
    left, done = kept.select("*", place.alias("h2")), None
    for base in range(0, 2 * HASH_BITS, STEP):
        shift = HASH_BITS - base % HASH_BITS - STEP
        cut_off = F.call_function("shiftright", F.col("h2" if base >= HASH_BITS else "h1"), F.lit(shift))
        cells = left.withColumns({"c1": F.col("h1"), "c2": cut_off} if base >= HASH_BITS
                                 else {"c1": cut_off, "c2": F.lit(0).cast("long")})
        entries = cut(_levels(cells, base, limit), "directory")
        both = cut(cells.join(entries, ["c1", "c2"], "left").select("key", "h1", "h2", "bytes", "entry"), "assigned")
        placed = both.where("entry is not null")
        done = placed if done is None else done.unionAll(placed)
        left = both.where("entry is null").drop("entry")
        if left.isEmpty():
            break
    else:
        done = done.unionAll(left.withColumn("entry", F.struct(F.lit(2 * HASH_BITS).alias("depth"), F.col("bytes").alias(
            "shard_bytes"), F.lit(1).cast("long").alias("shard_rows"))))
    bits = F.concat(*[F.lpad(F.conv(h, 10, 2), HASH_BITS, "0") for h in ("h1", "h2")])
    return done.select(F.col("key").alias(key), "bytes", F.substring(bits, F.lit(1), F.col("entry.depth")).alias("shard"),
                       F.col("entry.depth").alias("depth"), F.col("entry.shard_bytes").alias("shard_bytes"),
                       F.col("entry.shard_rows").alias("shard_rows"))


#: DuckDB: sums by every prefix of 24 bits; the first that fits is the shard.
ASSIGN_SQL = """
WITH h AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
p AS (SELECT doc_id, bytes, d, right(repeat('0', 60) || bin(h), 60)[:d] AS shard FROM h, range(0, 25) r(d)),
s AS (SELECT d, shard, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY d, shard)
SELECT doc_id, bytes, shard, d::INTEGER AS depth, shard_bytes, shard_rows
FROM p JOIN s USING (d, shard) WHERE shard_bytes <= {limit} OR shard_rows = 1
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d) = 1
"""
