"""Benchmark decontamination: size-partitioned MinHash containment search.

An item of the benchmark is short, a document may be long, so their Jaccard
similarity says little; what counts is how much of the item the document holds.
Items are partitioned by size (number of distinct shingles, in powers of two).
The items of a partition keep a bottom-k MinHash sketch whose k follows from
the partition's largest size: more than may be missing of any of its items, so
a document that holds enough of an item holds at least one value of its sketch.
Documents are probed with the hashes of all their shingles, as only their whole
set is sure to hold the item's smallest ones; candidates are then verified by
exact shingle containment.  Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.shared import cut

#: Shingle length and the share of an item's shingles that a document must hold.
WORDS, SHARE = 5, 0.8


def shingles(text: Column, words: int = WORDS) -> Column:
    """The distinct shingles of a text's words: runs of letters and digits, in
    lower case; texts with fewer words have none."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(F.array(runs), lambda w: F.array_distinct(F.when(
        F.size(w) >= words,
        F.transform(F.sequence(F.lit(1), F.size(w) - (words - 1)),
                    lambda i: F.array_join(F.slice(w, i, words), " "))).otherwise(F.array().cast("array<string>"))))[0]


def hashes(text: Column, words: int = WORDS) -> Column:
    """The distinct hashes of a text's shingles, equal to xxhash64 of each."""
    return F.array_distinct(F.transform(shingles(text, words), lambda s: F.xxhash64(s)))


def sketch(found: Column, share: float = SHARE) -> Column:
    """Bottom-k MinHash values of an item's shingles, k by its size partition:
    with sizes up to ``u``, at most ``floor((1 - share) * u)`` may be missing."""
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.size(found).cast("double"))) + 1) - 1
    k = F.floor((1 - share) * largest + 1e-9) + 1
    return F.slice(F.sort_array(F.transform(found, lambda s: F.xxhash64(s))), F.lit(1), k.cast("int"))


def _row(frame: DataFrame) -> list[Column]:
    """128 bits that tell rows with different ids or texts apart."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", "doc_id").alias("k2")]


def contained(docs: DataFrame, items: DataFrame, words: int = WORDS, share: float = SHARE) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) that hold at least ``share`` of the
    distinct shingles of rows of ``items`` (item_id, text).

    Returns ``k1, k2`` (the document row's key), ``doc_id``, ``item_id``,
    ``n_shared`` and ``n_item`` (shingles), one row per different document row
    and item text.  Null or shorter texts have no shingles and are in no row.
    Only the candidates' texts are cut into shingles a second time.  The sketch
    and the items' shingles are written first, so that the planner broadcasts
    them if their files are small and shuffles otherwise."""
    item = (items.select("item_id", shingles(F.col("text"), words).alias("found")).where(F.size("found") > 0)
            .withColumn("n_item", F.size("found").cast("long"))
            .withColumn("item", F.xxhash64("item_id", "found")).dropDuplicates(["item_id", "item"]))
    index = cut(item.select("item", F.explode(sketch(F.col("found"), share)).alias("hash")), "sketch")
    parts = cut(item.select("item", "item_id", "n_item", F.explode("found").alias("shingle")), "items")

    probes = docs.select(*_row(docs), F.explode(hashes(F.col("text"), words)).alias("hash"))
    candidates = cut(probes.join(index, "hash").select("k1", "k2", "item").distinct(), "candidates")
    rows = (docs.select("doc_id", "text", *_row(docs)).join(candidates.select("k1", "k2").distinct(), ["k1", "k2"],
                                                             "left_semi").dropDuplicates(["k1", "k2"]))
    held = (rows.select("k1", "k2", "doc_id", F.explode(shingles(F.col("text"), words)).alias("shingle"))
            .join(parts, "shingle").groupBy("k1", "k2", "doc_id", "item", "item_id", "n_item")
            .agg(F.count("*").alias("n_shared")))
    return (held.join(candidates, ["k1", "k2", "item"], "left_semi")
            .where(F.col("n_shared") >= share * F.col("n_item") - 1e-9)
            .select("k1", "k2", "doc_id", "item_id", "n_shared", "n_item"))


def pairs(docs: DataFrame, items: DataFrame, words: int = WORDS, share: float = SHARE) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shared``, ``n_item``, ``containment``: for each
    pair of ids the rows that share most."""
    best = F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item")).alias("best")
    return (contained(docs, items, words, share).groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "best.n_shared", "best.n_item",
                    (F.col("best.n_shared") / F.col("best.n_item")).alias("containment")))


def without(docs: DataFrame, items: DataFrame, words: int = WORDS, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns as they are."""
    hit = cut(contained(docs, items, words, share).select("k1", "k2").distinct(), "hits")
    kept = docs.select(F.struct("*").alias("row"), *_row(docs)).join(hit, ["k1", "k2"], "left_anti")
    return kept.select("row.*")


#: DuckDB: containment by joining all shingles.
PAIRS_SQL = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') FROM benchmark),
s AS (
  SELECT side, id, text, list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) AS s
  FROM (SELECT DISTINCT * FROM w)),
u AS (SELECT side, id, text, len(s) AS n, unnest(s) AS shingle FROM s),
hit AS (
  SELECT d.id AS doc_id, i.id AS item_id, i.n AS n_item, count(*) AS n_shared
  FROM u d JOIN u i ON d.side = 'd' AND i.side = 'i' AND d.shingle = i.shingle
  GROUP BY d.id, d.text, i.id, i.text, i.n HAVING count(*) >= 0.8 * i.n - 1e-9)
SELECT doc_id, item_id, arg_max(n_shared, n_shared / n_item) AS n_shared, arg_max(n_item, n_shared / n_item) AS n_item,
       max(n_shared / n_item) AS containment
FROM hit GROUP BY doc_id, item_id
"""
