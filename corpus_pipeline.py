"""A training corpus from documents: quality, near-duplicates, benchmark
leaks, secrets, token ids.

Every stage takes (spark, docs, sf_dir), works on all rows of its predecessor,
and returns them with the columns of ``documents``; the last returns token ids.
Whole texts go to Python workers and back in small batches, as executors keep
what a stage has taken of their memory for the next ones.
``run`` writes each stage's rows as Parquet below the session's checkpoint
folder and reads them back, so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import bpe, compress_quality, containment, secret_scan, simhash
from lakeward.llm.queries import byte_bpe
from lakeward.llm.shared import cut, read
from lakeward.session import small_batches

#: What stands for a secret in the corpus.
MASK = "[secret]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the compression classifier calls good."""
    small_batches(spark)
    labels = read(spark, sf_dir, "labels").where(~compress_quality.held_out())
    scored = compress_quality.score(docs.withColumn("row", F.struct("*")), compress_quality.train(docs, labels), with_rows=True)
    return scored.where("predicted = 1").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one with the smallest id."""
    small_batches(spark)
    return simhash.one_of_each(docs, words=4, distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no benchmark item."""
    return containment.without(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, their secrets masked."""
    small_batches(spark)
    return secret_scan.masked(docs, secret_scan.train_on_texts(docs), MASK)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, ``n_chars``, ``token_ids`` and ``n_tokens``."""
    small_batches(spark)
    return (bpe.encode(docs, *byte_bpe()).select("doc_id", "lang", "source", "n_chars", "token_ids")
            .withColumn("n_tokens", F.size("token_ids").cast("long")))


STAGES = [("quality classifier", quality), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", decontaminate), ("secret scan", secrets), ("byte-level BPE", encode)]

#: SQL can express neither the classifier nor the fingerprints; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
