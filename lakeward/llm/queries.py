"""The registered queries of this subpackage: name -> (function, DuckDB SQL or None).

Each applies its operator with production parameters to the whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import (bpe, collocations, compress_quality, containment, cross_entropy, divergence, extendible,
                          neighbours, secret_scan, simhash, spelling, surrogates, wrappers)
from lakeward.llm.shared import read

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return register


def byte_bpe() -> tuple[str, str]:
    """Place of the public rank file, and the pattern that goes with it."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), *byte_bpe())


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secret_scan.digest(secret_scan.scan(docs, secret_scan.train_on_texts(docs)))


@query("op2_compress_quality")
def op2_compress_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = compress_quality.train(docs, labels.where(~compress_quality.held_out()))
    return (compress_quality.score(docs, model)
            .select("doc_id", compress_quality.held_out().alias("held_out"), "score", "predicted"))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=4, distance=4)


@query("op9_containment", containment.PAIRS_SQL)
def op9_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.pairs(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op5_divergence", divergence.JUDGE_SQL)
def op5_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(read(spark, sf_dir, "documents"))


#: Bytes of text that a shard of the query holds at most.
SHARD_BYTES = 1 << 20


@query("op7_extendible_sharding", extendible.ASSIGN_SQL.format(limit=SHARD_BYTES))
def op7_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible.assign(read(spark, sf_dir, "documents"), "doc_id", F.octet_length("text"), SHARD_BYTES)


@query("op8_cross_entropy")
def op8_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what is labelled good, the background everything else."""
    docs = read(spark, sf_dir, "documents")
    good = read(spark, sf_dir, "labels").where("quality = 1")
    return cross_entropy.difference(docs, good)


@query("op10_html_wrappers")
def op10_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read(spark, sf_dir, "pages"))


@query("op1_pii_surrogates")
def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a secret in production; here it comes from the environment, if set."""
    key = os.environ.get("LAKEWARD_SURROGATE_KEY", "surrogate key of the registered query")
    return surrogates.replace(read(spark, sf_dir, "documents"), key.encode())


@query("op11_collocations", collocations.COLLOCATIONS_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


@query("op12_spelling")
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"), letters=6, least=5, times=5)


@query("op13_neighbours")
def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)
