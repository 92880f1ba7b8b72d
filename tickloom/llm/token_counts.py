"""Token counts with a digest cache.

A count depends on the text and on the tokenizer alone. Counts are kept in a table keyed by the
digest of the content and the digest of the tokenizer's version; documents join it, only distinct
contents without a count are encoded, and their counts are appended.

Null text counts as empty (0 bytes, 0 tokens). Repeated rows each get a row. Empty tables give an
empty result. Only ``doc_id`` and ``text`` are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import hashlib

import public_tokenizers
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import bytes_of, column, documents, per_row, scratch
from tickloom.llm.pieces import PieceCache, shared_cache, tokenizer
from tickloom.session import path_exists

CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"


def version(path: str) -> str:
    """Digest of the tokenizer's file and of the library that reads it."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


def content() -> F.Column:
    """Digest of the normalised content: null is empty, nothing else changes, as any change could change the count."""
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def encoded(rows: DataFrame, path: str) -> DataFrame:
    """``content`` and the library's number of tokens of each row's text."""

    def make():
        cache = shared_cache(("counts", path), lambda: PieceCache(tokenizer(path), lambda _, ids: len(ids)))
        return lambda batch: {"n_tokens": [sum(x) for x in cache.values(bytes_of(batch))]}

    return per_row(rows, make, [("content", "content"), ("text", "text")], "n_tokens long", keeps=True)


def read_cache(spark: SparkSession, folder: str, tokenizer_version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per content."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "content string, n_tokens long")
    rows = spark.read.schema(CACHE_SCHEMA).parquet(folder).where(F.col("tokenizer") == tokenizer_version)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, cache: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` per row of ``docs``; new counts are appended to the folder ``cache``.

    Which row stands for a content is settled on digests and ids alone, by an aggregate that
    combines before the shuffle, so copies cost one short row per task; texts move only to meet
    that choice. Two writers may append the same content: counts agree, and reading takes one.
    """
    spark = docs.sparkSession
    cache = cache or scratch(spark, "token-counts")
    now = version(path)
    rows = docs.select(column("doc_id").alias("doc_id"), column("text").alias("text")).withColumn("content", content())
    wanted = rows.groupBy("content").agg(F.min("doc_id").alias("stands"))
    missing = wanted.join(read_cache(spark, cache, now), "content", "left_anti")
    texts = rows.join(missing, (rows.content == missing.content) & rows.doc_id.eqNullSafe(missing.stands), "left_semi")
    counted = encoded(texts, path).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    counted.select("content", F.lit(now).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = read_cache(spark, cache, now)
    sizes = rows.select("doc_id", "content", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    return sizes.join(counts, "content").select("doc_id", "n_bytes", "n_tokens")


def op5_token_counts(spark: SparkSession, sf_dir: str, limit: int = 512) -> DataFrame:
    out = count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
