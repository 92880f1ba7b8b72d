"""Raw sources to typed, deduplicated staging frames. All lazy; nothing is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import utc_text
from tickloom.operators.dedup import distinct_ticks, latest_per_key


def stage_prices(raw: DataFrame, gated: bool = False) -> DataFrame:
    """One row per coin and instant, the highest price winning.

    ``gated`` says the rows passed the price contract, which rejects a missing symbol or
    timestamp.

    The text id is a function of (coin, instant), so it is built after deduplication,
    for surviving rows only. A bound on ``recorded_at`` set by a caller reaches the scan:
    it is a grouping column.
    """
    typed = raw.select(
        F.lower("symbol").alias("coin_id"),
        F.col("price").cast("double").alias("price_usd"),
        F.col("timestamp").cast("timestamp").alias("recorded_at"),
    )
    ticks = distinct_ticks(typed, "coin_id", "recorded_at", "price_usd", identified=gated)
    return ticks.select(
        F.concat("coin_id", F.lit("_"), utc_text("recorded_at")).alias("record_id"),
        "coin_id",
        "price_usd",
        "recorded_at",
    )


def stage_posts(raw: DataFrame, with_title: bool = True) -> DataFrame:
    """Newest version of every post.

    The title only breaks ties between versions of equal time and score, so leaving it
    out changes no other column and keeps the widest column out of scan and shuffle.
    """
    order = ["created_at", "score", *(["title"] if with_title else [])]
    typed = raw.select(
        F.col("id").alias("post_id"),
        *(["title"] if with_title else []),
        F.col("score").cast("bigint").alias("score"),
        F.col("created_utc").cast("timestamp").alias("created_at"),
    )
    posts = latest_per_key(typed, ["post_id"], order).withColumn("report_date", F.to_date("created_at"))
    return posts.select(F.col("post_id").alias("record_id"), *posts.columns)


def stage_index(raw: DataFrame) -> DataFrame:
    """Last index reading of every UTC day."""
    seconds = F.col("timestamp").cast("bigint")
    typed = raw.select(
        F.to_date(F.timestamp_seconds(seconds)).alias("report_date"),
        seconds.alias("fng_timestamp"),
        F.col("value").cast("bigint").alias("fng_value"),
        F.col("value_classification").alias("fng_classification"),
    )
    last = latest_per_key(typed, ["report_date"], ["fng_timestamp"])
    return last.select(F.col("report_date").cast("string").alias("record_id"), *last.columns)


def stage_trending(raw: DataFrame, with_details: bool = True) -> DataFrame:
    """Last trending entry of every coin and day, the highest score on a tie.

    Name, ticker and rank come after the score in that order, so leaving them out
    changes no other column.
    """
    at = F.col("timestamp").cast("timestamp")
    details = [
        F.col("name"),
        F.upper("symbol").alias("symbol"),
        F.col("market_cap_rank").cast("bigint").alias("market_cap_rank"),
    ]
    typed = raw.select(
        F.lower("coin_id").alias("coin_id"),
        *(details if with_details else []),
        F.col("score").cast("bigint").alias("trending_score"),
        at.alias("recorded_at"),
        F.to_date(at).alias("report_date"),
    )
    last = latest_per_key(typed, ["coin_id", "report_date"], ["recorded_at", "trending_score"])
    return last.select(
        F.concat("coin_id", F.lit("_"), F.col("report_date").cast("string")).alias("record_id"), *last.columns
    )
