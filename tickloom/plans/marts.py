"""Daily facts and dimensions.

Ticks and posts are reduced to one row per (coin, day) or day before any join or
window, so everything after the first aggregates is bounded by coins x days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import fixed_values as V
from tickloom.functions.columns import sentiment_score, surrogate_key
from tickloom.functions.rolling import rolling_corr, rolling_mean, rows_window
from tickloom.operators.joins import left_with_defaults
from tickloom.operators.merge import Bounds, within


def daily_price(stg_prices: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    if bounds.read_from is not None:
        # Stated on the timestamp itself, which is what the scan can prune on.
        stg_prices = stg_prices.where(F.col("recorded_at") >= F.lit(bounds.read_from).cast("timestamp"))
    return stg_prices.groupBy(F.to_date("recorded_at").alias("report_date"), "coin_id").agg(
        F.avg("price_usd").alias("avg_price")
    )


def daily_posts(stg_posts: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    return (
        within(stg_posts, "report_date", bounds.read_from)
        .groupBy("report_date")
        .agg(F.count("post_id").alias("total_posts"), F.sum("score").alias("total_engagement"))
    )


def with_posts(prices: DataFrame, posts: DataFrame, posts_as: str, engagement_as: str) -> DataFrame:
    renamed = posts.select("report_date", F.col("total_posts").alias(posts_as), F.col("total_engagement").alias(engagement_as))
    return left_with_defaults(prices, renamed, ["report_date"], {posts_as: 0, engagement_as: 0})


def crypto_daily(prices: DataFrame, posts: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Average price per coin and day next to the day's discussion volume.

    Takes the outputs of :func:`daily_price` and :func:`daily_posts`.
    """
    rows = with_posts(prices, posts, "reddit_posts", "reddit_score")
    rows = within(rows, "report_date", bounds.emit_from, bounds.emit_to)
    return rows.select(
        surrogate_key("coin_id", "report_date").alias("record_id"),
        "report_date",
        "coin_id",
        "avg_price",
        "reddit_posts",
        "reddit_score",
    )


def market_insights(
    prices: DataFrame,
    posts: DataFrame,
    stg_index: DataFrame,
    stg_trending: DataFrame,
    bounds: Bounds = Bounds(),
    flat_corr: float = 0.0,
) -> DataFrame:
    """Daily price, discussion, index and trending state with score and 7-row rolling metrics.

    ``flat_corr`` is the correlation where price or discussion did not move within a frame.
    """
    index = within(stg_index, "report_date", bounds.read_from).select("report_date", "fng_value", "fng_classification")
    trending = within(stg_trending, "report_date", bounds.read_from).select("report_date", "coin_id", "trending_score")

    rows = with_posts(prices, posts, "reddit_posts", "reddit_engagement")
    rows = left_with_defaults(
        rows,
        index,
        ["report_date"],
        {"fng_value": V.MISSING_INDEX_VALUE, "fng_classification": V.MISSING_INDEX_CLASS},
    )
    rows = left_with_defaults(
        rows, trending, ["report_date", "coin_id"], {"trending_score": 0}, matched="is_trending"
    )

    week = rows_window(["coin_id"], "report_date", 7)
    rows = rows.select(
        surrogate_key("coin_id", "report_date").alias("record_id"),
        "report_date",
        "coin_id",
        "avg_price",
        "reddit_posts",
        "reddit_engagement",
        "fng_value",
        "fng_classification",
        "is_trending",
        "trending_score",
        sentiment_score("fng_value", "reddit_posts", "reddit_engagement").alias("sentiment_score"),
        rolling_mean("avg_price", week).alias("avg_price_7d"),
        rolling_mean("reddit_posts", week).alias("avg_reddit_posts_7d"),
        rolling_corr("avg_price", "reddit_posts", week, flat_corr).alias("price_social_corr_7d"),
    )
    return within(rows, "report_date", bounds.emit_from, bounds.emit_to)


def dim_coin(stg_prices: DataFrame) -> DataFrame:
    return stg_prices.select("coin_id").distinct()


def dim_date(fct_crypto_daily: DataFrame) -> DataFrame:
    return fct_crypto_daily.select(F.col("report_date").alias("date")).distinct().select(
        "date",
        F.year("date").cast("bigint").alias("year"),
        F.month("date").cast("bigint").alias("month"),
        F.dayofmonth("date").cast("bigint").alias("day"),
    )
