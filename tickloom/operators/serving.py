"""Read-side queries: point lookups, trend series, mention counts, price cards.

Everything is computed in the plan; only the final few rows ever reach a client.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import fixed_values as V
from tickloom.functions.columns import band, mentions, money_text, ticker
from tickloom.functions.rolling import full_window_mean
from tickloom.operators.dedup import latest_per_key
from tickloom.operators.joins import left_with_defaults


def newest(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The last ``n`` rows by the order columns, returned oldest first."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def coin_history(fact: DataFrame, coin_id: str = "bitcoin", n: int = 10) -> DataFrame:
    """The newest ``n`` days of one coin, shaped for the price endpoint."""
    return fact.sparkSession.sql(
        """
        SELECT CAST(report_date AS STRING) AS date, coin_id AS coin, avg_price AS price,
               reddit_posts, reddit_score
        FROM {fact} WHERE coin_id = :coin_id ORDER BY report_date DESC LIMIT :n
        """,
        args={"coin_id": coin_id, "n": n},
        fact=fact,
    )


def index_history(index: DataFrame, n: int = 90, dedup: bool = False) -> DataFrame:
    """The newest ``n`` index rows by (ingestion day, event time).

    ``dedup`` keeps one row per event day instead of every fetched copy.
    """
    rows = index.select(
        F.col("value").cast("int").alias("value"),
        "value_classification",
        "dt",
        F.col("timestamp").cast("bigint").alias("timestamp"),
    )
    if dedup:
        daily = rows.withColumn("_day", F.to_date(F.timestamp_seconds("timestamp")))
        rows = latest_per_key(daily, ["_day"], ["timestamp", "dt", "value", "value_classification"]).drop("_day")
    return rows.orderBy(
        F.col("dt").desc(), F.col("timestamp").desc(), F.col("value").desc(), F.col("value_classification").desc()
    ).limit(n)


def index_trend(history: DataFrame, days: int = 30, rows: int = 7) -> DataFrame:
    """The newest ``days`` rows, oldest first, with a mean that needs a full window.

    The window has no key; it only ever sees the ``days`` rows left by the limit.
    """
    trimmed = newest(history, ["dt", "timestamp", "value", "value_classification"], days)
    window = Window.orderBy("dt", "timestamp", "value", "value_classification").rowsBetween(-(rows - 1), 0)
    return trimmed.withColumn("ma", full_window_mean("value", window, rows))


def index_badge(value: Column | str) -> Column:
    """Red below 35, green above 65, yellow between."""
    return band(value, 35, 65, ("red", "yellow", "green"))


def latest_index(index: DataFrame) -> DataFrame:
    """The newest index reading with its badge."""
    return index_history(index, 1).select("value", "value_classification", index_badge("value").alias("badge"), "dt")


def relabelled(prices: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Lake prices with the symbol shown as a ticker."""
    return prices.select(ticker("symbol", names).alias("symbol"), "price", "timestamp", "dt")


def price_listing(prices: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Every lake price, newest first, as one distributed sort.

    Copies of one record would all fall between two range bounds, so copies are first
    counted (on the map side), sorted as one row per block of copies, and unfolded after
    the sort inside the partition they landed in.
    """
    block = 100_000
    counted = relabelled(prices, names).groupBy("symbol", "price", "timestamp", "dt").agg(F.count(F.lit(1)).alias("_n"))
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / block)))).withColumn(
        "_copies", F.least(F.lit(block), F.col("_n") - F.col("_block") * block).cast("int")
    )
    ordered = blocks.orderBy(F.col("dt").desc(), F.col("timestamp").desc(), "symbol", F.col("price").desc(), "_block")
    return ordered.select(
        "symbol", "price", "timestamp", "dt", F.explode(F.array_repeat(F.lit(1), F.col("_copies"))).alias("_copy")
    ).drop("_copy")


def latest_prices(listing: DataFrame) -> DataFrame:
    """Newest price per symbol with its label; the higher price wins a tie."""
    rows = listing.select(F.upper("symbol").alias("symbol"), "price", "dt", "timestamp")
    return latest_per_key(rows, ["symbol"], ["dt", "timestamp", "price"]).withColumn("price_label", money_text("price"))


def mention_counts(
    posts: DataFrame, day: str = "dt", title: str = "title", patterns: dict[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """Posts per day whose title mentions each ticker, in one pass."""
    # Lower-cased once per post: a projection is not merged into a reader that uses it repeatedly.
    lowered = posts.select(F.col(day).alias("report_date"), F.lower(title).alias("_title"))
    counts = [
        F.count_if(mentions("_title", words)).alias(f"{token.lower()}_mentions")
        for token, words in (patterns or V.MENTION_PATTERNS).items()
    ]
    return lowered.groupBy("report_date").agg(*counts)


def ordered_mention_counts(counts: DataFrame) -> DataFrame:
    return counts.orderBy("report_date")


def mention_totals(counts: DataFrame, tokens: list[str] | None = None, days: int = 30) -> DataFrame:
    """Mentions per watched token over the newest ``days`` rows, one row per token."""
    wanted = [t for t in (V.WATCH_LIST if tokens is None else tokens) if f"{t.lower()}_mentions" in counts.columns]
    totals = newest(counts, ["report_date"], days).agg(
        *[F.coalesce(F.sum(f"{t.lower()}_mentions"), F.lit(0)).cast("bigint").alias(t) for t in wanted]
    )
    return totals.unpivot([], list(wanted), "Token", "Mentions")


def has_mentions(totals: DataFrame) -> DataFrame:
    """Whether any watched token was mentioned at all."""
    return totals.agg((F.coalesce(F.sum("Mentions"), F.lit(0)) > 0).alias("has_mentions"))


def price_vs_mentions(prices: DataFrame, counts: DataFrame, token: str = "BTC", days: int = 30) -> DataFrame:
    """Daily mean price of one token next to its mentions, newest ``days`` rows, oldest first."""
    daily = (
        prices.where(F.col("symbol") == token)
        .groupBy(F.col("dt").alias("report_date"))
        .agg(F.avg("price").alias("avg_price"))
    )
    said = counts.select("report_date", F.col(f"{token.lower()}_mentions").alias("mention_count"))
    return newest(left_with_defaults(daily, said, ["report_date"], {"mention_count": 0}), ["report_date"], days)


# Derived metrics over the daily facts.


def day_over_day(fact: DataFrame, price: str = "avg_price") -> DataFrame:
    """Relative change to the previous row and to seven rows before, and a 7-row price band.

    Runs on one row per coin and day, so a coin's window holds at most its days.
    """
    by_coin = Window.partitionBy("coin_id").orderBy("report_date")
    frame = by_coin.rowsBetween(-6, 0)

    def change(rows: int) -> Column:
        before = F.lag(price, rows).over(by_coin)
        return F.try_divide(F.col(price) - before, before)

    mean, spread = F.avg(price).over(frame), F.stddev_pop(price).over(frame)
    return fact.select(
        "report_date",
        "coin_id",
        price,
        change(1).alias("change_1d"),
        change(7).alias("change_7d"),
        (mean - 2 * spread).alias("band_low"),
        (mean + 2 * spread).alias("band_high"),
    )


def engagement_per_post(fact: DataFrame, posts: str = "reddit_posts", score: str = "reddit_score") -> DataFrame:
    """Engagement per post by day; the community columns are the same for every coin of a day."""
    daily = fact.groupBy("report_date").agg(F.max(posts).alias("posts"), F.max(score).alias("engagement"))
    return daily.withColumn("engagement_per_post", F.try_divide(F.col("engagement").cast("double"), F.col("posts")))


def engagement_share(insights: DataFrame) -> DataFrame:
    """Engagement by coin and trending flag, with its share of the total."""
    groups = insights.groupBy("coin_id", "is_trending").agg(F.sum("reddit_engagement").alias("engagement"))
    # The window holds one row per coin and flag.
    total = F.sum("engagement").over(Window.partitionBy())
    return groups.withColumn("share", F.try_divide(F.col("engagement").cast("double"), total))


def score_bands(insights: DataFrame) -> DataFrame:
    """Mean sentiment score per coin: Bullish from 70, Bearish below 30, Neutral between."""
    mean = insights.groupBy("coin_id").agg(F.avg("sentiment_score").alias("avg_score"))
    return mean.withColumn("band", band("avg_score", 30, 70, ("Bearish", "Neutral", "Bullish"), high_inclusive=True))


def field_aggregates(insights: DataFrame) -> DataFrame:
    """The report's default aggregate of every numeric field, per coin."""
    sums = ("reddit_posts", "reddit_engagement")
    means = (
        "avg_price",
        "fng_value",
        "trending_score",
        "sentiment_score",
        "avg_price_7d",
        "avg_reddit_posts_7d",
        "price_social_corr_7d",
    )
    return insights.groupBy("coin_id").agg(
        *[F.sum(c).alias(f"sum_{c}") for c in sums], *[F.avg(c).alias(f"mean_{c}") for c in means]
    )


def health(report: DataFrame, warn_only: list[str] | None = None) -> DataFrame:
    """Healthy / Warning / Failed per table from a quality report."""
    soft = F.col("check").isin(warn_only or [])
    return report.groupBy("table").agg(
        F.when(F.count_if((F.col("failures") > 0) & ~soft) > 0, "Failed")
        .when(F.count_if(F.col("failures") > 0) > 0, "Warning")
        .otherwise("Healthy")
        .alias("status")
    )
