"""The declared quality suite: 52 column checks and 4 whole-frame checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import fixed_values as V
from tickloom.operators import quality as Q
from tickloom.operators.ticks import jumps, with_previous

_NOT_NULL = {
    "raw_prices": ("symbol", "price"),
    "raw_posts": ("id",),
    "raw_index": ("timestamp", "value"),
    "raw_trending": ("coin_id", "timestamp"),
    "stg_prices": ("record_id", "coin_id", "price_usd", "recorded_at"),
    "stg_posts": ("record_id", "post_id", "report_date"),
    "stg_index": ("record_id", "report_date", "fng_value"),
    "stg_trending": ("record_id", "report_date", "coin_id"),
    "dim_coin": ("coin_id",),
    "dim_date": ("date",),
    "fct_crypto_daily": ("record_id", "report_date", "coin_id", "avg_price", "reddit_posts"),
    "fct_market_insights": ("record_id", "report_date", "coin_id", "avg_price", "fng_value", "sentiment_score"),
}
_UNIQUE = {
    "stg_prices": ("record_id",),
    "stg_posts": ("record_id", "post_id"),
    "stg_index": ("record_id",),
    "stg_trending": ("record_id",),
    "dim_coin": ("coin_id",),
    "dim_date": ("date",),
    "fct_crypto_daily": ("record_id",),
    "fct_market_insights": ("record_id",),
}

NOT_NULL = [Q.not_null(t, c) for t, cols in _NOT_NULL.items() for c in cols]
UNIQUE = [Q.unique(t, c) for t, cols in _UNIQUE.items() for c in cols]
RANGES = [
    Q.accepted_range("stg_prices", "price_usd", 0, 1_000_000),
    Q.accepted_range("stg_index", "fng_value", 0, 100),
    Q.accepted_range("fct_crypto_daily", "avg_price", 0),
    Q.accepted_range("fct_market_insights", "fng_value", 0, 100),
    Q.accepted_range("fct_market_insights", "sentiment_score", 0, 100),
]
RELATIONSHIPS = [
    Q.relationship(fact, column, parent, parent_column)
    for fact in ("fct_crypto_daily", "fct_market_insights")
    for column, parent, parent_column in (("report_date", "dim_date", "date"), ("coin_id", "dim_coin", "coin_id"))
]
EXPRESSIONS = [Q.expression_is_true("fct_crypto_daily", "avg_price >= 0")]
DECLARED = NOT_NULL + UNIQUE + RANGES + RELATIONSHIPS + EXPRESSIONS


def spiking_ticks(stg_prices: DataFrame) -> DataFrame:
    """Ticks more than half away from the coin's previous tick.

    Feeds stamp whole seconds, so a minute holds at most 60 ticks of a coin, and the
    coin-wide step sees at most half a million minutes per year.
    """
    ticks = stg_prices.select("coin_id", "recorded_at", "price_usd")
    return jumps(with_previous(ticks, "coin_id", "recorded_at", "price_usd", buckets=("MINUTE",)), "price_usd")


def price_spikes(table: str = "stg_prices") -> Q.FrameCheck:
    return Q.FrameCheck(table, "price_spike", lambda t: spiking_ticks(t[table]))


def price_positive(table: str = "stg_prices") -> Q.RowCheck:
    return Q.RowCheck(table, "price_positive", lambda: F.col("price_usd") <= 0)


def not_in_future(table: str = "stg_prices", as_of: Column | None = None) -> Q.RowCheck:
    return Q.RowCheck(
        table,
        "timestamp_not_in_future",
        lambda: F.col("recorded_at") > (F.current_timestamp() if as_of is None else as_of),
    )


def latest_day_complete(table: str = "fct_crypto_daily", expected: str = V.EXPECTED_COINS) -> Q.FrameCheck:
    def missing(t):
        fact = t[table]
        return Q.missing_expected(Q.expected_keys(fact.sparkSession, expected), fact)

    return Q.FrameCheck(table, "latest_day_has_expected_coins", missing)


def full_suite(expected: str = V.EXPECTED_COINS, as_of: Column | None = None) -> list[Q.Check]:
    return [*DECLARED, price_spikes(), price_positive(), not_in_future(as_of=as_of), latest_day_complete(expected=expected)]
