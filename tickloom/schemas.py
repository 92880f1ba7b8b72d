"""Fixed schemas of every source and stored table; JSON is never inferred."""

from __future__ import annotations

from pyspark.sql import types as T


S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
DAY, TS = T.DateType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


RAW_PRICES = _struct(symbol=S, price=D, timestamp=S, ingestion_date=S)
RAW_POSTS = _struct(id=S, title=S, score=L, created_utc=S, url=S)
RAW_INDEX = _struct(timestamp=S, value=L, value_classification=S, ingestion_date=S)
RAW_TRENDING = _struct(
    coin_id=S,
    name=S,
    symbol=S,
    market_cap_rank=L,
    score=L,
    timestamp=S,
    ingestion_date=S,
)
TRADE_MESSAGE = _struct(E=L, s=S, p=S)
TRADES = _struct(event_time=TS, symbol=S, price=D)

# External lake tables: the raw columns plus the partition column ``dt``.
LAKE_TABLES = {
    "coingecko_prices": _struct(symbol=S, price=D, timestamp=S),
    "reddit_posts": RAW_POSTS,
    "fear_greed_index": _struct(timestamp=S, value=L, value_classification=S),
    "coingecko_trending": _struct(coin_id=S, name=S, symbol=S, market_cap_rank=L, score=L, timestamp=S),
}

FCT_CRYPTO_DAILY = _struct(record_id=S, report_date=DAY, coin_id=S, avg_price=D, reddit_posts=L, reddit_score=L)
FCT_MARKET_INSIGHTS = _struct(
    record_id=S,
    report_date=DAY,
    coin_id=S,
    avg_price=D,
    reddit_posts=L,
    reddit_engagement=L,
    fng_value=L,
    fng_classification=S,
    is_trending=B,
    trending_score=L,
    sentiment_score=L,
    avg_price_7d=D,
    avg_reddit_posts_7d=D,
    price_social_corr_7d=D,
)

DIM_COIN = _struct(coin_id=S)
DIM_DATE = _struct(date=DAY, year=L, month=L, day=L)

# API payloads before flattening. Whole numbers stay text: the contract coerces or rejects them.
PRICE_PAYLOAD = "map<string, struct<usd: string>>"
# Index values keep their JSON type, as a number and the same digits in quotes are read differently.
INDEX_PAYLOAD = "struct<data: array<struct<value: variant, value_classification: string, timestamp: variant>>>"
POST_PAYLOAD = (
    "struct<data: struct<children: array<struct<data: struct<"
    "id: string, title: string, score: string, created_utc: string, url: string>>>>>"
)
TRENDING_PAYLOAD = "struct<coins: array<struct<item: map<string, string>>>>"
