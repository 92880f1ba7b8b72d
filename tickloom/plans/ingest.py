"""Feeds into bronze: flatten, contract, land by day; and bronze as gated sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.operators import contracts as K
from tickloom.operators.quality import require_rows
from tickloom.sources import payloads
from tickloom.sources.lake import Sources, read_day_folders


@dataclass(frozen=True)
class Feed:
    """A source: its bronze folder, how its payload unfolds, and what its records must look like."""

    folder: str
    flatten: Callable[..., DataFrame]
    contract: K.Contract
    schema: T.StructType


FEEDS = {
    "raw_prices": Feed("coingecko", payloads.flatten_prices, K.PRICES, schemas.RAW_PRICES),
    "raw_posts": Feed("reddit", payloads.flatten_posts, K.POSTS, schemas.RAW_POSTS),
    "raw_index": Feed("fear_greed", payloads.flatten_index, K.INDEX, schemas.RAW_INDEX),
    "raw_trending": Feed("trending_coins", payloads.flatten_trending, K.TRENDING, schemas.RAW_TRENDING),
}


def ingest(name: str, documents: DataFrame, root: str, day: dt.date, **options) -> dict[str, int]:
    """Land one day of a feed under ``root/<folder>/<day>/status=...``, replacing that day.

    Raises when the payload unfolds to nothing or no record is valid, and then leaves the day as it
    was; quarantined records, and documents that are no JSON, are kept next to the valid ones.
    Returns the counts.
    """
    feed = FEEDS[name]
    rows = require_rows(feed.flatten(documents, **options), feed.folder)
    broken = payloads.broken_documents(documents)
    return K.land(rows, feed.contract, f"{root}/{feed.folder}/{day}", unreadable=broken)


def ingest_posts_or_fallback(
    spark: SparkSession, documents: DataFrame, root: str, day: dt.date, **options
) -> dict[str, int]:
    """Posts, or the placeholder posts when the feed has none."""
    feed = FEEDS["raw_posts"]
    fallback = payloads.fallback_posts(spark, **options).withColumn("score", F.col("score").cast("string"))
    rows = payloads.or_fallback(feed.flatten(documents), fallback)
    broken = payloads.broken_documents(documents)
    return K.land(rows, feed.contract, f"{root}/{feed.folder}/{day}", unreadable=broken)


def bronze(
    spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None
) -> Sources:
    """The valid records of every feed with their landing day as ``dt``."""

    def load(feed: Feed) -> Callable[[], DataFrame]:
        return lambda: read_day_folders(
            spark, f"{root}/{feed.folder}", feed.schema, start=start, end=end, below="status=valid"
        )

    return Sources(gated=True, **{name: load(feed) for name, feed in FEEDS.items()})


def quarantined(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Records a feed's contract turned away, with the reasons."""
    fields = T.StructType(
        [T.StructField(K.RECORD, T.StringType()), T.StructField(K.ERRORS, T.ArrayType(T.StringType()))]
    )
    return read_day_folders(spark, f"{root}/{FEEDS[name].folder}", fields, below="status=quarantined")


def register_views(frames: dict[str, DataFrame]) -> None:
    """Staging frames as temporary views; nothing is computed until they are queried."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
