"""The driver tables seen as raw sources. Every view uses its whole table.

events        -> prices (an hour's events of a type are copies of one tick) and trending
conversations -> posts (turns are versions of a post)
orders        -> index readings, on 28 of the 30 price days
documents     -> lake posts for mention counts
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.lake import Sources

FIRST_DAY = "2024-01-01"
EXPECTED = "click, view,missing_coin , purchase,"
NAMES = {"click": "CLK", "view": "VW"}
MENTIONS = {"ETH": ("eth",), "DOT": ("dot", "polkadot"), "THE": ("the ", "der "), "NONE": ("qqqq", "bitcoin")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    # Zone-less Parquet timestamps are UTC instants here.
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def _uneven_day(key: str):
    """Squares mod 30 spread unevenly: days differ in volume and most have no row."""
    r = F.col(key) % 30
    return (r * r % 30).cast("int")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows as a feed delivers them, NULLs included."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.date_trunc("HOUR", "ts").alias("timestamp"),
        F.to_date("ts").alias("dt"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.timestamp_add("DAY", _uneven_day("conv_id"), F.lit(FIRST_DAY).cast("timestamp"))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("id"),
        F.col("text").alias("title"),
        F.length("text").cast("bigint").alias("score"),
        F.timestamp_add("MINUTE", F.col("turn").cast("int"), day).alias("created_utc"),
        F.concat(F.lit("/c/"), F.col("conv_id").cast("string")).alias("url"),
        F.to_date(day).alias("dt"),
    )


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        (F.lit(1704067200) + (key % 28) * 86400 + (key % 86400) * 7919 % 86400).alias("timestamp"),
        (F.floor("o_totalprice") % 101).cast("bigint").alias("value"),
        F.col("o_orderpriority").alias("value_classification"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), ((key % 28) + 1).cast("int")).alias("dt"),
    )


def trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list published every second day, on odd or even days depending on the type."""
    e = events(spark, sf_dir)
    back = (F.dayofmonth("ts") + F.length("event_type")) % 2
    return e.select(
        F.col("event_type").alias("coin_id"),
        F.initcap("event_type").alias("name"),
        F.substring("event_type", 1, 3).alias("symbol"),
        F.col("user_id").alias("market_cap_rank"),
        (F.col("user_id") % 15).alias("score"),
        F.timestamp_add("DAY", -back, F.col("ts")).alias("timestamp"),
        F.to_date("ts").alias("dt"),
    )


def lake_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("title"),
        F.col("n_chars").alias("score"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), _uneven_day("doc_id")).alias("dt"),
    )


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        raw_prices=lambda: prices(spark, sf_dir),
        raw_posts=lambda: posts(spark, sf_dir),
        raw_index=lambda: index(spark, sf_dir),
        raw_trending=lambda: trending(spark, sf_dir),
    )
