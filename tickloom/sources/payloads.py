"""API payload text to flat raw rows.

Each function takes a frame with one JSON document per row in ``col``; fields the
document lacks become NULL and are judged by the contract, not here. A text that is no JSON
object unfolds to nothing; :func:`broken_documents` gives these texts, for the quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import fixed_values as V
from tickloom import schemas
from tickloom.functions.columns import SECOND_FORMAT, epoch_text, json_int
from tickloom.operators.contracts import ERRORS, RECORD
from tickloom.sources.lake import DAY_FOLDER, DAY_IN_PATH, read_documents, read_mixed_json


def _stamped(df: DataFrame, at: Column | None) -> DataFrame:
    """Fetch time as text columns, set once per document before it is unfolded."""
    at = F.current_timestamp() if at is None else at
    stamped = df.withColumn("_fetched", F.date_format(at, SECOND_FORMAT))
    return stamped.withColumn("_fetched_day", F.substring("_fetched", 1, 10))


def broken_documents(df: DataFrame, col: str = "payload") -> DataFrame:
    """Documents that are no JSON object, as ``_record`` (the text) and ``_errors``."""
    broken = df.where(F.json_object_keys(col).isNull())
    return broken.select(F.col(col).alias(RECORD), F.array(F.lit("document: not a JSON object")).alias(ERRORS))


def flatten_prices(df: DataFrame, col: str = "payload", fetched_at: Column | None = None) -> DataFrame:
    """{coin: {usd}} to one row per coin, stamped with the fetch time. The price is text, for the contract to read."""
    entries = F.explode(F.from_json(col, schemas.PRICE_PAYLOAD)).alias("symbol", "quote")
    return (
        _stamped(df, fetched_at)
        .select("_fetched", "_fetched_day", entries)
        .select(
            "symbol",
            F.col("quote.usd").alias("price"),
            F.col("_fetched").alias("timestamp"),
            F.col("_fetched_day").alias("ingestion_date"),
        )
    )


def flatten_index(df: DataFrame, col: str = "payload") -> DataFrame:
    """data[] to one row per reading; readings without whole-number value and time are dropped.

    The ingestion date is the reading's own UTC date.
    """
    items = df.select(F.inline(F.from_json(col, schemas.INDEX_PAYLOAD)["data"]))
    parsed = items.select(json_int("value").alias("value"), "value_classification", json_int("timestamp").alias("timestamp"))
    # Outside years 1..9999 there is no calendar date.
    dated = F.col("timestamp").between(-62135596800, 253402300799)
    return parsed.where(F.col("value").isNotNull() & dated).withColumn(
        "ingestion_date", F.date_format(F.timestamp_seconds("timestamp"), "yyyy-MM-dd")
    )


def flatten_posts(df: DataFrame, col: str = "payload") -> DataFrame:
    """data.children[].data to one row per post; an unreadable creation time becomes NULL."""
    children = F.from_json(col, schemas.POST_PAYLOAD)["data"]["children"]
    post = df.select(F.explode(children).alias("child")).select("child.data.*")
    return post.withColumn("created_utc", epoch_text("created_utc"))


def read_price_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Older bronze days that hold the nested price payload itself, stamped with their folder's day."""
    docs = read_documents(spark, f"{root}/{DAY_FOLDER}/*.json")
    day = F.to_timestamp(F.regexp_extract(F.col("_metadata.file_path"), DAY_IN_PATH, 1))
    return flatten_prices(docs.select("payload", day.alias("_at")), fetched_at=F.col("_at"))


def read_post_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Bronze posts of any age: creation times as epoch numbers become text, text stays."""
    posts = read_mixed_json(spark, root, schemas.RAW_POSTS)
    return posts.withColumn("created_utc", F.coalesce(epoch_text("created_utc"), "created_utc"))


def flatten_trending(df: DataFrame, col: str = "payload", fetched_at: Column | None = None) -> DataFrame:
    """coins[].item to one row per coin; entries without an item, or with an empty one, are skipped.

    An item that has keys but none of the known ones stays, for the contract to reject.
    """
    entries = F.explode(F.from_json(col, schemas.TRENDING_PAYLOAD)["coins"]["item"]).alias("item")
    items = _stamped(df, fetched_at).select("_fetched", "_fetched_day", entries).where(F.size("item") > 0)
    return items.select(
        F.col("item")["id"].alias("coin_id"),
        *[F.col("item")[c].alias(c) for c in ("name", "symbol", "market_cap_rank", "score")],
        F.col("_fetched").alias("timestamp"),
        F.col("_fetched_day").alias("ingestion_date"),
    )


def flatten_trades(df: DataFrame, col: str = "payload") -> DataFrame:
    """Trade messages {E, s, p} to ticks at second precision (UTC). Works on batch and stream.

    Empty messages are skipped, unreadable ones left to :func:`rejected_trades`.
    """
    m = df.select(F.from_json(col, schemas.TRADE_MESSAGE).alias("m")).select("m.*")
    return m.where(_readable_trade()).select(
        F.date_trunc("SECOND", F.timestamp_millis("E")).alias("event_time"),
        F.col("s").alias("symbol"),
        F.col("p").cast("double").alias("price"),
    )


def _readable_trade() -> Column:
    """Time, symbol and price are there, and time and price can be read."""
    # Outside years 1..9999 there is no time to format.
    timed = F.col("E").between(-62135596800000, 253402300799999)
    return F.coalesce(timed & F.col("s").isNotNull() & F.col("p").try_cast("double").isNotNull(), F.lit(False))


def rejected_trades(df: DataFrame, col: str = "payload") -> DataFrame:
    """Messages that are not empty and yet give no tick, as ``_record`` (the text). Works on batch and stream.

    One such message stops neither batch nor stream; a side output keeps them to be counted.
    """
    m = df.select(F.col(col).alias(RECORD), F.from_json(col, schemas.TRADE_MESSAGE).alias("m")).select(RECORD, "m.*")
    empty = F.trim(RECORD).isin("", "{}", "null") | F.col(RECORD).isNull()
    return m.where(~empty & ~_readable_trade()).select(RECORD)


def fallback_posts(spark: SparkSession, at: Column | None = None) -> DataFrame:
    """Two placeholder posts whose ids carry the day."""
    at = F.current_timestamp() if at is None else at
    listed = [
        F.struct(F.lit(coin).alias("coin"), F.lit(title).alias("title"), F.lit(url).alias("url"))
        for coin, title, url in V.FALLBACK_POSTS
    ]
    return (
        spark.range(1)
        .select(F.inline(F.array(*listed)))
        .select(
            F.format_string("fallback-%s-%s", "coin", F.date_format(at, "yyyyMMdd")).alias("id"),
            "title",
            F.lit(1).cast("bigint").alias("score"),
            F.date_format(at, SECOND_FORMAT).alias("created_utc"),
            "url",
        )
    )


def or_fallback(df: DataFrame, fallback: DataFrame) -> DataFrame:
    """``df``, or ``fallback`` when ``df`` has no row. The emptiness test stops at the first row."""
    return df.unionByName(fallback.where(~df.limit(1).exists()))
