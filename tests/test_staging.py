import datetime as dt
import random

from helpers import rows

from tickloom.operators.dedup import latest_per_key
from tickloom.plans import staging

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def raw_prices(spark, data):
    return spark.createDataFrame(data, "symbol string, price double, timestamp string")


def test_prices_normalise_and_keep_highest(spark):
    raw = raw_prices(
        spark,
        [
            ("Bitcoin", 1.0, "2024-01-01 00:00:00"),
            ("bitcoin", 3.0, "2024-01-01 00:00:00"),
            ("bitcoin", None, "2024-01-01 00:00:00"),
            ("bitcoin", 2.0, "2024-01-01 00:00:01"),
            ("eth", None, "2024-01-01 00:00:00"),
        ],
    )
    got = rows(staging.stage_prices(raw).select("record_id", "coin_id", "price_usd"), "record_id")
    assert got == [
        ("bitcoin_2024-01-01 00:00:00+00", "bitcoin", 3.0),
        ("bitcoin_2024-01-01 00:00:01+00", "bitcoin", 2.0),
        ("eth_2024-01-01 00:00:00+00", "eth", None),
    ]


def test_prices_without_identity_collapse_to_one_row(spark):
    raw = raw_prices(
        spark,
        [
            (None, 1.0, "2024-01-01 00:00:00"),
            (None, 5.0, "2024-01-02 00:00:00"),
            (None, 7.0, "2024-01-02 00:00:00"),
            ("bitcoin", 9.0, None),
            ("bitcoin", 2.0, "2024-01-02 00:00:00"),
        ],
    )
    got = rows(staging.stage_prices(raw).select("record_id", "coin_id", "price_usd"))
    assert got == [("bitcoin_2024-01-02 00:00:00+00", "bitcoin", 2.0), (None, None, 7.0)]


def test_posts_keep_newest_version(spark):
    raw = spark.createDataFrame(
        [
            ("a", "old", 9, "2024-01-01 00:00:00"),
            ("a", "new", 1, "2024-01-02 00:00:00"),
            ("b", "x", 1, "2024-01-01 00:00:00"),
            ("b", "y", 2, "2024-01-01 00:00:00"),
            ("c", "p", 2, "2024-01-01 00:00:00"),
            ("c", "q", 2, "2024-01-01 00:00:00"),
            ("d", "undated", None, None),
        ],
        "id string, title string, score int, created_utc string",
    )
    got = rows(staging.stage_posts(raw).select("post_id", "title", "score"), "post_id")
    assert got == [("a", "new", 1), ("b", "y", 2), ("c", "q", 2), ("d", "undated", None)]


def test_posts_without_title_agree_on_all_other_columns(spark, sf_dir):
    from tickloom.sources import sample

    raw = sample.posts(spark, sf_dir)
    assert rows(staging.stage_posts(raw).drop("title")) == rows(staging.stage_posts(raw, with_title=False))


def test_index_keeps_last_reading_of_the_utc_day(spark):
    raw = spark.createDataFrame(
        [("1704067200", 10, "a"), ("1704153599", 20, "b"), ("1704153600", 30, "c")],
        "timestamp string, value int, value_classification string",
    )
    got = rows(staging.stage_index(raw).select("record_id", "fng_value"), "record_id")
    assert got == [("2024-01-01", 20), ("2024-01-02", 30)]


def test_trending_keeps_last_per_coin_and_day(spark):
    raw = spark.createDataFrame(
        [
            ("BTC", "Bitcoin", "btc", 1, 3, "2024-01-01 01:00:00"),
            ("btc", "Bitcoin", "btc", 1, 4, "2024-01-01 02:00:00"),
            ("btc", "Bitcoin", "btc", 1, 5, "2024-01-02 01:00:00"),
        ],
        "coin_id string, name string, symbol string, market_cap_rank int, score int, timestamp string",
    )
    got = rows(staging.stage_trending(raw).select("record_id", "symbol", "trending_score"), "record_id")
    assert got == [("btc_2024-01-01", "BTC", 4), ("btc_2024-01-02", "BTC", 5)]


def test_staging_is_idempotent_under_reappend(spark, sf_dir):
    from tickloom.sources import sample

    for stage, source in (
        (staging.stage_prices, sample.prices),
        (staging.stage_posts, sample.posts),
        (staging.stage_index, sample.index),
        (staging.stage_trending, sample.trending),
    ):
        raw = source(spark, sf_dir)
        assert rows(stage(raw.unionByName(raw))) == rows(stage(raw))


def test_latest_per_key_against_brute_force(spark):
    rnd = random.Random(7)
    data = [
        (rnd.choice("aaaaaab"), rnd.choice([None, 1, 2, 3]), rnd.choice([None, 1.5, 2.5]), rnd.randrange(5))
        for _ in range(400)
    ]
    df = spark.createDataFrame(data, "k string, o1 int, o2 double, v int").repartition(7)
    got = dict((r[0], r[1:]) for r in rows(latest_per_key(df, ["k"], ["o1", "o2"])))

    def rank(r):
        return [(x is not None, x if x is not None else 0) for x in r[1:]]

    for k in "ab":
        assert got[k] == max((r for r in data if r[0] == k), key=rank)[1:]


def test_key_predicates_reach_the_scan(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "p")
    spark.range(10).select(
        F.lit("a").alias("symbol"), F.lit(1.0).alias("price"), F.timestamp_seconds("id").alias("timestamp")
    ).write.parquet(path)
    staged = staging.stage_prices(spark.read.parquet(path)).where("recorded_at >= timestamp'2024-01-01 00:00:00'")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp,2024-01-01" in plan
