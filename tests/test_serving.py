import datetime as dt

from helpers import rows
from pyspark.sql import functions as F

from tickloom.operators import serving as S

D = [dt.date(2024, 1, i) for i in range(1, 32)]


def test_coin_history_is_a_top_n(spark, tmp_path):
    fact = spark.createDataFrame([(d, c, 1.0, 2, 3) for d in D for c in ("bitcoin", "x'; --")], "report_date date, coin_id string, avg_price double, reddit_posts int, reddit_score int")
    got = S.coin_history(fact, "x'; --")
    assert got.columns == ["date", "coin", "price", "reddit_posts", "reddit_score"]
    assert [r.date for r in got.collect()] == [str(d) for d in reversed(D[-10:])]
    fact.write.parquet(str(tmp_path / "fact"))
    stored = S.coin_history(spark.read.parquet(str(tmp_path / "fact")), "bitcoin")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "EqualTo(coin_id,bitcoin)" in plan
    assert S.coin_history(fact, "nobody").count() == 0


def index(spark, data):
    return spark.createDataFrame(data, "timestamp string, value int, value_classification string, dt date")


def test_index_history_and_dedup(spark):
    df = index(spark, [("1704067200", 10, "a", D[1]), ("1704067300", 20, "b", D[1]), ("1704067200", 10, "a", D[2]), ("1704153600", 30, "c", D[2])])
    assert [r.value for r in S.index_history(df, 3).collect()] == [30, 10, 20]
    assert [r.value for r in S.index_history(df, dedup=True).collect()] == [30, 20]


def test_trend_mean_runs_over_the_trimmed_series(spark):
    df = index(spark, [(str(1704067200 + 86400 * i), i, "c", d) for i, d in enumerate(D)])
    got = S.index_trend(S.index_history(df, 90), 8).collect()
    assert [r.value for r in got] == list(range(23, 31))
    assert [r.ma for r in got] == [None] * 6 + [26.0, 27.0]


def prices(spark, data):
    return spark.createDataFrame(data, "symbol string, price double, timestamp string, dt date")


def test_listing_keeps_every_copy_in_order(spark):
    df = prices(spark, [("Bitcoin", 1.0, "t1", D[0])] * 5 + [("pepe", 2.0, "t2", D[0]), ("bitcoin", None, "t0", D[1])])
    assert [(r.symbol, r.price) for r in S.price_listing(df).collect()] == [("BTC", None), ("PEPE", 2.0)] + [("BTC", 1.0)] * 5


def test_listing_splits_a_huge_group_of_copies(spark):
    df = spark.range(350_000).select(F.lit("bitcoin").alias("symbol"), F.lit(1.0).alias("price"), F.lit("t").alias("timestamp"), F.lit(D[0]).alias("dt"))
    listing = S.price_listing(df)
    assert listing.count() == 350_000
    plan = listing._jdf.queryExecution().optimizedPlan().toString()
    assert "_block" in plan


def test_latest_prices(spark):
    df = prices(spark, [("bitcoin", 1.0, "t1", D[0]), ("bitcoin", 0.5, "t0", D[1]), ("eth", 1234.5, "t1", D[1]), ("eth", 9.0, "t1", D[0])])
    got = rows(S.latest_prices(S.relabelled(df)).select("symbol", "price", "price_label"))
    assert got == [("BTC", 0.5, "$0.5000"), ("ETH", 1234.5, "$1,234.50")]


def posts(spark, data):
    return spark.createDataFrame(data, "dt date, title string")


def test_mentions_are_substring_and_case_insensitive(spark):
    df = posts(spark, [(D[0], "BTC and Bitcoin"), (D[0], "something else"), (D[0], None), (D[1], "Solana, ADA; doge")])
    got = {r.report_date: r for r in S.mention_counts(df).collect()}
    assert (got[D[0]].btc_mentions, got[D[0]].eth_mentions) == (1, 1)
    assert (got[D[1]].sol_mentions, got[D[1]].ada_mentions, got[D[1]].doge_mentions, got[D[1]].btc_mentions) == (1, 1, 1, 0)


def test_mention_totals_last_rows_only(spark):
    df = posts(spark, [(D[0], "btc"), (D[1], "btc"), (D[5], "btc eth"), (D[6], "none")])
    counts = S.mention_counts(df)
    assert rows(S.mention_totals(counts, ["BTC", "ETH", "NOPE"], days=2)) == [("BTC", 1), ("ETH", 1)]
    assert rows(S.mention_totals(counts, days=90))[1] == ("BTC", 3)
    assert S.has_mentions(S.mention_totals(counts, ["SOL"])).first()[0] is False
    assert S.has_mentions(S.mention_totals(counts, ["BTC"])).first()[0] is True


def test_price_vs_mentions(spark):
    listing = S.relabelled(prices(spark, [("bitcoin", 1.0, "t", D[0]), ("bitcoin", 3.0, "t", D[0]), ("bitcoin", 5.0, "t", D[1]), ("eth", 9.0, "t", D[1])]))
    counts = S.mention_counts(posts(spark, [(D[1], "btc"), (D[2], "btc")]))
    assert [tuple(r) for r in S.price_vs_mentions(listing, counts).collect()] == [(D[0], 2.0, 0), (D[1], 5.0, 1)]
    assert [tuple(r) for r in S.price_vs_mentions(listing, counts, days=1).collect()] == [(D[1], 5.0, 1)]


def test_health(spark):
    report = spark.createDataFrame([("a", "x", 1), ("a", "y", 0), ("b", "x", 0), ("c", "soft", 2)], "table string, check string, failures long")
    assert dict(rows(S.health(report, ["soft"]))) == {"a": "Failed", "b": "Healthy", "c": "Warning"}


def test_day_over_day_with_zero_price(spark):
    fact = spark.createDataFrame([(D[0], "a", 0.0), (D[1], "a", 2.0), (D[2], "a", 3.0)], "report_date date, coin_id string, avg_price double")
    assert [r.change_1d for r in S.day_over_day(fact).orderBy("report_date").collect()] == [None, None, 0.5]
