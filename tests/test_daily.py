import datetime as dt

import pytest
from helpers import rows

from tickloom.operators import merge as M
from tickloom.operators import quality as Q
from tickloom.plans import daily
from tickloom.sources.lake import Sources

DAY0 = dt.date(2024, 1, 1)
COINS = {"bitcoin": 40000.0, "ethereum": 2000.0}


def sources(spark, days, late=0.0, skip=()):
    """Two ticks per coin and day; ``late`` is added to the prices of day 3."""
    ticks, posts, index, trending = [], [], [], []
    for i in days:
        d = DAY0 + dt.timedelta(days=i)
        for c, p in COINS.items():
            if (c, i) not in skip:
                bump = late if i == 3 else 0.0
                ticks += [(c.title(), p + i * 10 + bump, f"{d} 00:00:00", d), (c, p + i * 20, f"{d} 12:00:00", d)]
        posts += [(f"p{i}-{j}", "t", 10 * j, f"{d} 0{j}:00:00", d) for j in range(i % 4)]
        if i % 5:
            index.append((f"{int(dt.datetime.combine(d, dt.time(), dt.timezone.utc).timestamp())}", 30 + i, "Fear", d))
        if i % 2:
            trending.append(("Bitcoin", "Bitcoin", "btc", 1, i, f"{d} 01:00:00", d))
    return Sources(
        raw_prices=lambda: spark.createDataFrame(ticks, "symbol string, price double, timestamp string, dt date"),
        raw_posts=lambda: spark.createDataFrame(posts, "id string, title string, score int, created_utc string, dt date"),
        raw_index=lambda: spark.createDataFrame(index, "timestamp string, value int, value_classification string, dt date"),
        raw_trending=lambda: spark.createDataFrame(
            trending, "coin_id string, name string, symbol string, market_cap_rank int, score int, timestamp string, dt date"
        ),
    )


def content(spark, fact):
    return rows(fact.read(spark).select(*fact.schema.names))


def built(spark, root, *stages):
    w = daily.Warehouse(str(root))
    for s in stages:
        daily.build(spark, w, s)
    return w


def test_incremental_equals_full_refresh_without_gaps(spark, tmp_path):
    grown = built(spark, tmp_path / "inc", sources(spark, range(10)), sources(spark, range(12)))
    full = built(spark, tmp_path / "full", sources(spark, range(12)))
    assert content(spark, grown.crypto_daily) == content(spark, full.crypto_daily)
    assert content(spark, grown.market_insights) == content(spark, full.market_insights)


def test_incremental_and_full_differ_when_days_are_missing(spark, tmp_path):
    """Rolling frames count rows: a full build sees rows older than the incremental read."""
    gaps = {("bitcoin", i) for i in range(2, 9)}
    grown = built(spark, tmp_path / "inc", sources(spark, range(10), skip=gaps), sources(spark, range(12), skip=gaps))
    full = built(spark, tmp_path / "full", sources(spark, range(12), skip=gaps))
    assert content(spark, grown.crypto_daily) == content(spark, full.crypto_daily)
    assert content(spark, grown.market_insights) != content(spark, full.market_insights)


def test_late_prices_reach_the_short_lookback_only(spark, tmp_path):
    w = built(spark, tmp_path / "w", sources(spark, range(5)))
    before = {r.record_id: r.avg_price for r in w.market_insights.read(spark).collect()}
    late = sources(spark, range(5), late=100.0)
    daily.build(spark, w, late)
    full = built(spark, tmp_path / "full", late)
    assert content(spark, w.crypto_daily) == content(spark, full.crypto_daily)
    # The insights re-emit the latest day alone, so day 3 keeps its old average ...
    assert {r.record_id: r.avg_price for r in w.market_insights.read(spark).collect()} == before
    # ... unless the emitted range is widened.
    daily.refresh_market_insights(spark, w, late, emit_lookback_days=2)
    assert content(spark, w.market_insights) == content(spark, full.market_insights)


def test_backfill_corrects_old_days_and_the_windows_after_them(spark, tmp_path):
    w = built(spark, tmp_path / "w", sources(spark, range(20)))
    late = sources(spark, range(20), late=100.0)
    full = built(spark, tmp_path / "full", late)
    day3 = DAY0 + dt.timedelta(days=3)
    daily.backfill(spark, w, late, day3, day3)
    assert content(spark, w.crypto_daily) == content(spark, full.crypto_daily)
    assert content(spark, w.market_insights) == content(spark, full.market_insights)


def test_backfill_last_days(spark, tmp_path):
    w = built(spark, tmp_path / "w", sources(spark, range(6)))
    late = sources(spark, range(6), late=7.0)
    daily.backfill_last(spark, w, late, 3, DAY0 + dt.timedelta(days=5))
    assert content(spark, w.crypto_daily) == content(spark, built(spark, tmp_path / "full", late).crypto_daily)


def test_facts_by_hand(spark, tmp_path):
    w = built(spark, tmp_path / "w", sources(spark, range(3)))
    got = {(r.report_date.day, r.coin_id): r for r in w.market_insights.read(spark).collect()}
    r = got[3, "bitcoin"]
    # Day index 2: ticks 40020 and 40040; two posts of score 0 and 10; index 32; not trending.
    assert (r.avg_price, r.reddit_posts, r.reddit_engagement, r.fng_value, r.is_trending) == (40030.0, 2, 10, 32, False)
    assert r.sentiment_score == round(0.7 * 32 + 0.3 * (2 * 5 + 1))
    assert r.avg_price_7d == pytest.approx((40000 + 40015 + 40030) / 3)
    assert r.avg_reddit_posts_7d == 1.0 and r.price_social_corr_7d == pytest.approx(1.0)
    first = got[1, "ethereum"]
    assert (first.fng_value, first.fng_classification, first.reddit_posts) == (50, "Neutral", 0)
    assert (got[2, "bitcoin"].is_trending, got[2, "bitcoin"].trending_score) == (True, 1)


def test_run_passes_clean_data_and_all_checks(spark, tmp_path):
    w = daily.Warehouse(str(tmp_path))
    report = daily.run(spark, w, sources(spark, range(4)), report_date=DAY0 + dt.timedelta(days=3))
    assert report.count() == 56 and report.where("failures > 0").count() == 0
    assert spark.read.parquet(w.dim("dim_coin")).count() == 2
    assert rows(spark.read.parquet(w.dim("dim_date")), "date")[0] == (DAY0, 2024, 1, 1)


def test_checks_limited_to_recent_landings(spark, tmp_path):
    src = sources(spark, range(6))
    w = built(spark, tmp_path, src)
    recent = daily.tables(spark, w, src, DAY0 + dt.timedelta(days=4))
    assert recent["raw_prices"].select("dt").distinct().count() == 3  # two days and one of slack
    assert recent["stg_prices"].count() == 12
    assert recent["fct_crypto_daily"].count() == 12


def test_run_stops_on_a_missing_coin_and_on_an_empty_source(spark, tmp_path):
    day3 = DAY0 + dt.timedelta(days=3)
    with pytest.raises(Q.QualityError, match="latest_day_has_expected_coins"):
        daily.run(spark, daily.Warehouse(str(tmp_path / "a")), sources(spark, range(4), skip={("ethereum", 3)}), report_date=day3)
    with pytest.raises(Q.QualityError, match="raw_prices returned no rows"):
        daily.run(spark, daily.Warehouse(str(tmp_path / "b")), sources(spark, []), report_date=day3)


def test_run_needs_rows_of_its_day(spark, tmp_path):
    with pytest.raises(Q.QualityError, match="raw_prices of 2024-01-10 returned no rows"):
        daily.run(spark, daily.Warehouse(str(tmp_path / "a")), sources(spark, range(4)), report_date=dt.date(2024, 1, 10))
    with pytest.raises(Q.QualityError, match="returned no rows"):  # today, unless told otherwise
        daily.run(spark, daily.Warehouse(str(tmp_path / "b")), sources(spark, range(4)))


def test_run_stages_raw_ticks_once_and_leaves_no_scratch(spark, tmp_path):
    import os

    src, staged = sources(spark, range(4)), []
    original = daily.staged

    def counting(*args):
        staged.append(args)
        return original(*args)

    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(f"{root}/{spark.sparkContext.applicationId}")) if os.path.isdir(f"{root}/{spark.sparkContext.applicationId}") else set()
    daily.staged = counting
    try:
        daily.run(spark, daily.Warehouse(str(tmp_path)), src, report_date=DAY0 + dt.timedelta(days=3))
    finally:
        daily.staged = original
    assert len(staged) == 1
    assert set(os.listdir(f"{root}/{spark.sparkContext.applicationId}")) <= before


def test_backfill_reaches_the_dimensions(spark, tmp_path):
    from tickloom.plans import checks

    w = built(spark, tmp_path, sources(spark, range(10, 14)))
    every = sources(spark, range(14))
    daily.backfill(spark, w, every, DAY0, DAY0 + dt.timedelta(days=9))
    report = Q.run_checks(daily.tables(spark, w, every), checks.RELATIONSHIPS)
    assert [r.failures for r in report.collect()] == [0, 0, 0, 0]
    assert spark.read.parquet(w.dim("dim_date")).count() == 14


def test_bronze_is_pruned_before_staging(spark):
    raw = sources(spark, range(10))("raw_prices")
    kept = daily.since_landed(raw, DAY0 + dt.timedelta(days=5)).select("dt").distinct()
    assert kept.count() == 6  # five days and one of slack
    assert daily.since_landed(raw, None) is raw


def test_full_refresh_replaces_everything(spark, tmp_path):
    w = built(spark, tmp_path, sources(spark, range(5)))
    daily.build(spark, w, sources(spark, range(2)), full_refresh=True)
    assert w.crypto_daily.watermark(spark) == DAY0 + dt.timedelta(days=1)
    assert w.crypto_daily.read(spark).count() == 4


def test_facts_are_sorted_within_day_files(spark, tmp_path):
    w = built(spark, tmp_path, sources(spark, range(3)))
    coins = [r.coin_id for r in spark.read.parquet(f"{w.crypto_daily.path}/report_date=2024-01-02").collect()]
    assert coins == sorted(coins)


def test_bounds_are_literals_in_the_plan(spark, tmp_path):
    from tickloom.plans import staging

    path = str(tmp_path / "bronze")
    sources(spark, range(10))("raw_prices").write.partitionBy("dt").parquet(path)
    src = Sources(raw_prices=lambda: spark.read.parquet(path))
    raw = daily.since_landed(src("raw_prices"), DAY0 + dt.timedelta(days=8))
    plan = staging.stage_prices(raw)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert M.Bounds() == M.Bounds(None, None, None)
