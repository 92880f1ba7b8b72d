"""Payload files to facts, through contract and bronze."""

import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tickloom.operators import contracts as K
from tickloom.operators.quality import QualityError
from tickloom.plans import daily, ingest

DAYS = [dt.date(2024, 1, i) for i in (1, 2, 3)]


def docs(spark, value):
    return spark.createDataFrame([(json.dumps(value),)], "payload string")


def seconds(day):
    return int(dt.datetime.combine(day, dt.time(6), dt.timezone.utc).timestamp())


def land_day(spark, root, day, bitcoin):
    at = F.lit(f"{day} 08:00:00").cast("timestamp")
    posts = [{"data": {"id": f"{day}-{i}", "title": "btc", "score": i, "created_utc": float(seconds(day))}} for i in range(3)]
    item = {"id": "Bitcoin", "name": "Bitcoin", "symbol": "btc", "market_cap_rank": 1, "score": 0}
    return [
        ingest.ingest("raw_prices", docs(spark, {"Bitcoin": {"usd": bitcoin}, "ethereum": {"usd": 10}, "bad": {}}), root, day, fetched_at=at),
        ingest.ingest("raw_posts", docs(spark, {"data": {"children": posts + [{"data": {"id": ""}}]}}), root, day),
        ingest.ingest("raw_index", docs(spark, {"data": [{"value": "40", "value_classification": "Fear", "timestamp": str(seconds(day))}]}), root, day),
        ingest.ingest("raw_trending", docs(spark, {"coins": [{"item": item}]}), root, day, fetched_at=at),
    ]


def test_payloads_to_facts(spark, tmp_path):
    root, w = str(tmp_path / "bronze"), daily.Warehouse(str(tmp_path / "wh"))
    for i, day in enumerate(DAYS):
        counts = land_day(spark, root, day, 100 + i)
        assert counts[:2] == [{"records": 3, "quarantined": 1}, {"records": 4, "quarantined": 1}]
        daily.build(spark, w, ingest.bronze(spark, root))
    land_day(spark, root, DAYS[2], 140)  # the same day again replaces it
    daily.run(spark, w, ingest.bronze(spark, root), report_date=DAYS[2])
    got = rows(
        w.market_insights.read(spark)
        .where("coin_id = 'bitcoin'")
        .select("report_date", "avg_price", "reddit_posts", "reddit_engagement", "fng_value", "is_trending", "trending_score"),
        "report_date",
    )
    assert got == [(d, p, 3, 3, 40, True, 0) for d, p in zip(DAYS, (100.0, 101.0, 140.0))]
    assert rows(ingest.quarantined(spark, root, "raw_prices").select(K.ERRORS).distinct()) == [(["price: missing"],)]


def test_bronze_range(spark, tmp_path):
    for day in DAYS:
        land_day(spark, str(tmp_path), day, 1)
    some = ingest.bronze(spark, str(tmp_path), DAYS[1], DAYS[2])("raw_prices")
    assert rows(some.select("dt").distinct(), "dt") == [(DAYS[1],), (DAYS[2],)]
    staged = daily.staged(ingest.bronze(spark, str(tmp_path)))
    ingest.register_views(staged)
    assert spark.sql("select count(*) from stg_prices where coin_id = 'bitcoin'").first()[0] == 3


def test_empty_and_all_invalid_feeds_raise(spark, tmp_path):
    with pytest.raises(QualityError, match="coingecko returned no rows"):
        ingest.ingest("raw_prices", docs(spark, {}), str(tmp_path), DAYS[0])
    with pytest.raises(K.AllRecordsInvalid):
        ingest.ingest("raw_prices", docs(spark, {"a": {"usd": -1}}), str(tmp_path), DAYS[0])


def test_numbers_that_are_none_are_quarantined(spark, tmp_path):
    posts = [{"data": {"id": "a", "score": "many"}}, {"data": {"id": "b", "score": None}}, {"data": {"id": "c", "score": 2.0}}]
    counts = ingest.ingest("raw_posts", docs(spark, {"data": {"children": posts}}), str(tmp_path), DAYS[0])
    assert counts == {"records": 3, "quarantined": 1}
    assert rows(ingest.bronze(spark, str(tmp_path))("raw_posts").select("id", "score")) == [("b", None), ("c", 2)]
    item = {"id": "a", "name": "A", "symbol": "a", "market_cap_rank": "n/a"}
    counts = ingest.ingest("raw_trending", docs(spark, {"coins": [{"item": item}, {"item": {**item, "market_cap_rank": 3}}]}), str(tmp_path), DAYS[0])
    assert counts == {"records": 2, "quarantined": 1}


def test_posts_fall_back(spark, tmp_path):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    counts = ingest.ingest_posts_or_fallback(spark, docs(spark, {"data": {"children": []}}), str(tmp_path), DAYS[0], at=at)
    assert counts == {"records": 2, "quarantined": 0}
