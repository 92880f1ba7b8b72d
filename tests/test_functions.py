import math

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tickloom.functions import (
    band,
    epoch_text,
    full_window_mean,
    money_text,
    rolling_corr,
    rolling_mean,
    rows_window,
    safe_bigint,
    sentiment_score,
    split_list,
    surrogate_key,
    ticker,
    utc_text,
)


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_surrogate_key_known_value_and_null(spark):
    import hashlib

    r = one(
        spark,
        full=surrogate_key(F.lit("bitcoin"), F.lit("2024-01-01").cast("date")),
        null=surrogate_key(F.lit("bitcoin"), F.lit(None).cast("date")),
    )
    assert r.full == hashlib.md5(b"bitcoin-2024-01-01").hexdigest()
    assert r.null == hashlib.md5(b"bitcoin-_dbt_utils_surrogate_key_null_").hexdigest()


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:00+00"),
        ("2024-01-01 00:00:00.5", "2024-01-01 00:00:00.500+00"),
        ("2024-01-01 00:00:00.123456", "2024-01-01 00:00:00.123456+00"),
        ("1969-12-31 23:59:59", "1969-12-31 23:59:59+00"),
    ],
)
def test_utc_text(spark, text, expected):
    assert one(spark, v=utc_text(F.lit(text).cast("timestamp"))).v == expected


def test_sentiment_score_caps_above_only_and_rounds_half_away(spark):
    r = one(
        spark,
        cap=sentiment_score(F.lit(100), F.lit(1000), F.lit(0)),
        half=sentiment_score(F.lit(0), F.lit(0), F.lit(50)),  # 0.3 * 5 = 1.5
        low=sentiment_score(F.lit(0), F.lit(0), F.lit(-1000)),
    )
    assert (r.cap, r.half, r.low) == (100, 2, -30)


def test_ticker(spark):
    r = one(spark, a=ticker(F.lit("Avalanche-2")), b=ticker(F.lit("pepe")), c=ticker(F.lit(None).cast("string")))
    assert (r.a, r.b, r.c) == ("AVAX", "PEPE", None)


def test_band_edges(spark):
    df = spark.createDataFrame([(34,), (35,), (65,), (66,), (None,)], "v int")
    got = df.select("v", band("v", 35, 65, ("red", "yellow", "green")).alias("b"))
    assert dict(rows(got)) == {34: "red", 35: "yellow", 65: "yellow", 66: "green", None: None}


def test_money_text(spark):
    df = spark.createDataFrame([(0.093316,), (1.0,), (71285.0,), (1234567.891,)], "v double")
    assert [r[0] for r in df.select(money_text("v")).collect()] == ["$0.0933", "$1.00", "$71,285.00", "$1,234,567.89"]


def test_split_list(spark):
    assert one(spark, v=split_list(F.lit(" bitcoin, ,ethereum ,"))).v == ["bitcoin", "ethereum"]


def test_epoch_text(spark):
    df = spark.createDataFrame([("1775602830.0",), ("1775602830",), ("abc",), (None,), ("nan",), ("1e30",)], "v string")
    assert [r[0] for r in df.select(epoch_text("v")).collect()] == ["2026-04-07 23:00:30"] * 2 + [None] * 4


def test_safe_bigint(spark):
    df = spark.createDataFrame([("12",), ("12.0",), ("12.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(safe_bigint("v")).collect()] == [12, 12, None, None, None]


def _series(spark, pairs):
    return spark.createDataFrame([("c", i, x, y) for i, (x, y) in enumerate(pairs)], "k string, d int, x double, y double")


def test_rolling_corr_undefined_is_flat_value(spark):
    df = _series(spark, [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)])
    w = rows_window(["k"], "d", 7)
    assert [r.c for r in df.withColumn("c", rolling_corr("x", "y", w)).collect()] == [0.0, 0.0, 0.0]
    nan = df.withColumn("c", rolling_corr("x", "y", w, flat_value=float("nan"))).orderBy("d").collect()
    assert nan[0].c == 0.0 and all(math.isnan(r.c) for r in nan[1:])


def test_rolling_corr_skips_incomplete_pairs(spark):
    pairs = [(1.0, 2.0), (None, 9.0), (2.0, 4.0), (7.0, None), (3.0, 7.0)]
    w = rows_window(["k"], "d", 7)
    got = [r.c for r in _series(spark, pairs).withColumn("c", rolling_corr("x", "y", w)).orderBy("d").collect()]
    assert got[-1] == pytest.approx(0.9933992677987828)


def test_rolling_mean_partial_and_full(spark):
    df = _series(spark, [(float(i), 0.0) for i in range(9)])
    w = rows_window(["k"], "d", 7)
    got = df.select("d", rolling_mean("x", w).alias("p"), full_window_mean("x", w, 7).alias("f")).orderBy("d").collect()
    assert [r.p for r in got][:3] == [0.0, 0.5, 1.0]
    assert [r.f for r in got] == [None] * 6 + [3.0, 4.0, 5.0]


def test_rolling_columns_share_one_window_node(spark):
    w = rows_window(["k"], "d", 7)
    df = _series(spark, [(1.0, 2.0)]).select(rolling_mean("x", w), rolling_mean("y", w), rolling_corr("x", "y", w))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
