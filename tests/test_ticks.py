import datetime as dt
import random

import pytest
from helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators.ticks import jumps, with_previous

T0 = dt.datetime(2024, 1, 1)


def ticks(spark, data):
    return spark.createDataFrame(data, "coin_id string, recorded_at timestamp, price_usd double")


def plain_lag(df):
    w = Window.partitionBy("coin_id").orderBy(F.col("recorded_at").asc_nulls_first())
    return df.withColumn("prev_price", F.lag("price_usd").over(w))


@pytest.mark.parametrize("buckets", [(), ("HOUR",), ("MINUTE",), ("MINUTE", "DAY"), ("SECOND", "HOUR"), ("SECOND", "MINUTE", "HOUR")])
def test_same_as_a_key_wide_lag(spark, buckets):
    rnd = random.Random(3)
    data = {}
    for _ in range(600):
        coin = rnd.choice(["hot"] * 8 + ["cold", "rare"])
        spread = 86400 * 4 if rnd.random() < 0.8 else 60
        at = T0 + dt.timedelta(seconds=rnd.randrange(spread), microseconds=rnd.choice([0, 5, 500000]))
        data[coin, at] = rnd.choice([None, 0.0, rnd.uniform(1, 100)])
    df = ticks(spark, [(c, t, p) for (c, t), p in data.items()]).repartition(5)
    got = with_previous(df, "coin_id", "recorded_at", "price_usd", buckets=buckets)
    assert rows(got) == rows(plain_lag(df))


def test_null_time_and_null_key(spark):
    df = ticks(spark, [("a", None, 1.0), ("a", T0, 2.0), (None, T0, 3.0), (None, T0 + dt.timedelta(hours=2), 4.0)])
    assert rows(with_previous(df, "coin_id", "recorded_at", "price_usd")) == rows(plain_lag(df))


def test_tick_rows_never_pass_a_key_wide_window(spark):
    df = ticks(spark, [("a", T0, 1.0)])
    plan = with_previous(df, "coin_id", "recorded_at", "price_usd")._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("windowspecdefinition(")[1].split("ASC")[0] for line in plan.splitlines() if "lag(price_usd" in line]
    # Ticks by second, seconds by hour, and only hours by coin alone.
    assert ["_second" in k or "_hour" in k for k in keys] == [True, True, False]


def test_jumps(spark):
    df = spark.createDataFrame(
        [(10.0, None), (16.0, 10.0), (15.0, 10.0), (4.0, 10.0), (5.0, 0.0)], "price_usd double, prev_price double"
    )
    assert rows(jumps(df, "price_usd")) == [(16.0, 10.0), (4.0, 10.0)]
