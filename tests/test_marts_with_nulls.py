"""Facts over random raw rows full of NULLs and ties, against SQL written with row numbers."""

import datetime as dt
import math
import random

import duckdb
import pandas as pd
import pytest

from tickloom.operators.merge import Bounds
from tickloom.plans import marts, staging

T0 = dt.datetime(2024, 1, 1)
SQL = """
WITH p AS (
  SELECT lower(symbol) AS coin_id, price, ts, lower(symbol) || '_' || CAST(ts AS VARCHAR) AS rid FROM prices
), p1 AS (
  SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY rid ORDER BY ts DESC NULLS LAST, price DESC NULLS LAST, coin_id DESC NULLS LAST) = 1
), pd AS (
  SELECT CAST(ts AS DATE) AS d, coin_id, avg(price) AS avg_price FROM p1 GROUP BY 1, 2
), o AS (
  SELECT * FROM posts QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC NULLS LAST, score DESC NULLS LAST, title DESC NULLS LAST) = 1
), od AS (
  SELECT CAST(ts AS DATE) AS d, count(id) AS n, sum(score) AS s FROM o GROUP BY 1
), f AS (
  SELECT CAST(make_timestamp(sec * 1000000) AS DATE) AS d, value, class FROM idx
  QUALIFY row_number() OVER (PARTITION BY d ORDER BY sec DESC NULLS LAST, value DESC NULLS LAST, class DESC NULLS LAST) = 1
), t AS (
  SELECT lower(coin_id) AS coin_id, CAST(ts AS DATE) AS d, score FROM trend
  QUALIFY row_number() OVER (PARTITION BY lower(coin_id), CAST(ts AS DATE) ORDER BY ts DESC NULLS LAST, score DESC NULLS LAST) = 1
), j AS (
  SELECT pd.d, pd.coin_id, avg_price, coalesce(n, 0) AS posts, coalesce(s, 0) AS eng, coalesce(f.value, 50) AS fng,
         coalesce(f.class, 'Neutral') AS class, t.coin_id IS NOT NULL AS hot, coalesce(t.score, 0) AS tscore
  FROM pd LEFT JOIN od ON pd.d = od.d LEFT JOIN f ON pd.d = f.d LEFT JOIN t ON pd.d = t.d AND pd.coin_id = t.coin_id
)
SELECT md5(coalesce(coin_id, '_dbt_utils_surrogate_key_null_') || '-' || coalesce(CAST(d AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS rid,
       d, coin_id, avg_price, posts, CAST(eng AS BIGINT), fng, class, hot, tscore,
       CAST(round(0.7::DOUBLE * fng + 0.3::DOUBLE * least(100.0::DOUBLE, posts * 5.0::DOUBLE + eng / 10.0::DOUBLE)) AS BIGINT),
       avg(avg_price) OVER w, avg(posts) OVER w, corr(avg_price, posts) OVER w
FROM j WINDOW w AS (PARTITION BY coin_id ORDER BY d NULLS FIRST ROWS 6 PRECEDING)
"""


def maybe(rnd, value, p=0.08):
    return None if rnd.random() < p else value


def raw(seed):
    rnd = random.Random(seed)

    def at(days=10):
        return maybe(rnd, T0 + dt.timedelta(days=rnd.randrange(days), hours=rnd.randrange(3)), 0.04)

    prices = [(maybe(rnd, rnd.choice(["Bitcoin", "bitcoin", "eth", "sol"])), maybe(rnd, rnd.randrange(1, 40) / 4), at()) for _ in range(400)]
    posts = [(maybe(rnd, f"p{rnd.randrange(30)}"), maybe(rnd, rnd.choice("xyz")), maybe(rnd, rnd.randrange(-50, 90)), at(7)) for _ in range(150)]
    index = [(maybe(rnd, 1704067200 + rnd.randrange(8) * 86400 + rnd.randrange(2)), maybe(rnd, rnd.randrange(101)), maybe(rnd, rnd.choice("ab"))) for _ in range(60)]
    trend = [(maybe(rnd, rnd.choice(["BITCOIN", "eth"])), maybe(rnd, rnd.randrange(5)), at(6)) for _ in range(25)]
    return prices, posts, index, trend


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_insights(spark, seed):
    prices, posts, index, trend = raw(seed)
    con = duckdb.connect()
    for name, data, columns in (
        ("prices", prices, "symbol VARCHAR, price DOUBLE, ts TIMESTAMP"),
        ("posts", posts, "id VARCHAR, title VARCHAR, score BIGINT, ts TIMESTAMP"),
        ("idx", index, "sec BIGINT, value BIGINT, class VARCHAR"),
        ("trend", trend, "coin_id VARCHAR, score BIGINT, ts TIMESTAMP"),
    ):
        con.execute(f"CREATE TABLE {name} ({columns})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(data[0]))})", data)
    expected = con.execute(SQL).fetchall()

    def text(rows, i):
        return [(*r[:i], r[i] and str(r[i]), *r[i + 1 :]) for r in rows]

    p = spark.createDataFrame(text(prices, 2), "symbol string, price double, timestamp string")
    o = spark.createDataFrame(text(posts, 3), "id string, title string, score bigint, created_utc string")
    x = spark.createDataFrame(index, "timestamp bigint, value bigint, value_classification string")
    t = spark.createDataFrame(
        [(c, c, c, 1, s, w and str(w)) for c, s, w in trend],
        "coin_id string, name string, symbol string, market_cap_rank bigint, score bigint, timestamp string",
    )
    got = marts.market_insights(
        marts.daily_price(staging.stage_prices(p)),
        marts.daily_posts(staging.stage_posts(o, with_title=False)),
        staging.stage_index(x),
        staging.stage_trending(t, with_details=False),
        Bounds(),
    ).collect()

    def canonical(rows):
        out = []
        for r in rows:
            r = list(r)
            if r[-1] is None or math.isnan(r[-1]):
                r[-1] = 0.0
            out.append([round(v, 7) + 0.0 if isinstance(v, float) else v for v in r])
        return sorted(out, key=repr)

    assert pd.DataFrame(canonical(got)).equals(pd.DataFrame(canonical(expected)))
