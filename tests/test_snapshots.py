"""Versions of a warehouse: written apart, shown together, kept for readers."""

import datetime as dt
import os

import pytest
from helpers import rows

from tickloom import schemas
from tickloom.operators import merge as M
from tickloom.operators import snapshots as S
from tickloom.plans import daily

D1, D2, D3 = (dt.date(2024, 1, i) for i in (1, 2, 3))


def frame(spark, *data):
    return spark.createDataFrame([(k, d, c, p, 0, 0) for k, d, c, p in data], schemas.FCT_CRYPTO_DAILY)


def held(spark, fact):
    return rows(fact.read(spark).select("record_id", "report_date", "avg_price"), "record_id")


@pytest.fixture
def warehouse(tmp_path):
    return daily.VersionedWarehouse(f"{tmp_path}/wh")


def test_upserts_make_versions_and_old_ones_stay(spark, warehouse):
    fact = warehouse.crypto_daily
    assert not fact.exists(spark) and fact.watermark(spark) is None and fact.read(spark).isEmpty()
    M.upsert(spark, fact, frame(spark, ("a", D1, "x", 1.0), ("b", D1, "y", 2.0), ("c", D2, "x", 3.0)))
    first = warehouse.pinned(spark)
    M.upsert(spark, fact, frame(spark, ("b", D1, "y", 20.0), ("d", D3, "z", 4.0), ("n", None, "n", 5.0)))
    assert held(spark, fact) == [("a", D1, 1.0), ("b", D1, 20.0), ("c", D2, 3.0), ("d", D3, 4.0), ("n", None, 5.0)]
    assert held(spark, first.crypto_daily) == [("a", D1, 1.0), ("b", D1, 2.0), ("c", D2, 3.0)]
    assert (fact.watermark(spark), first.crypto_daily.watermark(spark)) == (D3, D2)
    assert warehouse.snapshots.versions(spark) == [1, 2] and held(spark, fact.at(1)) == held(spark, first.crypto_daily)
    M.upsert(spark, fact, frame(spark))
    assert warehouse.snapshots.versions(spark) == [1, 2]


def test_untouched_days_keep_their_folder(spark, warehouse):
    fact = warehouse.crypto_daily
    M.upsert(spark, fact, frame(spark, ("a", D1, "x", 1.0), ("c", D2, "x", 3.0)))
    before = warehouse.snapshots.tables(spark)["fct_crypto_daily"]
    M.upsert(spark, fact, frame(spark, ("a", D1, "x", 9.0)))
    after = warehouse.snapshots.tables(spark)["fct_crypto_daily"]
    assert len(after) == 2 and [f for f in after if "01-02" in f] == [f for f in before if "01-02" in f] and before != after
    one = fact.read(spark).where("report_date = DATE'2024-01-02'")
    assert "PartitionFilters: [isnotnull(report_date" in one._jdf.queryExecution().executedPlan().toString()
    assert [r.avg_price for r in one.collect()] == [3.0]


def test_a_failure_between_two_facts_leaves_the_old_version(spark, warehouse):
    daily_fact, insights = warehouse.crypto_daily, warehouse.market_insights
    wide = spark.createDataFrame([], schemas.FCT_MARKET_INSIGHTS)
    with warehouse.change(spark):
        M.upsert(spark, daily_fact, frame(spark, ("a", D1, "x", 1.0)))
        insights.replace(wide)
        assert warehouse.snapshots.versions(spark) == [] and held(spark, daily_fact) == [("a", D1, 1.0)]
    with pytest.raises(RuntimeError, match="between"):
        with warehouse.change(spark):
            M.upsert(spark, daily_fact, frame(spark, ("a", D1, "x", 2.0), ("b", D2, "x", 2.0)))
            assert len(held(spark, daily_fact)) == 2  # the writer sees its own change
            assert held(spark, warehouse.pinned(spark).crypto_daily) == [("a", D1, 1.0)]  # others do not
            raise RuntimeError("between the facts")
    assert held(spark, daily_fact) == [("a", D1, 1.0)] and warehouse.snapshots.versions(spark) == [1]
    left = [f for _, _, files in os.walk(f"{daily_fact.path}") for f in files if f.endswith(".parquet")]
    assert len(left) == 1


def test_two_writers_cannot_commit_the_same_version(spark, warehouse):
    M.upsert(spark, warehouse.crypto_daily, frame(spark, ("a", D1, "x", 1.0)))
    other = daily.VersionedWarehouse(warehouse.root)
    with pytest.raises(S.ConcurrentCommit):
        with warehouse.change(spark):
            M.upsert(spark, warehouse.crypto_daily, frame(spark, ("a", D1, "x", 2.0)))
            M.upsert(spark, other.crypto_daily, frame(spark, ("a", D1, "x", 3.0)))
    assert held(spark, warehouse.crypto_daily) == [("a", D1, 3.0)]


def test_expired_versions_free_their_folders(spark, warehouse):
    fact = warehouse.crypto_daily
    for price in (1.0, 2.0, 3.0):
        M.upsert(spark, fact, frame(spark, ("a", D1, "x", price), ("b", D2, "x", price)))
    assert warehouse.snapshots.expire(spark, keep=2) == 2
    assert warehouse.snapshots.versions(spark) == [2, 3]
    assert held(spark, fact.at(2)) == [("a", D1, 2.0), ("b", D2, 2.0)] and len(held(spark, fact)) == 2
    assert warehouse.snapshots.expire(spark, keep=2) == 0


def test_small_tables_belong_to_the_version(spark, warehouse):
    coins = lambda *names: spark.createDataFrame([(n,) for n in names], schemas.DIM_COIN)
    assert warehouse.read_dim(spark, "dim_coin", schemas.DIM_COIN) is None
    warehouse.replace_dim(spark, "dim_coin", coins("x"))
    first = warehouse.pinned(spark)
    known = warehouse.read_dim(spark, "dim_coin", schemas.DIM_COIN)
    warehouse.replace_dim(spark, "dim_coin", known.unionByName(coins("y")))
    assert rows(warehouse.read_dim(spark, "dim_coin", schemas.DIM_COIN)) == [("x",), ("y",)]
    assert rows(first.read_dim(spark, "dim_coin", schemas.DIM_COIN)) == [("x",)]
