import datetime as dt
import os

import pytest
from helpers import rows

from tickloom import schemas
from tickloom.operators import merge as M

D1, D2, D3 = (dt.date(2024, 1, i) for i in (1, 2, 3))
COLUMNS = schemas.FCT_CRYPTO_DAILY.names


@pytest.fixture
def fact(tmp_path):
    return M.Fact(str(tmp_path / "fact"), schemas.FCT_CRYPTO_DAILY)


def frame(spark, *data):
    return spark.createDataFrame([(k, d, c, p, 0, 0) for k, d, c, p in data], schemas.FCT_CRYPTO_DAILY)


def stored(spark, fact):
    return rows(fact.read(spark).select("record_id", "report_date", "avg_price"), "record_id")


def test_upsert_updates_inserts_and_never_deletes(spark, fact):
    fact.replace(frame(spark, ("a", D1, "x", 1.0), ("b", D1, "y", 2.0), ("c", D2, "x", 3.0)))
    M.upsert(spark, fact, frame(spark, ("b", D1, "y", 20.0), ("d", D3, "z", 4.0)))
    assert stored(spark, fact) == [("a", D1, 1.0), ("b", D1, 20.0), ("c", D2, 3.0), ("d", D3, 4.0)]


def test_upsert_leaves_other_days_alone(spark, fact):
    fact.replace(frame(spark, ("a", D1, "x", 1.0), ("c", D2, "x", 3.0)))
    untouched = set(os.listdir(f"{fact.path}/report_date=2024-01-02"))
    M.upsert(spark, fact, frame(spark, ("a", D1, "x", 9.0)))
    assert set(os.listdir(f"{fact.path}/report_date=2024-01-02")) == untouched


def test_upsert_twice_is_the_same_as_once(spark, fact):
    fact.replace(frame(spark, ("a", D1, "x", 1.0)))
    update = frame(spark, ("a", D1, "x", 2.0), ("b", D1, "y", 3.0))
    M.upsert(spark, fact, update)
    once = stored(spark, fact)
    M.upsert(spark, fact, update)
    assert stored(spark, fact) == once


def test_upsert_into_nothing_creates_the_table(spark, fact):
    assert not fact.exists(spark) and fact.watermark(spark) is None
    M.upsert(spark, fact, frame(spark, ("a", D1, "x", 1.0)))
    assert fact.exists(spark) and fact.watermark(spark) == D1


def test_upsert_of_nothing_changes_nothing(spark, fact):
    fact.replace(frame(spark, ("a", D1, "x", 1.0)))
    M.upsert(spark, fact, frame(spark))
    assert stored(spark, fact) == [("a", D1, 1.0)]


def test_duplicate_keys_raise_and_leave_the_target_as_it_was(spark, fact):
    fact.replace(frame(spark, ("a", D1, "x", 1.0)))
    with pytest.raises(M.DuplicateKeys, match="record_id = b"):
        M.upsert(spark, fact, frame(spark, ("b", D1, "y", 1.0), ("b", D1, "y", 2.0)))
    assert stored(spark, fact) == [("a", D1, 1.0)]


def test_rows_without_a_day_merge_too(spark, fact):
    fact.replace(frame(spark, ("a", D1, "x", 1.0), ("n", None, "x", 5.0)))
    M.upsert(spark, fact, frame(spark, ("n", None, "x", 6.0), ("m", None, "y", 7.0)))
    assert stored(spark, fact) == [("a", D1, 1.0), ("m", None, 7.0), ("n", None, 6.0)]


def test_target_scan_is_pruned_to_the_touched_days(spark, fact):
    from pyspark.sql import functions as F

    fact.replace(frame(spark, ("a", D1, "x", 1.0), ("c", D2, "x", 3.0)))
    plan = fact.read(spark).where(F.col("report_date").isin([D1]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_date" in plan or "PartitionFilters: [(report_date" in plan


def test_bounds():
    assert M.short_lookback(None) == M.Bounds()
    assert M.short_lookback(D3) == M.Bounds(D1, D1)
    assert M.long_lookback(dt.date(2024, 1, 10)) == M.Bounds(D2, dt.date(2024, 1, 10))
    assert M.long_lookback(dt.date(2024, 1, 12), emit_days=2) == M.Bounds(D2, dt.date(2024, 1, 10))
    assert M.backfill_bounds(D1, D2, rolling=False) == M.Bounds(D1, D1, D2)
    assert M.backfill_bounds(dt.date(2024, 1, 9), dt.date(2024, 1, 10), rolling=True) == M.Bounds(
        D1, dt.date(2024, 1, 9), dt.date(2024, 1, 16)
    )


def test_random_upserts_against_a_dict(spark, fact):
    import random

    rnd, model = random.Random(11), {}
    for _ in range(4):
        update = {}
        for _ in range(rnd.randrange(1, 12)):
            k = f"k{rnd.randrange(15)}"
            # A key belongs to one day, as record ids hash the day.
            update[k] = (k, dt.date(2024, 1, 1 + int(k[1:]) % 4), rnd.choice("xyz"), round(rnd.random(), 3))
        model.update(update)
        M.upsert(spark, fact, frame(spark, *update.values()))
        assert stored(spark, fact) == sorted((k, d, p) for k, d, _, p in model.values())
