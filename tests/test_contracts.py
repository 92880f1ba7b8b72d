import json

import pytest
from helpers import rows

from tickloom.operators import contracts as K

PRICE = "symbol string, price string, timestamp string, ingestion_date string"


def judged(spark, contract, data, schema):
    return K.annotate(spark.createDataFrame(data, schema), contract)


def test_price_contract(spark):
    data = [
        ("bitcoin", "65000.5", "2024-01-01 00:00:00", "2024-01-01"),
        ("bitcoin", "0", "t", "d"),
        ("", "1", "t", "d"),
        (None, "1", "t", "d"),
        ("x", "-0.1", "t", "d"),
        ("x", "NaN", "t", "d"),
        ("x", "n/a", "t", "d"),
        ("x", None, "t", "d"),
        ("x", "1", None, "d"),
    ]
    df = judged(spark, K.PRICES, data, PRICE)
    assert rows(K.valid_records(df)) == [
        ("bitcoin", 0.0, "t", "d"),
        ("bitcoin", 65000.5, "2024-01-01 00:00:00", "2024-01-01"),
    ]
    bad = K.quarantined_records(df).collect()
    assert sorted(e for r in bad for e in r[K.ERRORS]) == [
        "price: below 0",
        "price: below 0",
        "price: missing",
        "price: not a double",
        "symbol: missing",
        "symbol: too short",
        "timestamp: missing",
    ]
    assert json.loads(bad[0][K.RECORD])["ingestion_date"] == "d"


def test_index_contract_bounds(spark):
    data = [(v, "c", "1", "d") for v in ("0", "100", "101", "-1", "50.5", "50.0")]
    df = judged(spark, K.INDEX, data, "value string, value_classification string, timestamp string, ingestion_date string")
    assert [r.value for r in K.valid_records(df).collect()] == [0, 100, 50]


def test_trending_contract(spark):
    schema = "coin_id string, name string, symbol string, market_cap_rank int, score int, timestamp string, ingestion_date string"
    df = judged(spark, K.TRENDING, [("a", "A", "a", None, None, "t", "d"), ("", "A", "a", 1, 1, "t", "d"), ("b", None, "b", 1, 1, "t", "d")], schema)
    assert K.valid_records(df).count() == 1


def test_absent_column_gets_default_and_null_stays_null(spark):
    df = judged(spark, K.POSTS, [("a", None)], "id string, title string")
    assert rows(K.valid_records(df)) == [("a", None, 0, None, "")]


def test_absent_required_column_fails_every_row(spark):
    df = judged(spark, K.INDEX, [("1", "c", "d")], "value string, value_classification string, ingestion_date string")
    assert [r[K.ERRORS] for r in K.quarantined_records(df).collect()] == [["timestamp: missing"]]
    nulls = judged(spark, K.INDEX, [("1", "c", None, "d")], "value string, value_classification string, timestamp string, ingestion_date string")
    assert K.valid_records(nulls).count() == 1


def test_json_records_absent_or_null(spark):
    df = spark.createDataFrame(
        [('{"id": "a"}',), ('{"id": "b", "title": null, "score": null, "url": "u"}',), ('{"id": ""}',)], "j string"
    )
    judged_df = K.annotate(K.parse_json_records(df, "j", K.POSTS), K.POSTS)
    assert rows(K.valid_records(judged_df)) == [("a", "", 0, None, ""), ("b", None, None, None, "u")]


def test_land_counts_and_keeps_everything(spark, tmp_path):
    path = str(tmp_path / "landed")
    df = spark.createDataFrame([("a", "1", "t", "d"), ("", "1", "t", "d"), ("b", "x", "t", "d")], PRICE)
    assert K.land(df, K.PRICES, path) == {"records": 3, "quarantined": 2}
    back = spark.read.parquet(path)
    assert dict(rows(back.groupBy("status").count())) == {"valid": 1, "quarantined": 2}


def test_land_by_day(spark, tmp_path):
    path = str(tmp_path / "landed")
    data = [("a", "1", "t", f"2024-01-0{i % 3 + 1}") for i in range(30)] + [("", "1", "t", "2024-01-01")]
    assert K.land(spark.createDataFrame(data, PRICE), K.PRICES, path, "ingestion_date") == {"records": 31, "quarantined": 1}
    assert spark.read.parquet(f"{path}/status=valid/ingestion_date=2024-01-02").count() == 10


def test_unparsable_records_keep_their_text(spark):
    df = spark.createDataFrame([('{"id": "a"}',), ("{broken",), ('{"id": ""}',)], "j string")
    bad = K.quarantined_records(K.annotate(K.parse_json_records(df, "j", K.POSTS), K.POSTS))
    assert sorted(r[K.RECORD] for r in bad.collect()) == sorted(["{broken", '{"id": ""}'])


def test_a_bad_batch_leaves_the_good_day_alone(spark, tmp_path):
    path = str(tmp_path / "landed")
    good = spark.createDataFrame([("a", "1", "t", "d")], PRICE)
    K.land(good, K.PRICES, path)
    with pytest.raises(K.AllRecordsInvalid):
        K.land(spark.createDataFrame([("", "1", "t", "d")], PRICE), K.PRICES, path)
    assert rows(spark.read.parquet(path).select("symbol", "status")) == [("a", "valid")]
    assert [p.name for p in tmp_path.iterdir()] == ["landed"]


def test_unreadable_texts_are_quarantined_and_counted(spark, tmp_path):
    texts = spark.createDataFrame([("{x", ["document: not a JSON object"])], f"{K.RECORD} string, {K.ERRORS} array<string>")
    counts = K.land(spark.createDataFrame([("a", "1", "t", "d")], PRICE), K.PRICES, str(tmp_path / "l"), unreadable=texts)
    assert counts == {"records": 2, "quarantined": 1}
    assert rows(spark.read.parquet(str(tmp_path / "l")).where("status = 'quarantined'").select(K.RECORD)) == [("{x",)]


def test_land_raises_when_all_invalid_or_empty(spark, tmp_path):
    bad = spark.createDataFrame([("", "1", "t", "d")], PRICE)
    with pytest.raises(K.AllRecordsInvalid):
        K.land(bad, K.PRICES, str(tmp_path / "a"))
    with pytest.raises(K.AllRecordsInvalid):
        K.land(bad.limit(0), K.PRICES, str(tmp_path / "b"))
