from helpers import rows
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.plans import daily
from tickloom.sources import catalog

PRICES = schemas.LAKE_TABLES["coingecko_prices"]


def test_lake_table_discovers_days_and_columns(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.createDataFrame([("a", 1.0, "t")], PRICES).write.parquet(f"{root}/dt=2024-01-01")
    name = catalog.register_lake_table(spark, "lake_test", "coingecko_prices", root)
    assert rows(spark.table(name).selectExpr("symbol", "cast(dt as string)")) == [("a", "2024-01-01")]
    wider = T.StructType([*PRICES.fields, T.StructField("currency", T.StringType())])
    spark.createDataFrame([("b", 2.0, "t", "eur")], wider).write.parquet(f"{root}/dt=2024-01-02")
    catalog.register_lake_table(spark, "lake_test", "coingecko_prices", root, wider)
    assert rows(spark.table(name).selectExpr("symbol", "currency", "cast(dt as string)")) == [
        ("a", None, "2024-01-01"),
        ("b", "eur", "2024-01-02"),
    ]
    plan = spark.table(name).where("dt = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_lake_over_bare_date_folders_in_sql(spark, tmp_path):
    root = str(tmp_path / "raw")
    for day, value in (("2024-01-01", 40), ("2024-01-02", 50), ("2024-01-03", 60)):
        spark.createDataFrame([("1704067200", value, "Fear")], schemas.LAKE_TABLES["fear_greed_index"]).write.parquet(f"{root}/fear_greed/{day}")
    for folder in ("coingecko", "reddit", "trending_coins"):
        (tmp_path / "raw" / folder).mkdir()
    assert len(catalog.register_lake(spark, "lake_bare", root)) == 4
    got = spark.sql("SELECT CAST(value AS INT) AS value, CAST(dt AS STRING) FROM lake_bare.fear_greed_index ORDER BY dt DESC LIMIT 2")
    assert [tuple(r) for r in got.collect()] == [(60, "2024-01-03"), (50, "2024-01-02")]
    assert spark.table("lake_bare.coingecko_prices").count() == 0
    one = spark.table("lake_bare.fear_greed_index").where("dt = '2024-01-02'")
    assert [r.value for r in one.collect()] == [50]
    assert one._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numPartitions").value() == 1
    catalog.register_lake(spark, "lake_bare", root)  # again: nothing changes
    assert spark.table("lake_bare.fear_greed_index").count() == 3


def test_warehouse_tables_in_sql(spark, sf_dir, tmp_path):
    from tickloom.sources import sample

    w = daily.Warehouse(str(tmp_path / "wh"))
    daily.build(spark, w, sample.sources(spark, sf_dir))
    catalog.register_warehouse(spark, "marts_test", w.root)
    got = spark.sql(
        """SELECT d.month, count(*) AS n, count(DISTINCT f.coin_id) AS coins
        FROM marts_test.fct_market_insights f JOIN marts_test.dim_date d ON f.report_date = d.date
        JOIN marts_test.dim_coin c ON f.coin_id = c.coin_id GROUP BY d.month"""
    )
    assert [tuple(r) for r in got.collect()] == [(1, 150, 5)]
    daily.build(spark, w, sample.sources(spark, sf_dir))
    catalog.register_warehouse(spark, "marts_test", w.root)
    assert spark.table("marts_test.fct_crypto_daily").count() == 150


def test_discovery_reads_changed_folders_alone(spark, tmp_path):
    root = f"{tmp_path}/prices"
    day = lambda df, d: df.write.mode("overwrite").parquet(f"{root}/dt={d}")
    for d in ("2024-01-01", "2024-01-02"):
        day(spark.createDataFrame([("a", 1.0)], "symbol string, price double"), d)
    columns, read = catalog.discover(spark, root)
    assert columns.names == ["symbol", "price"] and read == ["dt=2024-01-01", "dt=2024-01-02"]
    assert catalog.discover(spark, root) == (columns, [])
    day(spark.createDataFrame([("b", 2.0, 3)], "symbol string, price double, rank long"), "2024-01-03")
    columns, read = catalog.discover(spark, root)
    assert columns.names == ["symbol", "price", "rank"] and read == ["dt=2024-01-03"]
    day(spark.createDataFrame([("a",)], "symbol string"), "2024-01-01")  # written again, with less
    columns, read = catalog.discover(spark, root)
    assert columns.names == ["symbol", "price", "rank"] and read == ["dt=2024-01-01"]
    where = (f"found_{tmp_path.name}", "prices", root, f"{tmp_path}/db")
    name, _ = catalog.register_discovered(spark, *where)
    assert rows(spark.table(name).select("symbol", "price", "rank")) == [("a", 1.0, None), ("a", None, None), ("b", 2.0, 3)]
    day(spark.createDataFrame([(1.5,)], "symbol double"), "2024-01-04")
    try:
        catalog.discover(spark, root)
        raise AssertionError("columns of two kinds were taken")
    except ValueError as error:
        assert "symbol is double" in str(error)


def test_discovery_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    columns, read = catalog.discover(spark, f"{tmp_path}/none")
    assert columns.names == [] and read == []
