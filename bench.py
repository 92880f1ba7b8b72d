"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select data and
cores. Each query runs once unmeasured, then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tickloom import schemas  # noqa: E402
from tickloom.functions.columns import SECOND_FORMAT  # noqa: E402
from tickloom.operators import serving  # noqa: E402
from tickloom.plans import daily  # noqa: E402
from tickloom.registry import QUERIES  # noqa: E402
from tickloom.session import build_session, scratch_dir  # noqa: E402
from tickloom.sources import sample, sinks  # noqa: E402

HEADLINE = (
    "stg_prices_dedup",
    "stg_posts_dedup",
    "stg_fng_dedup",
    "stg_trending_dedup",
    "fct_crypto_daily",
    "fct_market_insights",
    "dim_date",
    "api_latest_10",
    "fng_latest_90",
    "fng_ma7_full_window",
    "prices_ordered_relabelled",
    "latest_price_per_coin",
    "mention_counts_fixed_tokens",
    "mention_totals_unpivot",
    "price_vs_mentions",
    "dq_price_spike",
    "dq_unique",
    "dq_relationships",
    "dq_accepted_range",
    "contract_valid",
    "json_map_flatten",
    "compaction",
    "inc_insights_emit_max",
    "stream_dedup",
)
# Those that write and read files run once after the warm-up.
ONCE = {"compaction", "inc_insights_emit_max", "stream_dedup"}


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def storage_ratio(spark, sf_dir: str) -> float:
    """Parquet bytes per JSONL byte for the price rows."""
    raw, out = scratch_dir(spark, "bench-json"), scratch_dir(spark, "bench-parquet")
    rows = sample.prices(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", SECOND_FORMAT)).drop("dt")
    sinks.save_day(rows, raw, "coingecko", "2024-01-01")
    sinks.compact(spark, raw, out, schemas.LAKE_TABLES["coingecko_prices"])
    return sinks.folder_bytes(spark, out, "*.parquet") / sinks.folder_bytes(spark, raw, "*.json")


def day_filter_share(spark, sf_dir: str) -> float:
    """Bytes read for one day of a day-partitioned table, as a share of the whole table."""
    path = scratch_dir(spark, "bench-days")
    sample.prices(spark, sf_dir).hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    one = spark.read.parquet(path).where("dt = '2024-01-15'").select("symbol", "price")
    one.collect()
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("filesSize").value() / sinks.folder_bytes(spark, path, "*.parquet")


def stored_lookup(spark, sf_dir: str) -> float:
    """Seconds for the newest ten days of a coin from the stored fact."""
    warehouse = daily.Warehouse(scratch_dir(spark, "bench-fact"))
    daily.refresh_crypto_daily(spark, warehouse, sample.sources(spark, sf_dir))

    def once() -> float:
        start = time.perf_counter()
        serving.coin_history(warehouse.crypto_daily.read(spark), "click").collect()
        return time.perf_counter() - start

    once()
    return statistics.median(once() for _ in range(3))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        seconds(spark, sf_dir, name)
        timings[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(1 if name in ONCE else 3)), 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "parquet_to_jsonl_bytes": round(storage_ratio(spark, sf_dir), 3),
                "one_day_bytes_share": round(day_filter_share(spark, sf_dir), 3),
                "stored_fact_lookup_sec": round(stored_lookup(spark, sf_dir), 3),
            }
        )
    )


if __name__ == "__main__":
    main()
