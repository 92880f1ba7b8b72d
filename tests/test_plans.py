"""Plan properties that have to hold at any scale."""

import re

import pytest

from tickloom.registry import QUERIES

# These write and read files while they are built; their plans are only the final read.
EAGER = {
    "inc_daily_equals_full", "inc_insights_emit_max", "upsert_no_delete", "backfill_range", "dq_full_suite",
    "contract_land", "bronze_daily_price", "jsonl_roundtrip", "path_date_partition", "external_table", "compaction",
    "append_observed", "stream_trades_append", "stream_dedup", "stream_daily_avg", "stream_freshness",
    "payload_broken_documents", "trades_rejected", "land_keeps_good_day", "publish_keeps_good_file", "inc_late_data",
    "backfill_dimensions", "gates", "external_lake_tables", "mixed_json_compaction", "inc_versions", "stream_late_corrected",
    "schema_discovery",
}


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for operator in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas", "InArrow"):
        assert operator not in text


@pytest.mark.parametrize(
    "name,scans",
    [
        # One scan for ticks, one for rows without symbol or time, which the files' statistics rule out.
        ("stg_prices_dedup", 2),
        ("mention_counts_fixed_tokens", 1),
    ],
)
def test_every_source_is_scanned_once(spark, sf_dir, name, scans):
    df = QUERIES[name](spark, sf_dir)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == scans


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", plan(spark, sf_dir, "fct_crypto_daily"))
    columns = {frozenset(f.split(":")[0] for f in s.split(",")) for s in schemas}
    assert frozenset({"ts", "event_type", "value"}) in columns
    assert all("props" not in c and "role" not in c for c in columns)


def test_aggregates_reduce_before_they_shuffle(spark, sf_dir):
    for name in ("stg_prices_dedup", "stg_posts_dedup", "stg_fng_dedup", "stg_trending_dedup", "latest_price_per_coin"):
        text = plan(spark, sf_dir, name)
        below = text[text.rindex("Exchange hashpartitioning") :]
        assert "HashAggregate" in below and "partial_max" in below and "Sort" not in below


def test_point_lookup_is_a_top_n(spark, sf_dir):
    assert "TakeOrderedAndProject(limit=10" in plan(spark, sf_dir, "api_latest_10")


def test_joins_without_broadcast_are_sort_merge(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, sf_dir, "fct_market_insights")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Three joins of the fact, and one back to the newest rows in each of three staging frames.
    assert text.count("SortMergeJoin") == 6 and "Broadcast" not in text
