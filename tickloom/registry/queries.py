"""Registered queries: (spark, sf_dir) -> DataFrame over the whole driver tables."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.functions import columns as C
from tickloom.functions.rolling import rolling_corr, rolling_mean, rows_window
from tickloom.operators import contracts as K
from tickloom.operators import merge as M
from tickloom.operators import quality as Q
from tickloom.operators import serving as S
from tickloom.operators.dedup import distinct_ticks, latest_per_key
from tickloom.operators.joins import left_with_defaults
from tickloom.operators.ticks import with_previous
from tickloom.plans import checks, daily, ingest, marts, staging
from tickloom.session import child_names, file_system, prepare, scratch_dir
from tickloom.sources import catalog, lake, payloads, sample, sinks
from tickloom.streaming import trades

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-01-31 00:00:00"


def shown(df: DataFrame) -> DataFrame:
    """Values in a form both engines print alike: days and times as text, doubles to 8 places."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, C.SECOND_FORMAT)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 8)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(fn(prepare(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


# Staging and marts.


@query
def stg_prices_dedup(spark, d):
    return _ticks(spark, d)


@query
def stg_posts_dedup(spark, d):
    return staging.stage_posts(sample.posts(spark, d))


@query
def stg_fng_dedup(spark, d):
    return staging.stage_index(sample.index(spark, d))


@query
def stg_trending_dedup(spark, d):
    return staging.stage_trending(sample.trending(spark, d))


def _ticks(spark, d):
    return staging.stage_prices(sample.prices(spark, d))


def _prices(spark, d):
    return marts.daily_price(_ticks(spark, d))


def _posts(spark, d):
    return marts.daily_posts(staging.stage_posts(sample.posts(spark, d), with_title=False))


def _index(spark, d):
    return staging.stage_index(sample.index(spark, d))


def _trending(spark, d):
    return staging.stage_trending(sample.trending(spark, d), with_details=False)


def _crypto_daily(spark, d):
    return marts.crypto_daily(_prices(spark, d), _posts(spark, d))


def _insights(spark, d):
    return marts.market_insights(_prices(spark, d), _posts(spark, d), _index(spark, d), _trending(spark, d))


@query
def daily_avg_price(spark, d):
    return _prices(spark, d)


@query
def daily_posts(spark, d):
    return _posts(spark, d)


@query
def fct_crypto_daily(spark, d):
    return _crypto_daily(spark, d)


@query
def fct_market_insights(spark, d):
    return _insights(spark, d)


@query
def left_join_defaults(spark, d):
    """Orders per customer and day-less customers: every customer, zero where none."""
    orders = sample.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("orders"), F.sum("o_totalprice").alias("spent")
    )
    customers = sample.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return left_with_defaults(customers, orders, ["c_custkey"], {"orders": 0, "spent": 0.0}, matched="has_orders")


@query
def surrogate_key(spark, d):
    """Keys over nullable parts: priorities other than urgent are hidden."""
    o = sample.table(spark, d, "orders")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority"))
    return o.select("o_orderkey", C.surrogate_key(urgent, F.to_date("o_orderdate"), "o_custkey").alias("record_id"))


@query
def sentiment_score(spark, d):
    """Order lines as readings: quantity as index, line number as posts, price as engagement."""
    li = sample.table(spark, d, "lineitem")
    score = C.sentiment_score(F.col("l_quantity"), F.col("l_linenumber"), F.col("l_extendedprice") / 200)
    return li.groupBy(score.alias("sentiment_score")).agg(F.count(F.lit(1)).alias("n"))


@query
def rolling_avg_7(spark, d):
    week = rows_window(["coin_id"], "report_date", 7)
    return _prices(spark, d).withColumn("avg_price_7d", rolling_mean("avg_price", week))


@query
def rolling_corr_7(spark, d):
    """Price against the number of distinct ticks of the day."""
    ticks = _ticks(spark, d)
    days = ticks.groupBy(F.to_date("recorded_at").alias("report_date"), "coin_id").agg(
        F.avg("price_usd").alias("avg_price"), F.count(F.lit(1)).alias("ticks")
    )
    week = rows_window(["coin_id"], "report_date", 7)
    return days.withColumn("corr_7d", rolling_corr("avg_price", "ticks", week))


@query
def is_trending_flag(spark, d):
    flagged = left_with_defaults(
        _prices(spark, d).select("report_date", "coin_id"),
        _trending(spark, d).select("report_date", "coin_id", "trending_score"),
        ["report_date", "coin_id"],
        {"trending_score": 0},
        matched="is_trending",
    )
    return flagged


@query
def dim_coin(spark, d):
    return marts.dim_coin(_ticks(spark, d))


@query
def dim_date(spark, d):
    return marts.dim_date(_crypto_daily(spark, d))


# Serving.


@query
def api_latest_10(spark, d):
    return S.coin_history(_crypto_daily(spark, d), "click")


@query
def fng_latest_90(spark, d):
    return S.index_history(sample.index(spark, d), 90)


@query
def fng_latest_90_dedup(spark, d):
    return S.index_history(sample.index(spark, d), 90, dedup=True)


@query
def fng_ma7_full_window(spark, d):
    return S.index_trend(S.index_history(sample.index(spark, d), 90, dedup=True), 30)


@query
def fng_band(spark, d):
    return sample.index(spark, d).groupBy("value").agg(F.count(F.lit(1)).alias("n")).withColumn("badge", S.index_badge("value"))


@query
def fng_latest(spark, d):
    return S.latest_index(sample.index(spark, d))


@query
def prices_ordered_relabelled(spark, d):
    return S.price_listing(sample.prices(spark, d), sample.NAMES)


@query
def latest_price_per_coin(spark, d):
    return S.latest_prices(S.relabelled(sample.prices(spark, d), sample.NAMES))


@query
def price_label(spark, d):
    return sample.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", C.money_text(F.col("l_extendedprice") * F.col("l_tax")).alias("label")
    )


@query
def mention_counts(spark, d):
    return S.ordered_mention_counts(S.mention_counts(sample.lake_posts(spark, d), patterns=sample.MENTIONS))


@query
def mention_counts_fixed_tokens(spark, d):
    return S.mention_counts(sample.lake_posts(spark, d))


@query
def mention_totals_unpivot(spark, d):
    counts = S.mention_counts(sample.lake_posts(spark, d), patterns=sample.MENTIONS)
    return S.mention_totals(counts, ["ETH", "DOT", "NONE", "ABSENT"], days=15)


@query
def price_vs_mentions(spark, d):
    counts = S.mention_counts(sample.lake_posts(spark, d), patterns=sample.MENTIONS)
    return S.price_vs_mentions(S.relabelled(sample.prices(spark, d), sample.NAMES | {"click": "ETH"}), counts, "ETH", 15)


@query
def has_mentions(spark, d):
    counts = S.mention_counts(sample.lake_posts(spark, d), patterns=sample.MENTIONS)
    return S.has_mentions(S.mention_totals(counts, ["NONE"], days=30))


@query
def dod_change(spark, d):
    return S.day_over_day(_crypto_daily(spark, d))


@query
def engagement_share(spark, d):
    return S.engagement_share(_insights(spark, d))


@query
def engagement_per_post(spark, d):
    return S.engagement_per_post(_crypto_daily(spark, d))


@query
def score_bands(spark, d):
    return S.score_bands(_insights(spark, d))


@query
def field_aggregates(spark, d):
    return S.field_aggregates(_insights(spark, d))


# Quality.


@query
def dq_not_null(spark, d):
    """Customers with their order totals: NULL where there is no order."""
    by_customer = sample.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    spent = by_customer.agg(F.sum("o_totalprice").alias("spent"))
    wide = sample.table(spark, d, "customer").join(spent, "c_custkey", "left")
    found = Q.run_checks({"customer": wide}, [Q.not_null("customer", c) for c in ("c_custkey", "c_name", "spent")])
    sources = sample.sources(spark, d)
    raw = [c for c in checks.NOT_NULL if c.table in daily.RAW]
    return found.unionByName(Q.run_checks({name: sources(name) for name in daily.RAW}, raw))


@query
def dq_unique(spark, d):
    t = {n: sample.table(spark, d, n) for n in ("conversations", "lineitem", "orders", "customer")}
    return Q.run_checks(
        t,
        [
            Q.unique("conversations", "conv_id"),
            Q.unique("lineitem", "l_orderkey"),
            Q.unique("orders", "o_orderkey"),
            Q.unique("customer", "c_nationkey"),
        ],
    )


@query
def dq_accepted_range(spark, d):
    t = {n: sample.table(spark, d, n) for n in ("events", "orders", "lineitem")}
    return Q.run_checks(
        t,
        [
            Q.accepted_range("events", "value", 1, 300),
            Q.accepted_range("orders", "o_totalprice", 10000),
            Q.accepted_range("orders", "o_totalprice", None, 400000),
            Q.accepted_range("lineitem", "l_discount", 0, 0.05),
        ],
    )


@query
def dq_relationships(spark, d):
    t = {n: sample.table(spark, d, n) for n in ("events", "orders", "lineitem", "customer", "labels", "documents")}
    return Q.run_checks(
        t,
        [
            Q.relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
            Q.relationship("orders", "o_custkey", "events", "user_id"),
            Q.relationship("labels", "doc_id", "documents", "doc_id"),
            Q.relationship("documents", "doc_id", "labels", "doc_id"),
        ],
    )


@query
def dq_expression(spark, d):
    return Q.run_checks(
        {"lineitem": sample.table(spark, d, "lineitem"), "fct_crypto_daily": _crypto_daily(spark, d)},
        [
            Q.expression_is_true("lineitem", "l_extendedprice * (1 - l_discount) >= 1000"),
            Q.expression_is_true("lineitem", "l_returnflag <> 'R'"),
            *checks.EXPRESSIONS,
        ],
    )


@query
def dq_price_spike(spark, d):
    return checks.spiking_ticks(_ticks(spark, d))


@query
def previous_event(spark, d):
    """Every distinct event time of a type next to the value before it, at full precision."""
    e = sample.events(spark, d).select(F.col("event_type").alias("coin_id"), "ts", "value")
    ticks = distinct_ticks(e, "coin_id", "ts", "value")
    return with_previous(ticks, "coin_id", "ts", "value", "previous")


@query
def dq_price_positive(spark, d):
    """Events below one, standing for prices that are not positive."""
    shifted = sample.prices(spark, d).withColumn("price", F.col("price") - 1)
    return staging.stage_prices(shifted).where(checks.price_positive().failing())


@query
def dq_not_future(spark, d):
    late = checks.not_in_future(as_of=F.lit("2024-01-29 12:00:00").cast("timestamp"))
    return _ticks(spark, d).where(late.failing())


@query
def dq_missing_expected(spark, d):
    return Q.missing_expected(Q.expected_keys(spark, sample.EXPECTED), _crypto_daily(spark, d))


@query
def dq_mart_completeness(spark, d):
    return Q.day_completeness(_crypto_daily(spark, d), Q.expected_keys(spark, sample.EXPECTED), "2024-01-15")


@query
def dq_freshness(spark, d):
    ticks = sample.events(spark, d).select(F.date_trunc("SECOND", "ts").alias("event_time"))
    return Q.freshness(ticks, max_delay_minutes=10, as_of=F.lit(AS_OF).cast("timestamp"))


@query
def dq_row_counts(spark, d):
    names = ("events", "orders", "lineitem", "conversations", "documents")
    return Q.row_counts({n: sample.table(spark, d, n) for n in names})


@query
def dq_full_suite(spark, d):
    """A whole daily run into a fresh warehouse, then every declared check."""
    warehouse, sources = daily.Warehouse(scratch_dir(spark, "suite")), sample.sources(spark, d)
    daily.build(spark, warehouse, sources)
    return Q.run_checks(daily.tables(spark, warehouse, sources), checks.DECLARED)


@query
def dq_planted_violations(spark, d):
    """The checks of raw and staged prices, posts and index readings over rows of which many break them."""
    u, c, o = F.col("user_id"), F.col("conv_id"), F.col("o_orderkey")
    e, posts = sample.events(spark, d), sample.posts(spark, d)
    prices = e.select(
        F.when(u % 20 != 3, F.col("event_type")).alias("symbol"),
        F.when(u % 20 != 5, F.col("value") * 8000 - 400000).alias("price"),
        F.when(u % 20 != 4, F.date_trunc("HOUR", "ts")).alias("timestamp"),
    )
    posts = posts.withColumn("conv_id", F.col("id").cast("bigint"))
    posts = posts.withColumn("id", F.when(c % 9 != 0, F.col("id"))).withColumn("created_utc", F.when(c % 7 != 0, F.col("created_utc")))
    index = sample.table(spark, d, "orders").select(
        F.when(o % 11 != 0, F.lit(1704067200) + (o % 28) * 86400 + o % 86400).alias("timestamp"),
        F.when(o % 5 != 0, (F.floor("o_totalprice") % 301 - 100).cast("bigint")).alias("value"),
        F.col("o_orderpriority").alias("value_classification"),
    )
    tables = {
        "raw_prices": prices, "raw_posts": posts, "raw_index": index,
        "stg_prices": staging.stage_prices(prices), "stg_posts": staging.stage_posts(posts), "stg_index": staging.stage_index(index),
    }
    return Q.run_checks(tables, [x for x in checks.DECLARED if x.table in tables])


@query
def dq_health(spark, d):
    t = {n: sample.table(spark, d, n) for n in ("events", "orders", "customer")}
    report = Q.run_checks(
        t,
        [
            Q.accepted_range("events", "value", 1),
            Q.unique("orders", "o_custkey"),
            Q.not_null("customer", "c_custkey"),
        ],
    )
    return S.health(report, ["unique(o_custkey)"])


# Payloads and contracts.


@query
def json_map_flatten(spark, d):
    """One two-coin payload per event: its type at its value, and '<type>_k' at props.k."""
    quotes = F.map_from_arrays(
        F.array("event_type", F.concat("event_type", F.lit("_k"))),
        F.array(
            F.struct(F.col("value").alias("usd")),
            F.struct(F.get_json_object("props", "$.k").cast("double").alias("usd")),
        ),
    )
    docs = sample.events(spark, d).select("ts", F.to_json(quotes).alias("payload"))
    return payloads.flatten_prices(docs, fetched_at=F.col("ts")).withColumn("price", C.safe_double("price"))


@query
def payload_string_prices(spark, d):
    """Quotes in quotes: every third price is text, some of it no number. The contract reads or rejects them."""
    k = F.col("user_id") % 3
    quote = F.when(k == 0, F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))).when(k == 1, F.col("value").cast("string"))
    text = F.concat(F.lit('{"'), F.col("event_type"), F.lit('": {"usd": '), F.coalesce(quote, F.lit('"n/a"')), F.lit("}}"))
    rows = payloads.flatten_prices(sample.events(spark, d).select("ts", text.alias("payload")), fetched_at=F.col("ts"))
    return K.valid_records(K.annotate(rows, K.PRICES))


@query
def payload_broken_documents(spark, d):
    """Every fifth document is cut short; what lands, by status, adds up to the input."""
    path = scratch_dir(spark, "broken")
    whole = F.to_json(F.map_from_arrays(F.array("event_type"), F.array(F.struct(F.col("value").alias("usd")))))
    text = F.when(F.col("event_id") % 5 == 0, F.expr("substring(w, 1, length(w) - 1)")).otherwise(F.col("w"))
    docs = sample.events(spark, d).withColumn("w", whole).select("ts", text.alias("payload"))
    ingest.ingest("raw_prices", docs, path, dt.date(2024, 2, 1), fetched_at=F.col("ts"))
    landed = spark.read.parquet(f"{path}/coingecko/2024-02-01")
    errors = F.coalesce(F.concat_ws(",", K.ERRORS), F.lit(""))
    return landed.groupBy("status", errors.alias("errors")).agg(F.count(F.lit(1)).alias("records"))


@query
def payload_index_values(spark, d):
    """One value per order, in five JSON forms; text has to be whole, numbers are cut, the rest is dropped."""
    k, n = F.col("o_orderkey") % 5, (F.floor("o_totalprice") % 101).cast("string")
    value = (
        F.when(k == 0, F.concat(F.lit('"'), n, F.lit('"')))
        .when(k == 1, F.concat(F.lit('"'), n, F.lit('.0"')))
        .when(k == 2, F.concat(n, F.lit(".7")))
        .when(k == 3, F.concat(F.lit("-"), n, F.lit(".7")))
        .otherwise(F.lit("null"))
    )
    stamp = (F.lit(1704067200) + F.col("o_orderkey")).cast("string")
    text = F.concat(F.lit('{"data": [{"value": '), value, F.lit(', "value_classification": "c", "timestamp": "'), stamp, F.lit('"}]}'))
    return payloads.flatten_index(sample.table(spark, d, "orders").select(text.alias("payload")))


def _odd_messages(spark, d):
    """Trade messages of which some are empty, carry no number as a price, lack a symbol or are no JSON."""
    k = F.col("event_id") % 10
    price = F.when(k == 1, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    symbol = F.when(k != 2, F.col("event_type"))
    whole = F.to_json(F.struct(F.unix_millis("ts").alias("E"), symbol.alias("s"), price.alias("p")))
    return sample.events(spark, d).select(
        "event_id", F.when(k == 3, F.lit("{}")).when(k == 4, F.lit("")).when(k == 5, F.lit("{broken")).otherwise(whole).alias("payload")
    )


@query
def trades_rejected(spark, d):
    """A stream with bad messages: ticks and rejected messages land side by side and nothing stops."""
    path = scratch_dir(spark, "odd")
    _odd_messages(spark, d).select("payload").write.text(f"{path}/in")
    stream = trades.file_stream(spark, f"{path}/in", T.StructType([T.StructField("value", T.StringType())]), "text")
    trades.append_ticks(stream, "value", f"{path}/ticks", f"{path}/rejected", f"{path}/state").awaitTermination()
    ticks = spark.read.parquet(f"{path}/ticks").select(F.lit("tick").alias("kind"))
    rejected = spark.read.parquet(f"{path}/rejected").select(F.lit("rejected").alias("kind"))
    return ticks.unionByName(rejected).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def json_array_flatten(spark, d):
    """Index payloads of three readings; one has no whole-number value and is dropped."""
    key = F.col("o_orderkey")

    def reading(value, seconds):
        return F.struct(
            value.cast("string").alias("value"),
            F.col("o_orderpriority").alias("value_classification"),
            seconds.cast("string").alias("timestamp"),
        )

    seconds = F.lit(1704067200) + key % 100000
    value = F.floor("o_totalprice") % 101
    items = F.array(reading(value, seconds), reading(F.lit("n/a"), seconds), reading(value, seconds + 86400))
    docs = sample.table(spark, d, "orders").select(F.to_json(F.struct(items.alias("data"))).alias("payload"))
    return payloads.flatten_index(docs)


@query
def json_posts_flatten(spark, d):
    """A listing per conversation turn, with the whole text as title."""
    post = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.col("text").alias("title"),
        F.length("text").alias("score"),
        F.when(F.col("turn") > 0, F.lit(1704067200.5) + F.col("turn") * 60).alias("created_utc"),
    )
    children = F.array(F.struct(post.alias("data")))
    docs = sample.table(spark, d, "conversations").select(
        F.to_json(F.struct(F.struct(children.alias("children")).alias("data"))).alias("payload")
    )
    return K.valid_records(K.annotate(payloads.flatten_posts(docs), K.POSTS))


@query
def json_trending_flatten(spark, d):
    """A list per event with one coin and one empty entry."""
    item = F.struct(
        F.col("event_type").alias("id"),
        F.initcap("event_type").alias("name"),
        F.upper("event_type").alias("symbol"),
        (F.col("user_id") % 15).alias("score"),
    )
    coins = F.array(F.struct(item.alias("item")), F.struct(F.when(F.lit(False), item).alias("item")))
    docs = sample.events(spark, d).select("ts", F.to_json(F.struct(coins.alias("coins"))).alias("payload"))
    return K.valid_records(K.annotate(payloads.flatten_trending(docs, fetched_at=F.col("ts")), K.TRENDING))


@query
def fallback_rows(spark, d):
    """An empty feed falls back to placeholders; the feed of all turns does not."""
    at = F.lit("2024-01-05 10:00:00").cast("timestamp")
    turns = sample.table(spark, d, "conversations")

    def feed(name, turns):
        rows = turns.select(
            F.concat_ws("-", "conv_id", "turn").alias("id"),
            F.col("text").alias("title"),
            F.length("text").cast("bigint").alias("score"),
            F.lit("2024-01-01 00:00:00").alias("created_utc"),
            F.lit("").alias("url"),
        )
        return payloads.or_fallback(rows, payloads.fallback_posts(spark, at)).withColumn("feed", F.lit(name))

    return feed("nobody", turns.where(F.col("role") == "nobody")).unionByName(feed("all", turns))


def _drifting_prices(spark, d):
    """Raw price rows of which some break the contract: negative or unreadable prices, empty symbols."""
    e = sample.events(spark, d)
    k = F.col("user_id") % 15
    return e.select(
        "event_id",
        F.when(k == 7, "").when(k == 8, None).otherwise(F.col("event_type")).alias("symbol"),
        F.when(k == 9, "n/a").otherwise((F.col("value") - 5).cast("string")).alias("price"),
        F.date_format("ts", C.SECOND_FORMAT).alias("timestamp"),
        F.date_format("ts", "yyyy-MM-dd").alias("ingestion_date"),
    )


@query
def contract_valid(spark, d):
    return K.valid_records(K.annotate(_drifting_prices(spark, d), K.PRICES, keep=("event_id",)))


@query
def contract_quarantine(spark, d):
    bad = K.quarantined_records(K.annotate(_drifting_prices(spark, d), K.PRICES))
    return bad.select(F.get_json_object(K.RECORD, "$.event_id").cast("bigint").alias("event_id"), F.col(K.ERRORS).alias("errors"))


@query
def contract_land(spark, d):
    """Rows per status as landed, valid and quarantined side by side."""
    path = scratch_dir(spark, "landed")
    K.land(_drifting_prices(spark, d), K.PRICES, path)
    return spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("records"))


@query
def contract_index(spark, d):
    """Order prices as index values around the bounds 0 and 100, with the reasons of those turned away."""
    k = F.col("o_orderkey")
    value = F.when(k % 7 == 0, F.lit("n/a")).otherwise(((F.floor("o_totalprice") % 121) - 10).cast("string"))
    rows = sample.table(spark, d, "orders").select(
        "o_orderkey", value.alias("value"), F.col("o_orderpriority").alias("value_classification"),
        F.when(k % 2 == 0, k.cast("string")).alias("timestamp"), F.lit("2024-01-01").alias("ingestion_date"),
    )
    judged = K.annotate(rows, K.INDEX, keep=("o_orderkey",))
    return judged.select("o_orderkey", "value", K.OK, F.concat_ws(",", K.ERRORS).alias("errors")).withColumnRenamed(K.OK, "ok")


@query
def land_keeps_good_day(spark, d):
    """A good batch, then one in which every record is invalid: the landed day is the first one."""
    path = scratch_dir(spark, "good-day")
    good = _drifting_prices(spark, d)
    K.land(good, K.PRICES, path)
    try:
        K.land(good.withColumn("symbol", F.lit("")), K.PRICES, path)
        refused = False
    except K.AllRecordsInvalid:
        refused = True
    back = spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("records"))
    return back.withColumn("refused", F.lit(refused))


@query
def publish_keeps_good_file(spark, d):
    """JSON lines published as Parquet under a day key; a later empty file is refused and changes nothing."""
    path = scratch_dir(spark, "publish")
    rows = sample.prices(spark, d).select("symbol", "price", F.date_format("timestamp", C.SECOND_FORMAT).alias("timestamp"))
    sinks.save_day(rows, path, "coingecko", "2024-01-01")
    sinks.save_day(rows.limit(0), path, "empty", "2024-01-01")
    schema, key = schemas.LAKE_TABLES["coingecko_prices"], f"{path}/raw/coingecko/2024-01-01/data.parquet"
    published = sinks.publish_parquet(spark, f"{path}/coingecko/2024-01-01", key, schema)
    try:
        sinks.publish_parquet(spark, f"{path}/empty/2024-01-01", key, schema)
        refused = False
    except Q.QualityError:
        refused = True
    back = spark.read.parquet(key).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.max("price").alias("high"))
    return back.withColumn("refused", F.lit(refused)).withColumn("published", F.lit(published).cast("bigint"))


@query
def contract_json_defaults(spark, d):
    """Post records as JSON text: a key the text lacks gets its default, a null stays null."""
    turns = sample.table(spark, d, "conversations")
    text = F.when(
        F.col("turn") % 2 == 0, F.to_json(F.struct(F.concat_ws("-", "conv_id", "turn").alias("id"), "conv_id"))
    ).otherwise(
        F.to_json(
            F.struct(
                F.concat_ws("-", "conv_id", "turn").alias("id"),
                F.lit(None).cast("string").alias("title"),
                F.length("text").alias("score"),
                F.lit("/u").alias("url"),
            ),
            {"ignoreNullFields": "false"},
        )
    )
    rows = K.parse_json_records(turns.select(text.alias("record")), "record", K.POSTS)
    return K.valid_records(K.annotate(rows, K.POSTS))


@query
def bronze_daily_price(spark, d):
    """Payloads through contract and bronze into staging and the daily average."""
    quotes = F.map_from_arrays(F.array("event_type"), F.array(F.struct((F.col("value") - 5).alias("usd"))))
    docs = sample.events(spark, d).select("ts", F.to_json(quotes).alias("payload"))
    root = scratch_dir(spark, "bronze")
    ingest.ingest("raw_prices", docs, root, dt.date(2024, 2, 1), fetched_at=F.col("ts"))
    raw = ingest.bronze(spark, root)("raw_prices")
    return marts.daily_price(staging.stage_prices(raw, gated=True))


# Incremental facts.


def _latest_landed(spark, d) -> dt.date:
    return sample.prices(spark, d).agg(F.max("dt")).first()[0]


def _until(spark, d, day: dt.date):
    """The sources as they were when only price days up to ``day`` had landed."""
    s = sample.sources(spark, d)
    return s.replaced(raw_prices=lambda: s("raw_prices").where(F.col("dt") <= F.lit(day)))


@query
def inc_daily_equals_full(spark, d):
    warehouse = daily.Warehouse(scratch_dir(spark, "inc-daily"))
    before = _latest_landed(spark, d) - dt.timedelta(days=2)
    daily.refresh_crypto_daily(spark, warehouse, _until(spark, d, before))
    daily.refresh_crypto_daily(spark, warehouse, sample.sources(spark, d))
    return warehouse.crypto_daily.read(spark)


@query
def inc_insights_emit_max(spark, d):
    warehouse = daily.Warehouse(scratch_dir(spark, "inc-insights"))
    before = _latest_landed(spark, d) - dt.timedelta(days=2)
    daily.refresh_market_insights(spark, warehouse, _until(spark, d, before))
    daily.refresh_market_insights(spark, warehouse, sample.sources(spark, d))
    return warehouse.market_insights.read(spark)


@query
def inc_versions(spark, d):
    """A warehouse in versions: two runs, of which the second leaves what a reader of the first version sees. In each
    version both facts hold the same days and coins."""
    warehouse = daily.VersionedWarehouse(scratch_dir(spark, "versions"))
    daily.build(spark, warehouse, _until(spark, d, _latest_landed(spark, d) - dt.timedelta(days=2)))
    first = warehouse.pinned(spark)
    daily.build(spark, warehouse, sample.sources(spark, d))

    def seen(w: daily.VersionedWarehouse) -> DataFrame:
        wide = w.market_insights.read(spark).select("record_id")
        both = w.crypto_daily.read(spark).join(wide, "record_id", "left_semi")
        return both.select("report_date", "coin_id", "avg_price", F.lit(w.version).cast("bigint").alias("version"))

    return seen(first).unionByName(seen(warehouse.pinned(spark)))


@query
def inc_late_data(spark, d):
    """A price rises late on a day before the newest one: the next run has it in the daily fact, whose lookback
    covers it, and not in the insights, which emit the newest day alone."""
    warehouse, good = daily.Warehouse(scratch_dir(spark, "late")), sample.sources(spark, d)
    newest = _latest_landed(spark, d)
    late = F.col("dt") == F.lit(newest - dt.timedelta(days=1))
    raised = F.when(late, F.col("price") + 1000).otherwise(F.col("price"))
    changed = good.replaced(raw_prices=lambda: good("raw_prices").withColumn("price", raised))
    daily.build(spark, warehouse, good)
    daily.build(spark, warehouse, changed)
    short = warehouse.crypto_daily.read(spark).select(F.lit("daily").alias("fact"), "report_date", "coin_id", "avg_price")
    wide = warehouse.market_insights.read(spark).select(F.lit("insights").alias("fact"), "report_date", "coin_id", "avg_price")
    return short.unionByName(wide)


@query
def backfill_dimensions(spark, d):
    """Days 10 to 30, then a backfill of the days before: no fact row is without its day or coin."""
    warehouse, good = daily.Warehouse(scratch_dir(spark, "backfill-dims")), sample.sources(spark, d)
    recent = F.col("dt") >= F.lit(dt.date(2024, 1, 10))
    daily.build(spark, warehouse, good.replaced(raw_prices=lambda: good("raw_prices").where(recent)))
    daily.backfill(spark, warehouse, good, dt.date(2024, 1, 1), dt.date(2024, 1, 9))
    report = Q.run_checks(daily.tables(spark, warehouse, good), checks.RELATIONSHIPS)
    days = warehouse.crypto_daily.read(spark).agg(F.count_distinct("report_date").alias("days"))
    return report.withColumn("days", F.lit(days.first()[0]))


@query
def upsert_no_delete(spark, d):
    """Days with posts get a new score, one coin is new, everything else must survive."""
    fact = daily.Warehouse(scratch_dir(spark, "upsert")).crypto_daily
    fact.replace(_crypto_daily(spark, d))
    rows = fact.read(spark)
    changed = rows.where("reddit_posts > 0").withColumn("reddit_score", F.col("reddit_score") + 1)
    added = (
        rows.where("coin_id = 'view'")
        .withColumn("coin_id", F.lit("newcoin"))
        .withColumn("record_id", C.surrogate_key("coin_id", "report_date"))
    )
    M.upsert(spark, fact, changed.unionByName(added))
    return fact.read(spark)


@query
def backfill_range(spark, d):
    """Facts built from prices that were wrong on three days, then rebuilt for those days."""
    warehouse = daily.Warehouse(scratch_dir(spark, "backfill"))
    good = sample.sources(spark, d)
    start, end = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
    wrong = F.col("dt").between(F.lit(start), F.lit(end))
    doubled = F.when(wrong, F.col("price") * 2).otherwise(F.col("price"))
    broken = good.replaced(raw_prices=lambda: good("raw_prices").withColumn("price", doubled))
    daily.refresh_crypto_daily(spark, warehouse, broken)
    daily.refresh_market_insights(spark, warehouse, broken)
    daily.backfill(spark, warehouse, good, start, end)
    return warehouse.market_insights.read(spark)


@query
def reappend_idempotent(spark, d):
    """Staging the raw rows appended twice."""
    raw = sample.prices(spark, d)
    return staging.stage_prices(raw.unionByName(raw))


@query
def stg_prices_ungated(spark, d):
    """Prices that passed no contract: rows without a symbol or time collapse into one, the latest and highest."""
    k = F.col("user_id") % 20
    raw = sample.events(spark, d).select(
        F.when(k != 3, F.col("event_type")).alias("symbol"),
        F.col("value").alias("price"),
        F.when(k != 4, F.date_trunc("HOUR", "ts")).alias("timestamp"),
    )
    return staging.stage_prices(raw).select("coin_id", "price_usd", "recorded_at")


@query
def staging_views(spark, d):
    """Staging registered as views and queried by name."""
    ingest.register_views({n: df for n, df in daily.staged(sample.sources(spark, d)).items()})
    return spark.sql(
        """
        SELECT 'stg_prices' AS view, count(*) AS n, count(DISTINCT coin_id) AS keys FROM stg_prices
        UNION ALL SELECT 'stg_posts', count(*), count(DISTINCT post_id) FROM stg_posts
        UNION ALL SELECT 'stg_index', count(*), count(DISTINCT report_date) FROM stg_index
        UNION ALL SELECT 'stg_trending', count(*), count(DISTINCT coin_id) FROM stg_trending
        """
    )


def _outcome(action: Callable[[], object], error: type[Exception]) -> str:
    """'ok', or 'refused' if the action raised."""
    try:
        action()
    except error:
        return "refused"
    return "ok"


@query
def gates(spark, d):
    """Every gate that raises, on data that passes and on data that does not, with the rows it saw."""
    path, sources = scratch_dir(spark, "gates"), sample.sources(spark, d)
    rows = sample.prices(spark, d).select("symbol", "price", F.date_format("timestamp", C.SECOND_FORMAT).alias("timestamp"))
    sinks.save_day(rows, path, "full", "2024-01-01")
    sinks.save_day(rows.limit(0), path, "empty", "2024-01-01")
    schema = schemas.LAKE_TABLES["coingecko_prices"]
    full, empty = f"{path}/full/2024-01-01", f"{path}/empty/2024-01-01"
    quotes = F.map_from_arrays(F.array("event_type"), F.array(F.struct("value").alias("usd")))
    docs = sample.events(spark, d).select("ts", F.to_json(quotes).alias("payload"))
    hollow = docs.withColumn("payload", F.lit("{}"))
    newest, days = _latest_landed(spark, d), dt.timedelta(days=1)

    def run(day):
        return daily.run(spark, daily.Warehouse(f"{path}/warehouse"), sources, expected="click,view", report_date=day)

    def flattened(docs):
        return Q.require_rows(payloads.flatten_prices(docs, fetched_at=F.col("ts")), "prices")

    seen = Q.require_partition_rows(spark, full)
    found = [
        ("partition_rows", "full", _outcome(lambda: Q.require_partition_rows(spark, full), Q.QualityError), seen),
        ("partition_rows", "empty", _outcome(lambda: Q.require_partition_rows(spark, empty), Q.QualityError), 0),
        ("required_lines", "full", _outcome(lambda: lake.read_required_json_lines(spark, full, schema), Q.QualityError), seen),
        ("required_lines", "empty", _outcome(lambda: lake.read_required_json_lines(spark, empty, schema), Q.QualityError), 0),
        ("source_rows", "full", _outcome(lambda: flattened(docs), Q.QualityError), seen),
        ("source_rows", "empty", _outcome(lambda: flattened(hollow), Q.QualityError), 0),
        ("landing_day", "missing", _outcome(lambda: run(newest + 400 * days), Q.QualityError), 0),
    ]
    return spark.createDataFrame(found, "gate string, case string, outcome string, rows long")


# Lake files.


@query
def jsonl_roundtrip(spark, d):
    path = scratch_dir(spark, "jsonl")
    rows = sample.prices(spark, d).withColumn("timestamp", F.date_format("timestamp", C.SECOND_FORMAT))
    sinks.save_days(rows, path)
    return lake.read_json_lines(spark, f"{path}/dt=*/*.json", schemas.LAKE_TABLES["coingecko_prices"])


@query
def path_date_partition(spark, d):
    """Rows and value per day, the day read back from the folder name."""
    path = scratch_dir(spark, "days")
    sample.events(spark, d).withColumn("dt", F.to_date("ts")).hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    rows = lake.read_day_folders(spark, path, schema)
    return rows.groupBy("dt", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query
def external_table(spark, d):
    """A catalog table over day folders."""
    path = scratch_dir(spark, "table")
    rows = sample.prices(spark, d).withColumn("timestamp", F.date_format("timestamp", C.SECOND_FORMAT))
    rows.hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    name = catalog.register_lake_table(spark, f"lake_{path[-32:]}", "coingecko_prices", path, database_location=f"{path}-db")
    return spark.table(name).groupBy("dt", "symbol").agg(F.count(F.lit(1)).alias("n"), F.max("price").alias("high"))


@query
def schema_discovery(spark, d):
    """A lake table that finds its columns: the newest day brings one more, and that day alone is looked into."""
    path = scratch_dir(spark, "found")
    rows = sample.prices(spark, d).select("symbol", "price", "dt")
    newest = F.col("dt") == F.lit(_latest_landed(spark, d))
    where = {"database": f"found_{path[-32:]}", "table": "prices", "root": path, "database_location": f"{path}-db"}
    rows.where(~newest).hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    catalog.register_discovered(spark, **where)
    more = rows.where(newest).withColumn("venue", F.upper("symbol"))
    more.hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(path)
    name, read = catalog.register_discovered(spark, **where)
    found = spark.table(name).groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.count("venue").alias("n_venues"))
    return found.withColumn("folders_read", F.lit(len(read)).cast("bigint"))


@query
def external_lake_tables(spark, d):
    """Posts, index and trending as catalog tables over day folders, one of them with bare dates."""
    path = scratch_dir(spark, "lake")
    posts = sample.posts(spark, d).withColumn("created_utc", F.date_format("created_utc", C.SECOND_FORMAT))
    index = sample.index(spark, d).withColumn("timestamp", F.col("timestamp").cast("string"))
    trending = sample.trending(spark, d).withColumn("timestamp", F.date_format("timestamp", C.SECOND_FORMAT))
    frames = {"reddit_posts": posts, "fear_greed_index": index, "coingecko_trending": trending}
    out = []
    for table, df in frames.items():
        root = f"{path}/{catalog.LAKE_FOLDERS[table]}"
        df.hint("rebalance", "dt").write.partitionBy("dt").parquet(root)
        name = catalog.register_lake_table(spark, f"lake_{path[-32:]}", table, root, database_location=f"{path}-db")
        counts = spark.table(name).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
        out.append(counts.select(F.lit(table).alias("table"), "dt", "n"))
    return lake.union_by_name(out)


@query
def union_by_name(spark, d):
    """Customers and suppliers under the union of their columns."""
    names = {"c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"}
    customers = sample.table(spark, d, "customer").select(*names).withColumnsRenamed(names)
    names = {"s_acctbal": "balance", "s_name": "name", "s_nationkey": "nation"}
    suppliers = sample.table(spark, d, "supplier").select(*names).withColumnsRenamed(names)
    return lake.union_by_name([customers, suppliers])


@query
def compaction(spark, d):
    """Posts written as JSON lines, compacted to Parquet and read back whole."""
    raw, out = scratch_dir(spark, "small"), scratch_dir(spark, "compact")
    posts = sample.posts(spark, d).withColumn("created_utc", F.date_format("created_utc", C.SECOND_FORMAT))
    sinks.save_day(posts, raw, "posts", "2024-01-01")
    sinks.compact(spark, raw, out, schemas.RAW_POSTS)
    return spark.read.schema(schemas.RAW_POSTS).parquet(out)


def _renamed(spark, folder: str, suffixes: dict[str, str]) -> None:
    """Give the files in the folders of a folder other suffixes, many at a time."""
    fs, _ = file_system(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def rename(f: str) -> None:
        old = next((s for s in suffixes if f.endswith(s)), None)
        if old is not None and not fs.rename(path(f), path(f.removesuffix(old) + suffixes[old])):
            raise OSError(f"cannot rename {f}")

    with ThreadPoolExecutor(16) as pool:
        for below in child_names(spark, folder):
            for _ in pool.map(rename, [f"{folder}/{below}/{name}" for name in child_names(spark, f"{folder}/{below}")]):
                pass


@query
def mixed_json_compaction(spark, d):
    """Events in five shapes, named alike: lines as .json and .jsonl, compressed lines, arrays over many lines
    and on one. Compacted and read back they are the table; broken lines are counted. A record beyond the limit,
    and a file without any, are set aside."""
    raw, out, limit = scratch_dir(spark, "mixed"), scratch_dir(spark, "mixed-out"), 1 << 20
    e = sample.events(spark, d).select("event_id", "event_type", "value", F.date_format("ts", C.SECOND_FORMAT).alias("ts"))
    k = F.col("event_id") % 5
    line = e.select(F.to_json(F.struct(*e.columns)).alias("value"), "event_id")
    line.where(k == 0).select("value").write.text(f"{raw}/lines")
    line.where(k == 1).select("value").write.option("compression", "gzip").text(f"{raw}/gz")
    listed = line.groupBy(F.floor(F.col("event_id") / 500).alias("b"), k.alias("k")).agg(F.sort_array(F.collect_list("value")).alias("v"))
    spread = F.concat(F.lit("[\n  "), F.array_join("v", ",\n  "), F.lit("\n]"))
    close = F.concat(F.lit("["), F.array_join("v", ","), F.lit("]"))
    listed.where("k = 2").select(spread.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{raw}/documents")
    listed.where("k = 3").select(close.alias("value")).write.text(f"{raw}/arrays")
    bad = F.when(F.col("event_id") % 50 == 4, F.array("value", F.lit("{broken"))).otherwise(F.array("value"))
    line.where(k == 4).select(F.explode(bad).alias("value")).write.text(f"{raw}/broken")
    large = F.concat(F.lit('{\n"event_id": 1, "pad": "'), F.expr(f"repeat(value, CAST({limit} div length(value) + 1 AS INT))"), F.lit('"\n}'))
    first = line.orderBy("event_id").limit(1)
    first.select(F.regexp_replace("value", '"', "'").alias("value")).select(large.alias("value")).write.text(f"{raw}/large")
    first.select(F.lit("{no record").alias("value")).write.text(f"{raw}/none")
    _renamed(spark, raw, {".txt.gz": ".jsonl.gz", ".txt": ".json"})
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        report = sinks.compact_report(spark, raw, out, e.schema, document_bytes=limit)
    counts = {name: F.lit(report[name]).cast("bigint") for name in ("skipped_lines", "set_aside")}
    return spark.read.schema(e.schema).parquet(out).withColumns(counts)


@query
def append_observed(spark, d):
    """Two appends to one raw table with the rows each load reported."""
    path = scratch_dir(spark, "raw")
    first = sinks.append_checked(sample.prices(spark, d), path)
    second = sinks.append_checked(sample.prices(spark, d), path)
    return (
        spark.read.parquet(path)
        .agg(F.count(F.lit(1)).alias("stored"))
        .withColumn("first_load", F.lit(first).cast("bigint"))
        .withColumn("second_load", F.lit(second).cast("bigint"))
    )


@query
def latest_row_per_key(spark, d):
    """The generic keep-latest operator: each customer's newest order."""
    o = sample.table(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    return latest_per_key(o, ["o_custkey"], ["day", "o_orderkey"])


# Streaming, run to completion over the files present.


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _messages(spark, d):
    # A glob finds a single file as well as a folder of part files.
    e = trades.file_stream(spark, f"{d}/{{events}}.parquet", EVENT_SCHEMA, "parquet")
    message = F.struct(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("E"),
        F.col("event_type").alias("s"),
        F.col("value").cast("string").alias("p"),
    )
    return e.select(F.to_json(message).alias("payload"))


def _streamed(spark, df, label):
    path = scratch_dir(spark, label)
    trades.append_sink(df, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query
def stream_trades_append(spark, d):
    return _streamed(spark, payloads.flatten_trades(_messages(spark, d)), "ticks")


def _hourly(spark, d):
    return payloads.flatten_trades(_messages(spark, d)).withColumn("event_time", F.date_trunc("HOUR", "event_time"))


@query
def stream_dedup(spark, d):
    return _streamed(spark, trades.closed_ticks(_hourly(spark, d)), "distinct")


@query
def stream_daily_avg(spark, d):
    return _streamed(spark, trades.closed_daily_average(_hourly(spark, d)), "averages")


@query
def stream_late_corrected(spark, d):
    """Ticks in three files, the last of which holds every seventh tick of all days: the days that were closed by
    then are corrected, and the rows that came late are counted."""
    path = scratch_dir(spark, "late")
    ticks = sample.events(spark, d).select(F.col("ts").cast("timestamp").alias("event_time"), F.col("event_type").alias("symbol"), F.col("value").alias("price"))
    late = F.unix_seconds("event_time") % 7 == 0
    early = F.col("event_time") < F.lit("2024-01-16").cast("timestamp")
    follow = trades.DailyAverages(f"{path}/out", delay="1 day")
    for part in (~late & early, ~late & ~early, late):
        ticks.where(part).write.mode("append").parquet(f"{path}/in")
        stream = trades.file_stream(spark, f"{path}/in", ticks.schema, "parquet")
        follow.start(stream, f"{path}/state").awaitTermination()
    late_rows = follow.progress(spark).agg(F.sum("late")).first()[0]
    return follow.averages(spark).withColumn("late_rows", F.lit(late_rows).cast("bigint"))


@query
def stream_freshness(spark, d):
    ticks = _streamed(spark, payloads.flatten_trades(_messages(spark, d)), "fresh")
    return Q.freshness(ticks, max_delay_minutes=10, as_of=F.lit(AS_OF).cast("timestamp"))
