"""DuckDB SQL for the registered queries, over the driver tables registered as views."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_DAY = "TIMESTAMP '2024-01-01 00:00:00'"
_TS = "'%Y-%m-%d %H:%M:%S'"


def _uneven_day(key: str) -> str:
    return f"CAST(({key} % 30) * ({key} % 30) % 30 AS INTEGER)"


# Views shared by many queries. Each names what it needs from the ones above it.
_VIEWS = {
    "prices": f"""
        SELECT event_type AS symbol, value AS price, date_trunc('hour', ts) AS moment, CAST(ts AS DATE) AS dt
        FROM events""",
    "posts": f"""
        SELECT CAST(conv_id AS VARCHAR) AS id, text AS title, length(text) AS score,
               {_DAY} + to_days({_uneven_day("conv_id")}) + to_minutes(turn) AS created
        FROM conversations""",
    "readings": """
        SELECT 1704067200 + (o_orderkey % 28) * 86400 + (o_orderkey % 86400) * 7919 % 86400 AS sec,
               CAST(floor(o_totalprice) AS BIGINT) % 101 AS value,
               o_orderpriority AS class,
               DATE '2024-01-01' + CAST(o_orderkey % 28 + 1 AS INTEGER) AS dt
        FROM orders""",
    "trend_rows": """
        SELECT event_type AS coin_id, upper(event_type[1]) || event_type[2:] AS name,
               upper(event_type[1:3]) AS symbol, user_id AS market_cap_rank, user_id % 15 AS score,
               ts - to_days(CAST((day(ts) + length(event_type)) % 2 AS INTEGER)) AS moment
        FROM events""",
    "ticks": """
        SELECT lower(symbol) AS coin_id, moment AS recorded_at, max(price) AS price_usd
        FROM prices GROUP BY ALL""",
    "post_versions": """
        SELECT id, max_by(title, (created, score, title)) AS title, max_by(score, (created, score, title)) AS score,
               max(created) AS created
        FROM posts GROUP BY id""",
    "index_days": """
        SELECT CAST(make_timestamp(sec * 1000000) AS DATE) AS report_date, max(sec) AS sec,
               max_by(value, (sec, value, class)) AS value, max_by(class, (sec, value, class)) AS class
        FROM readings GROUP BY 1""",
    "trend_days": """
        SELECT DISTINCT ON (coin_id, CAST(moment AS DATE)) *, CAST(moment AS DATE) AS report_date
        FROM trend_rows
        ORDER BY coin_id, CAST(moment AS DATE), moment DESC, score DESC, name DESC, symbol DESC, market_cap_rank DESC""",
    "price_days": """
        SELECT CAST(recorded_at AS DATE) AS report_date, coin_id, avg(price_usd) AS avg_price, count(*) AS ticks
        FROM ticks GROUP BY ALL""",
    "post_days": """
        SELECT CAST(created AS DATE) AS report_date, count(id) AS posts, CAST(sum(score) AS BIGINT) AS engagement
        FROM post_versions GROUP BY 1""",
    "fact": """
        SELECT md5(coin_id || '-' || CAST(report_date AS VARCHAR)) AS record_id, report_date, coin_id, avg_price,
               ifnull(posts, 0) AS posts, ifnull(engagement, 0) AS engagement
        FROM price_days LEFT JOIN post_days USING (report_date)""",
    "wide": """
        SELECT fact.*, ifnull(i.value, 50) AS fng, ifnull(i.class, 'Neutral') AS class,
               t.coin_id IS NOT NULL AS is_trending, ifnull(t.score, 0) AS trend
        FROM fact LEFT JOIN index_days i USING (report_date)
        LEFT JOIN trend_days t USING (report_date, coin_id)""",
    "insights": """
        SELECT *, CAST(round(0.7::DOUBLE * fng
                             + 0.3::DOUBLE * least(100.0::DOUBLE, posts * 5.0::DOUBLE + engagement / 10.0::DOUBLE)) AS BIGINT) AS score,
               avg(avg_price) OVER week AS price_7, avg(posts) OVER week AS posts_7,
               corr(avg_price, posts) OVER week AS corr_7
        FROM wide
        WINDOW week AS (PARTITION BY coin_id ORDER BY report_date ROWS 6 PRECEDING)""",
    "texts": f"""
        SELECT lower(text) AS t, DATE '2024-01-01' + {_uneven_day("doc_id")} AS dt FROM documents""",
    "said": """
        SELECT dt AS report_date,
               count(*) FILTER (contains(t, 'eth')) AS eth_mentions,
               count(*) FILTER (contains(t, 'dot') OR contains(t, 'polkadot')) AS dot_mentions,
               count(*) FILTER (contains(t, 'the ') OR contains(t, 'der ')) AS the_mentions,
               count(*) FILTER (contains(t, 'qqqq') OR contains(t, 'bitcoin')) AS none_mentions
        FROM texts GROUP BY dt""",
    "listing": """
        SELECT CASE lower(symbol) WHEN 'click' THEN 'CLK' WHEN 'view' THEN 'VW' ELSE upper(symbol) END AS symbol,
               price, moment, dt
        FROM prices""",
    "ungated": """
        SELECT coin_id, recorded_at, max(price_usd) AS price_usd FROM loose
        WHERE coin_id IS NOT NULL AND recorded_at IS NOT NULL GROUP BY ALL
        UNION ALL (SELECT coin_id, recorded_at, price_usd FROM loose WHERE coin_id IS NULL OR recorded_at IS NULL
                   ORDER BY recorded_at DESC NULLS LAST, price_usd DESC NULLS LAST, coin_id DESC NULLS LAST LIMIT 1)""",
    "loose": """
        SELECT CASE WHEN user_id % 20 <> 3 THEN lower(event_type) END AS coin_id, value AS price_usd,
               CASE WHEN user_id % 20 <> 4 THEN date_trunc('hour', ts) END AS recorded_at
        FROM events""",
    "drifting": f"""
        SELECT event_id, user_id % 15 AS k, event_type, value - 5 AS price,
               strftime(ts, {_TS}) AS timestamp, strftime(ts, '%Y-%m-%d') AS ingestion_date
        FROM events""",
    "turns": """
        SELECT conv_id, turn, concat_ws('-', conv_id, turn) AS id, role, text FROM conversations""",
    "messages": """
        SELECT date_trunc('second', ts) AS event_time, event_type AS symbol, value AS price FROM events""",
    "closed": """
        SELECT hour AS event_time, symbol, max(price) AS price
        FROM (SELECT date_trunc('hour', event_time) AS hour, symbol, price FROM messages)
        WHERE hour <= (SELECT date_trunc('hour', max(event_time)) - INTERVAL 2 DAY FROM messages)
        GROUP BY hour, symbol""",
}
_NEEDS = {
    "ticks": ["prices"],
    "post_versions": ["posts"],
    "index_days": ["readings"],
    "trend_days": ["trend_rows"],
    "price_days": ["ticks"],
    "post_days": ["post_versions"],
    "fact": ["price_days", "post_days"],
    "wide": ["fact", "index_days", "trend_days"],
    "insights": ["wide"],
    "said": ["texts"],
    "listing": ["prices"],
    "closed": ["messages"],
    "ungated": ["loose"],
}


def _needed(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in out:
            out.append(name)

    for name in names:
        add(name)
    return out


def oracle(name: str, views: tuple[str, ...], sql: str) -> None:
    prefix = ",\n".join(f"{v} AS ({_VIEWS[v]})" for v in _needed(views))
    ORACLES[name] = f"WITH {prefix}\n{sql}" if prefix else sql


_FACT_ROW = """record_id, CAST(report_date AS VARCHAR) AS report_date, coin_id, round(avg_price, 8) AS avg_price,
       posts AS reddit_posts, engagement AS reddit_score"""
_INSIGHT_ROW = """record_id, CAST(report_date AS VARCHAR) AS report_date, coin_id, round(avg_price, 8) AS avg_price,
       posts AS reddit_posts, engagement AS reddit_engagement, fng AS fng_value, class AS fng_classification,
       is_trending, trend AS trending_score, score AS sentiment_score, round(price_7, 8) AS avg_price_7d,
       round(posts_7, 8) AS avg_reddit_posts_7d,
       CASE WHEN corr_7 IS NULL OR isnan(corr_7) THEN 0.0 ELSE round(corr_7, 8) END AS price_social_corr_7d"""
_TICK_ROW = f"""coin_id || '_' || strftime(recorded_at, {_TS}) || '+00' AS record_id, coin_id,
       round(price_usd, 8) AS price_usd, strftime(recorded_at, {_TS}) AS recorded_at"""

oracle("stg_prices_dedup", ("ticks",), f"SELECT {_TICK_ROW} FROM ticks")
oracle("reappend_idempotent", ("ticks",), f"SELECT {_TICK_ROW} FROM ticks")
oracle(
    "stg_posts_dedup",
    ("post_versions",),
    f"""SELECT id AS record_id, id AS post_id, title, score, strftime(created, {_TS}) AS created_at,
       strftime(created, '%Y-%m-%d') AS report_date FROM post_versions""",
)
oracle(
    "stg_fng_dedup",
    ("index_days",),
    """SELECT CAST(report_date AS VARCHAR) AS record_id, CAST(report_date AS VARCHAR) AS report_date,
       sec AS fng_timestamp, value AS fng_value, class AS fng_classification FROM index_days""",
)
oracle(
    "stg_trending_dedup",
    ("trend_days",),
    f"""SELECT coin_id || '_' || CAST(report_date AS VARCHAR) AS record_id, coin_id, name, symbol, market_cap_rank,
       score AS trending_score, strftime(moment, {_TS}) AS recorded_at, CAST(report_date AS VARCHAR) AS report_date
FROM trend_days""",
)
oracle(
    "daily_avg_price",
    ("price_days",),
    "SELECT CAST(report_date AS VARCHAR) AS report_date, coin_id, round(avg_price, 8) AS avg_price FROM price_days",
)
oracle(
    "daily_posts",
    ("post_days",),
    "SELECT CAST(report_date AS VARCHAR) AS report_date, posts AS total_posts, engagement AS total_engagement FROM post_days",
)
for _name in ("fct_crypto_daily", "inc_daily_equals_full"):
    oracle(_name, ("fact",), f"SELECT {_FACT_ROW} FROM fact")
for _name in ("fct_market_insights", "inc_insights_emit_max", "backfill_range"):
    oracle(_name, ("insights",), f"SELECT {_INSIGHT_ROW} FROM insights")
oracle(
    "left_join_defaults",
    (),
    """SELECT c_custkey, c_mktsegment, ifnull(n, 0) AS orders, round(ifnull(s, 0.0), 8) AS spent, n IS NOT NULL AS has_orders
FROM customer LEFT JOIN (SELECT o_custkey, count(o_orderkey) AS n, sum(o_totalprice) AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
oracle(
    "surrogate_key",
    (),
    """SELECT o_orderkey, md5(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority ELSE '_dbt_utils_surrogate_key_null_' END
       || '-' || strftime(o_orderdate, '%Y-%m-%d') || '-' || CAST(o_custkey AS VARCHAR)) AS record_id FROM orders""",
)
oracle(
    "sentiment_score",
    (),
    """SELECT CAST(round(0.7::DOUBLE * l_quantity + 0.3::DOUBLE
       * least(100.0::DOUBLE, l_linenumber::DOUBLE * 5.0::DOUBLE + (l_extendedprice / 200) / 10.0::DOUBLE)) AS BIGINT) AS sentiment_score,
       count(*) AS n FROM lineitem GROUP BY 1""",
)
oracle(
    "rolling_avg_7",
    ("price_days",),
    """SELECT CAST(report_date AS VARCHAR) AS report_date, coin_id, round(avg_price, 8) AS avg_price,
       round(avg(avg_price) OVER (PARTITION BY coin_id ORDER BY report_date ROWS 6 PRECEDING), 8) AS avg_price_7d
FROM price_days""",
)
oracle(
    "rolling_corr_7",
    ("price_days",),
    """SELECT CAST(report_date AS VARCHAR) AS report_date, coin_id, round(avg_price, 8) AS avg_price, ticks,
       CASE WHEN c IS NULL OR isnan(c) THEN 0.0 ELSE round(c, 8) END AS corr_7d
FROM (SELECT *, corr(avg_price, ticks) OVER (PARTITION BY coin_id ORDER BY report_date ROWS 6 PRECEDING) AS c FROM price_days)""",
)
oracle(
    "is_trending_flag",
    ("price_days", "trend_days"),
    """SELECT CAST(report_date AS VARCHAR) AS report_date, coin_id, ifnull(score, 0) AS trending_score,
       t.name IS NOT NULL AS is_trending
FROM price_days LEFT JOIN trend_days t USING (report_date, coin_id)""",
)
oracle("dim_coin", (), "SELECT DISTINCT lower(event_type) AS coin_id FROM events")
oracle(
    "dim_date",
    (),
    """SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date, CAST(year(ts) AS BIGINT) AS year,
       CAST(month(ts) AS BIGINT) AS month, CAST(day(ts) AS BIGINT) AS day FROM events""",
)

# Serving.
oracle(
    "api_latest_10",
    ("fact",),
    """SELECT CAST(report_date AS VARCHAR) AS date, coin_id AS coin, round(avg_price, 8) AS price,
       posts AS reddit_posts, engagement AS reddit_score
FROM fact WHERE coin_id = 'click' ORDER BY report_date DESC LIMIT 10""",
)
oracle(
    "fng_latest_90",
    ("readings",),
    """SELECT value, class AS value_classification, CAST(dt AS VARCHAR) AS dt, sec AS timestamp
FROM readings ORDER BY readings.dt DESC, sec DESC, value DESC, class DESC LIMIT 90""",
)
_DEDUPED = """SELECT day + 1 AS dt, sec, value, class FROM (SELECT report_date AS day, sec, value, class FROM index_days)"""
oracle(
    "fng_latest_90_dedup",
    ("index_days",),
    f"""SELECT value, class AS value_classification, CAST(dt AS VARCHAR) AS dt, sec AS timestamp
FROM ({_DEDUPED}) x ORDER BY x.dt DESC LIMIT 90""",
)
oracle(
    "fng_ma7_full_window",
    ("index_days",),
    f"""SELECT value, class AS value_classification, CAST(dt AS VARCHAR) AS dt, sec AS timestamp,
       CASE WHEN count(*) OVER w = 7 THEN round(avg(value) OVER w, 8) END AS ma
FROM (SELECT * FROM ({_DEDUPED}) ORDER BY dt DESC LIMIT 30) x
WINDOW w AS (ORDER BY x.dt ROWS 6 PRECEDING)""",
)
oracle(
    "fng_band",
    ("readings",),
    """SELECT value, count(*) AS n, CASE WHEN value < 35 THEN 'red' WHEN value > 65 THEN 'green' ELSE 'yellow' END AS badge
FROM readings GROUP BY value""",
)
oracle(
    "fng_latest",
    ("readings",),
    """SELECT value, class AS value_classification,
       CASE WHEN value < 35 THEN 'red' WHEN value > 65 THEN 'green' ELSE 'yellow' END AS badge, CAST(dt AS VARCHAR) AS dt
FROM readings ORDER BY readings.dt DESC, sec DESC, value DESC, class DESC LIMIT 1""",
)
oracle(
    "prices_ordered_relabelled",
    ("listing",),
    f"""SELECT symbol, round(price, 8) AS price, strftime(moment, {_TS}) AS timestamp, CAST(dt AS VARCHAR) AS dt
FROM listing l ORDER BY l.dt DESC, l.moment DESC, l.symbol, l.price DESC""",
)
oracle(
    "latest_price_per_coin",
    ("listing",),
    f"""SELECT upper(symbol) AS symbol, max_by(price, (dt, moment, price)) AS price, CAST(max(dt) AS VARCHAR) AS dt,
       strftime(max_by(moment, (dt, moment, price)), {_TS}) AS timestamp,
       CASE WHEN max_by(price, (dt, moment, price)) < 1 THEN '$' || format('{{:,.4f}}', max_by(price, (dt, moment, price)))
            ELSE '$' || format('{{:,.2f}}', max_by(price, (dt, moment, price))) END AS price_label
FROM listing GROUP BY 1""",
)
oracle(
    "price_label",
    (),
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
       CASE WHEN v < 1 THEN '$' || format('{:,.4f}', v) ELSE '$' || format('{:,.2f}', v) END AS label
FROM (SELECT *, l_extendedprice * l_tax AS v FROM lineitem)""",
)
oracle(
    "mention_counts",
    ("said",),
    """SELECT CAST(report_date AS VARCHAR) AS report_date, eth_mentions, dot_mentions, the_mentions, none_mentions
FROM said ORDER BY 1""",
)
oracle(
    "mention_counts_fixed_tokens",
    ("texts",),
    "SELECT CAST(dt AS VARCHAR) AS report_date, "
    + ", ".join(
        f"count(*) FILTER (t LIKE '%{a}%' OR t LIKE '%{b}%') AS {a}_mentions"
        for a, b in (
            ("btc", "bitcoin"),
            ("eth", "ethereum"),
            ("sol", "solana"),
            ("ada", "cardano"),
            ("xrp", "ripple"),
            ("dot", "polkadot"),
            ("avax", "avalanche"),
            ("doge", "dogecoin"),
        )
    )
    + " FROM texts GROUP BY dt",
)
oracle(
    "mention_totals_unpivot",
    ("said",),
    """SELECT token AS "Token", CAST(n AS BIGINT) AS "Mentions" FROM (
  SELECT sum(eth_mentions) AS "ETH", sum(dot_mentions) AS "DOT", sum(none_mentions) AS "NONE"
  FROM (SELECT * FROM said ORDER BY report_date DESC LIMIT 15)) UNPIVOT (n FOR token IN ("ETH", "DOT", "NONE"))""",
)
oracle(
    "price_vs_mentions",
    ("prices", "said"),
    """SELECT CAST(report_date AS VARCHAR) AS report_date, round(p, 8) AS avg_price, ifnull(eth_mentions, 0) AS mention_count
FROM (SELECT dt AS report_date, avg(price) AS p FROM prices WHERE symbol = 'click' GROUP BY dt) x
LEFT JOIN said USING (report_date) ORDER BY report_date DESC LIMIT 15""",
)
oracle("has_mentions", ("said",), "SELECT sum(none_mentions) > 0 AS has_mentions FROM said")
oracle(
    "dod_change",
    ("fact",),
    """SELECT CAST(report_date AS VARCHAR) AS report_date, coin_id, round(avg_price, 8) AS avg_price,
       round((avg_price - lag(avg_price) OVER c) / lag(avg_price) OVER c, 8) AS change_1d,
       round((avg_price - lag(avg_price, 7) OVER c) / lag(avg_price, 7) OVER c, 8) AS change_7d,
       round(avg(avg_price) OVER w - 2 * stddev_pop(avg_price) OVER w, 8) AS band_low,
       round(avg(avg_price) OVER w + 2 * stddev_pop(avg_price) OVER w, 8) AS band_high
FROM fact WINDOW c AS (PARTITION BY coin_id ORDER BY report_date),
     w AS (PARTITION BY coin_id ORDER BY report_date ROWS 6 PRECEDING)""",
)
oracle(
    "engagement_share",
    ("wide",),
    """SELECT coin_id, is_trending, CAST(sum(engagement) AS BIGINT) AS engagement,
       round(sum(engagement)::DOUBLE / (SELECT sum(engagement) FROM wide), 8) AS share
FROM wide GROUP BY 1, 2""",
)
oracle(
    "engagement_per_post",
    ("fact",),
    """SELECT CAST(report_date AS VARCHAR) AS report_date, max(posts) AS posts, max(engagement) AS engagement,
       CASE WHEN max(posts) > 0 THEN round(max(engagement) / max(posts), 8) END AS engagement_per_post
FROM fact GROUP BY report_date""",
)
oracle(
    "score_bands",
    ("insights",),
    """SELECT coin_id, round(avg(score), 8) AS avg_score,
       CASE WHEN avg(score) >= 70 THEN 'Bullish' WHEN avg(score) < 30 THEN 'Bearish' ELSE 'Neutral' END AS band
FROM insights GROUP BY coin_id""",
)
oracle(
    "field_aggregates",
    ("insights",),
    """SELECT coin_id, CAST(sum(posts) AS BIGINT) AS sum_reddit_posts, CAST(sum(engagement) AS BIGINT) AS sum_reddit_engagement,
       round(avg(avg_price), 8) AS mean_avg_price, round(avg(fng), 8) AS mean_fng_value,
       round(avg(trend), 8) AS mean_trending_score, round(avg(score), 8) AS mean_sentiment_score,
       round(avg(price_7), 8) AS mean_avg_price_7d, round(avg(posts_7), 8) AS mean_avg_reddit_posts_7d,
       round(avg(CASE WHEN corr_7 IS NULL OR isnan(corr_7) THEN 0.0 ELSE corr_7 END), 8) AS mean_price_social_corr_7d
FROM insights GROUP BY coin_id""",
)


# Quality.
def _report(*checks: tuple[str, str, str]) -> str:
    """(table, check name, scalar SQL for the number of failures) per check."""
    rows = [f"SELECT '{t}' AS \"table\", '{c}' AS \"check\", CAST(({n}) AS BIGINT) AS failures" for t, c, n in checks]
    return "\nUNION ALL ".join(rows)


def _nulls(table: str, view: str, column: str, source: str | None = None) -> tuple[str, str, str]:
    return table, f"not_null({column})", f"SELECT count(*) FILTER ({source or column} IS NULL) FROM {view}"


def _twice(table: str, column: str) -> tuple[str, str, str]:
    return (
        table,
        f"unique({column})",
        f"SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY 1 HAVING count(*) > 1 AND {column} IS NOT NULL)",
    )


def _orphans(child: str, column: str, parent: str, key: str) -> tuple[str, str, str]:
    return (
        child,
        f"relationship({column} -> {parent}.{key})",
        f"SELECT count(*) FROM {child} WHERE {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)",
    )


oracle(
    "dq_not_null",
    ("prices", "posts", "readings", "trend_rows"),
    _report(
        _nulls("customer", "customer", "c_custkey"),
        _nulls("customer", "customer", "c_name"),
        (
            "customer",
            "not_null(spent)",
            "SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice IS NOT NULL)",
        ),
        _nulls("raw_prices", "prices", "symbol"),
        _nulls("raw_prices", "prices", "price"),
        _nulls("raw_posts", "posts", "id"),
        _nulls("raw_index", "readings", "timestamp", "sec"),
        _nulls("raw_index", "readings", "value"),
        _nulls("raw_trending", "trend_rows", "coin_id"),
        _nulls("raw_trending", "trend_rows", "timestamp", "moment"),
    ),
)
oracle(
    "dq_unique",
    (),
    _report(
        _twice("conversations", "conv_id"),
        _twice("lineitem", "l_orderkey"),
        _twice("orders", "o_orderkey"),
        _twice("customer", "c_nationkey"),
    ),
)
oracle(
    "dq_accepted_range",
    (),
    _report(
        ("events", "accepted_range(value, 1..300)", "SELECT count(*) FROM events WHERE value NOT BETWEEN 1 AND 300"),
        ("orders", "accepted_range(o_totalprice, 10000..)", "SELECT count(*) FROM orders WHERE o_totalprice < 10000"),
        ("orders", "accepted_range(o_totalprice, ..400000)", "SELECT count(*) FROM orders WHERE o_totalprice > 400000"),
        (
            "lineitem",
            "accepted_range(l_discount, 0..0.05)",
            "SELECT count(*) FROM lineitem WHERE l_discount NOT BETWEEN 0::DOUBLE AND 0.05::DOUBLE",
        ),
    ),
)
oracle(
    "dq_relationships",
    (),
    _report(
        _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
        _orphans("orders", "o_custkey", "events", "user_id"),
        _orphans("labels", "doc_id", "documents", "doc_id"),
        _orphans("documents", "doc_id", "labels", "doc_id"),
    ),
)
oracle(
    "dq_expression",
    (),
    _report(
        (
            "lineitem",
            "expression_is_true(l_extendedprice * (1 - l_discount) >= 1000)",
            "SELECT count(*) FROM lineitem WHERE l_extendedprice * (1 - l_discount) < 1000",
        ),
        (
            "lineitem",
            "expression_is_true(l_returnflag <> ''R'')",
            "SELECT count(*) FROM lineitem WHERE l_returnflag = 'R'",
        ),
        ("fct_crypto_daily", "expression_is_true(avg_price >= 0)", "SELECT 0"),
    ),
)
oracle(
    "dq_price_spike",
    ("ticks",),
    f"""SELECT coin_id, strftime(recorded_at, {_TS}) AS recorded_at, round(price_usd, 8) AS price_usd, round(before, 8) AS prev_price
FROM (SELECT *, lag(price_usd) OVER (PARTITION BY coin_id ORDER BY recorded_at) AS before FROM ticks)
WHERE before <> 0 AND abs(price_usd - before) / before > 0.5""",
)
oracle(
    "previous_event",
    (),
    f"""SELECT coin_id, strftime(ts, {_TS}) AS ts, round(value, 8) AS value, round(previous, 8) AS previous
FROM (SELECT *, lag(value) OVER (PARTITION BY coin_id ORDER BY ts) AS previous
      FROM (SELECT event_type AS coin_id, ts, max(value) AS value FROM events GROUP BY ALL))""",
)
oracle(
    "dq_price_positive",
    ("ticks",),
    f"""SELECT record_id, coin_id, round(p, 8) AS price_usd, recorded_at FROM (
  SELECT coin_id || '_' || strftime(moment, {_TS}) || '+00' AS record_id, coin_id, max(price - 1) AS p, strftime(moment, {_TS}) AS recorded_at
  FROM (SELECT lower(symbol) AS coin_id, moment, price FROM prices) GROUP BY coin_id, moment) WHERE p <= 0""",
)
oracle(
    "dq_not_future",
    ("ticks",),
    f"SELECT {_TICK_ROW} FROM ticks t WHERE t.recorded_at > TIMESTAMP '2024-01-29 12:00:00'",
)
oracle(
    "dq_missing_expected",
    (),
    """SELECT coin_id FROM (VALUES ('click'), ('view'), ('missing_coin'), ('purchase')) e(coin_id)
WHERE coin_id NOT IN (SELECT event_type FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events))""",
)
oracle(
    "dq_mart_completeness",
    ("fact",),
    """SELECT count(*) AS row_count, count(DISTINCT coin_id) AS distinct_coin_count,
       string_agg(DISTINCT coin_id, ',' ORDER BY coin_id) AS coin_ids, 'missing_coin' AS missing_coins, 'incomplete' AS status
FROM fact WHERE report_date = DATE '2024-01-15'""",
)
_FRESH = f"""SELECT strftime(m, {_TS}) AS last_event_time, n AS recent_rows, age AS age_seconds,
       CASE WHEN age > 600 THEN 'delayed' ELSE 'fresh' END AS status
FROM (SELECT max(event_time) AS m, count(*) FILTER (event_time >= TIMESTAMP '2024-01-30 23:50:00') AS n,
             date_diff('second', max(event_time), TIMESTAMP '2024-01-31 00:00:00') AS age FROM messages)"""
oracle("dq_freshness", ("messages",), _FRESH)
oracle("stream_freshness", ("messages",), _FRESH)
oracle(
    "dq_row_counts",
    (),
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, CASE WHEN count(*) > 0 THEN 'ok' ELSE 'empty' END AS status FROM {t}"
        for t in ("events", "orders", "lineitem", "conversations", "documents")
    ),
)
oracle(
    "dq_health",
    (),
    """SELECT 'events' AS "table", CASE WHEN count(*) FILTER (value < 1) > 0 THEN 'Failed' ELSE 'Healthy' END AS status FROM events
UNION ALL SELECT 'orders', CASE WHEN count(*) > count(DISTINCT o_custkey) THEN 'Warning' ELSE 'Healthy' END FROM orders
UNION ALL SELECT 'customer', CASE WHEN count(*) > count(c_custkey) THEN 'Failed' ELSE 'Healthy' END FROM customer""",
)

def _suite() -> list[tuple[str, str, str]]:
    """The 52 declared checks. Only the index readings and the score leave room for failures here."""
    clean = "SELECT 0"
    nulls = {
        "raw_prices": ("symbol", "price"),
        "raw_posts": ("id",),
        "raw_index": ("timestamp", "value"),
        "raw_trending": ("coin_id", "timestamp"),
        "stg_prices": ("record_id", "coin_id", "price_usd", "recorded_at"),
        "stg_posts": ("record_id", "post_id", "report_date"),
        "stg_index": ("record_id", "report_date", "fng_value"),
        "stg_trending": ("record_id", "report_date", "coin_id"),
        "dim_coin": ("coin_id",),
        "dim_date": ("date",),
        "fct_crypto_daily": ("record_id", "report_date", "coin_id", "avg_price", "reddit_posts"),
        "fct_market_insights": ("record_id", "report_date", "coin_id", "avg_price", "fng_value", "sentiment_score"),
    }
    keys = {
        "stg_prices": ("record_id",),
        "stg_posts": ("record_id", "post_id"),
        "stg_index": ("record_id",),
        "stg_trending": ("record_id",),
        "dim_coin": ("coin_id",),
        "dim_date": ("date",),
        "fct_crypto_daily": ("record_id",),
        "fct_market_insights": ("record_id",),
    }
    out = [(t, f"not_null({c})", clean) for t, cols in nulls.items() for c in cols]
    out += [(t, f"unique({c})", clean) for t, cols in keys.items() for c in cols]
    out += [
        ("stg_prices", "accepted_range(price_usd, 0..1000000)", "SELECT count(*) FROM ticks WHERE price_usd NOT BETWEEN 0 AND 1000000"),
        ("stg_index", "accepted_range(fng_value, 0..100)", "SELECT count(*) FROM index_days WHERE value NOT BETWEEN 0 AND 100"),
        ("fct_crypto_daily", "accepted_range(avg_price, 0..)", "SELECT count(*) FROM fact WHERE avg_price < 0"),
        ("fct_market_insights", "accepted_range(fng_value, 0..100)", "SELECT count(*) FROM insights WHERE fng NOT BETWEEN 0 AND 100"),
        ("fct_market_insights", "accepted_range(sentiment_score, 0..100)", "SELECT count(*) FROM insights WHERE score NOT BETWEEN 0 AND 100"),
        ("fct_crypto_daily", "expression_is_true(avg_price >= 0)", "SELECT count(*) FROM fact WHERE avg_price < 0"),
    ]
    for fact in ("fct_crypto_daily", "fct_market_insights"):
        out += [(fact, "relationship(report_date -> dim_date.date)", clean), (fact, "relationship(coin_id -> dim_coin.coin_id)", clean)]
    return out


oracle("dq_full_suite", ("insights",), _report(*_suite()))

_BAD_PRICES = """SELECT CASE WHEN user_id % 20 <> 3 THEN lower(event_type) END AS coin_id,
           CASE WHEN user_id % 20 <> 5 THEN value * 8000 - 400000 END AS price,
           CASE WHEN user_id % 20 <> 4 THEN date_trunc('hour', ts) END AS moment FROM events"""
_BAD_POSTS = f"""SELECT CASE WHEN conv_id % 9 <> 0 THEN CAST(conv_id AS VARCHAR) END AS id,
           CASE WHEN conv_id % 7 <> 0 THEN {_DAY} + to_days({_uneven_day("conv_id")}) + to_minutes(turn) END AS created FROM conversations"""
_BAD_INDEX = """SELECT CASE WHEN o_orderkey % 11 <> 0 THEN 1704067200 + (o_orderkey % 28) * 86400 + o_orderkey % 86400 END AS sec,
           CASE WHEN o_orderkey % 5 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 301 - 100 END AS value, o_orderpriority AS class FROM orders"""
_BAD_VIEWS = f"""WITH p AS ({_BAD_PRICES}), c AS ({_BAD_POSTS}), i AS ({_BAD_INDEX}),
sp AS (SELECT coin_id, moment, max(price) AS price FROM p WHERE coin_id IS NOT NULL AND moment IS NOT NULL GROUP BY 1, 2
       UNION ALL (SELECT coin_id, moment, price FROM p WHERE coin_id IS NULL OR moment IS NULL
                  ORDER BY moment DESC NULLS LAST, price DESC NULLS LAST, coin_id DESC NULLS LAST LIMIT 1)),
sc AS (SELECT id, max(created) AS created FROM c GROUP BY id),
si AS (SELECT DISTINCT ON (day) * FROM (SELECT CAST(make_timestamp(sec * 1000000) AS DATE) AS day, * FROM i)
       ORDER BY day, sec DESC NULLS LAST, value DESC NULLS LAST, class DESC NULLS LAST)
"""


def _planted() -> list[tuple[str, str, str]]:
    def nulls(table: str, view: str, **columns: str) -> list[tuple[str, str, str]]:
        return [_nulls(table, view, c, source) for c, source in columns.items()]

    def twice(table: str, column: str, view: str, key: str) -> tuple[str, str, str]:
        return table, f"unique({column})", f"SELECT count(*) FROM (SELECT {key} AS k FROM {view} GROUP BY 1 HAVING count(*) > 1) WHERE k IS NOT NULL"

    tick = f"coin_id || '_' || strftime(moment, {_TS})"
    return [
        *nulls("raw_prices", "p", symbol="coin_id", price="price"),
        *nulls("raw_posts", "c", id="id"),
        *nulls("raw_index", "i", timestamp="sec", value="value"),
        *nulls("stg_prices", "sp", record_id=f"({tick})", coin_id="coin_id", price_usd="price", recorded_at="moment"),
        *nulls("stg_posts", "sc", record_id="id", post_id="id", report_date="created"),
        *nulls("stg_index", "si", record_id="day", report_date="day", fng_value="value"),
        twice("stg_prices", "record_id", "sp", tick),
        twice("stg_posts", "record_id", "sc", "id"),
        twice("stg_posts", "post_id", "sc", "id"),
        twice("stg_index", "record_id", "si", "day"),
        ("stg_prices", "accepted_range(price_usd, 0..1000000)", "SELECT count(*) FROM sp WHERE price NOT BETWEEN 0 AND 1000000"),
        ("stg_index", "accepted_range(fng_value, 0..100)", "SELECT count(*) FROM si WHERE value NOT BETWEEN 0 AND 100"),
    ]


oracle("dq_planted_violations", (), _BAD_VIEWS + _report(*_planted()))

# Payloads and contracts.
oracle(
    "json_map_flatten",
    (),
    f"""SELECT symbol, round(price, 8) AS price, strftime(ts, {_TS}) AS timestamp, strftime(ts, '%Y-%m-%d') AS ingestion_date FROM (
  SELECT event_type AS symbol, value AS price, ts FROM events
  UNION ALL SELECT event_type || '_k', CAST(props->>'$.k' AS DOUBLE), ts FROM events)""",
)
oracle(
    "json_array_flatten",
    (),
    """SELECT CAST(floor(o_totalprice) AS BIGINT) % 101 AS value, o_orderpriority AS value_classification, sec AS timestamp,
       strftime(make_timestamp(sec * 1000000), '%Y-%m-%d') AS ingestion_date
FROM (SELECT *, unnest([1704067200 + o_orderkey % 100000, 1704067200 + o_orderkey % 100000 + 86400]) AS sec FROM orders)""",
)
oracle(
    "json_posts_flatten",
    ("turns",),
    f"""SELECT id, text AS title, length(text) AS score,
       CASE WHEN turn > 0 THEN strftime({_DAY} + to_minutes(turn), {_TS}) END AS created_utc, CAST(NULL AS VARCHAR) AS url
FROM turns""",
)
oracle(
    "json_trending_flatten",
    (),
    f"""SELECT event_type AS coin_id, upper(event_type[1]) || event_type[2:] AS name, upper(event_type) AS symbol,
       CAST(NULL AS BIGINT) AS market_cap_rank, user_id % 15 AS score, strftime(ts, {_TS}) AS timestamp,
       strftime(ts, '%Y-%m-%d') AS ingestion_date FROM events""",
)
oracle(
    "fallback_rows",
    ("turns",),
    """SELECT id, text AS title, length(text) AS score, '2024-01-01 00:00:00' AS created_utc, '' AS url, 'all' AS feed
FROM turns
UNION ALL SELECT 'fallback-bitcoin-20240105', 'Bitcoin market discussion fallback record', 1, '2024-01-05 10:00:00',
       'https://www.reddit.com/r/Bitcoin/', 'nobody'
UNION ALL SELECT 'fallback-ethereum-20240105', 'Ethereum market discussion fallback record', 1, '2024-01-05 10:00:00',
       'https://www.reddit.com/r/ethereum/', 'nobody'""",
)
oracle(
    "payload_string_prices",
    (),
    f"""SELECT event_type AS symbol, round(value, 8) AS price, strftime(ts, {_TS}) AS timestamp, strftime(ts, '%Y-%m-%d') AS ingestion_date
FROM events WHERE user_id % 3 < 2 AND value >= 0""",
)
oracle(
    "payload_broken_documents",
    (),
    """SELECT CASE WHEN event_id % 5 = 0 THEN 'quarantined' ELSE 'valid' END AS status,
       CASE WHEN event_id % 5 = 0 THEN 'document: not a JSON object' ELSE '' END AS errors, count(*) AS records
FROM events GROUP BY 1, 2""",
)
oracle(
    "payload_index_values",
    (),
    """SELECT CASE o_orderkey % 5 WHEN 3 THEN -n ELSE n END AS value, 'c' AS value_classification, 1704067200 + o_orderkey AS timestamp,
       strftime(make_timestamp((1704067200 + o_orderkey) * 1000000), '%Y-%m-%d') AS ingestion_date
FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) % 101 AS n FROM orders) WHERE o_orderkey % 5 IN (0, 2, 3)""",
)
oracle(
    "trades_rejected",
    (),
    """SELECT 'tick' AS kind, count(*) AS n FROM events WHERE event_id % 10 IN (0, 6, 7, 8, 9)
UNION ALL SELECT 'rejected', count(*) FROM events WHERE event_id % 10 IN (1, 2, 5)""",
)
oracle(
    "contract_index",
    (),
    """SELECT o_orderkey, v AS value, coalesce(v BETWEEN 0 AND 100, false) AS ok,
       CASE WHEN v IS NULL THEN 'value: not a bigint' WHEN v > 100 THEN 'value: above 100' WHEN v < 0 THEN 'value: below 0' ELSE '' END AS errors
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 121 - 10 END AS v FROM orders)""",
)
_PROBLEMS = """nullif(concat_ws(',', CASE k WHEN 7 THEN 'symbol: too short' WHEN 8 THEN 'symbol: missing' END,
         CASE WHEN k = 9 THEN 'price: not a double' WHEN price < 0 THEN 'price: below 0' END), '')"""
oracle(
    "contract_valid",
    ("drifting",),
    f"""SELECT event_type AS symbol, round(price, 8) AS price, timestamp, ingestion_date, event_id
FROM drifting WHERE {_PROBLEMS} IS NULL""",
)
oracle(
    "contract_quarantine",
    ("drifting",),
    f"SELECT event_id, {_PROBLEMS} AS errors FROM drifting WHERE {_PROBLEMS} IS NOT NULL",
)
oracle(
    "contract_land",
    ("drifting",),
    f"SELECT CASE WHEN {_PROBLEMS} IS NULL THEN 'valid' ELSE 'quarantined' END AS status, count(*) AS records FROM drifting GROUP BY 1",
)
oracle(
    "land_keeps_good_day",
    ("drifting",),
    f"""SELECT CASE WHEN {_PROBLEMS} IS NULL THEN 'valid' ELSE 'quarantined' END AS status, count(*) AS records, true AS refused
FROM drifting GROUP BY 1""",
)
oracle(
    "publish_keeps_good_file",
    ("prices",),
    """SELECT symbol, count(*) AS n, round(max(price), 8) AS high, true AS refused, (SELECT count(*) FROM prices) AS published
FROM prices GROUP BY symbol""",
)
oracle(
    "contract_json_defaults",
    ("turns",),
    """SELECT id, CASE WHEN turn % 2 = 0 THEN '' END AS title, CASE WHEN turn % 2 = 0 THEN 0 ELSE length(text) END AS score,
       CAST(NULL AS VARCHAR) AS created_utc, CASE WHEN turn % 2 = 0 THEN '' ELSE '/u' END AS url FROM turns""",
)

oracle(
    "bronze_daily_price",
    (),
    """SELECT strftime(sec, '%Y-%m-%d') AS report_date, coin_id, round(avg(p), 8) AS avg_price
FROM (SELECT lower(event_type) AS coin_id, date_trunc('second', ts) AS sec, max(value - 5) AS p
      FROM events WHERE value - 5 >= 0 GROUP BY 1, 2) GROUP BY 1, 2""",
)

# Incremental facts and lake files.
oracle(
    "inc_late_data",
    ("price_days",),
    """SELECT 'daily' AS fact, strftime(moment, '%Y-%m-%d') AS report_date, coin_id, round(avg(p), 8) AS avg_price FROM (
  SELECT lower(symbol) AS coin_id, moment, max(price + CASE WHEN dt = (SELECT max(dt) FROM prices) - 1 THEN 1000 ELSE 0 END) AS p
  FROM prices GROUP BY 1, 2) GROUP BY 2, 3
UNION ALL SELECT 'insights', CAST(report_date AS VARCHAR), coin_id, round(avg_price, 8) FROM price_days""",
)
oracle(
    "backfill_dimensions",
    (),
    "\nUNION ALL ".join(
        f"SELECT '{fact}' AS \"table\", 'relationship({link})' AS \"check\", CAST(0 AS BIGINT) AS failures, "
        "(SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) AS days"
        for fact in ("fct_crypto_daily", "fct_market_insights")
        for link in ("report_date -> dim_date.date", "coin_id -> dim_coin.coin_id")
    ),
)
oracle("stg_prices_ungated", ("ungated",), f"SELECT coin_id, round(price_usd, 8) AS price_usd, strftime(recorded_at, {_TS}) AS recorded_at FROM ungated")
oracle(
    "staging_views",
    ("ticks", "post_versions", "index_days", "trend_days"),
    """SELECT 'stg_prices' AS view, count(*) AS n, count(DISTINCT coin_id) AS keys FROM ticks
UNION ALL SELECT 'stg_posts', count(*), count(DISTINCT id) FROM post_versions
UNION ALL SELECT 'stg_index', count(*), count(DISTINCT report_date) FROM index_days
UNION ALL SELECT 'stg_trending', count(*), count(DISTINCT coin_id) FROM trend_days""",
)
oracle(
    "gates",
    (),
    """WITH n AS (SELECT count(*) AS n FROM events), g AS (SELECT unnest(['partition_rows', 'required_lines', 'source_rows']) AS gate)
SELECT gate, 'full' AS "case", 'ok' AS outcome, n AS rows FROM g, n
UNION ALL SELECT gate, 'empty', 'refused', 0 FROM g
UNION ALL SELECT 'landing_day', 'missing', 'refused', 0""",
)
oracle(
    "external_lake_tables",
    ("readings",),
    f"""SELECT 'reddit_posts' AS "table", CAST(CAST({_DAY} AS DATE) + {_uneven_day("conv_id")} AS VARCHAR) AS dt, count(*) AS n FROM conversations GROUP BY 2
UNION ALL SELECT 'fear_greed_index', CAST(dt AS VARCHAR), count(*) FROM readings GROUP BY 2
UNION ALL SELECT 'coingecko_trending', strftime(ts, '%Y-%m-%d'), count(*) FROM events GROUP BY 2""",
)
oracle(
    "mixed_json_compaction",
    (),
    f"""SELECT event_id, event_type, round(value, 8) AS value, strftime(ts, {_TS}) AS ts,
       (SELECT count(*) + 4 FROM events WHERE event_id % 50 = 4) AS skipped_lines, CAST(2 AS BIGINT) AS set_aside FROM events""",
)
oracle(
    "upsert_no_delete",
    ("fact",),
    """SELECT record_id, CAST(report_date AS VARCHAR) AS report_date, coin_id, round(avg_price, 8) AS avg_price,
       posts AS reddit_posts, engagement + CASE WHEN posts > 0 AND coin_id <> 'newcoin' THEN 1 ELSE 0 END AS reddit_score
FROM (SELECT * FROM fact
      UNION ALL SELECT md5('newcoin-' || CAST(report_date AS VARCHAR)), report_date, 'newcoin', avg_price, posts, engagement
      FROM fact WHERE coin_id = 'view')""",
)
oracle("jsonl_roundtrip", ("prices",), f"SELECT symbol, round(price, 8) AS price, strftime(moment, {_TS}) AS timestamp FROM prices")
oracle(
    "path_date_partition",
    (),
    """SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type, count(*) AS n, round(sum(value), 8) AS total FROM events GROUP BY 1, 2""",
)
oracle(
    "external_table",
    ("prices",),
    "SELECT CAST(dt AS VARCHAR) AS dt, symbol, count(*) AS n, round(max(price), 8) AS high FROM prices GROUP BY prices.dt, symbol",
)
oracle(
    "union_by_name",
    (),
    """SELECT c_name AS name, round(c_acctbal, 8) AS balance, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS nation FROM customer
UNION ALL SELECT s_name, round(s_acctbal, 8), NULL, CAST(s_nationkey AS BIGINT) FROM supplier""",
)
oracle(
    "compaction",
    ("posts",),
    f"SELECT id, title, score, strftime(created, {_TS}) AS created_utc, '/c/' || id AS url FROM posts",
)
oracle(
    "append_observed",
    (),
    "SELECT 2 * count(*) AS stored, count(*) AS first_load, count(*) AS second_load FROM events",
)
oracle(
    "latest_row_per_key",
    (),
    """SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, round(o_totalprice, 8) AS o_totalprice
FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC""",
)

# Streaming.
oracle(
    "stream_trades_append",
    ("messages",),
    f"SELECT strftime(event_time, {_TS}) AS event_time, symbol, round(price, 8) AS price FROM messages",
)
oracle(
    "stream_dedup",
    ("closed",),
    f"SELECT strftime(event_time, {_TS}) AS event_time, symbol, round(price, 8) AS price FROM closed c",
)
oracle(
    "stream_daily_avg",
    ("closed",),
    """SELECT strftime(event_time, '%Y-%m-%d') AS report_date, symbol AS coin_id, round(avg(price), 8) AS avg_price
FROM closed WHERE date_trunc('day', event_time) + INTERVAL 1 DAY <= (SELECT max(event_time) FROM closed)
GROUP BY 1, 2""",
)
oracle(
    "stream_late_corrected",
    (),
    """SELECT strftime(day, '%Y-%m-%d') AS report_date, event_type AS coin_id, round(avg(price), 8) AS avg_price,
       (SELECT count(*) FROM events WHERE CAST(floor(epoch(ts)) AS BIGINT) % 7 = 0 AND CAST(ts AS DATE) <
        (SELECT CAST(max(ts) - INTERVAL 1 DAY AS DATE) FROM events WHERE CAST(floor(epoch(ts)) AS BIGINT) % 7 <> 0)) AS late_rows
FROM (SELECT CAST(ts AS DATE) AS day, event_type, ts, max(value) AS price FROM events GROUP BY ALL)
WHERE day < (SELECT CAST(max(ts) - INTERVAL 1 DAY AS DATE) FROM events) GROUP BY day, event_type""",
)
oracle(
    "inc_versions",
    ("fact",),
    """SELECT CAST(report_date AS VARCHAR) AS report_date, coin_id, round(avg_price, 8) AS avg_price, version
FROM fact, (VALUES (CAST(1 AS BIGINT), 2), (CAST(2 AS BIGINT), 0)) v (version, back)
WHERE report_date <= (SELECT max(report_date) FROM fact) - back * INTERVAL 1 DAY""",
)
oracle(
    "schema_discovery",
    ("prices",),
    """SELECT CAST(dt AS VARCHAR) AS dt, count(*) AS n, count(symbol) FILTER (WHERE dt = (SELECT max(dt) FROM prices)) AS n_venues,
       CAST(1 AS BIGINT) AS folders_read FROM prices GROUP BY prices.dt""",
)
