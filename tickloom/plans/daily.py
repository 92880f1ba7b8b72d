"""The daily run: raw sources, staging, facts, dimensions and checks, incrementally."""

from __future__ import annotations

import datetime as dt
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import fixed_values as V
from tickloom import schemas
from tickloom.operators import merge as M
from tickloom.operators import quality as Q
from tickloom.operators.snapshots import Snapshots, VersionedFact, read_table, write_table
from tickloom.plans import checks, marts, staging
from tickloom.session import beside, delete_path, path_exists, scratch_space, stored, swap
from tickloom.sources.lake import Sources

RAW = ("raw_prices", "raw_posts", "raw_index", "raw_trending")


@dataclass(frozen=True)
class Warehouse:
    """Where the stored tables live."""

    root: str

    @property
    def crypto_daily(self) -> M.Fact:
        return M.Fact(f"{self.root}/fct_crypto_daily", schemas.FCT_CRYPTO_DAILY)

    @property
    def market_insights(self) -> M.Fact:
        return M.Fact(f"{self.root}/fct_market_insights", schemas.FCT_MARKET_INSIGHTS)

    def dim(self, name: str) -> str:
        return f"{self.root}/{name}"

    def change(self, spark: SparkSession) -> AbstractContextManager[None]:
        """What is written inside belongs together. Plain tables are replaced one by one."""
        return nullcontext()

    def read_dim(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame | None:
        """A dimension; None before it is first written."""
        return spark.read.schema(schema).parquet(self.dim(name)) if path_exists(spark, self.dim(name)) else None

    def replace_dim(self, spark: SparkSession, name: str, df: DataFrame) -> None:
        """Replace a dimension that ``df`` may itself read."""
        new = beside(self.dim(name))
        try:
            df.coalesce(1).write.parquet(new)
            swap(spark, new, self.dim(name))
        finally:
            delete_path(spark, new)


class VersionedWarehouse(Warehouse):
    """The same tables in versions: a run shows all it has written at once, by one manifest, and needs no rename.

    ``version`` pins what is read; without it every read takes the latest version.
    """

    def __init__(self, root: str, version: int | None = None):
        super().__init__(root)
        object.__setattr__(self, "snapshots", Snapshots(root))
        object.__setattr__(self, "version", version)

    def _fact(self, name: str, schema: T.StructType) -> VersionedFact:
        return VersionedFact(f"{self.root}/{name}", schema, snapshots=self.snapshots, version=self.version)

    @property
    def crypto_daily(self) -> VersionedFact:
        return self._fact("fct_crypto_daily", schemas.FCT_CRYPTO_DAILY)

    @property
    def market_insights(self) -> VersionedFact:
        return self._fact("fct_market_insights", schemas.FCT_MARKET_INSIGHTS)

    def pinned(self, spark: SparkSession) -> VersionedWarehouse:
        """The latest version, which later runs do not change."""
        return VersionedWarehouse(self.root, max(self.snapshots.versions(spark)))

    def change(self, spark: SparkSession) -> AbstractContextManager[None]:
        return self.snapshots.change(spark)

    def read_dim(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame | None:
        if name not in self.snapshots.tables(spark, self.version):
            return None
        return read_table(spark, self.snapshots, name, schema, self.version)

    def replace_dim(self, spark: SparkSession, name: str, df: DataFrame) -> None:
        write_table(self.snapshots, df, name)


def since_landed(raw: DataFrame, start: dt.date | None, day: str = "dt", slack_days: int = 1) -> DataFrame:
    """Bronze rows that can hold events from ``start`` on.

    A record lands on or after its event day, so the landing partition bounds the event
    day from above; the slack covers clock skew. Frames without the partition column
    pass through.
    """
    if start is None or day not in raw.columns:
        return raw
    return M.within(raw, day, start - dt.timedelta(days=slack_days))


def staged(sources: Sources, start: dt.date | None = None) -> dict[str, DataFrame]:
    """Staging frames with the columns the facts and checks use."""
    raw = {name: since_landed(sources(name), start) for name in RAW}
    return {
        "stg_prices": staging.stage_prices(raw["raw_prices"], gated=sources.gated),
        "stg_posts": staging.stage_posts(raw["raw_posts"], with_title=False),
        "stg_index": staging.stage_index(raw["raw_index"]),
        "stg_trending": staging.stage_trending(raw["raw_trending"], with_details=False),
    }


@dataclass(frozen=True)
class Days:
    """What the facts are made of: one row per day, or per coin and day."""

    prices: DataFrame
    posts: DataFrame
    index: DataFrame
    trending: DataFrame

    @classmethod
    def of(cls, stg: dict[str, DataFrame], bounds: M.Bounds = M.Bounds()) -> Days:
        return cls(
            marts.daily_price(stg["stg_prices"], bounds),
            marts.daily_posts(stg["stg_posts"], bounds),
            stg["stg_index"],
            stg["stg_trending"],
        )

    def since(self, start: dt.date | None) -> Days:
        return Days(*[M.within(df, "report_date", start) for df in (self.prices, self.posts, self.index, self.trending)])


def crypto_daily_rows(days: Days, bounds: M.Bounds) -> DataFrame:
    days = days.since(bounds.read_from)
    return marts.crypto_daily(days.prices, days.posts, bounds)


def market_insights_rows(days: Days, bounds: M.Bounds) -> DataFrame:
    days = days.since(bounds.read_from)
    return marts.market_insights(days.prices, days.posts, days.index, days.trending, bounds)


def _store(spark: SparkSession, fact: M.Fact, rows: DataFrame, replace: bool) -> None:
    if replace:
        fact.replace(rows)
    else:
        M.upsert(spark, fact, rows)


def refresh_crypto_daily(
    spark: SparkSession, warehouse: Warehouse, sources: Sources, full_refresh: bool = False
) -> None:
    """Full build on first run or request, otherwise recompute the lookback days and merge."""
    fact = warehouse.crypto_daily
    latest = None if full_refresh else fact.watermark(spark)
    bounds = M.short_lookback(latest)
    days = Days.of(staged(sources, bounds.read_from), bounds)
    _store(spark, fact, crypto_daily_rows(days, bounds), replace=latest is None)


def refresh_market_insights(
    spark: SparkSession,
    warehouse: Warehouse,
    sources: Sources,
    full_refresh: bool = False,
    emit_lookback_days: int = 0,
) -> None:
    """The same for the insights, reading far enough back to fill the rolling windows."""
    fact = warehouse.market_insights
    latest = None if full_refresh else fact.watermark(spark)
    bounds = M.long_lookback(latest, emit_days=emit_lookback_days)
    days = Days.of(staged(sources, bounds.read_from), bounds)
    _store(spark, fact, market_insights_rows(days, bounds), replace=latest is None)


def _start(*bounds: M.Bounds) -> dt.date | None:
    """The first day any of the bounds reads; None if one is unbounded."""
    days = [b.read_from for b in bounds]
    return None if None in days else min(days)


def store_staged(
    spark: SparkSession, sources: Sources, start: dt.date | None, space: str
) -> dict[str, DataFrame]:
    """Staging written once to the scratch space, for everything that reads it: facts, dimensions, checks."""
    return {name: stored(spark, df, name, space) for name, df in staged(sources, start).items()}


def _write_both(
    spark: SparkSession,
    warehouse: Warehouse,
    stg: dict[str, DataFrame],
    daily_bounds: M.Bounds,
    insight_bounds: M.Bounds,
    replace: tuple[bool, bool],
    space: str,
) -> None:
    """Both facts from one pass over the staged ticks and posts, by way of their per-day aggregates."""
    read = Days.of(stg, M.Bounds(read_from=_start(daily_bounds, insight_bounds)))
    prices, posts = stored(spark, read.prices, "day-prices", space), stored(spark, read.posts, "day-posts", space)
    days = Days(prices, posts, read.index, read.trending)
    _store(spark, warehouse.crypto_daily, crypto_daily_rows(days, daily_bounds), replace[0])
    _store(spark, warehouse.market_insights, market_insights_rows(days, insight_bounds), replace[1])


def update_dimensions(spark: SparkSession, warehouse: Warehouse, stg_prices: DataFrame, replace: bool) -> None:
    """Dates from the stored fact; coins from the staged prices, added to the known ones unless all is rebuilt."""
    warehouse.replace_dim(spark, "dim_date", marts.dim_date(warehouse.crypto_daily.read(spark)))
    coins = marts.dim_coin(stg_prices)
    known = None if replace else warehouse.read_dim(spark, "dim_coin", schemas.DIM_COIN)
    if known is not None:
        coins = known.unionByName(coins).distinct()
    warehouse.replace_dim(spark, "dim_coin", coins)


def backfill(spark: SparkSession, warehouse: Warehouse, sources: Sources, start: dt.date, end: dt.date) -> None:
    """Rebuild [start, end] from bronze and merge it, including later days whose windows changed, and the dimensions."""
    bounds = M.backfill_bounds(start, end, rolling=False), M.backfill_bounds(start, end, rolling=True)
    with scratch_space(spark, "backfill") as space, warehouse.change(spark):
        stg = store_staged(spark, sources, _start(*bounds), space)
        _write_both(spark, warehouse, stg, *bounds, replace=(False, False), space=space)
        update_dimensions(spark, warehouse, stg["stg_prices"], replace=False)


def backfill_last(spark: SparkSession, warehouse: Warehouse, sources: Sources, days: int, today: dt.date) -> None:
    backfill(spark, warehouse, sources, today - dt.timedelta(days=days), today)


def _next_bounds(spark: SparkSession, warehouse: Warehouse, full_refresh: bool) -> tuple[M.Bounds, M.Bounds, tuple[bool, bool]]:
    """What the two facts read and emit next, and whether each is replaced."""
    facts = (warehouse.crypto_daily, warehouse.market_insights)
    latest = [None if full_refresh else fact.watermark(spark) for fact in facts]
    return M.short_lookback(latest[0]), M.long_lookback(latest[1]), (latest[0] is None, latest[1] is None)


def build(spark: SparkSession, warehouse: Warehouse, sources: Sources, full_refresh: bool = False) -> None:
    """Facts, then the dimensions that depend on them."""
    *bounds, replace = _next_bounds(spark, warehouse, full_refresh)
    with scratch_space(spark, "build") as space, warehouse.change(spark):
        stg = store_staged(spark, sources, _start(*bounds), space)
        _write_both(spark, warehouse, stg, *bounds, replace=replace, space=space)
        update_dimensions(spark, warehouse, stg["stg_prices"], replace=replace[0])


def tables(
    spark: SparkSession,
    warehouse: Warehouse,
    sources: Sources,
    landed_from: dt.date | None = None,
    stg: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Everything the quality suite looks at: the facts whole, raw and staged rows from ``landed_from`` on.

    The suite reads each staged table several times: give the stored ones as ``stg``.
    """
    return {
        **{name: since_landed(sources(name), landed_from) for name in RAW},
        **(staged(sources, landed_from) if stg is None else stg),
        "fct_crypto_daily": warehouse.crypto_daily.read(spark),
        "fct_market_insights": warehouse.market_insights.read(spark),
        "dim_date": warehouse.read_dim(spark, "dim_date", schemas.DIM_DATE),
        "dim_coin": warehouse.read_dim(spark, "dim_coin", schemas.DIM_COIN),
    }


def run(
    spark: SparkSession,
    warehouse: Warehouse,
    sources: Sources,
    full_refresh: bool = False,
    expected: str = V.EXPECTED_COINS,
    report_date: dt.date | None = None,
    check_from: dt.date | None = None,
) -> DataFrame:
    """Raw gates, facts, dimensions, checks, final gate; stops at the first that fails.

    ``report_date`` is the day the run is for, today (UTC) unless given: every source must have
    landed rows on it, and the fact must hold the expected coins on it. Raw and staged rows are
    checked whole unless ``check_from`` limits them to what landed since; the facts are always
    checked whole. Raw ticks are staged once, for facts, dimensions and checks. Returns the report
    as a local frame, one row per check.
    """
    day = report_date or dt.datetime.now(dt.timezone.utc).date()
    for name in RAW:
        raw = sources(name)
        Q.require_rows(raw, name)
        if "dt" in raw.columns:
            Q.require_rows(raw.where(F.col("dt") == F.lit(day)), f"{name} of {day}")
    *bounds, replace = _next_bounds(spark, warehouse, full_refresh)
    start = _start(*bounds, M.Bounds(read_from=check_from))
    with scratch_space(spark, "run") as space:
        stg = store_staged(spark, sources, start, space)
        with warehouse.change(spark):
            _write_both(spark, warehouse, stg, *bounds, replace=replace, space=space)
            update_dimensions(spark, warehouse, stg["stg_prices"], replace=replace[0])
        report = Q.run_checks(tables(spark, warehouse, sources, check_from, stg), checks.full_suite(expected))
        found = report.collect()
        kept = spark.createDataFrame(found, report.schema)
    Q.enforce(kept)
    Q.require_complete_day(warehouse.crypto_daily.read(spark), Q.expected_keys(spark, expected), day)
    return kept
