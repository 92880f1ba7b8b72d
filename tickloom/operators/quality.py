"""Declarative data checks, reported as one (table, check, failures) frame.

All row-level and key checks share one scan of each table and one aggregate over all tables: a row gives
its keys and the checks it fails, tagged by check, and these are counted before they are shuffled, so a hot
key or a check that all rows fail costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.columns import split_list


@dataclass(frozen=True)
class RowCheck:
    """Counts rows for which ``failing`` is true; NULL is not a failure."""

    table: str
    name: str
    failing: Callable[[], Column]


@dataclass(frozen=True)
class FrameCheck:
    """Counts the rows of a derived frame; ``rows`` receives the dict of tables."""

    table: str
    name: str
    rows: Callable[[dict[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class KeyCheck:
    """Counts values of ``column`` that occur more than once, or rows whose value ``parent`` lacks. NULL is neither."""

    table: str
    name: str
    column: str
    parent: str | None = None
    parent_column: str | None = None


Check = RowCheck | FrameCheck | KeyCheck


def not_null(table: str, column: str) -> RowCheck:
    return RowCheck(table, f"not_null({column})", lambda: F.col(column).isNull())


def accepted_range(table: str, column: str, low: float | None = None, high: float | None = None) -> RowCheck:
    def failing() -> Column:
        c = F.col(column)
        sides = ([c < low] if low is not None else []) + ([c > high] if high is not None else [])
        return reduce(lambda a, b: a | b, sides)

    bounds = f"{'' if low is None else low}..{'' if high is None else high}"
    return RowCheck(table, f"accepted_range({column}, {bounds})", failing)


def expression_is_true(table: str, expression: str) -> RowCheck:
    return RowCheck(table, f"expression_is_true({expression})", lambda: ~F.expr(expression))


def unique(table: str, column: str) -> KeyCheck:
    """Failures = number of values that occur more than once."""
    return KeyCheck(table, f"unique({column})", column)


def relationship(table: str, column: str, parent: str, parent_column: str) -> KeyCheck:
    """Failures = child rows whose non-NULL value the parent lacks."""
    return KeyCheck(table, f"relationship({column} -> {parent}.{parent_column})", column, parent, parent_column)


def _key(column: str, own: T.DataType, wanted: T.DataType) -> Column:
    """A value as text that is equal exactly where the values are, under the type ``wanted``.

    A value that this type cannot hold equals none that it can.
    """
    if own != wanted:
        as_wanted = _text(F.col(column).try_cast(wanted), wanted)
        return F.coalesce(as_wanted, F.concat(F.lit("no such value: "), _text(F.col(column), own)))
    return _text(F.col(column), own)


def _text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0).cast(kind)  # one zero
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    return F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string")


def _tagged(tables: dict[str, DataFrame], table: str, checks: list[RowCheck | KeyCheck]) -> DataFrame:
    """``check`` (its number), ``key``, ``rows`` and ``present`` for all checks that a table's rows take part in."""

    def entry(number: int, when: Column, key: Column, rows: int) -> Column:
        whole = F.struct(F.lit(number).alias("check"), key.alias("key"), F.lit(rows).alias("rows"), F.lit(rows == 0).alias("present"))
        return F.when(when, whole)

    entries, none = [], F.lit(None).cast("string")
    for number, c in enumerate(checks):
        if isinstance(c, RowCheck):
            if c.table == table:
                entries.append(entry(number, c.failing(), none, 1))
            continue
        own = tables[c.table].schema[c.column].dataType
        wanted = tables[c.parent].schema[c.parent_column].dataType if c.parent else own
        if c.table == table:
            entries.append(entry(number, F.col(c.column).isNotNull(), _key(c.column, own, wanted), 1))
        if c.parent == table:
            entries.append(entry(number, F.col(c.parent_column).isNotNull(), _key(c.parent_column, wanted, wanted), 0))
    return tables[table].select(F.inline(F.array_compact(F.array(*entries))))


def _key_report(tables: dict[str, DataFrame], checks: list[RowCheck | KeyCheck]) -> DataFrame:
    """Row-level and key checks together: each table is read once, and all keys are counted by one aggregate."""
    used = dict.fromkeys(t for c in checks for t in (c.table, getattr(c, "parent", None)) if t)
    rows = reduce(DataFrame.unionByName, [_tagged(tables, t, checks) for t in used])
    counts = rows.groupBy("check", "key").agg(F.sum("rows").alias("rows"), F.bool_or("present").alias("present"))
    literal = lambda f: F.array(*(F.lit(f(c)) for c in checks))
    repeated = F.get(literal(lambda c: isinstance(c, KeyCheck) and c.parent is None), "check")
    failures = F.when(repeated, (F.col("rows") > 1).cast("long")).when(F.col("present"), 0).otherwise(F.col("rows"))
    found = counts.groupBy("check").agg(F.sum(failures).alias("failures"))
    every = rows.sparkSession.range(len(checks)).select(F.col("id").cast("int").alias("check"))
    named = every.join(found, "check", "left")
    return named.select(
        F.get(literal(lambda c: c.table), "check").alias("table"),
        F.get(literal(lambda c: c.name), "check").alias("check"),
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
    )


def run_checks(tables: dict[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check with its number of failures."""
    checks = list(checks)
    keys = [c for c in checks if isinstance(c, KeyCheck)]
    keyed = {t for c in keys for t in (c.table, c.parent)}
    fused = keys + [c for c in checks if isinstance(c, RowCheck) and c.table in keyed]
    parts: list[DataFrame] = [_key_report(tables, fused)] if fused else []
    for table in dict.fromkeys(c.table for c in checks if c.table not in keyed):
        rows = [c for c in checks if isinstance(c, RowCheck) and c.table == table]
        if rows:
            parts.append(_row_report(tables[table], table, rows))
    for c in checks:
        if isinstance(c, FrameCheck):
            parts.append(
                c.rows(tables)
                .agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
                .select(F.lit(c.table).alias("table"), F.lit(c.name).alias("check"), "failures")
            )
    return reduce(DataFrame.unionByName, parts)


def _row_report(df: DataFrame, table: str, checks: list[RowCheck]) -> DataFrame:
    counted = df.agg(F.array(*[F.count_if(c.failing()) for c in checks]).alias("n"))
    names = F.array(*[F.lit(c.name) for c in checks])
    return counted.select(F.explode(F.arrays_zip(names.alias("check"), F.col("n").alias("failures"))).alias("r")).select(
        F.lit(table).alias("table"), "r.check", "r.failures"
    )


class QualityError(ValueError):
    """A data check failed."""


def enforce(report: DataFrame, fail_fast: bool = True) -> list[tuple[str, str, int]]:
    """Raise on failed checks. Collects one row per check, never data rows."""
    failed = [tuple(r) for r in report.where("failures > 0").orderBy("table", "check").collect()]
    if failed and fail_fast:
        raise QualityError("; ".join(f"{t}.{c}: {n} failures" for t, c, n in failed))
    return failed


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when a frame is empty; stops at the first row found."""
    if df.isEmpty():
        raise QualityError(f"{what} returned no rows")
    return df


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table with an emptiness status."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(t)) for t, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).select(
        "table", "rows", F.when(F.col("rows") > 0, "ok").otherwise("empty").alias("status")
    )


def require_partition_rows(spark: SparkSession, path: str) -> int:
    """Non-blank line count of a landed JSONL folder or file; raises on a missing path or zero."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    n = lines.count()
    if n == 0:
        raise QualityError(f"no records in {path}")
    return n


def missing_expected(expected: DataFrame, fact: DataFrame, key: str = "coin_id", day: str = "report_date") -> DataFrame:
    """Expected keys the fact lacks on its latest day."""
    latest = fact.agg(F.max(day).alias("d")).select("d").scalar()
    return expected.join(fact.where(F.col(day) == latest).select(key).distinct(), key, "left_anti")


def expected_keys(spark: SparkSession, csv: str, key: str = "coin_id") -> DataFrame:
    """Literal relation from a comma list."""
    return spark.range(1).select(F.explode(split_list(F.lit(csv))).alias(key))


def day_completeness(fact: DataFrame, expected: DataFrame, report_date) -> DataFrame:
    """Row count, coin count, sorted coins and sorted missing coins of one fact day."""
    day = fact.where(F.col("report_date") == F.lit(report_date).cast("date"))
    found = day.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("coin_id").alias("distinct_coin_count"),
        F.sort_array(F.collect_set("coin_id")).alias("coin_ids"),
    )
    wanted = expected.agg(F.collect_set("coin_id").alias("wanted")).select("wanted").scalar()
    checked = found.withColumn("missing_coins", F.sort_array(F.array_except(wanted, "coin_ids")))
    return checked.withColumn(
        "status",
        F.when(F.col("row_count") == 0, "empty").when(F.size("missing_coins") > 0, "incomplete").otherwise("complete"),
    )


def require_complete_day(fact: DataFrame, expected: DataFrame, report_date) -> None:
    row = day_completeness(fact, expected, report_date).first()
    if row["status"] != "complete":
        raise QualityError(f"{report_date}: {row['status']}, missing {', '.join(row['missing_coins'])}")


def freshness(df: DataFrame, ts: str = "event_time", max_delay_minutes: int = 10, as_of: Column | None = None) -> DataFrame:
    """Latest event, rows inside the allowed delay, and fresh / delayed / empty."""
    now = F.current_timestamp() if as_of is None else as_of
    bound = now - F.make_interval(mins=F.lit(max_delay_minutes))
    seen = df.agg(F.max(ts).alias("last_event_time"), F.count_if(F.col(ts) >= bound).alias("recent_rows"))
    age = F.unix_micros(now) - F.unix_micros("last_event_time")
    return seen.select(
        "last_event_time",
        "recent_rows",
        F.floor(age / F.lit(1_000_000)).alias("age_seconds"),
        F.when(F.col("last_event_time").isNull(), "empty")
        .when(age > max_delay_minutes * 60_000_000, "delayed")
        .when(F.col("recent_rows") == 0, "delayed")
        .otherwise("fresh")
        .alias("status"),
    )


def require_fresh(df: DataFrame, **kw) -> None:
    row = freshness(df, **kw).first()
    if row["status"] != "fresh":
        raise QualityError(f"stream is {row['status']}, last event {row['last_event_time']}")


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """A frame that counts its rows while some action runs over it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
