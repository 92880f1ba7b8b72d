"""Keyed upsert into a date-partitioned Parquet fact, and the bounds of incremental runs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import child_names, path_exists, scratch_space, stored


class DuplicateKeys(ValueError):
    """An update set holds the same key twice."""


@dataclass(frozen=True)
class Fact:
    """A stored fact: Parquet under ``path``, one folder per day, sorted by ``cluster``."""

    path: str
    schema: T.StructType
    key: str = "record_id"
    day: str = "report_date"
    cluster: str = "coin_id"

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, self.path)

    def watermark(self, spark: SparkSession) -> dt.date | None:
        """Latest stored day; NULL-only or missing tables give None.

        Taken from the names of the day folders, newest first, until one holds a data file: no file is opened.
        """
        prefix = f"{self.day}="
        days = [n.removeprefix(prefix) for n in child_names(spark, self.path) if n.startswith(prefix)]
        for day in sorted((d for d in days if d[:1].isdigit()), reverse=True):
            if any(n[0] not in "._" for n in child_names(spark, f"{self.path}/{prefix}{day}")):
                return dt.date.fromisoformat(day)
        return None

    def replace(self, df: DataFrame) -> None:
        """Full refresh."""
        self._write(df, "static")

    def replace_days(self, df: DataFrame) -> None:
        """Replace exactly the days present in ``df``; every other day stays as it is."""
        self._write(df, "dynamic")

    def _write(self, df: DataFrame, mode: str) -> None:
        # Rebalancing splits a day that holds too much and joins small ones into one file.
        (
            df.select(*self.schema.names)
            .hint("rebalance", self.day)
            .sortWithinPartitions(self.day, self.cluster)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy(self.day)
            .parquet(self.path)
        )


def merged(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates replace rows of equal key, new keys are added, nothing is removed."""
    kept = target.join(updates.select(key), key, "left_anti")
    return updates.unionByName(kept)


def touched_days(updates: DataFrame, key: str, day: str) -> list[dt.date | None]:
    """The days of an update set; raises if one of them holds a key twice. One row per day is collected."""
    per_key = updates.groupBy(day, key).agg(F.count(F.lit(1)).alias("n"))
    per_day = per_key.groupBy(day).agg(F.max("n").alias("most"), F.max_by(key, "n").alias("key")).collect()
    for r in per_day:
        if r["most"] > 1:
            raise DuplicateKeys(f"{key} = {r['key']} occurs {r['most']} times in the update set")
    return [r[day] for r in per_day]


def upsert(spark: SparkSession, fact: Fact, updates: DataFrame) -> None:
    """Merge ``updates`` into a fact on its key, rewriting only the days they touch.

    A key must determine its day, as the record ids do, which hash it.

    The updates are computed once into a scratch table; the list of touched days and the
    merge read that table, so a lost executor re-reads files instead of recomputing the
    marts. The rewritten days are staged by the dynamic-overwrite commit and swapped in
    when all tasks are done, so the target can be read while its next version is written.
    """
    with scratch_space(spark, "upsert") as space:
        new = stored(spark, updates.select(*fact.schema.names), "updates", space)
        days = touched_days(new, fact.key, fact.day)
        if not fact.exists(spark):
            fact.replace(new)
        elif days:
            touched = F.col(fact.day).isin([d for d in days if d is not None])
            if None in days:
                touched = touched | F.col(fact.day).isNull()
            fact.replace_days(merged(fact.read(spark).where(touched), new, fact.key))


@dataclass(frozen=True)
class Bounds:
    """Days to read from staging and days to emit; None means unbounded."""

    read_from: dt.date | None = None
    emit_from: dt.date | None = None
    emit_to: dt.date | None = None


def short_lookback(latest: dt.date | None, days: int = 2) -> Bounds:
    """Recompute and emit the latest stored day and the ``days`` before it."""
    if latest is None:
        return Bounds()
    start = latest - dt.timedelta(days=days)
    return Bounds(read_from=start, emit_from=start)


def long_lookback(latest: dt.date | None, read_days: int = 8, emit_days: int = 0) -> Bounds:
    """Read enough days to fill the rolling windows, emit from the latest stored day on.

    ``emit_days`` widens the emitted range so late data also corrects earlier days.
    """
    if latest is None:
        return Bounds()
    return Bounds(
        read_from=latest - dt.timedelta(days=read_days + emit_days),
        emit_from=latest - dt.timedelta(days=emit_days),
    )


def backfill_bounds(start: dt.date, end: dt.date, rolling: bool, window: int = 7) -> Bounds:
    """Rebuild [start, end]; rolling facts also change on the days whose windows reach into it."""
    if not rolling:
        return Bounds(start, start, end)
    return Bounds(
        read_from=start - dt.timedelta(days=window + 1),
        emit_from=start,
        emit_to=end + dt.timedelta(days=window - 1),
    )


def within(df: DataFrame, column: str, start: dt.date | None, end: dt.date | None = None) -> DataFrame:
    """Rows of the day range; the literals are known when the plan is made, so files are pruned."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df
