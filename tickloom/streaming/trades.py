"""Trade ticks as a stream: append to the lake, daily averages of closed days, and their correction by late ticks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.session import path_exists
from tickloom.sources import payloads

#: Folder of each micro-batch in the tables that batches replace.
BATCH = "batch"


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    max_files: int | None = None,
) -> DataFrame:
    """New files below ``path`` (or matching it) as a stream.

    ``max_files`` bounds one micro-batch, and with it what enters the state before any of it is
    evicted; set it for long histories. Files are then expected in the order of their events: rows
    of files that come out of order count as late once the watermark has passed them, and are
    dropped by the closed ticks and averages. Without it all files present are one batch.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def append_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Exactly-once Parquet append. Default trigger: everything available, then stop."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def append_ticks(
    messages: DataFrame, col: str, path: str, rejected: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Ticks of a message stream to ``path``, and messages that cannot be read to ``rejected``.

    One query, and one scan of the source a batch. Each batch replaces the folder of its own number on both
    sides, so a batch that is run again after a failure adds nothing. A bad message stops neither side.
    """

    def land(batch: DataFrame, number: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            payloads.flatten_trades(batch, col).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")
            payloads.rejected_trades(batch, col).write.mode("overwrite").parquet(f"{rejected}/{BATCH}={number}")
        finally:
            batch.unpersist()

    return batch_sink(messages, land, checkpoint, trigger)


def batch_sink(df: DataFrame, land: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Give each micro-batch and its number to ``land``, which must do the same if it gets them again."""
    writer = df.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def closed_ticks(trades: DataFrame, delay: str = "2 days") -> DataFrame:
    """One tick per (symbol, event time), the highest price winning, once the watermark passed it.

    An aggregate rather than ``dropDuplicates``: copies are combined on the map side, so
    a record repeated a million times reaches its state partition as one row per task,
    and the same row wins as in the batch staging.
    """
    return (
        trades.withWatermark("event_time", delay)
        .groupBy("event_time", "symbol")
        .agg(F.max("price").alias("price"))
    )


def closed_daily_average(trades: DataFrame, delay: str = "2 days") -> DataFrame:
    """Average price per symbol and day of the distinct ticks, once the day is closed."""
    ticks = closed_ticks(trades, delay)
    return (
        ticks.groupBy(F.window("event_time", "1 day").alias("w"), "symbol")
        .agg(F.avg("price").alias("avg_price"))
        .select(F.to_date("w.start").alias("report_date"), F.col("symbol").alias("coin_id"), "avg_price")
    )


@dataclass(frozen=True)
class DailyAverages:
    """Daily averages of a tick stream below one folder, corrected when ticks come late.

    ``ticks/`` holds every tick by day and batch, ``averages/`` the averages of closed days by day, and
    ``progress/`` a row a batch: the latest time seen, the first day that is still open, and how many rows
    came late, for days that were closed before. A batch lands its ticks, then writes the averages of the days
    that it closes and of the closed days it adds to, from the landed ticks of these days alone. Every step
    replaces what the same batch has written before, so a batch that is run again changes nothing.
    """

    root: str
    delay: str = "2 days"

    TICK = "event_time timestamp, symbol string, price double"

    def start(self, ticks: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Follow a stream of ticks (``event_time, symbol, price``)."""
        return batch_sink(ticks, self.land, checkpoint, trigger)

    def land(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        day = F.to_date("event_time").alias("day")
        rows = batch.where("event_time IS NOT NULL").select("event_time", "symbol", "price", day, F.lit(number).alias(BATCH))
        self._replace(rows.repartition("day"), "ticks", "day", BATCH)
        before = self.progress(spark).where(F.col(BATCH) < number).agg(F.max("latest"), F.max("open_from")).first()
        landed = self.ticks(spark).where(F.col(BATCH) == number)
        counts = landed.agg(F.max("event_time").alias("latest"), F.count_if(F.col("day") < F.lit(before[1])).alias("late"))
        latest = F.greatest("latest", F.lit(before[0]).cast("timestamp"))
        open_from = F.to_date(latest - F.expr(f"INTERVAL {self.delay}"))
        now = counts.select(latest.alias("latest"), open_from.alias("open_from"), "late", F.lit(number).alias(BATCH))
        self._replace(now, "progress", BATCH)
        until = self.progress(spark).where(F.col(BATCH) == number).first()["open_from"]
        if until is None:
            return
        # Closed days that this batch touches, and days that it closes: one row a day.
        touched = landed.select("day").distinct().where(F.col("day") < F.lit(until))
        closing = self.ticks(spark).select("day").distinct().where(F.col("day") < F.lit(until))
        if before[1] is not None:
            closing = closing.where(F.col("day") >= F.lit(before[1]))
        days = [r.day for r in touched.unionByName(closing).distinct().collect()]
        if days:
            known = self.ticks(spark).where(F.col("day").isin(days) & (F.col(BATCH) <= number))
            self._replace(daily_averages(known), "averages", "report_date")

    def _replace(self, df: DataFrame, table: str, *folders: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(f"{self.root}/{table}")

    def _read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        if not path_exists(spark, f"{self.root}/{table}"):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.root}/{table}")

    def ticks(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "ticks", f"{self.TICK}, day date, {BATCH} long")

    def progress(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "progress", f"latest timestamp, open_from date, late long, {BATCH} long")

    def averages(self, spark: SparkSession) -> DataFrame:
        """``report_date, coin_id, avg_price`` of the days that are closed, with all ticks that have come."""
        return self._read(spark, "averages", "coin_id string, avg_price double, report_date date").select("report_date", "coin_id", "avg_price")


def daily_averages(ticks: DataFrame) -> DataFrame:
    """Average price per symbol and day of the distinct ticks, the highest of those at one moment."""
    one = ticks.groupBy("day", "symbol", "event_time").agg(F.max("price").alias("price"))
    return one.groupBy(F.col("day").alias("report_date"), F.col("symbol").alias("coin_id")).agg(F.avg("price").alias("avg_price"))
