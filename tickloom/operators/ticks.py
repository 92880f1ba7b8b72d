"""Tick-level lag that stays parallel when one series holds most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    out: str = "prev_price",
    buckets: tuple[str, ...] = ("SECOND", "HOUR"),
) -> DataFrame:
    """``lag(value)`` per key ordered by time, without a key-wide window over ticks.

    Ticks are windowed per (key, time bucket); each bucket gets one extra leading row with
    the last value before it. Those values come from the buckets' own last ticks, lagged
    the same way over the next coarser bucket, and over the whole key at the end.

    (key, ts) must be unique, which bounds every window: with the default at most a
    million microsecond ticks in a second, 3,600 seconds in an hour, and the hours of a
    series. For ticks at whole seconds ``("MINUTE",)`` is bounded just as well and cheaper.
    """
    cols = [*df.columns, out]
    in_time = F.col(ts).asc_nulls_first()
    if not buckets:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(key).orderBy(in_time))).select(*cols)

    bucket = f"_{buckets[0].lower()}"
    ticks = df.withColumn(bucket, F.date_trunc(buckets[0], ts)).withColumn("_lead_in", F.lit(False))
    # max_by skips rows without an order value; a tick without time is alone in its bucket.
    order = F.coalesce(ts, F.timestamp_seconds(F.lit(0)))
    last = ticks.groupBy(key, bucket).agg(F.max(ts).alias(ts), F.max_by(value, order).alias(value))
    lead_in = with_previous(last, key, ts, value, "_before", buckets[1:]).select(
        key, bucket, F.col("_before").alias(value), F.lit(True).alias("_lead_in")
    )
    in_bucket = Window.partitionBy(key, bucket).orderBy(F.col("_lead_in").desc(), in_time)
    return (
        ticks.unionByName(lead_in, allowMissingColumns=True)
        .withColumn(out, F.lag(value).over(in_bucket))
        .where(~F.col("_lead_in"))
        .select(*cols)
    )


def jumps(df: DataFrame, value: str, previous: str = "prev_price", limit: float = 0.5) -> DataFrame:
    """Rows whose value moved by more than ``limit`` of the previous one.

    A zero previous value has no relative move and is not reported.
    """
    moved = F.try_divide(F.abs(F.col(value) - F.col(previous)), F.col(previous))
    return df.where(F.col(previous).isNotNull() & (moved > limit))
