"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A maximum of these fits a buffer of fixed width, so that a hash aggregate can hold it.
FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _same(names: dict[str, str]) -> Column:
    cond = F.lit(True)
    for a, b in names.items():
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` columns per key, NULLs counting as smallest.

    The greatest first order column per key is a hash aggregate with a buffer of fixed width,
    combined before the shuffle: a key holding a third of all rows is one row per task. The rows
    that reach it are joined back, and ``max(struct)`` settles ties among them alone; its remaining
    columns follow the order columns, which makes ties deterministic. An order that starts with
    text has no such buffer and is left to ``max(struct)``.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    kept = df
    if isinstance(df.schema[order[0]].dataType, FIXED_WIDTH):
        top = df.groupBy(*keys).agg(F.max(order[0]).alias("_top"))
        top = top.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "_top")
        met = {**{k: f"_key_{i}" for i, k in enumerate(keys)}, order[0]: "_top"}
        kept = df.join(top, _same(met), "left_semi")
    picked = kept.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def distinct_ticks(df: DataFrame, key: str, ts: str, value: str, identified: bool = False) -> DataFrame:
    """One row per (key, ts), the one with the highest value.

    Grouping on the two typed columns with a fixed-width buffer keeps this a hash
    aggregate. Rows without key or time have no identity of their own and collapse
    into a single row: latest time first, then highest value. ``identified`` promises
    there are none, which saves looking for them.
    """
    if identified:
        return df.groupBy(key, ts).agg(F.max(value).alias(value))
    has_identity = F.col(key).isNotNull() & F.col(ts).isNotNull()
    ticks = df.where(has_identity).groupBy(key, ts).agg(F.max(value).alias(value))
    unidentified = (
        df.where(~has_identity)
        .select(key, ts, value)
        .orderBy(
            F.col(ts).desc_nulls_last(),
            F.col(value).desc_nulls_last(),
            F.col(key).desc_nulls_last(),
        )
        .limit(1)
    )
    return ticks.unionByName(unidentified)
