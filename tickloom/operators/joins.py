"""Left joins that attach optional per-day facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_with_defaults(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    defaults: dict[str, object],
    matched: str | None = None,
) -> DataFrame:
    """LEFT equi-join; columns in ``defaults`` are filled where there is no value.

    ``matched`` names a flag telling a missing right row from a NULL or default value.
    No broadcast hint: the right sides are aggregated to one row per day (or coin-day),
    and adaptive execution broadcasts them after seeing their shuffled size, or
    sort-merges them when that size is too large.
    """
    if matched:
        right = right.withColumn(matched, F.lit(True))
        defaults = {**defaults, matched: False}
    joined = left.join(right, on, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})
