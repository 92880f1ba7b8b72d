"""Rolling-window Columns over ROWS frames.

All builders taking the same window object end up in one Window node (one sort).
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def rows_window(keys: list[str], order: str, rows: int = 7) -> WindowSpec:
    """The current row and the ``rows - 1`` before it, per key. Counts rows, not days."""
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), 0)


def rolling_mean(value: str, window: WindowSpec) -> Column:
    return F.avg(value).over(window)


def rolling_corr(
    x: str, y: str, window: WindowSpec, flat_value: float = 0.0, short_value: float = 0.0
) -> Column:
    """Pearson correlation per frame.

    ``flat_value`` stands where a side is constant, ``short_value`` where a frame holds
    fewer than two pairs; a pair counts only if both sides are present. ``corr() OVER``
    divides by zero under ANSI when a side is constant, so the quotient is spelled out.
    """
    xs = F.when(F.col(y).isNotNull(), F.col(x)).cast("double")
    ys = F.when(F.col(x).isNotNull(), F.col(y)).cast("double")
    value = F.try_divide(
        F.covar_pop(xs, ys).over(window),
        F.stddev_pop(xs).over(window) * F.stddev_pop(ys).over(window),
    )
    value = F.coalesce(value, F.lit(flat_value))
    if flat_value == short_value:
        return value
    return F.when(F.count(xs).over(window) < 2, F.lit(short_value)).otherwise(value)


def full_window_mean(value: str, window: WindowSpec, rows: int = 7) -> Column:
    """Mean only where the frame holds ``rows`` values, NULL before that."""
    return F.when(F.count(value).over(window) == rows, F.avg(value).over(window))
