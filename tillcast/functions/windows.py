"""Window frames over a series. Every frame here is partitioned by a series key and the
rows are one per day, week or promotion, so a partition never exceeds the calendar."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def series(keys: list[str], order) -> WindowSpec:
    order = order if isinstance(order, (list, tuple)) else [order]
    return Window.partitionBy(*keys).orderBy(*order)


def before(keys: list[str], order) -> WindowSpec:
    """All earlier rows of the series, without the current one."""
    return series(keys, order).rowsBetween(Window.unboundedPreceding, -1)


def trailing(keys: list[str], order, n: int) -> WindowSpec:
    """The n rows before the current one."""
    return series(keys, order).rowsBetween(-n, -1)


def until_now(keys: list[str], order) -> WindowSpec:
    return series(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def trailing_means(value, keys: list[str], order, lengths, prefix: str) -> dict[str, Column]:
    """``{prefix}_{n}`` -> mean of the n previous rows, for every n."""
    return {f"{prefix}_{n}": F.avg(value).over(trailing(keys, order, n)) for n in lengths}


def top_row(df, keys: list[str], order, name: str = "_rn"):
    """First row per key in the given order."""
    return df.withColumn(name, F.row_number().over(series(keys, order))).where(F.col(name) == 1).drop(name)
