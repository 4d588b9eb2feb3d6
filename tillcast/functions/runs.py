"""Daily series kept as runs: a row for each day on which something changes, valid until the next one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import week_start


def event_runs(events: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Each event (one per key and day) with ``run_end``, the day before the key's next one; the last run is its own day."""
    nxt = F.lead(day).over(Window.partitionBy(*keys).orderBy(day))
    return events.withColumn("run_end", F.coalesce(F.date_sub(nxt, 1), F.col(day)))


def lay_out(runs: DataFrame, day: str, values: list[str]) -> DataFrame:
    """One row per day of each run; ``values`` hold on its first day only and are NULL on the others.

    Nothing is joined or moved: a series is laid out from its events where it lies."""
    other = [c for c in runs.columns if c not in (day, "run_end", *values)]
    days = runs.select("*", F.posexplode(F.sequence(day, "run_end")).alias("_nth", "_day"))
    return days.select(*other, F.col("_day").alias(day), *[F.when(F.col("_nth") == 0, F.col(c)).alias(c) for c in values])


def week_pieces(runs: DataFrame, day: str, values: list[str]) -> DataFrame:
    """Runs cut where a week ends: one row per run and week (``week_start``), from ``day`` to ``run_end`` within it; ``values``
    hold on the first piece only, of whose first day they are. A seventh of the rows of ``lay_out`` where little happens."""
    other = [c for c in runs.columns if c not in (day, "run_end", *values)]
    weeks = F.sequence(week_start(day), week_start("run_end"), F.expr("interval 7 days"))
    cut = runs.select("*", F.posexplode(weeks).alias("_nth", "week_start"))
    return cut.select(*other, "week_start", F.greatest(day, "week_start").alias(day), F.least("run_end", F.date_add("week_start", 6)).alias("run_end"),
                      *[F.when(F.col("_nth") == 0, F.col(c)).alias(c) for c in values])


def padded_median(seen: Column, n: Column) -> Column:
    """Median of ``n`` numbers of which ``seen`` (an array) lists those that are not 0."""
    ordered = F.sort_array(seen)
    below, zeros = F.size(F.filter(seen, lambda x: x < 0)), n - F.size(seen)

    def at(i: Column) -> Column:
        return F.when(i < below, F.get(ordered, i)).when(i < below + zeros, F.lit(0.0)).otherwise(F.get(ordered, i - zeros))
    return (at(F.floor((n - 1) / 2).cast("int")) + at(F.floor(n / 2).cast("int"))) / 2
