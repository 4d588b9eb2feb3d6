"""Join shapes Spark has no operator for, built so that they shuffle on
(key, date bucket) and never compare a key's rows all against all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import day_number


def explode_days(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """One row per day of [start, end]; rows with an empty or unknown period vanish."""
    return df.where(F.col(end) >= F.col(start)).withColumn(
        out, F.explode(F.sequence(F.col(start), F.col(end))))


def written_out(df: DataFrame) -> DataFrame:
    """Rows that grow with the input, or that an explode made many, for the side of a join: the join shuffles them.

    The planner takes an explode for as large as its input, and a kept table (and what is aggregated from it) for as large as its
    compressed file, and would send the rows whole through the driver as a broadcast; a join once planned so stays so, even when it
    learns the real size."""
    return df.hint("merge")


def points_in_ranges(ranges: DataFrame, points: DataFrame, keys: list[str], lo: str, hi: str,
                     point: str, bucket_days: int, few: bool = False) -> DataFrame:
    """Inner join of ``points`` to every range of the same key with lo <= point <= hi.

    Each range is copied to the date buckets it touches and joined by (key, bucket), so a
    key that holds a large part of the rows is spread over its buckets and a point meets
    only ranges near it. Pick a bucket about as long as a range: copies stay at 2 or 3. ``few``
    ranges, whose number does not grow with the points, may be broadcast.
    """
    def bucket(c):
        return F.floor(day_number(c) / bucket_days).cast("int")

    spread = ranges.where(F.col(lo) <= F.col(hi)).withColumn(
        "_bucket", F.explode(F.sequence(bucket(lo), bucket(hi))))
    placed = points.withColumn("_bucket", bucket(point))
    return ((spread if few else written_out(spread)).join(placed, [*keys, "_bucket"])
            .where((F.col(point) >= F.col(lo)) & (F.col(point) <= F.col(hi)))
            .drop("_bucket"))


def next_event(days: DataFrame, events: DataFrame, keys: list[str], day: str, event_day: str,
               payload: list[str], tie: str) -> DataFrame:
    """As-of forward: for each distinct (key, day), the nearest event strictly after the day.

    ``days`` is reduced to distinct (key, day) first, so a window partition holds at most one
    row per day plus the key's events, whatever the number of sales lines behind them. Rows
    are walked from the latest day back, carrying the last event seen. Ties on the event day
    go to the smallest ``tie``. Returns keys, day, event_day, payload.
    """
    wanted = [event_day, *payload]
    ticks = days.select(*keys, F.col(day).alias("_at")).distinct().withColumn("_kind", F.lit(0))
    marks = (events.where(F.col(event_day).isNotNull())
             .select(*keys, F.col(event_day).alias("_at"),
                     F.struct(*[F.col(c) for c in wanted]).alias("_event"),
                     F.col(tie).alias("_tie"))
             .withColumn("_kind", F.lit(1)))
    both = ticks.unionByName(marks, allowMissingColumns=True)
    later_first = (Window.partitionBy(*keys)
                   .orderBy(F.desc("_at"), F.asc("_kind"), F.desc("_tie"))
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (both.withColumn("_next", F.last("_event", ignorenulls=True).over(later_first))
            .where(F.col("_kind") == 0)
            .select(*keys, F.col("_at").alias(day), *[F.col("_next")[c].alias(c) for c in wanted]))


def keep_left(left: DataFrame, right: DataFrame, keys: list[str], defaults: dict | None = None) -> DataFrame:
    """Left join on shared key names, then defaults for missing values."""
    out = left.join(right, keys, "left")
    return out.fillna(defaults) if defaults else out
