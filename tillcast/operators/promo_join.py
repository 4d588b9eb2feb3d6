"""Attaching promotions to sales days: the one running, and the next one to come."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.joins import explode_days, next_event, written_out


def current_promo(sales: DataFrame, plan: DataFrame, keys: list[str], payload: list[str],
                  day: str = "sale_date") -> DataFrame:
    """Promotion running on the sales day (inclusive ends) and a 0/1 flag.

    The plan is spread to its days, so this is an equi join on (key, day): rows of a popular
    key are spread over the days instead of meeting all promotions of the key in one task.
    A sales row matching several promotions appears once per promotion.
    """
    days = (explode_days(plan, "promo_start", "promo_end", day)
            .select(*keys, day, "promo_id", "promo_start", "promo_end", *payload))
    return (sales.join(written_out(days), [*keys, day], "left")
            .withColumn("on_promo", F.when(F.col("promo_start").isNotNull(), 1).otherwise(0)))


def next_promo(sales: DataFrame, plan: DataFrame, keys: list[str], payload: list[str] = (),
               day: str = "sale_date") -> DataFrame:
    """One row per distinct (key, day): the first promotion that starts after the day."""
    return next_event(sales, plan, keys, day, "promo_start", ["promo_id", "promo_end", *payload], tie="promo_id")


def future_promos(sales: DataFrame, plan: DataFrame, keys: list[str], day: str = "sale_date") -> DataFrame:
    """All later promotions of each distinct (key, day): how many, the first and the last start.

    The set itself is every promotion past the day; writing it out row by row would repeat
    the plan for each sales day, so the window carries counts and bounds instead.
    """
    ticks = sales.select(*keys, F.col(day).alias("_at")).distinct().withColumn("_start", F.lit(None).cast("date"))
    marks = plan.select(*keys, F.col("promo_start").alias("_at"), F.col("promo_start").alias("_start"))
    # At one date the sales rows (no start) come first: a promotion starting today is not later.
    later = (Window.partitionBy(*keys).orderBy(F.desc("_at"), F.asc_nulls_first("_start"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ticks.unionByName(marks)
            .withColumn("n_future", F.count("_start").over(later))
            .withColumn("first_start", F.min("_start").over(later))
            .withColumn("last_start", F.max("_start").over(later))
            .where(F.col("_start").isNull() & (F.col("n_future") > 0))
            .select(*keys, F.col("_at").alias(day), "n_future", "first_start", "last_start"))


def next_promo_detail(sales: DataFrame, plan: DataFrame, keys: list[str], payload: list[str],
                      day: str = "sale_date") -> DataFrame:
    """Sales rows with the next promotion, its plan attributes and the days until it starts."""
    upcoming = next_promo(sales, plan, keys, payload, day)
    renamed = {c: f"next_{c}" for c in ["promo_start", "promo_id", "promo_end", *payload]}
    return (sales.join(upcoming.withColumnsRenamed(renamed), [*keys, day], "left")
            .withColumn("days_to_next", F.datediff("next_promo_start", day)))


def daily_promo(daily: DataFrame, plan: DataFrame, keys: list[str], day: str = "sale_date") -> DataFrame:
    """Dense daily rows with the current promotion (plan de-duplicated) and the next one.

    Days without a later promotion keep NULLs."""
    slim = plan.select(*keys, "promo_id", "promo_start", "promo_end").distinct()
    upcoming = next_promo(daily, slim, keys, day=day).select(
        *keys, day, F.col("promo_id").alias("next_promo_id"), F.col("promo_start").alias("next_promo_start"))
    return current_promo(daily, slim, keys, [], day).join(upcoming, [*keys, day], "left")


def place_days(plan: DataFrame, keys: list[str], first_day, day: str = "sale_date") -> DataFrame:
    """For each day of a place from ``first_day`` on: the promotion running and the first one to start after it.

    The next promotion is laid out from the plan itself, from one start to the day before the following one, so the
    days of sales are not needed. Of promotions that start together the smallest id is the next one; a day in several
    promotions has a row for each."""
    slim = plan.select(*keys, "promo_id", "promo_start", "promo_end").distinct()
    running = explode_days(slim, "promo_start", "promo_end", day)
    starts = slim.groupBy(*keys, "promo_start").agg(F.min("promo_id").alias("promo_id"))
    earlier = F.lag("promo_start").over(Window.partitionBy(*keys).orderBy("promo_start"))
    ahead = starts.select(*keys, F.col("promo_id").alias("next_promo_id"), F.col("promo_start").alias("next_promo_start"),
                          F.greatest(F.coalesce(earlier, F.lit(first_day)), F.lit(first_day)).alias("_from"), F.date_sub("promo_start", 1).alias("_to"))
    upcoming = explode_days(ahead, "_from", "_to", day).drop("_from", "_to")
    return running.join(upcoming, [*keys, day], "full")


def daily_promo_by_place(daily: DataFrame, days: DataFrame, keys: list[str], day: str = "sale_date") -> DataFrame:
    """Daily rows with the current and the next promotion of their place, from ``place_days``."""
    return daily.join(days, [*keys, day], "left").withColumn("on_promo", F.when(F.col("promo_start").isNotNull(), 1).otherwise(0))
