"""Which stores, items and promotions take part, and what they are called."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid_at(df: DataFrame, run_date, start: str = "start", end: str = "end") -> DataFrame:
    """Effective-dated rows in force at the run date: start < run date <= end."""
    now = F.lit(run_date).cast("date")
    return df.where((F.col(start) < now) & (F.col(end) >= now))


def open_stores(stores: DataFrame, closures: DataFrame, run_date, territories: list, skip_format: str) -> DataFrame:
    """Stores of the territories, without one format, minus those closed at the run date."""
    closed = valid_at(closures, run_date).select("store_id")
    return (stores.where(F.col("territory").isin(territories) & (F.col("format") != skip_format))
            .join(closed, "store_id", "left_anti"))


def scope_items(sold: DataFrame, rules: dict[str, list[str]], start, end, stores: DataFrame | None = None) -> DataFrame:
    """Distinct (item, brand) sold in [start, end) by the scope's stores.

    ``rules`` maps each brand to the departments taken from it: one pass with a disjunction
    gives what a union of one query per brand would.
    """
    if stores is not None:
        sold = sold.join(stores.select("store_id").distinct(), "store_id", "left_semi")
    wanted = F.lit(False)
    for brand, departments in rules.items():
        wanted = wanted | ((F.col("brand") == brand) & F.col("family").isin(departments))
    period = (F.col("sale_date") >= F.lit(start).cast("date")) & (F.col("sale_date") < F.lit(end).cast("date"))
    return sold.where(wanted & period).select("item_id", "brand").distinct()


def item_hierarchy(items: DataFrame, texts: DataFrame) -> DataFrame:
    """Group family, family and sub family codes (department + 1, 2, 3 code digits) and texts."""
    out = items
    for level, name in enumerate(["group_family", "family_level", "sub_family_level"], start=1):
        code = F.concat("family", F.substring("item_code", 1, level))
        labels = texts.where(F.col("level") == level).select(
            F.col("code").alias(f"{name}_code"), F.col("text").alias(f"{name}_text"))
        out = out.withColumn(f"{name}_code", code).join(labels, f"{name}_code", "left")
    return out


def latest_status(stock: DataFrame, day, items: DataFrame, stores: DataFrame,
                  item_key: str, store_key: str) -> DataFrame:
    """Stock rows of one day, kept when both the item and the store are in scope."""
    return (stock.where(F.col("sale_date") == F.lit(day).cast("date"))
            .join(items.select(item_key).distinct(), item_key, "left_semi")
            .join(stores.select(store_key).distinct(), store_key, "left_semi"))


def promo_plan(headers: DataFrame, promo_lines: DataFrame, start_year: int, version: int,
               strict_year: bool = False) -> DataFrame:
    """Campaigns from a year on that were not withdrawn, with their lines of one version."""
    year = F.col("year") > start_year if strict_year else F.col("year") >= start_year
    live = headers.where(year & (F.col("status") != "-1"))
    lines = promo_lines.where(F.col("version") == version).drop("version")
    return live.join(lines, "promo_id", "left")


def item_start(assortment: DataFrame) -> DataFrame:
    """First day a variant is in a store's assortment."""
    return assortment.groupBy("variant_id", "store_id").agg(F.min("sale_date").alias("start_date"))


def assortment(days: DataFrame, id_map: DataFrame, departments: list[str]) -> DataFrame:
    """Store assortment with the item id the variant had that day, for some departments."""
    ids = (id_map.where(F.col("family").isin(departments))
           .select("variant_id", "sale_date", "item_id", "family").distinct())
    return days.join(ids, ["variant_id", "sale_date"], "left_semi").join(ids, ["variant_id", "sale_date"], "left")


def active_flag(rows: DataFrame, status: DataFrame, keys: list[str]) -> DataFrame:
    """1 for rows whose latest status has no stop reason, 0 for stopped, NULL when unknown."""
    latest = status.groupBy(*keys).agg(
        F.max(F.when(F.col("stop_reason").isNull(), 1).otherwise(0)).alias("active"))
    return rows.join(latest, keys, "left")
