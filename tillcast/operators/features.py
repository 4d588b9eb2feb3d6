"""Weekly features: trailing statistics, shares, promotion timing, outside information."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import week_number, week_start, weeks_between
from tillcast.functions.joins import keep_left
from tillcast.functions.numbers import exact_mean, flag, ratio
from tillcast.functions.windows import before, trailing, trailing_means

LENGTHS = (4, 12, 24, 52)


def level_means(weekly: DataFrame, keys: list[str], prefix: str, spread: bool = False,
                lengths=LENGTHS) -> DataFrame:
    """Sales of a level per week, with the means of its previous 4, 12, 24, 52 rows and, with
    ``spread``, the smallest and largest earlier week. Windows run on the rolled-up rows."""
    level = weekly.groupBy(*keys, "week_start").agg(F.sum("qty").alias("_qty"))
    cols = trailing_means("_qty", keys, "week_start", lengths, f"{prefix}_mean")
    if spread:
        earlier = before(keys, "week_start")
        cols |= {f"{prefix}_min": F.min("_qty").over(earlier), f"{prefix}_max": F.max("_qty").over(earlier)}
    return level.withColumns(cols).drop("_qty")


def rolling_means(weekly: DataFrame, item: list[str], sub_family: list[str], family: list[str]) -> DataFrame:
    """Weekly rows with trailing means at item, sub family and family level of the store."""
    out = weekly
    for keys, prefix, spread in [(family, "family", True), (sub_family, "sub_family", False), (item, "item", False)]:
        out = out.join(level_means(weekly, keys, prefix, spread), [*keys, "week_start"], "left")
    return out


def _year_to_date(weekly: DataFrame, keys: list[str], name: str) -> DataFrame:
    level = weekly.groupBy(*keys, "year", "week_start").agg(F.sum("qty").alias("_qty"))
    return level.withColumn(name, F.sum("_qty").over(before([*keys, "year"], "week_start"))).drop("_qty")


def share_to_date(weekly: DataFrame, item: str, family: str, store: str) -> DataFrame:
    """Share of the item in its family over the year's earlier weeks, in the store and nationally.

    Both parts count whole earlier weeks; the national item total is rolled up over stores
    first, so rows of other stores in the same week never leak in."""
    parts = [([item, store], "_item_store"), ([family, store], "_family_store"),
             ([item], "_item"), ([family], "_family")]
    out = weekly
    for keys, name in parts:
        out = out.join(_year_to_date(weekly, keys, name), [*keys, "year", "week_start"], "left")
    return (out.withColumn("share_in_store", ratio("_item_store", "_family_store"))
            .withColumn("share_national", ratio("_item", "_family"))
            .drop(*[name for _, name in parts]))


def discount_ratio(weekly: DataFrame, keys: list[str]) -> DataFrame:
    """Earlier weeks with a discount over earlier weeks with sales; NULL without sales."""
    w = before(keys, "week_start")
    discounted = (F.col("coupon_disc") > 0) | (F.col("promo_disc") > 0) | (F.col("member_disc") > 0)
    return weekly.withColumn("discount_ratio", ratio(F.sum(flag(discounted)).over(w),
                                                     F.sum(flag(F.col("qty") > 0)).over(w)))


def promo_price_features(weekly: DataFrame) -> DataFrame:
    """Price cut, length, weekdays and timing of the current promotion, and the weeks to the
    next one as far as it was announced by the row's week."""
    known = week_start("next_announced") <= F.col("week_start")
    return weekly.withColumns({
        "price_ratio": ratio("promo_price", "list_price"),
        "promo_days": F.datediff("promo_end", "promo_start"),
        "start_dow": F.dayofweek("promo_start"), "end_dow": F.dayofweek("promo_end"),
        "weeks_since_start": weeks_between("week_start", "promo_start"),
        "weeks_to_end": weeks_between("promo_end", "week_start"),
        "weeks_to_next": F.when(known, weeks_between("next_promo_start", "week_start")),
        "next_promo_days": F.datediff("next_promo_end", "next_promo_start")})


def climate_join(weekly: DataFrame, climate: DataFrame) -> DataFrame:
    """Monthly temperatures of the city; text that is no number becomes NULL."""
    month = climate.groupBy("month", "city_id").agg(
        F.max(F.col("high").try_cast("double")).alias("high"), F.max(F.col("low").try_cast("double")).alias("low"))
    return keep_left(weekly.withColumn("month", F.date_format("week_start", "MM")), month, ["month", "city_id"])


def competitor_flag(weekly: DataFrame, competitor: DataFrame, since) -> DataFrame:
    """1 when a competitor of the same city promoted the item since a date."""
    seen = (competitor.where(F.col("created") >= F.lit(since).cast("date"))
            .select("city_id", "item_id").distinct().withColumn("competitor", F.lit(1)))
    return keep_left(weekly, seen, ["city_id", "item_id"], {"competitor": 0})


def next_promo_week_sales(weekly: DataFrame, keys: list[str]) -> DataFrame:
    """Sales of the key in the first and second week of the row's next promotion."""
    out = weekly
    for n in (1, 2):
        sold = weekly.select(*keys, F.col("week_start").alias(f"_w{n}"), F.col("qty").alias(f"next_promo_qty_w{n}"))
        target = week_start(F.date_add("next_promo_start", 7 * (n - 1)))
        out = out.withColumn(f"_w{n}", target).join(sold, [*keys, f"_w{n}"], "left").drop(f"_w{n}")
    return out


def barcode_pick(barcodes: DataFrame, keys: list[str]) -> DataFrame:
    """First created main barcode that has not ended; one minimum per key, no sort."""
    usable = barcodes.where((F.col("main") == "Y") & F.col("ended").isNull())
    first = F.min(F.struct("created", "barcode"))
    return usable.groupBy(*keys).agg(first.alias("_b")).select(*keys, "_b.created", "_b.barcode")


def festival_tickets(lines: DataFrame, festivals: DataFrame, keys: list[str]) -> DataFrame:
    """Ticket lines (not distinct tickets) on festival days, per festival and year."""
    days = festivals.where(F.col("festival").isNotNull()).select(
        F.col("day").alias("sale_date"), "festival", "year").distinct()
    return lines.join(days, "sale_date").groupBy(*keys, "festival", "year").agg(F.count("ticket_id").alias("tickets"))


def festival_last_year(tickets: DataFrame, keys: list[str]) -> DataFrame:
    """This year's festivals with the ticket lines of the same festival a year before."""
    prior = tickets.select(*keys, "festival", (F.col("year") + 1).alias("year"), F.col("tickets").alias("tickets_last_year"))
    return tickets.join(prior, [*keys, "festival", "year"], "left")


def weekly_final(weekly: DataFrame, texts: DataFrame, barcodes: DataFrame, oos: DataFrame, oos_keys: list[str],
                 festivals: DataFrame, tickets: DataFrame, keys: list[str]) -> DataFrame:
    """Weekly rows with item text, barcode, out-of-stock flag, the week's festival and the
    ticket lines that festival had a year before. Every joined side has one row per key."""
    week_festival = festivals.groupBy("week_start").agg(F.max("festival").alias("festival"))
    prior = tickets.select(*keys, "festival", (F.col("year") + 1).alias("year"), F.col("tickets").alias("tickets_last_year"))
    return (weekly.join(texts, "item_id", "left").join(barcodes.select("item_id", "barcode"), "item_id", "left")
            .join(oos, [*oos_keys, "week_start"], "left").join(week_festival, "week_start", "left")
            .join(prior, [*keys, "festival", "year"], "left")
            .fillna(0, ["any_oos"]))


def family_item_ratio(weekly: DataFrame, item: list[str], levels: dict[str, list[str]]) -> DataFrame:
    """Sales per item within the family (and sub family) of the store and week, with trailing
    means along the item's series."""
    out = weekly
    for name, keys in levels.items():
        per_item = weekly.groupBy(*keys, "week_start").agg(
            ratio(F.sum("qty"), F.count(F.lit(1))).alias(f"{name}_per_item"))
        out = out.join(per_item, [*keys, "week_start"], "left")
    means = {f"{name}_per_item_{n}": exact_mean(f"{name}_per_item", trailing(item, "week_start", n))
             for name in levels for n in LENGTHS}
    return out.withColumns(means)


def last_year_sales(weekly: DataFrame, keys: list[str], exact: int = 364, earliest: int = 395,
                    latest: int = 333) -> DataFrame:
    """Quantity a year earlier: the nearest week at or before it within a month, else the
    nearest one after it within a month. Offsets are days before the week's Monday.

    Two range frames over the week number replace two self joins with ranking."""
    lo, mid, hi = (-math.ceil(d / 7) for d in (earliest, exact, latest))
    weeks = Window.partitionBy(*keys).orderBy("_week")
    back, ahead = F.last("qty").over(weeks.rangeBetween(lo, mid)), F.first("qty").over(weeks.rangeBetween(mid, hi))
    return (weekly.withColumn("_week", week_number("week_start"))
            .withColumn("last_year_qty", F.coalesce(back, ahead)).drop("_week"))


def weekly_features(weekly: DataFrame, oos: DataFrame, keys: list[str]) -> DataFrame:
    return keep_left(weekly, oos, [*keys, "week_start"], {"any_oos": 0})
