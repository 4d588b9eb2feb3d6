"""From till lines to dense daily demand and weekly sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import day_number, month_start, week_key, week_start
from tillcast.functions.numbers import UNITS, flag, mean_money, ratio, total
from tillcast.functions.runs import event_runs, lay_out, padded_median, week_pieces

MONEY = ("gross", "coupon_disc", "promo_disc", "member_disc")


def enrich_sales(lines: DataFrame, items: DataFrame, stores: DataFrame, holidays: DataFrame) -> DataFrame:
    """Sales lines with units, calendar keys, place, item family and a holiday flag.

    Every side is reduced to one row per key first, so the number of lines is kept."""
    item = items.groupBy("variant_id").agg(*[F.max(c).alias(c) for c in ("item_id", "sub_family", "family", "pack")])
    store = stores.groupBy("store_id").agg(F.max("city_id").alias("city_id"), F.max("territory").alias("territory"))
    free = holidays.groupBy("sale_date").agg(F.max("holiday").alias("holiday"))
    return (lines.join(item, "variant_id", "left").join(store, "store_id", "left").join(free, "sale_date", "left")
            .withColumns({"units": F.col("qty") * F.col("pack"),
                          "week_start": week_start("sale_date"), "week_key": week_key("sale_date"),
                          "month_start": month_start("sale_date"), "year": F.year("sale_date"),
                          "dow": F.dayofweek("sale_date"),
                          "holiday": F.coalesce("holiday", F.lit(0))}))


def full_item_list(items: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Every listed item with its rows; items without rows stay, with NULLs."""
    return items.select(*keys).distinct().join(rows, keys, "left")


def _measures(bulk_qty: float, of: Column | None = None) -> list[Column]:
    """The daily sums of sales lines, of those with ``of`` if it is given."""
    def c(name: str) -> Column:
        return F.col(name) if of is None else F.when(of, F.col(name))
    return [F.sum(c("qty")).alias("qty"), total(c("gross")).alias("gross"),
            F.sum(F.when(F.col("qty") > 0, c("qty"))).alias("positive_qty"),
            total(c("coupon_disc")).alias("coupon_disc"), total(c("promo_disc")).alias("promo_disc"),
            total(c("member_disc")).alias("member_disc"),
            F.min(c("coupon_disc")).alias("coupon_min"),
            F.max(c("coupon_disc")).alias("coupon_max"),
            mean_money(c("coupon_disc")).alias("coupon_mean"),
            F.round(F.stddev_pop(c("coupon_disc")), 6).alias("coupon_std"),
            F.max(flag(c("qty") >= bulk_qty)).alias("any_bulk")]


def daily_sales(lines: DataFrame, keys: list[str], bulk_qty: float = 50) -> DataFrame:
    """One row per key and day: sums, spread of the coupon discount, any-bulk flag, and the
    quantity of positive lines only (the base for baselines)."""
    return lines.groupBy(*keys, "sale_date").agg(*_measures(bulk_qty))


# ---- dense daily series, kept as events

def day_facts(lines: DataFrame, keys: list[str], sold: Column, carried: Column, bulk_qty: float = 50) -> DataFrame:
    """One row per key and day with any line: the daily sums of the lines that count as ``sold`` (NULL without one) and
    whether a line shows that the assortment carries the item (``carried``)."""
    return lines.groupBy(*keys, "sale_date").agg(*_measures(bulk_qty, sold), F.max(flag(carried)).alias("carried"))


def series_spans(facts: DataFrame, keys: list[str]) -> DataFrame:
    return facts.groupBy(*keys).agg(F.min("sale_date").alias("first_day"), F.max("sale_date").alias("last_day"))


def dense_events(facts: DataFrame, empty_days: DataFrame, keys: list[str], also: list[str] = (), days: int = 90) -> DataFrame:
    """The days of a series on which something happens, as runs: days with lines and days out of stock. Each out-of-stock
    day that is carried has the median quantity of the same weekday over 0..``days`` days back.

    The days between have no sale and hold stock, so they need no row: a median is that of the (at most 13) quantities in its
    frame that are not 0, padded with zeros to the number of days the frame has. ``also`` are attributes of the key. All windows
    of a key share one exchange; a key has one row per day at most."""
    values = [c for c in facts.columns if c not in (*keys, *also, "sale_date")]
    both = facts.withColumn("empty", F.lit(0)).unionByName(
        empty_days.select(*keys, *also, "sale_date", F.lit(1).alias("empty")), allowMissingColumns=True)
    events = both.repartition(*keys).groupBy(*keys, *also, "sale_date").agg(*[F.max(c).alias(c) for c in [*values, "empty"]])
    up_to = Window.partitionBy(*keys).orderBy("sale_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = event_runs(events, keys, "sale_date").withColumns(
        {"carried": F.coalesce("carried", F.lit(0)), "dow": F.dayofweek("sale_date"), "_day": day_number("sale_date"),
         "_first": day_number(F.min("sale_date").over(up_to))})
    there = (F.col("empty") == 0) | (F.col("carried") == 1)
    back = Window.partitionBy(*keys, "dow").orderBy("_day").rangeBetween(-days, Window.currentRow)
    framed = runs.withColumns({"_seen": F.collect_list(F.when(there & (F.col("qty") != 0), F.col("qty"))).over(back),
                               "_gone": F.count(F.when(~there, 1)).over(back)})
    n = (F.floor(F.least(F.col("_day") - F.col("_first"), F.lit(days)) / 7) + 1 - F.col("_gone")).cast("int")
    return framed.withColumn("median_qty", F.when((F.col("empty") == 1) & (F.col("carried") == 1), padded_median(F.col("_seen"), n))).drop(
        "_day", "_first", "_seen", "_gone", "dow")


def dense_days(events: DataFrame, keys: list[str], also: list[str] = (), of: Column | None = None) -> DataFrame:
    """The dense daily series of ``dense_events``: days that hold stock or are carried, quantity 0 if unsold, demand the larger
    of sold and median quantity; ``stopped`` is NULL on days the assortment does not carry. ``of``, a condition on ``week_start``:
    only the days of such weeks are laid out."""
    runs, values = _present_runs(events, [*keys, *also])
    if of is not None:
        runs = week_pieces(runs, "sale_date", values).where(of).drop("week_start")
    return _dense_values(lay_out(runs, "sale_date", values), [*keys, *also, "sale_date"])


def _present_runs(events: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The events whose day is in the series, and the days after the others as runs without values; and the values' names."""
    values = [c for c in events.columns if c not in (*keys, "sale_date", "run_end")]
    there = F.coalesce("empty", F.lit(0)) - F.coalesce("carried", F.lit(0)) < 1
    runs = events.select(*keys, F.when(there, F.col("sale_date")).otherwise(F.date_add("sale_date", 1)).alias("sale_date"), "run_end",
                         *[F.when(there, F.col(c)).alias(c) for c in values])
    return runs.where(F.col("sale_date") <= F.col("run_end")), values


def _dense_values(laid: DataFrame, keys: list[str]) -> DataFrame:
    qty = F.coalesce("qty", F.lit(0.0))
    money_cols = ["gross", "coupon_disc", "promo_disc", "member_disc"]
    return laid.select(
        *keys, F.dayofweek("sale_date").alias("dow"), F.when(F.col("carried") == 1, "N").alias("stopped"),
        F.coalesce("empty", F.lit(0)).alias("out_of_stock"), qty.alias("qty"), "median_qty",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in money_cols], "coupon_min", "coupon_max", "coupon_mean", "coupon_std",
        F.coalesce("any_bulk", F.lit(0)).alias("any_bulk"),
        F.when(F.col("median_qty") > qty, F.col("median_qty")).otherwise(qty).alias("demand"))


def dense_pieces(events: DataFrame, keys: list[str], also: list[str] = ()) -> DataFrame:
    """``dense_days`` with the days of a week on which nothing happens in one row with the event before them in that week: the
    row holds for ``sale_date``, the days after it up to ``run_end`` have no sale."""
    runs, values = _present_runs(events, [*keys, *also])
    return _dense_values(week_pieces(runs, "sale_date", values), [*keys, *also, "week_start", "sale_date", "run_end"])


def days_of_pieces(pieces: DataFrame) -> DataFrame:
    """The days of ``dense_pieces``: keys, week, day, weekday, ``out_of_stock`` and ``demand``."""
    days = pieces.select("*", F.posexplode(F.sequence("sale_date", "run_end")).alias("_nth", "_day"))
    first = F.col("_nth") == 0
    return days.withColumns({"sale_date": F.col("_day"), "dow": F.dayofweek("_day"),
                             "out_of_stock": F.when(first, F.col("out_of_stock")).otherwise(0),
                             "demand": F.when(first, F.col("demand")).otherwise(0.0)}).drop("_nth", "_day", "run_end")


def event_medians(events: DataFrame, keys: list[str]) -> DataFrame:
    """The out-of-stock days of ``dense_events`` with their median, in the shape of ``oos_median``."""
    return events.where((F.col("empty") == 1) & (F.col("carried") == 1)).select(
        *keys, "sale_date", F.dayofweek("sale_date").alias("dow"), F.col("empty").alias("out_of_stock"), F.lit("N").alias("stopped"), "median_qty")


# ---- the same from any daily frames

def full_date_sales(stock: DataFrame, assortment: DataFrame, sold: DataFrame, keys: list[str]) -> DataFrame:
    """Dense daily sales: stock days that hold stock, or on which the assortment carries the item
    (``stopped`` N); quantity 0 if unsold. ``stopped`` is NULL on days without such an entry.

    ``sold`` has one row per key and day."""
    carried = assortment.where(F.col("stopped") == "N").select(*keys, "sale_date", "stopped").distinct()
    kept = (stock.drop("stopped").join(carried, [*keys, "sale_date"], "left")
            .where((F.col("balance") > 0) | (F.col("stopped") == "N")))
    per_day = sold.groupBy(*keys, "sale_date").agg(F.sum("qty").alias("qty"))
    return kept.join(per_day, [*keys, "sale_date"], "left").select(
        *keys, "sale_date", F.dayofweek("sale_date").alias("dow"), "stopped",
        flag(F.col("balance") <= 0).alias("out_of_stock"),
        F.coalesce("qty", F.lit(0.0)).alias("qty")).distinct()


def oos_median(dense: DataFrame, keys: list[str], days: int = 90) -> DataFrame:
    """For out-of-stock days: median quantity of the same weekday over 0..``days`` days back.

    A range frame per (key, weekday) holds at most 13 rows for 90 days; no self join."""
    back = (Window.partitionBy(*keys, "dow").orderBy("_day").rangeBetween(-days, Window.currentRow))
    usable = dense.where((F.col("out_of_stock") == 0) | (F.col("stopped") == "N"))  # for frames not made by full_date_sales
    return (usable.withColumn("_day", day_number("sale_date"))
            .withColumn("median_qty", F.percentile("qty", F.lit(0.5)).over(back))
            .where(F.col("out_of_stock") == 1)
            .select(*keys, "sale_date", "dow", "out_of_stock", "stopped", "median_qty"))


def daily_demand(dense: DataFrame, medians: DataFrame, per_day: DataFrame, keys: list[str]) -> DataFrame:
    """Dense days with demand = the larger of sold and median quantity, plus the day's discounts.

    Days without any sale keep their keys and their uplifted demand."""
    med = medians.select(*keys, "sale_date", "median_qty")
    money_cols = ["gross", "coupon_disc", "promo_disc", "member_disc"]
    rest = ["coupon_min", "coupon_max", "coupon_mean", "coupon_std", "any_bulk"]
    return (dense.join(med, [*keys, "sale_date"], "left")
            .join(per_day.select(*keys, "sale_date", *money_cols, *rest), [*keys, "sale_date"], "left")
            .withColumn("demand", F.when(F.col("median_qty") > F.col("qty"), F.col("median_qty"))
                        .otherwise(F.col("qty")))
            .fillna(0.0, money_cols).fillna(0, ["any_bulk"]))


def calendar_weeks(calendar: DataFrame) -> DataFrame:
    """One row per week: its keys, latest year and month, first and last day, day count."""
    return calendar.groupBy("week_start").agg(
        F.max("week_key").alias("week_key"), F.max("year").alias("year"),
        F.max("month_start").alias("month_start"), F.min("day").alias("first_day"),
        F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n_days"))


def holiday_weeks(calendar: DataFrame) -> DataFrame:
    return calendar.groupBy("week_start").agg(F.sum("holiday").cast("int").alias("holiday_days"))


def promo_week_counts(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct current and next promotions per key and week, and the largest id of each.

    A week sees a handful of promotions, so sets are cheaper than the row expansion that
    several count(distinct) in one grouping cost."""
    return daily.groupBy(*keys, week_start("sale_date").alias("week_start")).agg(
        F.size(F.collect_set("promo_id")).alias("n_current"), F.size(F.collect_set("next_promo_id")).alias("n_next"),
        F.max("promo_id").alias("promo_id"), F.max("next_promo_id").alias("next_promo_id"))


def week_day_bit(day) -> Column:
    """A number with one bit for the weekday, Monday the lowest."""
    return F.call_function("shiftleft", F.lit(1), F.weekday(day))


def place_weeks(days: DataFrame, place: list[str]) -> DataFrame:
    """Per place and week the current and the next promotions of ``place_days``, each with the weekdays it holds on (``mask``)."""
    ids = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("promo_id").alias("id")),
                            F.struct(F.lit(1).alias("kind"), F.col("next_promo_id").alias("id")))).alias("_p")
    each = days.select(*place, week_start("sale_date").alias("week_start"), week_day_bit("sale_date").alias("_bit"), ids)
    masks = (each.where("_p.id is not null").groupBy(*place, "week_start", "_p.kind", "_p.id").agg(F.bit_or("_bit").alias("mask")))
    one = F.struct("id", "mask")
    return masks.groupBy(*place, "week_start").agg(F.collect_list(F.when(F.col("kind") == 0, one)).alias("_current"),
                                                   F.collect_list(F.when(F.col("kind") == 1, one)).alias("_next"))


def _rolled_days(daily: DataFrame, keys: list[str]) -> DataFrame:
    units = {c: F.sum(F.rint(F.col(c) * UNITS).cast("bigint")).alias(c) for c in MONEY}
    week = week_start("sale_date").alias("week_start")
    parts = daily.groupBy(*keys, week, "promo_id", "next_promo_id").agg(
        F.sum("demand").alias("qty"), *units.values(), F.min("coupon_min").alias("coupon_min"), F.max("coupon_max").alias("coupon_max"),
        F.sum(F.col("coupon_mean").cast("decimal(24,8)")).alias("_means"), F.count("coupon_mean").alias("_n"),
        F.max("out_of_stock").alias("any_oos"), F.max("any_bulk").alias("any_bulk"))
    return parts.groupBy(*keys, "week_start").agg(
        F.sum("qty").alias("qty"), *[(F.sum(c) / UNITS).alias(c) for c in units], F.min("coupon_min").alias("coupon_min"),
        F.max("coupon_max").alias("coupon_max"), ratio(F.sum("_means"), F.sum("_n")).alias("coupon_mean"),
        F.size(F.collect_set("promo_id")).alias("n_current"), F.size(F.collect_set("next_promo_id")).alias("n_next"),
        F.max("promo_id").alias("promo_id"), F.max("next_promo_id").alias("next_promo_id"),
        F.max("any_oos").alias("any_oos"), F.max("any_bulk").alias("any_bulk"))


def _rolled_pieces(pieces: DataFrame, days: DataFrame, by_week: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    several = days.groupBy(*place, "sale_date").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    counted = pieces.join(several, [*place, "sale_date"], "left").withColumn("_times", F.coalesce("_times", F.lit(1)))
    whole = F.call_function("shiftleft", week_day_bit("run_end"), F.lit(1)) - week_day_bit("sale_date")  # the weekdays of the piece
    times = F.col("_times")
    rolled = counted.groupBy(*keys, "week_start").agg(
        F.sum(F.col("demand") * times).alias("qty"), *[(F.sum(F.rint(F.col(c) * UNITS).cast("bigint") * times) / UNITS).alias(c) for c in MONEY],
        F.min("coupon_min").alias("coupon_min"), F.max("coupon_max").alias("coupon_max"),
        ratio(F.sum(F.col("coupon_mean").cast("decimal(24,8)") * times), F.sum(F.when(F.col("coupon_mean").isNotNull(), times))).alias("coupon_mean"),
        F.max("out_of_stock").alias("any_oos"), F.max("any_bulk").alias("any_bulk"), F.bit_or(whole).alias("_mask"))

    def met(name: str) -> Column:  # most weeks have all their days
        return F.when(F.col("_mask") == 127, F.col(name)).otherwise(F.filter(name, lambda p: p["mask"].bitwiseAND(F.col("_mask")) != 0))
    found = rolled.join(by_week, [*place, "week_start"], "left").withColumns({"_current": met("_current"), "_next": met("_next")})

    def number(name: str) -> Column:
        return F.when(F.col(name).isNull(), 0).otherwise(F.size(name))
    return found.select(*keys, "week_start", "qty", *MONEY, "coupon_min", "coupon_max", "coupon_mean",
                        number("_current").alias("n_current"), number("_next").alias("n_next"), F.array_max("_current.id").alias("promo_id"),
                        F.array_max("_next.id").alias("next_promo_id"), "any_oos", "any_bulk")


def weekly_sales(daily: DataFrame, weeks: DataFrame, plan: DataFrame, keys: list[str], place: list[str] | None = None,
                 days: DataFrame | None = None, by_week: DataFrame | None = None) -> DataFrame:
    """Dense days rolled up to weeks, with holidays, promotion counts and the plan details of
    the week's current promotion. The plan is kept per ``place`` (the keys, unless given), whose columns that are no keys are
    attributes of them.

    ``daily`` has the promotions of each day, or is ``dense_pieces`` if ``days`` (``place_days``) and ``by_week`` (``place_weeks`` of
    them) are given. Days are first summed per pair of promotions, of which a week has a handful, so that sets are built from few
    rows. Pieces are summed per week, whose promotions are those of its place on the weekdays that the pieces hold; neither days
    nor their promotions are written out. The joined sides have one row per key."""
    place = list(place or keys)
    all_keys = [*keys, *[c for c in place if c not in keys]]
    rolled = _rolled_days(daily, all_keys) if days is None else _rolled_pieces(daily, days, by_week, all_keys, place)
    details = plan.groupBy(*place, "promo_id").agg(
        *[F.max(c).alias(c) for c in ("promo_start", "promo_end", "promo_price", "list_price", "slot", "announced")])
    upcoming = plan.groupBy(*place, F.col("promo_id").alias("next_promo_id")).agg(
        F.max("promo_start").alias("next_promo_start"), F.max("promo_end").alias("next_promo_end"),
        F.max("announced").alias("next_announced"))
    return (rolled.join(weeks, "week_start", "left").join(details, [*place, "promo_id"], "left")
            .join(upcoming, [*place, "next_promo_id"], "left"))


def oos_week(stock: DataFrame, keys: list[str]) -> DataFrame:
    """1 when any day of the week was out of stock."""
    return stock.groupBy(*keys, week_start("sale_date").alias("week_start")).agg(
        F.max(flag(F.col("balance") <= 0)).alias("any_oos"))


def weekly_totals(lines: DataFrame) -> DataFrame:
    """Sales lines by item, store and week; the year is that of the week's last day."""
    week = week_start("sale_date")
    return lines.groupBy("item_id", "sub_family", "family", "store_id", "city_id", week.alias("week_start")).agg(
        F.sum("qty").alias("qty"), total("gross").alias("gross"), total("coupon_disc").alias("coupon_disc"),
        total("promo_disc").alias("promo_disc"), total("member_disc").alias("member_disc"),
    ).withColumn("year", F.year(F.date_add("week_start", 6)))


def family_day_sales(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Quantity and amount per family (and brand), store and day; NULL counts as 0."""
    return lines.groupBy(*keys, "sale_date").agg(
        F.sum(F.coalesce("qty", F.lit(0.0))).alias("qty"),
        F.coalesce(total("gross"), F.lit(0.0)).alias("gross"))


