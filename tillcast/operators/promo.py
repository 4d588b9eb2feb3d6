"""The promotion table: one row per item, store and promotion, with history and uplift."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import month_start, week_number, week_start
from tillcast.functions.joins import explode_days, points_in_ranges, written_out
from tillcast.functions.numbers import exact_mean, ratio, total
from tillcast.functions.windows import top_row

HISTORY_ROWS = 5
# A promotion counts as history when its start week lies before the week 42 days earlier.
HISTORY_GAP_WEEKS = 7
UPLIFT_DAYS = 14


def promo_agg(daily: DataFrame, plan: DataFrame, keys: list[str], plan_keys: list[str], end) -> DataFrame:
    """Sales per key and promotion up to ``end``, plus promotions that start after it.

    Upcoming rows have NULL sales: the plan spread over the known (item, store) pairs of its
    sub family and city, minus what already has sales."""
    day = F.lit(end).cast("date")
    past = (daily.where(F.col("promo_id").isNotNull() & (F.col("sale_date") <= day))
            .groupBy(*keys, *plan_keys, "promo_id").agg(F.sum("qty").alias("sales")))
    scope = daily.select(*keys, *plan_keys).distinct()
    coming = (plan.where(F.col("promo_start") > day).select(*plan_keys, "promo_id").distinct()
              .join(written_out(scope), plan_keys)
              .join(written_out(past.select(*keys, "promo_id")), [*keys, "promo_id"], "left_anti")
              .withColumn("sales", F.lit(None).cast("double")))
    details = plan.groupBy(*plan_keys, "promo_id").agg(
        F.max("promo_price").alias("promo_price"), F.max("list_price").alias("list_price"),
        F.min("promo_start").alias("promo_start"), F.max("promo_end").alias("promo_end"), F.max("slot").alias("slot"))
    return (past.unionByName(coming).join(details, [*plan_keys, "promo_id"], "left")
            .withColumns({"price_ratio": F.round(ratio("promo_price", "list_price"), 3),
                          "start_week": week_start("promo_start"), "end_week": week_start("promo_end"),
                          "start_month": month_start("promo_start")}))


def first_promo_of_month(promos: DataFrame, keys: list[str]) -> DataFrame:
    return top_row(promos, [*keys, "start_month"], ["start_week", "promo_id"])


def promo_last_year(promos: DataFrame, keys: list[str], family: list[str]) -> DataFrame:
    """Sales and price cut of last year's first promotion in the same month, and the family's
    mean promotion sales of that month."""
    a_year_on = F.add_months("start_month", 12).alias("start_month")
    first = first_promo_of_month(promos, keys).select(
        *keys, a_year_on, F.col("sales").alias("last_year_sales"), F.col("price_ratio").alias("last_year_price_ratio"))
    fam = (promos.groupBy(*family, "start_month").agg(ratio(F.sum("sales"), F.count("sales")).alias("last_year_family_mean"))
           .withColumn("start_month", F.add_months("start_month", 12)))
    return promos.join(written_out(first), [*keys, "start_month"], "left").join(written_out(fam), [*family, "start_month"], "left")


def _history(promos: DataFrame, level: list[str], tie: list[str], name: str) -> DataFrame:
    """Per level and start week: mean sales of the last five promotions that qualify as history.

    Only the five latest promotions of a week can matter, and they are kept by rank before
    anything is gathered; the five latest up to a week then lie in the last five weekly rows,
    and a range frame looks them up seven weeks back. No promotion meets another one pairwise.
    """
    entry = F.struct(F.col("start_week"), *[F.col(t) for t in tie], F.col("sales"))
    newest = Window.partitionBy(*level, "start_week").orderBy(*[F.desc(t) for t in tie])
    ranked = promos.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= HISTORY_ROWS)
    weeks = ranked.groupBy(*level, "start_week").agg(F.collect_list(entry).alias("_own"))
    rows = Window.partitionBy(*level).orderBy("start_week").rowsBetween(1 - HISTORY_ROWS, 0)
    numbered = Window.partitionBy(*level).orderBy("_week").rangeBetween(Window.unboundedPreceding, -HISTORY_GAP_WEEKS)
    merged = F.slice(F.sort_array(F.flatten(F.collect_list("_own").over(rows)), asc=False), 1, HISTORY_ROWS)
    known = F.filter(F.col("_last")["sales"], lambda x: x.isNotNull())
    mean = ratio(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))
    return (weeks.withColumns({"_week": week_number("start_week"), "_merged": merged})
            .withColumn("_last", F.last("_merged").over(numbered))
            .select(*level, "start_week", mean.alias(name)))


def promo_history(promos: DataFrame, keys: list[str], family: list[str]) -> DataFrame:
    """Mean sales of the last five earlier promotions, of the item and of its family."""
    item = _history(promos, keys, ["promo_id"], "last_five_mean")
    fam = _history(promos, family, ["promo_id", *[k for k in keys if k not in family]], "family_last_five_mean")
    return promos.join(written_out(item), [*keys, "start_week"], "left").join(written_out(fam), [*family, "start_week"], "left")


def promo_festival(promos: DataFrame, calendar: DataFrame) -> DataFrame:
    """Largest festival type strictly inside the promotion.

    Looked up once per distinct period, by day equality."""
    periods = promos.select("promo_start", "promo_end").distinct()
    inside = explode_days(periods.withColumns({"_lo": F.date_add("promo_start", 1), "_hi": F.date_sub("promo_end", 1)}),
                          "_lo", "_hi", "day")
    found = (inside.join(calendar.where(F.col("festival").isNotNull()).select("day", "festival"), "day")
             .groupBy("promo_start", "promo_end").agg(F.max("festival").alias("festival")))
    return promos.join(found, ["promo_start", "promo_end"], "left")


def lunar_weeks(calendar: DataFrame) -> DataFrame:
    """Week -> the same week of the last lunar year (filled forward), and the weeks 15 and 45
    days around that one. One row per calendar week, so the single ordered pass is small."""
    known = calendar.select(F.col("day").alias("lunar_day"), F.col("week_start").alias("_last"))
    mapped = (calendar.select("week_start", "lunar_day").join(known, "lunar_day", "left")
              .groupBy("week_start").agg(F.min("_last").alias("_last")))
    so_far = Window.orderBy("week_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (mapped.withColumn("lunar_week", F.max("_last").over(so_far)).drop("_last")
            .withColumns({f"{side}_{n}": week_start(f("lunar_week", n))
                          for n in (15, 45) for side, f in (("from", F.date_sub), ("to", F.date_add))}))


def promo_lunar(promos: DataFrame, weeks: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and total sales and mean price cut of the key's promotions that started around the
    same lunar week a year before: within 15 days (1m) and within 45 days (3m).

    One bucketed join over the wide window serves both; the narrow one is conditional."""
    mine = promos.join(weeks.withColumnRenamed("week_start", "start_week"), "start_week", "left")
    earlier = promos.select(*keys, F.col("start_week").alias("_then"), F.col("sales").alias("_sales"),
                            F.col("price_ratio").alias("_ratio"))
    ranges = mine.select(*keys, "promo_id", "from_15", "to_15", "from_45", "to_45")
    near = points_in_ranges(ranges, earlier, keys, "from_45", "to_45", "_then", 98)
    narrow = (F.col("_then") >= F.col("from_15")) & (F.col("_then") <= F.col("to_15"))
    aggs = []
    for name, cond in (("1m", narrow), ("3m", F.lit(True))):
        sales, cut = F.when(cond, F.col("_sales")), F.when(cond, F.col("_ratio"))
        aggs += [ratio(F.sum(sales), F.count(sales)).alias(f"lunar_mean_{name}"), F.sum(sales).alias(f"lunar_sum_{name}"),
                 exact_mean(cut).alias(f"lunar_ratio_{name}")]
    stats = near.groupBy(*keys, "promo_id").agg(*aggs)
    return mine.drop("from_15", "to_15", "from_45", "to_45").join(written_out(stats), [*keys, "promo_id"], "left")


def matched_last_year(daily: DataFrame, mapping: DataFrame, plan: DataFrame, keys: list[str],
                      plan_keys: list[str]) -> DataFrame:
    """Sales and reward per key in the last-year period mapped to a promotion, for the plan's
    items; only keys with a positive reward."""
    periods = (mapping.join(plan.select(*plan_keys, "promo_id").distinct(), "promo_id")
               .select(*plan_keys, "promo_id", "last_start", "last_end"))
    hits = points_in_ranges(periods, daily, plan_keys, "last_start", "last_end", "sale_date", 31, few=True)
    return (hits.groupBy(*dict.fromkeys([*keys, *plan_keys]), "promo_id")
            .agg(F.sum("qty").alias("matched_sales"), total("reward").alias("matched_reward"))
            .where(F.col("matched_reward") > 0))


def matched_or_lunar(lunar: DataFrame, matched: DataFrame, keys: list[str]) -> DataFrame:
    """Matched last-year sales where known, else the lunar mean, as decimal(38,6)."""
    exact = matched.select(*keys, "promo_id", "matched_sales")
    return lunar.join(written_out(exact), [*keys, "promo_id"], "left").withColumns(
        {f"last_year_{n}": F.coalesce("matched_sales", f"lunar_mean_{n}").cast("decimal(38,6)") for n in ("1m", "3m")})


def promo_uplift_base(daily: DataFrame, mapping: DataFrame, plan: DataFrame, group: list[str], item: str,
                      plan_item: str) -> DataFrame:
    """Per group (store, sub family, brand) and promotion: sales in the mapped period of items
    with a positive reward, and those items' sales in the 14 days before its start.

    ``daily`` holds one row per item, store and day with qty, reward and positive qty."""
    periods = mapping.join(plan.select("promo_id", plan_item).distinct(), "promo_id")
    inside = points_in_ranges(periods, daily, [plan_item], "last_start", "last_end", "sale_date", 31, few=True)
    sold = (inside.groupBy(*group, item, "promo_id")
            .agg(F.min("last_start").alias("last_start"), F.min("last_end").alias("last_end"),
                 F.sum("qty").alias("_qty"), total("reward").alias("_reward")).where(F.col("_reward") > 0))
    during = sold.groupBy(*group, "promo_id").agg(
        F.min("last_start").alias("last_start"), F.min("last_end").alias("last_end"), F.sum("_qty").alias("promo_sales"))
    lead_in = sold.select(*group, item, "promo_id", F.date_sub("last_start", UPLIFT_DAYS).alias("_lo"), "last_start")
    ahead = points_in_ranges(lead_in, daily.where(F.col("positive_qty") > 0).select(*group, item, "sale_date", "positive_qty"),
                             [*group, item], "_lo", "last_start", "sale_date", UPLIFT_DAYS)
    prior = ahead.groupBy(*group, "promo_id").agg(F.sum("positive_qty").alias("prior_sales"))
    return during.join(written_out(prior), [*group, "promo_id"])


def promo_uplift(promos: DataFrame, base: DataFrame, group: list[str]) -> DataFrame:
    """Promotion rows with daily sales in the period over daily sales in the 14 days before.

    The period counts as end - start days, so a one-day promotion has no uplift (NULL)."""
    days = F.datediff("last_end", "last_start")
    uplift = base.select(*group, "promo_id",
                         ratio(ratio("promo_sales", days), ratio("prior_sales", F.lit(UPLIFT_DAYS))).alias("uplift"))
    return promos.join(written_out(uplift), [*group, "promo_id"], "left")


def promo_baseline(promos: DataFrame, daily: DataFrame, keys: list[str], earliest: int = 56, latest: int = 28) -> DataFrame:
    """Positive sales from 8 to 4 weeks before the promotion start, 0 if there are none."""
    ranges = promos.select(*keys, "promo_id", F.date_sub("promo_start", earliest).alias("_lo"),
                           F.date_sub("promo_start", latest).alias("_hi"))
    sold = points_in_ranges(ranges, daily.select(*keys, "sale_date", "positive_qty"), keys, "_lo", "_hi", "sale_date", 28)
    total = sold.groupBy(*keys, "promo_id").agg(F.sum("positive_qty").alias("baseline"))
    return promos.join(written_out(total), [*keys, "promo_id"], "left").fillna(0.0, ["baseline"])


def uplift_value(promos: DataFrame) -> DataFrame:
    """Expected promotion sales: baseline times uplift."""
    return promos.withColumn("uplift_value", F.col("baseline") * F.col("uplift"))
