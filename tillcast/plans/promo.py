"""Promotion-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions.dates import week_start
from tillcast.functions.numbers import total
from tillcast.operators import promo, promo_join
from tillcast.plans.registry import query
from tillcast.plans.shared import PLACE, SERIES

END = "2001-06-30"
FAMILY = ["family", "store_id"]
GROUP = ["store_id", "sub_family", "brand"]
KEY = [*SERIES, "promo_id", "sales"]


def day_sales(src):
    """Item, store and day with quantity, reward and the quantity of positive lines."""
    return src.lines().groupBy("item_id", "store_id", "sub_family", "family", "brand", "city_id", "sale_date").agg(
        F.sum("qty").alias("qty"), total("reward").alias("reward"),
        F.sum(F.when(F.col("qty") > 0, F.col("qty"))).alias("positive_qty"))


def day_sales_kept(src):
    return src.keep("day_sales", lambda: day_sales(src.keep_lines()))


def promo_table(src, daily=None):
    sold = day_sales(src) if daily is None else daily
    tagged = promo_join.current_promo(sold, src.kept_plan(), PLACE, [])
    return promo.promo_agg(tagged, src.kept_plan(), SERIES, PLACE, END)


def promo_table_kept(src, daily=None):
    """The promotion table for queries that join it with itself or read it several times."""
    return src.keep("promos", lambda: promo_table(src, daily))


def with_family(src):
    return promo_table_kept(src).withColumn("family", F.substring("sub_family", 1, 1))


def mapping(src):
    """Each campaign's period of last year: the first three weeks of the same month."""
    start = F.add_months("start", -12)
    return src.promo_headers().select("promo_id", start.alias("last_start"), F.date_add(start, 20).alias("last_end"))


def lunar(src, daily=None):
    return promo.promo_lunar(promo_table_kept(src, daily), promo.lunar_weeks(src.calendar()), SERIES)


def matched(src, daily=None):
    sold = day_sales(src) if daily is None else daily
    return promo.matched_last_year(sold, mapping(src), src.kept_plan(), SERIES, PLACE)


def uplift_base(src):
    daily = day_sales_kept(src).select("item_id", *GROUP, "sale_date", "qty", "reward", "positive_qty")
    return promo.promo_uplift_base(daily, mapping(src), src.kept_plan(), GROUP, "item_id", "sub_family")


def with_uplift(src):
    """The promotion table and the base are kept one after the other, so that their exchanges do not lie on the disks together."""
    brand = F.split_part("item_id", F.lit("|"), F.lit(2))
    daily, base = _kept_days(src), src.keep("uplift_base", lambda: uplift_base(src))
    return promo.promo_uplift(promo_table_kept(src, daily).withColumn("brand", brand), base, GROUP)


def _kept_days(src):
    """``day_sales_kept`` for queries that need of the lines only it and the plan: the kept lines go."""
    daily = day_sales_kept(src)
    src.kept_plan()
    src.forget("lines")
    return daily


@query("promo_agg", "SELECT * FROM promos")
def promo_agg(src):
    return promo_table(src)


@query("first_promo_of_month", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, store_id, start_month ORDER BY start_week, promo_id) AS rn
  FROM promos) x WHERE rn = 1""")
def first_promo_of_month(src):
    return promo.first_promo_of_month(promo_table(src), SERIES)


@query("promo_last_year", """
WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, store_id, start_month
                                                      ORDER BY start_week, promo_id) AS rn FROM promos) x WHERE rn = 1),
     m AS (SELECT substr(sub_family, 1, 1) AS family, store_id, start_month, sum(sales) / nullif(count(sales), 0) AS mean
           FROM promos GROUP BY ALL)
SELECT p.item_id, p.store_id, p.promo_id, p.sales, f.sales AS last_year_sales, f.price_ratio AS last_year_price_ratio,
       m.mean AS last_year_family_mean
FROM promos p
LEFT JOIN f ON f.item_id = p.item_id AND f.store_id = p.store_id AND f.start_month = p.start_month - INTERVAL 1 YEAR
LEFT JOIN m ON m.family = substr(p.sub_family, 1, 1) AND m.store_id = p.store_id
           AND m.start_month = p.start_month - INTERVAL 1 YEAR""")
def promo_last_year(src):
    return promo.promo_last_year(with_family(src), SERIES, FAMILY).select(
        *KEY, "last_year_sales", "last_year_price_ratio", "last_year_family_mean")


@query("promo_history", """
WITH p AS (SELECT *, substr(sub_family, 1, 1) AS family FROM promos),
     i AS (SELECT a.item_id, a.store_id, a.promo_id, b.sales,
                  row_number() OVER (PARTITION BY a.item_id, a.store_id, a.promo_id
                                     ORDER BY b.start_week DESC, b.promo_id DESC) AS rn
           FROM p a JOIN p b ON b.item_id = a.item_id AND b.store_id = a.store_id
            AND b.start_week < date_trunc('week', a.start_week - 42)),
     f AS (SELECT a.item_id, a.store_id, a.promo_id, b.sales,
                  row_number() OVER (PARTITION BY a.item_id, a.store_id, a.promo_id
                                     ORDER BY b.start_week DESC, b.promo_id DESC, b.item_id DESC) AS rn
           FROM p a JOIN p b ON b.family = a.family AND b.store_id = a.store_id
            AND b.start_week < date_trunc('week', a.start_week - 42))
SELECT p.item_id, p.store_id, p.promo_id, p.sales, x.m AS last_five_mean, y.m AS family_last_five_mean
FROM p
LEFT JOIN (SELECT item_id, store_id, promo_id, sum(sales) / nullif(count(sales), 0) AS m FROM i WHERE rn <= 5 GROUP BY ALL) x
  ON x.item_id = p.item_id AND x.store_id = p.store_id AND x.promo_id = p.promo_id
LEFT JOIN (SELECT item_id, store_id, promo_id, sum(sales) / nullif(count(sales), 0) AS m FROM f WHERE rn <= 5 GROUP BY ALL) y
  ON y.item_id = p.item_id AND y.store_id = p.store_id AND y.promo_id = p.promo_id""")
def promo_history(src):
    return promo.promo_history(with_family(src), SERIES, FAMILY).select(*KEY, "last_five_mean", "family_last_five_mean")


@query("promo_festival", """
SELECT p.item_id, p.store_id, p.promo_id, p.sales, max(c.festival) AS festival
FROM promos p LEFT JOIN calendar c ON c.day > p.promo_start AND c.day < p.promo_end AND c.festival IS NOT NULL
GROUP BY ALL""")
def promo_festival(src):
    return promo.promo_festival(promo_table_kept(src), src.calendar()).select(*KEY, "festival")


@query("lunar_weeks", """
WITH w AS (SELECT CAST(date_trunc('week', sale_date) AS DATE) AS week_start, sum(qty) AS qty FROM raw_lines GROUP BY ALL)
SELECT m.*, a.qty, b.qty AS lunar_qty
FROM lunar_map m LEFT JOIN w a ON a.week_start = m.week_start LEFT JOIN w b ON b.week_start = m.lunar_week""")
def lunar_weeks(src):
    sold = src.raw_lines().groupBy(week_start("sale_date").alias("week_start")).agg(F.sum("qty").alias("qty"))
    then = sold.withColumnsRenamed({"week_start": "lunar_week", "qty": "lunar_qty"})
    return promo.lunar_weeks(src.calendar()).join(sold, "week_start", "left").join(then, "lunar_week", "left")


@query("promo_lunar", "SELECT * FROM lunar_promos")
def promo_lunar(src):
    return lunar(src).select(*KEY, "start_week", "lunar_week", *[f"lunar_{s}_{n}" for n in ("1m", "3m")
                                                                for s in ("mean", "sum", "ratio")])


@query("matched_last_year", "SELECT * FROM matched")
def matched_last_year(src):
    return matched(src)


@query("matched_or_lunar", """
SELECT l.item_id, l.store_id, l.promo_id, l.sales, m.matched_sales,
       CAST(CAST(coalesce(m.matched_sales, l.lunar_mean_1m) AS DECIMAL(38,6)) AS DOUBLE) AS last_year_1m,
       CAST(CAST(coalesce(m.matched_sales, l.lunar_mean_3m) AS DECIMAL(38,6)) AS DOUBLE) AS last_year_3m
FROM lunar_promos l
LEFT JOIN matched m ON m.item_id = l.item_id AND m.store_id = l.store_id AND m.promo_id = l.promo_id""")
def matched_or_lunar(src):
    daily = _kept_days(src)
    out = promo.matched_or_lunar(lunar(src, daily), matched(src, daily), SERIES)
    return out.select(*KEY, "matched_sales", *[F.col(c).cast("double").alias(c) for c in ("last_year_1m", "last_year_3m")])


@query("promo_uplift_base", "SELECT * FROM uplift_rows")
def promo_uplift_base(src):
    return uplift_base(src)


@query("promo_uplift", "SELECT * FROM uplifts")
def promo_uplift(src):
    return with_uplift(src).select(*KEY, "uplift")


@query("promo_baseline", "SELECT * FROM baselines")
def promo_baseline(src):
    return promo.promo_baseline(promo_table_kept(src, day_sales_kept(src)), day_sales_kept(src), SERIES).select(
        *KEY, "sub_family", "promo_start", "baseline")


@query("uplift_value", """
SELECT u.item_id, u.store_id, u.promo_id, u.sales, b.baseline, u.uplift, b.baseline * u.uplift AS uplift_value
FROM uplifts u JOIN baselines b ON b.item_id = u.item_id AND b.store_id = u.store_id AND b.promo_id = u.promo_id""")
def uplift_value(src):
    out = promo.uplift_value(promo.promo_baseline(with_uplift(src), day_sales_kept(src), SERIES))
    return out.select(*KEY, "baseline", "uplift", "uplift_value")
