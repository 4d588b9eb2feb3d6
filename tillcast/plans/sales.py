"""Sales, promotion joins, dense daily demand and weekly roll-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions.dates import week_start
from tillcast.operators import promo_join, sales
from tillcast.operators.bulk import on_promo_or_discount
from tillcast.plans.registry import query
from tillcast.plans.shared import DENSE, PLACE, dense_demand, dense_events, dense_promo, dense_weeks, holidays, weekly

LINE = ["ticket_id", "hour", "variant_id", "store_id", "sale_date", "qty"]


@query("enrich_sales", """
SELECT l.ticket_id, l.hour, l.variant_id, l.store_id, l.sale_date, l.qty, l.item_id, l.sub_family, l.family,
       l.city_id, l.territory, l.qty * i.pack AS units, c.week_start, c.week_key, c.month_start, c.year, c.dow,
       c.holiday
FROM lines l JOIN items i ON i.variant_id = l.variant_id JOIN calendar c ON c.day = l.sale_date""")
def enrich_sales(src):
    raw = src.raw_lines().select(*LINE)
    return sales.enrich_sales(raw, src.items(), src.stores(), holidays(src)).drop("pack")


@query("promo_split", """
SELECT store_id, sale_date, CASE WHEN promo_id IS NOT NULL OR coupon_disc > 0 OR promo_disc > 0 OR member_disc > 0
                                 THEN 'promo' ELSE 'regular' END AS branch, sum(qty) AS qty, count(*) AS n
FROM lines l LEFT JOIN plan p ON p.sub_family = l.sub_family AND p.city_id = l.city_id
                             AND l.sale_date BETWEEN p.promo_start AND p.promo_end
GROUP BY ALL""")
def promo_split(src):
    tagged = promo_join.current_promo(src.lines(), src.plan(), PLACE, [])
    branch = F.when(on_promo_or_discount(), "promo").otherwise("regular")
    return tagged.groupBy("store_id", "sale_date", branch.alias("branch")).agg(
        F.sum("qty").alias("qty"), F.count(F.lit(1)).alias("n"))


@query("current_promo", """
SELECT l.ticket_id, l.hour, l.variant_id, l.store_id, l.sale_date, l.qty, p.promo_id, p.promo_start, p.promo_end,
       p.promo_price, p.list_price, CASE WHEN p.promo_start IS NOT NULL THEN 1 ELSE 0 END AS on_promo
FROM lines l LEFT JOIN plan p ON p.sub_family = l.sub_family AND p.city_id = l.city_id
                             AND l.sale_date >= p.promo_start AND l.sale_date <= p.promo_end""")
def current_promo(src):
    return promo_join.current_promo(src.lines(), src.plan(), PLACE, ["promo_price", "list_price"]).select(
        *LINE, "promo_id", "promo_start", "promo_end", "promo_price", "list_price", "on_promo")


@query("future_promos", """
SELECT l.sub_family, l.city_id, l.sale_date, count(*) AS n_future, min(p.promo_start) AS first_start,
       max(p.promo_start) AS last_start
FROM (SELECT DISTINCT sub_family, city_id, sale_date FROM lines) l
JOIN plan p ON p.sub_family = l.sub_family AND p.city_id = l.city_id AND p.promo_start > l.sale_date
GROUP BY ALL""")
def future_promos(src):
    return promo_join.future_promos(src.lines(), src.plan(), PLACE)


@query("next_promo", """
SELECT sub_family, city_id, sale_date, promo_start, promo_id, promo_end
FROM (SELECT l.*, p.promo_start, p.promo_id, p.promo_end,
             row_number() OVER (PARTITION BY l.sub_family, l.city_id, l.sale_date ORDER BY p.promo_start, p.promo_id) AS rn
      FROM (SELECT DISTINCT sub_family, city_id, sale_date FROM lines) l
      LEFT JOIN plan p ON p.sub_family = l.sub_family AND p.city_id = l.city_id AND p.promo_start > l.sale_date) x
WHERE rn = 1""")
def next_promo(src):
    return promo_join.next_promo(src.lines(), src.plan(), PLACE)


@query("next_promo_detail", """
SELECT ticket_id, hour, variant_id, store_id, sale_date, qty, next_promo_id, next_promo_start, next_promo_end,
       next_promo_price, next_slot, CAST(next_promo_start - sale_date AS INTEGER) AS days_to_next
FROM (SELECT l.ticket_id, l.hour, l.variant_id, l.store_id, l.sale_date, l.qty, p.promo_id AS next_promo_id,
             p.promo_start AS next_promo_start, p.promo_end AS next_promo_end, p.promo_price AS next_promo_price,
             p.slot AS next_slot
      FROM lines l
      LEFT JOIN (SELECT l.sub_family, l.city_id, l.sale_date, min(p.promo_start) AS s
                 FROM lines l JOIN plan p ON p.sub_family = l.sub_family AND p.city_id = l.city_id
                                         AND p.promo_start > l.sale_date GROUP BY ALL) n
        ON n.sub_family = l.sub_family AND n.city_id = l.city_id AND n.sale_date = l.sale_date
      LEFT JOIN plan p ON p.sub_family = l.sub_family AND p.city_id = l.city_id AND p.promo_start = n.s) x""")
def next_promo_detail(src):
    return promo_join.next_promo_detail(src.lines(), src.plan(), PLACE, ["promo_price", "slot"]).select(
        *LINE, "next_promo_id", "next_promo_start", "next_promo_end", "next_promo_price", "next_slot", "days_to_next")


@query("full_item_sales", """
SELECT i.variant_id, l.ticket_id, l.store_id, l.sale_date, l.qty
FROM items i LEFT JOIN raw_lines l ON l.variant_id = i.variant_id""")
def full_item_sales(src):
    rows = src.raw_lines().select("variant_id", "ticket_id", "store_id", "sale_date", "qty")
    return sales.full_item_list(src.items(), rows, ["variant_id"])


@query("full_item_weekly", """
SELECT i.item_id, w.store_id, w.week_start, w.qty
FROM (SELECT DISTINCT item_id FROM items) i LEFT JOIN weekly w ON w.item_id = i.item_id""")
def full_item_weekly(src):
    return sales.full_item_list(src.items(), weekly(src).select("item_id", "store_id", "week_start", "qty"), ["item_id"])


@query("daily_sales", """
SELECT item_id, store_id, sale_date, sum(qty) AS qty, CAST(sum(gross) AS DOUBLE) AS gross,
       sum(CASE WHEN qty > 0 THEN qty END) AS positive_qty, CAST(sum(coupon_disc) AS DOUBLE) AS coupon_disc,
       CAST(sum(promo_disc) AS DOUBLE) AS promo_disc, CAST(sum(member_disc) AS DOUBLE) AS member_disc,
       CAST(min(coupon_disc) AS DOUBLE) AS coupon_min, CAST(max(coupon_disc) AS DOUBLE) AS coupon_max,
       CAST(sum(coupon_disc) AS DOUBLE) / count(coupon_disc) AS coupon_mean,
       round(stddev_pop(CAST(coupon_disc AS DOUBLE)), 6) AS coupon_std,
       max(CASE WHEN qty >= 50 THEN 1 ELSE 0 END) AS any_bulk
FROM lines GROUP BY item_id, store_id, sale_date""")
def daily_sales(src):
    return sales.daily_sales(src.lines(), ["item_id", "store_id"])


@query("full_date_sales", "SELECT * FROM dense_days")
def full_date_sales(src):
    return dense_demand(src).select(*DENSE, "city_id", "sale_date", "dow", "stopped", "out_of_stock", "qty")


@query("oos_median", "SELECT * FROM oos_medians")
def oos_median(src):
    return sales.event_medians(dense_events(src), DENSE)


@query("daily_demand", "SELECT * FROM dense_demand")
def daily_demand(src):
    return dense_demand(src)


@query("calendar_weeks", """
SELECT c.week_start, max(c.week_key) AS week_key, max(c.year) AS year, max(c.month_start) AS month_start,
       min(c.day) AS first_day, max(c.day) AS last_day, count(*) AS n_days, any_value(s.n_lines) AS n_lines
FROM calendar c
LEFT JOIN (SELECT CAST(date_trunc('week', sale_date) AS DATE) AS week_start, count(*) AS n_lines
           FROM raw_lines GROUP BY ALL) s ON s.week_start = c.week_start
GROUP BY c.week_start""")
def calendar_weeks(src):
    sold = src.raw_lines().groupBy(week_start("sale_date").alias("week_start")).agg(F.count(F.lit(1)).alias("n_lines"))
    return sales.calendar_weeks(src.calendar()).join(sold, "week_start", "left")


@query("holiday_week", """
SELECT w.store_id, w.week_start, w.qty, h.holiday_days
FROM (SELECT store_id, CAST(date_trunc('week', sale_date) AS DATE) AS week_start, sum(qty) AS qty
      FROM raw_lines GROUP BY ALL) w
LEFT JOIN (SELECT week_start, CAST(sum(holiday) AS INTEGER) AS holiday_days FROM calendar GROUP BY ALL) h
  ON h.week_start = w.week_start""")
def holiday_week(src):
    weeks = src.raw_lines().groupBy("store_id", week_start("sale_date").alias("week_start")).agg(F.sum("qty").alias("qty"))
    return weeks.join(sales.holiday_weeks(src.calendar()), "week_start", "left")


@query("daily_promo", "SELECT * FROM dense_promo")
def daily_promo(src):
    return dense_promo(src)


@query("promo_week_counts", """
SELECT sub_family, store_id, CAST(date_trunc('week', sale_date) AS DATE) AS week_start,
       CAST(count(DISTINCT promo_id) AS INTEGER) AS n_current, CAST(count(DISTINCT next_promo_id) AS INTEGER) AS n_next,
       max(promo_id) AS promo_id, max(next_promo_id) AS next_promo_id
FROM dense_promo GROUP BY ALL""")
def promo_week_counts(src):
    return sales.promo_week_counts(dense_promo(src), DENSE)


@query("weekly_sales", "SELECT * FROM dense_weeks")
def weekly_sales(src):
    return dense_weeks(src)


@query("oos_week", """
SELECT sub_family, store_id, CAST(date_trunc('week', sale_date) AS DATE) AS week_start,
       CASE WHEN sum(CASE WHEN balance <= 0 THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS any_oos
FROM stock GROUP BY ALL""")
def oos_week(src):
    return sales.oos_week(src.stock(), DENSE)


@query("family_day_sales", """
SELECT sub_family, store_id, sale_date, sum(coalesce(qty, 0)) AS qty, CAST(sum(coalesce(gross, 0)) AS DOUBLE) AS gross
FROM lines GROUP BY sub_family, store_id, sale_date""")
def family_day_sales(src):
    return sales.family_day_sales(src.lines(), ["sub_family", "store_id"])


@query("family_brand_day_sales", """
SELECT sub_family, brand, store_id, sale_date, sum(coalesce(qty, 0)) AS qty,
       CAST(sum(coalesce(gross, 0)) AS DOUBLE) AS gross
FROM lines GROUP BY sub_family, brand, store_id, sale_date""")
def family_brand_day_sales(src):
    return sales.family_day_sales(src.lines(), ["sub_family", "brand", "store_id"])
