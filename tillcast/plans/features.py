"""Weekly feature queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillcast.operators import features, increment, sales
from tillcast.plans.registry import query
from tillcast.plans.shared import DENSE, SERIES, dense_weeks, weekly, weekly_kept

WEEK = ["item_id", "store_id", "week_start", "qty"]


def _trailing(level: str, table: str, keys: str) -> str:
    """Trailing means by row position and self join."""
    parts = ", ".join(f"avg(b.q) FILTER (a.rn - b.rn <= {n}) AS {level}_mean_{n}" for n in (4, 12, 24, 52))
    on = " AND ".join(f"b.{k} = a.{k}" for k in keys.split(", "))
    return f"""SELECT {", ".join("a." + k for k in keys.split(", "))}, a.week_start, {parts},
       min(b.q) AS {level}_min, max(b.q) AS {level}_max
FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY week_start) AS rn FROM {table}) a
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY week_start) AS rn FROM {table}) b
  ON {on} AND b.rn < a.rn
GROUP BY ALL"""


def _level(keys: str) -> str:
    return f"(SELECT {keys}, week_start, sum(qty) AS q FROM weekly GROUP BY ALL)"


ROLLING_SQL = f"""
WITH fam AS ({_trailing("family", _level("family, store_id"), "family, store_id")}),
     sub AS ({_trailing("sub_family", _level("sub_family, store_id"), "sub_family, store_id")}),
     itm AS ({_trailing("item", _level("item_id, store_id"), "item_id, store_id")})
SELECT w.item_id, w.store_id, w.week_start, w.qty,
       f.* EXCLUDE (family, store_id, week_start),
       s.* EXCLUDE (sub_family, store_id, week_start, sub_family_min, sub_family_max),
       i.* EXCLUDE (item_id, store_id, week_start, item_min, item_max)
FROM weekly w
JOIN fam f ON f.family = w.family AND f.store_id = w.store_id AND f.week_start = w.week_start
JOIN sub s ON s.sub_family = w.sub_family AND s.store_id = w.store_id AND s.week_start = w.week_start
JOIN itm i ON i.item_id = w.item_id AND i.store_id = w.store_id AND i.week_start = w.week_start"""


@query("rolling_means", ROLLING_SQL)
def rolling_means(src):
    out = features.rolling_means(weekly_kept(src), SERIES, ["sub_family", "store_id"], ["family", "store_id"])
    return out.drop("sub_family", "family", "city_id", "gross", "coupon_disc", "promo_disc", "member_disc", "year")


def _cum(keys: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {keys}, year, week_start, sum(q) OVER (PARTITION BY {keys}, year ORDER BY week_start
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS c
  FROM (SELECT {keys}, year, week_start, sum(qty) AS q FROM weekly GROUP BY ALL) x)"""


SHARE_SQL = f"""
WITH {_cum("item_id, store_id", "a")}, {_cum("family, store_id", "b")}, {_cum("item_id", "c")}, {_cum("family", "d")}
SELECT w.item_id, w.store_id, w.week_start, w.qty, a.c / nullif(b.c, 0) AS share_in_store,
       c.c / nullif(d.c, 0) AS share_national
FROM weekly w
JOIN a ON a.item_id = w.item_id AND a.store_id = w.store_id AND a.week_start = w.week_start
JOIN b ON b.family = w.family AND b.store_id = w.store_id AND b.week_start = w.week_start
JOIN c ON c.item_id = w.item_id AND c.week_start = w.week_start
JOIN d ON d.family = w.family AND d.week_start = w.week_start"""


@query("share_to_date", SHARE_SQL)
def share_to_date(src):
    return features.share_to_date(weekly_kept(src), "item_id", "family", "store_id").select(
        *WEEK, "share_in_store", "share_national")


DISCOUNT_SQL = """
SELECT a.item_id, a.store_id, a.week_start, a.qty,
       CAST(sum(CASE WHEN b.coupon_disc > 0 OR b.promo_disc > 0 OR b.member_disc > 0 THEN 1 ELSE 0 END) AS DOUBLE)
         / nullif(sum(CASE WHEN b.qty > 0 THEN 1 ELSE 0 END), 0) AS discount_ratio
FROM weekly a LEFT JOIN weekly b ON b.item_id = a.item_id AND b.store_id = a.store_id AND b.week_start < a.week_start
GROUP BY ALL"""


@query("discount_ratio", DISCOUNT_SQL)
def discount_ratio(src):
    return features.discount_ratio(weekly(src), SERIES).select(*WEEK, "discount_ratio")


@query("promo_price_features", """
SELECT sub_family, store_id, week_start, promo_price / nullif(list_price, 0) AS price_ratio,
       CAST(promo_end - promo_start AS INTEGER) AS promo_days, CAST(dayofweek(promo_start) + 1 AS INTEGER) AS start_dow,
       CAST(dayofweek(promo_end) + 1 AS INTEGER) AS end_dow,
       CAST((week_start - CAST(date_trunc('week', promo_start) AS DATE)) // 7 AS INTEGER) AS weeks_since_start,
       CAST((CAST(date_trunc('week', promo_end) AS DATE) - week_start) // 7 AS INTEGER) AS weeks_to_end,
       CASE WHEN date_trunc('week', next_announced) <= week_start
            THEN CAST((CAST(date_trunc('week', next_promo_start) AS DATE) - week_start) // 7 AS INTEGER) END AS weeks_to_next,
       CAST(next_promo_end - next_promo_start AS INTEGER) AS next_promo_days
FROM dense_weeks""")
def promo_price_features(src):
    return features.promo_price_features(dense_weeks(src)).select(
        "sub_family", "store_id", "week_start", "price_ratio", "promo_days", "start_dow", "end_dow",
        "weeks_since_start", "weeks_to_end", "weeks_to_next", "next_promo_days")


@query("climate_join", """
SELECT w.item_id, w.store_id, w.week_start, w.qty, w.city_id, strftime(w.week_start, '%m') AS month,
       TRY_CAST(c.high AS DOUBLE) AS high, TRY_CAST(c.low AS DOUBLE) AS low
FROM weekly w LEFT JOIN climate c ON c.city_id = w.city_id AND c.month = strftime(w.week_start, '%m')""")
def climate_join(src):
    return features.climate_join(weekly(src), src.climate()).select(*WEEK, "city_id", "month", "high", "low")


@query("competitor_flag", """
SELECT item_id, store_id, week_start, qty, city_id,
       CASE WHEN (city_id, item_id) IN (SELECT city_id, item_id FROM competitor WHERE created >= DATE '1997-01-01')
            THEN 1 ELSE 0 END AS competitor
FROM weekly""")
def competitor_flag(src):
    return features.competitor_flag(weekly(src), src.competitor(), "1997-01-01").select(*WEEK, "city_id", "competitor")


@query("next_promo_week_sales", """
SELECT a.sub_family, a.store_id, a.week_start, a.qty, a.next_promo_start, b.qty AS next_promo_qty_w1,
       c.qty AS next_promo_qty_w2
FROM dense_weeks a
LEFT JOIN dense_weeks b ON b.sub_family = a.sub_family AND b.store_id = a.store_id
                       AND b.week_start = date_trunc('week', a.next_promo_start)
LEFT JOIN dense_weeks c ON c.sub_family = a.sub_family AND c.store_id = a.store_id
                       AND c.week_start = date_trunc('week', a.next_promo_start + 7)""")
def next_promo_week_sales(src):
    weeks = src.keep("weeks", lambda: dense_weeks(src).select(*DENSE, "week_start", "qty", "next_promo_start"))
    return features.next_promo_week_sales(weeks, DENSE)


@query("barcode_pick", """
SELECT item_id, created, barcode
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY created, barcode) AS rn
      FROM barcodes WHERE main = 'Y' AND ended IS NULL) x
WHERE rn = 1""")
def barcode_pick(src):
    return features.barcode_pick(src.barcodes(), ["item_id"])


TICKETS_SQL = """
SELECT l.item_id, l.store_id, c.festival, c.year, count(l.ticket_id) AS tickets
FROM lines l JOIN calendar c ON c.day = l.sale_date AND c.festival IS NOT NULL GROUP BY ALL"""


def _tickets(src):
    return features.festival_tickets(src.lines(), src.calendar(), SERIES)


@query("festival_tickets", TICKETS_SQL)
def festival_tickets(src):
    return _tickets(src)


@query("festival_last_year", f"""
WITH t AS ({TICKETS_SQL})
SELECT a.*, b.tickets AS tickets_last_year
FROM t a LEFT JOIN t b ON b.item_id = a.item_id AND b.store_id = a.store_id AND b.festival = a.festival
                      AND b.year = a.year - 1""")
def festival_last_year(src):
    return features.festival_last_year(_tickets(src), SERIES)


@query("weekly_final", f"""
WITH t AS ({TICKETS_SQL}),
     f AS (SELECT week_start, max(festival) AS festival FROM calendar GROUP BY ALL),
     o AS (SELECT sub_family, store_id, CAST(date_trunc('week', sale_date) AS DATE) AS week_start,
                  max(CASE WHEN balance <= 0 THEN 1 ELSE 0 END) AS any_oos FROM stock GROUP BY ALL),
     b AS (SELECT item_id, arg_min(barcode, (created, barcode)) AS barcode FROM barcodes
           WHERE main = 'Y' AND ended IS NULL GROUP BY ALL),
     x AS (SELECT item_id, min(item_name) AS item_text FROM items GROUP BY ALL)
SELECT w.item_id, w.store_id, w.week_start, w.qty, x.item_text, b.barcode, coalesce(o.any_oos, 0) AS any_oos,
       f.festival, t.tickets AS tickets_last_year
FROM weekly w LEFT JOIN x ON x.item_id = w.item_id LEFT JOIN b ON b.item_id = w.item_id
LEFT JOIN o ON o.sub_family = w.sub_family AND o.store_id = w.store_id AND o.week_start = w.week_start
LEFT JOIN f ON f.week_start = w.week_start
LEFT JOIN t ON t.item_id = w.item_id AND t.store_id = w.store_id AND t.festival = f.festival AND t.year = w.year - 1""")
def weekly_final(src):
    src.keep_lines()
    texts = src.items().groupBy("item_id").agg(F.min("item_name").alias("item_text"))
    return features.weekly_final(
        weekly(src), texts, features.barcode_pick(src.barcodes(), ["item_id"]),
        sales.oos_week(src.stock(), DENSE), DENSE, src.calendar(), _tickets(src), SERIES).select(
        *WEEK, "item_text", "barcode", "any_oos", "festival", "tickets_last_year")


def _per_item_sql() -> str:
    means = ", ".join(
        f"CAST(sum(CAST({n}_per_item AS DECIMAL(24,8))) OVER w{k} AS DOUBLE) / nullif(count({n}_per_item) OVER w{k}, 0)"
        f" AS {n}_per_item_{k}" for n in ("family", "sub_family") for k in (4, 12, 24, 52))
    frames = ", ".join(f"w{k} AS (PARTITION BY item_id, store_id ORDER BY week_start ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
                       for k in (4, 12, 24, 52))
    return f"""
WITH r AS (SELECT item_id, store_id, week_start, qty,
                  sum(qty) OVER (PARTITION BY family, store_id, week_start)
                    / count(*) OVER (PARTITION BY family, store_id, week_start) AS family_per_item,
                  sum(qty) OVER (PARTITION BY sub_family, store_id, week_start)
                    / count(*) OVER (PARTITION BY sub_family, store_id, week_start) AS sub_family_per_item
           FROM weekly)
SELECT *, {means} FROM r WINDOW {frames}"""


@query("family_item_ratio", _per_item_sql())
def family_item_ratio(src):
    out = features.family_item_ratio(weekly_kept(src), SERIES, {"family": ["family", "store_id"],
                                                           "sub_family": ["sub_family", "store_id"]})
    return out.drop("sub_family", "family", "city_id", "gross", "coupon_disc", "promo_disc", "member_disc", "year")


LAST_YEAR_SQL = """
WITH k AS (SELECT *, date_trunc('week', week_start - 364) AS exact, date_trunc('week', week_start - 395) AS early,
                  date_trunc('week', week_start - 333) AS late FROM weekly),
     b AS (SELECT a.item_id, a.store_id, a.week_start, arg_max(p.qty, p.week_start) AS qty
           FROM k a JOIN weekly p ON p.item_id = a.item_id AND p.store_id = a.store_id
            AND p.week_start BETWEEN a.early AND a.exact GROUP BY ALL),
     f AS (SELECT a.item_id, a.store_id, a.week_start, arg_min(p.qty, p.week_start) AS qty
           FROM k a JOIN weekly p ON p.item_id = a.item_id AND p.store_id = a.store_id
            AND p.week_start BETWEEN a.exact AND a.late GROUP BY ALL)
SELECT w.item_id, w.store_id, w.week_start, w.qty, coalesce(b.qty, f.qty) AS last_year_qty
FROM weekly w
LEFT JOIN b ON b.item_id = w.item_id AND b.store_id = w.store_id AND b.week_start = w.week_start
LEFT JOIN f ON f.item_id = w.item_id AND f.store_id = w.store_id AND f.week_start = w.week_start"""


@query("last_year_sales", LAST_YEAR_SQL)
def last_year_sales(src):
    return features.last_year_sales(weekly(src), SERIES).select(*WEEK, "last_year_qty")


@query("weekly_features", f"""
WITH ly AS ({LAST_YEAR_SQL.strip()}),
     o AS (SELECT sub_family, store_id, CAST(date_trunc('week', sale_date) AS DATE) AS week_start,
                  max(CASE WHEN balance <= 0 THEN 1 ELSE 0 END) AS any_oos FROM stock GROUP BY ALL)
SELECT w.item_id, w.store_id, w.week_start, w.qty, w.sub_family, w.city_id, w.gross, ly.last_year_qty,
       coalesce(o.any_oos, 0) AS any_oos
FROM weekly w
JOIN ly ON ly.item_id = w.item_id AND ly.store_id = w.store_id AND ly.week_start = w.week_start
LEFT JOIN o ON o.sub_family = w.sub_family AND o.store_id = w.store_id AND o.week_start = w.week_start""")
def weekly_features(src):
    with_last_year = features.last_year_sales(weekly(src), SERIES)
    return features.weekly_features(with_last_year, sales.oos_week(src.stock(), DENSE), DENSE).select(
        *WEEK, "sub_family", "city_id", "gross", "last_year_qty", "any_oos")


def _carried_sql() -> str:
    """The last two weeks out of a run over all of them."""
    parts = {"a": ROLLING_SQL, "b": SHARE_SQL, "c": DISCOUNT_SQL, "d": _per_item_sql(), "e": LAST_YEAR_SQL}
    joins = "\n".join(f"JOIN ({sql.strip()}) {n} ON {n}.item_id = a.item_id AND {n}.store_id = a.store_id AND {n}.week_start = a.week_start"
                      for n, sql in parts.items() if n != "a")
    rest = ", ".join(f"{n}.* EXCLUDE (item_id, store_id, week_start, qty)" for n in parts if n != "a")
    return f"""
SELECT a.*, {rest} FROM ({ROLLING_SQL.strip()}) a
{joins}
WHERE a.week_start >= (SELECT max(week_start) - 7 FROM weekly)"""


@query("carried_weeks", _carried_sql())
def carried_weeks(src):
    """The last two weeks' features, each from the state of the weeks before it."""
    last = weekly_kept(src).agg(F.max("week_start")).first()[0]
    out = increment.carried_weeks(weekly_kept(src), F.lit(last - dt.timedelta(7)))
    return out.drop("sub_family", "family", "city_id", "gross", "coupon_disc", "promo_disc", "member_disc", "year")
