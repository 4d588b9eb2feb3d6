"""Scope and master-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions.dates import week_start
from tillcast.operators import scope
from tillcast.plans.registry import query

RUN_DATE = "2001-10-20"
SCOPE_RULES = {"Brand#1": ["S", "M"], "Brand#2": ["E"], "Brand#3": ["L", "P", "S"]}
DEPARTMENTS = ["S", "M", "E"]


def _stores(src):
    return src.stores().select("store_id", "city_id", "territory",
                               F.when(F.col("balance") < 0, "express").otherwise("large").alias("format"))


def _closures(src):
    """A store counts as closed from the day after its last sale."""
    last = src.raw_lines().groupBy("store_id").agg(F.max("sale_date").alias("last"))
    return last.select("store_id", F.date_add("last", 1).alias("start"), F.lit("9999-12-31").cast("date").alias("end"))


def _open(src):
    return scope.open_stores(_stores(src), _closures(src), RUN_DATE, [0, 1, 2, 3], "express")


OPEN_SQL = """
SELECT s.store_id, s.city_id, s.territory, CASE WHEN s.balance < 0 THEN 'express' ELSE 'large' END AS format
FROM stores s
WHERE s.territory IN (0, 1, 2, 3) AND s.balance >= 0
  AND s.store_id NOT IN (SELECT store_id FROM raw_lines GROUP BY store_id
                         HAVING max(sale_date) + 1 < DATE '2001-10-20')"""

ITEMS_SQL = f"""
SELECT DISTINCT item_id, brand FROM lines
WHERE store_id IN (SELECT store_id FROM ({OPEN_SQL}) o)
  AND sale_date >= DATE '1996-01-01' AND sale_date < DATE '2001-07-01'
  AND brand = 'Brand#1' AND family IN ('S', 'M')
UNION SELECT DISTINCT item_id, brand FROM lines
WHERE store_id IN (SELECT store_id FROM ({OPEN_SQL}) o)
  AND sale_date >= DATE '1996-01-01' AND sale_date < DATE '2001-07-01'
  AND brand = 'Brand#2' AND family IN ('E')
UNION SELECT DISTINCT item_id, brand FROM lines
WHERE store_id IN (SELECT store_id FROM ({OPEN_SQL}) o)
  AND sale_date >= DATE '1996-01-01' AND sale_date < DATE '2001-07-01'
  AND brand = 'Brand#3' AND family IN ('L', 'P', 'S')"""


@query("scope_stores", OPEN_SQL)
def scope_stores(src):
    return _open(src)


@query("scope_items", ITEMS_SQL)
def scope_items(src):
    return scope.scope_items(src.lines(), SCOPE_RULES, "1996-01-01", "2001-07-01", _open(src))


def _item_codes(src):
    return src.items().select("variant_id", "item_id", "family", "item_name",
                              F.concat(F.lpad(F.col("pack").cast("string"), 2, "0"),
                                       F.substr("brand", F.lit(7))).alias("item_code"))


def _texts(src):
    """Descriptions by code level: the alphabetically first item name under the code."""
    levels = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("level")
    return (_item_codes(src).select("family", "item_code", "item_name", levels)
            .withColumn("code", F.expr("concat(family, substr(item_code, 1, level))"))
            .groupBy("level", "code").agg(F.min("item_name").alias("text")))


@query("item_hierarchy", """
WITH coded AS (SELECT variant_id, item_id, family, item_name,
                      lpad(CAST(pack AS VARCHAR), 2, '0') || substr(brand, 7) AS item_code FROM items),
     texts AS (SELECT l.level, family || substr(item_code, 1, l.level) AS code, min(item_name) AS text
               FROM coded, (VALUES (1), (2), (3)) l(level) GROUP BY ALL)
SELECT c.*, family || substr(item_code, 1, 1) AS group_family_code, a.text AS group_family_text,
       family || substr(item_code, 1, 2) AS family_level_code, b.text AS family_level_text,
       family || substr(item_code, 1, 3) AS sub_family_level_code, d.text AS sub_family_level_text
FROM coded c
LEFT JOIN texts a ON a.level = 1 AND a.code = family || substr(item_code, 1, 1)
LEFT JOIN texts b ON b.level = 2 AND b.code = family || substr(item_code, 1, 2)
LEFT JOIN texts d ON d.level = 3 AND d.code = family || substr(item_code, 1, 3)""")
def item_hierarchy(src):
    return scope.item_hierarchy(_item_codes(src), _texts(src))


@query("latest_status", f"""
SELECT * FROM stock
WHERE sale_date = DATE '2001-06-30'
  AND sub_family IN (SELECT split_part(item_id, '|', 1) FROM ({ITEMS_SQL}) i)
  AND store_id IN (SELECT store_id FROM ({OPEN_SQL}) o)""")
def latest_status(src):
    items = scope.scope_items(src.lines(), SCOPE_RULES, "1996-01-01", "2001-07-01", _open(src))
    families = items.select(F.split_part("item_id", F.lit("|"), F.lit(1)).alias("sub_family"))
    return scope.latest_status(src.stock(), "2001-06-30", families, _open(src).select("store_id"),
                               "sub_family", "store_id").select(
        "sub_family", "store_id", "city_id", "sale_date", "balance", "stopped")


@query("promo_plan", """
SELECT h.promo_id, h.start, h."end", h.year, h.status, l.sub_family, l.city_id, l.promo_start, l.promo_end,
       l.list_price, l.promo_price, l.slot
FROM promo_headers h LEFT JOIN promo_lines l ON l.promo_id = h.promo_id AND l.version = 50
WHERE h.year >= 1996 AND h.status <> '-1'""")
def promo_plan(src):
    return scope.promo_plan(src.promo_headers(), src.promo_lines(), 1996, 50).select(
        "promo_id", "start", "end", "year", "status", "sub_family", "city_id", "promo_start", "promo_end",
        "list_price", "promo_price", "slot")


@query("item_start", "SELECT variant_id, store_id, min(sale_date) AS start_date FROM raw_lines GROUP BY ALL")
def item_start(src):
    return scope.item_start(src.assortment_days())


@query("assortment", """
WITH ids AS (SELECT DISTINCT variant_id, sale_date, item_id, family FROM lines WHERE family IN ('S', 'M', 'E'))
SELECT a.variant_id, a.sale_date, a.store_id, a.unit_count, a.stopped, a.list_price,
       i.item_id, i.family
FROM assortment_days a JOIN ids i ON i.variant_id = a.variant_id AND i.sale_date = a.sale_date""")
def assortment(src):
    return scope.assortment(src.assortment_days(), src.lines(), DEPARTMENTS)


@query("active_flag", """
SELECT w.sub_family, w.store_id, w.week_start, w.qty, s.active
FROM (SELECT sub_family, store_id, CAST(date_trunc('week', sale_date) AS DATE) AS week_start, sum(qty) AS qty
      FROM lines GROUP BY ALL) w
LEFT JOIN (SELECT sub_family, store_id, max(CASE WHEN stopped = 'Y' THEN 0 ELSE 1 END) AS active
           FROM stock WHERE sale_date = DATE '2001-06-30' GROUP BY ALL) s
  ON s.sub_family = w.sub_family AND s.store_id = w.store_id""")
def active_flag(src):
    weeks = src.lines().groupBy("sub_family", "store_id", week_start("sale_date").alias("week_start")).agg(
        F.sum("qty").alias("qty"))
    status = src.stock().where(F.col("sale_date") == F.lit("2001-06-30").cast("date")).withColumn(
        "stop_reason", F.when(F.col("stopped") == "Y", "stopped"))
    return scope.active_flag(weeks, status, ["sub_family", "store_id"])
