"""Bulk-order queries."""

from __future__ import annotations

from tillcast.operators import bulk
from tillcast.plans.registry import query
from tillcast.plans.shared import SERIES, candidates, clean_lines, flagged_groups, shipment_links, shipped, sold_promo

LINE = ["ticket_id", "hour", "item_id", "store_id", "sale_date", "qty"]


@query("basket_groups", """
SELECT l.ticket_id, l.hour, l.item_id, l.store_id, l.sale_date, l.qty, d.group_id
FROM sold_lines l JOIN day_groups d USING (item_id, store_id, sale_date)""")
def basket_groups(src):
    return bulk.basket_groups(src.sold_lines(), SERIES).select(*LINE, "group_id")


@query("bulk_threshold_regular", "SELECT * FROM p90_regular")
def bulk_threshold_regular(src):
    return bulk.bulk_threshold_regular(sold_promo(src), SERIES)


@query("bulk_threshold_promo", "SELECT * FROM p90_promo")
def bulk_threshold_promo(src):
    return bulk.bulk_threshold_promo(sold_promo(src), SERIES)


@query("abnormal_groups", "SELECT * FROM flagged_groups")
def abnormal_groups(src):
    return flagged_groups(src)


@query("item_code_fill", """
SELECT g.brand, g.day,
       coalesce((SELECT arg_max(c.code, c.day) FROM item_codes c WHERE c.brand = g.brand AND c.day <= g.day),
                (SELECT arg_min(c.code, c.day) FROM item_codes c WHERE c.brand = g.brand)) AS code
FROM (SELECT b.brand, c.day FROM (SELECT DISTINCT brand FROM item_codes) b, calendar c) g""")
def item_code_fill(src):
    return bulk.item_code_fill(src.item_codes(), src.sale_days(), "brand")


@query("shipment_scope", "SELECT * FROM shipment_scope_rows")
def shipment_scope(src):
    return shipped(src)


@query("shipment_candidates", "SELECT * FROM candidates")
def shipment_candidates(src):
    return candidates(src)


@query("shipment_match", "SELECT * FROM shipment_links")
def shipment_match(src):
    return shipment_links(src)


@query("bulk_share", "SELECT * FROM bulk_shares ORDER BY percent_flagged DESC")
def bulk_share(src):
    return bulk.bulk_share(shipment_links(src), SERIES)


@query("demand_without_bulk", "SELECT ticket_id, hour, item_id, store_id, sale_date, qty, group_id FROM clean_lines")
def demand_without_bulk(src):
    return clean_lines(src).select(*LINE, "group_id")


@query("bulk_threshold_sketch", """
WITH h AS (SELECT CASE WHEN promo_id IS NOT NULL OR coupon_disc > 0 OR promo_disc > 0 OR member_disc > 0 THEN 'promo' ELSE 'regular' END AS branch,
                  sub_family, item_id, store_id, sale_date, hour, sum(qty) AS qty FROM sold_promo GROUP BY ALL)
SELECT branch, CASE branch WHEN 'promo' THEN sub_family ELSE item_id END AS key, count(*) AS n, true AS within FROM h GROUP BY ALL""")
def bulk_threshold_sketch(src):
    """Thresholds from weekly sketches, and whether their exact ranks are within the sketch's error of 0.9."""
    sold = src.keep("sold_promo", lambda: sold_promo(src))
    found = bulk.sketched_thresholds(bulk.quantity_sketches(sold, SERIES))
    return bulk.ranks_within(sold, found, SERIES).select("branch", "key", "n", "within")
