"""Intermediate results several queries start from. Lazy: nothing runs here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.operators import bulk, promo_join, sales
from tillcast.sources.retail import RetailInputs

# Dense daily series, the places promotions are planned for, and sparse weekly series.
DENSE = ["sub_family", "store_id"]
PLACE = ["sub_family", "city_id"]
SERIES = ["item_id", "store_id"]


# ---- bulk orders: from sold lines to the links with shipments; all of it reads one kept copy of the lines

def sold_promo(src: RetailInputs) -> DataFrame:
    return promo_join.current_promo(src.keep_lines().sold_lines(), src.kept_plan(), PLACE, [])


def group_days(src: RetailInputs) -> DataFrame:
    return src.keep("group_days", lambda: bulk.group_days(sold_promo(src), SERIES))


def flagged_groups(src: RetailInputs) -> DataFrame:
    limits = src.keep("limits", lambda: bulk.quantity_thresholds(sold_promo(src), SERIES))
    return bulk.flag_groups(group_days(src).where("qty is not null"), bulk.of_branch(limits, "regular"),
                            bulk.of_branch(limits, "promo"), src.payments())


def shipped(src: RetailInputs) -> DataFrame:
    large = src.stores().where(F.col("balance") >= 0)
    return bulk.shipment_scope(src.keep_lines().shipments(), src.lines(), large, "O")


def candidates(src: RetailInputs) -> DataFrame:
    return src.keep("candidates", lambda: bulk.shipment_candidates(flagged_groups(src), shipped(src), SERIES))


def shipment_links(src: RetailInputs) -> DataFrame:
    return src.keep("links", lambda: bulk.shipment_match(candidates(src), SERIES))


def planned_days(src: RetailInputs) -> DataFrame:
    """The days of an item and store whose lines are planned bulk."""
    links = shipment_links(src)
    planned = bulk.planned_groups(links, bulk.bulk_share(links, SERIES), SERIES)
    return src.keep("planned_days", lambda: group_days(src).join(planned, [*SERIES, "group_id"], "left_semi").select(*SERIES, "sale_date"))


def clean_lines(src: RetailInputs) -> DataFrame:
    """Sold lines without planned bulk, with their purchase group."""
    links = shipment_links(src)
    grouped = src.sold_lines().join(group_days(src).select(*SERIES, "sale_date", "group_id"), [*SERIES, "sale_date"], "left")
    return bulk.demand_without_bulk(grouped, links, bulk.bulk_share(links, SERIES), SERIES)


# ---- dense daily demand

def dense_events(src: RetailInputs) -> DataFrame:
    """The events of the dense daily series (``operators.sales.dense_events``): sales without planned bulk, carried days (a
    variant with a discounted line is in the assortment that day), days out of stock."""
    def make():
        planned = planned_days(src).withColumn("_planned", F.lit(1))
        lines = src.lines().join(planned, [*SERIES, "sale_date"], "left")
        sold = (F.col("return_flag") != "R") & F.col("_planned").isNull()
        facts = src.keep("day_facts", lambda: sales.day_facts(lines, [*DENSE, "city_id"], sold, F.col("disc_pct") > 0))
        return sales.dense_events(facts, src.empty_days(sales.series_spans(facts, [*DENSE, "city_id"])), DENSE, ["city_id"])
    events = src.keep("events", make)
    src.forget("day_facts")
    return events


def dense_demand(src: RetailInputs) -> DataFrame:
    return sales.dense_days(dense_events(src), DENSE, ["city_id"])


def place_days(src: RetailInputs) -> DataFrame:
    first = src.sale_days().agg(F.min("day")).first()[0]
    return src.keep("place_days", lambda: promo_join.place_days(src.kept_plan(), PLACE, first))


def dense_promo(src: RetailInputs, of: Column | None = None) -> DataFrame:
    """The daily rows. They are laid out from the kept events and kept plan days wherever they are used, without an exchange.
    ``of`` is a condition on ``week_start`` if only some weeks are wanted."""
    return promo_join.daily_promo_by_place(sales.dense_days(dense_events(src), DENSE, ["city_id"], of), place_days(src), PLACE)


def dense_pieces(src: RetailInputs) -> DataFrame:
    """The same days, a row per event and week."""
    return sales.dense_pieces(dense_events(src), DENSE, ["city_id"])


def dense_weeks(src: RetailInputs) -> DataFrame:
    weeks = sales.calendar_weeks(src.calendar()).join(sales.holiday_weeks(src.calendar()), "week_start")
    days = place_days(src)
    by_week = src.keep("place_weeks", lambda: sales.place_weeks(days, PLACE))
    return sales.weekly_sales(dense_pieces(src), weeks, src.kept_plan(), DENSE, PLACE, days, by_week)


def dense_weeks_kept(src: RetailInputs) -> DataFrame:
    """The weekly rows for queries that use them several times."""
    return src.keep("dense_weeks", lambda: dense_weeks(src))


def weekly(src: RetailInputs) -> DataFrame:
    return sales.weekly_totals(src.lines())


def weekly_kept(src: RetailInputs) -> DataFrame:
    """The weekly rows for queries that use them several times."""
    return src.keep("weekly", lambda: weekly(src))


def holidays(src: RetailInputs) -> DataFrame:
    return src.calendar().where("holiday = 1").select(F.col("day").alias("sale_date"), "holiday")
