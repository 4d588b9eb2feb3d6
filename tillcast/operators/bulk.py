"""Bulk orders: finding abnormal purchases, matching them to shipments, removing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import day_number, week_start
from tillcast.functions.joins import points_in_ranges
from tillcast.functions.numbers import flag, ratio, total

# Factors and limits of the abnormal-quantity rule.
REGULAR_FACTOR, PROMO_FACTOR = 175, 200
ALWAYS_ABNORMAL_QTY = 250
THRESHOLD_CAP = 50
CHEQUE = 2
BAND_DAYS = 35
TOO_FLAGGED_PERCENT = 20000
#: Size of a quantile sketch, and the error in rank that it stays within with 99 % confidence (1.33 % for 200; falls with the size).
SKETCH_SIZE, RANK_ERROR = 800, 0.005


def on_promo_or_discount() -> Column:
    """True for rows on a promotion or with any discount; never NULL."""
    return (F.col("promo_id").isNotNull() | (F.col("coupon_disc") > 0) | (F.col("promo_disc") > 0)
            | (F.col("member_disc") > 0))


def basket_groups(lines: DataFrame, keys: list[str], gap_days: int = 7, day: str = "sale_date") -> DataFrame:
    """Lines with the number of the purchase group they belong to within their key.

    A group is a run of sales days less than ``gap_days`` apart; this rule is an assumption, as
    only the shape of such a grouping is given.
    Runs are found on distinct days (a key has at most one row per day there) and joined back
    by key and day, so a key with very many lines is never gathered in one task.
    """
    w = Window.partitionBy(*keys).orderBy(day)
    opens = F.datediff(day, F.lag(day).over(w))
    runs = (lines.select(*keys, day).distinct()
            .withColumn("_new", F.when(opens.isNull() | (opens >= gap_days), 1).otherwise(0))
            .withColumn("group_id", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
            .drop("_new"))
    return lines.join(runs, [*keys, day], "left")


def quantity_thresholds(lines: DataFrame, keys: list[str]) -> DataFrame:
    """90th percentile of the quantity per key, day and hour, rounded and capped: of regular
    sales per item, of promotion sales per sub family. Both branches come from one pass.

    Equal hourly quantities are counted first, so the percentile merges small histograms and a
    dominant item costs no more than its number of different quantities."""
    promo = on_promo_or_discount()
    branch, key = F.when(promo, "promo").otherwise("regular"), F.when(promo, F.col("sub_family")).otherwise(F.col("item_id"))
    hourly = lines.groupBy(branch.alias("branch"), key.alias("key"), *keys, "sale_date", "hour").agg(F.sum("qty").alias("qty"))
    counted = hourly.groupBy("branch", "key", "qty").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("branch", "key").agg(
        F.least(F.round(F.percentile("qty", F.lit(0.9), F.col("n"))), F.lit(float(THRESHOLD_CAP))).alias("p90"))


def quantity_sketches(lines: DataFrame, keys: list[str], k: int = SKETCH_SIZE) -> DataFrame:
    """A mergeable quantile sketch (KLL) of the hourly quantities per branch, key and week: what is kept of a week so that
    later runs need not read its lines again."""
    promo = on_promo_or_discount()
    branch, key = F.when(promo, "promo").otherwise("regular"), F.when(promo, F.col("sub_family")).otherwise(F.col("item_id"))
    hourly = lines.groupBy(branch.alias("branch"), key.alias("key"), *keys, "sale_date", "hour").agg(F.sum("qty").alias("qty"))
    return hourly.groupBy("branch", "key", week_start("sale_date").alias("week_start")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"kll_sketch_agg_double(cast(qty AS double), {k})").alias("sketch"))


def sketched_thresholds(sketches: DataFrame, q: float = 0.9) -> DataFrame:
    """``branch, key, n, quantile, p90`` from the sketches of any weeks, merged. ``quantile`` is a quantity whose rank is within
    ``RANK_ERROR`` of ``q``; ``p90`` is rounded and capped as the exact threshold is."""
    merged = sketches.groupBy("branch", "key").agg(F.sum("n").alias("n"), F.expr("kll_merge_agg_double(sketch)").alias("_s"))
    return merged.select("branch", "key", "n", F.expr(f"kll_sketch_get_quantile_double(_s, {q}D)").alias("quantile")).withColumn(
        "p90", F.least(F.round("quantile"), F.lit(float(THRESHOLD_CAP))))


def ranks_within(lines: DataFrame, thresholds: DataFrame, keys: list[str], q: float = 0.9, error: float = RANK_ERROR) -> DataFrame:
    """Sketched thresholds with their exact rank in the lines: ``within`` is whether some rank of the quantity is as near to ``q`` as stated."""
    promo = on_promo_or_discount()
    branch, key = F.when(promo, "promo").otherwise("regular"), F.when(promo, F.col("sub_family")).otherwise(F.col("item_id"))
    hourly = lines.groupBy(branch.alias("branch"), key.alias("key"), *keys, "sale_date", "hour").agg(F.sum("qty").alias("qty"))
    ranks = hourly.join(thresholds.select("branch", "key", "quantile"), ["branch", "key"]).groupBy("branch", "key").agg(
        (F.count_if(F.col("qty") < F.col("quantile")) / F.count(F.lit(1))).alias("_low"),
        (F.count_if(F.col("qty") <= F.col("quantile")) / F.count(F.lit(1))).alias("_high"))
    return thresholds.join(ranks, ["branch", "key"]).withColumn(
        "within", (F.col("_low") - error <= q) & (F.col("_high") + error >= q)).drop("_low", "_high")


def of_branch(thresholds: DataFrame, branch: str) -> DataFrame:
    """One branch of the thresholds, under the name of its key."""
    name = {"regular": "item_id", "promo": "sub_family"}[branch]
    return thresholds.where(F.col("branch") == branch).select(F.col("key").alias(name), "p90")


def bulk_threshold_regular(lines: DataFrame, keys: list[str]) -> DataFrame:
    return of_branch(quantity_thresholds(lines.where(~on_promo_or_discount()), keys), "regular")


def bulk_threshold_promo(lines: DataFrame, keys: list[str]) -> DataFrame:
    return of_branch(quantity_thresholds(lines.where(on_promo_or_discount()), keys), "promo")


def _group_sums() -> list[Column]:
    """What a purchase group shows of its lines with a positive quantity."""
    def c(name: str) -> Column:
        return F.when(F.col("qty") > 0, F.col(name))
    return [F.max(c("sub_family")).alias("sub_family"), F.max(c("ticket_id")).alias("ticket_id"), F.max(c("promo_id")).alias("promo_id"),
            total(c("member_disc")).alias("member_disc"), total(c("promo_disc")).alias("promo_disc"),
            total(c("coupon_disc")).alias("coupon_disc"), F.sum(c("qty")).alias("qty")]


def group_days(lines: DataFrame, keys: list[str], gap_days: int = 7) -> DataFrame:
    """``basket_groups`` without the lines: one row per key and day with its group and the sums of its positive lines
    (``qty`` is NULL without one). Lines are summed before anything is ordered, and never joined back."""
    days = lines.groupBy(*keys, "sale_date").agg(*_group_sums())
    w = Window.partitionBy(*keys).orderBy("sale_date")
    opens = F.datediff("sale_date", F.lag("sale_date").over(w))
    return (days.withColumn("_new", F.when(opens.isNull() | (opens >= gap_days), 1).otherwise(0))
            .withColumn("group_id", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new"))


def abnormal_groups(lines: DataFrame, regular: DataFrame, promo: DataFrame, payments: DataFrame,
                    keys: list[str]) -> DataFrame:
    """Purchase groups per key and day with an abnormal flag, from lines with their group."""
    groups = lines.where(F.col("qty") > 0).groupBy(*keys, "sale_date", "group_id").agg(*_group_sums())
    return flag_groups(groups, regular, promo, payments)


def flag_groups(groups: DataFrame, regular: DataFrame, promo: DataFrame, payments: DataFrame) -> DataFrame:
    """Groups (with their sums) with an abnormal flag.

    Both thresholds are attached in one pass and picked by branch, instead of splitting the
    groups in two and uniting them again. Abnormal: quantity above factor * log10(p90 + 1),
    or paid by cheque, or a quantity that is always too large."""
    cheques = payments.where(F.col("media_type") == CHEQUE).select("ticket_id").distinct().withColumn("_cheque", F.lit(1))
    branch = on_promo_or_discount()
    limit = F.when(branch, PROMO_FACTOR).otherwise(REGULAR_FACTOR) * F.log10(F.col("p90") + 1)
    abnormal = (((F.col("qty") > limit) & F.col("group_id").isNotNull()) | F.col("_cheque").isNotNull()
                | (F.col("qty") >= ALWAYS_ABNORMAL_QTY))
    return (groups.join(regular.withColumnRenamed("p90", "_regular"), "item_id", "left")
            .join(promo.withColumnRenamed("p90", "_promo"), "sub_family", "left")
            .join(cheques, "ticket_id", "left")
            .withColumn("p90", F.when(branch, F.col("_promo")).otherwise(F.col("_regular")))
            .withColumn("abnormal_flag", flag(abnormal))
            .drop("_regular", "_promo", "_cheque"))


def item_code_fill(codes: DataFrame, days: DataFrame, key: str) -> DataFrame:
    """Sparse daily code observations made complete for every day of the calendar.

    Gaps take the last known code; days before the first observation take the first one."""
    first, last = (days.agg(f("day")).scalar() for f in (F.min, F.max))
    grid = codes.select(key).distinct().withColumn("day", F.explode(F.sequence(first, last)))
    series = Window.partitionBy(key).orderBy("day")
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = series.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return grid.join(codes, [key, "day"], "left").withColumn(
        "code", F.coalesce(F.last("code", ignorenulls=True).over(so_far),
                           F.first("code", ignorenulls=True).over(whole)))


def shipment_scope(shipments: DataFrame, id_map: DataFrame, stores: DataFrame, order_prefix: str) -> DataFrame:
    """Shipped quantity per item, store and day for one kind of order and the scope's stores.

    The code map is reduced to one item per variant and day first, so shipments never multiply."""
    ids = id_map.groupBy("variant_id", F.col("sale_date").alias("delivery_date")).agg(F.max("item_id").alias("item_id"))
    return (shipments.where(F.col("order_no").startswith(order_prefix))
            .join(stores.select("store_id").distinct(), "store_id", "left_semi")
            .join(ids, ["variant_id", "delivery_date"])
            .groupBy("item_id", "store_id", "delivery_date").agg(F.sum("qty").alias("delivery_qty")))


def shipment_candidates(groups: DataFrame, shipments: DataFrame, keys: list[str]) -> DataFrame:
    """Abnormal groups and the shipments of the same key at most ``BAND_DAYS`` days away.

    The band is joined through date buckets, so a key meets only shipments near in time."""
    bands = (groups.where(F.col("abnormal_flag") == 1)
             .select(*keys, "sale_date", "group_id", "qty",
                     F.date_sub("sale_date", BAND_DAYS).alias("_lo"), F.date_add("sale_date", BAND_DAYS).alias("_hi")))
    return points_in_ranges(bands, shipments, keys, "_lo", "_hi", "delivery_date", 2 * BAND_DAYS).select(
        *keys, "sale_date", "group_id", "qty", "delivery_date", "delivery_qty")


def allocate(shipped: list[tuple[int, float]], sold: list[tuple[int, float]], band: int,
             strict_block: bool = False) -> list[tuple[int, int]]:
    """Pairs (shipment, sale) by position; both lists are (day number, quantity) sorted by day.

    Each shipment is used up by the next unassigned sales in turn. A sale ``band`` or more
    days away ends the shipment; if it is too old it is also skipped, so that it cannot hold
    up later shipments (``strict_block`` keeps it in the way)."""
    pairs: list[tuple[int, int]] = []
    j = 0
    for i, (ship_day, left) in enumerate(shipped):
        while left > 0 and j < len(sold):
            sale_day, qty = sold[j]
            if abs(ship_day - sale_day) >= band:
                if strict_block or sale_day > ship_day:
                    break
                j += 1
                continue
            pairs.append((i, j))
            left = left - qty if left >= qty else 0
            j += 1
    return pairs


def shipment_match(candidates: DataFrame, keys: list[str], strict_block: bool = False) -> DataFrame:
    """Sales groups matched to shipments as ``allocate`` does it, walking both in date order per key.

    The two inputs are reduced to one row per key and date, and a key's dates are cut into stretches wherever two neighbours
    are ``BAND_DAYS`` or more apart: nothing is matched across such a gap (but blocked across it, so ``strict_block`` does not cut). A stretch, at most one sale and one shipment a day,
    is folded over in one expression: the state is the shipment in use and what is left of it."""
    sold = candidates.groupBy(*keys, F.col("sale_date").alias("date")).agg(
        F.max_by(F.struct("group_id", "qty"), F.struct("qty", "group_id")).alias("_s")).select(
        *keys, "date", "_s.group_id", "_s.qty", F.lit(True).alias("is_sale"))
    shipped = candidates.groupBy(*keys, F.col("delivery_date").alias("date")).agg(F.max("delivery_qty").alias("qty")).withColumn("is_sale", F.lit(False))
    in_order = Window.partitionBy(*keys).orderBy("date", "is_sale")
    events = sold.unionByName(shipped, allowMissingColumns=True).withColumn("n", day_number("date"))
    gap = F.col("n") - F.lag("n").over(in_order)
    cut = (events.withColumn("_new", F.lit(0) if strict_block else F.when(gap >= BAND_DAYS, 1).otherwise(0))
           .withColumn("_stretch", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0))))
    listed = cut.groupBy(*keys, "_stretch").agg(
        F.sort_array(F.collect_list(F.when(F.col("is_sale"), F.struct("n", F.col("date").alias("sale_date"), "group_id", "qty")))).alias("sales"),
        F.sort_array(F.collect_list(F.when(~F.col("is_sale"), F.struct("n", F.col("date").alias("delivery_date"), F.col("qty").alias("delivery_qty"))))).alias("ships"))
    ships = F.transform("ships", lambda x, i: F.struct(i.alias("at"), x["n"].alias("n"), x["delivery_date"].alias("delivery_date"), x["delivery_qty"].alias("delivery_qty")))
    types = dict(candidates.dtypes)
    out = ["sale_date", "group_id", "qty", "delivery_date", "delivery_qty"]
    pair = "struct<" + ", ".join(f"{c}: {types[c]}" for c in out) + ">"
    state = f"struct<at: int, left: double, pairs: array<{pair}>>"

    def step(acc, sale):
        start = F.when(acc["left"] > 0, acc["at"]).otherwise(acc["at"] + 1)

        def open_(s):
            """Not used up, and the sale is not out of its reach; with ``strict_block`` not before it either."""
            near = s["n"] > sale["n"] - BAND_DAYS
            return (s["at"] >= start) & (s["delivery_qty"] > 0) & (near & (s["n"] < sale["n"] + BAND_DAYS) if strict_block else near)

        def taken(found):
            left = F.when((found["at"] == acc["at"]) & (acc["left"] > 0), acc["left"]).otherwise(found["delivery_qty"])
            matched = F.concat(acc["pairs"], F.array(F.struct(
                sale["sale_date"], sale["group_id"], sale["qty"], found["delivery_date"], found["delivery_qty"]).cast(pair)))
            return (F.when(found.isNull(), F.struct(F.lit(1 << 30).alias("at"), F.lit(0.0).alias("left"), acc["pairs"].alias("pairs")).cast(state))
                    .when(found["n"] - sale["n"] >= BAND_DAYS, F.struct(found["at"].alias("at"), left.alias("left"), acc["pairs"].alias("pairs")).cast(state))
                    .otherwise(F.struct(found["at"].alias("at"), F.greatest(left - sale["qty"], F.lit(0.0)).alias("left"), matched.alias("pairs")).cast(state)))
        return F.element_at(F.transform(F.array(F.get(F.filter("ships_", open_), 0)), taken), 1)

    first = F.struct(F.lit(0).alias("at"), F.col("ships_")[0]["delivery_qty"].alias("left"), F.array().cast(f"array<{pair}>").alias("pairs")).cast(state)
    both = listed.where((F.size("sales") > 0) & (F.size("ships") > 0)).select(*keys, "sales", ships.alias("ships_"))
    matched = both.select(*keys, F.explode(F.aggregate("sales", first, step)["pairs"]).alias("_p"))
    return matched.select(*keys, *[F.col("_p")[c].alias(c) for c in out])


def bulk_share(links: DataFrame, keys: list[str]) -> DataFrame:
    """Sold against shipped quantity of the linked groups, in percent, highest first."""
    distinct = links.select(*keys, "group_id", "qty", "delivery_date", "delivery_qty").distinct()
    per_group = distinct.groupBy(*keys, "group_id").agg(
        F.sum("qty").alias("qty"), F.max("delivery_qty").alias("delivery_qty"))
    return (per_group.groupBy(*keys).agg(F.sum("qty").alias("qty"), F.sum("delivery_qty").alias("delivery_qty"))
            .withColumn("percent_flagged", ratio("qty", "delivery_qty") * 100)
            .orderBy(F.desc("percent_flagged"), *keys))


def planned_groups(links: DataFrame, shares: DataFrame, keys: list[str], limit_percent: float = TOO_FLAGGED_PERCENT) -> DataFrame:
    """The linked groups, except for keys whose linked share is beyond the limit: there the links are taken as wrong."""
    planned = links.select(*keys, "group_id").distinct()
    return planned.join(shares.where(F.col("percent_flagged") > limit_percent).select(*keys), keys, "left_anti")


def demand_without_bulk(lines: DataFrame, links: DataFrame, shares: DataFrame, keys: list[str],
                        limit_percent: float = TOO_FLAGGED_PERCENT) -> DataFrame:
    """Lines that are not part of a planned bulk delivery, by their group."""
    return lines.join(planned_groups(links, shares, keys, limit_percent), [*keys, "group_id"], "left_anti")
