"""Retail inputs read off the order/line star schema of the test data.

This is the only module that knows those table names. The mapping is an assumption of this
repository: it gives every operator realistic inputs (sales lines, promotion plan, stock
snapshots, shipments, coupons ...) whose size follows the given tables. No row is dropped
by an id rule; where an input is a subset of the lines, the rule is a business one (returned
lines are shipments, undiscounted lines carry an item code, and so on).

item_id      brand within a product type          sub_family   product type
variant_id   part                                 family       first letter of the type
store_id     supplier                             city_id      nation of the supplier
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.dates import day_number, month_start, week_key, week_start
from tillcast.functions.lineage import discard, drop_shuffles, materialise
from tillcast.functions.numbers import money, total
from tillcast.functions.runs import event_runs, lay_out
from tillcast.functions.texts import COUNT_CODES, padded
from tillcast.sources.tables import load

# Public holidays (month-day), festivals (type, first and last month-day).
HOLIDAYS = ["01-01", "05-01", "10-01"]
FESTIVALS = [(1, "02-05", "02-11"), (2, "09-15", "09-17")]
# Days by which a lunar year is shorter than the calendar mapping assumes.
LUNAR_YEAR_DAYS = 354
LIVE_VERSION = 50
STOCK = ["sub_family", "store_id", "city_id"]
DRAFT_VERSION = 20


def _pct(c: str) -> Column:
    """A two-decimal rate as whole hundredths, so comparisons are exact."""
    return F.rint(F.col(c) * 100).cast("int")


class RetailInputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}
        self._kept: dict[str, DataFrame] = {}
        self._span: Row | None = None

    def table(self, name: str) -> DataFrame:
        """A scan; the table's schema is looked up once per query, however often it is used."""
        if name not in self._tables:
            self._tables[name] = load(self.spark, self.folder, name)
        return self._tables[name]

    def keep(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A step other steps of the same query read several times, written to storage once, so
        that the sales lines are scanned once for it and not once per use."""
        if name not in self._kept:
            self._kept[name] = materialise(make())
            drop_shuffles(self.spark)
        return self._kept[name]

    def forget(self, *names: str) -> None:
        """Delete kept steps once all that reads them is kept itself; whoever asks for one again works it out anew."""
        discard(*[self._kept.pop(name) for name in names if name in self._kept])

    # ---- masters -------------------------------------------------------------------
    def items(self) -> DataFrame:
        """One row per variant, with the article it belongs to."""
        return self.table("part").select(
            F.concat_ws("|", "p_type", "p_brand").alias("item_id"),
            F.col("p_partkey").alias("variant_id"), F.col("p_type").alias("sub_family"),
            F.substring("p_type", 1, 1).alias("family"), F.col("p_brand").alias("brand"),
            F.col("p_name").alias("item_name"), F.col("p_size").alias("pack"),
            F.col("p_retailprice").alias("retail_price"))

    def stores(self) -> DataFrame:
        place = self.table("nation").select(F.col("n_nationkey").alias("city_id"),
                                            F.col("n_name").alias("city"),
                                            F.col("n_regionkey").alias("territory"))
        return self.table("supplier").select(
            F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").alias("city_id"),
            F.col("s_name").alias("store_name"), F.col("s_acctbal").alias("balance"),
        ).join(place, "city_id")

    # ---- sales ---------------------------------------------------------------------
    def raw_lines(self) -> DataFrame:
        """Sales lines without master data: only the line table is read."""
        disc = F.col("l_extendedprice") * F.col("l_discount")
        flagged = F.col("l_returnflag")
        none = F.lit(0.0)
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("ticket_id"), F.col("l_linenumber").alias("hour"),
            F.col("l_partkey").alias("variant_id"), F.col("l_suppkey").alias("store_id"),
            F.to_date("l_shipdate").alias("sale_date"), F.col("l_quantity").alias("qty"),
            money("l_extendedprice").alias("gross"),
            money(F.col("l_extendedprice") * F.col("l_tax")).alias("reward"),
            money(F.when(flagged == "A", disc).otherwise(none)).alias("coupon_disc"),
            money(F.when(flagged == "N", disc).otherwise(none)).alias("promo_disc"),
            money(F.when(flagged == "R", disc).otherwise(none)).alias("member_disc"),
            flagged.alias("return_flag"), F.col("l_linestatus").alias("line_status"),
            _pct("l_discount").alias("disc_pct"), _pct("l_tax").alias("tax_pct"))

    def keep_lines(self) -> RetailInputs:
        """From here on the sales lines come from a kept copy: for queries that use them several times."""
        self.keep("lines", self.lines)
        return self

    def lines(self) -> DataFrame:
        """Sales lines with item and store attributes."""
        if "lines" in self._kept:
            return self._kept["lines"]
        items = self.items().select("variant_id", "item_id", "sub_family", "family", "brand")
        stores = self.stores().select("store_id", "city_id", "territory")
        return self.raw_lines().join(items, "variant_id").join(stores, "store_id")

    # ---- calendar ------------------------------------------------------------------
    def sale_days(self) -> DataFrame:
        """Every day from the first to the last sale. The two dates are read from the lines once
        per query; the days themselves are a constant of the plan."""
        if self._span is None:
            days = self._kept["lines"] if "lines" in self._kept else self.table("lineitem").select(F.col("l_shipdate").alias("sale_date"))
            self._span = days.agg(F.to_date(F.min("sale_date")).alias("lo"), F.to_date(F.max("sale_date")).alias("hi")).first()
        return self.spark.range(1, numPartitions=1).select(
            F.explode(F.sequence(F.lit(self._span.lo), F.lit(self._span.hi))).alias("day"))

    def calendar(self) -> DataFrame:
        md = F.date_format("day", "MM-dd")
        festival = F.lit(None).cast("int")
        for kind, first, last in FESTIVALS:
            festival = F.when(md.between(first, last), kind).otherwise(festival)
        return self.sale_days().select(
            "day", week_start("day").alias("week_start"), week_key("day").alias("week_key"),
            month_start("day").alias("month_start"), F.year("day").alias("year"),
            F.dayofweek("day").alias("dow"),
            F.date_sub("day", LUNAR_YEAR_DAYS).alias("lunar_day"),
            F.when(md.isin(HOLIDAYS), 1).otherwise(0).alias("holiday"),
            festival.alias("festival"))

    # ---- promotions ----------------------------------------------------------------
    def promo_lines(self) -> DataFrame:
        """One promotion per sub family, city and month: live when that month's mean discount
        is above 5 %, else a draft. Each lasts 14 days and ends inside its month."""
        cells = self.lines().groupBy("sub_family", "city_id", month_start("sale_date").alias("month")).agg(
            F.sum("disc_pct").alias("pct"), F.count(F.lit(1)).alias("n"))
        prices = self.items().groupBy("sub_family").agg(F.max("retail_price").alias("list_price"))
        start = F.date_add("month", F.pmod(F.col("pct"), F.lit(10)).cast("int"))
        return (cells.join(prices, "sub_family")
                .select("sub_family", "city_id", "month",
                        (F.year("month") * 100 + F.month("month")).alias("promo_id"),
                        F.when(F.col("pct") > 5 * F.col("n"), LIVE_VERSION)
                        .otherwise(DRAFT_VERSION).alias("version"),
                        start.alias("promo_start"), "list_price",
                        F.round(F.col("list_price") * (70 + F.month("month") % 10) / 100, 4).alias("promo_price"),
                        (F.col("city_id") % 5).alias("slot"))
                .withColumn("promo_end", F.date_add("promo_start", 13))
                .withColumn("announced", F.date_sub("promo_start", 28)))

    def kept_plan(self) -> DataFrame:
        """The plan, a small table, for queries that read it more than once."""
        return self.keep("plan", self.plan)

    def plan(self) -> DataFrame:
        """The live promotion lines."""
        return self.promo_lines().where(F.col("version") == LIVE_VERSION).drop("version")

    def promo_headers(self) -> DataFrame:
        """One campaign per month; withdrawn (-1) when returns outnumber coupon sales."""
        month = month_start("sale_date")
        return (self.raw_lines().groupBy(month.alias("start")).agg(
            F.count_if(F.col("return_flag") == "R").alias("n_r"),
            F.count_if(F.col("return_flag") == "A").alias("n_a"))
            .select((F.year("start") * 100 + F.month("start")).alias("promo_id"), "start",
                    F.last_day("start").alias("end"), F.year("start").alias("year"),
                    F.when(F.col("n_r") > F.col("n_a"), "-1").otherwise("1").alias("status")))

    # ---- stock and assortment ------------------------------------------------------
    def empty_days(self, spans: DataFrame) -> DataFrame:
        """The days on which a series is out of stock, between its first and last movement (``first_day``, ``last_day``). Which
        days these are is a fixed pattern of the day number, as the test data has no stock: one in 23, stepped to from the
        first one (10 is the inverse of 7 modulo 23)."""
        ahead = F.pmod(F.pmod(-self._pattern(F.col("first_day")), F.lit(23)) * 10, F.lit(23)).cast("int")
        first = F.date_add("first_day", ahead)
        return spans.where(first <= F.col("last_day")).select(
            *STOCK, F.explode(F.sequence(first, "last_day", F.expr("interval 23 days"))).alias("sale_date"))

    @staticmethod
    def _pattern(day: Column) -> Column:
        return F.ascii("sub_family") * 31 + F.col("store_id") * 17 + day_number(day) * 7

    def stock(self) -> DataFrame:
        """Daily stock per sub family and store, one row for every day between the first and the
        last movement. Which days are out of stock (balance 0) or stopped is a fixed pattern of
        the day number; the quantities come from the lines. Days without movement are laid out
        from the ones with, not joined."""
        moved = self.lines().groupBy(*STOCK, "sale_date").agg(F.sum("qty").alias("moved"))
        days = lay_out(event_runs(moved, STOCK, "sale_date"), "sale_date", ["moved"])
        stopped = (F.ascii("sub_family") + F.col("store_id") * 5 + day_number("sale_date")) % 29 == 0
        return days.select(
            *STOCK, "sale_date",
            F.when(self._pattern(F.col("sale_date")) % 23 == 0, 0.0).otherwise(F.coalesce("moved", F.lit(0.0)) + 1).alias("balance"),
            F.when(stopped, "Y").otherwise("N").alias("stopped"))

    def sold_lines(self) -> DataFrame:
        """Lines sold to customers; the returned ones stand for deliveries."""
        return self.lines().where(F.col("return_flag") != "R")

    def assortment_days(self) -> DataFrame:
        """Assortment rows per variant, store and day, keyed by code as a store system would."""
        return self.raw_lines().groupBy("variant_id", "store_id", "sale_date").agg(
            F.sum("qty").alias("unit_count"),
            F.when(F.max("disc_pct") == 0, "Y").otherwise("N").alias("stopped"),
            total("gross").alias("list_price"))

    def item_codes(self) -> DataFrame:
        """Sparse daily brand -> code observations: days with an untaxed, undiscounted line."""
        return (self.lines().where((F.col("disc_pct") == 0) & (F.col("tax_pct") == 0))
                .groupBy("brand", F.col("sale_date").alias("day"))
                .agg(F.max("variant_id").alias("code")))

    def barcodes(self) -> DataFrame:
        return self.lines().select(
            "item_id", F.col("variant_id").alias("barcode"), F.col("sale_date").alias("created"),
            F.when(F.col("line_status") == "O", "Y").otherwise("N").alias("main"),
            F.when(F.col("return_flag") == "R", F.col("sale_date")).alias("ended"))

    # ---- bulk orders ---------------------------------------------------------------
    def shipments(self) -> DataFrame:
        return (self.lines().where(F.col("return_flag") == "R")
                .select("variant_id", "store_id", F.col("sale_date").alias("delivery_date"), "qty",
                        F.concat("line_status", F.col("ticket_id").cast("string")).alias("order_no")))

    def payments(self) -> DataFrame:
        """Payment media per ticket: urgent orders are paid by cheque (media type 2)."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("ticket_id"),
            F.when(F.col("o_orderpriority") == "1-URGENT", 2).otherwise(1).alias("media_type"))

    # ---- coupons -------------------------------------------------------------------
    def coupon_headers(self) -> DataFrame:
        code = F.element_at(F.array(*[F.lit(c) for c in COUNT_CODES]),
                            (F.col("o_orderkey") % len(COUNT_CODES) + 1).cast("int"))
        kind = (F.when(F.col("o_orderpriority") == "1-URGENT", "CP")
                .when(F.col("o_orderpriority") == "2-HIGH", "MPM")
                .when(F.col("o_orderpriority") == "3-MEDIUM", "MP").otherwise("XX"))
        return self.table("orders").select(
            F.col("o_orderkey").alias("activity_id"),
            F.lpad((F.col("o_custkey") % 4 + 1).cast("string"), 2, "0").alias("type_id"),
            kind.alias("type_code"), code.alias("count_code"),
            F.when(F.col("o_orderstatus") == "F", "S").otherwise("C").alias("level"),
            F.col("o_orderstatus").alias("status"))

    def coupon_periods(self) -> DataFrame:
        day = F.to_date("o_orderdate")
        return self.table("orders").select(F.col("o_orderkey").alias("activity_id"),
                                           day.alias("start"), F.date_add(day, 20).alias("end"))

    def coupon_areas(self) -> DataFrame:
        """Two zero-padded ids glued by |: cities for city coupons, stores for store coupons,
        the lowest and highest among the stores that sold on the ticket."""
        places = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        area = self.table("lineitem").join(places, "l_suppkey").groupBy("l_orderkey").agg(
            *[f(c).alias(n) for n, f, c in [
                ("city_a", F.min, "s_nationkey"), ("city_b", F.max, "s_nationkey"),
                ("store_a", F.min, "l_suppkey"), ("store_b", F.max, "l_suppkey")]])
        pair = {p: F.concat_ws("|", *[padded(f"{p}_{x}", 9) for x in "ab"]) for p in ("city", "store")}
        level = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
        return area.join(level, "l_orderkey").select(
            F.col("l_orderkey").alias("activity_id"),
            F.when(F.col("o_orderstatus") == "F", pair["store"]).otherwise(pair["city"]).alias("area_list"))

    def coupon_items(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_orderkey").alias("activity_id"),
                                             F.col("l_partkey").alias("variant_id")).distinct()

    # ---- outside information -------------------------------------------------------
    def climate(self) -> DataFrame:
        """Month and city temperatures as text, the way such files arrive."""
        spread = self.table("customer").groupBy(F.col("c_nationkey").alias("city_id")).agg(
            F.max("c_acctbal").alias("hi"), F.min("c_acctbal").alias("lo"))
        months = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m")
        return spread.select("*", months).select(
            F.lpad(F.col("m").cast("string"), 2, "0").alias("month"), "city_id",
            F.col("hi").cast("string").alias("high"), F.col("lo").cast("string").alias("low"))

    def competitor(self) -> DataFrame:
        """Competitor promotions: pending orders, in the customer's city, of the ordered items."""
        pending = self.table("orders").where(F.col("o_orderstatus") == "P").select(
            "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("created"))
        owner = self.table("customer").select(F.col("c_custkey").alias("o_custkey"),
                                              F.col("c_nationkey").alias("city_id"))
        sold = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                             F.col("l_partkey").alias("variant_id"))
        items = self.items().select("variant_id", "item_id")
        return (sold.join(pending, "o_orderkey").join(owner, "o_custkey").join(items, "variant_id")
                .select("city_id", "item_id", "created"))
