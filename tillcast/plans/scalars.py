"""Scans, filters and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillcast.functions import dates
from tillcast.functions.numbers import ratio, rounded
from tillcast.functions.lineage import new_folder
from tillcast.functions.texts import padded
from tillcast.plans.registry import query
from tillcast.sources.files import append_increment
from tillcast.sources.tables import date_slice


@query("scan_project", """
SELECT l_orderkey, l_partkey, l_quantity, round(l_extendedprice * (1 - l_discount), 4) AS net
FROM lineitem
WHERE l_quantity > 25 AND l_returnflag <> 'N' AND l_discount >= 0.02 AND l_shipdate IS NOT NULL""")
def scan_project(src):
    return (src.table("lineitem")
            .where((F.col("l_quantity") > 25) & (F.col("l_returnflag") != "N")
                   & (F.col("l_discount") >= 0.02) & F.col("l_shipdate").isNotNull())
            .select("l_orderkey", "l_partkey", "l_quantity",
                    F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net")))


@query("date_slice", """
SELECT l_orderkey, l_suppkey, CAST(l_shipdate AS DATE) AS sale_date, l_quantity
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-07-01' AND l_shipdate < TIMESTAMP '1998-07-01'""")
def sliced(src):
    cut = date_slice(src.table("lineitem"), "l_shipdate", dt.date(1996, 7, 1), dt.date(1998, 7, 1))
    return cut.select("l_orderkey", "l_suppkey", F.to_date("l_shipdate").alias("sale_date"), "l_quantity")


@query("incremental_append", """
SELECT store_id, sale_date, sum(qty) AS qty FROM raw_lines GROUP BY ALL""")
def incremental(src):
    """A first run writes all days, a second one the last quarter's again, part of a partition; read back, nothing is doubled or lost."""
    daily = src.raw_lines().groupBy("store_id", "sale_date").agg(F.sum("qty").alias("qty")).withColumn("year", F.year("sale_date"))
    path = new_folder(src.spark)
    append_increment(daily, path, ["year"])
    late = daily.where(F.col("sale_date") > F.date_sub(daily.agg(F.max("sale_date")).scalar(), 90))
    append_increment(late, path, ["year"], keys=["store_id", "sale_date"])
    return src.spark.read.schema(daily.schema).parquet(path).drop("year")


@query("scalar_string", """
SELECT variant_id, family || lpad(CAST(pack AS VARCHAR), 2, '0') AS code,
       substr(brand, 7) AS brand_no, substr(item_name, 1, 3) AS head,
       family || substr(lpad(CAST(pack AS VARCHAR), 2, '0'), 1, 1) AS family_code,
       lpad(CAST(variant_id AS VARCHAR), greatest(9, length(CAST(variant_id AS VARCHAR)))::INTEGER, '0') AS padded, instr(item_name, 'ring') AS found
FROM items""")
def scalar_string(src):
    pack = F.lpad(F.col("pack").cast("string"), 2, "0")
    return src.items().select(
        "variant_id", F.concat("family", pack).alias("code"), F.substr("brand", F.lit(7)).alias("brand_no"),
        F.substring("item_name", 1, 3).alias("head"),
        F.concat("family", F.substring(pack, 1, 1)).alias("family_code"),
        padded("variant_id", 9).alias("padded"),
        F.instr("item_name", "ring").cast("bigint").alias("found"))


@query("scalar_date", """
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed,
       CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS age,
       CAST(o_orderdate AS DATE) + 7 AS next_week, CAST(o_orderdate AS DATE) - 42 AS six_weeks_ago,
       CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(week(o_orderdate) AS INTEGER) AS iso_week,
       CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS INTEGER) AS week_key
FROM orders""")
def scalar_date(src):
    day = src.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return day.select(
        "o_orderkey", F.to_date(F.date_format("d", "yyyyMMdd"), "yyyyMMdd").alias("parsed"),
        F.datediff("d", F.lit("1995-01-01").cast("date")).alias("age"),
        F.date_add("d", 7).alias("next_week"), F.date_sub("d", 42).alias("six_weeks_ago"),
        F.dayofweek("d").alias("dow"), F.year("d").alias("year"), F.weekofyear("d").alias("iso_week"),
        dates.week_key("d").alias("week_key"))


@query("scalar_math", """
SELECT ticket_id, variant_id, round(qty / 3, 4) AS third, abs(qty - 25) AS gap,
       round(175 * log10(qty + 1), 6) AS threshold, round(sqrt(qty), 6) AS root, qty * qty AS squared,
       round(qty / nullif(CAST(tax_pct AS DOUBLE), 0), 6) AS per_tax
FROM raw_lines""")
def scalar_math(src):
    qty = F.col("qty")
    return src.raw_lines().select(
        "ticket_id", "variant_id", rounded(qty / 3, 4).alias("third"), F.abs(qty - 25).alias("gap"),
        rounded(175 * F.log10(qty + 1)).alias("threshold"), rounded(F.sqrt(qty)).alias("root"),
        (qty * qty).alias("squared"), rounded(ratio("qty", "tax_pct")).alias("per_tax"))


@query("scalar_cond", """
SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS big,
       CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'done' ELSE 'other' END AS state,
       coalesce(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 0) AS priority,
       coalesce(TRY_CAST(o_orderpriority AS INTEGER), -1) AS bad_cast,
       CAST(CAST(o_totalprice AS DECIMAL(38,6)) AS DOUBLE) AS exact_price
FROM orders""")
def scalar_cond(src):
    status = F.col("o_orderstatus")
    return src.table("orders").select(
        "o_orderkey", F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).alias("big"),
        F.when(status == "O", "open").when(status == "F", "done").otherwise("other").alias("state"),
        F.coalesce(F.substring("o_orderpriority", 1, 1).try_cast("int"), F.lit(0)).alias("priority"),
        F.coalesce(F.col("o_orderpriority").try_cast("int"), F.lit(-1)).alias("bad_cast"),
        F.col("o_totalprice").cast("decimal(38,6)").cast("double").alias("exact_price"))


@query("business_days", """
SELECT p.*, (SELECT CAST(count(*) FILTER (isodow(g.d) < 6) AS INTEGER)
             FROM (SELECT unnest(generate_series(p.s, p.e - 1, INTERVAL 1 DAY)) AS d) g) AS business_days,
       (SELECT CAST(count(*) FILTER (isodow(g.d) >= 6) AS INTEGER)
             FROM (SELECT unnest(generate_series(p.s, p.e - 1, INTERVAL 1 DAY)) AS d) g) AS weekend_days
FROM (SELECT sub_family, city_id, promo_id, promo_start AS s, CAST(promo_end + slot AS DATE) AS e FROM promo_lines) p""")
def business_days(src):
    return src.promo_lines().select(
        "sub_family", "city_id", "promo_id", F.col("promo_start").alias("s"),
        F.date_add("promo_end", F.col("slot")).alias("e"),
    ).withColumns({"business_days": dates.business_days("s", "e"), "weekend_days": dates.weekend_days("s", "e")})


@query("week_distance", """
SELECT sub_family, city_id, promo_id,
       CAST((CAST(date_trunc('week', promo_start) AS DATE) - CAST(date_trunc('week', announced) AS DATE)) / 7 AS INTEGER) AS weeks_notice,
       CAST((DATE '2001-12-31' - CAST(date_trunc('week', promo_start) AS DATE)) / 7 AS INTEGER) AS weeks_left
FROM promo_lines""")
def week_distance(src):
    return src.promo_lines().select(
        "sub_family", "city_id", "promo_id",
        dates.weeks_between("promo_start", "announced").alias("weeks_notice"),
        dates.weeks_between(F.lit("2001-12-31").cast("date"), "promo_start").alias("weeks_left"))
