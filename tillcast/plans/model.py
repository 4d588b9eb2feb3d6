"""Model-table, forecast and evaluation queries, on weekly sales per sub family and store."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions.dates import business_days, week_key, week_start
from tillcast.functions.joins import written_out
from tillcast.functions.numbers import flag, total
from tillcast.functions.texts import composite_key
from tillcast.operators import coupon, evaluate, features, forecast, model_table, promo, promo_join, scope
from tillcast.plans.day_split import forecast_in, orders
from tillcast.plans.promo import FAMILY, promo_table, promo_table_kept, with_family
from tillcast.plans.registry import query
from tillcast.plans.shared import DENSE, PLACE, SERIES, dense_weeks, dense_weeks_kept, weekly
from tillcast.sources.types import infer_types as infer_text_types
from tillcast.sources.types import type_results as type_result_rows

SF = ["sub_family", "store_id"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
#: What the weekly models see of a row: numbers, and columns of categories.
WEEKLY_NUMBERS = [
    "year", "holiday_days", "n_current", "n_next", "promo_price", "list_price", "price_ratio", "promo_days", "weeks_since_start",
    "weeks_to_end", "weeks_to_next", "next_promo_days", "high", "low", "last_year_qty", "series_mean_4", "series_mean_12", "series_mean_24",
    "series_mean_52", "family_mean_4", "family_mean_12", "family_mean_24", "family_mean_52", "family_min", "family_max", "bulk_ratio", "business_days"]
WEEKLY_CATEGORIES = ["sub_family", "store_id", "city_id", "territory", "slot", "festival", "start_dow", "end_dow", "month", "quarter", "next_month"]
PROMO_NUMBERS = ["price_ratio", "list_price", "promo_price", "business_days", "weekend_days", "year", "last_year_sales", "last_year_price_ratio",
                 "last_year_family_mean", "last_five_mean", "family_last_five_mean", "slot_discount"]
PROMO_CATEGORIES = ["sub_family", "store_id", "city_id", "brand", "slot", "festival", "month"]
WEEKLY, WEEKLY_ERRORS, PROMO, PROMO_ERRORS = forecast.WEEKLY, forecast.WEEKLY_ERRORS, forecast.PROMO, forecast.PROMO_ERRORS


def weekly_sf(src):
    return src.keep("weekly_sf", lambda: src.lines().groupBy(*SF, "city_id", week_start("sale_date").alias("week_start")).agg(
        F.sum("qty").alias("qty"), total("gross").alias("gross"), F.max(flag(F.col("qty") >= 50)).alias("bulk"),
        F.sum(F.when(F.col("return_flag") == "R", -F.col("qty")).otherwise(F.col("qty"))).alias("net")))


def _dense(src):
    return model_table.densify_weeks(weekly_sf(src), "sub_family", "store_id")


def _targets(src):
    return model_table.horizon_targets(_dense(src).select(*SF, "week_start", "qty"), SF)


def _naive(src):
    return evaluate.naive_forecast(weekly_sf(src).select(*SF, "week_start", "qty"), SF)


def _weekly_rows(src):
    """Training rows with the features of the weekly tables: promotion plan and calendar of the week, climate, last year's
    sales, trailing means of the series and of its family. No feature looks at the row's own sales."""
    week = weekly_sf(src).withColumn("family", F.substring("sub_family", 1, 1))
    plan = features.promo_price_features(dense_weeks_kept(src)).select(
        *SF, "week_start", "holiday_days", "n_current", "n_next", "promo_price", "list_price", "price_ratio", "promo_days", "start_dow", "end_dow",
        "weeks_since_start", "weeks_to_end", "weeks_to_next", "next_promo_days", "slot", F.month("next_promo_start").alias("next_month"),
        business_days("promo_start", "promo_end").alias("business_days"))
    series = features.level_means(week, SF, "series")
    family = features.level_means(week, ["family", "store_id"], "family", spread=True)
    year_ago = features.last_year_sales(week.select(*SF, "week_start", "qty"), SF).select(*SF, "week_start", "last_year_qty")
    bulk = model_table.bulk_ratio(weekly_sf(src), SF).select(*SF, "week_start", "bulk_ratio")
    festival = src.calendar().groupBy("week_start").agg(F.max("festival").alias("festival"))
    targets = model_table.training_rows(_targets(src)).withColumn("family", F.substring("sub_family", 1, 1))
    placed = targets.join(src.stores().select("store_id", "city_id", "territory"), "store_id")
    known = (placed.join(plan, [*SF, "week_start"], "left").join(series, [*SF, "week_start"], "left")
             .join(family, ["family", "store_id", "week_start"], "left").join(year_ago, [*SF, "week_start"], "left")
             .join(bulk, [*SF, "week_start"], "left").join(festival, "week_start", "left"))
    return features.climate_join(known, src.climate()).withColumns(
        {"year": F.year("week_start"), "month": F.month("week_start"), "quarter": F.quarter("week_start")})


STOP = "2001-01-01"  # first day of the test rows


def _indexed(src, name, rows, columns, fit_on):
    index = src.keep(f"{name}_index", lambda: model_table.category_index(rows, columns, fit_on))
    sizes = model_table.category_sizes(index, columns)
    return model_table.indexed(rows, index, columns, sizes), sizes


def _split(src):
    """Weekly rows with their part and category numbers, written once; categories are those of the training rows."""
    split = src.keep("weekly_rows", lambda: model_table.split_by_date(_weekly_rows(src), "week_start", STOP))
    rows, sizes = _indexed(src, "weekly", split, WEEKLY_CATEGORIES, F.col("part") == "train")
    return src.keep("weekly_indexed", lambda: rows), sizes


def _weekly_models(src):
    rows, category = model_table.dense_features(_split(src)[0], WEEKLY_NUMBERS, WEEKLY_CATEGORIES)
    train, test = rows.where("part = 'train'"), rows.where("part = 'test'")
    return src.keep("weekly_models", lambda: forecast.weekly_models(
        train, test, "sub_family", SF, range(10), trees=WEEKLY, errors=WEEKLY_ERRORS, category=category, names=WEEKLY_NUMBERS + WEEKLY_CATEGORIES)), train


def _promo_rows(src):
    """Promotions with the features of the promotion tables: history, last year, slot discount, festival, length."""
    keys = [*SERIES, "promo_id"]
    known = with_family(src)
    year_ago = promo.promo_last_year(known, SERIES, FAMILY).select(*keys, "last_year_sales", "last_year_price_ratio", "last_year_family_mean")
    history = promo.promo_history(known, SERIES, FAMILY).select(*keys, "last_five_mean", "family_last_five_mean")
    festival = promo.promo_festival(promo_table_kept(src), src.calendar()).select(*keys, "festival")
    lines = promo_join.current_promo(src.lines(), src.kept_plan(), PLACE, ["slot"])
    short = promo_table_kept(src).select(*keys, "promo_start", "promo_end")
    discount = coupon.slot_discount(lines, short, SERIES).select(*keys, "slot_discount")
    rows = model_table.clean_target(promo_table_kept(src), "sales", ["promo_start", "promo_end"], keep_unknown=True)
    for side in (year_ago, history, festival, discount):
        rows = rows.join(written_out(side), keys, "left")
    rows = model_table.promo_length(rows, "promo_start", "promo_end").withColumns(
        {"month": F.month("promo_start"), "year": F.year("promo_start"), "brand": F.split_part("item_id", F.lit("|"), F.lit(2))})
    rows = src.keep("promo_rows", lambda: rows)
    known = (F.col("sales") > 0) & (F.col("promo_start") < STOP)
    out, sizes = _indexed(src, "promo", rows, PROMO_CATEGORIES, known)
    return src.keep("promo_indexed", lambda: out), sizes, known


@query("clean_target", """
SELECT 'week' AS kind, sub_family, store_id, week_start AS day, net AS target FROM weekly_sf WHERE net >= 0
UNION ALL
SELECT 'promo', sub_family, store_id, promo_start, sales FROM promos
WHERE promo_start IS NOT NULL AND (sales >= 0 OR sales IS NULL)""")
def clean_target(src):
    weeks = model_table.clean_target(weekly_sf(src), "net").select(
        F.lit("week").alias("kind"), *SF, F.col("week_start").alias("day"), F.col("net").alias("target"))
    promos = model_table.clean_target(promo_table(src), "sales", ["promo_start"], keep_unknown=True).select(
        F.lit("promo").alias("kind"), *SF, F.col("promo_start").alias("day"), F.col("sales").alias("target"))
    return weeks.unionByName(promos)


@query("bulk_ratio", """
SELECT a.sub_family, a.store_id, a.week_start, a.bulk, CAST(sum(b.bulk) AS DOUBLE) / nullif(count(b.bulk), 0) AS bulk_ratio
FROM (SELECT *, row_number() OVER (PARTITION BY sub_family, store_id ORDER BY week_start) AS rn FROM weekly_sf) a
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY sub_family, store_id ORDER BY week_start) AS rn FROM weekly_sf) b
  ON b.sub_family = a.sub_family AND b.store_id = a.store_id AND b.rn BETWEEN a.rn - 52 AND a.rn - 1
GROUP BY ALL""")
def bulk_ratio(src):
    return model_table.bulk_ratio(weekly_sf(src), SF).select(*SF, "week_start", "bulk", "bulk_ratio")


@query("one_hot", "SELECT sub_family, store_id, week_start, qty, " + ", ".join(
    f"CAST(sub_family = '{t}' AS INTEGER) AS sub_family__{t}" for t in TYPES) + ", " + ", ".join(
    f"CAST(bulk = {b} AS INTEGER) AS bulk__{b}" for b in (0, 1))
       + f", CAST(sub_family NOT IN ({', '.join(repr(t) for t in TYPES)}) AS INTEGER) AS sub_family__other, 0 AS bulk__other FROM weekly_sf")
def one_hot(src):
    rows = weekly_sf(src).select(*SF, "week_start", "qty", "bulk")
    return model_table.one_hot(rows, {"sub_family": TYPES, "bulk": [0, 1]}).drop("bulk")


def _sparse_sql(rows: str, keys: str, numbers: list[str], columns: list[str], fit_on: str) -> str:
    """The sparse vector from one long table of (row, place, value): category numbers by counting, places by adding sizes."""
    means = ", ".join(f"round(CAST(sum(CAST({c} AS DECIMAL(24,8))) AS DOUBLE) / nullif(count({c}), 0), 6) AS {c}" for c in numbers)
    values = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS v FROM r WHERE {fit_on} AND {c} IS NOT NULL" for c in columns)
    order = ", ".join(f"('{c}', {k})" for k, c in enumerate(columns))
    number_rows = " UNION ALL ".join(f"SELECT rid, {k} AS place, coalesce(CAST({c} AS DOUBLE), (SELECT {c} FROM m), 0.0) AS value FROM r" for k, c in enumerate(numbers))
    dummy_rows = " UNION ALL ".join(
        f"SELECT r.rid, CAST(s.start + coalesce(i.ix, s.n) AS INTEGER) AS place, 1.0 AS value FROM r JOIN starts s ON s.col = '{c}' "
        f"LEFT JOIN ix i ON i.col = '{c}' AND i.v = CAST(r.{c} AS VARCHAR)" for c in columns)
    return f"""
WITH base AS MATERIALIZED ({rows}),
     r AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM base),
     m AS MATERIALIZED (SELECT {means} FROM r WHERE {fit_on}),
     ix AS MATERIALIZED (SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY n DESC, v) - 1 AS ix
            FROM (SELECT col, v, count(*) AS n FROM ({values}) GROUP BY ALL)),
     sizes AS (SELECT o.col, o.k, count(i.v) AS n FROM (VALUES {order}) o(col, k) LEFT JOIN ix i ON i.col = o.col GROUP BY ALL),
     starts AS (SELECT a.col, a.n, {len(numbers)} + coalesce(sum(b.n + 1), 0) AS start FROM sizes a LEFT JOIN sizes b ON b.k < a.k GROUP BY ALL),
     p AS MATERIALIZED (SELECT * FROM ({number_rows} UNION ALL {dummy_rows}) WHERE value <> 0)
SELECT {keys}, CAST((SELECT sum(n + 1) FROM sizes) + {len(numbers)} AS INTEGER) AS size,
       (SELECT list(CAST(place AS INTEGER) ORDER BY place) FROM p WHERE p.rid = r.rid) AS indices,
       (SELECT list(CAST(value AS DOUBLE) ORDER BY place) FROM p WHERE p.rid = r.rid) AS "values"
FROM r"""


def _means_sql(level: str, keys: str, table: str) -> str:
    parts = ", ".join(f"avg(q) OVER (PARTITION BY {keys} ORDER BY week_start ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS {level}_mean_{n}" for n in (4, 12, 24, 52))
    spread = ", ".join(f"{f}(q) OVER (PARTITION BY {keys} ORDER BY week_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS {level}_{f}" for f in ("min", "max"))
    return f"SELECT {keys}, week_start, {parts}, {spread} FROM ({table})"


WEEKLY_ROWS_SQL = f"""
SELECT w.sub_family, w.store_id, w.week_start, st.city_id, st.territory, d.holiday_days, d.n_current, d.n_next, d.promo_price, d.list_price, d.slot,
       d.promo_price / nullif(d.list_price, 0) AS price_ratio, d.promo_end - d.promo_start AS promo_days, dayofweek(d.promo_start) + 1 AS start_dow,
       dayofweek(d.promo_end) + 1 AS end_dow, (w.week_start - CAST(date_trunc('week', d.promo_start) AS DATE)) // 7 AS weeks_since_start,
       (CAST(date_trunc('week', d.promo_end) AS DATE) - w.week_start) // 7 AS weeks_to_end,
       CASE WHEN date_trunc('week', d.next_announced) <= w.week_start THEN (CAST(date_trunc('week', d.next_promo_start) AS DATE) - w.week_start) // 7 END AS weeks_to_next,
       d.next_promo_end - d.next_promo_start AS next_promo_days, month(d.next_promo_start) AS next_month,
       (SELECT count(*) FROM (SELECT unnest(range(0, d.promo_end - d.promo_start)) AS k) x WHERE (dayofweek(d.promo_start) + 6 + x.k) % 7 < 5) AS business_count,
       d.promo_start AS start_day, year(w.week_start) AS year, month(w.week_start) AS month, quarter(w.week_start) AS quarter, fe.festival,
       TRY_CAST(cl.high AS DOUBLE) AS high, TRY_CAST(cl.low AS DOUBLE) AS low,
       s.* EXCLUDE (sub_family, store_id, week_start, series_min, series_max), f.* EXCLUDE (family, store_id, week_start),
       coalesce(yb.qty, ya.qty) AS last_year_qty,
       CAST(sum(w.bulk) OVER (PARTITION BY w.sub_family, w.store_id ORDER BY w.week_start ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING) AS DOUBLE)
         / nullif(count(w.bulk) OVER (PARTITION BY w.sub_family, w.store_id ORDER BY w.week_start ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING), 0) AS bulk_ratio
FROM weekly_sf w JOIN stores st ON st.store_id = w.store_id
LEFT JOIN dense_weeks d ON d.sub_family = w.sub_family AND d.store_id = w.store_id AND d.week_start = w.week_start
LEFT JOIN (SELECT week_start, max(festival) AS festival FROM calendar GROUP BY ALL) fe ON fe.week_start = w.week_start
LEFT JOIN climate cl ON cl.city_id = st.city_id AND cl.month = strftime(w.week_start, '%m')
JOIN ({_means_sql("series", "sub_family, store_id", "SELECT sub_family, store_id, week_start, qty AS q FROM weekly_sf")}) s
  ON s.sub_family = w.sub_family AND s.store_id = w.store_id AND s.week_start = w.week_start
JOIN ({_means_sql("family", "family, store_id", "SELECT substr(sub_family, 1, 1) AS family, store_id, week_start, sum(qty) AS q FROM weekly_sf GROUP BY ALL")}) f
  ON f.family = substr(w.sub_family, 1, 1) AND f.store_id = w.store_id AND f.week_start = w.week_start
LEFT JOIN (SELECT a.sub_family, a.store_id, a.week_start, arg_max(b.qty, b.week_start) AS qty FROM weekly_sf a JOIN weekly_sf b
             ON b.sub_family = a.sub_family AND b.store_id = a.store_id
            AND b.week_start BETWEEN date_trunc('week', a.week_start - 395) AND date_trunc('week', a.week_start - 364) GROUP BY ALL) yb
  ON yb.sub_family = w.sub_family AND yb.store_id = w.store_id AND yb.week_start = w.week_start
LEFT JOIN (SELECT a.sub_family, a.store_id, a.week_start, arg_min(b.qty, b.week_start) AS qty FROM weekly_sf a JOIN weekly_sf b
             ON b.sub_family = a.sub_family AND b.store_id = a.store_id
            AND b.week_start BETWEEN date_trunc('week', a.week_start - 364) AND date_trunc('week', a.week_start - 333) GROUP BY ALL) ya
  ON ya.sub_family = w.sub_family AND ya.store_id = w.store_id AND ya.week_start = w.week_start"""


@query("feature_vector", _sparse_sql(
    f"SELECT * EXCLUDE (business_count, start_day), CASE WHEN start_day IS NOT NULL THEN business_count END AS business_days FROM ({WEEKLY_ROWS_SQL}) x",
    "sub_family, store_id, week_start", WEEKLY_NUMBERS, WEEKLY_CATEGORIES, f"week_start < DATE '{STOP}'"))
def feature_vector(src):
    rows, sizes = _split(src)
    means = model_table.training_means(rows, WEEKLY_NUMBERS, F.col("part") == "train")
    return model_table.sparse_features(rows, WEEKLY_NUMBERS, WEEKLY_CATEGORIES, sizes, means).select(*SF, "week_start", "size", "indices", "values")


@query("densify_weeks", "SELECT sub_family, store_id, week_start, qty FROM dense_sf")
def densify_weeks(src):
    return _dense(src).select(*SF, "week_start", "qty")


def _leads_sql(horizons) -> str:
    """The weeks of each horizon by one range join on the date, not by row position as in Spark."""
    cols = ", ".join(f"max(t.qty) FILTER (t.week_start = d.week_start + {7 * h}) AS w{h}" for h in horizons)
    return (f"SELECT d.sub_family, d.store_id, d.week_start, d.qty, {cols} FROM dense_sf d JOIN dense_sf t"
            " ON t.sub_family = d.sub_family AND t.store_id = d.store_id"
            f" AND t.week_start BETWEEN d.week_start AND d.week_start + {7 * max(horizons)} GROUP BY ALL")


@query("horizon_targets", f"""
SELECT sub_family, store_id, week_start, qty, {", ".join(f"nullif(w{h}, -1) AS w{h}" for h in range(10))}
FROM ({_leads_sql(range(10))}) x WHERE qty <> -1""")
def horizon_targets(src):
    return model_table.training_rows(_targets(src))


@query("skipped_weeks", f"""
SELECT * FROM (
  SELECT sub_family, store_id, week_start, CASE WHEN qty = -1 THEN 1 ELSE 0 END AS missing_sales,
         concat_ws(',', {", ".join(f"CASE WHEN qty = -1 OR w{h} = -1 THEN '{h}' END" for h in range(10))}) AS skipped
  FROM ({_leads_sql(range(10))}) x) y WHERE skipped <> ''""")
def skipped_weeks(src):
    return model_table.skipped_weeks(_targets(src), SF)


@query("train_test_split_by_date", """
SELECT item_id, store_id, promo_id, start_week, sales,
       CASE WHEN start_week < DATE '2001-01-01' THEN 'train' ELSE 'test' END AS part
FROM promos WHERE start_week >= DATE '1998-01-01' AND sales > 0""")
def train_test_split_by_date(src):
    return model_table.split_by_date(promo_table(src), "start_week", "2001-01-01", "1998-01-01", "sales").select(
        *SERIES, "promo_id", "start_week", "sales", "part")


@query("attach_week", """
SELECT p.item_id, p.store_id, p.promo_id, p.promo_start, c.week_key AS start_week_key
FROM promos p LEFT JOIN calendar c ON c.day = p.promo_start""")
def attach_week(src):
    return model_table.attach_week(promo_table(src), src.calendar()).select(
        *SERIES, "promo_id", "promo_start", "start_week_key")


@query("hold_features", """
WITH t AS (SELECT * FROM dense_weeks WHERE week_start + 6 >= DATE '2001-03-01'),
     k AS (SELECT DISTINCT week_start FROM t WHERE week_start + 6 > DATE '2001-03-01' ORDER BY week_start LIMIT 9)
SELECT t.sub_family, t.store_id, t.week_start, t.qty, f.gross, f.n_current
FROM t
LEFT JOIN (SELECT * FROM t WHERE week_start = (SELECT min(week_start) FROM t)) f
  ON f.sub_family = t.sub_family AND f.store_id = t.store_id
WHERE t.week_start IN (SELECT week_start FROM k)""")
def hold_features(src):
    rows = dense_weeks(src).select(*DENSE, "week_start", "qty", "gross", "n_current")
    return model_table.hold_features(rows, DENSE, ["gross", "n_current"], "2001-03-01")


@query("weekly_forecast")
def weekly_forecast(src):
    out = forecast.weekly_forecast(_weekly_models(src)[0], SF)
    return evaluate.order_quantity(evaluate.confidence_bound(out, 3.0), [*SF, "horizon"], "week_start")


@query("weekly_models")
def weekly_models(src):
    models, train = _weekly_models(src)
    return forecast.model_report(models, forecast.skipped_items(train, "sub_family", range(10)), "sub_family")


@query("promo_forecast")
def promo_forecast(src):
    rows, _, known = _promo_rows(src)
    rows, category = model_table.dense_features(rows, PROMO_NUMBERS, PROMO_CATEGORIES)
    test = rows.where(F.col("sales").isNull() | (F.col("promo_start") >= STOP))
    out = src.keep("promo_predictions", lambda: forecast.promo_forecast(
        rows.where(known), test, "sales", SERIES, trees=PROMO, errors=PROMO_ERRORS, category=category))
    return evaluate.confidence_bound(evaluate.cap_forecast(out), 1.28).withColumn("order_qty", F.col("upper")).select(
        *SERIES, "promo_id", "promo_start", "sales", "forecast", "err2", "upper", "order_qty")


@query("error_model")
def error_model(src):
    return forecast.fold_rows(_weekly_models(src)[0], SF)


@query("kfold_mape")
def kfold_mape(src):
    return forecast.kfold_mape(forecast.fold_rows(_weekly_models(src)[0], SF), ["sub_family", "horizon"])


@query("feature_importance")
def feature_importance(src):
    return forecast.top_features(_weekly_models(src)[0], "sub_family")


@query("confidence_bound", "SELECT * FROM forecast_in")
def confidence_bound(src):
    return evaluate.confidence_bound(forecast_in(src), 3.0)


@query("order_quantity", "SELECT * FROM order_rows")
def order_quantity(src):
    return orders(src)


_METRICS = """
SELECT {by} count(*) AS n, CAST(sum(CAST(forecast - qty AS DECIMAL(24,8))) AS DOUBLE) AS rel_error,
       CAST(sum(CAST(abs(forecast - qty) AS DECIMAL(24,8))) AS DOUBLE) AS abs_error,
       CAST(sum(CAST(abs(forecast - qty) AS DECIMAL(24,8))) AS DOUBLE) / sum(qty) AS weighted_mape,
       CAST(sum(CAST(abs(forecast - qty) / abs(nullif(qty, 0)) AS DECIMAL(24,8))) AS DOUBLE)
         / count(CASE WHEN qty <> 0 THEN 1 END) AS mean_mape
FROM naive_sf {group}"""


@query("error_metrics", _METRICS.format(by="sub_family,", group="GROUP BY sub_family")
       + "\nUNION ALL\n" + _METRICS.format(by="'ALL' AS sub_family,", group=""))
def error_metrics(src):
    rows = _naive(src)
    whole = evaluate.error_metrics(rows, []).select(F.lit("ALL").alias("sub_family"), "*")
    return evaluate.error_metrics(rows, ["sub_family"]).unionByName(whole)


@query("error_curve", """
WITH e AS (SELECT sub_family, round(forecast - qty, 6) AS error, sum(qty) AS volume FROM naive_sf GROUP BY ALL),
     c AS (SELECT *, sum(volume) OVER (PARTITION BY sub_family ORDER BY error) AS cumulative,
                  sum(volume) OVER (PARTITION BY sub_family) AS total FROM e)
SELECT sub_family, error, volume, cumulative, cumulative / total AS volume_share,
       (SELECT min(error) FROM c d WHERE d.sub_family = c.sub_family AND d.cumulative / d.total > 0.8) AS error_at_volume,
       (SELECT min(cumulative / total) FROM c d WHERE d.sub_family = c.sub_family AND d.error > 10) AS volume_at_error,
       coalesce((SELECT min(cumulative / total) FROM c d WHERE d.sub_family = c.sub_family AND d.error >= 0), 0) AS share_at_zero
FROM c""")
def error_curve(src):
    curve = src.keep("curve", lambda: evaluate.error_curve(_naive(src), ["sub_family"]))
    return curve.join(evaluate.curve_points(curve, ["sub_family"], 0.8, 10), "sub_family")


@query("cap_forecast", """
WITH p AS (SELECT sub_family, store_id, week_start, qty, greatest(forecast, 0) AS f FROM naive_sf),
     t AS (SELECT quantile_cont(f, 0.999) AS top FROM p)
SELECT sub_family, store_id, week_start, qty, CASE WHEN f > top * 2 THEN top ELSE f END AS forecast FROM p, t""")
def cap_forecast(src):
    return evaluate.cap_forecast(_naive(src).drop("err2"))


@query("item_profile", """
SELECT *, sum("sum") OVER (ORDER BY "sum" DESC, item_id) AS cum_sum,
       sum("sum") OVER (ORDER BY "sum" DESC, item_id) / sum("sum") OVER () AS cum_share
FROM (SELECT item_id, count(*) AS n, avg(qty) AS mean, round(stddev_samp(qty), 6) AS std, min(qty) AS min,
             quantile_cont(qty, 0.25) AS q25, quantile_cont(qty, 0.5) AS q50, quantile_cont(qty, 0.75) AS q75,
             max(qty) AS max, sum(qty) AS sum FROM weekly GROUP BY ALL) x""")
def item_profile(src):
    return evaluate.item_profile(weekly(src), "item_id").withColumn("std", F.round("std", 6))


@query("analysis_filter", """
SELECT w.sub_family, w.store_id, w.week_start, w.qty
FROM dense_weeks w
JOIN stock s ON s.sub_family = w.sub_family AND s.store_id = w.store_id AND s.sale_date = DATE '2001-06-30'
WHERE s.stopped <> 'Y' AND w.any_bulk = 0 AND w.any_oos = 0""")
def analysis_filter(src):
    status = src.stock().where(F.col("sale_date") == F.lit("2001-06-30").cast("date")).withColumn(
        "stop_reason", F.when(F.col("stopped") == "Y", "stopped"))
    rows = scope.active_flag(dense_weeks(src), status, DENSE)
    return evaluate.analysis_filter(rows).select(*DENSE, "week_start", "qty")


@query("type_results", """
SELECT TRY_CAST(split_part(full_item, '_', 1) AS INTEGER) AS item_id,
       TRY_CAST(split_part(full_item, '_', 2) AS INTEGER) AS variant_id, full_item,
       lpad(store, CAST(greatest(3, length(store)) AS INTEGER), '0') AS store_code,
       full_item || '_' || lpad(store, CAST(greatest(3, length(store)) AS INTEGER), '0') AS item_store,
       week_key, qty AS forecast, CAST(tax_pct AS DOUBLE) AS predict_error, CAST(NULL AS DOUBLE) AS upper,
       CAST(gross AS DOUBLE) AS order_qty
FROM (SELECT i.pack || '_' || i.variant_id AS full_item, CAST(r.store_id AS VARCHAR) AS store,
             c.week_key, r.qty, r.tax_pct, r.gross
      FROM raw_lines r JOIN items i ON i.variant_id = r.variant_id JOIN calendar c ON c.day = r.sale_date) x""")
def type_results(src):
    text = (src.raw_lines().join(src.items().select("variant_id", "pack"), "variant_id")
            .select(composite_key("pack", "variant_id").alias("full_item"), F.col("store_id").cast("string").alias("store_code"),
                    week_key("sale_date").cast("string").alias("week"), F.col("qty").cast("string").alias("predict_sales"),
                    F.col("tax_pct").cast("string").alias("predict_error"), F.col("return_flag").alias("upper"),
                    F.col("gross").cast("string").alias("order_prediction")))
    return type_result_rows(text)


@query("infer_types", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def infer_types(src):
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    text = src.table("orders").select(*[F.col(c).cast("string").alias(c) for c in names])
    return infer_text_types(text, ["o_orderkey"])
