import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tillcast.functions.joins import points_in_ranges
from tillcast.functions.lineage import materialise
from tillcast.functions.texts import COUNT_CODES
from tillcast.operators import coupon, day_split, promo, promo_join

D = dt.date
KEYS = ["item_id", "store_id"]
PROMO = "item_id string, store_id int, family string, promo_id int, start_week date, sales double, price_ratio double"


def monday(n: int) -> D:
    return D(2018, 1, 1) + dt.timedelta(7 * n)


def test_promo_table_adds_only_unseen_upcoming_rows(make, rows):
    daily = make("item_id string, store_id int, sf string, city int, sale_date date, qty double, promo_id int", [
        ("i", 1, "s", 9, "2019-01-01", 2.0, 1), ("i", 1, "s", 9, "2019-01-02", 3.0, 1), ("i", 1, "s", 9, "2019-01-09", 4.0, None),
        ("i", 2, "s", 9, "2019-01-09", 1.0, None), ("j", 1, "t", 9, "2019-01-09", 1.0, None)])
    plan = make("sf string, city int, promo_id int, promo_start date, promo_end date, promo_price double, list_price double, slot int", [
        ("s", 9, 1, "2019-01-01", "2019-01-02", 2.0, 3.0, 1), ("s", 9, 2, "2019-02-01", "2019-02-02", 1.0, 0.0, 1),
        ("s", 8, 3, "2019-02-01", "2019-02-02", 1.0, 2.0, 1)])
    out = promo.promo_agg(daily, plan, KEYS, ["sf", "city"], "2019-01-15")
    assert rows(out, "item_id", "store_id", "promo_id", "sales", "price_ratio", "start_week") == [
        ("i", 1, 1, 5.0, 0.667, "2018-12-31"), ("i", 1, 2, None, None, "2019-01-28"), ("i", 2, 2, None, None, "2019-01-28")]


def test_first_promo_and_last_year(make, rows):
    df = make("item_id string, store_id int, family string, promo_id int, start_week date, start_month date, sales double, price_ratio double", [
        ("i", 1, "f", 2, "2018-01-08", "2018-01-01", 4.0, 0.5), ("i", 1, "f", 1, "2018-01-08", "2018-01-01", 6.0, 0.6),
        ("i", 1, "f", 3, "2018-01-15", "2018-01-01", 9.0, 0.7), ("i", 1, "f", 9, "2019-01-07", "2019-01-01", None, 0.8)])
    assert rows(promo.first_promo_of_month(df, KEYS), "promo_id") == [(1,), (9,)]
    out = promo.promo_last_year(df, KEYS, ["family", "store_id"]).where("promo_id = 9")
    r = out.first()
    assert (r.last_year_sales, r.last_year_price_ratio, round(r.last_year_family_mean, 6)) == (6.0, 0.6, round(19 / 3, 6))


def test_history_equals_brute_force(make):
    random.seed(5)
    data = [(random.choice("ij"), random.choice([1, 2]), "f", n, monday(random.randrange(60)),
             None if random.random() < 0.2 else float(random.randrange(20)), 0.5) for n in range(120)]
    got = {(r.item_id, r.store_id, r.promo_id): (r.last_five_mean, r.family_last_five_mean)
           for r in promo.promo_history(make(PROMO, data), KEYS, ["family", "store_id"]).collect()}

    def mean(row, same, tie):
        old = [p for p in data if same(p) and p[4] < row[4] - dt.timedelta(42)]
        top = [p[5] for p in sorted(old, key=tie, reverse=True)[:5] if p[5] is not None]
        return sum(top) / len(top) if top else None

    for p in data:
        item = mean(p, lambda q: q[:2] == p[:2], lambda q: (q[4], q[3]))
        fam = mean(p, lambda q: q[1] == p[1], lambda q: (q[4], q[3], q[0]))
        assert got[(p[0], p[1], p[3])] == (item, fam)


def test_festival_must_lie_strictly_inside(make, rows):
    promos = make("promo_id int, promo_start date, promo_end date", [
        (1, "2019-02-05", "2019-02-07"), (2, "2019-02-04", "2019-02-06"), (3, "2019-02-05", "2019-02-05"), (4, "2019-02-01", "2019-02-20")])
    cal = make("day date, festival int", [("2019-02-05", 1), ("2019-02-10", 2), ("2019-02-11", None)])
    assert rows(promo.promo_festival(promos, cal), "promo_id", "festival") == [(1, None), (2, 1), (3, None), (4, 2)]


def test_lunar_windows(make, rows):
    days = [D(2018, 1, 1) + dt.timedelta(d) for d in range(900)]
    cal = make("day date, week_start date, lunar_day date", [(d, d - dt.timedelta(d.weekday()), d - dt.timedelta(354)) for d in days])
    weeks = promo.lunar_weeks(cal)
    first = weeks.where("week_start = '2018-01-01'").first()
    assert first.lunar_week is None and weeks.count() == 129
    assert weeks.where("week_start = '2019-12-30'").first().lunar_week == D(2019, 1, 7)
    data = [("i", 1, "f", 1, D(2019, 12, 30), 5.0, 0.5), ("i", 1, "f", 2, D(2019, 1, 7), 4.0, 0.5), ("i", 1, "f", 3, D(2019, 1, 28), 6.0, 0.7),
            ("i", 1, "f", 4, D(2019, 2, 25), 9.0, 0.7), ("i", 2, "f", 5, D(2019, 1, 7), 99.0, 0.7)]
    out = promo.promo_lunar(make(PROMO, data), weeks, KEYS).where("promo_id = 1").first()
    assert (out.lunar_sum_1m, out.lunar_mean_3m, out.lunar_sum_3m, out.lunar_ratio_3m) == (4.0, 5.0, 10.0, 0.6)


def test_matched_uplift_and_baseline(make, rows):
    daily = make("item_id string, store_id int, sf string, brand string, sale_date date, qty double, reward double, positive_qty double", [
        ("i", 1, "s", "b", "2018-01-03", 6.0, 1.0, 6.0), ("i", 1, "s", "b", "2017-12-18", 7.0, 0.0, 7.0), ("i", 1, "s", "b", "2017-12-17", 50.0, 0.0, 50.0),
        ("j", 1, "s", "b", "2018-01-03", 9.0, 0.0, 9.0), ("k", 2, "s", "b", "2018-01-03", 4.0, 1.0, 4.0)])
    mapping = make("promo_id int, last_start date, last_end date", [(7, "2018-01-01", "2018-01-04"), (8, "2018-01-03", "2018-01-03")])
    plan = make("sf string, promo_id int", [("s", 7), ("s", 7)])
    hit = promo.matched_last_year(daily, mapping, plan, ["item_id", "store_id"], ["sf"])
    assert rows(hit, "item_id", "matched_sales") == [("i", 6.0), ("k", 4.0)]  # no reward, no match
    base = promo.promo_uplift_base(daily, mapping, plan, ["store_id", "sf", "brand"], "item_id", "sf")
    # Store 2 sold nothing in the 14 days before, so it has no row; day -15 is too early.
    assert rows(base, "store_id", "promo_sales", "prior_sales") == [(1, 6.0, 7.0)]
    promos = make("item_id string, store_id int, sf string, brand string, promo_id int, promo_start date", [
        ("i", 1, "s", "b", 7, "2018-02-12"), ("k", 2, "s", "b", 7, "2018-02-12")])
    out = promo.promo_uplift(promos, base, ["store_id", "sf", "brand"])
    assert rows(out, "item_id", "uplift") == [("i", (6 / 3) / (7 / 14)), ("k", None)]
    one_day = base.withColumn("last_end", F.col("last_start"))
    assert rows(promo.promo_uplift(promos, one_day, ["store_id", "sf", "brand"]), "uplift") == [(None,), (None,)]
    # 2018-02-12: 56 days back is 2017-12-18, 28 back is 2018-01-15.
    full = promo.uplift_value(promo.promo_baseline(out, daily, KEYS))
    assert rows(full, "item_id", "baseline", "uplift_value") == [("i", 13.0, 52.0), ("k", 4.0, None)]
    both = promo.matched_or_lunar(make("item_id string, store_id int, promo_id int, lunar_mean_1m double, lunar_mean_3m double", [
        ("i", 1, 7, 1.0, 2.0), ("z", 1, 7, 1.0, None)]), hit, KEYS)
    assert [(str(r[0]), str(r[1])) for r in both.orderBy("item_id").select("last_year_1m", "last_year_3m").collect()] == [
        ("6.000000", "6.000000"), ("1.000000", "None")]


def test_coupons_reach_only_their_places(make, rows):
    heads = make("activity_id int, type_id string, type_code string, count_code string, level string, status string", [
        (1, "01", "MPM", "11", "C", "O"), (2, "02", "CP", "27", "S", "F"), (3, "03", "CP", "60", "C", "P")])
    pad = lambda *ids: "|".join(f"{i:09d}" for i in ids)
    areas = make("activity_id int, area_list string", [(1, pad(11, 11)), (2, pad(1, 21)), (3, pad(1))])
    periods = make("activity_id int, start date, end date", [(1, "2019-01-06", "2019-01-07"), (2, "2019-01-07", "2019-01-07"), (3, "2019-01-07", "2019-01-07")])
    items = make("activity_id int, variant_id int", [(a, v) for a in (1, 2, 3) for v in (5, 6)])
    ids = make("variant_id int, item_id string", [(5, "i"), (5, "i")])
    table = coupon.coupon_map(heads, areas, periods, items, ids, "O", "F")
    assert rows(table, "activity_id", "item_id") == [(1, "i"), (2, "i")]
    weeks = coupon.coupon_weeks(table)
    assert rows(weeks, "activity_id", "week_start") == [(1, "2018-12-31"), (1, "2019-01-07"), (2, "2019-01-07")]
    weekly = make("item_id string, store_id int, city_id int, week_start date, gross double, coupon_disc double", [
        ("i", 21, 1, "2019-01-07", 10.0, 1.0), ("i", 5, 11, "2019-01-07", 10.0, 2.0), ("i", 1, 11, "2019-01-07", 0.0, 2.0), ("i", 9, 9, "2019-01-07", 1.0, 0.0)])
    hits = coupon.coupon_union(weekly, weeks)
    # 1 is not found in 11 or 21; the city's coupon is listed once for its two stores.
    assert rows(hits, "level", "place_id", "activity_id") == [("C", 11, 1), ("S", 1, 2), ("S", 21, 2)]
    assert coupon.coupon_link(weekly, weeks).count() == 3 + 4  # three cities and four stores
    # The city's coupon stands in the rows of both stores; store 1 has its own too; store 9 has none and stays.
    each = coupon.coupon_rows(weekly, weeks, ["item_id", "store_id"])
    assert rows(each, "store_id", "level", "activity_id") == [(1, "C", 1), (1, "S", 2), (21, "S", 2), (5, "C", 1), (9, None, None)]
    assert coupon.coupon_rows(weekly, weeks.limit(0), ["item_id", "store_id"]).count() == 4
    codes = coupon.coupon_codes(weekly, weeks, ["item_id", "store_id"])
    assert codes.count() == weekly.count()
    dummies = coupon.coupon_dummies(codes)
    # 11 also sets the dummy of 1; MPM also sets MP; no coupon sets nothing, not even "other".
    assert rows(dummies, "store_id", "type_codes", "code_mpm", "code_mp", "code_cp", "count_1", "count_11", "count_27", "count_other") == [
        (1, "CP,MPM", 1, 1, 1, 1, 1, 1, 0), (21, "CP", 0, 0, 1, 0, 0, 1, 0), (5, "MPM", 1, 1, 0, 1, 1, 0, 0), (9, None, 0, 0, 0, 0, 0, 0, 0)]
    promos = make("item_id string, store_id int, promo_id int, promo_start date, promo_end date", [
        ("i", 21, 1, "2019-01-09", "2019-01-10"), ("i", 1, 1, "2019-01-01", "2019-01-08"), ("i", 5, 1, "2019-02-01", "2019-02-02")])
    out = coupon.coupon_discount(dummies, promos, ["item_id", "store_id"])
    # Only store 21 has exactly one flagged code: code 27 is worth 0.1, also for store 1.
    assert rows(out, "store_id", "coupon_discount") == [(1, 0.1), (21, 0.1), (5, None)]


def test_long_ids_are_not_cut(make, rows):
    weeks = make("activity_id int, item_id string, level string, type_id string, type_code string, count_code string, area_list string, week_start date", [
        (1, "i", "S", "01", "CP", "1", "1000000001|1000000003", "2019-01-07")])
    weekly = make("item_id string, store_id bigint, city_id int, week_start date", [("i", 1000000001, 1, "2019-01-07"), ("i", 1000000002, 1, "2019-01-07")])
    assert rows(coupon.coupon_union(weekly, weeks), "place_id") == [(1000000001,)]
    codes = coupon.coupon_codes(weekly, weeks, ["item_id", "store_id"])
    assert rows(codes, "store_id", "type_codes", "n_type_code") == [(1000000001, "CP", 1), (1000000002, None, None)]


def test_slot_discount(make, rows):
    lines = make("k string, sale_date date, slot int, coupon_disc double, gross double", [
        ("a", "2019-01-01", 1, 1.0, 10.0), ("b", "2019-01-01", 1, 3.0, 10.0), ("a", "2019-01-02", 2, 9.0, 10.0), ("a", "2019-01-02", 3, 1.0, 0.0)])
    promos = make("k string, promo_id int, promo_start date, promo_end date", [("a", 1, "2019-01-01", "2019-01-01"), ("b", 2, "2019-01-01", "2019-01-09")])
    assert rows(coupon.slot_discount(lines, promos, ["k"]), "k", "slot_discount") == [("a", 0.2), ("b", 0.2)]


def test_assortment_week(make, rows):
    weekly = make("k string, week_start date", [("a", "2018-12-31"), ("b", "2018-12-31")])
    days = [("a", D(2018, 12, 31) + dt.timedelta(d), "N", 6.0, 3.0) for d in range(7)] + [("b", D(2019, 1, 1), "Y", 6.0, 0.0)]
    out = coupon.assortment_week(weekly, make("k string, sale_date date, stopped string, list_price double, unit_count double", days), ["k"])
    assert rows(out, "k", "active_days", "unit_price", "active") == [("a", 7, 2.0, 1), ("b", 0, None, 0)]


def _days(make, values, start=D(2019, 1, 7)):
    return make("k string, sale_date date, demand double, out_of_stock int",
                [("a", start + dt.timedelta(n), float(v), 0) for n, v in enumerate(values)])


def test_regular_and_good_weeks(make):
    daily = _days(make, [1] * 27)  # three whole weeks and one of six days
    weeks = make("k string, week_start date, holiday_days int, n_current int, qty double", [
        ("a", "2019-01-07", 0, 0, 7.0), ("a", "2019-01-14", 0, 0, 7.0), ("a", "2019-01-21", 1, 0, 7.0), ("a", "2019-01-28", 0, 0, 6.0)])
    cal = make("week_start date", [("2018-12-31",), ("2019-02-04",)])
    regular = day_split.regular_days(daily, weeks, cal, ["k"])
    assert regular.count() == 20
    good = day_split.good_weeks(regular, ["k"])
    assert good.count() == 14
    inner = make("week_start date", [("2019-01-07",), ("2019-01-28",)])
    assert day_split.regular_days(daily, weeks, inner, ["k"]).count() == 7


def test_week_to_day_adds_up(make):
    history = _days(make, [1, 2, 3, 4, 5, 6, 7, 1, 2, 3, 4, 5, 6, 7]).withColumn("dow", F.dayofweek("sale_date"))
    share = day_split.weekday_share(history, ["k"])
    assert abs(share.agg(F.sum("share")).first()[0] - 1) < 1e-12
    forecast = make("k string, week_start date, f double", [("a", "2019-02-04", 28.0), ("b", "2019-02-04", 14.0)])
    events = make("sale_date date, event_code string", [("2019-02-05", "E")])
    impacts = make("k string, event_code string, impact double", [("a", "E", 1.0), ("b", "E", 1.0)])
    out = {(r.k, r.sale_date.day): r.d for r in day_split.week_to_day(forecast, share, impacts, events, ["k"], {"d": "f"}).collect()}
    assert len(out) == 14
    assert abs(sum(v for (k, _), v in out.items() if k == "a") - 28) < 1e-9
    assert abs(out["a", 5] / out["a", 4] - 4) < 1e-6  # twice the share of Monday, doubled by the event
    assert all(out["b", d] == 2.0 for d in range(4, 11))  # no share: an even seventh


def moved_after_explode(df) -> int:
    """Exchanges of what an explode wrote out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning", plan[:plan.index("Generate explode(")]))


def test_shares_meet_keys_not_days(make, rows, small_broadcasts, spark):
    """Shares, events and impacts that repeat or are null give the rows of the joins by day; the days written out are not moved again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    forecast = make("k string, week_start date, f double", [("a", "2019-02-04", 28.0), ("a", "2019-02-06", 7.0), ("a", "2019-02-04", 14.0),
                                                            ("b", "2019-02-11", 14.0), (None, "2019-02-04", 7.0), ("c", None, 3.0)])
    share = make("k string, dow int, share double", [("a", 2, 0.5), ("a", 3, 0.25), ("a", 3, 0.125), ("a", 4, None), ("a", None, 9.0), ("b", 2, 0.0), (None, 2, 1.0)])
    events = make("sale_date date, event_code string", [("2019-02-05", "E"), ("2019-02-05", "G"), ("2019-02-06", None), (None, "E")])
    impacts = make("k string, event_code string, impact double", [("a", "E", 1.0), ("a", "E", 3.0), ("a", None, 5.0), (None, "E", 1.0), ("b", "E", 2.0)])
    out = day_split.week_to_day(forecast, share, impacts, events, ["k"], {"d": "f"})
    days = forecast.select("*", F.explode(F.sequence("week_start", F.date_add("week_start", 6))).alias("sale_date")).withColumn("dow", F.dayofweek("sale_date"))
    joined = (days.join(share, ["k", "dow"], "left").join(events, "sale_date", "left").join(impacts, ["k", "event_code"], "left").toPandas())
    joined["lift"] = (1 + joined["impact"].fillna(0)) * joined["share"]
    whole = joined.groupby(["k", "week_start"], dropna=False)["lift"].transform("sum")
    joined["d"] = (joined["f"] / 7).where(whole == 0, joined["lift"] * joined["f"] / whole.where(whole != 0))
    names = ["k", "week_start", "sale_date", "dow", "event_code", "share", "impact", "f", "d"]

    def plain(some):
        return sorted(str([None if v != v else round(v, 9) if isinstance(v, float) else str(v) for v in r]) for r in some[names].astype(object).itertuples(index=False))
    assert plain(out.toPandas()) == plain(joined) and len(joined) > 40
    assert moved_after_explode(out) == 0
    numbered = make("k string, promo_id int, pattern string, day_no int, dow int, length int, f double", [
        ("a", 1, "P", 0, 2, 1, 8.0), ("a", 1, "P", 1, 3, 1, 8.0), ("b", 1, None, 0, 2, 0, 8.0), (None, 1, "P", 0, 2, 1, 8.0), ("c", 1, "P", 0, 2, 3, 8.0)])
    patterns = make("k string, pattern string, day_no int, share double", [
        ("a", "P", 0, 0.5), ("a", "P", 0, 0.25), ("a", "P", 1, None), ("a", "Q", 1, 0.75), ("b", None, 0, 0.5), (None, "P", 0, 0.5)])
    weekdays = make("k string, dow int, share double", [("a", 3, 0.5), ("c", 2, 0.5), ("b", None, 0.5), (None, 2, 0.5)])
    spread = day_split.promo_to_day(numbered, patterns, weekdays, ["k"], {"d": "f"})
    assert rows(spread, "k", "day_no", "d") == sorted([("a", 0, 2.0), ("a", 0, 4.0), ("a", 1, 8.0), ("b", 0, 8.0), ("c", 0, 8.0), (None, 0, 4.0)],
                                                     key=lambda r: tuple((v is None, str(v)) for v in r))
    assert moved_after_explode(spread) == 0


def test_event_impact(make, rows):
    out = day_split.event_impact(_days(make, [1, 3] + [0] * 12 + [5], D(2019, 1, 7)), {"E": [201902, 201903], "Z": [201904]}, ["k"])
    assert out.count() == 15
    assert rows(out.where("daily_mean >= 3"), "event", "impact") == [
        ("E", (3 - 4 / 14) / (4 / 14)), ("Z", 0.0)]


def test_promo_days_and_fallbacks(make, rows):
    forecast = make("k string, promo_id int, promo_start date, promo_end date, f double", [
        ("a", 1, "2019-01-07", "2019-01-08", 10.0), ("b", 1, "2019-01-07", "2019-01-08", 10.0), ("c", 1, "2019-01-07", "2019-01-07", 10.0)])
    known = make("length int, start_dow int, end_dow int, pattern string", [(1, 2, 3, "P")])
    days = day_split.promo_days(forecast, known)
    assert rows(days, "k", "day_no", "pattern") == [("a", 0, "P"), ("a", 1, "P"), ("b", 0, "P"), ("b", 1, "P"), ("c", 0, None)]
    sold = make("k string, sale_date date, demand double, promo_id int, promo_start date, promo_end date", [
        ("a", "2018-01-01", 0.0, 5, "2018-01-01", "2018-01-02"), ("a", "2018-01-02", 3.0, 5, "2018-01-01", "2018-01-02"),
        ("z", "2018-01-02", 0.0, 5, "2018-01-01", "2018-01-02"), ("a", "2018-01-03", 9.0, None, None, None)])
    share = day_split.promo_day_share(day_split.promo_daily_sales(sold, known, ["k"]), ["k"])
    assert rows(share, "k", "day_no", "share") == [("a", 0, 0.0), ("a", 1, 1.0), ("z", 1, 0.0)]
    weekdays = make("k string, dow int, share double", [("b", 2, 0.125), ("b", 3, 0.375)])
    out = day_split.promo_to_day(days, share, weekdays, ["k"], {"d": "f"})
    # a: pattern (its first day sold nothing); b: weekday shares made to add up; c: evenly, length 0 + 1.
    assert rows(out, "k", "day_no", "d") == [("a", 0, 0.0), ("a", 1, 10.0), ("b", 0, 2.5), ("b", 1, 7.5), ("c", 0, 10.0)]


def joins_of(df) -> str:
    """The plan as it ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def periods(spark, n: int):
    """Kept promotions of one length, in few bytes: equal columns take no room in the file."""
    start = F.lit("2019-01-01").cast("date")
    return materialise(spark.range(n).select(
        F.lit("a long name that every row of the table has").alias("k"), F.col("id").alias("promo_id"), start.alias("promo_start"),
        F.date_add(start, 13).alias("promo_end"), (F.col("id") % 3).alias("slot"))).where("promo_id >= 0")


@pytest.fixture
def small_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "30k")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_slots_do_not_broadcast_written_out_periods(spark, make, small_broadcasts):
    lines = (spark.range(40).select(F.lit("a long name that every row of the table has").alias("k"), F.lit(1.0).alias("gross"), (F.col("id") % 3).alias("slot"),
                                    F.date_add(F.lit("2019-01-01").cast("date"), F.col("id").cast("int")).alias("sale_date"), F.lit(0.1).alias("coupon_disc")))
    out = coupon.slot_discount(lines, periods(spark, 500).drop("slot"), ["k"])
    assert {r.slot_discount for r in out.collect()} == {0.1} and out.count() == 500
    assert not re.search(r"Generate.*explode\(sequence\(promo_start", joins_of(out))  # no row for each day of a promotion
    days = promo_join.current_promo(lines.drop("slot"), periods(spark, 500), ["k"], ["slot"])
    assert "BroadcastHashJoin" not in joins_of(days) and days.count() == 14 * 500 + 26


def test_promotion_features_are_not_broadcast(spark, small_broadcasts):
    """What is aggregated from a kept table grows with the promotions, however few bytes the file has."""
    promos = materialise(periods(spark, 1000).select("k", F.col("promo_id").alias("store_id"), "promo_id", "promo_start", F.lit(2.0).alias("sales"), F.lit(0.5).alias("price_ratio"),
                                                     F.trunc("promo_start", "month").alias("start_month"), F.date_trunc("week", "promo_start").cast("date").alias("start_week")))
    later = promos.withColumns({"start_month": F.add_months("start_month", 12), "start_week": F.date_add("start_week", 364), "promo_id": F.col("promo_id") + 5000, "sales": F.lit(3.0)})
    both = materialise(promos.unionByName(later))
    year_ago = promo.promo_last_year(both, ["k", "store_id"], ["store_id"])
    history = promo.promo_history(both, ["k", "store_id"], ["store_id"])
    for out in (year_ago, history):
        assert "BroadcastHashJoin" not in joins_of(out) and out.count() == 2000
    assert {(r.sales, r.last_year_sales, r.last_year_family_mean) for r in year_ago.collect()} == {(2.0, None, None), (3.0, 2.0, 2.0)}
    assert {(r.sales, r.last_five_mean, r.family_last_five_mean) for r in history.collect()} == {(2.0, None, None), (3.0, 2.0, 2.0)}


def test_ranges_are_not_broadcast(spark, small_broadcasts):
    points = spark.range(3000).select(F.lit("a long name that every row of the table has").alias("k"), F.date_add(F.lit("2019-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    found = points_in_ranges(periods(spark, 1000), points, ["k"], "promo_start", "promo_end", "day", 2)
    assert "BroadcastHashJoin" not in joins_of(found) and found.count() == 14 * 1000


def test_coupon_weeks_of_promotions_are_not_broadcast(spark, small_broadcasts):
    codes = [coupon.column_of(c) for c in COUNT_CODES] + ["count_other"]
    weekly = spark.range(2000).select(
        F.lit("a long name that every row of the table has").alias("k"), F.date_add(F.lit("2018-12-31").cast("date"), (7 * (F.col("id") % 3)).cast("int")).alias("week_start"), F.lit(1.0).alias("coupon_disc"),
        F.lit(10.0).alias("gross"), *[F.lit(int(i == 0)).alias(c) for i, c in enumerate(codes)])
    promos = periods(spark, 400).withColumn("promo_end", F.date_add("promo_end", 70))
    out = coupon.coupon_discount(weekly, promos, ["k"])
    assert {r.coupon_discount for r in out.collect()} == {0.1} and out.count() == 400
    assert not re.search(r"BroadcastHashJoin[^\n]*week_start[^\n]*BuildLeft", joins_of(out))


def shuffled_rows(df):
    """Rows that the plan's exchanges wrote."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(plan.plan())
        elif kind != "ReusedExchangeExec":
            if kind == "ShuffleExchangeExec":
                found += plan.metrics().apply("shuffleRecordsWritten").value()
            todo += [plan.children().apply(i) for i in range(plan.children().length())]
    return found


def test_coupons_are_moved_once_and_not_by_week_or_store(spark):
    """Forty stores of a city, forty coupons of it that last four weeks: 1600 rows a week come out, but few are moved."""
    day = F.lit("2019-01-07").cast("date")
    weekly = spark.range(40).select(F.lit("i").alias("item_id"), F.col("id").cast("int").alias("store_id"), F.lit(7).alias("city_id"), F.lit(1.0).alias("gross"),
                                    F.lit(0.0).alias("coupon_disc"), F.explode(F.sequence(day, F.date_add(day, 21), F.expr("interval 7 days"))).alias("week_start"))
    spans = spark.range(40).select(F.col("id").alias("activity_id"), F.lit("i").alias("item_id"), F.lit("C").alias("level"), F.lit("01").alias("type_id"),
                                   F.lit("CP").alias("type_code"), F.lit("11").alias("count_code"), F.lit("000000007").alias("area_list"),
                                   F.sequence(day, F.date_add(day, 21), F.expr("interval 7 days")).alias("weeks"))
    keys = ["item_id", "store_id"]
    out = coupon.coupon_rows(weekly, spans, keys)
    assert out.count() == 4 * 40 * 40 and shuffled_rows(out) <= 3 * 160 + 40  # to the store's coupons, then to the city's
    assert shuffled_rows(coupon.coupon_codes(weekly, spans, keys)) <= 3 * 160 + 40
    link = coupon.coupon_link(weekly, spans)
    assert link.where("level = 'C'").count() == 4 * 40 and link.where("activity_id is null").count() == 4 * 40
    assert shuffled_rows(link) <= 40 + 2 * 41 + 41
    assert coupon.coupon_union(weekly, spans).count() == 4 * 40


def test_coupon_rows_without_a_key_meet_nothing(make, rows):
    weekly = make("item_id string, store_id int, city_id int, week_start date, gross double, coupon_disc double", [
        ("i", None, 7, "2019-01-07", 1.0, 0.0), ("i", 2, None, "2019-01-07", 1.0, 0.0), ("i", 3, 7, None, 1.0, 0.0), (None, 4, 7, "2019-01-07", 1.0, 0.0),
        ("i", 5, 7, "2019-01-07", 1.0, 0.0), ("i", 5, 7, "2019-01-07", 2.0, 0.0)])
    weeks = make("activity_id int, item_id string, level string, type_id string, type_code string, count_code string, area_list string, week_start date", [
        (1, "i", "C", "01", "CP", "11", "7", "2019-01-07"), (2, None, "C", "01", "CP", "11", "7", "2019-01-07"), (3, "i", "C", "01", "CP", "11", "7", None),
        (4, "i", "C", "01", "CP", "11", "x", "2019-01-07")])
    keys = ["item_id", "store_id"]
    assert rows(coupon.coupon_rows(weekly, weeks, keys), "store_id", "activity_id") == [(2, None), (3, None), (4, None), (5, 1), (None, 1)]
    assert rows(coupon.coupon_codes(weekly, weeks, keys), "store_id", "gross", "n_type_id") == [
        (2, 1.0, None), (3, 1.0, None), (4, 1.0, None), (5, 1.0, 1), (5, 2.0, 1), (None, 1.0, 1)]
    link = coupon.coupon_link(weekly, weeks).where("level = 'C'")
    assert rows(link, "item_id", "place_id", "week_start", "activity_id") == [
        ("i", 7, "2019-01-07", 1), ("i", 7, None, None), ("i", None, "2019-01-07", None), (None, 7, "2019-01-07", None)]
    assert rows(coupon.coupon_union(weekly, weeks), "place_id", "activity_id") == [(7, 1)]
