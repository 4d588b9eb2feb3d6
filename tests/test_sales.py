import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillcast.operators import bulk, features, promo_join, sales, scope

D = dt.date
PLAN = "k string, promo_id int, promo_start date, promo_end date, price double"


def test_scope(make, rows):
    stores = make("store_id int, territory int, format string", [(1, 1, "L"), (2, 1, "X"), (3, 2, "L"), (4, 1, "L"), (5, 1, "L")])
    closed = make("store_id int, start date, end date", [(4, "2019-01-01", "2019-12-31"), (5, "2019-06-01", "2019-12-31")])
    # start < run date <= end: store 5 closes on the run date itself, so it still counts as open.
    assert rows(scope.open_stores(stores, closed, "2019-06-01", [1], "X"), "store_id") == [(1,), (5,)]
    sold = make("item_id string, brand string, family string, store_id int, sale_date date", [
        ("i", "A", "f", 1, "2019-01-01"), ("i", "A", "f", 1, "2019-01-02"), ("j", "A", "g", 1, "2019-01-01"),
        ("l", "B", "g", 9, "2019-01-01"), ("m", "B", "g", 1, "2019-02-01")])
    rules = {"A": ["f"], "B": ["g"]}
    assert rows(scope.scope_items(sold, rules, "2019-01-01", "2019-02-01", stores), "item_id", "brand") == [("i", "A")]
    assert rows(scope.scope_items(sold, rules, "2019-01-01", "2019-02-02"), "item_id") == [("i",), ("l",), ("m",)]


def test_plan_keeps_campaigns_without_lines(make, rows):
    heads = make("promo_id int, year int, status string", [(1, 2018, "1"), (2, 2018, "-1"), (3, 2017, "1"), (4, 2019, "1")])
    lines = make("promo_id int, version int, item int", [(1, 50, 7), (1, 20, 8), (2, 50, 9)])
    assert rows(scope.promo_plan(heads, lines, 2018, 50), "promo_id", "item") == [(1, 7), (4, None)]
    assert rows(scope.promo_plan(heads, lines, 2018, 50, strict_year=True), "promo_id") == [(4,)]


def test_current_and_next_promo(make, rows):
    lines = make("k string, sale_date date, qty double", [
        ("a", "2019-01-01", 1.0), ("a", "2019-01-03", 2.0), ("a", "2019-01-04", 3.0), ("b", "2019-01-03", 4.0), (None, "2019-01-03", 5.0)])
    plan = make(PLAN, [("a", 1, "2019-01-03", "2019-01-03", 9.0), ("a", 3, "2019-01-10", "2019-01-12", 8.0),
                       ("a", 2, "2019-01-10", "2019-01-20", 7.0), ("z", 4, "2019-01-01", "2019-01-09", 6.0)])
    now = promo_join.current_promo(lines, plan, ["k"], ["price"])
    assert rows(now, "qty", "promo_id", "on_promo", "price") == [
        (1.0, None, 0, None), (2.0, 1, 1, 9.0), (3.0, None, 0, None), (4.0, None, 0, None), (5.0, None, 0, None)]
    nxt = promo_join.next_promo_detail(lines, plan, ["k"], ["price"])
    assert rows(nxt, "qty", "next_promo_id", "days_to_next", "next_price") == [
        (1.0, 1, 2, 9.0), (2.0, 2, 7, 7.0), (3.0, 2, 6, 7.0), (4.0, None, None, None), (5.0, None, None, None)]
    later = promo_join.future_promos(lines, plan, ["k"])
    assert rows(later, "sale_date", "n_future", "first_start", "last_start") == [
        ("2019-01-01", 3, "2019-01-03", "2019-01-10"), ("2019-01-03", 2, "2019-01-10", "2019-01-10"),
        ("2019-01-04", 2, "2019-01-10", "2019-01-10")]


def test_overlapping_promos_repeat_the_sale(make):
    lines = make("k string, sale_date date, qty double", [("a", "2019-01-03", 2.0)])
    plan = make(PLAN, [("a", 1, "2019-01-01", "2019-01-05", 9.0), ("a", 2, "2019-01-03", "2019-01-08", 9.0)])
    assert promo_join.current_promo(lines, plan, ["k"], []).count() == 2


def test_enrich_keeps_every_line(make):
    lines = make("variant_id int, store_id int, sale_date date, qty double", [
        (1, 1, "2018-12-31", 2.0), (1, 1, "2018-12-31", 2.0), (9, 9, "2019-01-01", 1.0), (None, 1, "2019-01-01", 1.0)])
    items = make("variant_id int, item_id string, sub_family string, family string, pack int", [(1, "i", "s", "f", 6), (1, "i", "s", "f", 6)])
    stores = make("store_id int, city_id int, territory int", [(1, 3, 4), (1, 3, 4)])
    free = make("sale_date date, holiday int", [("2019-01-01", 1), ("2019-01-01", 1)])
    out = sales.enrich_sales(lines, items, stores, free)
    assert out.count() == 4
    r = out.where("variant_id = 1").first()
    assert (r.units, r.week_key, r.year, r.dow, r.holiday, r.city_id) == (12.0, 201901, 2018, 2, 0, 3)


def test_out_of_stock_day_takes_the_median_even_without_sale(make, rows):
    start = D(2019, 1, 7)
    stock = [("a", start + dt.timedelta(d), 0.0 if d in (28, 29) else 5.0, "Y" if d == 29 else "N") for d in range(30)]
    sold = [("a", start + dt.timedelta(7 * w), q) for w, q in enumerate([3.0, 5.0, 7.0, 9.0])] + [("a", D(2019, 1, 8), -1.0)]
    stock = make("k string, sale_date date, balance double, stopped string", stock)
    lines = make("k string, sale_date date, qty double", sold).withColumns(
        {c: F.lit(0.0) for c in ("gross", "coupon_disc", "promo_disc", "member_disc")})
    per_day = sales.daily_sales(lines, ["k"])
    carried = make("k string, sale_date date, stopped string", [("a", start + dt.timedelta(d), "Y" if d == 29 else "N") for d in range(20, 30)])
    dense = sales.full_date_sales(stock, carried, lines, ["k"])
    assert dense.count() == 29  # empty and not carried on the last day
    assert rows(dense.where("dow = 2"), "stopped")[:2] == [("N",), ("N",)] and dense.where("stopped is null").count() == 20
    med = sales.oos_median(dense, ["k"])
    # Mondays 3, 5, 7, 9 and the empty day itself (0): the median is 5.
    assert rows(med, "sale_date", "median_qty") == [("2019-02-04", 5.0)]
    out = sales.daily_demand(dense, med, per_day, ["k"])
    assert out.count() == dense.count()
    assert rows(out.where("out_of_stock = 1"), "k", "qty", "demand") == [("a", 0.0, 5.0)]
    assert rows(out.where("sale_date = '2019-01-08'"), "qty", "demand") == [(-1.0, -1.0)]


def test_daily_sales_positive_quantity(make):
    lines = make("k string, sale_date date, qty double, gross double, coupon_disc double, promo_disc double, member_disc double",
                 [("a", "2019-01-01", -2.0, 1.0, 0.5, 0.0, 0.0), ("a", "2019-01-01", 50.0, 2.0, 0.0, 0.0, 0.0)])
    r = sales.daily_sales(lines, ["k"]).first()
    assert (r.qty, r.positive_qty, r.gross, r.coupon_mean, r.any_bulk) == (48.0, 50.0, 3.0, 0.25, 1)


def _weekly(make, values, key=("a", "s")):
    return make("item_id string, store_id string, week_start date, qty double",
                [(*key, D(2018, 1, 1) + dt.timedelta(7 * w), float(q)) for w, q in values])


def test_last_year_falls_back_to_near_weeks(make, rows):
    df = _weekly(make, [(0, 10), (3, 11), (52, 1), (56, 2), (104, 3), (110, 4)])
    out = features.last_year_sales(df, ["item_id", "store_id"])
    # week 52 -> 0; week 56 -> exactly 52 back is 4: nearest earlier within a month is 3;
    # week 104 -> 52; week 110 -> 58 is missing: nearest earlier within a month is 56.
    assert rows(out, "qty", "last_year_qty") == [(1.0, 10.0), (10.0, None), (11.0, None), (2.0, 11.0), (3.0, 1.0), (4.0, 2.0)]
    ahead = features.last_year_sales(_weekly(make, [(3, 7), (52, 1)]), ["item_id", "store_id"])
    assert rows(ahead, "qty", "last_year_qty") == [(1.0, 7.0), (7.0, None)]


def test_trailing_features_do_not_leak(make):
    keys = dict(item=["item_id", "store_id"], sub_family=["sub_family", "store_id"], family=["family", "store_id"])
    add = lambda df: df.withColumns({"sub_family": F.lit("s"), "family": F.lit("f")})
    values = [(w, w + 1) for w in range(20)]
    base = features.rolling_means(add(_weekly(make, values)), **keys)
    changed = features.rolling_means(add(_weekly(make, [(w, q if w < 10 else 99) for w, q in values])), **keys)
    cols = [c for c in base.columns if "mean" in c or c.endswith(("min", "max"))]
    pick = lambda df: df.where(F.col("week_start") <= F.lit(D(2018, 1, 1) + dt.timedelta(70))).orderBy("week_start").select(*cols).collect()
    assert pick(base) == pick(changed)
    assert base.count() == 20
    r = base.orderBy("week_start").collect()[5]
    assert (r.item_mean_4, r.item_mean_12, r.family_min, r.family_max) == (3.5, 3.0, 1.0, 5.0)


def test_share_to_date_counts_whole_earlier_weeks(make, rows):
    df = make("item_id string, store_id string, family string, year int, week_start date, qty double", [
        ("a", "1", "f", 2018, "2018-01-01", 4.0), ("a", "2", "f", 2018, "2018-01-01", 6.0), ("b", "1", "f", 2018, "2018-01-01", 10.0),
        ("a", "1", "f", 2018, "2018-01-08", 1.0), ("a", "2", "f", 2018, "2018-01-08", 1.0)])
    out = features.share_to_date(df, "item_id", "family", "store_id").where("week_start = '2018-01-08'")
    assert rows(out, "store_id", "share_in_store", "share_national") == [("1", 4 / 14, 0.5), ("2", 1.0, 0.5)]


def test_zero_denominators_give_null(make):
    df = _weekly(make, [(0, 0), (1, 5)]).withColumns({c: F.lit(0.0) for c in ("coupon_disc", "promo_disc", "member_disc")})
    out = features.discount_ratio(df, ["item_id", "store_id"]).orderBy("week_start").collect()
    assert [r.discount_ratio for r in out] == [None, None]


def test_next_promo_timing_is_hidden_until_announced(make, rows):
    df = make("week_start date, promo_start date, promo_end date, promo_price double, list_price double, "
              "next_promo_start date, next_promo_end date, next_announced date", [
                  ("2018-12-31", "2018-12-30", "2019-01-08", 5.0, 0.0, "2019-01-20", "2019-01-20", "2019-01-07"),
                  ("2019-01-07", None, None, None, None, "2019-01-20", "2019-01-20", "2019-01-07")])
    out = features.promo_price_features(df)
    assert rows(out, "price_ratio", "weeks_since_start", "weeks_to_end", "weeks_to_next", "next_promo_days", "start_dow") == [
        (None, 1, 1, None, 0, 1), (None, None, None, 1, 0, None)]


def test_barcode_and_climate(make, rows):
    codes = make("item_id string, barcode int, created date, main string, ended date", [
        ("a", 5, "2018-01-02", "Y", None), ("a", 4, "2018-01-02", "Y", None), ("a", 1, "2018-01-01", "N", None),
        ("a", 2, "2018-01-01", "Y", "2018-02-01")])
    assert rows(features.barcode_pick(codes, ["item_id"]), "item_id", "barcode") == [("a", 4)]
    weeks = make("city_id int, week_start date", [(1, "2019-01-07"), (2, "2019-01-07")])
    temps = make("month string, city_id int, high string, low string", [("01", 1, "9.5", "n/a")])
    assert rows(features.climate_join(weeks, temps), "city_id", "high", "low") == [(1, 9.5, None), (2, None, None)]


def test_basket_groups_split_on_gaps(make, rows):
    lines = make("k string, sale_date date, n int", [("a", "2019-01-01", 1), ("a", "2019-01-01", 2), ("a", "2019-01-07", 3),
                                                     ("a", "2019-01-14", 4), ("b", "2019-01-14", 5)])
    assert rows(bulk.basket_groups(lines, ["k"], 7), "n", "group_id") == [(1, 1), (2, 1), (3, 1), (4, 2), (5, 1)]


def test_thresholds_are_capped_and_split(make, rows):
    base = [("i", "s", 1, "2019-01-01", h, float(q), p, 0.0) for h, (q, p) in enumerate([(10, None), (20, None), (400, None), (3, 7)])]
    lines = make("item_id string, sub_family string, store_id int, sale_date date, hour int, qty double, promo_id int, coupon_disc double", base)
    lines = lines.withColumns({"promo_disc": F.lit(0.0), "member_disc": F.lit(0.0)})
    keys = ["item_id", "store_id"]
    assert rows(bulk.bulk_threshold_regular(lines, ["store_id"]), "item_id", "p90") == [("i", 50.0)]
    assert rows(bulk.bulk_threshold_promo(lines, keys[1:]), "sub_family", "p90") == [("s", 3.0)]


def test_abnormal_rule(make, rows):
    cols = "item_id string, store_id int, sub_family string, sale_date date, group_id int, ticket_id int, promo_id int, qty double"
    data = [("i", 1, "s", "2019-01-01", 1, 11, None, 60.0), ("i", 1, "s", "2019-01-02", 2, 12, 7, 60.0), ("i", 2, "s", "2019-01-01", 1, 13, None, 10.0),
            ("i", 3, "s", "2019-01-01", 1, 14, None, 10.0), ("j", 1, "s", "2019-01-01", 1, 15, None, 250.0), ("i", 4, "s", "2019-01-01", 1, 16, None, -5.0)]
    lines = make(cols, data).withColumns({c: F.lit(0.0) for c in ("member_disc", "promo_disc", "coupon_disc")})
    # 175 * log10(2) = 52.7 off promotion, 200 * log10(2) = 60.2 on promotion; ticket 13 is paid by cheque.
    out = bulk.abnormal_groups(lines, make("item_id string, p90 double", [("i", 1.0)]), make("sub_family string, p90 double", [("s", 1.0)]),
                               make("ticket_id int, media_type int", [(13, 2), (13, 2), (14, 1)]), ["item_id", "store_id"])
    assert rows(out, "ticket_id", "abnormal_flag") == [(11, 1), (12, 0), (13, 1), (14, 0), (15, 1)]


def test_code_fill_covers_the_leading_gap(make, rows):
    codes = make("brand string, day date, code int", [("a", "2019-01-03", 7), ("a", "2019-01-05", 8), ("b", "2019-01-01", 1)])
    days = make("day date", [(f"2019-01-0{d}",) for d in range(1, 7)])
    out = bulk.item_code_fill(codes, days, "brand")
    assert [r[1] for r in rows(out.where("brand = 'a'"), "day", "code")] == [7, 7, 7, 7, 8, 8]
    assert out.count() == 12


def test_allocation_rule():
    # The first shipment takes both early sales; the second is used up by a larger sale.
    assert bulk.allocate([(0, 30.0), (10, 5.0)], [(1, 10.0), (2, 20.0), (9, 50.0)], 35) == [(0, 0), (0, 1), (1, 2)]
    # A sale that is too old blocks later shipments only on request.
    assert bulk.allocate([(50, 5.0)], [(0, 1.0), (49, 1.0)], 35) == [(0, 1)]
    assert bulk.allocate([(50, 5.0)], [(0, 1.0), (49, 1.0)], 35, strict_block=True) == []
    # A sale too far ahead waits for the next shipment.
    assert bulk.allocate([(0, 5.0), (40, 5.0)], [(38, 1.0)], 35) == [(1, 0)]
    assert bulk.allocate([(0, 5.0)], [(35, 1.0)], 35) == []


@pytest.mark.parametrize("strict", [False, True])
def test_shipment_match_equals_the_walk(spark, strict):
    """Random sales and shipments of many keys, matched in the plan as ``allocate`` does one after another."""
    draw, day0 = random.Random(11), D(2019, 1, 1)
    rows, want = [], set()
    for k in range(60):
        span = draw.choice([40, 200, 900])
        sold = {draw.randrange(span): (g, float(draw.randint(1, 40))) for g in range(draw.randint(1, 14))}
        ships = {draw.randrange(span): float(draw.choice([0, 5, 30, 80])) for _ in range(draw.randint(1, 9))}
        pairs = [(s, t) for s in sold for t in ships if abs(s - t) <= bulk.BAND_DAYS]
        rows += [(f"k{k}", k % 7, day0 + dt.timedelta(s), *sold[s], day0 + dt.timedelta(t), ships[t]) for s, t in pairs]
        a, b = sorted({t for _, t in pairs}), sorted({s for s, _ in pairs})
        for i, j in bulk.allocate([(t, ships[t]) for t in a], [(s, sold[s][1]) for s in b], bulk.BAND_DAYS, strict):
            want.add((f"k{k}", k % 7, day0 + dt.timedelta(b[j]), *sold[b[j]], day0 + dt.timedelta(a[i]), ships[a[i]]))
    draw.shuffle(rows)
    cand = spark.createDataFrame(rows, "item_id string, store_id int, sale_date date, group_id int, qty double, delivery_date date, delivery_qty double")
    out = bulk.shipment_match(cand, ["item_id", "store_id"], strict)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 40
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "Python" not in plan


def test_dense_events_equal_the_joined_frames(spark):
    """The series laid out from events against the same frames exploded and joined, on random series with negative sales."""
    draw, day0 = random.Random(5), D(2019, 1, 1)
    lines, stock, empty, carried = [], [], [], []
    for k in "abc":
        days = sorted(draw.sample(range(300), 60))
        for d in days:
            for _ in range(draw.randint(1, 2)):
                lines.append((k, 7, day0 + dt.timedelta(d), float(draw.choice([-3, 0, 1, 4, 9, 60])), 2.5, draw.choice([0.0, 0.5]), 0.0, 0.25, draw.random() < 0.8, draw.random() < 0.6))
        gone = {d for d in range(days[0], days[-1] + 1) if draw.random() < 0.15}
        empty += [(k, 7, day0 + dt.timedelta(d)) for d in gone]
        stock += [(k, day0 + dt.timedelta(d), 0.0 if d in gone else 1.0, "N") for d in range(days[0], days[-1] + 1)]
    lines = spark.createDataFrame(lines, "k string, city int, sale_date date, qty double, gross double, coupon_disc double, promo_disc double, member_disc double, sold boolean, on boolean")
    facts = sales.day_facts(lines, ["k", "city"], F.col("sold"), F.col("on"))
    events = sales.dense_events(facts, spark.createDataFrame(empty, "k string, city int, sale_date date"), ["k"], ["city"])
    got = sales.dense_days(events, ["k"], ["city"])
    assort = lines.where("on").select("k", "sale_date", F.lit("N").alias("stopped"))
    sold = sales.daily_sales(lines.where("sold"), ["k"])
    dense = sales.full_date_sales(spark.createDataFrame(stock, "k string, sale_date date, balance double, stopped string"), assort, sold, ["k"])
    medians = sales.oos_median(dense, ["k"])
    want = sales.daily_demand(dense, medians, sold, ["k"])
    columns = want.columns
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    assert medians.count() > 20 and medians.where("median_qty <> 0").count() > 0
    assert sorted(map(str, sales.event_medians(events, ["k"]).select(medians.columns).collect())) == sorted(map(str, medians.collect()))
    assert got.select("k", "sale_date").distinct().count() == got.count()


def test_place_days_equal_the_joins(make, rows):
    plan = make(PLAN, [("a", 1, "2019-01-03", "2019-01-03", 9.0), ("a", 3, "2019-01-10", "2019-01-12", 8.0), ("a", 3, "2019-01-10", "2019-01-12", 7.0),
                       ("a", 2, "2019-01-10", "2019-01-20", 7.0), ("z", 4, "2019-01-01", "2019-01-09", 6.0)])
    daily = make("k string, sale_date date", [(k, f"2019-01-{d:02d}") for k in ("a", "z", "q") for d in range(1, 26)])
    want = promo_join.daily_promo(daily, plan, ["k"])
    got = promo_join.daily_promo_by_place(daily, promo_join.place_days(plan, ["k"], D(2019, 1, 1)), ["k"])
    assert rows(got, *want.columns) == rows(want, *want.columns)


def test_shipment_match_and_removal(make, rows):
    groups = make("item_id string, store_id int, sale_date date, group_id int, qty double, abnormal_flag int", [
        ("i", 1, "2019-01-10", 1, 40.0, 1), ("i", 1, "2019-01-20", 2, 90.0, 1), ("i", 1, "2019-06-01", 3, 9.0, 1),
        ("i", 1, "2019-01-11", 4, 5.0, 0), ("j", 1, "2019-01-10", 1, 40.0, 1)])
    ships = make("item_id string, store_id int, delivery_date date, delivery_qty double", [
        ("i", 1, "2019-01-12", 60.0), ("i", 1, "2019-02-24", 10.0)])
    keys = ["item_id", "store_id"]
    cand = bulk.shipment_candidates(groups, ships, keys)
    assert rows(cand, "group_id", "delivery_date") == [(1, "2019-01-12"), (2, "2019-01-12"), (2, "2019-02-24")]
    links = bulk.shipment_match(cand, keys)
    assert rows(links, "group_id", "qty", "delivery_date", "delivery_qty") == [
        (1, 40.0, "2019-01-12", 60.0), (2, 90.0, "2019-01-12", 60.0)]
    share = bulk.bulk_share(links, keys)
    assert rows(share, "qty", "delivery_qty") == [(130.0, 120.0)]
    lines = make("item_id string, store_id int, group_id int, n int", [("i", 1, 1, 1), ("i", 1, 3, 2), ("j", 1, 1, 3), ("i", 1, None, 4)])
    assert rows(bulk.demand_without_bulk(lines, links, share, keys), "n") == [(2,), (3,), (4,)]
    assert bulk.demand_without_bulk(lines, links, share, keys, limit_percent=100).count() == 4


def test_sketched_thresholds_stay_within_their_rank_error(spark):
    """Weekly sketches, merged, against exact ranks of all hourly quantities; merging some weeks gives those weeks' threshold."""
    lines = spark.range(40_000).select(
        F.concat(F.lit("i"), F.pmod("id", F.lit(3)).cast("string")).alias("item_id"), F.lit("s").alias("sub_family"), F.lit(1).alias("store_id"),
        F.expr("date_add(date'2019-01-01', cast(id % 200 as int))").alias("sale_date"), F.col("id").alias("hour"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("qty"), F.when(F.col("id") % 5 == 0, 1).alias("promo_id"),
        *[F.lit(0.0).alias(c) for c in ("coupon_disc", "promo_disc", "member_disc")])
    sketches = bulk.quantity_sketches(lines, ["item_id", "store_id"])
    found = {(r.branch, r.key): r for r in bulk.sketched_thresholds(sketches).collect()}
    assert len(found) == 4 and sum(r.n for r in found.values()) == 40_000
    for (branch, key), r in found.items():
        own = lines.where("promo_id is not null") if branch == "promo" else lines.where((F.col("item_id") == key) & F.col("promo_id").isNull())
        below, upto, n = own.agg(F.count_if(F.col("qty") < r.quantile), F.count_if(F.col("qty") <= r.quantile), F.count("*")).first()
        assert n == r.n and below / n - bulk.RANK_ERROR <= 0.9 <= upto / n + bulk.RANK_ERROR and r.p90 == 50.0
    early = bulk.sketched_thresholds(sketches.where("week_start < '2019-03-01'")).agg(F.sum("n")).first()[0]
    assert early == lines.where("trunc(sale_date, 'week') < '2019-03-01'").count()


def test_pieces_of_weeks_equal_days(spark, make):
    """Weeks summed from pieces, and regular days picked from them, against the days laid out; with promotions that overlap, a place
    without any, a null key, days out of stock at either end of a run, negative and missing values."""
    from tillcast.operators import day_split
    draw, day0 = random.Random(11), D(2018, 12, 26)
    facts, empty = [], []
    for k, city in (("a", 1), ("b", 1), ("c", 2), (None, 1), ("d", None), ("e", 3)):
        days = sorted(draw.sample(range(150), 25))
        for d in days:
            qty = draw.choice([None, -2.0, 0.0, 3.0, 8.0])
            facts.append((k, city, day0 + dt.timedelta(d), qty, draw.choice([None, 2.5]), 0.5, 0.0, 0.25, draw.choice([None, 0.25]), 1.5,
                          draw.choice([None, 0.125, 0.5]), 0.1, draw.choice([0, 1]), draw.choice([0, 1])))
        empty += [(k, city, day0 + dt.timedelta(d)) for d in range(days[0], days[-1] + 1) if draw.random() < 0.2]
    facts = make("k string, city int, sale_date date, qty double, gross double, coupon_disc double, promo_disc double, member_disc double, coupon_min double, "
                 "coupon_max double, coupon_mean double, coupon_std double, any_bulk int, carried int", facts)
    events = sales.dense_events(facts, make("k string, city int, sale_date date", empty), ["k"], ["city"])
    plan = make("city int, promo_id int, promo_start date, promo_end date, promo_price double, list_price double, slot int, announced date", [
        (1, 1, "2019-01-03", "2019-01-16", 9.0, 10.0, 1, "2018-12-10"), (1, 2, "2019-01-10", "2019-01-12", 8.0, 10.0, 1, None),
        (1, 3, "2019-03-08", "2019-03-10", 8.0, 10.0, 1, None), (2, 4, "2019-02-01", "2019-02-01", 8.0, 10.0, 1, None),
        (2, 5, "2019-02-01", "2019-02-20", 8.0, 10.0, 1, None), (None, 6, "2019-01-01", "2019-03-01", 8.0, 10.0, 1, None)])
    place = promo_join.place_days(plan, ["city"], day0)
    daily = promo_join.daily_promo_by_place(sales.dense_days(events, ["k"], ["city"]), place, ["city"])
    weeks = (spark.range(30).select(F.expr("date_add(date'2018-12-24', cast(id * 7 as int))").alias("week_start"))
             .withColumn("holiday_days", F.when(F.weekofyear("week_start") == 1, 1).otherwise(0)))
    pieces = sales.dense_pieces(events, ["k"], ["city"])
    want = sales.weekly_sales(daily, weeks, plan, ["k"], ["city"])
    got = sales.weekly_sales(pieces, weeks, plan, ["k"], ["city"], place, sales.place_weeks(place, ["city"]))
    assert got.dtypes == want.dtypes and want.where("n_current > 1").count() > 1 and want.where("n_next > 1").count() > 0
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    calendar = make("week_start date", [("2018-12-24",), ("2019-07-01",)])
    a, b = (day_split.regular_days(d, want, calendar, ["k"]) for d in (daily, pieces))
    assert a.dtypes == b.dtypes and a.count() > 100 and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    some = F.col("week_start").isin(D(2019, 1, 7), D(2019, 2, 4))
    few = sales.dense_days(events, ["k"], ["city"], some)
    assert sorted(map(str, few.collect())) == sorted(map(str, sales.dense_days(events, ["k"], ["city"]).where(
        F.trunc("sale_date", "week").isin(D(2019, 1, 7), D(2019, 2, 4))).collect()))
    plan_text = b._jdf.queryExecution().executedPlan().toString()
    assert plan_text.index("posexplode(sequence(sale_date") < plan_text.index("LeftSemi")  # the days come after the choice of weeks
