import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.functions import dates
from tillcast.functions.joins import explode_days, next_event, points_in_ranges
from tillcast.functions.lineage import discard, materialise, release, shared_folder
from tillcast.functions.numbers import exact_mean, ratio, total
from tillcast.functions.running import exact_quantile, running_total
from tillcast.functions.texts import code_list, has_code, has_none_of, padded

D = dt.date


def test_weeks_at_year_end(make, rows):
    df = make("day date", [("2018-12-30",), ("2018-12-31",), ("2019-01-01",), ("2021-01-03",)])
    out = df.select("day", dates.week_key("day").alias("k"), dates.week_start("day").alias("w"))
    assert rows(out, "day", "k", "w") == [
        ("2018-12-30", 201852, "2018-12-24"), ("2018-12-31", 201901, "2018-12-31"),
        ("2019-01-01", 201901, "2018-12-31"), ("2021-01-03", 202053, "2020-12-28")]
    gap = make("a date, b date", [("2019-01-01", "2018-12-30")]).select(dates.weeks_between("a", "b")).first()[0]
    assert gap == 1


def test_business_days_match_numpy(make):
    random.seed(1)
    pairs = [(D(2018, 1, 1) + dt.timedelta(random.randrange(900)), D(2018, 1, 1) + dt.timedelta(random.randrange(900)))
             for _ in range(300)] + [(D(2019, 1, 5), D(2019, 1, 5)), (D(2019, 1, 6), D(2019, 1, 7))]
    got = make("a date, b date", pairs).select("a", "b", dates.business_days("a", "b").alias("n"),
                                               dates.weekend_days("a", "b").alias("w")).collect()
    for r in got:
        want = np.busday_count(r.a, r.b)
        assert (r.n, r.w) == (want, (r.b - r.a).days - want)


def test_ratio_and_exact_sums(make):
    r = make("a double, b double", [(1.0, 0.0)]).select(ratio("a", "b")).first()
    assert r[0] is None
    df = make("x double", [(0.1,)] * 10 + [(None,)])
    out = df.agg(total("x").alias("t"), exact_mean("x").alias("m")).first()
    assert (out.t, out.m) == (1.0, 0.1)
    assert df.where("x > 5").agg(exact_mean("x")).first()[0] is None


def test_code_lists(make, rows):
    df = make("k int, c string", [(1, "MPM"), (1, "MPM"), (2, "MP"), (2, "CP"), (3, None)])
    lists = df.groupBy("k").agg(code_list("c").alias("codes"))
    out = lists.select("k", "codes", has_code("codes", "MP").alias("sub"), has_code("codes", "MP", True).alias("exact"),
                       has_none_of("codes", ["CP", "MP"]).alias("none"),
                       has_none_of("codes", ["CP", "MP"], True).alias("none_exact"))
    # MPM holds MP as text; a group without codes has no list and no "other" either.
    assert rows(out, "k", "codes", "sub", "exact", "none", "none_exact") == [
        (1, "MPM", 1, 0, 0, 1), (2, "CP,MP", 1, 1, 0, 0), (3, None, 0, 0, 0, 0)]


def test_explode_days_skips_empty_periods(make):
    df = make("k int, a date, b date", [(1, "2019-01-01", "2019-01-03"), (2, "2019-01-05", "2019-01-04"), (3, None, "2019-01-01")])
    assert [(r.k, r.d.day) for r in explode_days(df, "a", "b", "d").collect()] == [(1, 1), (1, 2), (1, 3)]


def test_range_join_equals_brute_force(make):
    random.seed(2)
    day = lambda: D(2018, 1, 1) + dt.timedelta(random.randrange(400))
    ranges = [(random.choice("ab"), i, *sorted([day(), day()])) for i in range(60)] + [("a", 99, D(2019, 1, 1), D(2018, 1, 1))]
    points = [(random.choice("abc"), j, day()) for j in range(200)]
    want = sorted((i, j) for k, i, lo, hi in ranges for q, j, p in points if k == q and lo <= p <= hi)
    for bucket in (1, 30, 1000):
        out = points_in_ranges(make("k string, i int, lo date, hi date", ranges), make("k string, j int, p date", points),
                               ["k"], "lo", "hi", "p", bucket)
        assert sorted((r.i, r.j) for r in out.collect()) == want


def test_next_event_is_strict_and_breaks_ties(make, rows):
    days = make("k string, d date", [("a", "2019-01-01"), ("a", "2019-01-01"), ("a", "2019-01-05"), ("a", "2019-02-01"),
                                     ("b", "2019-01-01"), (None, "2019-01-01")])
    events = make("k string, e date, id int", [("a", "2019-01-05", 7), ("a", "2019-01-05", 3), ("a", "2019-01-20", 1),
                                               ("c", "2019-01-20", 9), (None, "2019-01-20", 9)])
    out = next_event(days, events, ["k"], "d", "e", ["id"], "id")
    assert rows(out, "k", "d", "e", "id") == [
        ("a", "2019-01-01", "2019-01-05", 3), ("a", "2019-01-05", "2019-01-20", 1), ("a", "2019-02-01", None, None),
        ("b", "2019-01-01", None, None), (None, "2019-01-01", "2019-01-20", 9)]


def test_running_total_equals_cumsum(make):
    random.seed(3)
    data = [(random.choice("ab"), i, round(random.uniform(-50, 50), random.choice([0, 1])), float(random.randrange(9)))
            for i in range(400)]
    df = make("k string, i int, x double, v double", data)
    got = {r.i: r.c for r in running_total(df, ["k"], "x", "v", "c").collect()}
    for k, i, x, _ in data:
        assert got[i] == sum(v for kk, _, xx, v in data if kk == k and xx <= x)
    whole = {r.i: r.c for r in running_total(df, [], "x", "v", "c", ["i"]).collect()}
    for k, i, x, _ in data:
        assert whole[i] == sum(v for _, ii, xx, v in data if (xx, ii) <= (x, i))


def test_crowded_values_are_spread(spark):
    """All values in a narrow stretch: the ranges follow the values, not a fixed scale."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).select((F.col("id") * 7919 % 20000 / 20000 * 0.015).alias("x"), F.lit(1).alias("n")).repartition(4)
        kept = running_total(df, [], "x", "n", "c")
        assert kept.agg(F.max("c"), F.countDistinct("c")).first()[:2] == (20000, 20000)
        assert kept.where("c != rint(x / 0.015 * 20000) + 1").count() == 0
        sizes = [r["count"] for r in df.repartitionByRange("x").groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.6 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_quantile_equals_numpy(make, spark):
    random.seed(4)
    xs = [round(random.lognormvariate(2, 1), 2) for _ in range(501)] + [3.0] * 200
    df = make("x double", [(x,) for x in xs] + [(None,)])
    for q in (0.0, 0.25, 0.5, 0.9, 0.999, 1.0):
        got = spark.range(1).select(exact_quantile(df, "x", q).alias("q")).first().q
        assert abs(got - np.quantile(xs, q)) < 1e-9


def test_padding_never_cuts(make, rows):
    out = make("n bigint", [(7,), (1000000001,), (None,)]).select(padded("n", 9).alias("p"))
    assert rows(out, "p") == [("000000007",), ("1000000001",), (None,)]


def test_local_folder_without_the_setting(spark, make, monkeypatch):
    class Conf:  # a session whose settings name no folder, and which must not be changed
        def get(self, *_):
            return None

        def set(self, *_):
            raise AssertionError("no setting is written")

    class Context:
        applicationId, master = "test-app", "local[2]"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    folder = shared_folder(Session())
    assert folder == shared_folder(Session()) and "tillcast-" in folder
    Context.master = "spark://somewhere"
    with pytest.raises(RuntimeError):
        shared_folder(Session())


def test_release_deletes_what_was_kept(spark, make):
    path = materialise(make("a int", [(1,)])).inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and release(spark) >= 1 and not os.path.exists(path)


def test_materialise_uses_the_named_folder(spark, make):
    out = materialise(make("a int", [(1,), (2,)]))
    assert out.agg(F.sum("a")).first()[0] == 3
    assert out.inputFiles()[0].removeprefix("file://").startswith(shared_folder(spark))


def test_discard_deletes_only_what_it_is_given(spark, make):
    one, two = materialise(make("a int", [(1,)])), materialise(make("a int", [(2,)]))
    paths = [f.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0] for f in (one, two)]
    discard(one, make("a int", [(3,)]))
    assert not os.path.exists(paths[0]) and two.first().a == 2
