import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillcast.operators import boosting, evaluate, forecast, model_table, sales
from tillcast.sources import files, types
from tillcast.sources.tables import date_slice

D = dt.date


def monday(n: int) -> D:
    return D(2018, 1, 1) + dt.timedelta(7 * n)


def weekly(make, rows):
    return make("item string, store int, week_start date, qty double", [(i, s, monday(w), float(q)) for i, s, w, q in rows])


def test_dense_weeks_and_targets(make, rows):
    df = weekly(make, [("i", 1, 0, 5), ("i", 1, 2, 7), ("i", 2, 3, 8), ("j", 1, 9, 1)])
    dense = model_table.densify_weeks(df, "item", "store")
    assert dense.count() == 9  # item i: two stores, four weeks each
    targets = model_table.horizon_targets(dense, ["item", "store"], range(3))
    train = model_table.training_rows(targets, range(3))
    assert rows(train.where("store = 1"), "qty", "w0", "w1", "w2") == [(1.0, 1.0, None, None), (5.0, 5.0, None, 7.0), (7.0, 7.0, None, None)]
    gone = model_table.skipped_weeks(targets.where("store = 1"), ["item", "store"], range(3))
    assert rows(gone, "week_start", "missing_sales", "skipped") == [
        ("2018-01-01", 0, "1"), ("2018-01-08", 1, "0,1,2"), ("2018-01-15", 0, "1"), ("2018-01-22", 1, "0,1,2")]


def test_bulk_ratio_stays_in_its_series(make, rows):
    df = make("k string, week_start date, bulk int", [("a", monday(0), 1), ("a", monday(1), 0), ("a", monday(2), 0), ("b", monday(3), 0)])
    assert rows(model_table.bulk_ratio(df, ["k"]), "week_start", "bulk_ratio") == [
        ("2018-01-01", None), ("2018-01-08", 1.0), ("2018-01-15", 0.5), ("2018-01-22", None)]


def test_cleaning_guards_and_dummies(make, rows):
    df = make("a double, d date", [(-1.0, "2019-01-01"), (0.0, "2019-01-01"), (None, "2019-01-01"), (1.0, None)])
    assert rows(model_table.clean_target(df, "a"), "a") == [(0.0,), (1.0,)]
    assert rows(model_table.clean_target(df, "a", ["d"], keep_unknown=True), "a") == [(0.0,), (None,)]
    filled = model_table.ensure_columns(make("a int", [(None,)]), {"a": 1, "b": 0})
    assert rows(filled, "a", "b") == [(1, 0)]
    with pytest.raises(ValueError, match="missing"):
        model_table.check_features(filled, ["a", "z"])
    with pytest.raises(ValueError, match="duplicate"):
        model_table.check_features(filled, ["a", "a"])
    cats = make("c string", [("x",), ("y",), (None,)])
    assert model_table.categories(cats, "c") == ["x", "y"]
    hot = model_table.one_hot(cats, {"c": ["x"]}).collect()
    assert [(r.c__x, r.c__other) for r in hot] == [(1, 0), (0, 1), (0, 1)]  # no silent zeros
    assert rows(model_table.one_hot(cats, {"c": ["x", "y"]}), "c", "c__x", "c__y") == [("x", 1, 0), ("y", 0, 1), (None, 0, 0)]


def test_split_and_week(make, rows):
    df = make("d date, y double", [("2017-12-31", 1.0), ("2018-01-01", 1.0), ("2018-06-01", 2.0), ("2018-06-02", 0.0)])
    assert rows(model_table.split_by_date(df, "d", "2018-06-01", "2018-01-01", "y"), "d", "part") == [
        ("2018-01-01", "train"), ("2018-06-01", "test")]
    cal = make("day date, week_key int", [("2018-12-31", 201901), ("2018-12-31", 201901)])
    promos = make("promo_start date", [("2018-12-31",), ("2020-01-01",)])
    assert rows(model_table.attach_week(promos, cal), "promo_start", "start_week_key") == [("2018-12-31", 201901), ("2020-01-01", None)]


def test_held_features_never_cross_series(make, rows):
    df = make("k string, week_start date, x double", [("a", monday(0), 1.0), ("a", monday(1), 2.0), ("a", monday(2), 3.0),
                                                      ("b", monday(2), 9.0), ("a", monday(3), 4.0)])
    out = model_table.hold_features(df, ["k"], ["x"], monday(1), n_weeks=2)
    assert rows(out, "k", "week_start", "x") == [("a", "2018-01-08", 2.0), ("a", "2018-01-15", 2.0), ("b", "2018-01-15", None)]


def test_bound_and_order(make, rows):
    df = make("k string, week_start date, forecast double, err2 double", [("a", monday(0), 10.0, 4.0), ("a", monday(1), 5.0, -1.0)])
    out = evaluate.order_quantity(evaluate.confidence_bound(df, 3.0), ["k"], "week_start")
    assert rows(out, "week_start", "upper", "order_qty") == [("2018-01-01", 16.0, 16.0), ("2018-01-08", 8.0, 2.0)]


def test_errors(make, rows):
    df = make("k string, qty double, forecast double", [("a", 10.0, 12.0), ("a", 0.0, 3.0), ("a", 5.0, 4.0)])
    r = evaluate.error_metrics(df, ["k"]).first()
    assert (r.n, r.rel_error, r.abs_error, r.weighted_mape, r.mean_mape) == (3, 4.0, 6.0, 0.4, 0.2)
    curve = evaluate.error_curve(df, ["k"])
    assert rows(curve, "error", "cumulative") == [(-1.0, 5.0), (2.0, 15.0), (3.0, 15.0)]
    assert rows(evaluate.error_curve(df, []), "error", "volume_share") == [(-1.0, 5 / 15), (2.0, 1.0), (3.0, 1.0)]
    assert rows(evaluate.curve_points(curve, ["k"], 0.5, -1.0), "error_at_volume", "volume_at_error", "share_at_zero") == [(2.0, 1.0, 1.0)]
    only_low = evaluate.error_curve(df.where("forecast < qty"), ["k"])
    assert evaluate.curve_points(only_low, ["k"], 0.5, 0.0).first().share_at_zero == 0.0


def test_cap_touches_only_the_forecast(make, rows):
    df = make("n int, forecast double", [(0, -5.0)] + [(i, 1.0) for i in range(1, 1200)] + [(1200, 90.0)])
    out = evaluate.cap_forecast(df)
    top = np.quantile([0.0] + [1.0] * 1199 + [90.0], 0.999)
    assert rows(out.where("n in (0, 1, 1200)"), "n", "forecast") == [(0, 0.0), (1, 1.0), (1200, top)]


def test_item_profile(make):
    values = [3.0, 1.0, 4.0, 1.0, 5.0]
    df = make("item string, qty double", [("a", v) for v in values] + [("b", 2.0)])
    out = {r.item: r for r in evaluate.item_profile(df, "item").collect()}
    a = out["a"]
    assert (a.n, a.mean, a.q25, a.q50, a.q75, a.sum, a.cum_sum) == (5, 2.8, 1.0, 3.0, 4.0, 14.0, 14.0)
    assert abs(a.std - np.std(values, ddof=1)) < 1e-12 and out["b"].std is None
    assert (out["b"].cum_sum, out["b"].cum_share) == (16.0, 1.0)


def test_analysis_filter(make):
    df = make("active int, any_bulk int, any_oos int", [(1, 0, 0), (0, 1, 0), (1, 0, 1), (None, 0, 0)])
    assert evaluate.analysis_filter(df).count() == 1
    r = evaluate.analysis_report(df).first()
    assert (r.n, r.out_of_stock, r.inactive, r.bulk, r.dropped_ratio) == (4, 1, 1, 1, 0.75)


SMALL = boosting.Trees(40, 3, 0.3, columns=1.0, patience=10)


def plain_booster(x, y, xv, yv, trees, category):
    """The same booster by loops over rows and every possible cut, as an independent check."""
    rounds, forecast_, valid, curve = [], [trees.base] * len(y), [trees.base] * len(yv), []

    def goes_left(v, rule):
        f, cut, missing_left = rule
        if np.isnan(v[f]):
            return missing_left
        return v[f] == cut if category[f] else v[f] <= cut

    def node(rows, depth, allowed):
        g, n = sum(forecast_[i] - y[i] for i in rows), len(rows)
        out = {"value": -g / (n + trees.penalty), "gain": 0.0}
        if depth == trees.depth:
            return out
        best = None
        for f in allowed:
            values = sorted({x[i][f] for i in rows if not np.isnan(x[i][f])})
            every = sorted({r[f] for r in x if not np.isnan(r[f])})
            cuts = every if category[f] else [(p + q) / 2 for p, q in zip(every, every[1:])] + [every[-1]] if every else []
            for cut in cuts:
                for missing_left in (False, True):
                    left = [i for i in rows if goes_left(x[i], (f, cut, missing_left))]
                    gl = sum(forecast_[i] - y[i] for i in left)
                    if not 0 < len(left) < n:
                        continue
                    gain = gl ** 2 / (len(left) + trees.penalty) + (g - gl) ** 2 / (n - len(left) + trees.penalty) - g ** 2 / (n + trees.penalty)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, (f, cut, missing_left), left)
            del values
        if best and best[0] > boosting.LEAST_GAIN:
            out["gain"], out["rule"] = best[0], best[1]
            left = set(best[2])
            out["left"], out["right"] = node(best[2], depth + 1, allowed), node([i for i in rows if i not in left], depth + 1, allowed)
            if out["gain"] < trees.gain and "rule" not in out["left"] and "rule" not in out["right"]:
                del out["rule"]
        return out

    def value(tree, v):
        while "rule" in tree:
            tree = tree["left"] if goes_left(v, tree["rule"]) else tree["right"]
        return tree["value"]
    best = 0
    for r in range(trees.iterations):
        allowed = np.flatnonzero(boosting.drawn(len(x[0]), trees.columns, boosting.SEED, r)).tolist()
        tree = node(list(range(len(y))), 0, allowed)
        rounds.append(tree)
        forecast_ = [p + trees.step * value(tree, v) for p, v in zip(forecast_, x)]
        valid = [p + trees.step * value(tree, v) for p, v in zip(valid, xv)]
        curve.append(sum(abs(p - t) for p, t in zip(valid, yv)) / len(yv))
        if curve[-1] < curve[best]:
            best = r
        elif trees.patience and r - best >= trees.patience:
            break
    kept = rounds[:best + 1]
    return lambda v: trees.base + trees.step * sum(value(t, v) for t in kept), curve, len(kept)


def _noisy(seed, n, missing=0.15):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.integers(0, 6, n), rng.integers(0, 4, n), rng.integers(0, 3, n)].astype(float)
    y = 2.0 * x[:, 0] + 7 * (x[:, 2] == 1) + rng.integers(0, 5, n) + np.where(x[:, 1] > 1, 1.5, 0)
    x[:, :2][rng.random((n, 2)) < missing] = np.nan
    return x, y


@pytest.mark.parametrize("trees", [boosting.Trees(12, 3, 0.3, gain=4.0, columns=0.7, patience=5), boosting.Trees(6, 2, 0.5, columns=1.0, patience=0)])
def test_booster_equals_the_plain_one(trees):
    category = np.array([False, False, True])
    for seed in range(4):
        x, y = _noisy(seed, 60)
        xv, yv = _noisy(seed + 50, 30)
        model = boosting.fit_arrays(x, y, trees, (xv, yv), category)
        plain, curve, rounds = plain_booster(x, y, xv, yv, trees, category)
        assert np.allclose(model.curve, curve)
        if trees.patience:
            assert model.rounds == rounds == 1 + int(np.argmin(curve))
            assert np.allclose(model.predict(xv), [plain(v) for v in xv])


def test_only_the_smaller_of_two_nodes_is_summed(monkeypatch):
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 9, (400, 5)).astype(float), rng.integers(0, 50, 400).astype(float)
    x[rng.random(x.shape) < 0.1] = np.nan
    summed, whole = [], boosting.Layout.sums

    def counted(self, columns, at, *rest):
        summed.append(len(at))
        return whole(self, columns, at, *rest)
    monkeypatch.setattr(boosting.Layout, "sums", counted)
    category = np.array([False, False, False, False, True])
    small = boosting.fit_arrays(x, y, boosting.Trees(8, 4, 0.3, gain=200.0), None, category)
    assert max(summed[1:4]) <= 200 and len(summed) <= 32
    # the same trees from the sums of all rows, and the same forecasts from the trees without the rows' last places
    monkeypatch.setattr(boosting.Layout, "level", lambda self, columns, at, gradient, first, width, allowed, above: whole(self, columns, at, gradient, first, width))
    plain = boosting.fit_arrays(x, y, boosting.Trees(8, 4, 0.3, gain=200.0), None, category)
    for a, b in zip(small.trees, plain.trees, strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value, rtol=1e-12, atol=1e-12)
    assert any((t.feature < 0).any() and (t.gain > 0)[t.feature < 0].any() for t in small.trees)  # some splits went again
    assert np.allclose(small.predict(x), plain.predict(x), rtol=1e-12)


def test_patience_sees_past_a_plateau():
    """Two steps of one feature and a validation set that only the second kind of split helps: errors stand still, then fall. A
    patience shorter than the plateau stops in front of it, a longer one finds the best round behind it."""
    rng = np.random.default_rng(0)
    x = np.c_[np.repeat([0.0, 1.0], 60), np.tile(np.repeat([0.0, 1.0], 30), 2)]
    y = 100.0 * x[:, 0] + 2.0 * x[:, 1]
    held = np.c_[np.zeros(20), rng.integers(0, 2, 20)].astype(float)
    aim = 100.5 + 0 * held[:, 0]  # validation rows that the first rounds bring no nearer for a while
    early = boosting.fit_arrays(x, y, boosting.Trees(60, 1, 0.1, columns=1.0, patience=2, base=0.5), (held, aim))
    late = boosting.fit_arrays(x, y, boosting.Trees(60, 1, 0.1, columns=1.0, patience=40, base=0.5), (held, aim))
    assert late.rounds == 1 + int(np.argmin(late.curve)) and late.rounds >= early.rounds
    assert len(early.curve) - early.rounds == 2 or len(early.curve) == 60
    curve = [5.0, 5.0, 6.0, 5.5, 4.0, 4.2, 4.4, 4.1]
    for rounds, stop, best in ((2, 2, 0), (4, 7, 4), (3, 3, 0)):
        watch = boosting._Patience(boosting.Trees(99, 1, 0.1, patience=rounds))
        at = next((k for k, e in enumerate(curve) if watch.done(e)), len(curve) - 1)
        assert (at, watch.best) == (stop, best)


def test_gain_columns_and_sizes():
    x, y = _noisy(3, 80, 0)
    none = boosting.fit_arrays(x, y, boosting.Trees(3, 3, 0.5, gain=1e9, columns=1.0))
    assert all((t.feature < 0).all() for t in none.trees)
    drawn = [boosting.drawn(10, 0.8, 7, r) for r in range(6)]
    assert {int(d.sum()) for d in drawn} == {8} and len({tuple(d) for d in drawn}) > 1
    share = boosting.fit_arrays(x, y, boosting.Trees(20, 3, 0.3, columns=1.0)).importance()
    assert share.sum() == pytest.approx(1) and share.argmax() in (0, 2)
    from tillcast.plans import model
    assert (model.WEEKLY.iterations, model.WEEKLY.depth, model.WEEKLY.step, model.WEEKLY.gain, model.WEEKLY.patience) == (10_000, 4, 0.03, 1.0, 15)
    assert (model.PROMO.iterations, model.PROMO.depth, model.PROMO.step, model.PROMO.gain, model.PROMO.patience) == (1_000, 6, 0.3, 5.0, 20)
    assert (model.WEEKLY_ERRORS.iterations, model.WEEKLY_ERRORS.depth, model.WEEKLY_ERRORS.step, model.WEEKLY_ERRORS.gain) == (100, 4, 0.03, 1.0)
    assert (model.PROMO_ERRORS.iterations, model.PROMO_ERRORS.depth, model.PROMO_ERRORS.gain) == (100, 6, 5.0)


def test_table_and_arrays_give_the_same_model(spark, monkeypatch):
    """A table beyond the bound of one task is fitted by jobs: the same trees, curve and best round."""
    category = np.array([False, False, True])
    x, y = _noisy(1, 200)
    rows = spark.createDataFrame([([None if np.isnan(c) else float(c) for c in v], float(t), k % 4 == 0) for k, (v, t) in enumerate(zip(x, y))],
                                 "features array<double>, y double, held boolean").repartition(3)
    trees = boosting.Trees(5, 2, 0.4, gain=1.0, columns=0.7, patience=3)
    one = boosting.fit(rows, "features", "y", trees, F.col("held"), category)
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 10)
    monkeypatch.setattr(boosting, "STAGE", 2)
    many = boosting.fit(rows, "features", "y", trees, F.col("held"), category)
    assert np.allclose(one.curve, many.curve) and one.rounds == many.rounds
    assert np.allclose(one.predict(x), many.predict(x))
    got = boosting.predicted(rows, one, "features", "f").collect()
    assert np.allclose([r.f for r in got], one.predict(np.array([[np.nan if c is None else c for c in r.features] for r in got])))


def _training(spark):
    rows = [(k, w, float(10 * k + (w % 4)), float(10 * k + ((w + 1) % 4))) for k in range(4) for w in range(40)]
    rows += [(9, 0, 1.0, None), (9, 1, 2.0, 3.0)]  # an item with too few rows
    return spark.createDataFrame(rows, "k int, w int, w0 double, w1 double").withColumns(
        {"week_start": F.expr("date_add(date'2018-01-01', w * 7)"), "store": F.col("w") % 2, "features": F.array((F.col("w") % 4).cast("double"), F.lit(None).cast("double"))})


def test_weekly_models_by_item_and_horizon(spark):
    rows = _training(spark)
    train, test = rows.where("w < 36"), rows.where("w >= 36")
    models = forecast.weekly_models(train, test, "k", ["k", "store"], [0, 1], trees=SMALL, errors=SMALL, names=["phase", "none"])
    out = forecast.weekly_forecast(models, ["k", "store"])
    assert out.count() == 2 * test.count() and out.where("target_week != date_add(week_start, 7 * horizon)").count() == 0
    joined = out.where("horizon = 0").join(test, ["k", "store", "week_start"])
    naive = train.agg(F.avg("w0")).first()[0]
    model, mean = joined.agg(F.avg(F.abs(F.col("forecast") - F.col("w0"))), F.avg(F.abs(F.lit(naive) - F.col("w0")))).first()
    assert model < mean / 5 and out.where("err2 is null or isnan(err2)").count() == 0
    skipped = forecast.skipped_items(train, "k", [0, 1])
    assert sorted(map(tuple, skipped.collect())) == [(9, 0, 2), (9, 1, 1)]
    report = {(r.k, r.horizon): r for r in forecast.model_report(models, skipped, "k").collect()}
    assert len(report) == 10 and sum(r.skipped for r in report.values()) == 2
    assert all(r.n_rows == 36 and 1 <= r.rounds <= 40 and r.mae >= 0 for r in report.values() if not r.skipped)
    top = forecast.top_features(models, "k").collect()
    assert {r.feature for r in top} == {"phase"} and all(r.importance == pytest.approx(1) for r in top)
    folds = forecast.fold_rows(models, ["k", "store"])
    assert folds.count() == 2 * 36 * 4 and folds.where("forecast is null or err2 is null").count() == 0
    # Each group by itself gives what the arrays give: no model sees another item's rows.
    mine = sorted(train.where("k = 2").collect(), key=lambda r: (r.k, r.store, r.week_start))
    fold = {(r.store, r.week_start): r.fold for r in folds.where("k = 2 and horizon = 1").collect()}
    x = np.array([[r.features[0], np.nan] for r in mine])
    _, sales, _, _ = forecast._item_models(x, np.array([r.w1 for r in mine]), np.array([fold[r.store, r.week_start] for r in mine]), 2, SMALL, SMALL, None)
    want = {(r.store, r.week_start): sales.predict(np.array([[r.features[0], np.nan]]))[0] for r in test.where("k = 2").collect()}
    got = {(r.store, r.week_start): r.forecast for r in out.where("k = 2 and horizon = 1").collect()}
    assert got == pytest.approx(want)


def test_folds_mape_and_promo_model(spark):
    rows = forecast.with_folds(_training(spark).withColumn("features", F.array(F.col("k").cast("double"), (F.col("w") % 4).cast("double"))), ["k", "week_start"], 3)
    assert rows.select("k", "w", "fold").collect() == forecast.with_folds(rows.drop("fold"), ["k", "week_start"], 3).select("k", "w", "fold").collect()
    predicted, models = forecast.out_of_fold(rows, "w0", 3, SMALL)
    assert predicted.count() == rows.count() and len(models) == 3
    data = predicted.select("fold", "w0", "forecast").collect()
    per_fold = {f: sum(abs(r.forecast - r.w0) for r in data if r.fold == f) / sum(r.w0 for r in data if r.fold == f) for f in range(3)}
    out = forecast.kfold_mape(predicted, actual="w0").collect()
    assert all(abs(r.mape - per_fold[r.fold]) < 1e-9 and abs(r.mean_mape - np.mean(list(per_fold.values()))) < 1e-9 for r in out)
    test = rows.where("w >= 36").withColumn("w0", F.lit(None).cast("double"))
    found = forecast.promo_forecast(rows.where("w < 36"), test, "w0", ["k", "week_start"], trees=SMALL, errors=SMALL)
    assert found.count() == test.count() and found.where("abs(forecast - (10 * k + w % 4)) > 4").count() <= 2
    with pytest.raises(ValueError, match="few"):
        forecast.promo_forecast(rows.limit(2), test, "w0", ["k"], trees=SMALL)
    model = boosting.fit(rows, "features", "w0", SMALL)
    assert forecast.feature_importance(model, ["k", "phase"], spark, top=1).first().feature == "k"


def test_sparse_features_and_index(make):
    df = make("c string, d int, x double, part string", [("a", 1, 2.0, "t"), ("b", 2, None, "t"), ("b", 1, 4.0, "t"), ("z", None, 0.0, "p"), (None, 2, 1.0, "p")])
    index = model_table.category_index(df, ["c", "d"], F.col("part") == "t")
    assert sorted(map(tuple, index.collect())) == [("c", "a", 1), ("c", "b", 0), ("d", "1", 0), ("d", "2", 1)]
    sizes = model_table.category_sizes(index, ["c", "d"])
    assert sizes == [2, 2]
    rows = model_table.indexed(df, index, ["c", "d"], sizes)
    means = model_table.training_means(df, ["x"], F.col("part") == "t")
    assert means == {"x": 3.0}
    out = model_table.sparse_features(rows, ["x"], ["c", "d"], sizes, means).collect()
    got = {(r.c, r.d): (r.size, r["indices"], r["values"]) for r in out}
    assert got[("a", 1)] == (7, [0, 2, 4], [2.0, 1.0, 1.0]) and got[("b", 2)] == (7, [0, 1, 5], [3.0, 1.0, 1.0])
    assert got[("z", None)] == (7, [3, 6], [1.0, 1.0]) and got[(None, 2)] == (7, [0, 3, 5], [1.0, 1.0, 1.0])
    dense, category = model_table.dense_features(rows, ["x"], ["c", "d"])
    assert category.tolist() == [False, True, True] and {tuple(r.features) for r in dense.collect()} >= {(None, 0.0, 1.0), (0.0, 2.0, 2.0)}


def test_missing_features_take_the_mean(make):
    out = model_table.feature_array(make("a double, b double", [(1.0, 2.0), (None, 4.0), (3.0, None)]), {"g": ["a", "b"]}, ["g"])
    assert [list(r.features) for r in out.collect()] == [[1.0, 2.0], [2.0, 4.0], [3.0, 3.0]]


def test_means_come_from_the_training_rows(make):
    df = make("a double, part string", [(1.0, "train"), (3.0, "train"), (None, "train"), (100.0, "test"), (None, "test")])
    out = model_table.feature_array(df, {"g": ["a"]}, ["g"], F.col("part") == "train").collect()
    assert [r.features[0] for r in out] == [1.0, 3.0, 2.0, 100.0, 2.0]


def test_typing(make, rows):
    text = make("full_item string, store_code string, week string, predict_sales string, predict_error string, upper string, order_prediction string", [
        ("12_3", "7", "201901", "1.5", "x", "2", "3"), ("bad", "1234", "w", "1", "1", "1", "1")])
    out = types.type_results(text)
    assert rows(out, "item_id", "variant_id", "store_code", "item_store", "week_key", "forecast", "predict_error") == [
        (12, 3, "007", "12_3_007", 201901, 1.5, None), (None, None, "1234", "bad_1234", None, 1.0, 1.0)]
    raw = make("a string, b string, c string, id string", [("1", "1", "x", "1"), (None, "2.5", "2", "2"), ("9", "9", "9", None)])
    typed = types.infer_types(raw, ["id"])
    assert dict(typed.dtypes) == {"a": "bigint", "b": "double", "c": "string", "id": "bigint"} and typed.count() == 2


def test_files(spark, make, tmp_path):
    df = make("d date, x int", [("2019-01-01", 1), ("2019-01-02", 2)])
    files.write_csv_extract(df, str(tmp_path / "csv"))
    back = files.read_side_csv(spark, str(tmp_path / "csv"), "d date, x int")
    assert sorted(back.collect()) == sorted(df.collect())
    table = str(tmp_path / "facts")
    assert files.full_refresh(df, str(tmp_path / "whole"), ["d"]).count() == 2
    files.append_increment(df, table, ["d"])
    for _ in range(2):  # a second run replaces its own partition only
        files.append_increment(make("d date, x int", [("2019-01-02", 5), ("2019-01-03", 6)]), table, ["d"])
    assert sorted(r.x for r in spark.read.parquet(table).collect()) == [1, 5, 6]
    calls = []
    build = lambda: calls.append(1) or df
    for _ in range(2):
        assert files.load_if_missing(spark, "side_table", build).count() == 2
    assert calls == [1]
    spark.sql("DROP VIEW side_table")


def test_append_keeps_what_it_does_not_touch(spark, make, tmp_path):
    table, schema = str(tmp_path / "facts"), "year int, k string, x int"
    files.append_increment(make(schema, [(2018, "a", 1), (2018, None, 2), (2019, "a", 3), (2019, "b", 4)]), table, ["year"], ["year", "k"])
    for _ in range(2):
        files.append_increment(make(schema, [(2019, "b", 40), (2019, "c", 50), (2018, None, 20)]), table, ["year"], ["year", "k"])
    got = sorted((r.year, r.k or "", r.x) for r in spark.read.parquet(table).collect())
    assert got == [(2018, "", 20), (2018, "a", 1), (2019, "a", 3), (2019, "b", 40), (2019, "c", 50)]


def test_refresh_switches_only_when_complete(spark, make, tmp_path):
    """A failing job leaves the old version; a reader in between goes on; a result may read the table it replaces."""
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        files.read_current(spark, path)
    old = files.full_refresh(make("x int", [(1,), (2,)]), path)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("x"))
    with pytest.raises(Exception, match="lost"):
        files.full_refresh(broken, path)
    assert sorted(r.x for r in files.read_current(spark, path).collect()) == [1, 2]
    new = files.full_refresh(files.read_current(spark, path).select((F.col("x") * 10).alias("x")), path)
    assert sorted(r.x for r in new.collect()) == [10, 20] and sorted(r.x for r in old.collect()) == [1, 2]
    for n in range(3):
        files.full_refresh(make("x int", [(n,)]), path)
    assert len(files.versions(spark, path)) == 2 and files.read_current(spark, path).first().x == 2
    for n in (5, 6):
        files.save_table(make("x int", [(n,)]) if n == 5 else spark.table("kept_table").selectExpr("x + 1 AS x"), "kept_table")
    assert spark.table("kept_table").first().x == 6
    spark.sql("DROP VIEW kept_table")


def test_carried_weeks_equal_the_full_run(spark):
    """History plus one week after another against a run over everything, with gaps, new series, returns and a year's end."""
    import random
    from tillcast.operators import increment
    draw, rows = random.Random(4), []
    for i in range(5):
        for s in range(3):
            for w in range(draw.choice([0, 0, 125]), 131):
                if draw.random() < 0.6 or w > 127 and i < 4:
                    rows.append((f"i{i}", f"f{i % 2}{i % 3}", f"f{i % 2}", s, monday(w), float(draw.randint(-2, 30)), *[draw.choice([0.0, 1.5]) for _ in range(3)]))
    weekly_ = spark.createDataFrame(rows, "item_id string, sub_family string, family string, store_id int, week_start date, qty double, coupon_disc double, promo_disc double, member_disc double")
    weekly_ = weekly_.withColumn("year", F.year(F.date_add("week_start", 6)))
    first = monday(127)
    full = increment.all_features(weekly_).where(F.col("week_start") >= F.lit(first))
    carried = increment.carried_weeks(weekly_, F.lit(first))
    assert sorted(carried.columns) == sorted(full.columns)
    cols = full.columns
    assert sorted(map(str, carried.select(cols).collect())) == sorted(map(str, full.select(cols).collect()))
    state = increment.initial_state(weekly_)
    per = state.rows.groupBy("item_id", "store_id").count().agg(F.max("count")).first()[0]
    assert per <= increment.KEEP_WEEKS and state.rows.count() < weekly_.count()


def test_date_slice_is_pushed_to_the_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cut = date_slice(lines, "l_shipdate", D(1996, 1, 1), D(1997, 1, 1)).select("l_quantity", "l_shipdate")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "ReadSchema: struct<l_quantity:double,l_shipdate" in plan
    want = lines.where("year(l_shipdate) = 1996").count()
    assert cut.count() == want


def test_weeks_conserve_days(spark):
    from tillcast.plans import shared
    from tillcast.sources.retail import RetailInputs
    src = RetailInputs(spark, "/root/testdata/sf0.001")
    days, weeks = shared.dense_promo(src), shared.dense_weeks(src)
    assert days.agg(F.sum("demand")).first()[0] == weeks.agg(F.sum("qty")).first()[0]
    keys = weeks.select(*shared.DENSE, "week_start")
    assert keys.count() == keys.distinct().count()
    assert sales.calendar_weeks(src.calendar()).where("n_days > 7").count() == 0


def test_rows_per_place_are_counted_once_and_rows_step_down_alike(monkeypatch):
    """All trees of a model have the same rows at the root, so only gradients are summed there; a row's way down is that of its bins."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=(300, 3)), rng.integers(0, 4, 300)])
    x[rng.random(x.shape) < 0.1] = np.nan
    y, category = np.nan_to_num(x[:, 0]) + (x[:, 3] == 2) * 3, np.array([False] * 3 + [True])
    summed, whole = [], boosting.Layout.sums

    def counted(self, columns, at, *rest):
        summed.append(len(at))
        return whole(self, columns, at, *rest)
    monkeypatch.setattr(boosting.Layout, "sums", counted)
    model = boosting.fit_arrays(x, y, boosting.Trees(6, 3, 0.3, columns=1.0), None, category)
    assert summed.count(300) == 1
    binned = boosting.to_bins(x, model.edges, category)
    for tree in model.trees:
        at = np.zeros(300, np.int64)
        for _ in range(3):
            want = []
            for row, node in zip(binned, at):
                f = tree.feature[node]
                b = row[f]
                left = tree.missing_left[node] if b == 0 else b == tree.cut[node] if category[f] else b <= tree.cut[node]
                want.append(node if f < 0 else 2 * node + (1 if left else 2))
            for form in (binned, np.asfortranarray(binned), np.repeat(binned, 2, axis=1)[:, ::2]):
                assert (tree.step_down(form, at, category) == want).all()
            at = np.array(want)


def test_parts_are_put_together_by_column():
    parts = [pd.DataFrame({"a": [1, 2], "b": [0.5, np.nan]}), pd.DataFrame([{"a": 3, "top": [{"feature": "x"}]}])]
    table = forecast._shaped(parts, ["b", "a", "top"])
    assert table.values.tolist() == [[0.5, 1, None], [None, 2, None], [None, 3, [{"feature": "x"}]]]
    assert list(forecast._shaped([], ["a", "b"]).columns) == ["a", "b"] and len(forecast._shaped([], ["a"])) == 0


def test_cuts_are_compared_in_blocks_with_the_same_tree(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=(400, 2)), rng.integers(0, 50, 400)])
    x[rng.random(x.shape) < 0.1] = np.nan
    y, category = np.nan_to_num(x[:, 0]) + (x[:, 2] > 20), np.array([False, False, True])
    fitted = {}
    for places in (1, boosting.PLACES):
        monkeypatch.setattr(boosting, "PLACES", places)
        fitted[places] = boosting.fit_arrays(x, y, boosting.Trees(5, 4, 0.3, columns=1.0), None, category).trees
    for a, b in zip(*fitted.values()):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.value == b.value).all() and (a.missing_left == b.missing_left).all()


def test_the_driver_gets_one_set_of_sums(spark, monkeypatch):
    from tillcast.functions.sums import added_up
    df, got = spark.range(0, 1000, 1, 16), []
    kind, collect = type(df), type(df).collect
    monkeypatch.setattr(kind, "collect", lambda self: got.append(collect(self)) or got[-1])
    total = added_up(df, lambda batch: [batch.column(0).to_numpy().astype(float).sum(keepdims=True), np.ones(2) * batch.num_rows], np.float64)
    assert [t.tolist() for t in total] == [[499500.0], [1000.0, 1000.0]] and [len(g) for g in got] == [1]
    assert added_up(df.where("id < 0"), lambda batch: [np.ones(1)], np.float64) == []


def test_a_kept_step_leaves_no_shuffle_files(spark, tmp_path):
    import time

    from tillcast.sources.retail import RetailInputs
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    src, before = RetailInputs(spark, str(tmp_path)), files()
    kept = src.keep("x", lambda: spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and kept.count() == 10 and src.keep("x", None) is kept
    src.forget("x", "y")
    assert src.keep("x", lambda: spark.range(3)).count() == 3
