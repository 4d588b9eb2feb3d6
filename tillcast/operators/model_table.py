"""Preparing rows for the models: cleaning, dummies, dense weeks, targets and splits."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import business_days, weekend_days
from tillcast.functions.numbers import exact_mean, ratio
from tillcast.functions.windows import series, trailing

MISSING = -1.0
HORIZONS = range(10)


def clean_target(rows: DataFrame, target: str, required: list[str] = (), keep_unknown: bool = False) -> DataFrame:
    """Drop negative targets and rows without the required columns; NULL targets (future
    promotions) stay only on request."""
    ok = F.col(target) >= 0
    if keep_unknown:
        ok = ok | F.col(target).isNull()
    if required:
        rows = rows.dropna(subset=list(required))
    return rows.where(ok)


def promo_length(rows: DataFrame, start: str, end: str) -> DataFrame:
    return rows.withColumns({"business_days": business_days(start, end), "weekend_days": weekend_days(start, end)})


def bulk_ratio(weekly: DataFrame, keys: list[str], rows: int = 52) -> DataFrame:
    """Share of bulk weeks among the series' previous rows; never across series."""
    w = trailing(keys, "week_start", rows)
    return weekly.withColumn("bulk_ratio", ratio(F.sum("bulk").over(w), F.count("bulk").over(w)))


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Missing columns are added with their default; NULLs in present ones are filled with it."""
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent).fillna({c: v for c, v in defaults.items() if c not in absent})


def check_features(df: DataFrame, features: list[str]) -> list[str]:
    """The feature names, after checking that each exists and none is listed twice."""
    missing = [c for c in features if c not in df.columns]
    twice = sorted({c for c in features if features.count(c) > 1})
    if missing or twice:
        raise ValueError(f"missing features {missing}, duplicate features {twice}")
    return features


def categories(df: DataFrame, column: str) -> list:
    """Distinct values of a category column, found on the executors. Each becomes a column of the model, so
    their number is that of columns, not of rows."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def one_hot(df: DataFrame, values: dict[str, list]) -> DataFrame:
    """0/1 columns named <column>__<value>, for given categories; <column>__other marks every value that is
    none of them, NULL included, so that a row without a category never looks like one with."""
    known = {f"{c}__{v}": F.when(F.col(c) == v, 1).otherwise(0) for c, vs in values.items() for v in vs}
    other = {f"{c}__other": F.when(F.col(c).isin(list(vs)), 0).otherwise(1) for c, vs in values.items()}
    return df.withColumns(known | other)


def feature_vector(df: DataFrame, groups: dict[str, list[str]], use: list[str], out: str = "features",
                   fit_on: Column | None = None) -> DataFrame:
    """The features of the chosen groups as one vector; missing numbers take the mean of the rows that
    ``fit_on`` picks (the training rows), of all rows without it."""
    names = check_features(df, [c for g in use for c in groups[g]])
    typed = df.withColumns({c: F.col(c).cast("double") for c in names})
    known = typed if fit_on is None else typed.where(fit_on)
    filled = Imputer(inputCols=names, outputCols=[f"_{c}" for c in names]).fit(known).transform(typed)
    assembled = VectorAssembler(inputCols=[f"_{c}" for c in names], outputCol=out, handleInvalid="keep").transform(filled)
    return assembled.drop(*[f"_{c}" for c in names])


def feature_array(df: DataFrame, groups: dict[str, list[str]], use: list[str], fit_on: Column | None = None) -> DataFrame:
    return feature_vector(df, groups, use, fit_on=fit_on).withColumn("features", vector_to_array("features"))


def category_index(df: DataFrame, columns: list[str], fit_on: Column | None = None) -> DataFrame:
    """``column, value, ix``: the values of category columns, as text, numbered from 0 by falling frequency, then value. The
    fitted index is a table: its rows are the different values, found on the executors."""
    known = df if fit_on is None else df.where(fit_on)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("_p")
    counted = known.select(pairs).select("_p.*").where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("column").orderBy(F.desc("_n"), "value")
    return counted.withColumn("ix", (F.row_number().over(order) - 1).cast("int")).drop("_n")


def category_sizes(index: DataFrame, columns: list[str]) -> list[int]:
    """Number of known values per column."""
    sizes = {r["column"]: r["n"] for r in index.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per column
    return [sizes.get(c, 0) for c in columns]


def indexed(df: DataFrame, index: DataFrame, columns: list[str], sizes: list[int]) -> DataFrame:
    """``<column>__ix`` for each category column; a value that was not seen, and NULL, have a slot of their own after the last."""
    out = df
    for c, n in zip(columns, sizes):
        own = index.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("ix").alias(f"{c}__ix"))
        out = (out.withColumn("_text", F.col(c).cast("string")).join(own, F.col("_text") == F.col("_value"), "left")
               .drop("_text", "_value").withColumn(f"{c}__ix", F.coalesce(f"{c}__ix", F.lit(n))))
    return out


def sparse_features(df: DataFrame, numbers: list[str], columns: list[str], sizes: list[int], fill: dict[str, float] | None = None) -> DataFrame:
    """``size, indices, values`` of one sparse vector: the numbers (missing ones by ``fill``, else 0), then a block of dummies per category
    column (``<column>__ix``) with a slot for unknown values at its end. Zeros are left out."""
    check_features(df, [*numbers, *columns])
    fill = fill or {}
    parts = [F.struct(F.lit(k).alias("at"), F.coalesce(F.col(c).cast("double"), F.lit(float(fill.get(c, 0.0)))).alias("value")) for k, c in enumerate(numbers)]
    start = len(numbers)
    for c, n in zip(columns, sizes):
        parts.append(F.struct((F.lit(start) + F.col(f"{c}__ix")).alias("at"), F.lit(1.0).alias("value")))
        start += n + 1
    kept = F.filter(F.array(*parts), lambda x: x["value"] != 0)
    return df.withColumns({"size": F.lit(start), "indices": F.transform(kept, lambda x: x["at"]), "values": F.transform(kept, lambda x: x["value"]).cast("array<double>")})


def dense_features(df: DataFrame, numbers: list[str], columns: list[str], out: str = "features") -> tuple[DataFrame, np.ndarray]:
    """``features`` for the models: the numbers, missing ones null, then one category number per column; and which are categories."""
    check_features(df, [*numbers, *columns])
    every = [F.col(c).cast("double") for c in numbers] + [F.col(f"{c}__ix").cast("double") for c in columns]
    return df.withColumn(out, F.array(*every)), np.array([False] * len(numbers) + [True] * len(columns))


def training_means(df: DataFrame, numbers: list[str], fit_on: Column | None = None) -> dict[str, float]:
    """Means of the known numbers, exact to six decimals, so that they do not depend on the order of rows."""
    known = df if fit_on is None else df.where(fit_on)
    found = known.agg(*[F.round(exact_mean(F.col(c).cast("double")), 6).alias(c) for c in numbers]).first()
    return {c: found[c] for c in numbers if found[c] is not None}


def densify_weeks(weekly: DataFrame, item: str, store: str) -> DataFrame:
    """Every store of an item with every week of the item's span; missing weeks get quantity -1.

    The grid is spread per series, never crossed over the whole table."""
    span = weekly.groupBy(item).agg(F.min("week_start").alias("_lo"), F.max("week_start").alias("_hi"))
    weeks = F.explode(F.sequence("_lo", "_hi", F.expr("interval 7 days"))).alias("week_start")
    grid = weekly.select(item, store).distinct().join(span, item).select(item, store, weeks)
    return grid.join(weekly, [item, store, "week_start"], "left").fillna(MISSING, ["qty"])


def horizon_targets(dense: DataFrame, keys: list[str], horizons=HORIZONS) -> DataFrame:
    """Targets w0 .. w9: the quantity 0 to 9 weeks on; -1 where that week is missing, NULL past the end."""
    w = series(keys, "week_start")
    return dense.withColumns({f"w{h}": F.lead("qty", h).over(w) if h else F.col("qty") for h in horizons})


def training_rows(targets: DataFrame, horizons=HORIZONS) -> DataFrame:
    """Rows with known quantity; targets of missing weeks become NULL."""
    return targets.where(F.col("qty") != MISSING).withColumns(
        {f"w{h}": F.when(F.col(f"w{h}") != MISSING, F.col(f"w{h}")) for h in horizons})


def skipped_weeks(targets: DataFrame, keys: list[str], horizons=HORIZONS) -> DataFrame:
    """Series weeks that cannot be trained on, with the horizons they are skipped for."""
    gone = F.col("qty") == MISSING
    marks = [F.when(gone | (F.col(f"w{h}") == MISSING), F.lit(str(h))) for h in horizons]
    return (targets.withColumn("skipped", F.concat_ws(",", *marks)).where(F.col("skipped") != "")
            .select(*keys, "week_start", F.when(gone, 1).otherwise(0).alias("missing_sales"), "skipped"))


def split_by_date(rows: DataFrame, day: str, stop, start=None, target: str | None = None) -> DataFrame:
    """``part`` = train before the stop date, test from it on; optionally only rows from a
    start date on with a positive target."""
    if start is not None:
        rows = rows.where(F.col(day) >= F.lit(start).cast("date"))
    if target is not None:
        rows = rows.where(F.col(target) > 0)
    return rows.withColumn("part", F.when(F.col(day) < F.lit(stop).cast("date"), "train").otherwise("test"))


def attach_week(promos: DataFrame, calendar: DataFrame) -> DataFrame:
    """Week key of the promotion start, by calendar."""
    days = calendar.groupBy(F.col("day").alias("promo_start")).agg(F.max("week_key").alias("start_week_key"))
    return promos.join(days, "promo_start", "left")


def hold_features(rows: DataFrame, keys: list[str], features: list[str], start, n_weeks: int = 9) -> DataFrame:
    """Rows from the forecast start on, where time features keep the value of the first test week.

    Features of later weeks are blanked and filled forward within the series; the first
    ``n_weeks`` weeks that end after the start are kept."""
    day = F.lit(start).cast("date")
    week_end = F.date_add("week_start", 6)
    test = rows.where(week_end >= day)
    first = test.agg(F.min("week_start")).scalar()
    w = series(keys, "week_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = {c: F.last(F.when(F.col("week_start") <= F.col("_first"), F.col(c)), ignorenulls=True).over(w) for c in features}
    weeks = test.where(week_end > day).select("week_start").distinct().orderBy("week_start").limit(n_weeks)
    return test.withColumn("_first", first).withColumns(held).drop("_first").join(weeks, "week_start", "left_semi")
