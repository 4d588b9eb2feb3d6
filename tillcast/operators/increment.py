"""Weekly features carried from run to run.

A run for one more week needs of the past: the last 52 rows of each series and of its levels (trailing means go by rows), the rows of
57 weeks (last year's sales), and running totals (smallest and largest week of a family, weeks with sales and with a discount,
sales of the year to date). ``State`` holds just that. ``next_week`` gives the features of the new week's rows, for which it
reads the state of those series only; ``advanced`` gives the state after it. Both give what a run over the whole history does."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.lineage import discard, drop_shuffles, is_kept, materialise
from tillcast.functions.numbers import exact_mean, flag, ratio
from tillcast.functions.windows import trailing
from tillcast.operators import features

ITEM, SUB_FAMILY, FAMILY = ["item_id", "store_id"], ["sub_family", "store_id"], ["family", "store_id"]
LEVELS = {"family": FAMILY, "sub_family": SUB_FAMILY}
TOTALS = {"_item_store": ["item_id", "store_id"], "_family_store": ["family", "store_id"], "_item": ["item_id"], "_family": ["family"]}
KEEP_ROWS, KEEP_WEEKS = max(features.LENGTHS), 57
PER_ITEM = [f"{name}_per_item" for name in LEVELS]


@dataclass(frozen=True)
class State:
    """What a run needs of the weeks before. ``rows`` and ``levels`` hold weekly rows, the others a row per key."""

    rows: DataFrame
    levels: dict[str, DataFrame]
    extremes: DataFrame
    counts: DataFrame
    to_date: dict[str, DataFrame]

    def frames(self) -> list[DataFrame]:
        return [self.rows, *self.levels.values(), self.extremes, self.counts, *self.to_date.values()]


def all_features(weekly: DataFrame) -> DataFrame:
    """The same features of every row, from the whole history."""
    out = features.rolling_means(weekly, ITEM, SUB_FAMILY, FAMILY)
    out = features.share_to_date(out, "item_id", "family", "store_id")
    out = features.discount_ratio(out, ITEM)
    out = features.family_item_ratio(out, ITEM, LEVELS)
    return features.last_year_sales(out, ITEM)


def _per_item(rows: DataFrame) -> DataFrame:
    """Sales per item of the row's family and sub family in its store and week."""
    out = rows
    for name, keys in LEVELS.items():
        per = rows.groupBy(*keys, "week_start").agg(ratio(F.sum("qty"), F.count(F.lit(1))).alias(f"{name}_per_item"))
        out = out.join(per, [*keys, "week_start"], "left")
    return out


def _level(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "week_start").agg(F.sum("qty").alias("qty"))


def _latest(rows: DataFrame, keys: list[str], until) -> DataFrame:
    """The last ``KEEP_ROWS`` rows of each key, and all rows of the ``KEEP_WEEKS`` weeks up to ``until``."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("week_start")))
    recent = F.col("week_start") > F.date_sub(until, 7 * KEEP_WEEKS)
    return rows.withColumn("_nth", nth).where((F.col("_nth") <= KEEP_ROWS) | recent).drop("_nth")


def _counts(rows: DataFrame) -> DataFrame:
    discounted = (F.col("coupon_disc") > 0) | (F.col("promo_disc") > 0) | (F.col("member_disc") > 0)
    return rows.groupBy(*ITEM).agg(F.sum(flag(discounted)).alias("_discounted"), F.sum(flag(F.col("qty") > 0)).alias("_sold"))


def _to_date(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    return rows.groupBy(*keys, "year").agg(F.sum("qty").alias(name))


def initial_state(weekly: DataFrame, stored: bool = False) -> State:
    """The state after all rows of ``weekly``, kept. ``stored``: these are read from a table, so need not be written for this."""
    weekly = weekly if stored else materialise(weekly)
    last = weekly.agg(F.max("week_start")).scalar()
    levels = {n: _level(weekly, keys) for n, keys in LEVELS.items()}
    extremes = levels["family"].groupBy(*FAMILY).agg(F.min("qty").alias("family_min"), F.max("qty").alias("family_max"))
    year = weekly.agg(F.max("year")).scalar()
    state = State(_latest(_per_item(weekly), ITEM, last), {n: _latest(levels[n], LEVELS[n], last) for n in levels}, extremes, _counts(weekly),
                  {n: _to_date(weekly.where(F.col("year") == year), keys, n) for n, keys in TOTALS.items()})
    kept = _kept(state)
    discard(weekly)
    return kept


def _kept(state: State) -> State:
    return State(_put(state.rows), {n: _put(f) for n, f in state.levels.items()}, _put(state.extremes),
                 _put(state.counts), {n: _put(f) for n, f in state.to_date.items()})


def _put(step: DataFrame) -> DataFrame:
    """``materialise``, after which the step's exchanges leave the disks."""
    kept = materialise(step)
    drop_shuffles(kept.sparkSession)
    return kept


def _of(state: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The part of a state that belongs to keys of the new rows."""
    return state.join(new.select(*keys).distinct(), keys, "left_semi")


def next_week(state: State, new: DataFrame) -> DataFrame:
    """The rows of one new week (all of them, later than the state) with the features of ``all_features``."""
    rows = _per_item(new)
    both = _of(state.rows, new, ITEM).withColumn("_new", F.lit(False)).unionByName(rows.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    means = {f"item_mean_{n}": F.avg("qty").over(trailing(ITEM, "week_start", n)) for n in features.LENGTHS}
    means |= {f"{c}_{n}": exact_mean(c, trailing(ITEM, "week_start", n)) for c in PER_ITEM for n in features.LENGTHS}
    out = features.last_year_sales(both.withColumns(means), ITEM).where("_new").drop("_new")
    for name, keys in LEVELS.items():
        level = _level(new, keys)
        past = _of(state.levels[name], new, keys)
        trail = features.level_means(past.unionByName(level), keys, name).join(level.select(*keys, "week_start"), [*keys, "week_start"], "left_semi")
        out = out.join(trail, [*keys, "week_start"], "left")
    out = out.join(state.extremes, FAMILY, "left").join(state.counts, ITEM, "left")
    for name, keys in TOTALS.items():
        out = out.join(state.to_date[name], [*keys, "year"], "left")
    return out.withColumns({
        "discount_ratio": ratio("_discounted", "_sold"), "share_in_store": ratio("_item_store", "_family_store"),
        "share_national": ratio("_item", "_family")}).drop("_discounted", "_sold", *TOTALS)


def advanced(state: State, new: DataFrame) -> State:
    """The state after one more week, kept."""
    week, year = new.agg(F.max("week_start")).scalar(), new.agg(F.max("year")).scalar()
    levels = {n: _level(new, keys) for n, keys in LEVELS.items()}
    family = levels["family"].select(*FAMILY, F.col("qty").alias("family_min"), F.col("qty").alias("family_max"))
    return _kept(State(
        _latest(state.rows.unionByName(_per_item(new).select(state.rows.columns)), ITEM, week),
        {n: _latest(state.levels[n].unionByName(levels[n].select(state.levels[n].columns)), keys, week) for n, keys in LEVELS.items()},
        state.extremes.unionByName(family).groupBy(*FAMILY).agg(F.min("family_min").alias("family_min"), F.max("family_max").alias("family_max")),
        state.counts.unionByName(_counts(new)).groupBy(*ITEM).agg(F.sum("_discounted").alias("_discounted"), F.sum("_sold").alias("_sold")),
        {n: state.to_date[n].unionByName(_to_date(new, keys, n)).where(F.col("year") == year).groupBy(*keys, "year").agg(F.sum(n).alias(n))
         for n, keys in TOTALS.items()}))


def carried_weeks(weekly: DataFrame, first) -> DataFrame:
    """The features of all weeks from ``first`` on, week by week from the state of the weeks before; one table per week is kept. The
    driver walks over weeks, of which a run has one or a few."""
    weekly = weekly if is_kept(weekly) else _put(weekly)
    state = initial_state(weekly.where(F.col("week_start") < first), stored=True)
    weeks = [r[0] for r in weekly.where(F.col("week_start") >= first).select("week_start").distinct().orderBy("week_start").collect()]
    out = []
    for k, week in enumerate(weeks):
        new = weekly.where(F.col("week_start") == F.lit(week))
        out.append(_put(next_week(state, new)))
        if k + 1 < len(weeks):
            later = advanced(state, new)
            discard(*state.frames())
            state = later
    return reduce(DataFrame.unionByName, out)
