"""Demand imputation in whole numbers: mean, biases and one factor, by grouped sums alone.

The model of a cell is mean + option bias + minute bias + option factor x minute factor. Every
number is kept in millionths as a whole number, every division is rounded half away from zero,
and the number of rounds is fixed, so any engine that sums exactly gets the same estimates.

1. mean of the training cells; twice: option biases, then minute biases, from what is left,
   each over its cells plus ``shrink``;
2. the minute factor starts as the minute's bias (busy minutes sell more of what sells well); three
   times: option factors, then minute factors, by least squares with a ridge weight per cell;
3. censored cells get the model's value, within [0, the group's largest observed value], rounded half
   to even.

Training cells and gates are those of ``impute``. Each step is a sum over an option or a minute of a
group, written as a window: with the grid partitioned by group it needs no exchange at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockout.operators.grid import GROUP, OPTION

UNIT = 1_000_000
_NUMBER = "decimal(38,0)"


@dataclass(frozen=True)
class RankOneSettings:
    """``shrink``: cells of no deviation added to each bias; ``ridge``: weight per cell, in millionths."""

    bias_rounds: int = 2
    factor_rounds: int = 3
    shrink: int = 1
    ridge: int = 100_000
    min_observed: int = 5


def _whole(value: Column | int) -> Column:
    return (F.lit(value) if isinstance(value, int) else value).cast(_NUMBER)


def rounded_quotient(a: Column, b: Column) -> Column:
    """a / b to the nearest whole number, half away from zero; 0 where b is 0."""
    twice = F.call_function("div", F.abs(a) * _whole(2) + b, b * _whole(2))
    return _whole(F.when(b == 0, F.lit(0)).otherwise(F.when(a < 0, -twice).otherwise(twice)))


def half_even(value: Column) -> Column:
    """Millionths (not negative) to units, half to even."""
    units = F.call_function("div", value, _whole(UNIT))
    rest = value - _whole(units) * _whole(UNIT)
    up = (rest > UNIT // 2) | ((rest == UNIT // 2) & (units % 2 == 1))
    return units + up.cast("long")


def impute_rank_one(censored: DataFrame, settings: RankOneSettings | None = None) -> DataFrame:
    """The grid with ``qty_imputed``, as ``impute.impute_demand`` gives it."""
    s = settings or RankOneSettings()
    group, option, minute = (Window.partitionBy(*k) for k in (GROUP, OPTION, [*GROUP, "ord_ts"]))
    # The first window is by group: where the grid does not lie so, it is shuffled by group here, and
    # every later window, by the group and more, takes it as it lies.
    largest = F.coalesce(F.max(F.when(~F.col("is_censored"), F.col("qty"))).over(group), F.lit(0))
    cells = censored.select(*OPTION, "ord_ts", "qty", "is_censored", "broad_dt").withColumn("top", _whole(largest))
    train = F.col("train")
    total = lambda value, over: _whole(F.coalesce(F.sum(F.when(train, value)).over(over), F.lit(0)))
    cells = cells.withColumn("busy", F.max(F.when(F.col("is_censored") | (F.col("qty") != 0), 1).otherwise(0)).over(option) == 1)
    cells = cells.withColumn("train", F.col("busy") & ~F.col("is_censored"))
    cells = cells.withColumns({
        "n": total(F.lit(1), group),
        "gaps": F.sum(F.when(F.col("busy") & F.col("is_censored"), 1).otherwise(0)).over(group),
        "y": _whole(F.col("qty")) * _whole(UNIT)})
    cells = cells.withColumn("mean", rounded_quotient(total(F.col("y"), group), F.col("n")))
    cells = cells.withColumns({"n_option": total(F.lit(1), option), "n_minute": total(F.lit(1), minute),
                               "by_option": _whole(0), "by_minute": _whole(0)})
    left = F.col("y") - F.col("mean") - F.col("by_option") - F.col("by_minute")
    for _ in range(s.bias_rounds):
        for own, n, over in (("by_option", "n_option", option), ("by_minute", "n_minute", minute)):
            cells = cells.withColumn("left", left + F.col(own))
            bias = rounded_quotient(total(F.col("left"), over), F.col(n) + _whole(s.shrink))
            cells = cells.withColumn(own, F.when(F.col(n) > 0, bias).otherwise(_whole(0)))
    cells = cells.withColumn("left", left).withColumns({"f_option": _whole(0), "f_minute": F.col("by_minute")})
    for _ in range(s.factor_rounds):
        for own, other, n, over in (("f_option", "f_minute", "n_option", option), ("f_minute", "f_option", "n_minute", minute)):
            shared = total(F.col("left") * F.col(other), over)
            weight = total(F.col(other) * F.col(other), over) + F.col(n) * _whole(s.ridge) * _whole(UNIT)
            cells = cells.withColumn(own, rounded_quotient(shared * _whole(UNIT), weight))
    value = (F.col("mean") + F.col("by_option") + F.col("by_minute")
             + rounded_quotient(F.col("f_option") * F.col("f_minute"), _whole(UNIT)))
    bounded = F.greatest(_whole(0), F.least(value, F.col("top") * _whole(UNIT)))
    trainable = (F.col("gaps") >= 1) & (F.col("n") >= s.min_observed)
    imputed = (F.when(~F.col("is_censored"), F.col("qty").cast("double"))
               .when(trainable, half_even(bounded).cast("double")))
    return cells.select(*OPTION, "ord_ts", "qty", "is_censored", "broad_dt", imputed.alias("qty_imputed"))
