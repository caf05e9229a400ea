"""Random-walk-with-drift forecast of many series at once."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statledger.functions import safe_divide


def drift_forecast(
    series: DataFrame,
    group: str,
    t: str,
    y: str,
    horizon: int = 4,
    level: float = 0.95,
    drift_error: bool = False,
) -> DataFrame:
    """Point forecast and interval per group for the ``horizon`` steps after its last one.

    ARIMA(0,1,0) with drift: the drift is the mean step, the spread that of the
    steps around it. ``drift_error`` widens the interval by the uncertainty of
    the drift. One row per group and step of ``t`` is expected, see ``fill_steps``, so a group is as
    long as the series; a group with fewer than three values has no interval. The drift
    is per elapsed step of ``t``. Two rows of one group and step are an error.
    """
    z = NormalDist().inv_cdf(0.5 + level / 2)
    by_group = Window.partitionBy(group).orderBy(t)
    twice = F.raise_error(F.lit(f"more than one row for a {group} and {t}"))
    step = F.when(F.lag(t).over(by_group) == F.col(t), twice).otherwise(
        F.col(y) - F.lag(y).over(by_group)
    )
    fitted = (
        series.withColumn("_step", step)
        .groupBy(group)
        .agg(
            F.count(y).alias("n"),
            F.max(t).alias("_last_t"),
            (F.max(t) - F.min(t)).alias("_elapsed"),
            F.min_by(y, t).alias("_first"),
            F.max_by(y, t).alias("_last"),
            F.stddev_samp("_step").alias("sigma"),
        )
        .withColumn("drift", safe_divide(F.col("_last") - F.col("_first"), F.col("_elapsed")))
    )
    h = F.col("h")
    variance = h + h * h / F.col("_elapsed") if drift_error else h
    point = F.col("_last") + F.col("drift") * h
    margin = F.lit(z) * F.col("sigma") * F.sqrt(variance)
    return (
        fitted.filter("n > 1")
        .withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .select(
            group,
            (F.col("_last_t") + h).alias(t),
            h,
            "n",
            "drift",
            "sigma",
            point.alias("forecast"),
            (point - margin).alias("lower"),
            (point + margin).alias("upper"),
        )
    )


def order_forecast(
    series: DataFrame, group: str, t: str, y: str, horizon: int = 4, level: float = 0.95
) -> DataFrame:
    """Forecasts per group from the autoregressive order that fits its series best.

    The orders are p lags, 0 to 2, of the values (d = 0) or of their steps (d = 1), each with a constant. All are least
    squares over the same steps, so that their Bayesian information criteria compare; equal ones go to the
    lower d, then p. Everything comes from sums of lagged products, one shuffle for all groups. One row per group
    and step is expected, see ``fill_steps``. A group with fewer than ten values has no row; equal values
    are forecast as such, without spread. Moving averages are not among the orders.
    """
    z = NormalDist().inv_cdf(0.5 + level / 2)
    by_group = Window.partitionBy(group).orderBy(t)
    # Values from the first one on, which keeps the sums of products small.
    since = F.first(y).over(by_group)
    x = [(F.lag(y, k).over(by_group) - since).cast("double").alias(f"_x{k}") for k in range(4)]
    lagged = series.select(group, t, F.col(y).cast("double").alias("_y"), *x)
    whole = F.col("_x3").isNotNull()
    terms = {0: [F.col(f"_x{k}") for k in range(3)], 1: [F.col(f"_x{k}") - F.col(f"_x{k + 1}") for k in range(3)]}
    sums = []
    for d, v in terms.items():
        sums += [F.sum(F.when(whole, v[i])).alias(f"_s{d}{i}") for i in range(3)]
        sums += [F.sum(F.when(whole, v[i] * v[j])).alias(f"_s{d}{i}{j}") for i in range(3) for j in range(i, 3)]
    fitted = (
        lagged.groupBy(group)
        .agg(
            F.count_if(whole).alias("n"),
            F.max(t).alias("_last_t"),
            F.max_by(F.array("_x2", "_x1", "_x0"), t).alias("_recent"),
            (F.min_by("_y", t)).alias("_base"),
            *sums,
        )
        .where("n >= 7")
        .withColumn("_orders", F.array(*[o for d in terms for o in _orders(d)]))
        .withColumn("_best", F.array_min(F.filter("_orders", lambda o: o["score"].isNotNull())))
        .select(group, "n", "_last_t", "_recent", "_base", "_best.*")
    )

    def onward(start: Column, constant: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(horizon)),
            start,
            lambda past, _: F.concat(
                past,
                F.array(
                    constant
                    + F.col("w1") * F.element_at(past, -1)
                    + F.col("w2") * F.element_at(past, -2)
                    + F.col("w3") * F.element_at(past, -3)
                ),
            ),
        )

    # A shock's share in the value some steps later.
    echo = onward(F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)), F.lit(0.0))
    spread = F.aggregate(F.slice("_echo", 3, F.col("h")), F.lit(0.0), lambda total, e: total + e * e)
    point = F.col("_base") + F.element_at("_ahead", F.col("h") + 3)
    margin = F.lit(z) * F.col("sigma") * F.sqrt(spread)
    return (
        fitted.withColumns({"_ahead": onward(F.col("_recent"), F.col("c")), "_echo": echo})
        .withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .select(
            group,
            (F.col("_last_t") + F.col("h")).alias(t),
            "h",
            "n",
            "p",
            "d",
            "sigma",
            point.alias("forecast"),
            (point - margin).alias("lower"),
            (point + margin).alias("upper"),
        )
    )


def _orders(d: int) -> list[Column]:
    """The fits of 0, 1 and 2 lags from the sums over values (``d`` 0) or steps (1)."""
    n = F.col("n")
    mean = [F.col(f"_s{d}{i}") / n for i in range(3)]
    about = {
        (i, j): F.col(f"_s{d}{i}{j}") - F.col(f"_s{d}{i}") * F.col(f"_s{d}{j}") / n
        for i in range(3)
        for j in range(i, 3)
    }
    zero = F.lit(0.0)
    det = about[1, 1] * about[2, 2] - about[1, 2] * about[1, 2]
    slopes = [
        (zero, zero),
        (safe_divide(about[0, 1], about[1, 1]), zero),
        (
            safe_divide(about[0, 1] * about[2, 2] - about[0, 2] * about[1, 2], det),
            safe_divide(about[0, 2] * about[1, 1] - about[0, 1] * about[1, 2], det),
        ),
    ]
    fits = []
    for p, (a, b) in enumerate(slopes):
        rest = F.greatest(about[0, 0] - a * about[0, 1] - b * about[0, 2], zero + a * 0 + b * 0)
        # An exact fit is better than any other.
        score = F.when(rest > 0, n * F.log(rest / n) + (p + 1) * F.log(n)).when(rest == 0, F.lit(-1e308))
        weights = (a, b, zero) if d == 0 else (a + 1, b - a, -b)
        fits.append(
            F.struct(
                score.alias("score"),
                F.lit(d).alias("d"),
                F.lit(p).alias("p"),
                (mean[0] - a * mean[1] - b * mean[2]).alias("c"),
                *[w.alias(f"w{k}") for k, w in enumerate(weights, 1)],
                F.sqrt(rest / (n - (p + 1))).alias("sigma"),
            )
        )
    return fits


def fill_steps(series: DataFrame, group: str, t: str, y: str, end) -> DataFrame:
    """``series`` with a row of value 0 for every step that a group lacks from its first one to ``end``.

    ``end`` is a value or a column, the same for all groups.
    """
    last = end if isinstance(end, Column) else F.lit(end)
    spans = series.groupBy(group).agg(F.min(t).alias("_first"))
    steps = spans.select(group, F.explode(F.sequence("_first", last.cast("bigint"))).alias(t))
    return steps.join(series, [group, t], "left").select(
        group, t, F.coalesce(y, F.lit(0).cast("bigint")).alias(y)
    )


def holdout_check(forecast: DataFrame, actual: DataFrame, group: str, t: str, y: str) -> DataFrame:
    """Forecasts beside the values observed later, and whether the interval held them."""
    seen = actual.select(group, t, F.col(y).alias("actual"))
    return forecast.join(seen, [group, t]).select(
        group,
        t,
        "forecast",
        "lower",
        "upper",
        "actual",
        F.col("actual").between(F.col("lower"), F.col("upper")).alias("in_interval"),
    )
