"""Series by day, week or month. Rows are aggregated to periods first, so windows stay calendar-sized."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bins import cut
from ..functions.dates import month_key, week_ending_sunday
from ..functions.numbers import safe_ratio
from .ordering import join_null_safe, running_totals

# period -> (label of a moment, step between labels)
_PERIODS = {
    "day": (lambda c: F.to_date(c), "interval 1 day"),
    "week": (week_ending_sunday, "interval 7 days"),
    "month": (lambda c: F.trunc(c, "month"), "interval 1 month"),
}


def monthly_revenue(df: DataFrame, moment: str, revenue: str, order_key: str) -> DataFrame:
    """Sum, mean, count and growth against the previous month that has rows."""
    months = df.groupBy(month_key(F.col(moment)).alias("month")).agg(
        F.sum(revenue).alias("revenue_sum"), F.avg(revenue).alias("aov"),
        F.count(order_key).alias("order_count"),
    )
    return growth(months, "month", "revenue_sum")


def growth(series: DataFrame, label: str, measure: str, name: str = "mom_growth_pct") -> DataFrame:
    """Percent change to the previous row of an aggregated series."""
    before = F.lag(measure).over(Window.orderBy(label))
    return series.withColumn(name, safe_ratio(F.col(measure) - before, before) * 100)


def resample(
    df: DataFrame, moment: str, period: str, measures: Mapping[str, Column],
    fill_zero: Sequence[str] = (), by: Sequence[str] = (),
) -> DataFrame:
    """One row per period between the first and the last, empty ones included."""
    label, step = _PERIODS[period]
    by = list(by)
    filled = df.where(F.col(moment).isNotNull()).groupBy(*by, label(F.col(moment)).alias("period")).agg(
        *[m.alias(n) for n, m in measures.items()]
    )
    spans = filled.groupBy(*by).agg(F.min("period").alias("_a"), F.max("period").alias("_b"))
    calendar = spans.select(
        *by, F.explode(F.sequence("_a", "_b", F.expr(step))).alias("period")
    )
    out = join_null_safe(calendar, filled, [*by, "period"], "left")
    return out.na.fill(0, list(fill_zero)) if fill_zero else out


def unusual_periods(series: DataFrame, measure: str, sigmas: float = 1.5) -> DataFrame:
    """Periods above mean + sigmas * sample deviation of the series."""
    m = series.agg(
        F.struct(F.avg(measure).alias("mean"), F.stddev_samp(measure).alias("dev")).alias("m")
    ).scalar()
    return series.withColumn("threshold", m["mean"] + m["dev"] * sigmas).where(
        F.col(measure) > F.col("threshold")
    )


def min_max_scaled(groups: DataFrame, measure: str, name: str = "scaled") -> DataFrame:
    """(v - min) / (max - min) over an aggregated table."""
    s = groups.agg(F.struct(F.min(measure).alias("a"), F.max(measure).alias("b")).alias("s")).scalar()
    return groups.withColumn(name, safe_ratio(F.col(measure) - s["a"], s["b"] - s["a"]))


def running_revenue(df: DataFrame, moment: str, row_key: str, revenue: str) -> DataFrame:
    """Row-level running total in date order."""
    return running_totals(
        df.select(row_key, moment, revenue), [moment, row_key], {"cumulative": F.col(revenue)}
    )


def prior_rate(df: DataFrame, key: str, moment: str, row_key: str, outcome: str) -> DataFrame:
    """Per row: earlier rows of the same key, their outcomes, and the earlier rate (null for the first).

    One key with very many rows is spread over slices like any other range of the order.
    """
    ran = running_totals(df, [moment, row_key], {
        "_hits": F.col(outcome).cast("bigint"), "_rows": F.lit(1).cast("bigint"),
    }, by=[key])
    return (
        ran.withColumn("prior_count", F.col("_rows") - 1)
        .withColumn("prior_hits", F.col("_hits") - F.col(outcome))
        .withColumn("prior_rate", safe_ratio(F.col("prior_hits"), F.col("prior_count")))
        .drop("_hits", "_rows")
    )


# fixed values: share buckets of the earlier rate
PRIOR_EDGES = [-0.001, 0.0, 0.25, 0.50, 0.75, 1.001]
PRIOR_LABELS = ["0%", "1-25%", "26-50%", "51-75%", "76-100%"]


def rate_by_prior(df: DataFrame, key: str, moment: str, row_key: str, outcome: str) -> DataFrame:
    """Outcome rate by the bucket of the earlier rate; rows without history are left out."""
    with_prior = prior_rate(df, key, moment, row_key, outcome).where("prior_count > 0")
    bucket = cut(F.col("prior_rate"), PRIOR_EDGES, PRIOR_LABELS)
    return with_prior.groupBy(bucket.alias("prior_bucket")).agg(
        F.count("*").alias("n"), F.avg(outcome).alias("rate")
    )


def series_ends(series: DataFrame, label: str, measure: str) -> DataFrame:
    """First and last point, and the two neighbouring labels of the best growth."""
    grown = growth(series, label, measure, "_g").withColumn(
        "_previous", F.lag(label).over(Window.orderBy(label))
    )
    best = F.struct(F.col("_g"), F.col(label))
    known = F.col("_g").isNotNull()
    return grown.agg(
        F.min(label).alias("first_label"), F.min_by(measure, label).alias("first_value"),
        F.max(label).alias("last_label"), F.max_by(measure, label).alias("last_value"),
        F.max_by("_previous", F.when(known, best)).alias("best_growth_from"),
        F.max_by(label, F.when(known, best)).alias("best_growth_to"),
        F.max("_g").alias("best_growth_pct"),
    )


def decompose_monthly(series: DataFrame, value: str, by: Sequence[str] = (), cycle: int = 12) -> DataFrame:
    """Classical additive decomposition of gap-free monthly series, one per key.

    Trend: centred moving average over one cycle with half-weight ends. Seasonal: mean of the
    detrended values per calendar month, centred on zero. Residual: what is left.
    """
    by = list(by)
    order = Window.partitionBy(*by).orderBy("period")
    half = cycle // 2
    around = order.rowsBetween(-half, half)
    ends = F.lag(value, half).over(order) + F.lead(value, half).over(order)
    trend = F.when(
        F.count(value).over(around) == cycle + 1, (F.sum(value).over(around) - ends / 2) / cycle
    )
    step = series.withColumn("trend", trend).withColumn("_month", F.month("period")).withColumn(
        "_detrended", F.col(value) - F.col("trend")
    )
    phase = step.withColumn(
        "_phase", F.avg("_detrended").over(Window.partitionBy(*by, "_month"))
    )
    centre = phase.where("_phase is not null").select(*by, "_month", "_phase").distinct().groupBy(*by).agg(
        F.avg("_phase").alias("_centre")
    )
    if by:
        joined = join_null_safe(phase, centre, by, "left")
    else:
        joined = phase.withColumn("_centre", centre.scalar())
    seasonal = F.col("_phase") - F.col("_centre")
    return joined.select(
        *by, "period", F.col(value).alias("observed"), "trend", seasonal.alias("seasonal"),
        (F.col("_detrended") - seasonal).alias("residual"),
    )


def _local_lines(values: np.ndarray, span: int, at: np.ndarray, trust: np.ndarray) -> np.ndarray:
    """Loess of degree one over evenly spaced values: a weighted line through the ``span`` nearest points of each place.

    Tricube weights times ``trust``. Where no point has weight, the nearest value. A span longer than the series
    takes all points with the bandwidth widened by half of what is missing.
    """
    n, near = len(values), min(span, len(values))
    left = np.clip(np.floor(at).astype(int) - (span - 1) // 2, 0, n - near)
    place = left[:, None] + np.arange(near)
    reach = np.maximum(at - left, left + near - 1 - at) + max(0, span - n) // 2
    gap = np.abs(place - at[:, None]) / np.maximum(reach, 1e-12)[:, None]
    weight = np.where(gap < 1, (1 - gap**3) ** 3, 0.0) * trust[place]
    mass = weight.sum(1)
    share = weight / np.where(mass > 0, mass, 1.0)[:, None]
    centre = (share * place).sum(1)
    spread = (share * (place - centre[:, None]) ** 2).sum(1)
    slope = np.where(spread > 1e-6 * max(n - 1, 1) ** 2, (at - centre) / np.where(spread > 0, spread, 1.0), 0.0)
    fitted = (share * (1 + slope[:, None] * (place - centre[:, None])) * values[place]).sum(1)
    return np.where(mass > 0, fitted, values[np.clip(np.rint(at).astype(int), 0, n - 1)])


def _moving_mean(values: np.ndarray, width: int) -> np.ndarray:
    return np.convolve(values, np.full(width, 1 / width), "valid")


def _odd_from(x: float) -> int:
    whole = int(np.ceil(x))
    return whole + 1 - whole % 2


def _seasonal_and_trend(values: np.ndarray, cycle: int, span: int, rounds: int, passes: int) -> tuple[np.ndarray, np.ndarray]:
    n, places = len(values), np.arange(len(values), dtype=float)
    trend_span, low_span = _odd_from(1.5 * cycle / (1 - 1.5 / span)), _odd_from(cycle + 1)
    seasonal, trend, trust, even = np.zeros(n), np.zeros(n), np.ones(n), np.ones(n)
    for turn in range(rounds + 1):
        for _ in range(passes):
            rest, phases = values - trend, np.zeros(n + 2 * cycle)
            for phase in range(cycle):  # each smoothed on its own and carried one cycle beyond both ends
                own = rest[phase::cycle]
                phases[phase::cycle] = _local_lines(own, span, np.arange(-1.0, len(own) + 1), trust[phase::cycle])
            low = _moving_mean(_moving_mean(_moving_mean(phases, cycle), cycle), 3)
            seasonal = phases[cycle:-cycle] - _local_lines(low, low_span, places, even)
            trend = _local_lines(values - seasonal, trend_span, places, trust)
        if turn < rounds:
            off = np.abs(values - seasonal - trend)
            bound = 6 * np.median(off)
            trust = np.clip(1 - (off / bound) ** 2, 0, None) ** 2 if bound > 0 else even
    return seasonal, trend


def decompose_loess(
    series: DataFrame, value: str, by: Sequence[str] = (), cycle: int = 12, span: int = 7, robust: bool = True,
    label: str = "period",
) -> DataFrame:
    """Seasonal and trend decomposition by local regression (STL) of gap-free series, one per key.

    observed = trend + seasonal + residual. ``span`` (odd, 3 or more) is how many cycles a season is smoothed over. Robust
    fits take 15 rounds of two passes, others one of five. Nulls and not-a-numbers count as zero; a series of
    less than two cycles has null parts; equal labels keep the order of their values.

    Rows are periods, not events: a task holds one key's calendar at a time, and keys are dealt over the tasks.
    """
    if span < 3 or span % 2 == 0 or cycle < 2:
        raise ValueError("span is odd and 3 or more, cycle 2 or more")
    by = list(by)
    slim = series.select(*by, F.col(label).alias("period"), F.col(value).cast("double").alias("observed"))
    rounds, passes = (15, 2) if robust else (0, 5)
    out = T.StructType([*slim.schema.fields, *[T.StructField(c, T.DoubleType()) for c in ("trend", "seasonal", "residual")]])

    def parts(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["period", "observed"], ignore_index=True)
        values = np.nan_to_num(rows["observed"].to_numpy(float), posinf=0.0, neginf=0.0)
        if len(values) < 2 * cycle:
            return rows.assign(trend=np.nan, seasonal=np.nan, residual=np.nan)
        seasonal, trend = _seasonal_and_trend(values, cycle, span, rounds, passes)
        return rows.assign(observed=values, trend=trend, seasonal=seasonal, residual=values - seasonal - trend)

    fitted = slim.groupBy(*by).applyInPandas(parts, out)
    return fitted.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("trend", "seasonal", "residual")})
