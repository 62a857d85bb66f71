"""Histograms, box plots, density curves and break-even bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bins import equal_width_bin, equal_width_edges, histogram_bin, interval_label
from .ordering import exact_quantiles, join_null_safe, known
from .quality import nan_as_missing


def _span(df: DataFrame, value: str, widen_by: Column) -> Column:
    """Lowest and highest value as one scalar, moved apart when they are the same."""
    low, high = F.min(value).cast("double"), F.max(value).cast("double")
    pad = F.when(low == high, widen_by).otherwise(F.lit(0.0))
    return df.agg(F.struct((low - pad).alias("low"), (high + pad).alias("high")).alias("s")).scalar()


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts per equal-width bin over the global range (a single value gets a range of one); NaN is missing."""
    kept = nan_as_missing(df).where(F.col(value).isNotNull())
    span = _span(kept, value, F.lit(0.5))
    number = histogram_bin(F.col(value), span["low"], span["high"], bins)
    counts = kept.select(*by, number.alias("bin")).groupBy(*by, "bin").agg(F.count("*").alias("n"))
    step = (span["high"] - span["low"]) / bins
    return counts.select(
        *by, "bin", (span["low"] + step * (F.col("bin") - 1)).alias("left_edge"),
        (span["low"] + step * F.col("bin")).alias("right_edge"), "n",
    )


def density_histogram(df: DataFrame, value: str, group: str, bins: int) -> DataFrame:
    """Each group over its own range, normalised to area one."""
    kept = known(df, value, group)
    spans = kept.groupBy(group).agg(
        F.min(value).cast("double").alias("_low"), F.max(value).cast("double").alias("_high"),
        F.count("*").alias("_n"),
    )
    pad = F.when(F.col("_low") == F.col("_high"), 0.5).otherwise(0.0)
    spans = spans.select(group, "_n", (F.col("_low") - pad).alias("_low"), (F.col("_high") + pad).alias("_high"))
    counts = kept.groupBy(group, value).agg(F.count("*").alias("_c"))
    binned = join_null_safe(counts, spans, [group]).withColumn(
        "bin", histogram_bin(F.col(value), F.col("_low"), F.col("_high"), bins)
    )
    step = (F.col("_high") - F.col("_low")) / bins
    return (
        binned.groupBy(group, "bin", "_low", "_high", "_n").agg(F.sum("_c").alias("n"))
        .select(group, "bin", "n", F.try_divide(F.col("n"), F.col("_n") * step).alias("density"))
    )


def clipped_counts(df: DataFrame, key: str, low: int, high: int) -> DataFrame:
    """Histogram of rows per key with the ends clipped to ``low`` and ``high``."""
    per_key = known(df, key).groupBy(key).agg(F.count("*").alias("k"))
    return per_key.groupBy(F.greatest(F.lit(low), F.least(F.lit(high), F.col("k"))).alias("visits")).agg(
        F.count("*").alias("keys")
    )


def box_stats(df: DataFrame, value: str, by: str | Sequence[str]) -> DataFrame:
    """Quartiles, whisker ends within 1.5 IQR, and the number of outliers per group."""
    by = [by] if isinstance(by, str) else list(by)
    df = known(df, *by)
    quartiles = exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, distinct=False)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    fenced = join_null_safe(counts, quartiles, by)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    ends = fenced.groupBy(*by).agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("_c"))).alias("outliers"),
    )
    return join_null_safe(quartiles, ends, by)


def density_curve(
    df: DataFrame, value: str, by: Sequence[str] = (), points: int = 32, reach: float = 3.0
) -> DataFrame:
    """Gaussian kernel density on a grid per group, Scott bandwidth, reaching past both ends.

    Values are counted first; the grid is a set of aggregate columns, so no row is multiplied. A group
    without spread has no bandwidth and gets a null density.
    """
    by = list(by)
    kept = known(df, value, *by)
    spans = kept.groupBy(*by).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"), F.count("*").alias("_n"),
        F.stddev_samp(value).alias("_s"),
    )
    spans = spans.withColumn("_h", F.col("_s") * F.pow("_n", F.lit(-0.2))).withColumn(
        "_start", F.col("_low") - F.col("_h") * reach
    ).withColumn("_step", (F.col("_high") - F.col("_low") + F.col("_h") * (2 * reach)) / (points - 1))
    counts = kept.groupBy(*by, value).agg(F.count("*").alias("_c"))
    shape = ["_start", "_step", "_h", "_n"]
    if by:
        placed = join_null_safe(counts, spans.select(*by, *shape), by)
    else:
        s = spans.select(F.struct(*shape).alias("s")).scalar()
        placed = counts.select("*", *[s[c].alias(c) for c in shape])
    sums = []
    for k in range(points):
        z = F.try_divide(F.col("_start") + F.col("_step") * k - F.col(value), F.col("_h"))
        sums.append(F.sum(F.col("_c") * F.exp(z * z * -0.5)).alias(f"d{k}"))
    wide = placed.groupBy(*by, *shape).agg(*sums)
    norm = F.col("_n") * F.col("_h") * F.sqrt(F.lit(2.0) * F.pi())
    cells = F.array(*[
        F.struct(
            F.lit(k).alias("point"), (F.col("_start") + F.col("_step") * k).alias("x"),
            F.try_divide(F.col(f"d{k}"), norm).alias("density"),
        )
        for k in range(points)
    ])
    return wide.select(*by, F.inline(cells))


def mean_by_equal_bins(
    df: DataFrame, value: str, measure: str, bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """Mean of a measure per right-closed equal-width bin, with the bin's edges."""
    span = _span(df, value, F.greatest(F.abs(F.min(value)) * 0.001, F.lit(0.001)))
    number = equal_width_bin(F.col(value), span["low"], span["high"], bins)
    left, right = equal_width_edges(F.col("bin"), span["low"], span["high"], bins)
    return (
        known(df, value, *by).select(*by, number.alias("bin"), F.col(measure).alias("_m"))
        .groupBy(*by, "bin").agg(F.count("*").alias("n"), F.avg("_m").alias("mean"))
        .select(*by, "bin", left.alias("left_edge"), right.alias("right_edge"), "n", "mean")
    )


def breakeven_by_group(
    df: DataFrame, group: str, value: str, measure: str, bins: int = 10
) -> DataFrame:
    """First bin with a negative mean per group, as an interval, or 'never negative'."""
    means = mean_by_equal_bins(df, value, measure, bins, [group])
    negative = F.col("mean") < 0
    label = interval_label(F.col("left_edge"), F.col("right_edge"))
    return means.groupBy(group).agg(
        F.coalesce(
            F.min_by(F.when(negative, label), F.when(negative, F.col("bin"))), F.lit("never negative")
        ).alias("breakeven_bucket"),
        F.bround(
            F.min_by(F.when(negative, F.col("mean")), F.when(negative, F.col("bin"))), 2
        ).alias("mean_at_breakeven"),
    )


def breakeven_midpoint(df: DataFrame, value: str, measure: str, bins: int = 10) -> DataFrame:
    """Middle of the first bin with a negative mean over the whole table."""
    means = mean_by_equal_bins(df, value, measure, bins).where("mean < 0")
    return means.orderBy("bin").limit(1).select(
        "bin", ((F.col("left_edge") + F.col("right_edge")) / 2).alias("midpoint"), "mean"
    )
