"""Column profiles and summaries, from a bounded number of passes over the table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import column_quantiles
from .quality import nan_as_missing, numeric_columns


def _text_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per cell: column name and value as text."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text")) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def number_cells(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form of numeric columns: ``keep..., column, number``."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("number")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))


#: Columns whose quantiles are taken in one go, so that a very wide table makes no expression too large to compile.
TOGETHER = 16


def _quantiles(df: DataFrame, columns: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    """column and its quantiles, from the columns side by side: no row is written out once a column."""
    return reduce(DataFrame.unionByName, [
        column_quantiles(df, columns[i : i + TOGETHER], quantiles).drop("n") for i in range(0, len(columns), TOGETHER)
    ])


def column_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, nulls and, for numeric columns, min/max/mean/sample deviation: one aggregate, one row each."""
    numeric = set(numeric_columns(df))
    none = F.lit(None).cast("double")
    parts = []
    for i, c in enumerate(columns):
        num = c in numeric
        parts.append(F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(dict(df.dtypes)[c]).alias("dtype"),
            F.count("*").alias("total_count"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            (F.min(c).cast("double") if num else none).alias("min"),
            (F.max(c).cast("double") if num else none).alias("max"),
            (F.avg(c) if num else none).alias("mean"),
            (F.stddev_samp(c) if num else none).alias("std"),
        ).alias(f"s{i}"))
    row = df.agg(*parts)
    return row.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct non-null values per column; repeated values collapse before the shuffle.

    Floating columns are told apart as numbers, all others by their text, which no number type rounds.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    floats = [c for c in columns if isinstance(types[c], (T.DoubleType, T.FloatType))]
    texts = [c for c in columns if c not in floats]
    different = []
    if floats:
        different.append(number_cells(df, floats).where("number is not null").distinct().select("column"))
    if texts:
        different.append(_text_cells(df, texts).where("text is not null").distinct().select("column"))
    return reduce(DataFrame.unionByName, different).groupBy("column").agg(F.count("*").alias("unique_count"))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """dtype, counts, null share, distinct, min/max/mean/std and quartiles for each column.

    Moments take one pass, the quartiles of all columns three by bracketing, the distinct values one with a shuffle of
    the different values. NaN is a missing value.
    """
    columns = list(columns or df.columns)
    df = nan_as_missing(df.select(*[F.col(f"`{c}`") for c in columns]))
    numeric = [c for c in columns if c in set(numeric_columns(df))]
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    out = column_moments(df, columns)
    details = distinct_counts(df, columns)
    if numeric:
        details = _quantiles(df, numeric, quartiles).join(details, "column", "full")
    else:
        details = details.withColumns({p: F.lit(None).cast("double") for p in quartiles})
    share = F.try_divide(F.col("null_count"), F.col("total_count")) * 100
    return out.join(details, "column", "left").select(
        "position", "column", "dtype", "total_count", "null_count",
        F.bround(share, 2).alias("null_pct"),
        F.coalesce("unique_count", F.lit(0).cast("bigint")).alias("unique_count"),
        "min", "max",
        *[F.bround(c, 4).alias(c) for c in ("mean", "std", "p25", "p50", "p75")],
    )


def category_profile(df: DataFrame, column: str) -> DataFrame:
    """Value counts with their share; nulls are not counted."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("proportion", F.col("n") / total)


def id_like_columns(df: DataFrame) -> DataFrame:
    """Numeric columns with 'id' in the name whose values are all different."""
    named = [c for c in numeric_columns(df) if "id" in c.lower()]
    if not named:
        return df.sparkSession.createDataFrame([], "column string")
    rows = df.select(F.count("*")).scalar()
    return distinct_counts(df, named).where(F.col("unique_count") == rows).select("column")


def analysis_columns(df: DataFrame) -> list[str]:
    """Numeric columns without the id-like ones (a handful of names reaches the driver)."""
    skip = {r["column"] for r in id_like_columns(df).collect()}
    return [c for c in numeric_columns(df) if c not in skip]


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """mean, median, deviation, min and max per column."""
    middle = _quantiles(df, columns, {"median": 0.5})
    return (
        column_moments(df, columns).select("column", "mean", "std", "min", "max")
        .join(middle, "column", "left")
        .select("column", "mean", "median", "std", "min", "max")
    )


def pooled_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean over all values of all columns, and the column with the highest rounded mean."""
    row = df.agg(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), F.count(c).alias("n"),
                 F.sum(F.col(c).cast("double")).alias("total"), F.avg(c).alias("mean")).alias(f"s{i}")
        for i, c in enumerate(columns)
    ])
    table = row.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))
    best = F.struct(F.bround("mean", 2), -F.col("position"))
    return table.where("n > 0").agg(
        F.count("*").alias("columns"),
        F.bround(F.sum("total") / F.sum("n"), 2).alias("overall_mean"),
        F.max_by("column", best).alias("top_column"),
        F.max(F.bround("mean", 2)).alias("top_mean"),
        (F.max(F.bround("mean", 2)) - F.min(F.bround("mean", 2))).alias("spread"),
    )


def variability(df: DataFrame, columns: Sequence[str], alert_above: float = 40.0) -> DataFrame:
    """min/max/median, coefficient of variation in percent, and an alert above the limit."""
    cv = F.coalesce(
        F.bround(F.try_divide(F.bround("std", 2), F.bround("mean", 2)) * 100, 1), F.lit(0.0)
    )
    return (
        numeric_summary(df, columns).where("mean is not null")
        .withColumn("cv_pct", cv).withColumn("high_variability", F.col("cv_pct") > alert_above)
    )
