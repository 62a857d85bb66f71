"""Any table at all: find dirty rows, describe the clean ones, sum up the case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile, quality
from ..operators.quality import Split
from ..session import materialise
from ..sources.readers import read_csv_any_encoding


def read(spark: SparkSession, path: str) -> DataFrame:
    """Any CSV in a usual encoding; dots in names are replaced, they mean nesting in Spark."""
    df = read_csv_any_encoding(spark, path)
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def investigate(df: DataFrame) -> Split:
    """Clean and dirty rows. The tagged rows are written once: every later step reads them."""
    tagged = materialise(quality.audit_any_table(df))
    return Split(
        tagged.where("reason is null").drop("reason"), tagged.where("reason is not null"))


def column_statistics(clean: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation per analysed column, rounded to cents."""
    return profile.column_moments(clean, columns).where("mean is not null").select(
        "column", F.bround("mean", 2).alias("mean"),
        F.coalesce(F.bround("std", 2), F.lit(0.0)).alias("std"))


def ranking(clean: DataFrame, columns: Sequence[str], k: int = 3) -> DataFrame:
    """The k columns with the highest and with the lowest mean."""
    means = column_statistics(clean, columns).select("column", "mean")
    high = means.orderBy(F.desc("mean"), "column").limit(k).withColumn("side", F.lit("top"))
    return high.unionByName(means.orderBy("mean", "column").limit(k).withColumn("side", F.lit("bottom")))


def summary(parts: Split, columns: Sequence[str], label: str = "case") -> DataFrame:
    """Totals, pass rate, issues, pooled mean, leading column and the number of high-variability alerts."""
    issues = quality.issue_counts(parts.dirty).agg(F.sum("n")).scalar()
    removed = parts.dirty.select(F.count("*")).scalar()
    pooled = profile.pooled_summary(parts.clean, columns).select(
        F.struct("columns", "overall_mean", "top_column", "top_mean", "spread").alias("s")).scalar()
    alerts = profile.variability(parts.clean, columns).select(F.count_if("high_variability")).scalar()
    kept = F.count("*")
    return parts.clean.agg(kept.alias("clean_rows")).select(
        F.lit(label).alias("case"), (F.col("clean_rows") + removed).alias("total_rows"),
        removed.alias("dirty_rows"),
        F.bround((1 - removed / (F.col("clean_rows") + removed)) * 100, 1).alias("pass_rate_pct"),
        F.coalesce(issues, F.lit(0)).alias("issues"), pooled["columns"].alias("columns"),
        pooled["overall_mean"].alias("overall_mean"), pooled["top_column"].alias("top_column"),
        pooled["top_mean"].alias("top_mean"), pooled["spread"].alias("spread"), alerts.alias("alerts"),
    )


def run(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    parts = investigate(read(spark, path))
    columns = profile.analysis_columns(parts.clean)
    return {
        "dirty": parts.dirty, "statistics": column_statistics(parts.clean, columns),
        "issues": quality.issue_counts(parts.dirty), "ranking": ranking(parts.clean, columns),
        "variability": profile.variability(parts.clean, columns),
        "summary": summary(parts, columns, path.rsplit("/", 1)[-1]),
    }
