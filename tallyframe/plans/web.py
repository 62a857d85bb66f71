"""Web sessions: audit, clean, explore, test, report facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import flag
from ..operators import distribution, grouping, inference, profile, topk
from ..operators.quality import Rule, Split, any_null, first_reason, reason_counts, split
from ..sources.readers import read_csv
from ..sources.writers import write_csv, write_parquet

# fixed values: the column contract and the known sources
COLUMNS = [
    "Page Views", "Session Duration", "Bounce Rate", "Traffic Source", "Time on Page",
    "Previous Visits", "Conversion Rate",
]
NUMERIC = [c for c in COLUMNS if c != "Traffic Source"]
SOURCES = ["Organic", "Social", "Paid", "Direct", "Referral"]
SCHEMA = (
    "`Page Views` bigint, `Session Duration` double, `Bounce Rate` double, `Traffic Source` string, "
    "`Time on Page` double, `Previous Visits` bigint, `Conversion Rate` double"
)
TARGETS = ["Session Duration", "Bounce Rate", "Conversion Rate", "Page Views", "Time on Page"]


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SCHEMA, expected=COLUMNS)


def audit(df: DataFrame) -> DataFrame:
    return profile.profile_columns(df)


def source_shares(df: DataFrame) -> DataFrame:
    return profile.category_profile(df, "Traffic Source")


def rules(columns: list[str] = COLUMNS) -> list[Rule]:
    """Seven rules, the first one that fails counts; an unknown source is one not in the list."""
    outside = lambda c: (F.col(c) < 0) | (F.col(c) > 1)
    return [
        Rule("null_value", any_null(columns)),
        Rule("session_duration_too_short", F.col("Session Duration") < 0.1),
        Rule("time_on_page_too_short", F.col("Time on Page") < 0.1),
        Rule("bounce_rate_out_of_range", outside("Bounce Rate")),
        Rule("conversion_rate_out_of_range", outside("Conversion Rate")),
        Rule("page_views_invalid", F.col("Page Views") < 1),
        Rule("unknown_traffic_source", ~F.col("Traffic Source").isin(SOURCES)),
    ]


def clean(df: DataFrame) -> Split:
    return split(df, first_reason(rules(df.columns)))


def derive(df: DataFrame) -> DataFrame:
    return df.withColumn("converted", flag(F.col("Conversion Rate") == 1.0))


def explore(df: DataFrame) -> dict[str, DataFrame]:
    metrics = ["Conversion Rate", "Bounce Rate", "Session Duration"]
    spread = {f"{f} {m}": (F.avg if f == "mean" else F.stddev_samp)(m) for m in metrics for f in ("mean", "std")}
    return {
        **{f"histogram {c}": distribution.histogram(df, c, 30) for c in NUMERIC},
        **{f"boxes {c}": distribution.box_stats(df, c, "Traffic Source") for c in NUMERIC},
        "median_order": topk.by_median(df, "Traffic Source", "Session Duration"),
        "correlation": inference.correlation_matrix(df, [*NUMERIC, "converted"]),
        "source_spread": grouping.summarise(df, ["Traffic Source"], spread),
        "conversion_density": distribution.density_curve(df, "Conversion Rate", ["Traffic Source"]),
    }


def tests(df: DataFrame) -> DataFrame:
    out = inference.kruskal(df, TARGETS, "Traffic Source")
    return out.select("target", F.bround("h_stat", 4).alias("H_stat"), F.bround("p_value", 4).alias("p_value"), "significant")


def correlations(df: DataFrame) -> DataFrame:
    return inference.pearson_with_target(df, "Conversion Rate", [c for c in NUMERIC if c != "Conversion Rate"])


def source_metrics(df: DataFrame, source: str, columns: dict[str, str]) -> DataFrame:
    """Mean per source of each measure, rounded to four digits; ``columns``: output name -> column."""
    return grouping.summarise(df, [source], {k: F.bround(F.avg(c), 4) for k, c in columns.items()}, keep_null_keys=False)


def significant_targets(results: DataFrame) -> DataFrame:
    """Targets whose test is significant, by name."""
    return results.where("significant").select("target").orderBy("target")


def report_facts(
    df: DataFrame, source: str = "Traffic Source", duration: str = "Session Duration",
    bounce: str = "Bounce Rate", conversion: str = "Conversion Rate", visits: str = "Previous Visits",
    features: list[str] | None = None,
) -> DataFrame:
    """Best sources, new against returning visitors, and the feature most tied to conversion."""
    means = source_metrics(df, source, {"d": duration, "b": bounce, "c": conversion})
    lead = lambda m, low=False: grouping.leader(means, source, m, low).select(source).scalar()
    features = features or [c for c in NUMERIC if c != conversion]
    top = inference.rank_features(df, conversion, features).limit(1).select(F.struct("feature", "r").alias("s")).scalar()
    return df.agg(
        F.bround(F.avg(F.when(F.col(visits) == 0, F.col(conversion))), 4).alias("new_conversion"),
        F.bround(F.avg(F.when(F.col(visits) > 0, F.col(conversion))), 4).alias("returning_conversion"),
    ).select(
        lead("c").alias("best_conversion_source"), lead("d").alias("highest_engagement_source"),
        lead("b", True).alias("lowest_bounce_source"), "new_conversion", "returning_conversion",
        top["feature"].alias("top_feature"), F.bround(top["r"], 4).alias("top_r"),
    )


def run(spark: SparkSession, path: str, out: str) -> dict[str, str]:
    """CSV in; audit, dirty rows, clean rows (also as Parquet, which the tests read), tests and summary out."""
    raw = read(spark, path)
    parts = clean(raw)
    typed = write_parquet(derive(parts.clean), f"{out}/clean_parquet")
    kept = spark.read.parquet(typed)
    results = tests(kept)
    write_csv(significant_targets(results), f"{out}/significant_targets")
    return {
        "audit": write_csv(audit(raw).orderBy("position").drop("position"), f"{out}/audit"),
        "dirty": write_csv(parts.dirty, f"{out}/dirty"), "clean": write_csv(kept, f"{out}/clean"), "typed": typed,
        "reasons": write_csv(reason_counts(parts.dirty), f"{out}/dirty_breakdown"),
        "stats": write_csv(results, f"{out}/stats"),
        "summary": write_csv(profile.numeric_summary(kept, NUMERIC), f"{out}/numeric_summary"),
    }
