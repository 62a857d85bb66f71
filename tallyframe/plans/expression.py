"""Gene expression with clinical data: clean, summaries, group tests, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import distribution, grouping, inference, learning, profile
from ..operators.quality import Rule, Split, all_reasons, flag_repeats, split
from ..sources.readers import read_csv

# fixed values: the column contract and the valid sets
GENES = [
    "MYCN", "ALK", "PHOX2B", "TH", "CHGB", "DBH", "NTRK1", "NTRK2", "MDM2", "CDK4", "BIRC5", "CCND1",
    "MYC", "TERT", "ATRX", "TP53",
]
GENE_COLUMNS = [f"expr_{g}" for g in GENES]
STAGES = ["1", "2A", "2B", "3", "4", "4S"]
RISKS = ["low", "intermediate", "high"]
SCHEMA = (
    "patient_id string, age_months bigint, stage string, risk_group string, mycn_amplified bigint, "
    + ", ".join(f"{g} double" for g in GENE_COLUMNS) + ", efs_months double, event bigint"
)
COLUMNS = ["patient_id", "age_months", "stage", "risk_group", "mycn_amplified", *GENE_COLUMNS, "efs_months", "event"]


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SCHEMA, expected=COLUMNS)


def rules(repeat: str) -> list[Rule]:
    return [
        *[Rule(f"negative gene expression value in {g}", F.col(g) < 0) for g in GENE_COLUMNS],
        Rule("age_months out of valid range [1, 240]", ~F.col("age_months").between(1, 240)),
        Rule("efs_months must be positive", F.col("efs_months") <= 0),
        Rule("event value not in {0, 1}", ~F.col("event").isin(0, 1)),
        Rule("stage not in valid set", ~F.col("stage").isin(STAGES)),
        Rule("risk_group not in valid set", ~F.col("risk_group").isin(RISKS)),
        Rule("mycn_amplified not in {0, 1}", ~F.col("mycn_amplified").isin(0, 1)),
        Rule("duplicate patient_id", F.col(repeat)),
    ]


def clean(df: DataFrame, order_by: list[str] | None = None) -> Split:
    """All reasons per row; of a repeated patient the first row by ``order_by`` stays."""
    order = order_by or [c for c in df.columns if c != "patient_id"]
    flagged = flag_repeats(df, ["patient_id"], order, "_repeat")
    parts = split(flagged, all_reasons(rules("_repeat")))
    return Split(parts.clean.drop("_repeat"), parts.dirty.drop("_repeat"))


def without_dirty(df: DataFrame, dirty: DataFrame) -> DataFrame:
    """Later steps drop the patients named in the dirty file."""
    return df.join(dirty.select("patient_id").distinct(), "patient_id", "left_anti")


def summary(df: DataFrame) -> DataFrame:
    numeric = ["age_months", *GENE_COLUMNS, "efs_months"]
    return profile.profile_columns(df, numeric)


def category_counts(df: DataFrame) -> DataFrame:
    out = None
    for c in ("stage", "risk_group", "mycn_amplified", "event"):
        part = profile.category_profile(df.withColumn(c, F.col(c).cast("string")), c)
        part = part.select(F.lit(c).alias("column"), F.col(c).alias("value"), "n", (F.col("proportion") * 100).alias("pct"))
        out = part if out is None else out.unionByName(part)
    return out


def distributions(df: DataFrame) -> dict[str, DataFrame]:
    """All genes at once, in long form with the gene's column name as ``column``."""
    cells = profile.number_cells(df, GENE_COLUMNS, ["event", "risk_group", "stage"])
    key_genes = cells.where(F.col("column").isin("expr_MYCN", "expr_NTRK1", "expr_ALK"))
    return {
        "gene_density": distribution.density_curve(cells, "number", ["column"]),
        "gene_histogram": distribution.density_histogram(cells, "number", "column", 20),
        "age_histogram": distribution.histogram(df, "age_months", 20),
        "efs_by_event": distribution.density_curve(df, "efs_months", ["event"]),
        "gene_boxes_by_event": distribution.box_stats(cells, "number", ["column", "event"]),
        "gene_boxes_by_risk": distribution.box_stats(cells, "number", ["column", "risk_group"]),
        "key_gene_boxes_by_stage": distribution.box_stats(key_genes, "number", ["column", "stage"]),
        "age_boxes_by_event": distribution.box_stats(df, "age_months", "event"),
        "mycn_density": distribution.density_curve(df, "expr_MYCN", ["mycn_amplified"]),
    }


def correlations(df: DataFrame) -> DataFrame:
    return inference.correlation_matrix(df, [*GENE_COLUMNS, "age_months", "efs_months"])


def strong_correlations(df: DataFrame) -> DataFrame:
    return inference.strong_pairs(df, [*GENE_COLUMNS, "age_months", "efs_months"])


def event_shares(df: DataFrame, column: str) -> DataFrame:
    return grouping.row_shares(df, column, "event")


def clinical_tests(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "risk_group": inference.chi_square(df, "risk_group", "event"),
        "stage": inference.chi_square(df, "stage", "event"),
        "mycn_amplified": inference.fisher(df, "mycn_amplified", "event"),
        "age": inference.mann_whitney(df, ["age_months"], "event"),
    }


def gene_tests(df: DataFrame) -> DataFrame:
    return inference.mann_whitney(df, GENE_COLUMNS, "event").orderBy("p_value", "target")


def components(df: DataFrame) -> learning.Components:
    return learning.principal_components(df, GENE_COLUMNS, len(GENE_COLUMNS))


def clusters(df: DataFrame, k: int = 4) -> DataFrame:
    return learning.hierarchical_groups(df, GENE_COLUMNS, k, ["patient_id", "risk_group", "event"])
