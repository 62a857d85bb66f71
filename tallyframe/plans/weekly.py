"""Weekly sales: clean, profit features, and the region by product summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import safe_ratio
from ..operators import grouping, topk
from ..operators.quality import Rule, Split, any_null, first_reason, flag_repeats, split
from ..sources.readers import read_csv

# fixed values: the column contract
COLUMNS = ["date", "region", "product", "units_sold", "revenue", "cost"]
SCHEMA = "date string, region string, product string, units_sold bigint, revenue double, cost double"


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SCHEMA, expected=COLUMNS)


def rules(repeat: str) -> list[Rule]:
    return [
        Rule("non_positive_units", F.col("units_sold") <= 0),
        Rule("non_positive_revenue", F.col("revenue") <= 0),
        Rule("non_positive_cost", F.col("cost") <= 0),
        Rule("cost_exceeds_revenue", F.col("cost") > F.col("revenue")),
        Rule("invalid_date", F.col("date").isNotNull() & F.try_to_date("date", "yyyy-MM-dd").isNull()),
        Rule("missing_required_field", any_null(COLUMNS)),
        Rule("duplicate", F.col(repeat)),
    ]


def clean(df: DataFrame) -> Split:
    parts = split(flag_repeats(df, name="_repeat"), first_reason(rules("_repeat")))
    return Split(parts.clean.drop("_repeat"), parts.dirty.drop("_repeat"))


def derive(df: DataFrame) -> DataFrame:
    profit = F.col("revenue") - F.col("cost")
    return df.withColumns({
        "date": F.try_to_date("date", "yyyy-MM-dd"), "profit": profit,
        "profit_margin": F.bround(safe_ratio(profit, F.col("revenue")), 4),
    })


def sales_summary(df: DataFrame) -> DataFrame:
    return grouping.summarise(df, ["region", "product"], {
        "total_revenue": F.sum("revenue"), "total_profit": F.sum("profit"),
        "total_units": F.sum("units_sold"), "avg_profit_margin": F.avg("profit_margin")}, keep_null_keys=False)


def dashboard(df: DataFrame, regions: Sequence[str] = (), products: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Headline figures, revenue by region and by week and product, for the chosen rows."""
    kept = topk.multi_select(topk.multi_select(df, "region", regions), "product", products)
    return {
        "headline": kept.agg(
            F.sum("revenue").alias("total_revenue"), F.sum("profit").alias("total_profit"),
            F.avg("units_sold").alias("avg_units_sold")),
        "by_region": grouping.summarise(kept, ["region"], {"revenue": F.sum("revenue")}),
        "trend": grouping.summarise(kept, ["date", "product"], {"revenue": F.sum("revenue")}).orderBy("date", "product"),
    }
