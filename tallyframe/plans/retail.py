"""Retail sales with web traffic: clean, explore, test, model, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bins import cut
from ..functions.dates import date_range_text, days_between, parse_month_first, weekday_number
from ..functions.numbers import flag, safe_ratio
from ..operators import customers, distribution, grouping, inference, learning, reshape, timeline, topk
from ..operators.ordering import exact_quantiles
from ..operators.quality import (
    Rule,
    Split,
    beyond_population_z,
    first_reason,
    require_parsed,
    split,
    warn_when_nothing_dirty,
)
from ..session import materialise
from ..sources.readers import read_csv
from ..sources.writers import write_csv, write_parquet

# fixed values: the column contracts and feature lists
SALES_COLUMNS = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID", "Customer Name",
    "Segment", "Country", "City", "State", "Postal Code", "Region", "Product ID", "Category",
    "Sub-Category", "Product Name", "Sales", "Quantity", "Discount", "Profit",
]
WEB_COLUMNS = [
    "Page Views", "Session Duration", "Bounce Rate", "Traffic Source", "Time on Page",
    "Previous Visits", "Conversion Rate",
]
CATEGORICAL = ["Ship Mode", "Segment", "Category", "Sub-Category", "Region"]
NUMERIC = ["Sales", "Quantity", "Discount", "days_to_ship", "order_month", "order_year", "order_dayofweek"]
Z_LIMIT = 3.0
KEY = ["Order ID", "Product ID", "Customer ID", "Sales", "Quantity", "Discount"]
# fixed values: the headers of the result files
BREAKEVEN_HEADER = ["Category", "breakeven_discount_bucket", "mean_profit_at_breakeven"]
RFM_HEADER = ["Customer ID", "Recency", "Frequency", "Monetary", "R", "F", "M", "RFM_Score", "Segment"]
REPORT_HEADER = [
    "model_name", "cv_auroc_mean", "cv_auroc_std", "cv_f1_mean", "cv_f1_std", "precision_0", "recall_0", "f1_0",
    "precision_1", "recall_1", "f1_1",
]


def _ddl(columns: list[str], kinds: dict[str, str]) -> str:
    return ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in columns)


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    kinds = {"Row ID": "bigint", "Postal Code": "bigint", "Quantity": "bigint", "Sales": "double",
             "Discount": "double", "Profit": "double"}
    return read_csv(spark, path, _ddl(SALES_COLUMNS, kinds), "ISO-8859-1", SALES_COLUMNS)


def read_web(spark: SparkSession, path: str) -> DataFrame:
    kinds = {c: "double" for c in WEB_COLUMNS if c != "Traffic Source"}
    kinds.update({"Page Views": "bigint", "Previous Visits": "bigint"})
    return read_csv(spark, path, _ddl(WEB_COLUMNS, kinds), "ISO-8859-1", WEB_COLUMNS)


def clean_sales(df: DataFrame, source: str) -> Split:
    """The z-score is over the raw column, rows that fail the first rule included."""
    parts = split(df, first_reason([
        Rule("sales_zero_or_negative", F.col("Sales") <= 0),
        Rule("profit_extreme_outlier", beyond_population_z(df, "Profit", Z_LIMIT)),
    ]))
    warn_when_nothing_dirty(parts.dirty, source)
    return Split(parts.clean, parts.dirty.withColumn("source_file", F.lit(source)))


def clean_web(df: DataFrame, source: str) -> Split:
    parts = split(df, first_reason([Rule("zero_page_views", F.col("Page Views") == 0)]))
    warn_when_nothing_dirty(parts.dirty, source)
    return Split(parts.clean, parts.dirty.withColumn("source_file", F.lit(source)))


def derive_sales(df: DataFrame) -> DataFrame:
    """Dates (ISO or month first) and what follows from them; raises on the first text that is no date."""
    dated = df
    for c in ("Order Date", "Ship Date"):
        parsed = df.withColumn("_parsed", parse_month_first(F.col(c).cast("string")))
        require_parsed(parsed.where(F.col(c).isNotNull()), c, "_parsed", "Order ID")
        dated = dated.withColumn(c, parse_month_first(F.col(c).cast("string")))
    ordered = F.col("Order Date")
    return dated.withColumns({
        "days_to_ship": days_between(F.col("Ship Date"), ordered),
        "profit_margin": safe_ratio(F.col("Profit"), F.col("Sales")),
        "order_month": F.month(ordered), "order_year": F.year(ordered),
        "order_dayofweek": weekday_number(ordered), "is_loss": flag(F.col("Profit") < 0),
    }).drop("Country", "Row ID")


def derive_web(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "converted": flag(F.col("Conversion Rate") >= 1.0),
        "visits_bin": cut(F.col("Previous Visits"), [-1, 0, 2, 9], ["0", "1-2", "3+"]),
    })


def explore(df: DataFrame) -> dict[str, DataFrame]:
    products = grouping.summarise(df, ["Product Name"], {"profit": F.sum("Profit")}, keep_null_keys=False)
    months = {"total_sales": F.sum("Sales"), "total_profit": F.sum("Profit")}
    per_customer = df.select("Customer ID", "Order ID").distinct().groupBy("Customer ID").agg(F.count("*").alias("orders"))
    cap = exact_quantiles(per_customer, "orders", {"p95": 0.95}, distinct=False).select("p95").scalar()
    return {
        "profit_histogram": distribution.histogram(df, "Profit", 60),
        "profit_density": distribution.density_curve(df, "Profit"),
        "profit_boxes": distribution.box_stats(df, "Profit", "Category"),
        "mean_profit": grouping.summarise(df, ["Sub-Category"], {"mean_profit": F.avg("Profit")}).orderBy("mean_profit"),
        "breakeven_midpoint": distribution.breakeven_midpoint(df, "Discount", "Profit"),
        "discount_trend": inference.trend_line(df, "Discount", "Profit"),
        "monthly": timeline.resample(df, "Order Date", "month", months).orderBy("period"),
        "margin_by_region_segment": grouping.pivot_mean(df, "Region", "Segment", "profit_margin"),
        "ship_modes": topk.by_median(df, "Ship Mode", "profit_margin"),
        "ship_mode_density": distribution.density_curve(df, "profit_margin", ["Ship Mode"]),
        "products": topk.top_and_bottom(products, "profit", "Product Name", 10),
        "order_frequency": distribution.histogram(per_customer.where(F.col("orders") <= cap), "orders", 30),
    }


def explore_web(df: DataFrame) -> dict[str, DataFrame]:
    return {"conversion_by_source": grouping.summarise(df, ["Traffic Source"], {
        "mean": F.avg("Conversion Rate"), "std": F.stddev_samp("Conversion Rate")}, keep_null_keys=False)}


def category_table(df: DataFrame) -> DataFrame:
    return grouping.profit_table(df, ["Category", "Sub-Category"], "Profit", "profit_margin", "is_loss")


def correlations(df: DataFrame) -> DataFrame:
    return inference.correlation_matrix(df, ["Sales", "Quantity", "Discount", "Profit", "days_to_ship", "profit_margin"])


def tests(df: DataFrame) -> DataFrame:
    """Three Kruskal-Wallis tests on profit and the segment by ship mode chi-square, one row each."""
    shape = lambda t, name, statistic: t.select(
        F.lit(name).alias("test_name"), F.bround(statistic, 4).alias("statistic"),
        F.bround("p_value", 6).alias("p_value"), F.col("dof").cast("bigint").alias("dof"),
        F.when(F.col("p_value") < 0.05, "significant").otherwise("not significant").alias("conclusion"))
    rows = [
        shape(inference.kruskal(df, ["Profit"], c), f"Profit ~ {c}", "h_stat")
        for c in ("Region", "Segment", "Category")
    ]
    rows.append(shape(
        inference.chi_square(df, "Segment", "Ship Mode"), "Segment x Ship Mode (chi-square)", "statistic"))
    return reshape.stack_tables(*rows)


def profit_verdict(results: DataFrame) -> DataFrame:
    """differs_by, same_by: the groupings that the Kruskal-Wallis rows of ``tests`` find profit to differ by, and the others."""
    named = results.where(F.col("test_name").startswith("Profit ~ ")).select(
        F.substring_index("test_name", " ~ ", -1).alias("g"), (F.col("conclusion") == "significant").alias("hit"))
    listed = lambda kind: F.array_join(F.sort_array(F.collect_list(F.when(F.col("hit") == kind, F.col("g")))), ", ")
    return named.agg(listed(True).alias("differs_by"), listed(False).alias("same_by"))


def breakeven(df: DataFrame) -> DataFrame:
    return distribution.breakeven_by_group(df, "Category", "Discount", "Profit")


def rfm(df: DataFrame) -> DataFrame:
    return customers.rfm_scores(df, "Customer ID", "Order ID", "Order Date", "Sales")


def seasonality(df: DataFrame) -> DataFrame:
    months = timeline.resample(df, "Order Date", "month", {"sales": F.sum("Sales")}, ["sales"])
    return timeline.decompose_monthly(months, "sales")


def robust_seasonality(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Monthly sales by robust local regression, per key where ``by`` names some."""
    months = timeline.resample(df, "Order Date", "month", {"sales": F.sum("Sales")}, ["sales"], by)
    return timeline.decompose_loess(months, "sales", by)


def model_report(
    df: DataFrame, key: Sequence[str], models: Mapping[str, learning.Fitter] | None = None, folds: int = 5
) -> DataFrame:
    """Cross-validated figures per model; ``key`` names the rows apart."""
    plan = learning.plan_one_hot(df, CATEGORICAL, NUMERIC)
    coded = plan.encode(df.withColumns({k: F.col(k) for k in key}), ["is_loss", *key])
    return learning.cross_validate(coded, "is_loss", list(key), models, folds)


def findings(
    categories: DataFrame, breakevens: DataFrame, scores: DataFrame, group: str = "Category",
    item: str = "Sub-Category", focus: str = "Furniture", report: DataFrame | None = None,
    results: DataFrame | None = None,
) -> DataFrame:
    """Worst loss rate, the focus category's break-even, segment shares; with a model report its best model, with test
    results their verdict on profit."""
    worst = grouping.leader(categories, item, "pct_loss").select(F.struct(F.col(item).alias("item"), "pct_loss").alias("s")).scalar()
    bucket = breakevens.where(F.col(group) == focus).select("breakeven_bucket").scalar()
    out = scores.agg(
        (F.avg((F.col("segment") == "Champions").cast("int")) * 100).alias("champions_pct"),
        (F.avg((F.col("segment") == "At Risk").cast("int")) * 100).alias("at_risk_pct"),
    ).select(
        worst["item"].alias("worst_item"), worst["pct_loss"].alias("worst_pct_loss"),
        bucket.alias("focus_breakeven"), "champions_pct", "at_risk_pct",
    )
    if results is not None:
        verdict = profit_verdict(results).select(F.struct("differs_by", "same_by").alias("v")).scalar()
        out = out.withColumns({"profit_differs_by": verdict["differs_by"], "profit_same_by": verdict["same_by"]})
    if report is None:
        return out
    best = learning.with_best(report).where("is_best").select(F.struct("model_name", "cv_auroc_mean").alias("b")).scalar()
    return out.withColumns({"best_model": best["model_name"], "best_auroc": best["cv_auroc_mean"]})


def segment_shares(scores: DataFrame) -> DataFrame:
    counts = scores.groupBy("segment").agg(F.count("*").alias("n"))
    return grouping.share_of_total(counts, "n", "pct").orderBy(F.desc("n"), "segment")


def overview(kept: DataFrame, dirty: DataFrame, moment: str = "Order Date") -> DataFrame:
    """Clean and dirty rows, the loss rate and the date range."""
    removed = dirty.select(F.count("*")).scalar()
    return kept.agg(
        F.count("*").alias("clean_rows"), (F.avg("is_loss") * 100).alias("loss_rate_pct"),
        date_range_text(F.col(moment)).alias("date_range"),
    ).withColumn("dirty_rows", removed)


def run(
    spark: SparkSession, sales_path: str, web_path: str, out: str,
    models: Mapping[str, learning.Fitter] | None = None, folds: int = 5,
) -> dict[str, str]:
    """Two CSV files in; typed clean tables, all dirty rows with their source, the result tables, the models' report
    and the findings out."""
    name = lambda path: path.rstrip("/").rsplit("/", 1)[-1]
    sales = clean_sales(read_sales(spark, sales_path), name(sales_path))
    web = clean_web(read_web(spark, web_path), name(web_path))
    kept = write_parquet(derive_sales(sales.clean), f"{out}/sales_clean")
    written = {
        "sales": kept, "web": write_parquet(derive_web(web.clean), f"{out}/web_clean"),
        "dirty": write_csv(reshape.stack_tables(sales.dirty, web.dirty), f"{out}/dirty"),
    }
    df = spark.read.parquet(kept)
    report, categories, turns, scores = model_report(df, KEY, models, folds), category_table(df), breakeven(df), rfm(df)
    results = materialise(tests(df))
    for label, table in {
        "profit_by_category": categories, "statistical_tests": results,
        "discount_breakeven": turns.toDF(*BREAKEVEN_HEADER), "rfm_scores": scores.toDF(*RFM_HEADER),
        "classification_report": report.select("model_name", *[F.bround(c, 4).alias(c) for c in REPORT_HEADER[1:]]),
        "findings": findings(categories, turns, scores, report=report, results=results),
    }.items():
        written[label] = write_csv(table, f"{out}/tables/{label}")
    return written
