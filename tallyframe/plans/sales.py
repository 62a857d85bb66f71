"""Sales orders: clean, aggregate, and the facts a report states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_key, parse_mixed_date
from ..operators import grouping, reshape, timeline, topk
from ..operators.quality import (
    Rule,
    Split,
    Tally,
    all_reasons,
    ensure_clean,
    require_parsed,
    split,
    total_mismatch,
    unparsed,
    write_split,
)
from ..session import fresh_folder
from ..sources.readers import read_csv
from ..sources.writers import write_csv, write_parquet

# fixed values: the column contract
SCHEMA = (
    "order_id string, date string, customer_name string, customer_email string, region string, "
    "product string, category string, quantity bigint, unit_price double, discount_pct double, "
    "total double, sales_rep string, status string"
)
COLUMNS = [part.split()[0] for part in SCHEMA.split(", ")]
QUANTITY_LIMIT = 50
PENDING = "Pending"
LEADER_COLUMNS = ("region", "category", "product", "sales_rep", "customer_name")


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SCHEMA, expected=COLUMNS)


def with_dates(df: DataFrame) -> DataFrame:
    """Mixed date texts to dates; raises on the first text that is no date."""
    parsed = df.withColumn("_parsed", parse_mixed_date(F.col("date")))
    require_parsed(parsed, "date", "_parsed", "order_id")
    return parsed.withColumn("date", F.col("_parsed")).drop("_parsed")


def rules(limit: int = QUANTITY_LIMIT) -> list[Rule]:
    return [
        Rule("negative unit_price", F.col("unit_price") < 0),
        Rule(f"quantity exceeds threshold (>{limit})", F.col("quantity") > limit),
        Rule("total_mismatch", total_mismatch(
            F.col("total"), F.col("quantity"), F.col("unit_price"), F.col("discount_pct"))),
    ]


def clean(df: DataFrame, limit: int = QUANTITY_LIMIT) -> Split:
    return split(df, all_reasons(rules(limit)))


def derive(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "month": month_key(F.col("date")), "revenue": F.col("total"),
        "is_pending": F.coalesce(F.col("status") == PENDING, F.lit(False)),
        "missing_email": F.col("customer_email").isNull(), "missing_rep": F.col("sales_rep").isNull(),
    })


def checks(limit: int = QUANTITY_LIMIT) -> list[Rule]:
    """What no clean row may break; here a null price or quantity breaks the check as well."""
    return [
        Rule("negative unit_price", ~F.coalesce(F.col("unit_price") >= 0, F.lit(False))),
        Rule("quantity over the limit", ~F.coalesce(F.col("quantity") <= limit, F.lit(False))),
        *rules(limit)[2:], Rule("no date", F.col("date").isNull()),
    ]


def check(df: DataFrame, limit: int = QUANTITY_LIMIT) -> None:
    ensure_clean(df, checks(limit))


def write_clean(df: DataFrame, folder: str, limit: int = QUANTITY_LIMIT) -> tuple[Split, Tally]:
    """Dates, rules, counts and post-clean checks of the raw table in one scan of it."""
    dated = df.withColumns({"_text": F.col("date"), "date": parse_mixed_date(F.col("date"))})
    return write_split(
        dated, rules(limit), all_reasons(rules(limit)), folder, checks(limit),
        [unparsed("_text", "date", "order_id", "date")], ["_text"], "sales")


def revenue_by(df: DataFrame, column: str) -> DataFrame:
    out = grouping.summarise(df, [column], grouping.revenue_measures("revenue", "order_id"))
    return out.orderBy(F.desc("revenue_sum"))


def tables(df: DataFrame) -> dict[str, DataFrame]:
    """The ten summary tables of clean, derived orders."""
    measures = grouping.revenue_measures("revenue", "order_id")
    rep = {**measures, "avg_discount": F.avg("discount_pct")}
    customers = grouping.summarise(
        df, ["customer_name"], {k: measures[k] for k in ("revenue_sum", "order_count")}, keep_null_keys=False)
    return {
        "monthly_revenue": timeline.monthly_revenue(df, "date", "revenue", "order_id"),
        "revenue_by_region": revenue_by(df, "region"),
        "revenue_by_category": revenue_by(df, "category"),
        "revenue_by_product": revenue_by(df, "product"),
        "sales_rep_performance": grouping.summarise(df, ["sales_rep"], rep).orderBy(F.desc("revenue_sum")),
        "top_customers": topk.top(customers, "revenue_sum", "customer_name", 10),
        "customer_concentration": grouping.concentration(df, "customer_name", "revenue"),
        "status_breakdown": grouping.summarise(
            df, ["status"], {k: measures[k] for k in ("order_count", "revenue_sum")}, keep_null_keys=False),
        "region_category_heatmap": heatmap(df),
        "discount_summary": grouping.summarise(df, ["category"], {
            "avg_discount": F.avg("discount_pct"), "max_discount": F.max("discount_pct"),
            "min_discount": F.min("discount_pct")}, keep_null_keys=False),
    }


def heatmap(df: DataFrame) -> DataFrame:
    """Revenue of every seen region with every seen category, zero where there is none."""
    wide = grouping.pivot_sum(df.where("region is not null"), "region", "category", "revenue")
    return grouping.melt(wide, ["region"], "category", "revenue_sum")


def kpis(df: DataFrame) -> DataFrame:
    leaders = {
        "top_region": "region", "top_product": "product", "top_sales_rep": "sales_rep",
        "top_customer": "customer_name",
    }
    return grouping.kpis(df, "revenue", "order_id", "customer_name", F.col("is_pending"), leaders)


def summary_stats(df: DataFrame) -> DataFrame:
    """KPIs and all tables in long form: table, metric_name, metric_value (+ number)."""
    long = [reshape.record_to_long(kpis(df), "kpis")]
    long += [reshape.to_long(table, name) for name, table in tables(df).items()]
    return reshape.stack_tables(*long)


def monthly_facts(df: DataFrame) -> DataFrame:
    """Peak month with its share, best growth with both months, last growth and last count."""
    months = timeline.monthly_revenue(df, "date", "revenue", "order_id")
    ends = timeline.series_ends(months, "month", "revenue_sum").select(
        F.struct("best_growth_from", "best_growth_to", "best_growth_pct").alias("e")).scalar()
    return months.agg(
        F.min_by("month", F.struct(-F.col("revenue_sum"), F.col("month"))).alias("peak_month"),
        F.max("revenue_sum").alias("peak_revenue"),
        (F.max("revenue_sum") / F.sum("revenue_sum") * 100).alias("peak_share_pct"),
        F.max_by("mom_growth_pct", "month").alias("last_growth_pct"),
        F.max_by("order_count", "month").alias("last_order_count"),
    ).withColumns({c: ends[c] for c in ("best_growth_from", "best_growth_to", "best_growth_pct")})


def leader_facts(df: DataFrame, columns: tuple[str, ...] = LEADER_COLUMNS) -> DataFrame:
    """Per grouping, all in one pass: leaders by revenue, mean order value and count, the leader's
    share, and the range of revenue."""
    slim = df.select(*columns, F.col("revenue").alias("_m"), F.col("order_id").alias("_o"))
    groups = grouping.by_each_key(slim, list(columns), {
        "revenue": F.sum("_m"), "aov": F.avg("_m"), "orders": F.count("_o")})
    return groups.groupBy("grouping").agg(
        grouping.top_key("revenue").alias("top_by_revenue"), F.max("revenue").alias("top_revenue"),
        (F.max("revenue") / F.sum("revenue") * 100).alias("top_share_pct"),
        grouping.top_key("aov").alias("top_by_aov"), F.max("aov").alias("top_aov"),
        grouping.top_key("orders").alias("top_by_count"), F.max("orders").alias("top_count"),
        (F.max("revenue") - F.min("revenue")).alias("revenue_range"),
    )


def rep_discount_leader(df: DataFrame) -> DataFrame:
    means = grouping.summarise(df, ["sales_rep"], {"avg_discount": F.avg("discount_pct")}, keep_null_keys=False)
    return grouping.leader(means, "sales_rep", "avg_discount")


def customer_facts(df: DataFrame) -> DataFrame:
    """Shares of the top one and top three customers, and how many ordered more than once."""
    shares = grouping.concentration(df, "customer_name", "revenue", (1, 3)).agg(F.struct(
        F.max(F.when(F.col("top_n") == 1, F.col("pct_of_total"))).alias("one"),
        F.max(F.when(F.col("top_n") == 3, F.col("pct_of_total"))).alias("three")).alias("s")).scalar()
    counts = grouping.count_distribution(df.where("customer_name is not null"), "customer_name", "order_id")
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("rows_per_key") > 1, F.col("keys"))), F.lit(0)).alias("repeat_customers")
    ).select(shares["one"].alias("top1_pct"), shares["three"].alias("top3_pct"), "repeat_customers")


def status_facts(df: DataFrame) -> DataFrame:
    """Pending orders: count, revenue, both shares, and the region with most of them."""
    pending: Column = F.col("is_pending")
    regions = df.where(pending & F.col("region").isNotNull()).groupBy("region").agg(F.count("order_id").alias("_n"))
    revenue = F.coalesce(F.sum(F.when(pending, F.col("revenue"))), F.lit(0.0))
    return df.agg(
        F.count_if(pending).alias("pending_count"),
        (F.count_if(pending) / F.count("*") * 100).alias("pending_count_pct"),
        revenue.alias("pending_revenue"), (revenue / F.sum("revenue") * 100).alias("pending_revenue_pct"),
    ).withColumn("top_pending_region", F.coalesce(
        grouping.leader(regions, "region", "_n").select("region").scalar(), F.lit("N/A")))


def run(spark: SparkSession, path: str, out: str) -> dict[str, str]:
    """CSV in, scanned once; dirty rows, clean rows (also as Parquet, which the later tables read) and summary out."""
    parts, _ = write_clean(read(spark, path), fresh_folder(spark, "sales"))
    typed = write_parquet(derive(parts.clean), f"{out}/clean_parquet")
    kept = spark.read.parquet(typed)
    return {
        "dirty": write_csv(parts.dirty, f"{out}/dirty"), "clean": write_csv(kept, f"{out}/clean"),
        "typed": typed, "summary": write_csv(summary_stats(kept), f"{out}/summary_stats"),
    }
