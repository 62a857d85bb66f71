"""Time the headline queries at one scale and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyframe.catalog import REGISTRY, Tables  # noqa: E402

HEADLINE = [
    "io6_parquet_scan", "dq1_all_reasons_split", "dq2_first_reason_split", "dq3_split_with_source",
    "dq6_sigma_all_columns", "dq7_repeated_rows", "dq9_audit_any_table", "dq16_column_profile",
    "j2_left_frequency", "a2_monthly_revenue", "a6_profit_table", "a9_rate_by_flags", "a13_exact_quantiles",
    "a14_kpis", "a21_pivot_zero_fill", "a28_histogram", "a32_box_stats", "a33_density_curve",
    "a36_discount_breakeven", "w2_running_revenue", "w4_prior_rate", "w10_resample", "t2_top_customers",
    "s1_mixed_dates", "ud4_rfm_scores", "st1_kruskal", "st3_mann_whitney", "st5_correlation_matrix",
    "st11_seasonal_decomposition", "ml8_auroc", "f4_noshow_summary",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    tables.lineitem.count()  # start-up is not part of any query
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        REGISTRY[name].run(tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
