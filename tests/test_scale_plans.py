"""What a plan must not do to the rows, and the same results on null, repeated and missing values."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import ordering, profile


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moved_rows(plan):
    """Exchanges that a file's rows reach without an aggregate in between."""
    lines, found = plan.split("Initial Plan")[-1].splitlines(), []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line or "Exchange SinglePartition" in line:
            below = next((x for x in lines[i + 1:] if re.search("Aggregate|FileScan|ExistingRDD|LocalTableScan", x)), "")
            if "FileScan" in below:
                found.append(line)
    return found


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows") / "rows.parquet")
    data = [(None if i % 11 == 0 else f"g{i % 3}", None if i % 7 == 0 else float(i % 50), float("nan") if i % 5 == 0 else i / 3, i % 4) for i in range(2000)]
    df = spark.createDataFrame([*data, *data[:300]], "g string, v double, w double, k int").withColumn("none", F.lit(None).cast("double"))
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_quantiles_leave_rows_where_they_are_read(rows):
    grouped = ordering.column_quantiles(rows, ["v", "w"], {"m": 0.5}, ["g"])
    assert moved_rows(plan_of(grouped)) == []
    whole = plan_of(ordering.column_quantiles(rows, ["v"], {"m": 0.5}))
    assert "CartesianProduct" not in whole and moved_rows(whole) == []


def test_quantiles_of_more_groups_than_are_sent(rows, monkeypatch):
    few = ordering.column_quantiles(rows, ["v", "w"], {"m": 0.5, "q": 0.3}, ["g"]).collect()
    monkeypatch.setattr(ordering, "SENT", 2)
    many = ordering.column_quantiles(rows, ["v", "w"], {"m": 0.5, "q": 0.3}, ["g"]).collect()
    assert sorted(map(str, few)) == sorted(map(str, many)) and len(few) == 8


def test_summary_takes_its_columns_side_by_side(rows, monkeypatch):
    monkeypatch.setattr(profile, "TOGETHER", 2)
    columns = ["v", "w", "k", "none"]
    summary = profile.numeric_summary(rows, columns)
    assert moved_rows(plan_of(summary)) == []
    got = {r["column"]: r["median"] for r in summary.collect()}
    pdf = rows.select(*columns).toPandas()
    assert got["none"] is None
    for c in columns[:-1]:
        assert got[c] == pytest.approx(pd.to_numeric(pdf[c]).median())
    profiled = {r["column"]: r for r in profile.profile_columns(rows, columns).collect()}
    assert profiled["none"]["p50"] is None and profiled["none"]["unique_count"] == 0
    assert profiled["w"]["p25"] == pytest.approx(round(pdf["w"].quantile(0.25), 4))


@pytest.fixture(scope="module")
def small_tables(spark, tmp_path_factory):
    """Lines and orders with null and repeated keys."""
    from tallyframe.catalog import Tables

    folder = str(tmp_path_factory.mktemp("tables"))
    lines = [(None if i % 29 == 0 else i % 60, i % 7, i % 5, 1 + i % 7, float(1 + i % 50), 100.0 + i, (i % 11) / 100, "NRA"[i % 3], "FO"[i % 2], f"1995-{1 + i % 12:02d}-{1 + i % 28:02d}") for i in range(400)]
    tables = {
        "lineitem": ([*lines, *lines[:40]], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_returnflag string, l_linestatus string, d string"),
        "orders": ([(i if i else None, i % 9, f"1995-01-{1 + i % 28:02d}") for i in range(60)], "o_orderkey bigint, o_custkey bigint, d string"),
        "customer": ([(i, f"c{i}", i % 2) for i in range(9)], "c_custkey bigint, c_name string, c_nationkey int"),
        "part": ([(i, f"b{i}", f"t{i % 3}") for i in range(7)], "p_partkey bigint, p_brand string, p_type string"),
        "supplier": ([(i, f"Supplier#{i:09d}") for i in range(5)], "s_suppkey bigint, s_name string"),
        "nation": ([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int"),
        "region": ([(0, "ASIA"), (1, None)], "r_regionkey int, r_name string"),
    }
    for name, (data, schema) in tables.items():
        df = spark.createDataFrame(data, schema)
        if "d" in df.columns:
            df = df.withColumn({"lineitem": "l_shipdate", "orders": "o_orderdate"}[name], F.to_timestamp_ntz("d")).drop("d")
        if name == "lineitem":
            df = df.withColumn("l_tax", F.col("l_linenumber") / 100)
        df.write.parquet(f"{folder}/{name}.parquet")
    return Tables(spark, folder)


def test_appointments_are_joined_once(small_tables):
    from tallyframe.catalog.facts import f4_noshow_summary

    out = f4_noshow_summary(small_tables)
    assert all("/appointments-" in f for f in out.inputFiles())
    got = {r["metric"]: r["value"] for r in out.collect()}
    lines, orders = small_tables.lineitem, small_tables.orders
    visits = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).where("l_quantity * 3 - 5 between 0 and 115 and l_shipdate >= o_orderdate")
    assert got["Total appointments (after cleaning)"] == str(visits.count())
    assert got["Total unique patients"] == str(visits.select("o_custkey").distinct().count())


def test_sales_contract_is_joined_once(small_tables):
    from tallyframe.catalog.facts import _sales_contract, f9_summary_stats

    out = f9_summary_stats(small_tables)
    assert all("/sales-" in f for f in out.inputFiles())
    got = {(r["table"], r["metric_name"]): r["metric_number"] for r in out.collect()}
    rows = _sales_contract(small_tables)
    assert got["kpis", "order_count"] == rows.count()
    assert got["kpis", "median_order_value"] == rows.toPandas()["revenue"].median()
    assert got["revenue_by_region", "nan :: order_count"] == rows.where("region is null").count()


def test_tests_on_ranks_read_written_counts(rows):
    from tallyframe.operators import inference

    out = inference.kruskal(rows, ["v"], "g")
    assert {f.split("/")[-2].split("-")[0] for f in out.inputFiles()} == {"ranks", "cells"}
    pdf = rows.select("g", "v").toPandas().dropna()
    pdf["r"], n = pdf["v"].rank(), len(pdf)
    sums = pdf.groupby("g")["r"].agg(["sum", "count"])
    ties = pdf["v"].value_counts().astype(float)
    h = (12 / (n * (n + 1)) * (sums["sum"] ** 2 / sums["count"]).sum() - 3 * (n + 1)) / (1 - (ties**3 - ties).sum() / (n**3 - n))
    assert out.first()["h_stat"] == pytest.approx(h)


def test_rows_are_dealt_to_folds_once(small_tables):
    from tallyframe.catalog.learning import _held_out
    from tallyframe.operators import learning

    out = _held_out(small_tables, lambda train, label: learning.fit_logistic(train, label, iterations=3))
    assert all("/folds-" in f for f in out.inputFiles())
    known = small_tables.lineitem.join(small_tables.part, F.col("l_partkey") == F.col("p_partkey"))
    loss = (F.col("l_extendedprice") * (1 - F.col("l_discount")) - F.col("l_quantity") * 800.0 < 0).cast("int")
    want = {r["k"]: -(-r["n"] // 5) for r in known.groupBy(loss.alias("k")).agg(F.count("*").alias("n")).collect()}
    assert {r["class"]: r["support"] for r in out.collect()} == {0: 0, 1: 0} | want


def test_samples_outside_each_fold(rows):
    from tallyframe.operators import learning

    df = rows.withColumns({"id": F.monotonically_increasing_id(), "label": (F.col("k") > 1).cast("int")}).select("id", "label", "k")
    dealt = learning.written_folds(df, "label", ["id"], 4)
    sample = learning.fold_samples(dealt, ["id"], 150, 4)
    for fold in range(4):
        want = learning.labelled_sample(dealt.where(F.col("fold") != fold), ["id"], 150)
        assert sorted(sample(fold).collect()) == sorted(want.collect())
    again = learning.stratified_folds(df, "label", ["id"], 4)
    assert sorted(dealt.collect()) == sorted(again.collect())


@pytest.fixture(scope="module")
def many_lines(spark, tmp_path_factory):
    """More lines than any bound on the rows of a fit there was (4,000)."""
    from tallyframe.catalog import Tables

    folder = str(tmp_path_factory.mktemp("many"))
    lines = [(None if i % 97 == 0 else i, i % 7, i % 5, 1 + i % 7, float(1 + i % 50), 1000.0 * (1 + i % 50) * (1 + i % 13 / 20), (i % 11) / 100, "NRA"[i % 3], "FO"[i % 2], f"1995-{1 + i % 12:02d}-{1 + i % 28:02d}") for i in range(6000)]
    schema = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, d string"
    df = spark.createDataFrame(lines, schema).withColumns({"l_tax": F.lit(0.01), "l_shipdate": F.to_timestamp_ntz("d")}).drop("d")
    df.write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, f"b{i}", f"t{i % 3}") for i in range(7)], "p_partkey bigint, p_brand string, p_type string").write.parquet(f"{folder}/part.parquet")
    return Tables(spark, folder)


def test_held_out_models_are_fitted_on_every_row_outside_the_fold(many_lines):
    from tallyframe.catalog.learning import _held_out
    from tallyframe.operators import learning

    seen = []

    def fit(train, label):
        seen.append(train.count())
        return learning.fit_logistic(train, label, iterations=3)

    held = sum(r["support"] for r in _held_out(many_lines, fit).collect())
    assert seen == [6000 - held] and held in (1200, 1201, 1202)


def test_cross_validation_fits_on_every_row_outside_each_fold(many_lines, monkeypatch):
    from tallyframe.catalog.learning import ml7_cross_validation
    from tallyframe.operators import learning

    seen = []

    def fit(train, label):
        seen.append(train.count())
        return learning.fit_logistic(train, label, iterations=3)

    monkeypatch.setattr(learning, "DEFAULT_MODELS", {"light": fit})
    out = ml7_cross_validation(many_lines).collect()
    assert len(out) == 1 and len(seen) == 5 and sum(seen) == 4 * 6000
