"""The pipelines on small tables in their own column contracts."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import learning, profile
from tallyframe.plans import casefile, expression, noshow, retail, sales, web, weekly


def csv(tmp_path, name, frame, encoding="utf-8"):
    path = tmp_path / name
    frame.to_csv(path, index=False, encoding=encoding)
    return str(path)


@pytest.fixture()
def sales_csv(tmp_path):
    rows = [
        ("o1", "2025-01-05", "Ann", "a@x", "North", "P1", "C1", 2, 10.0, 0.0, 20.0, "Rep1", "Completed"),
        ("o2", "15-03-2025", "Bob", None, "South", "P2", "C2", 1, 100.0, 10.0, 90.0, None, "Pending"),
        ("o3", "03-04-2025", "Ann", "a@x", "North", "P2", "C2", 7, 10.0, 0.0, 70.0, "Rep2", "Completed"),
        ("o4", "2025-02-01", "Cid", "c@x", "North", "P1", "C1", 999, 10.0, 0.0, 1.0, "Rep1", "Completed"),
        ("o5", "2025-02-02", "Cid", "c@x", "West", "P1", "C1", 1, -10.0, 0.0, -10.0, "Rep1", "Completed"),
    ]
    return csv(tmp_path, "sales.csv", pd.DataFrame(rows, columns=sales.COLUMNS))


def test_sales(spark, tmp_path, sales_csv):
    parts = sales.clean(sales.with_dates(sales.read(spark, sales_csv)))
    assert {r["order_id"]: r["reason"] for r in parts.dirty.collect()} == {
        "o4": "quantity exceeds threshold (>50); total_mismatch", "o5": "negative unit_price"}
    kept = sales.derive(parts.clean)
    assert [r["month"] for r in kept.orderBy("order_id").collect()] == ["2025-01", "2025-03", "2025-03"]
    sales.check(kept)
    row = sales.kpis(kept).first()
    # North and South tie at 90: the first name leads; a null rep never leads
    assert (row["total_revenue"], row["top_region"], row["top_sales_rep"], row["top_customer"]) == (180.0, "North", "Rep2", "Ann")
    assert (row["median_order_value"], row["pending_count"], row["pending_revenue"]) == (70.0, 1, 90.0)
    assert (row["repeat_customer_count"], row["one_time_customer_count"]) == (1, 1)
    cells = {(r["region"], r["category"]): r["revenue_sum"] for r in sales.heatmap(kept).collect()}
    assert cells == {("North", "C1"): 20.0, ("North", "C2"): 70.0, ("South", "C1"): 0.0, ("South", "C2"): 90.0}
    facts = sales.monthly_facts(kept).first()
    assert (facts["peak_month"], facts["best_growth_from"], facts["best_growth_to"], facts["last_order_count"]) == ("2025-03", "2025-01", "2025-03", 2)
    assert sales.status_facts(kept).first()["top_pending_region"] == "South"
    assert sales.customer_facts(kept).first()["repeat_customers"] == 1
    assert sales.rep_discount_leader(kept).first()["sales_rep"] == "Rep1"
    out = sales.run(spark, sales_csv, str(tmp_path / "out"))
    long = spark.read.option("header", True).csv(out["summary"])
    names = {r["table"] for r in long.select("table").distinct().collect()}
    assert names == {"kpis", *sales.tables(kept)} and long.where("metric_name = 'nan :: avg_discount'").count() == 1


def test_sales_bad_date(spark, tmp_path):
    row = ("o1", "someday", "Ann", "a@x", "North", "P1", "C1", 2, 10.0, 0.0, 20.0, "Rep1", "Completed")
    path = csv(tmp_path, "bad.csv", pd.DataFrame([row], columns=sales.COLUMNS))
    with pytest.raises(ValueError, match="o1"):
        sales.with_dates(sales.read(spark, path))


def visits():
    rows = []
    for i in range(60):
        rows.append((f"2987249{i % 20}", 1000 + i, "FM"[i % 2], f"2016-04-{1 + i % 20:02d}T10:00:00Z", f"2016-05-{1 + i % 28:02d}T00:00:00Z",
                     i, f"N{i % 3}", i % 2, 0, 1, 0, i % 3, i % 2, "Yes" if i % 4 == 0 else "No"))
    rows.append(("1", 1, "F", "2016-05-10T10:00:00Z", "2016-05-01T00:00:00Z", -1, "N0", 0, 0, 0, 0, 0, 0, "No"))
    rows.append(("2", 2, "F", "2016-05-10T10:00:00Z", "2016-05-01T00:00:00Z", 30, "N0", 0, 0, 0, 0, 0, 0, "No"))
    rows.append(("3", 3, "F", "2016-05-10T23:00:00Z", "2016-05-10T00:00:00Z", 115, "N0", 0, 0, 0, 0, 4, 0, "No"))
    rows.append(("4", 4, "F", "2016-05-10T23:00:00Z", "2016-05-10T00:00:00Z", 116, "N0", 0, 0, 0, 0, 0, 0, "No"))
    return pd.DataFrame(rows, columns=noshow.COLUMNS)


def test_noshow(spark, tmp_path):
    path = csv(tmp_path, "visits.csv", visits())
    parts = noshow.clean(noshow.parse(noshow.read(spark, path)))
    assert {r["PatientId"]: r["reason"] for r in parts.dirty.collect()} == {
        "1": "negative age", "2": "appointment before scheduled date", "4": "age > 115"}
    kept = noshow.derive(parts.clean).cache()
    same_day = kept.where("PatientId = '3'").first()
    assert (same_day["lead_days"], same_day["lead_bucket"], same_day["age_group"], same_day["handcap_binary"]) == (0, "same-day", "81+", 1)
    for name, table in {**noshow.univariate(kept), **noshow.bivariate(kept), **noshow.multivariate(kept)}.items():
        assert table.columns and table.collect() is not None, name
    overall = kept.agg(F.avg("noshow_flag")).first()[0]
    text = {r["metric"]: r["value"] for r in noshow.summary(kept, min_visits=5).collect()}
    assert text["Total appointments (after cleaning)"] == "61" and text["Overall no-show rate (%)"] == f"{overall * 100:.2f}"
    assert "No-show rate — Lead bucket 90d+ (%)" not in text
    written = noshow.run(spark, path, str(tmp_path / "out"))
    clean = spark.read.option("header", True).csv(written["clean"])
    assert clean.columns == [*noshow.COLUMNS, *noshow.DERIVED]


def retail_frame():
    rows = []
    for i in range(240):
        discount = (i % 9) / 10
        sale = 100.0 + i
        rows.append((i, f"O{i // 2}", f"{1 + i % 12}/{1 + i % 28}/{2014 + i % 4}", f"{1 + i % 12}/{1 + i % 28}/{2015 + i % 4}", f"Mode{i % 3}",
                     f"K{i % 40}", f"Name{i % 40}", f"Seg{i % 3}", "US", "City", "State", 12345, f"R{i % 4}", f"PR{i % 15}",
                     f"Cat{i % 3}", f"Sub{i % 6}", f"Café {i % 15}", sale, 1 + i % 7, discount, sale * (0.35 - discount) + i % 5))
    rows[0] = (*rows[0][:17], 0.0, 1, 0.0, 99999.0)
    return pd.DataFrame(rows, columns=retail.SALES_COLUMNS)


def test_retail(spark, tmp_path):
    sales_path = csv(tmp_path, "sales.csv", retail_frame(), "latin-1")
    visits = pd.DataFrame([[0, 1.0, 0.1, "Paid", 1.0, 0, 0.5], [3, 1.0, 0.1, "Paid", 1.0, 2, 1.0], [5, 1.0, 0.1, "Paid", 1.0, 9, 1.0]], columns=retail.WEB_COLUMNS)
    web_path = csv(tmp_path, "web.csv", visits, "latin-1")
    parts = retail.clean_sales(retail.read_sales(spark, sales_path), "sales.csv")
    dirty = parts.dirty.collect()
    # the row fails both rules, the first one counts
    assert [(r["reason"], r["source_file"]) for r in dirty] == [("sales_zero_or_negative", "sales.csv")]
    kept = retail.derive_sales(parts.clean)
    first = kept.where("`Order ID` = 'O1'").orderBy("Sales").first()
    assert str(first["Order Date"]) == "2016-03-03" and first["Product Name"] == "Café 2" and first["days_to_ship"] == 365
    assert "Country" not in kept.columns
    light = {"Logistic Regression": learning.fit_logistic, "Random Forest": lambda d, y: learning.fit_forest(d, y, trees=3, depth=3)}
    out = retail.run(spark, sales_path, web_path, str(tmp_path / "out"), light, folds=2)
    header = lambda name: spark.read.option("header", True).csv(out[name]).columns
    assert header("rfm_scores") == ["Customer ID", "Recency", "Frequency", "Monetary", "R", "F", "M", "RFM_Score", "Segment"]
    assert header("discount_breakeven") == ["Category", "breakeven_discount_bucket", "mean_profit_at_breakeven"]
    assert header("profit_by_category") == ["Category", "Sub-Category", "count", "mean_profit", "median_profit", "mean_profit_margin", "pct_loss"]
    assert header("statistical_tests") == ["test_name", "statistic", "p_value", "dof", "conclusion"]
    report = spark.read.option("header", True).csv(out["classification_report"])
    assert report.columns == retail.REPORT_HEADER and {r["model_name"] for r in report.collect()} == set(light)
    assert spark.read.option("header", True).csv(out["findings"]).first()["best_model"] in light
    df = spark.read.parquet(out["sales"])
    tests = {r["test_name"]: r for r in spark.read.option("header", True).csv(out["statistical_tests"]).collect()}
    assert len(tests) == 4 and tests["Profit ~ Category"]["dof"] == "2"
    for name, table in {**retail.explore(df), "corr": retail.correlations(df), "season": retail.seasonality(df)}.items():
        assert table.collect(), name
    scores = retail.rfm(df)
    assert scores.count() == 40
    found = retail.findings(retail.category_table(df), retail.breakeven(df), scores, focus="Cat0").first()
    # the first category only has discounts 0, 0.3 and 0.6, and 35 % is what it can bear
    assert found["focus_breakeven"] == "(0.56, 0.64]" and 0 <= found["champions_pct"] <= 100
    assert retail.segment_shares(scores).agg(F.sum("pct")).first()[0] == pytest.approx(100)
    view = retail.overview(df, parts.dirty).first()
    assert (view["clean_rows"], view["dirty_rows"]) == (239, 1)
    clean_web = retail.derive_web(retail.clean_web(retail.read_web(spark, web_path), "web.csv").clean).orderBy("Page Views").collect()
    assert [(r["converted"], r["visits_bin"]) for r in clean_web] == [(1, "1-2"), (1, "3+")]
    assert retail.explore_web(spark.read.parquet(out["web"]))["conversion_by_source"].first()["mean"] == 1.0


def test_dates_that_are_none_stop_the_plans(spark):
    bad = spark.createDataFrame([("O1", "2020-01-02", "no date")], "`Order ID` string, `Order Date` string, `Ship Date` string")
    with pytest.raises(ValueError, match="cannot parse Ship Date in row O1"):
        retail.derive_sales(bad)
    visits = spark.createDataFrame([(7, "2016-04-29T18:38:08Z", "not a date")], "AppointmentID int, ScheduledDay string, AppointmentDay string")
    with pytest.raises(ValueError, match="cannot parse AppointmentDay in row 7"):
        noshow.parse(visits)


def test_web(spark, tmp_path):
    rows = [
        [5, 1.0, 0.1, "Paid", 1.0, 0, 0.5], [5, 0.0999, 0.1, "Paid", 1.0, 0, 0.5], [5, 0.1, 1.0001, "Nope", 1.0, 0, 0.5],
        [5, 1.0, 0.1, "Nope", 1.0, 0, 0.5], [0, 1.0, 0.1, "Paid", 1.0, 0, 0.5], [5, None, 2.0, "Paid", 1.0, 0, 0.5],
        [5, 2.0, 0.2, "Direct", 3.0, 4, 1.0], [6, 3.0, 0.3, "Direct", 2.0, 4, 1.0], [7, 1.5, 0.15, "Social", 2.5, 0, 0.2],
    ]
    path = csv(tmp_path, "web.csv", pd.DataFrame(rows, columns=web.COLUMNS))
    parts = web.clean(web.read(spark, path))
    assert sorted(r["reason"] for r in parts.dirty.collect()) == sorted([
        "session_duration_too_short", "bounce_rate_out_of_range", "unknown_traffic_source", "page_views_invalid", "null_value"])
    kept = web.derive(parts.clean)
    assert kept.agg(F.sum("converted")).first()[0] == 2
    facts = web.report_facts(kept).first()
    assert (facts["best_conversion_source"], facts["lowest_bounce_source"], facts["returning_conversion"]) == ("Direct", "Paid", 1.0)
    for name, table in {**web.explore(kept), "tests": web.tests(kept), "corr": web.correlations(kept), "share": web.source_shares(kept)}.items():
        assert table.collect(), name
    assert set(web.run(spark, path, str(tmp_path / "out"))) == {"audit", "dirty", "clean", "typed", "reasons", "stats", "summary"}


def test_case_file(spark, tmp_path):
    frame = pd.DataFrame({
        "client.id": range(1, 41), "size": [5.0] * 39 + [500.0], "cost": [float(i % 7) for i in range(40)], "name": ["n"] * 40})
    frame.loc[3, "cost"] = None
    frame = pd.concat([frame, frame.iloc[[5]]])
    out = casefile.run(spark, csv(tmp_path, "any.csv", frame))
    issues = {r["issue"]: r["n"] for r in out["issues"].collect()}
    assert issues == {"duplicate row": 1, "missing value": 1, "anomalous value": 1}
    row = out["summary"].first()
    assert (row["total_rows"], row["dirty_rows"], row["pass_rate_pct"], row["top_column"]) == (41, 3, 92.7, "size")
    assert {r["column"] for r in out["statistics"].collect()} == {"size", "cost"}
    assert [r["high_variability"] for r in out["variability"].orderBy("column").collect()] == [True, False]


def patients():
    rows = []
    for i in range(60):
        genes = [8 + ((i * (g + 3)) % 17) / 5 + (2 if g == 0 and i % 2 else 0) for g in range(16)]
        rows.append([f"P{i:03d}", 1 + i * 4 % 240, expression.STAGES[i % 6], expression.RISKS[i % 3], i % 2, *genes, 5.0 + i, i % 2])
    bad = list(rows[0])
    bad[1], bad[2], bad[5] = 241, "5", -1.0
    rows.append(bad)
    return pd.DataFrame(rows, columns=expression.COLUMNS)


def test_expression(spark, tmp_path):
    df = expression.read(spark, csv(tmp_path, "genes.csv", patients()))
    parts = expression.clean(df, ["age_months"])
    assert [r["reason"] for r in parts.dirty.collect()] == [
        "negative gene expression value in expr_MYCN; age_months out of valid range [1, 240]; stage not in valid set; duplicate patient_id"]
    kept = parts.clean.cache()
    assert expression.without_dirty(df, parts.dirty).count() == 59
    tests = expression.gene_tests(kept).collect()
    assert tests[0]["target"] == "expr_MYCN" and tests[0]["bonferroni_significant"] and len(tests) == 16
    assert expression.components(kept).variance().count() == 16
    assert expression.summary(kept).count() == 18 and expression.category_counts(kept).count() == 6 + 3 + 2 + 2
    tables = {**expression.distributions(kept), **expression.clinical_tests(kept), "shares": expression.event_shares(kept, "stage"),
              "corr": expression.correlations(kept), "strong": expression.strong_correlations(kept), "clusters": expression.clusters(kept)}
    for name, table in tables.items():
        assert table.collect() is not None, name


def test_weekly(spark, tmp_path):
    rows = [
        ["2025-01-06", "East", "A", 3, 100.0, 40.0], ["2025-01-06", "East", "A", 3, 100.0, 40.0], ["2025-01-13", "West", "A", 0, 100.0, 40.0],
        ["2025-01-13", "West", "B", 1, 100.0, 140.0], ["someday", "West", "B", 1, 100.0, 40.0], ["2025-01-13", None, "B", 1, 100.0, 40.0],
    ]
    parts = weekly.clean(weekly.read(spark, csv(tmp_path, "weekly.csv", pd.DataFrame(rows, columns=weekly.COLUMNS))))
    assert sorted(r["reason"] for r in parts.dirty.collect()) == [
        "cost_exceeds_revenue", "duplicate", "invalid_date", "missing_required_field", "non_positive_units"]
    kept = weekly.derive(parts.clean)
    assert weekly.sales_summary(kept).first()["avg_profit_margin"] == 0.6
    views = weekly.dashboard(kept, regions=["East"])
    assert views["headline"].first()["total_profit"] == 60.0 and views["trend"].count() == 1


def test_profile_of_a_contract_with_blanks_in_names(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "`Page Views` bigint, `Bounce Rate` double, `Traffic Source` string")
    assert [r["column"] for r in profile.profile_columns(df).orderBy("position").collect()] == ["Page Views", "Bounce Rate", "Traffic Source"]
