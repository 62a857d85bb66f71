"""Tests and models against brute force on small frames."""

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.functions import tails
from tallyframe.operators import customers, grouping, inference, learning, timeline


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(3)
    n = 400
    pdf = pd.DataFrame({
        "id": np.arange(n), "g": rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]),
        "x": rng.integers(0, 12, n).astype(float), "e": rng.integers(0, 2, n)})
    pdf["y"] = pdf.x * 2 + rng.normal(0, 1, n) + (pdf.g == "a")
    return pdf, spark.createDataFrame(pdf).repartition(5)


def kruskal(pdf, value, group):
    ranks, n = pdf[value].rank(), len(pdf)
    h = 12 / (n * (n + 1)) * sum(r.sum() ** 2 / len(r) for _, r in ranks.groupby(pdf[group])) - 3 * (n + 1)
    ties = pdf[value].value_counts()
    return h / (1 - (ties**3 - ties).sum() / (n**3 - n))


def test_kruskal(sample):
    pdf, df = sample
    out = {r["target"]: r for r in inference.kruskal(df, ["x", "y"], "g").collect()}
    for c in ("x", "y"):
        assert out[c]["h_stat"] == pytest.approx(kruskal(pdf, c, "g")) and out[c]["dof"] == 2
        assert out[c]["p_value"] == pytest.approx(math.exp(-out[c]["h_stat"] / 2))


def test_kruskal_of_equal_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, v double")
    assert inference.kruskal(df, ["v"], "g").first()["h_stat"] is None


def test_mann_whitney_counts_pairs(sample):
    pdf, df = sample
    row = inference.mann_whitney(df, ["x"], "e").first()
    a, b = pdf[pdf.e == 0].x.values, pdf[pdf.e == 1].x.values
    u = (a[:, None] > b).sum() + 0.5 * (a[:, None] == b).sum()
    assert row["statistic"] == pytest.approx(u) and row["mean_diff"] == pytest.approx(b.mean() - a.mean())
    assert 0 <= row["p_value"] <= 1


@pytest.mark.parametrize("larger", [1, 2, 5, 8])
def test_u_counts_against_full_enumeration(larger):
    for smaller in range(1, 9):
        want = Counter(sum(c) - smaller * (smaller - 1) // 2 for c in combinations(range(smaller + larger), smaller))
        assert tails.u_counts(smaller, larger) == [want[u] for u in range(smaller * larger + 1)]


def test_small_mann_whitney_is_exact(spark):
    """Exact without ties and up to the stated sizes; with ties or beyond them the approximation."""
    a, b = [1.0, 4.0, 5.0], [2.0, 3.0, 7.0, 8.0, 9.0]
    df = spark.createDataFrame([(0, v, 1.0) for v in a] + [(1, v, 2.0) for v in b], "e int, x double, tied double")
    rows = {r["target"]: r for r in inference.mann_whitney(df, ["x", "tied"], "e").collect()}
    u = sum(x > y for x in a for y in b)
    splits = [sum(x > y for x in c for y in set(a + b) - set(c)) for c in combinations(a + b, 3)]
    far = sum(s >= max(u, 15 - u) for s in splits) / len(splits)
    assert rows["x"]["statistic"] == u and rows["x"]["p_value"] == pytest.approx(min(1, 2 * far))
    assert rows["tied"]["p_value"] == pytest.approx(math.erfc(rows["tied"]["z"] / math.sqrt(2)))
    many = spark.range(9).unionByName(spark.range(9, 30)).select((F.col("id") < 9).cast("int").alias("e"), F.col("id").cast("double").alias("x"))
    row = inference.mann_whitney(many, ["x"], "e").first()
    assert row["p_value"] == pytest.approx(math.erfc(row["z"] / math.sqrt(2)))
    alone = inference.mann_whitney(df.where("e = 0"), ["x"], "e").first()
    assert alone["p_value"] is None or 0 <= alone["p_value"] <= 1 or math.isnan(alone["p_value"])


@pytest.mark.parametrize("rows", [
    [("a", "x")] * 12 + [("a", "y")] * 5 + [("b", "x")] * 7 + [("b", "y")] * 11,
    [("a", "x")] * 12 + [("b", "y")] * 11,
    [("a", "x")] * 12 + [("a", "y")] * 5 + [("b", "y")] * 11,
    [("a", "x")] * 9 + [("a", "z")] * 4 + [("b", "y")] * 6 + [("c", "x")] * 3 + [("c", "y")] * 8,
])
def test_chi_square_with_empty_cells(spark, rows):
    table = pd.crosstab(pd.Series([r[0] for r in rows]), pd.Series([r[1] for r in rows])).values.astype(float)
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    dof = (table.shape[0] - 1) * (table.shape[1] - 1)
    gap = np.abs(table - expected)
    gap = gap - np.minimum(0.5, gap) if dof == 1 else gap
    row = inference.chi_square(spark.createDataFrame(rows, "r string, c string"), "r", "c").first()
    assert row["statistic"] == pytest.approx((gap**2 / expected).sum()) and row["dof"] == dof
    assert row["p_value"] == pytest.approx(tails.chi_square_tail(row["statistic"], dof))


def test_correlations(sample):
    pdf, df = sample
    got = {(r["left"], r["right"]): r["r"] for r in inference.correlation_matrix(df, ["x", "y", "e"]).collect()}
    want = pdf[["x", "y", "e"]].corr()
    assert all(v == pytest.approx(want.loc[k]) for k, v in got.items()) and len(got) == 9
    assert [(r["left"], r["right"]) for r in inference.strong_pairs(df, ["x", "y", "e"]).collect()] == [("x", "y")]
    assert [r["feature"] for r in inference.rank_features(df, "y", ["e", "x"]).collect()] == ["x", "e"]
    slope = inference.trend_line(df, "x", "y").first()
    assert [slope["slope"], slope["intercept"]] == pytest.approx(list(np.polyfit(pdf.x, pdf.y, 1)))


def test_gini(spark):
    values = [1.0, 1.0, 4.0, 10.0, 0.0]
    v = np.sort(values)
    want = (2 * (np.arange(1, 6) * v).sum() - 6 * v.sum()) / (5 * v.sum())
    df = spark.createDataFrame([(x,) for x in values], "v double")
    assert grouping.gini(df, "v").first()["gini"] == pytest.approx(want)


def test_leader_ties_go_to_the_first_key(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), (None, 9.0)], "k string, v double")
    assert grouping.leader(df, "k", "v").first()["k"] == "a"
    keys = grouping.by_each_key(df.withColumn("m", F.col("v")), ["k"], {"v": F.sum("m")})
    assert keys.agg(grouping.top_key("v")).first()[0] == "a"


def test_heatmap_counts_empty_cells(spark):
    cells = spark.createDataFrame([("n", "a", 5.0), ("s", "b", 7.0)], "r string, c string, v double")
    row = grouping.heatmap_facts(cells, "r", "c", "v").first()
    assert (row["max_row"], row["max_column"], row["zero_cells"]) == ("s", "b", 2)


def test_rfm_against_pandas(spark):
    rng = np.random.default_rng(5)
    n = 900
    pdf = pd.DataFrame({
        "customer": rng.integers(0, 97, n), "order": rng.integers(0, 400, n),
        "day": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 300, n), "D"), "spend": np.round(rng.random(n) * 100, 2)})
    out = customers.rfm_scores(spark.createDataFrame(pdf), "customer", "order", "day", "spend").toPandas().sort_values("customer")
    ref = pdf.day.max() + pd.Timedelta(days=1)
    want = pdf.groupby("customer").agg(last=("day", "max"), f=("order", "nunique"), m=("spend", "sum")).reset_index()
    want["r"] = (ref - want["last"]).dt.days
    assert list(out.r_score) == list(pd.qcut(want.r, 4, labels=[4, 3, 2, 1]).astype(int))
    assert list(out.f_score) == list(pd.qcut(want.f.rank(method="first"), 4, labels=[1, 2, 3, 4]).astype(int))
    assert list(out.m_score) == list(pd.qcut(want.m.rank(method="first"), 4, labels=[1, 2, 3, 4]).astype(int))
    assert set(out.segment) <= {"Champions", "Loyal", "At Risk", "Mid-tier"}


def test_prior_rate_of_a_hot_key(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"id": np.arange(1500), "k": np.where(rng.random(1500) < 0.5, 0, rng.integers(1, 60, 1500)), "t": rng.integers(0, 50, 1500), "f": rng.integers(0, 2, 1500)})
    out = timeline.prior_rate(spark.createDataFrame(pdf).repartition(6), "k", "t", "id", "f").toPandas().sort_values("id")
    s = pdf.sort_values(["t", "id"])
    s["c"], s["h"] = s.groupby("k").cumcount(), s.groupby("k").f.cumsum() - s.f
    s = s.sort_values("id")
    assert list(out.prior_count) == list(s.c) and list(out.prior_hits) == list(s.h)
    assert out.prior_rate.isna().sum() == pdf.k.nunique()


@pytest.mark.parametrize("period, rule", [("day", "D"), ("week", "W"), ("month", "MS")])
def test_resample_fills_gaps(spark, period, rule):
    days = pd.to_datetime(["2024-01-03", "2024-01-04", "2024-02-20", "2024-05-06"])
    df = spark.createDataFrame([(d.to_pydatetime(), 2.0) for d in days], "d timestamp_ntz, v double")
    out = timeline.resample(df, "d", period, {"s": F.sum("v"), "m": F.avg("v")}, ["s"]).orderBy("period").toPandas()
    want = pd.Series(2.0, index=days).resample(rule).agg(["sum", "mean"])
    assert [str(p) for p in out.period] == [str(p.date()) for p in want.index]
    assert list(out.s) == list(want["sum"]) and list(out.m.isna()) == list(want["mean"].isna())


def test_decomposition_adds_up(spark):
    months = pd.date_range("2020-01-01", periods=48, freq="MS")
    rows = [(m.date(), 100.0 + i + 10 * math.sin(m.month)) for i, m in enumerate(months)]
    df = spark.createDataFrame(rows, "period date, v double")
    out = timeline.decompose_monthly(df, "v").orderBy("period").toPandas()
    inner = out.dropna()
    assert len(inner) == 36 and np.allclose(inner.observed, inner.trend + inner.seasonal + inner.residual)
    assert out.groupby(out.period.astype(str).str[5:7]).seasonal.first().sum() == pytest.approx(0)


def test_auroc_and_roc(spark):
    rng = np.random.default_rng(8)
    score, label = rng.integers(0, 20, 300) / 20, rng.integers(0, 2, 300)
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": label}))
    pos, neg = score[label == 1], score[label == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert learning.auroc(df, "s", "y").first()[0] == pytest.approx(want)
    roc = learning.roc_points(df, "s", "y").orderBy(F.desc("threshold")).toPandas()
    x, y = np.r_[0, roc.fpr], np.r_[0, roc.tpr]
    assert (np.diff(x) * (y[1:] + y[:-1]) / 2).sum() == pytest.approx(want) and (x[-1], y[-1]) == (1, 1)


def test_folds_are_even_and_repeatable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"))
    a = learning.stratified_folds(df.repartition(7), "y", ["id"])
    b = learning.stratified_folds(df.repartition(3), "y", ["id"])
    counts = a.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in counts if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert a.join(b.withColumnRenamed("fold", "other"), "id").where("fold <> other").count() == 0


def test_one_hot_unknown_is_all_zero(spark):
    plan = learning.plan_one_hot(spark.createDataFrame([("b",), ("a",), ("c",)], "k string"), ["k"], [])
    assert plan.names == ["k_b", "k_c"]
    got = [list(r["features"]) for r in plan.encode(spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "k string"), []).collect()]
    assert got == [[0, 0], [1, 0], [0, 0], [0, 0]]


def test_models_learn_a_simple_rule(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"id": np.arange(400), "x": rng.normal(size=400), "k": rng.choice(["u", "v"], 400)})
    pdf["y"] = ((pdf.x + (pdf.k == "u")) > 0.8).astype(int)
    df = spark.createDataFrame(pdf)
    coded = learning.plan_one_hot(df, ["k"], ["x"]).encode(df, ["id", "y"])
    models = {"Logistic Regression": learning.fit_logistic,
              "Random Forest": lambda d, y: learning.fit_forest(d, y, trees=5, depth=4)}
    out = learning.with_best(learning.cross_validate(coded, "y", ["id"], models, folds=2)).collect()
    assert len(out) == 2 and sum(r["is_best"] for r in out) == 1
    assert all(r["cv_auroc_mean"] > 0.9 and 0 <= r["f1_1"] <= 1 for r in out)


def test_principal_components(spark):
    rng = np.random.default_rng(10)
    base = rng.normal(size=(200, 2))
    data = np.c_[base, base[:, :1] * 2 + rng.normal(0, 0.1, (200, 1)), rng.normal(size=(200, 1))]
    df = spark.createDataFrame(pd.DataFrame(data, columns=list("abcd")).assign(g=np.arange(200) % 2))
    parts = learning.principal_components(df, list("abcd"), 4)
    values = np.sort(np.linalg.eigvalsh(np.corrcoef(data.T)))[::-1]
    assert np.allclose([r["explained_variance_ratio"] for r in parts.variance().collect()], values / 4)
    needed = {r["share"]: r["components"] for r in parts.needed().collect()}
    cumulative = np.cumsum(values / 4)
    assert needed == {s: int(np.argmax(cumulative >= s) + 1) for s in (0.80, 0.95)}
    assert learning.centroids(parts.scores(["g"]), "g").count() == 2
    assert learning.hierarchical_groups(df, list("abcd"), 3, ["g"]).select("cluster").distinct().count() == 3
