"""Ordered operators against pandas, over many slices, with hot keys, ties, nulls and copies."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators.ordering import (
    Slices,
    column_quantiles,
    exact_quantiles,
    quantile_labels,
    row_ranks,
    running_totals,
    value_ranks,
)


def skewed(rows=3000, seed=1):
    """Groups of very different size: one holds a third of all rows, one key is null."""
    rng = np.random.default_rng(seed)
    groups = np.where(rng.random(rows) < 0.34, "hot", rng.choice(list("abcdefgh"), rows))
    return pd.DataFrame({
        "id": np.arange(rows), "g": [None if g == "h" else g for g in groups],
        "v": np.where(rng.random(rows) < 0.34, 7.0, np.round(rng.normal(10, 5, rows), 1)),
        "w": rng.integers(0, 5, rows),
    })


@pytest.fixture(scope="module")
def data(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf, "id bigint, g string, v double, w bigint").repartition(6)
    return pdf, df


def test_running_total_whole_table(data):
    pdf, df = data
    out = running_totals(df, ["v", "id"], {"run": F.col("w"), "n": F.lit(1).cast("bigint")}, totals=True).toPandas()
    want = pdf.sort_values(["v", "id"])
    want["run"], want["n"] = want.w.cumsum(), np.arange(1, len(want) + 1)
    merged = out.merge(want, on="id", suffixes=("", "_want"))
    assert (merged.run == merged.run_want).all() and (merged.n == merged.n_want).all()
    assert set(out.n_total) == {len(pdf)} and set(out.run_total) == {pdf.w.sum()}


def test_running_total_per_group(data):
    pdf, df = data
    out = running_totals(df, ["v", "id"], {"run": F.col("w")}, by=["g"], totals=True).toPandas()
    want = pdf.sort_values(["v", "id"]).copy()
    want["run"] = want.groupby("g", dropna=False).w.cumsum()
    want["total"] = want.groupby("g", dropna=False).w.transform("sum")
    merged = out.merge(want, on="id", suffixes=("", "_want"))
    assert (merged.run == merged.run_want).all() and (merged.run_total == merged.total).all()


def test_descending_order(data):
    pdf, df = data
    out = row_ranks(df, [F.desc("v"), F.col("id")]).toPandas().sort_values("rank")
    assert list(out.id) == list(pdf.sort_values(["v", "id"], ascending=[False, True]).id)


def test_copies_get_every_rank_once(spark):
    df = spark.range(2000).select(F.lit("x").alias("k"), F.lit(1.0).alias("v")).repartition(7)
    ranks = [r["rank"] for r in row_ranks(df, ["v"], by=["k"]).collect()]
    assert sorted(ranks) == list(range(1, 2001))


def test_hot_group_is_spread_over_slices(spark):
    """A group of copies that fills the table must not end in one partition of the ordered step."""
    df = spark.range(4000).select(F.lit(1).alias("k"), F.spark_partition_id().alias("_origin"))
    parts = df.repartitionByRange("k", "_origin").groupBy(F.spark_partition_id().alias("p")).count()
    assert parts.agg(F.max("count")).first()[0] < 4000


def test_average_ranks(data):
    pdf, df = data
    out = value_ranks(df, "v").toPandas().set_index("v").avg_rank
    want = pdf.assign(r=pdf.v.rank()).groupby("v").r.first()
    assert np.allclose(out.sort_index(), want.sort_index())


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles(data, by):
    pdf, df = data
    out = exact_quantiles(df, "v", {"a": 0.05, "b": 0.5, "c": 0.95}, by).toPandas()
    if by:
        for row in out.itertuples():
            values = pdf[pdf.g.isna() if row.g is None else pdf.g == row.g].v
            assert np.allclose([row.a, row.b, row.c], values.quantile([0.05, 0.5, 0.95]))
            assert row.n == len(values) and row.distinct == values.nunique()
    else:
        assert np.allclose(out[["a", "b", "c"]].iloc[0], pdf.v.quantile([0.05, 0.5, 0.95]))


@pytest.mark.parametrize("values", [[3.0], [3.0, 3.0, 3.0], [1.0, 2.0], [None, 5.0, None]])
def test_quantiles_of_tiny_columns(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, "v", {"m": 0.5}).first()["m"]
    assert got == pytest.approx(pd.Series(values, dtype=float).median())


def test_quantiles_of_nothing(spark):
    row = exact_quantiles(spark.createDataFrame([], "v double"), "v", {"m": 0.5}).first()
    assert row["m"] is None


def test_quantile_labels_follow_qcut(data):
    pdf, df = data
    ids = pdf.drop_duplicates("v").head(101)
    small = df.sparkSession.createDataFrame(ids[["id", "v"]])
    out = quantile_labels(small, "v", [4, 3, 2, 1], "q").toPandas().set_index("id").q
    want = pd.qcut(ids.set_index("id").v, 4, labels=[4, 3, 2, 1]).astype(int)
    assert (out.sort_index() == want.sort_index()).all()


def test_slices_depend_on_the_row_alone(data):
    """A branch that is run again, from other partitions, puts every row where the first run did."""
    _, df = data
    keys = [(F.col("g"), False), (F.col("v"), True), (F.col("id"), False)]
    number = Slices(df, keys).number
    once = {r.id: r.s for r in df.repartition(3).select("id", number.alias("s")).collect()}
    again = {r.id: r.s for r in df.repartition(7, "w").select("id", number.alias("s")).collect()}
    assert once == again and len(set(once.values())) > 4
    placed = df.select("g", "v", "id", number.alias("s")).orderBy("g", F.desc("v"), "id").collect()
    assert [r.s for r in placed] == sorted(r.s for r in placed)


def test_hot_values_and_copies_are_split(spark):
    rows = [("x", 1.0, i) for i in range(3000)] + [("y", float(i), 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, v double, id int")
    slices = Slices(df, [(F.col("k"), False), (F.col("v"), False)])
    assert slices.is_copy is None and df.groupBy(slices.number).count().agg(F.max("count")).first()[0] < 1500
    copies = df.drop("id")
    slices = Slices(copies, [(F.col("k"), False), (F.col("v"), False)])
    assert copies.where(slices.is_copy).distinct().count() == 1
    out = running_totals(copies, ["v"], {"n": F.lit(1).cast("bigint"), "s": F.col("v")}, by=["k"], totals=True)
    hot = sorted(out.where("k = 'x'").collect(), key=lambda r: r.n)
    assert [r.n for r in hot] == list(range(1, 3001)) and all(r.s == r.n and r.n_total == 3000 for r in hot)
    assert out.where("k = 'y'").agg(F.max("s"), F.max("n")).first() == (499500.0, 1000)


def test_no_rows_are_written_down(data):
    """Running totals write nothing and sort no range; quantiles write brackets only, one row a group."""
    _, df = data
    rows = running_totals(df, ["v", "id"], {"n": F.lit(1)})._jdf.queryExecution().optimizedPlan().toString()
    assert rows.count("LogicalRDD") == df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") * rows.count("LogicalRDD [id")
    assert "RepartitionByExpression" not in rows.replace("RepartitionByExpression [6", "")
    plan = exact_quantiles(df, "v", {"m": 0.5}, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_running_total_of_nothing(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert running_totals(df, ["v"], {"n": F.lit(1)}, by=["k"], totals=True).collect() == []


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_of_long_columns(spark, by):
    """Large enough for both sketches: skew, ties over a third of all rows, outliers, nulls."""
    rng = np.random.default_rng(5)
    n = 60_000
    v = np.where(rng.random(n) < 0.34, 3.5, np.exp(rng.normal(0, 6, n)))
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < 0.8, "a", "b"), "v": v, "w": rng.normal(0, 1, n)})
    df = spark.createDataFrame(pdf).withColumn("w", F.when(F.col("w") < 2, F.col("w")))
    pdf.loc[pdf.w >= 2, "w"] = np.nan
    asked = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.999, "f": 1.0}
    got = column_quantiles(df, ["v", "w"], asked, by).toPandas()
    assert len(got) == (4 if by else 2)
    for row in got.itertuples():
        values = pdf[pdf.g == row.g][row.column] if by else pdf[row.column]
        assert row.n == values.count()
        assert list(row[-6:]) == pytest.approx(list(values.quantile(list(asked.values()))), rel=1e-12)
