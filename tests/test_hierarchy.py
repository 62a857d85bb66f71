"""Ward trees against merges found by trying every pair, and the score equations of the logistic fit."""

from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import learning


def plain_ward(points):
    """Heights of the merges that each add least to the sum of squares inside the groups."""
    groups, heights = [[i] for i in range(len(points))], []

    def inside(members):
        return ((points[members] - points[members].mean(0)) ** 2).sum()

    while len(groups) > 1:
        added, a, b = min((inside(x + y) - inside(x) - inside(y), x, y) for x, y in combinations(groups, 2))
        heights.append(np.sqrt(2 * max(added, 0)))
        groups = [g for g in groups if g not in (a, b)] + [a + b]
    return heights


def standard(data):
    return (data - data.mean(0)) / data.std(0, ddof=1)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    data = np.concatenate([rng.normal(c, 0.6, (7, 4)) for c in (0, 3, 9)])
    frame = pd.DataFrame(data, columns=list("abcd")).assign(key=range(21))
    return data, spark.createDataFrame(frame).repartition(3)


def test_rows_with_a_leaf_each(table):
    data, df = table
    tree, rows = learning.ward_rows(df, list("abcd"), 64, ["key"])
    merges = tree.merges.orderBy("step").collect()
    assert np.allclose([m["height"] for m in merges], plain_ward(standard(data)))
    assert merges[-1]["size"] == 21 and rows.select("leaf").distinct().count() == 21
    nodes = sorted(n for m in merges for n in (m["left"], m["right"]))
    assert nodes == list(range(40)) and all(m["left"] < m["right"] < 21 + m["step"] for m in merges)
    # every node's leaves stand side by side
    place = {r["leaf"]: r["position"] for r in tree.leaves.collect()}
    assert sorted(place.values()) == list(range(21))
    under = {i: {i} for i in range(21)}
    for m in merges:
        under[21 + m["step"]] = under[m["left"]] | under[m["right"]]
        spots = [place[x] for x in under[21 + m["step"]]]
        assert max(spots) - min(spots) == len(spots) - 1


def test_few_leaves_keep_the_variance(table):
    data, df = table
    tree, rows = learning.ward_rows(df, list("abcd"), 5, ["key"])
    assert tree.leaves.count() == 5 and tree.merges.count() == 4
    merged = tree.merges.agg(F.sum(F.col("height") * F.col("height")) / 2).first()[0]
    inside = df.select(learning.squares_inside(df, list("abcd"), rows, "key")).first()[0]
    assert merged + inside == pytest.approx((standard(data) ** 2).sum())
    assert {r["leaf"]: r["n"] for r in rows.groupBy("leaf").agg(F.count("*").alias("n")).collect()} == {r["leaf"]: r["size"] for r in tree.leaves.collect()}


def test_columns(table):
    data, df = table
    got = [m["height"] for m in learning.ward_columns(df, list("abcd")).merges.orderBy("step").collect()]
    assert np.allclose(got, plain_ward(standard(data).T))


def test_merges_of_weighted_centres():
    """Groups of several rows in one place merge as their rows do."""
    points = np.array([[0.0, 0], [0, 0], [0, 0], [2, 1], [2, 1], [5, 5], [6, 5], [6, 5]])
    centres, sizes = np.unique(points, axis=0, return_counts=True)
    squared = ((centres[:, None] - centres[None]) ** 2).sum(-1)
    got = [m[3] for m in learning.ward_merges(squared, sizes)]
    assert np.allclose(got, plain_ward(points)[-len(got):])


def test_edge_cases(spark, table):
    _, df = table
    tree, rows = learning.ward_rows(df.limit(0), list("abcd"), 8, ["key"])
    assert tree.merges.count() == tree.leaves.count() == rows.count() == 0 and rows.columns == ["key", "leaf"]
    one = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 3.0), (3, 4.0, 1.0)], "key int, a double, b double")
    tree, rows = learning.ward_rows(one, ["a", "b"], 8, ["key"])
    leaf = {r["key"]: r["leaf"] for r in rows.collect()}
    assert leaf[1] == leaf[2] != leaf[3] and [m["size"] for m in tree.merges.collect()] == [3]


def test_score_equations(spark):
    """Balanced at the optimum, and not a little away from it."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] + rng.normal(size=400) > 0.5).astype(int)
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(y=y)))
    model = learning.fit_logistic(df, "y")
    out = {r["feature"]: r["residual"] for r in learning.score_equations(model, df, "y", ["a", "b"]).collect()}
    assert set(out) == {"a", "b", "intercept"} and max(map(abs, out.values())) < 1e-4
    early = learning.fit_logistic(df, "y", iterations=1)
    assert max(abs(r["residual"]) for r in learning.score_equations(early, df, "y", ["a", "b"]).collect()) > 1e-3
