"""The forest over blocks against plain loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyframe.operators import forest, learning


def coded(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(0, 1000, n), rng.integers(0, 5, n), np.round(rng.exponential(30, n)), rng.integers(0, 2, n)]
    x[:: 50, 0] = x[0, 0]
    y = ((x[:, 0] > 200 * x[:, 1]) ^ (rng.random(n) < 0.05)).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x.tolist(), "y": y})).repartition(4)
    return x, y, df.select(array_to_vector("x").alias("features"), F.col("y").cast("int"))


def test_cuts_part_all_rows_evenly(spark):
    x, y, df = coded(spark, 20_000)
    cuts, weight = forest.cut_points(df, "y")
    assert weight == pytest.approx([len(y) / (2 * (y == c).sum()) for c in (0, 1)])
    assert cuts[1].tolist() == [0.5, 1.5, 2.5, 3.5] and cuts[3].tolist() == [0.5]
    mass = np.array(weight)[y]
    for i in (0, 2):
        assert 20 <= len(cuts[i]) <= forest.BINS - 1
        bins = cuts[i].searchsorted(x[:, i])
        for b in np.unique(bins):
            inside, values = mass[bins == b].sum() / mass.sum(), x[bins == b, i]
            hot = max(mass[x[:, i] == v].sum() for v in np.unique(values)) / mass.sum()
            assert inside <= 1 / forest.BINS + hot + 1e-9


def test_ordered_doubles():
    x = np.array([-np.inf, -1e300, -2.5, -1e-320, -0.0, 0.0, 1e-320, 1.0, 1.5, 1e300, np.inf])
    whole = forest.ordered(x)
    assert (np.diff(whole) >= 0).all() and whole[4] == whole[5]
    assert forest.ordered(whole).tolist() == x.tolist()


def test_split_gains_most():
    rng = np.random.default_rng(1)
    bins, label, count = rng.integers(0, forest.BINS, (300, 3)).astype(np.uint8), rng.integers(0, 2, 300).astype(np.uint8), rng.integers(1, 4, 300)
    weight, tried = [0.7, 1.9], np.array([[2, 0]])
    hist = forest.counted(bins.ravel(), np.arange(300) * 3, label, count.astype(float), np.zeros(300, int), tried)
    good, feature, cut, left = forest.best_splits(hist, tried, weight)

    def impurity(rows):
        w = np.array([(count * (label == c) * weight[c])[rows].sum() for c in (0, 1)])
        return w.sum() * (1 - ((w / w.sum()) ** 2).sum()) if w.sum() else 0.0

    loss = {(f, c): impurity(bins[:, f] <= c) + impurity(bins[:, f] > c) for f in (0, 2) for c in range(forest.BINS - 1)}
    assert good[0] and loss[feature[0], cut[0]] == pytest.approx(min(loss.values()))
    assert left[0].tolist() == [(count * (label == c))[bins[:, feature[0]] <= cut[0]].sum() for c in (0, 1)]


@pytest.mark.parametrize("local", [1 << 20, 300])
def test_every_row_reaches_its_leaf(spark, monkeypatch, local):
    monkeypatch.setattr(forest, "LOCAL", local)
    monkeypatch.setattr(forest, "BLOCK", 700)
    monkeypatch.setattr(forest, "NODES", 8)
    monkeypatch.setattr(forest, "DEALT", 12_000)  # three trees at a time
    kept = []
    blocks_of = forest._blocks
    monkeypatch.setattr(forest, "_blocks", lambda *a: kept.append(blocks_of(*a)) or kept[-1])
    x, y, df = coded(spark, 4000)
    model = forest.fit(df, "y", 5, 9, 42)
    blocks = [(b, n, np.frombuffer(v, np.uint8).reshape(n, -1), np.frombuffer(z, np.uint8)) for b, n, v, z in kept[0].collect()]
    assert sum(n for _, n, _, _ in blocks) == 4000 and sum(z.sum() for *_, z in blocks) == y.sum()
    assert (local == 300) == any((t.feature >= 0).any() for t in model.tops)
    weight = [len(y) / (2 * (y == c).sum()) for c in (0, 1)]
    for t, tree in enumerate(model.whole(range(5))):
        mass = np.zeros((len(tree.feature), 2))
        for b, n, bins, label in blocks:
            np.add.at(mass, (tree.walk(bins), label), forest.drawn(42, t, b, n) * np.array(weight)[label])
        ended = mass.sum(1) > 0
        assert (ended == (tree.feature < 0)).all()
        assert np.allclose((mass[:, 1] / np.where(ended, mass.sum(1), 1))[ended], tree.share[ended])
        depth = np.zeros(len(tree.feature), int)
        for node in np.flatnonzero(tree.feature >= 0):
            depth[tree.left[node] : tree.left[node] + 2] = depth[node] + 1
        assert 3 < depth.max() <= 9
    whole = model.scores(df, "y").toPandas()
    monkeypatch.setattr(forest, "SENT", 1)  # a tree at a time
    again = model.scores(df, "y").toPandas()
    order = ["score", "label"]
    assert np.allclose(whole.sort_values(order), again.sort_values(order)) and len(whole) == 4000
    bins = np.stack([c.searchsorted(x[:, i]) for i, c in enumerate(model.cuts)], 1).astype(np.uint8)
    want = np.mean([t.share[t.walk(bins)] for t in model.whole(range(5))], 0)
    assert np.allclose(np.sort(whole["score"]), np.sort(want)) and whole["label"].sum() == y.sum()


def test_as_good_as_the_learner_of_small_tables(spark):
    _, _, df = coded(spark, 3000)
    _, _, held = coded(spark, 2000, seed=4)
    area = [learning.auroc(learning.scored(fit(df, "y", trees=20, depth=8), held, "y"), "score", "label").first()[0]
            for fit in (learning.fit_forest, learning.fit_deep_forest)]
    assert area[1] > area[0] - 0.02 > 0.85


def test_empty_one_class_and_null_labels(spark):
    _, _, df = coded(spark, 500)
    with pytest.raises(ValueError):
        learning.fit_deep_forest(df.where("y > 1"), "y", 3, 3)
    model = learning.fit_deep_forest(df.where("y = 1"), "y", 3, 3)
    assert {r["score"] for r in model.scores(df, "y").collect()} == {1.0}
    assert model.scores(df.where("y > 1"), "y").count() == 0
    with pytest.raises(Exception, match="a label is null"):
        learning.fit_deep_forest(df.withColumn("y", F.nullif("y", F.lit(1))), "y", 3, 3)
