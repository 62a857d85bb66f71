"""Loss-prediction models on tabular features, with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from itertools import combinations

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import safe_ratio
from ..session import fresh_folder, materialise, written
from . import forest
from .grouping import distinct_values
from .ordering import row_ranks, running_totals

SEED = 42


@dataclass(frozen=True)
class OneHotPlan:
    """Categories per column, the alphabetically first one dropped, plus numeric pass-through."""

    categories: Mapping[str, tuple]
    numeric: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        coded = [f"{c}_{v}" for c, values in self.categories.items() for v in values[1:]]
        return coded + list(self.numeric)

    def columns(self) -> list[Column]:
        """An unknown or null category is all zeros."""
        coded = [
            F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{c}_{v}")
            for c, values in self.categories.items() for v in values[1:]
        ]
        return coded + [F.col(c).cast("double").alias(c) for c in self.numeric]

    def encode(self, df: DataFrame, keep: Sequence[str], name: str = "features") -> DataFrame:
        wide = df.select(*keep, *[c.alias(f"_f{i}") for i, c in enumerate(self.columns())])
        slots = [f"_f{i}" for i in range(len(self.names))]
        return VectorAssembler(inputCols=slots, outputCol=name).transform(wide).drop(*slots)


def plan_one_hot(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> OneHotPlan:
    """Learn the categories; refuses a column with too many to be one-hot slots."""
    return OneHotPlan({c: tuple(distinct_values(df, c)) for c in categorical}, tuple(numeric))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (classes * n_c) per class, and its ratio of other rows to own rows."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    return counts.select(
        label, "n", (total["n"] / (total["k"] * F.col("n"))).alias("weight"),
        ((total["n"] - F.col("n")) / F.col("n")).alias("others_per_row"),
    )


def with_balanced_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weight for a 0/1 label, from one scalar aggregate."""
    s = df.agg(
        F.struct(F.count("*").alias("n"), F.sum(label).alias("pos")).alias("s")
    ).scalar()
    own = F.when(F.col(label) == 1, s["pos"]).otherwise(s["n"] - s["pos"])
    return df.withColumn(name, safe_ratio(s["n"].cast("double"), own * 2))


def with_positive_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Positives weighted by the ratio of negatives to positives, negatives by one."""
    s = df.agg(F.struct(F.count("*").alias("n"), F.sum(label).alias("pos")).alias("s")).scalar()
    ratio = safe_ratio((s["n"] - s["pos"]).cast("double"), s["pos"])
    return df.withColumn(name, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def fit_logistic(train: DataFrame, label: str, c: float = 1.0, iterations: int = 1000) -> Model:
    """Balanced logistic regression; the penalty is per unit of weight, hence 1 / (C * sum of weights)."""
    weighted = with_balanced_weight(train, label)
    mass = weighted.agg(F.sum("weight")).first()[0]
    return LogisticRegression(
        labelCol=label, featuresCol="features", weightCol="weight", maxIter=iterations,
        regParam=1.0 / (c * mass), standardization=False,
    ).fit(weighted)


def score_equations(model: Model, train: DataFrame, label: str, names: Sequence[str], c: float = 1.0) -> DataFrame:
    """feature, residual: the gradient of a ``fit_logistic`` objective at the fitted coefficients, one aggregate.

    Per feature the sum of weight * (probability - label) * value, plus coefficient / C (not for the intercept),
    as a share of the sum of weight * abs(value). Zero at the optimum.
    """
    rows = with_balanced_weight(model.transform(train), label)
    off = F.col("weight") * (F.get(vector_to_array("probability"), F.lit(1)) - F.col(label))
    values = vector_to_array("features")
    slots = [F.get(values, F.lit(i)) for i in range(len(names))] + [F.lit(1.0)]
    pull = [float(v) / c for v in model.coefficients.toArray()] + [0.0]
    cells = [
        F.struct(F.lit(name).alias("feature"), safe_ratio(
            F.sum(off * x) + F.lit(b), F.sum(F.col("weight") * F.abs(x))).alias("residual")).alias(f"s{i}")
        for i, (name, x, b) in enumerate(zip([*names, "intercept"], slots, pull))
    ]
    return rows.agg(*cells).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cells))])))


def fit_forest(train: DataFrame, label: str, trees: int = 200, depth: int = 30) -> Model:
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth, seed=SEED,
    ).fit(with_balanced_weight(train, label))


def fit_deep_forest(train: DataFrame, label: str, trees: int = 200, depth: int = 30) -> forest.Forest:
    """The forest of ``fit_forest`` for any number of rows: thresholds from every row, no row of a node or tree on the driver."""
    return forest.fit(train, label, trees, depth, SEED)


def fit_boosted(train: DataFrame, label: str, rounds: int = 200, depth: int = 6, rate: float = 0.1) -> Model:
    return GBTClassifier(
        labelCol=label, featuresCol="features", weightCol="weight", maxIter=rounds, maxDepth=depth,
        stepSize=rate, seed=SEED,
    ).fit(with_positive_weight(train, label))


def labelled_sample(df: DataFrame, key: Sequence[str], rows: int, seed: int = SEED) -> DataFrame:
    """At most ``rows`` rows, the first in seeded hash order of the key: a documented bound on what a model is fitted on."""
    place = F.xxhash64(*[F.col(c) for c in key], F.lit(seed))
    return materialise(df.orderBy(place, *key).limit(rows))


def stratified_folds(df: DataFrame, label: str, key: Sequence[str], folds: int = 5, seed: int = SEED) -> DataFrame:
    """Fold 0..folds-1 per row, dealt within each label in seeded hash order of the key."""
    hashed = df.withColumn("_h", F.xxhash64(*[F.col(c) for c in key], F.lit(seed)))
    ranked = row_ranks(hashed, ["_h", *key], by=[label], name="_r")
    return ranked.withColumn("fold", ((F.col("_r") - 1) % folds).cast("int")).drop("_h", "_r")


def written_folds(df: DataFrame, label: str, key: Sequence[str], folds: int = 5) -> DataFrame:
    """``stratified_folds`` dealt once and written to the shared folder, a folder for each fold: who asks for one reads no other."""
    dealt = stratified_folds(df, label, key, folds)
    folder = fresh_folder(df.sparkSession, "folds")
    dealt.write.partitionBy("fold").parquet(folder)
    return df.sparkSession.read.schema(dealt.schema).parquet(folder).select(*[F.col(f"`{c}`") for c in dealt.columns])


def fold_samples(dealt: DataFrame, key: Sequence[str], rows: int, folds: int) -> Callable[[int], DataFrame]:
    """For each fold the ``labelled_sample`` of the rows outside it, all from one scan of the dealt rows.

    The first rows of several folds together are among the first rows of each of them.
    """
    firsts = [labelled_sample(dealt.where(F.col("fold") == fold), key, rows) for fold in range(folds)]
    heads = reduce(DataFrame.unionByName, firsts)
    samples = [labelled_sample(heads.where(F.col("fold") != fold), key, rows) for fold in range(folds)]
    return samples.__getitem__


def scored(model: Model | forest.Forest, df: DataFrame, label: str) -> DataFrame:
    """label, score (probability of class 1) and prediction at 0.5."""
    if isinstance(model, forest.Forest):
        rows = model.scores(df, label)
    else:
        score = F.get(vector_to_array("probability"), F.lit(1))
        rows = model.transform(df).select(F.col(label).alias("label"), score.alias("score"))
    return rows.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def auroc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve by the rank formula, ties at their average rank; exact."""
    cells = df.groupBy(score).agg(F.count("*").alias("c"), F.sum(label).alias("p"))
    ran = running_totals(cells, [score], {"_upto": F.col("c")})
    rank = F.col("_upto") - (F.col("c") - 1) / 2
    sums = ran.agg(
        F.sum(F.col("p") * rank).alias("r"), F.sum("p").cast("double").alias("pos"),
        F.sum(F.col("c") - F.col("p")).cast("double").alias("neg"),
    )
    return sums.select(
        safe_ratio(
            F.col("r") - F.col("pos") * (F.col("pos") + 1) / 2, F.col("pos") * F.col("neg")
        ).alias("auroc")
    )


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """One point per distinct score, highest first: threshold, false and true positive rate."""
    cells = df.groupBy(F.col(score).alias("threshold")).agg(F.count("*").alias("c"), F.sum(label).alias("p"))
    ran = running_totals(
        cells, [F.desc("threshold")], {"tp": F.col("p"), "fp": F.col("c") - F.col("p")}, totals=True
    )
    return ran.select(
        "threshold", safe_ratio(F.col("fp").cast("double"), F.col("fp_total")).alias("fpr"),
        safe_ratio(F.col("tp").cast("double"), F.col("tp_total")).alias("tpr"),
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """precision, recall, F1 and support for classes 0 and 1, with macro F1; from four counts."""
    row = df.agg(*[
        F.count_if((F.col(label) == a) & (F.col(prediction) == b)).cast("double").alias(f"n{a}{b}")
        for a in (0, 1) for b in (0, 1)
    ])
    cells = []
    for c in (0, 1):
        hit, missed, wrong = F.col(f"n{c}{c}"), F.col(f"n{c}{1 - c}"), F.col(f"n{1 - c}{c}")
        cells.append(F.struct(
            F.lit(c).alias("class"),
            F.coalesce(safe_ratio(hit, hit + wrong), F.lit(0.0)).alias("precision"),
            F.coalesce(safe_ratio(hit, hit + missed), F.lit(0.0)).alias("recall"),
            F.coalesce(safe_ratio(2 * hit, 2 * hit + wrong + missed), F.lit(0.0)).alias("f1"),
            (hit + missed).cast("bigint").alias("support"),
        ))
    both = F.array(*cells)
    macro = (both[0]["f1"] + both[1]["f1"]) / 2
    return row.select(both.alias("a"), macro.alias("macro_f1")).select(F.inline("a"), "macro_f1")


# name -> how to fit it on (train, label)
Fitter = Callable[[DataFrame, str], Model | forest.Forest]
DEFAULT_MODELS: dict[str, Fitter] = {
    "Logistic Regression": fit_logistic,
    "Random Forest": fit_deep_forest,
    "Boosted Trees": fit_boosted,
}


def cross_validate(
    df: DataFrame, label: str, key: Sequence[str], models: Mapping[str, Fitter] | None = None,
    folds: int = 5, encode: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """AUROC and macro F1 per model: mean and population deviation over the folds, class figures
    averaged over the folds. One row of scalars per fit reaches the driver; the folds of a model are fitted side by side.

    Each model is fitted on every row outside its fold and scored on every row inside. The rows are dealt once for all
    models. ``encode`` adds the features to dealt rows, so that no vector is sorted or written; it must keep the label.
    """
    dealt = written_folds(df, label, key, folds)
    coded = encode or (lambda rows: rows)

    def figures_of(name: str, fit: Fitter, fold: int) -> tuple:
        model = fit(coded(dealt.where(F.col("fold") != fold)), label)
        held = written(scored(model, coded(dealt.where(F.col("fold") == fold)), label), "scored")
        area = auroc(held, "score", "label").first()[0]
        report = {r["class"]: r for r in classification_report(held, "label", "prediction").collect()}
        return (
            name, fold, area, report[0]["macro_f1"],
            *[float(report[c][m]) for c in (0, 1) for m in ("precision", "recall", "f1")],
        )

    records = []
    with ThreadPoolExecutor(folds) as pool:
        for name, fit in (models or DEFAULT_MODELS).items():
            one = inheritable_thread_target(df.sparkSession)(partial(figures_of, name, fit))
            records += pool.map(one, range(folds))
    figures = [f"{m}_{c}" for c in (0, 1) for m in ("precision", "recall", "f1")]
    schema = "model_name string, fold int, auroc double, f1 double, " + ", ".join(f"{f} double" for f in figures)
    runs = df.sparkSession.createDataFrame(records, schema)
    return runs.groupBy("model_name").agg(
        F.avg("auroc").alias("cv_auroc_mean"), F.stddev_pop("auroc").alias("cv_auroc_std"),
        F.avg("f1").alias("cv_f1_mean"), F.stddev_pop("f1").alias("cv_f1_std"),
        *[F.avg(f).alias(f) for f in figures],
    )


def with_best(report: DataFrame) -> DataFrame:
    """Mark the model with the highest mean AUROC."""
    best = report.orderBy(F.desc("cv_auroc_mean"), "model_name").limit(1).select("model_name").scalar()
    return report.withColumn("is_best", F.col("model_name") == best)


def feature_importance(df: DataFrame, model: Model, names: Sequence[str], k: int = 20) -> DataFrame:
    """The k most important features; the vector has one entry per feature slot."""
    values = [float(v) for v in model.featureImportances.toArray()]
    table = df.sparkSession.createDataFrame(list(zip(names, values)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


@dataclass(frozen=True)
class Components:
    """A fitted standardise-then-project step."""

    projected: DataFrame
    ratios: list[float]
    loadings: list[list[float]]

    def variance(self) -> DataFrame:
        """component, its share of the variance and the running share."""
        total, rows = 0.0, []
        for i, r in enumerate(self.ratios):
            total += r
            rows.append((i + 1, f"PC{i + 1}", r, total))
        return self.projected.sparkSession.createDataFrame(
            rows, "position int, component string, explained_variance_ratio double, cumulative_variance double"
        )

    def loading_table(self, names: Sequence[str], components: int = 2) -> DataFrame:
        rows = [
            (f"PC{j + 1}", names[i], float(row[j]))
            for i, row in enumerate(self.loadings) for j in range(components)
        ]
        return self.projected.sparkSession.createDataFrame(
            rows, "component string, feature string, loading double"
        )

    def needed(self, shares: Sequence[float] = (0.80, 0.95)) -> DataFrame:
        """How many components reach each share."""
        table = self.variance()
        cells = [
            F.struct(F.lit(s).alias("share"), F.min(
                F.when(F.col("cumulative_variance") >= s, F.col("position"))
            ).alias("components")).alias(f"s{i}")
            for i, s in enumerate(shares)
        ]
        return table.agg(*cells).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(shares))])))

    def reconstructed(self, names: Sequence[str]) -> DataFrame:
        """left, right, value: loadings x variances x loadings per pair of features, left before right.

        With all components kept that is the correlation matrix, whatever sign each component has.
        """
        kept, scale = np.array(self.loadings), len(self.loadings)
        whole = (kept * (np.array(self.ratios) * scale)) @ kept.T
        rows = [(names[i], names[j], float(whole[i, j])) for i, j in combinations(range(len(names)), 2)]
        return self.projected.sparkSession.createDataFrame(rows, "left string, right string, value double")

    def scores(self, keep: Sequence[str], components: int = 2) -> DataFrame:
        parts = vector_to_array("_pc")
        return self.projected.select(
            *keep, *[F.get(parts, F.lit(j)).alias(f"pc{j + 1}") for j in range(components)]
        )


def standardised(df: DataFrame, vector: str, name: str = "_scaled") -> DataFrame:
    scaler = StandardScaler(inputCol=vector, outputCol=name, withMean=True, withStd=True)
    return scaler.fit(df).transform(df)


def as_vector(df: DataFrame, columns: Sequence[str] | str, name: str = "_vector") -> DataFrame:
    """A vector from one array column or from several numeric columns."""
    if isinstance(columns, str) and isinstance(df.schema[columns].dataType, T.ArrayType):
        return df.withColumn(name, array_to_vector(F.col(columns).cast("array<double>")))
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def principal_components(df: DataFrame, columns: Sequence[str] | str, k: int) -> Components:
    scaled = standardised(as_vector(df, columns), "_vector")
    model = PCA(k=k, inputCol="_scaled", outputCol="_pc").fit(scaled)
    return Components(
        model.transform(scaled), [float(v) for v in model.explainedVariance.toArray()],
        model.pc.toArray().tolist(),
    )


def centroids(scores: DataFrame, group: str, components: int = 2) -> DataFrame:
    return scores.groupBy(group).agg(
        F.count("*").alias("n"), *[F.avg(f"pc{j + 1}").alias(f"pc{j + 1}") for j in range(components)]
    )


def hierarchical_groups(df: DataFrame, columns: Sequence[str] | str, k: int, keep: Sequence[str]) -> DataFrame:
    """Top-down hierarchical grouping of standardised rows.

    The learner splits a cluster by moving its centre in proportion to the centre's length, which is
    zero for centred data. All rows are therefore shifted by one first; distances stay the same.
    """
    scaled = standardised(as_vector(df, columns), "_vector")
    shifted = F.transform(vector_to_array("_scaled"), lambda x: x + 1.0)
    moved = scaled.withColumn("_moved", array_to_vector(shifted))
    model = BisectingKMeans(k=k, seed=SEED, featuresCol="_moved", predictionCol="cluster").fit(moved)
    return model.transform(moved).select(*keep, "cluster")


@dataclass(frozen=True)
class MergeTree:
    """A Ward tree over leaves numbered 0..k-1; the merge of step s makes the node k + s."""

    #: step, left, right, height, size
    merges: DataFrame
    #: leaf, position, size: leaves as the tree lists them from left to right
    leaves: DataFrame


def ward_merges(squared: np.ndarray, sizes: Sequence[int]) -> list[tuple[int, int, int, float, int]]:
    """Lance-Williams merges of groups with the given sizes and squared distances of their centres.

    A height is the distance at which two single rows would make the same sum of squares. Of equal distances
    the pair with the lowest numbers goes first.
    """
    weight = np.array(sizes, float)
    gaps = 2 * np.outer(weight, weight) / np.add.outer(weight, weight) * squared
    np.fill_diagonal(gaps, np.inf)
    node, out = list(range(len(weight))), []
    for step in range(len(weight) - 1):
        i, j = sorted(divmod(int(np.argmin(gaps)), len(gaps)))
        height, a, b = gaps[i, j], weight[i], weight[j]
        out.append((step, *sorted((node[i], node[j])), float(np.sqrt(max(height, 0.0))), int(a + b)))
        with np.errstate(invalid="ignore"):
            joined = ((a + weight) * gaps[i] + (b + weight) * gaps[j] - weight * height) / (a + b + weight)
        gaps[i, :] = gaps[:, i] = np.where(np.isfinite(gaps[i]) & np.isfinite(gaps[j]), joined, np.inf)
        gaps[j, :] = gaps[:, j] = np.inf
        gaps[i, i] = np.inf
        weight[i], node[i] = a + b, len(sizes) + step
    return out


def _merge_tree(df: DataFrame, squared: np.ndarray, sizes: Sequence[int]) -> MergeTree:
    merges = ward_merges(squared, sizes)
    members = {i: [i] for i in range(len(sizes))}
    for step, left, right, _, _ in merges:
        members[len(sizes) + step] = members.pop(left) + members.pop(right)
    listed = [(leaf, at, int(sizes[leaf])) for nodes in members.values() for at, leaf in enumerate(nodes)]
    spark = df.sparkSession
    return MergeTree(
        spark.createDataFrame(merges, "step int, left int, right int, height double, size bigint"),
        spark.createDataFrame(listed, "leaf int, position int, size bigint"),
    )


def ward_rows(df: DataFrame, columns: Sequence[str] | str, leaves: int = 256, keep: Sequence[str] = ()) -> tuple[MergeTree, DataFrame]:
    """A Ward tree of standardised rows, and the rows with their ``leaf``.

    Rows are first parted top-down into at most ``leaves`` groups, on Spark; only their centres and sizes, which
    ``leaves`` bounds, reach the driver and are merged there. Where ``leaves`` is at least the number of different
    rows, leaves are those and the tree is the plain one. An empty table has an empty tree.
    """
    scaled = standardised(as_vector(df, columns), "_vector") if not df.isEmpty() else None
    if scaled is None:
        return _merge_tree(df, np.zeros((0, 0)), []), df.select(*keep, F.lit(None).cast("int").alias("leaf"))
    parted = materialise(hierarchical_groups(df, columns, leaves, [*keep, "_scaled"]))
    found = parted.groupBy("cluster").agg(Summarizer.mean(F.col("_scaled")).alias("centre"), F.count("*").alias("n")).orderBy("cluster").collect()
    centres = np.array([r["centre"].toArray() for r in found])
    squared = ((centres[:, None] - centres[None]) ** 2).sum(-1)
    numbers = F.create_map(*[F.lit(v) for i, r in enumerate(found) for v in (r["cluster"], i)])
    rows = parted.select(*keep, numbers[F.col("cluster")].alias("leaf"))
    return _merge_tree(df, squared, [r["n"] for r in found]), rows


def squares_inside(df: DataFrame, columns: Sequence[str] | str, leaves: DataFrame, key: str, leaf: str = "leaf") -> Column:
    """Sum over the groups of the squared distances of standardised rows to their group's centre, as a scalar."""
    scaled = standardised(as_vector(df, columns), "_vector").select(key, vector_to_array("_scaled").alias("_v"))
    cells = scaled.join(leaves.select(key, leaf), key).select(leaf, F.posexplode("_v").alias("_i", "_x"))
    spread = cells.groupBy(leaf, "_i").agg((F.var_pop("_x") * F.count("*")).alias("_s"))
    return spread.agg(F.sum("_s")).scalar()


def ward_columns(df: DataFrame, columns: Sequence[str] | str) -> MergeTree:
    """A Ward tree of the standardised columns as points with one coordinate a row; leaf i is column i.

    Squared distances follow from the correlations, 2 (n - 1) (1 - r), so one aggregate over the rows is enough.
    """
    vectors = as_vector(df, columns)
    matrix = Correlation.corr(vectors, "_vector").first()[0].toArray()
    return _merge_tree(df, np.maximum(2 * (vectors.count() - 1) * (1 - matrix), 0.0), [1] * len(matrix))
