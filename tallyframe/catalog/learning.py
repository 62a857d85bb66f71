"""Models. Fitted figures depend on the solver, so only the exact parts have an SQL twin."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import learning
from .frames import RETAIL_LINES, retail_lines, rounded
from .registry import query

CATEGORICAL = ["l_returnflag", "l_linestatus", "category"]
NUMERIC = ["sales", "l_quantity", "l_discount", "order_month", "order_year", "order_dayofweek"]
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "sales"]
#: The forest of ``ml11_feature_importance`` is fitted on at most so many labelled rows, in hash order of the key; all other models on every row.
FIT_ROWS = 4_000


def _frame(t):
    d = F.col("l_shipdate")
    return retail_lines(t).withColumns({
        "order_month": F.month(d), "order_year": F.year(d), "order_dayofweek": F.weekday(d)})


def _encoded(t, keep=("is_loss",)):
    df = _frame(t)
    plan = learning.plan_one_hot(df, CATEGORICAL, NUMERIC)
    return plan, plan.encode(df, list(keep))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS f0,
                 CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS f1,
                 CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS f2, l_quantity AS f3 FROM lineitem""")
def ml1_one_hot(t):
    plan = learning.plan_one_hot(t.lineitem, ["l_returnflag", "l_linestatus"], ["l_quantity"])
    coded = plan.encode(t.lineitem, ["l_orderkey", "l_linenumber"])
    slots = vector_to_array("features")
    return coded.select("l_orderkey", "l_linenumber", *[F.get(slots, F.lit(i)).alias(f"f{i}") for i in range(4)])


@query(f"""WITH {RETAIL_LINES}, c AS (SELECT is_loss, count(*) AS n FROM retail_lines GROUP BY 1), s AS (SELECT sum(n) AS total FROM c)
           SELECT is_loss, n, round(total / (2 * n), 9) AS weight, round((total - n) / n, 9) AS others_per_row FROM c, s""")
def ml2_class_weights(t):
    return rounded(learning.class_weights(retail_lines(t, parts=False), "is_loss"), 9, "weight", "others_per_row")


@query()
def ml3_logistic_regression(t):
    """No SQL twin: coefficients come from the solver."""
    plan, df = _encoded(t)
    model = learning.fit_logistic(df, "is_loss")
    rows = list(zip(plan.names, [float(v) for v in model.coefficients.toArray()]))
    return t.spark.createDataFrame([*rows, ("intercept", float(model.intercept))], "feature string, coefficient double")


_SLOTS = " UNION ALL ".join([f"SELECT DISTINCT '{c}_' || {c} AS feature FROM retail_lines WHERE {c} > (SELECT min({c}) FROM retail_lines)" for c in CATEGORICAL]
                            + [f"SELECT '{c}'" for c in [*NUMERIC, "intercept"]])


@query(f"""WITH {RETAIL_LINES} SELECT feature, true AS balanced FROM ({_SLOTS})""")
def ml3_score_equations(t):
    """At the optimum every score equation of the penalised fit is balanced, whatever solver found it."""
    plan, df = _encoded(t)
    equations = learning.score_equations(learning.fit_logistic(df, "is_loss"), df, "is_loss", plan.names)
    return equations.select("feature", (F.abs("residual") < 1e-3).alias("balanced"))


def _unfolded(t):
    """The labelled rows with their plain columns, and what makes features of them once they are dealt."""
    df = _frame(t)
    plan = learning.plan_one_hot(df, CATEGORICAL, NUMERIC)
    slim = df.select(*dict.fromkeys(["is_loss", *KEY, *CATEGORICAL, *NUMERIC]))
    return slim, lambda dealt: plan.encode(dealt, ["is_loss"])


def _held_out(t, fit):
    df, encode = _unfolded(t)
    dealt = learning.written_folds(df, "is_loss", KEY)
    model = fit(encode(dealt.where("fold <> 0")), "is_loss")
    held = learning.scored(model, encode(dealt.where("fold = 0")), "is_loss")
    return learning.classification_report(held, "label", "prediction")


@query()
def ml4_random_forest(t):
    """No SQL twin: trees depend on the learner."""
    return _held_out(t, learning.fit_deep_forest)


@query()
def ml5_boosted_trees(t):
    """No SQL twin: trees depend on the learner."""
    return _held_out(t, learning.fit_boosted)


@query(f"""WITH {RETAIL_LINES}, c AS (SELECT is_loss, count(*) AS n FROM retail_lines GROUP BY 1), f AS (SELECT CAST(unnest(range(5)) AS INTEGER) AS fold)
           SELECT is_loss, fold, CAST(n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END AS BIGINT) AS n FROM c, f""")
def ml6_stratified_folds(t):
    dealt = learning.stratified_folds(retail_lines(t, parts=False), "is_loss", KEY)
    return dealt.groupBy("is_loss", "fold").agg(F.count("*").alias("n"))


@query()
def ml7_cross_validation(t):
    """No SQL twin: figures of fitted models."""
    df, encode = _unfolded(t)
    return learning.with_best(learning.cross_validate(df, "is_loss", KEY, encode=encode))


_SCORED = f"""{RETAIL_LINES}, s AS (SELECT l_quantity AS score, is_loss FROM retail_lines)"""


@query(f"""WITH {_SCORED}, c AS (SELECT score, count(*) AS c, sum(is_loss) AS p FROM s GROUP BY 1),
           r AS (SELECT *, sum(c) OVER (ORDER BY score) - (c - 1) / 2 AS rk FROM c),
           x AS (SELECT sum(p * rk) AS r, sum(p)::DOUBLE AS pos, sum(c - p)::DOUBLE AS neg FROM r)
           SELECT round((r - pos * (pos + 1) / 2) / (pos * neg), 9) AS auroc FROM x""")
def ml8_auroc(t):
    return rounded(learning.auroc(retail_lines(t, parts=False), "l_quantity", "is_loss"), 9, "auroc")


@query(f"""WITH {_SCORED}, n AS (SELECT count(*) FILTER (WHERE is_loss = 1 AND score >= 40)::DOUBLE AS tp, count(*) FILTER (WHERE is_loss = 0 AND score >= 40)::DOUBLE AS fp,
             count(*) FILTER (WHERE is_loss = 1 AND score < 40)::DOUBLE AS fn, count(*) FILTER (WHERE is_loss = 0 AND score < 40)::DOUBLE AS tn FROM s),
           m AS (SELECT *, (2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2 AS macro FROM n)
           SELECT CAST(0 AS INTEGER) AS class, round(tn / (tn + fn), 9) AS precision, round(tn / (tn + fp), 9) AS recall, round(2 * tn / (2 * tn + fp + fn), 9) AS f1,
                  CAST(tn + fp AS BIGINT) AS support, round(macro, 9) AS macro_f1 FROM m
           UNION ALL SELECT 1, round(tp / (tp + fp), 9), round(tp / (tp + fn), 9), round(2 * tp / (2 * tp + fp + fn), 9), CAST(tp + fn AS BIGINT), round(macro, 9) FROM m""")
def ml9_classification_report(t):
    df = retail_lines(t, parts=False).withColumn("predicted", (F.col("l_quantity") >= 40).cast("int"))
    return rounded(learning.classification_report(df, "is_loss", "predicted"), 9, "precision", "recall", "f1", "macro_f1")


@query(f"""WITH {_SCORED}, c AS (SELECT score, count(*) AS c, sum(is_loss) AS p FROM s GROUP BY 1)
           SELECT score AS threshold, round(sum(c - p) OVER w / (SELECT sum(c - p) FROM c), 9) AS fpr, round(sum(p) OVER w / (SELECT sum(p) FROM c), 9) AS tpr
           FROM c WINDOW w AS (ORDER BY score DESC)""")
def ml10_roc_points(t):
    return rounded(learning.roc_points(retail_lines(t, parts=False), "l_quantity", "is_loss"), 9, "fpr", "tpr")


@query()
def ml11_feature_importance(t):
    """No SQL twin: importances of fitted trees."""
    plan, df = _encoded(t, ["is_loss", *KEY])
    model = learning.fit_forest(learning.labelled_sample(df, KEY, FIT_ROWS), "is_loss")
    return learning.feature_importance(df, model, plan.names)


def _components(t, k=64):
    return learning.principal_components(t.embeddings, "embedding", k)


@query()
def ml12_principal_components(t):
    """No SQL twin: eigen decomposition."""
    return _components(t).variance()


@query()
def ml12_loadings(t):
    """No SQL twin: eigen decomposition."""
    return _components(t, 2).loading_table([f"e{i}" for i in range(64)])


_DIMS = range(64)
_WIDE = "wide AS (SELECT label, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS e{i}" for i in _DIMS) + " FROM embeddings)"
_CORRELATIONS = " UNION ALL ".join(
    f"SELECT {i} AS l, {j} AS r, corr(e{i}, e{j}) AS value FROM wide" for i in _DIMS for j in _DIMS if i < j)


@query(f"WITH {_WIDE} SELECT 'e' || l AS \"left\", 'e' || r AS \"right\", round(value, 6) AS value FROM ({_CORRELATIONS})")
def ml12_reconstruction(t):
    """All components together give the correlations back: loadings x variances x loadings."""
    return rounded(_components(t).reconstructed([f"e{i}" for i in _DIMS]), 6, "value")


@query()
def ml13_components_needed(t):
    """No SQL twin: eigen decomposition."""
    return _components(t).needed()


@query(f"""WITH {_WIDE}, r AS ({_CORRELATIONS}) SELECT 1.0::DOUBLE AS total, round((64 + 2 * sum(value * value)) / 4096, 9) AS squares, true AS least FROM r""")
def ml13_share_identities(t):
    """Shares add up to one, their squares to those of the correlations, and each count is the least that reaches its share."""
    fitted = _components(t)
    shares, ratio = fitted.variance(), F.col("explained_variance_ratio")
    least = fitted.needed().join(shares, F.col("components") == F.col("position")).agg(F.bool_and(
        (F.col("cumulative_variance") >= F.col("share")) & (F.col("cumulative_variance") - ratio < F.col("share")))).scalar()
    return shares.agg(F.round(F.sum(ratio), 9).alias("total"), F.round(F.sum(ratio * ratio), 9).alias("squares")).withColumn("least", least)


@query()
def ml14_group_centroids(t):
    """No SQL twin: eigen decomposition."""
    return learning.centroids(_components(t, 2).scores(["label"]), "label")


_CENTRES = "c AS (SELECT label, " + ", ".join(
    f"avg((e{i} - (SELECT avg(e{i}) FROM wide)) / (SELECT stddev_samp(e{i}) FROM wide)) AS c{i}" for i in _DIMS) + " FROM wide GROUP BY 1)"


@query(f"""WITH {_WIDE}, {_CENTRES} SELECT a.label AS "left", b.label AS "right", round({" + ".join(f"pow(a.c{i} - b.c{i}, 2)" for i in _DIMS)}, 6) AS distance
           FROM c a JOIN c b ON a.label < b.label""")
def ml14_centroid_distances(t):
    """Squared distances of the groups' centres in the space of all components: a rotation keeps them."""
    centres = learning.centroids(_components(t).scores(["label"], 64), "label", 64)
    place = F.array(*[f"pc{j + 1}" for j in _DIMS])
    a, b = (centres.select(F.col("label").alias(side), place.alias(f"_{side}")) for side in ("left", "right"))
    squares = F.zip_with("_left", "_right", lambda x, y: (x - y) * (x - y))
    return rounded(a.join(b, F.col("left") < F.col("right")).select("left", "right", F.aggregate(squares, F.lit(0.0), lambda s, x: s + x).alias("distance")), 6, "distance")


@query()
def ml15_ward_merges(t):
    """No SQL twin: merges depend on how the rows were parted into leaves."""
    return learning.ward_rows(t.embeddings, "embedding", 64)[0].merges


@query("""SELECT count(*) AS size, true AS heights_rise, true AS sizes_add_up, round(64::DOUBLE * (count(*) - 1), 3) AS squares FROM embeddings""")
def ml15_ward_identities(t):
    """The last merge holds all rows, and what the merges add to the squares inside the leaves is the whole variance."""
    tree, rows = learning.ward_rows(t.embeddings, "embedding", 64, ["vec_id"])
    inside = learning.squares_inside(t.embeddings, "embedding", rows, "vec_id")
    steps = tree.merges.agg(F.sort_array(F.collect_list(F.struct("step", "height", "size"))).alias("s"), F.max("size").alias("size"),
                            (F.sum(F.col("height") * F.col("height")) / 2).alias("merged"))
    rise = F.forall(F.zip_with(F.slice("s", 2, 2**30), F.col("s"), lambda x, y: F.coalesce(x["height"] >= y["height"] - 1e-9, F.lit(True))), lambda x: x)
    total = tree.leaves.agg(F.sum("size")).scalar()
    return steps.select("size", rise.alias("heights_rise"), (F.col("size") == total).alias("sizes_add_up"), F.round(F.col("merged") + inside, 3).alias("squares"))


@query(f"""WITH {_WIDE}, r AS ({_CORRELATIONS}) SELECT arg_max(l, value) AS "left", arg_max(r, value) AS "right",
             round(sqrt(2 * ((SELECT count(*) FROM wide) - 1) * (1 - max(value))), 6) AS height FROM r""")
def ml15_closest_columns(t):
    """The first merge of the columns' tree joins the two with the highest correlation."""
    return rounded(learning.ward_columns(t.embeddings, "embedding").merges.where("step = 0").select("left", "right", "height"), 6, "height")


@query()
def ml15_hierarchical_groups(t):
    """No SQL twin: iterative clustering."""
    return learning.hierarchical_groups(t.embeddings, "embedding", 4, ["vec_id", "label"])
