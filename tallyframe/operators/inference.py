"""Tests and correlations: counts, ranks and moments are distributed, only finished statistics get a tail."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import safe_ratio
from ..functions.tails import chi_square_p, exact_u_p, fisher_p, normal_p, student_p
from ..session import written
from .ordering import known, ranked_counts
from .profile import number_cells


#: A U test without ties is exact where the smaller sample and the larger one have at most so many rows.
EXACT_SMALLER, EXACT_LARGER = 8, 500


def _ranked_groups(df: DataFrame, targets: Sequence[str], group: str) -> tuple[DataFrame, DataFrame]:
    """Per target: average ranks of the distinct values, and value counts per group.

    The counts are written once, so that the raw table is read a single time, and so are the ranks, which the sums of
    ranks and of ties both read.
    """
    raw = known(number_cells(known(df, group), targets, [group]), "number")
    cells = written(raw.groupBy("column", group, "number").agg(F.count("*").alias("c")), "cells")
    values = written(cells.groupBy("column", "number").agg(F.sum("c").alias("c")), "values")
    ranks = ranked_counts(values, "number", "c", ["column"])
    return written(ranks.select("column", "number", F.col("n").alias("ties"), "avg_rank"), "ranks"), cells


def _tie_sums(ranks: DataFrame) -> DataFrame:
    t = F.col("ties").cast("double")
    return ranks.groupBy("column").agg(
        F.sum("ties").alias("n"), F.sum(t * t * t - t).alias("tie_sum")
    )


def kruskal(df: DataFrame, targets: Sequence[str], group: str, alpha: float = 0.05) -> DataFrame:
    """Kruskal-Wallis H with tie correction for each target: H, dof, p and the verdict."""
    ranks, cells = _ranked_groups(df, targets, group)
    sums = cells.join(ranks, ["column", "number"]).groupBy("column", group).agg(
        F.sum(F.col("c") * F.col("avg_rank")).alias("r"), F.sum("c").alias("m")
    )
    spread = sums.groupBy("column").agg(
        F.sum(F.col("r") * F.col("r") / F.col("m")).alias("q"), F.count("*").alias("groups")
    )
    n = F.col("n").cast("double")
    raw = F.lit(12.0) / (n * (n + 1)) * F.col("q") - 3 * (n + 1)
    h = safe_ratio(raw, 1 - safe_ratio(F.col("tie_sum"), n * n * n - n))
    out = spread.join(_tie_sums(ranks), "column").select(
        F.col("column").alias("target"), h.alias("h_stat"), (F.col("groups") - 1).alias("dof")
    )
    return out.withColumn("p_value", chi_square_p("h_stat", "dof")).withColumn(
        "significant", F.col("p_value") < alpha
    )


def mann_whitney(df: DataFrame, targets: Sequence[str], event: str, alpha: float = 0.05) -> DataFrame:
    """Two-sided U test of event=0 against event=1 per target, with the Bonferroni verdict.

    The statistic is U of event=0. Without ties, and with at most ``EXACT_SMALLER`` and ``EXACT_LARGER`` rows in the
    two samples, p is exact, from the counts of all arrangements; otherwise it is the normal approximation with tie
    and continuity correction. z is that approximation's in both cases.
    """
    ranks, cells = _ranked_groups(df, targets, event)
    joined = cells.join(ranks, ["column", "number"])
    zero, one = F.col(event) == 0, F.col(event) == 1
    sums = joined.groupBy("column").agg(
        F.sum(F.when(zero, F.col("c") * F.col("avg_rank"))).alias("r0"),
        F.sum(F.when(zero, F.col("c"))).cast("double").alias("n0"),
        F.sum(F.when(one, F.col("c"))).cast("double").alias("n1"),
        (F.sum(F.when(zero, F.col("c") * F.col("number"))) / F.sum(F.when(zero, F.col("c")))).alias("mean_event0"),
        (F.sum(F.when(one, F.col("c") * F.col("number"))) / F.sum(F.when(one, F.col("c")))).alias("mean_event1"),
    ).join(_tie_sums(ranks), "column")
    n0, n1, n = F.col("n0"), F.col("n1"), F.col("n").cast("double")
    u = F.col("r0") - n0 * (n0 + 1) / 2
    middle = n0 * n1 / 2
    deviation = F.sqrt(n0 * n1 / 12 * ((n + 1) - F.col("tie_sum") / (n * (n - 1))))
    z = safe_ratio(F.greatest(u, n0 * n1 - u) - middle - 0.5, deviation)
    corrected = alpha / len(targets)
    countable = (F.least(n0, n1) > 0) & (F.least(n0, n1) <= EXACT_SMALLER) & (F.greatest(n0, n1) <= EXACT_LARGER) & (F.col("tie_sum") == 0)
    approximate = F.least(F.lit(1.0), normal_p(F.greatest(F.col("z"), F.lit(0.0))))
    return (
        sums.select(
            F.col("column").alias("target"), u.alias("statistic"), z.alias("z"),
            "mean_event0", "mean_event1", (F.col("mean_event1") - F.col("mean_event0")).alias("mean_diff"),
            *[F.when(countable, n).alias(name) for name, n in (("_n0", n0), ("_n1", n1))],
        )
        .withColumn("p_value", F.coalesce(exact_u_p("statistic", "_n0", "_n1"), approximate))
        .withColumn("bonferroni_significant", F.col("p_value") < corrected).drop("_n0", "_n1")
    )


def bonferroni(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Corrected threshold and how many tests pass before and after the correction."""
    threshold = F.lit(alpha) / F.count("*")
    counted = tests.agg(
        F.count("*").alias("tests"), threshold.alias("alpha_corrected"),
        F.count_if(F.col("p_value") < alpha).alias("significant_before"),
        F.sort_array(F.collect_list("p_value")).alias("_p"),
    )
    return counted.select(
        "tests", "alpha_corrected", "significant_before",
        F.size(F.filter("_p", lambda p: p < F.col("alpha_corrected"))).cast("bigint").alias("significant_after"),
    )


def chi_square(df: DataFrame, row: str, column: str, alpha: float = 0.05) -> DataFrame:
    """Test of independence; Yates' correction applies to a 2x2 table only."""
    cells = known(df, row, column).groupBy(row, column).agg(F.count("*").alias("o"))
    rows = cells.groupBy(row).agg(F.sum("o").alias("ro"))
    columns = cells.groupBy(column).agg(F.sum("o").alias("co"))
    total = cells.agg(F.sum("o")).scalar().cast("double")
    k_rows = rows.select(F.count("*")).scalar()
    k_columns = columns.select(F.count("*")).scalar()
    dof = (k_rows - 1) * (k_columns - 1)
    expected = F.col("ro") * F.col("co") / total
    gap = F.abs(F.col("o") - expected)
    yates = F.when(dof == 1, F.least(F.lit(0.5), gap)).otherwise(F.lit(0.0))
    seen = cells.join(rows, row).join(columns, column).agg(
        F.sum((gap - yates) * (gap - yates) / expected).alias("s"), F.sum(expected).alias("e"),
        F.count("*").alias("k"), F.max(gap).alias("g"), F.max(yates).alias("y"),
    )
    # An empty cell adds (0 - e)^2 / e = e, so all of them add n - sum(e of the seen cells). In a
    # 2x2 table every cell has the same gap, so an empty cell has e = gap and Yates' term follows.
    shrunk = F.col("g") - F.col("y")
    empty_2x2 = F.coalesce(safe_ratio((4 - F.col("k")) * shrunk * shrunk, F.col("g")), F.lit(0.0))
    out = seen.select(
        (F.col("s") + F.when(dof == 1, empty_2x2).otherwise(total - F.col("e"))).alias("statistic"),
        dof.cast("bigint").alias("dof"),
    )
    return out.withColumn("p_value", chi_square_p("statistic", "dof")).withColumn(
        "conclusion", F.when(F.col("p_value") < alpha, "significant").otherwise("not significant")
    )


def fisher(df: DataFrame, row: str, column: str) -> DataFrame:
    """Exact test of two 0/1 columns: the four counts, odds ratio and two-sided p."""
    counts = df.agg(*[
        F.count_if((F.col(row) == i) & (F.col(column) == j)).alias(f"n{i}{j}")
        for i in (0, 1) for j in (0, 1)
    ])
    odds = safe_ratio(
        F.col("n00").cast("double") * F.col("n11"), F.col("n01").cast("double") * F.col("n10")
    )
    return counts.withColumn("odds_ratio", odds).withColumn("p_value", fisher_p("n00", "n01", "n10", "n11"))


def correlation(x: str, y: str) -> Column:
    """Aggregate: Pearson r over the rows where both are known; null, not an error, for a constant."""
    return safe_ratio(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs, long form, from one aggregate."""
    pairs = list(combinations(range(len(columns)), 2))
    row = df.agg(*[correlation(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs])
    cells = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            r = F.lit(1.0) if i == j else F.col(f"c{min(i, j)}_{max(i, j)}")
            cells.append(F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), r.alias("r")))
    return row.select(F.inline(F.array(*cells)))


def strong_pairs(df: DataFrame, columns: Sequence[str], least: float = 0.5) -> DataFrame:
    """Each pair once, where abs(r) is above the limit."""
    return correlation_matrix(df, columns).where(
        (F.col("left") < F.col("right")) & (F.abs("r") > least)
    )


def pearson_with_target(df: DataFrame, target: str, features: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """r, t and two-sided p of each feature against the target."""
    row = df.agg(*[
        F.struct(
            F.lit(f).alias("feature"), correlation(target, f).alias("r"),
            F.count_if(F.col(target).isNotNull() & F.col(f).isNotNull()).alias("n"),
        ).alias(f"s{i}")
        for i, f in enumerate(features)
    ])
    table = row.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(features))])))
    r = F.col("r")
    exact = F.signum(r) * F.lit(float("inf"))
    t = F.when(1 - r * r > 0, r * F.sqrt(safe_ratio(F.col("n") - 2, 1 - r * r))).when(r.isNotNull(), exact)
    return table.withColumn("t_stat", t).withColumn(
        "p_value", student_p("t_stat", (F.col("n") - 2).cast("double"))
    ).withColumn("significant", F.col("p_value") < alpha)


def rank_features(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Features by the size of their correlation with the target."""
    row = df.agg(*[correlation(target, f).alias(f"r{i}") for i, f in enumerate(features)])
    table = row.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"r{i}").alias("r")) for i, f in enumerate(features)
    ])))
    return table.orderBy(F.desc(F.abs("r")), "feature")


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line y = intercept + slope * x; null for a constant x."""
    slope = safe_ratio(F.regr_sxy(y, x), F.regr_sxx(y, x))
    return df.agg(
        slope.alias("slope"), (F.regr_avgy(y, x) - slope * F.regr_avgx(y, x)).alias("intercept"),
        F.regr_count(y, x).alias("n"),
    )
