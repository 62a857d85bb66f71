"""Grouped aggregates. Sums and counts combine on the map side, so a hot group costs one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import exact_quantiles, join_null_safe, known, running_totals, value_ranks


def summarise(
    df: DataFrame, by: Sequence[str], measures: Mapping[str, Column], keep_null_keys: bool = True
) -> DataFrame:
    """Grouped aggregate; null keys form a group of their own unless dropped."""
    if not keep_null_keys:
        df = known(df, *by)
    return df.groupBy(*by).agg(*[m.alias(name) for name, m in measures.items()])


def revenue_measures(revenue: str, order_key: str) -> dict[str, Column]:
    return {
        "revenue_sum": F.sum(revenue), "aov": F.avg(revenue), "order_count": F.count(order_key),
    }


def leader(df: DataFrame, key: str, measure: str, lowest: bool = False) -> DataFrame:
    """The key with the highest (lowest) measure; on a tie the smallest key. Nulls never lead."""
    side = F.asc(measure) if lowest else F.desc(measure)
    return df.where(F.col(key).isNotNull() & F.col(measure).isNotNull()).orderBy(side, key).limit(1)


def share_of_total(df: DataFrame, measure: str, name: str = "share_pct") -> DataFrame:
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(name, F.try_divide(F.col(measure), total) * 100)


def rate_by(df: DataFrame, by: Sequence[str], outcome: Column) -> DataFrame:
    """Mean of a 0/1 outcome per group, next to the overall rate (rows without a key count in it)."""
    groups = df.groupBy(*by).agg(F.count(outcome).alias("n"), F.sum(outcome).alias("_hits"))
    overall = groups.agg(F.sum("_hits") / F.sum("n")).scalar()
    return known(groups, *by).select(*by, "n", (F.col("_hits") / F.col("n")).alias("rate")).withColumn("overall_rate", overall)


def rate_by_flags(df: DataFrame, flags: Sequence[str], outcome: str) -> DataFrame:
    """Outcome rate at 0 and 1 of each flag: one result for all flags, one pass."""
    cells = F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).cast("int").alias("value")) for f in flags])
    return (
        known(df.select(outcome, F.inline(cells)), "value").groupBy("flag", "value")
        .agg(F.count("*").alias("n"), F.avg(outcome).alias("rate"))
    )


def best_and_worst(df: DataFrame, key: str, outcome: str, min_count: int) -> DataFrame:
    """Groups with the highest and the lowest rate among those with enough rows."""
    groups = (
        known(df, key).groupBy(key).agg(F.count(outcome).alias("n"), F.avg(outcome).alias("rate"))
        .where(F.col("n") >= min_count)
    )
    high = groups.orderBy(F.desc("rate"), key).limit(1).withColumn("place", F.lit("highest"))
    low = groups.orderBy(F.asc("rate"), key).limit(1).withColumn("place", F.lit("lowest"))
    return high.unionByName(low)


def count_distribution(df: DataFrame, key: str, counted: str) -> DataFrame:
    """How many keys have how many rows."""
    per_key = known(df, key).groupBy(key).agg(F.count(counted).alias("rows_per_key"))
    return per_key.groupBy("rows_per_key").agg(F.count("*").alias("keys"))


def profit_table(
    df: DataFrame, by: Sequence[str], profit: str, margin: str, loss_flag: str
) -> DataFrame:
    """count, mean, median, mean margin and percent of losses per group."""
    df = known(df, *by)
    basic = df.groupBy(*by).agg(
        F.count(profit).alias("count"), F.avg(profit).alias("mean_profit"),
        F.avg(margin).alias("mean_profit_margin"), (F.avg(loss_flag) * 100).alias("pct_loss"),
    )
    middle = exact_quantiles(df, profit, {"median_profit": 0.5}, by, distinct=False).drop("n")
    return join_null_safe(basic, middle, list(by), "left").select(
        *by, "count", "mean_profit", "median_profit", "mean_profit_margin",
        F.bround("pct_loss", 2).alias("pct_loss"),
    )


def distinct_values(df: DataFrame, column: str, limit: int = 10_000) -> list:
    """Sorted values for pivot headers; refuses more than a table can have as columns."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has over {limit} values, too many for columns")
    return sorted(r[0] for r in rows)


def pivot_sum(df: DataFrame, row: str, column: str, measure: str, values: Sequence | None = None) -> DataFrame:
    """Pivot of sums with empty cells as zero."""
    values = list(values) if values is not None else distinct_values(df, column)
    return known(df, row).groupBy(row).pivot(column, values).agg(F.sum(measure)).na.fill(0.0)


def pivot_mean(df: DataFrame, row: str, column: str, measure: str, values: Sequence | None = None) -> DataFrame:
    values = list(values) if values is not None else distinct_values(df, column)
    return known(df, row).groupBy(row).pivot(column, values).agg(F.avg(measure))


def melt(wide: DataFrame, ids: Sequence[str], name: str, value: str) -> DataFrame:
    rest = [c for c in wide.columns if c not in ids]
    return wide.unpivot(list(ids), rest, name, value)


def contingency(df: DataFrame, row: str, column: str, values: Sequence | None = None) -> DataFrame:
    values = list(values) if values is not None else distinct_values(df, column)
    return known(df, row, column).groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0)


def row_shares(df: DataFrame, row: str, column: str) -> DataFrame:
    """Contingency in percent of each row key."""
    cells = known(df, row, column).groupBy(row, column).agg(F.count("*").alias("n"))
    rows = cells.groupBy(row).agg(F.sum("n").alias("_row"))
    return join_null_safe(cells, rows, [row]).select(
        row, column, "n", (F.col("n") / F.col("_row") * 100).alias("row_pct")
    )


def heatmap_facts(cells: DataFrame, row: str, column: str, measure: str) -> DataFrame:
    """Highest cell with both labels and the number of empty cells of the full grid."""
    top = F.max(F.struct(F.col(measure), F.col(column), F.col(row)))
    rows, columns = F.count_distinct(row), F.count_distinct(column)
    return cells.agg(
        F.max(measure).alias("max_value"),
        F.max_by(column, F.struct(measure, column, row)).alias("max_column"),
        F.max_by(row, F.struct(measure, column, row)).alias("max_row"),
        (rows * columns - F.count_if(F.col(measure) != 0)).alias("zero_cells"),
        top.alias("_top"),
    ).drop("_top")


def compare_populations(df: DataFrame, predicate: Column, measures: Mapping[str, Column]) -> DataFrame:
    """The same measures where the predicate holds and where it does not: ``measure, holds, rest``."""
    names = list(measures)
    row = df.agg(*[
        F.avg(F.when(side, measures[m])).alias(f"{tag}{i}")
        for i, m in enumerate(names)
        for tag, side in (("h", predicate), ("r", ~predicate))
    ])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(f"h{i}").alias("holds"), F.col(f"r{i}").alias("rest"))
        for i, m in enumerate(names)
    ])))


def gini(df: DataFrame, value: str) -> DataFrame:
    """Gini coefficient; equal values share a rank block, so only distinct values are ordered."""
    ranked = value_ranks(df, value)
    n, total = F.sum("n"), F.sum(F.col("n") * F.col(value))
    weighted = F.sum(F.col("n") * F.col("avg_rank") * F.col(value))
    return ranked.agg(
        n.alias("n"), F.try_divide(2 * weighted - (n + 1) * total, n * total).alias("gini")
    )


def concentration(df: DataFrame, key: str, measure: str, tops: Sequence[int] = (1, 3, 5, 10)) -> DataFrame:
    """Revenue and share of the n biggest keys, for several n. Only the biggest few keys are kept.

    Rows without a key count in the total but never rank.
    """
    groups = df.groupBy(key).agg(F.sum(measure).alias("_m"))
    total = groups.agg(F.sum("_m")).scalar()
    head = known(groups, key).orderBy(F.desc("_m"), key).limit(max(tops)).select("_m")
    ranked = head.agg(F.sort_array(F.collect_list("_m"), asc=False).alias("a"))
    cells = F.array(*[
        F.struct(
            F.lit(n).alias("top_n"),
            F.aggregate(F.slice("a", 1, n), F.lit(0.0), lambda s, x: s + x).alias("revenue_sum"),
        )
        for n in tops
    ])
    return ranked.select(F.inline(cells)).withColumn(
        "pct_of_total", F.try_divide(F.col("revenue_sum"), total) * 100
    )


def pareto(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Keys by measure, largest first, with the running sum and its share."""
    groups = df.groupBy(key).agg(F.sum(measure).alias(measure))
    total = groups.agg(F.sum(measure)).scalar()
    ran = running_totals(known(groups, key), [F.desc(measure), F.col(key)], {
        "position": F.lit(1).cast("bigint"), "cumulative": F.col(measure),
    })
    return ran.withColumn("cumulative_pct", F.try_divide(F.col("cumulative"), total) * 100)


def by_each_key(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """The same additive measures for several groupings in one pass: ``grouping, key, <measures>``.

    Keys go through as text; null keys are left out. ``measures`` are expressions on the row's
    own columns.
    """
    used = [c for c in df.columns if c not in keys]
    cells = [F.struct(F.lit(k).alias("grouping"), F.col(k).cast("string").alias("key")) for k in keys]
    long = df.select(*used, F.inline(F.array(*cells))).where("key is not null")
    return long.groupBy("grouping", "key").agg(*[m.alias(n) for n, m in measures.items()])


def top_key(measure: str, key: str = "key") -> Column:
    """Aggregate: the key with the highest measure, the smallest key on a tie."""
    return F.min_by(key, F.struct(-F.col(measure), F.col(key)))


def kpis(
    df: DataFrame, revenue: str, order_key: str, customer: str, pending: Column,
    leaders: Mapping[str, str],
) -> DataFrame:
    """One row of headline figures; ``leaders`` maps an output name to the key column to rank.

    Three passes: totals, the median, and all leaders with the customers' order counts together.
    """
    totals = df.agg(
        F.bround(F.sum(revenue), 2).alias("total_revenue"), F.count("*").alias("order_count"),
        F.bround(F.avg(revenue), 2).alias("avg_order_value"),
        F.count_if(pending).alias("pending_count"),
        F.bround(F.coalesce(F.sum(F.when(pending, F.col(revenue))), F.lit(0.0)), 2).alias("pending_revenue"),
    )
    middle = exact_quantiles(df, revenue, {"m": 0.5}, distinct=False).select(F.bround("m", 2)).scalar()
    keys = list(dict.fromkeys([*leaders.values(), customer]))
    slim = df.select(*keys, F.col(revenue).alias("_m"), F.col(order_key).alias("_o"))
    groups = by_each_key(slim, keys, {"revenue": F.sum("_m"), "orders": F.count("_o")})
    # one row per key of any grouping comes in; per grouping only the best key is kept
    picks = [
        F.min_by(F.when(F.col("grouping") == key, F.col("key")), F.when(
            F.col("grouping") == key, F.struct(-F.col("revenue"), F.col("key")))).alias(name)
        for name, key in leaders.items()
    ]
    mine = F.col("grouping") == customer
    facts = groups.agg(F.struct(
        *picks, F.count_if(mine & (F.col("orders") > 1)).alias("repeat"),
        F.count_if(mine & (F.col("orders") == 1)).alias("once"),
    ).alias("f")).scalar()
    return totals.withColumn("median_order_value", middle).withColumns({
        **{name: facts[name] for name in leaders},
        "repeat_customer_count": facts["repeat"], "one_time_customer_count": facts["once"],
    })
