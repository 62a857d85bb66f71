"""Sorting, limits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import exact_quantiles, join_null_safe, known, row_ranks


def top(df: DataFrame, measure: str, key: str, k: int, lowest: bool = False) -> DataFrame:
    """The k biggest (smallest) rows, ties by key; every task keeps only k rows."""
    return df.orderBy(F.asc(measure) if lowest else F.desc(measure), key).limit(k)


def top_and_bottom(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    return top(df, measure, key, k).withColumn("side", F.lit("top")).unionByName(
        top(df, measure, key, k, lowest=True).withColumn("side", F.lit("bottom"))
    )


def ranking_with_ends(df: DataFrame, measure: str, key: str, k: int = 3) -> DataFrame:
    """Full ranking from lowest to highest with the k lowest and k highest marked."""
    ranked = row_ranks(df, [measure, key], name="position", totals=True)
    mark = F.when(F.col("position") <= k, "lowest").when(F.col("position") > F.col("position_total") - k, "highest")
    return ranked.withColumn("mark", mark).drop("position_total")


def only_top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows whose key is among the k most frequent."""
    counts = known(df, key).groupBy(key).agg(F.count("*").alias("_n"))
    return df.join(top(counts, "_n", key, k).select(key), key, "left_semi")


def in_order(groups: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Re-index to a fixed category order; a missing category gives a row of nulls."""
    wanted = groups.sparkSession.createDataFrame(
        [(i, v) for i, v in enumerate(order)], f"position int, `{key}` string"
    )
    return wanted.join(groups, key, "left").select("position", *groups.columns)


def by_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Groups ordered by their median."""
    return exact_quantiles(known(df, group), value, {"median": 0.5}, [group], distinct=False).orderBy("median", group)


def hash_sample(df: DataFrame, key: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """``min(k, n)`` rows chosen by a seeded hash of the key: the same rows on every run."""
    return df.orderBy(F.xxhash64(*[F.col(c) for c in key], F.lit(seed)), *key).limit(k)


def distinct_sorted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def text_filter_or_first(
    df: DataFrame, text: str, pattern: str, order: Sequence[str], least: int = 2, first: int = 10
) -> DataFrame:
    """Rows matching a pattern (any case); with fewer than ``least`` hits, the first rows instead."""
    hit = F.col(text).rlike(f"(?i){pattern}")
    hits = df.select(F.count_if(hit)).scalar()
    head = df.orderBy(*order).limit(first)
    return df.where(hit & (hits >= least)).unionByName(head.where(hits < least))


def multi_select(df: DataFrame, column: str, chosen: Sequence) -> DataFrame:
    """Keep the chosen values; nothing chosen means everything."""
    return df.where(F.col(column).isin(list(chosen))) if chosen else df


def map_groups(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Look a key up and drop the rows it misses."""
    return join_null_safe(df, lookup, [key], "inner")
