"""Customer scoring by recency, frequency and spend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bins import bin_from_rank
from ..functions.dates import days_between
from ..session import materialise
from .ordering import known, quantile_labels, row_ranks


def segment_of(r: Column, f: Column, m: Column) -> Column:
    return (
        F.when((r == 4) & (f == 4) & (m == 4), "Champions")
        .when((r >= 3) & (f >= 3) & (m >= 4), "Loyal")
        .when((r <= 2) & (f <= 2) & (m <= 2), "At Risk")
        .otherwise("Mid-tier")
    )


def rank_quartile(df: DataFrame, value: str, key: str, name: str) -> DataFrame:
    """Quartile 1..4 of the rank by (value, key)."""
    ranked = row_ranks(df, [value, key], name="_rank", totals=True)
    quartile = bin_from_rank(F.col("_rank"), F.col("_rank_total"))
    return ranked.withColumn(name, quartile).drop("_rank", "_rank_total")


def recency_frequency_spend(
    df: DataFrame, customer: str, order_key: str, moment: str, spend: str
) -> DataFrame:
    """Days since the last order (from the day after the newest), distinct orders, total spend.

    One pass: orders collapse first, so one customer with very many orders stays cheap, and the newest
    date comes from the customers' last dates, which are written once.
    """
    orders = known(df, customer).groupBy(customer, order_key).agg(
        F.max(moment).alias("_last"), F.sum(spend).alias("_spend"))
    base = materialise(orders.groupBy(customer).agg(
        F.max("_last").cast("date").alias("_last"), F.count(order_key).alias("frequency"),
        F.sum("_spend").alias("monetary"),
    ))
    reference = base.select(F.date_add(F.max("_last"), 1)).scalar()
    recency = days_between(reference, F.col("_last"))
    return base.select(customer, recency.alias("recency"), "frequency", "monetary")


def rfm_scores(df: DataFrame, customer: str, order_key: str, moment: str, spend: str) -> DataFrame:
    base = recency_frequency_spend(df, customer, order_key, moment, spend)
    scored = quantile_labels(base, "recency", [4, 3, 2, 1], "r_score")
    for value, name in (("frequency", "f_score"), ("monetary", "m_score")):
        # each order is taken on its own: in a chain every ranking would be read three times by the next
        ranked = rank_quartile(base.select(customer, value), value, customer, name)
        scored = scored.join(ranked.drop(value), customer)
    r, f, m = (F.col(c) for c in ("r_score", "f_score", "m_score"))
    return scored.select(
        customer, "recency", "frequency", F.bround("monetary", 2).alias("monetary"), r, f, m,
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_score"),
        segment_of(r, f, m).alias("segment"),
    )
