"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import split_once

KEY_SEPARATOR = " | "
METRIC_SEPARATOR = " :: "


def to_long(df: DataFrame, table: str, keys: Sequence[str] | None = None) -> DataFrame:
    """table, metric_name ('key | key :: metric'), metric_value as text and, when numeric, as number."""
    if keys is None:
        keys = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    metrics = [c for c in df.columns if c not in keys]
    prefix = F.concat_ws(KEY_SEPARATOR, *[F.coalesce(F.col(k).cast("string"), F.lit("nan")) for k in keys])
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    cells = [
        F.struct(
            (F.concat(prefix, F.lit(METRIC_SEPARATOR + c)) if keys else F.lit(c)).alias("metric_name"),
            F.col(c).cast("string").alias("metric_value"),
            (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("metric_number"),
        )
        for c in metrics
    ]
    return df.select(F.lit(table).alias("table"), F.inline(F.array(*cells)))


def record_to_long(df: DataFrame, table: str) -> DataFrame:
    """A one-row record as metric rows: every column is a metric."""
    return to_long(df, table, keys=[])


def from_long(long: DataFrame, table: str, metrics: Sequence[str]) -> DataFrame:
    """One table back from the long form: a row per key, a column per metric."""
    prefix, column = split_once(F.col("metric_name"), METRIC_SEPARATOR)
    rows = long.where(F.col("table") == table).select(
        prefix.alias("prefix"), column.alias("column"), "metric_number"
    )
    return rows.groupBy("prefix").pivot("column", list(metrics)).agg(F.first("metric_number"))


def stack_tables(*tables: DataFrame) -> DataFrame:
    """Union by name; columns a table lacks become null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
