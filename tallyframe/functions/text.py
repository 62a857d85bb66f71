"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_from_slug(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def contains_ci(text: Column, needle: str) -> Column:
    return F.contains(F.lower(text), F.lit(needle.lower()))


def label_or(text: Column, default: str) -> Column:
    return F.coalesce(text, F.lit(default))


def split_once(text: Column, separator: str) -> tuple[Column, Column]:
    """Part before and part after the first separator (null when it is missing)."""
    pieces = F.split(text, f"\\Q{separator}\\E", 2)
    return F.get(pieces, F.lit(0)), F.get(pieces, F.lit(1))


def recode(value: Column, labels: dict) -> Column:
    """Literal map; values outside it become null."""
    chosen = None
    for key, label in labels.items():
        test = value == F.lit(key)
        chosen = F.when(test, F.lit(label)) if chosen is None else chosen.when(test, F.lit(label))
    return chosen
