"""Numeric helpers that keep pandas semantics where Spark's default differs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Null, not an error, on a zero base."""
    return F.try_divide(top, bottom)


def flag(condition: Column) -> Column:
    """0/1; an unknown comparison counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def percent(share: Column) -> Column:
    return share * 100


def currency(value: Column) -> Column:
    """``$1,234``"""
    return F.concat(F.lit("$"), F.format_number(value, 0))


def jitter(value: Column, spread: float = 0.1, seed: int = 42) -> Column:
    """Seeded uniform noise in ``value ± spread``."""
    return value + (F.rand(seed) * (2 * spread) - spread)


def number_from_text(text: Column) -> Column:
    """Drop thousands commas and percent signs; null when no number is left."""
    return F.regexp_replace(text, "[,%]", "").try_cast("double")
