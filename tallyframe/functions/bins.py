"""Bins and bin labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(value: Column, edges: list[float], labels: list) -> Column:
    """Right-closed bins ``(e0, e1], (e1, e2], ...``; null outside the outer edges."""
    out = F.when(value <= F.lit(edges[0]), F.lit(None))
    for upper, label in zip(edges[1:], labels, strict=True):
        out = out.when(value <= F.lit(upper), F.lit(label))
    return out


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based right-closed bin of ``bins`` equal widths over ``low..high``.

    Compares with every inner edge, so a value on an edge stays in the lower bin.
    """
    step = (high - low) / bins
    above = [(value > low + step * k).cast("int") for k in range(1, bins)]
    return F.lit(1) + reduce(lambda a, b: a + b, above, F.lit(0))


def equal_width_edges(bin_number: Column, low: Column, high: Column, bins: int) -> tuple[Column, Column]:
    """Edges of a bin; the very first edge sits 0.1 % of the range lower, so ``low`` is inside."""
    step = (high - low) / bins
    left = F.when(bin_number == 1, low - (high - low) * 0.001).otherwise(low + step * (bin_number - 1))
    return left, low + step * bin_number


def _edge_text(edge: Column, digits: int) -> Column:
    """``digits`` decimals, or as many significant digits below one, without trailing zeros."""
    small = (F.abs(edge) < 1) & (edge != 0)
    places = F.when(small, digits - 1 - F.floor(F.log10(F.abs(edge)))).otherwise(F.lit(digits))
    scale = F.pow(F.lit(10.0), places)
    text = (F.rint(edge * scale) / scale).cast("decimal(38,18)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", ".0")


def interval_label(left: Column, right: Column, digits: int = 3) -> Column:
    """``(0.24, 0.32]``"""
    return F.concat(F.lit("("), _edge_text(left, digits), F.lit(", "), _edge_text(right, digits), F.lit("]"))


def histogram_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based left-closed bin with the last bin closed on both sides; ``high`` must exceed ``low``."""
    raw = F.floor(F.try_divide(value - low, high - low) * bins) + 1
    return F.when(value.isNotNull(), F.least(F.lit(bins), raw).cast("int"))


def bin_from_rank(rank: Column, total: Column, bins: int = 4) -> Column:
    """Quantile bin of a row rank 1..total, edges at interpolated positions, right-closed."""
    above = [(rank > (total - 1) * k / bins + 1).cast("int") for k in range(1, bins)]
    return F.lit(1) + reduce(lambda a, b: a + b, above, F.lit(0))


def bin_from_edges(value: Column, edges: list[Column], labels: list | None = None) -> Column:
    """Right-closed bin number of a value given the inner quantile edges, or its label."""
    labels = labels or list(range(1, len(edges) + 2))
    out = None
    for edge, label in zip(edges, labels, strict=False):
        test = value <= edge
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.when(value > edges[-1], F.lit(labels[len(edges)]))
