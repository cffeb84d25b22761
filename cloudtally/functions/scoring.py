"""Bands, points and weighted scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def up_to(value: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """The label of the first edge the value does not exceed, else the last label (also for NULL)."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    column = None
    for edge, label in zip(edges, labels):
        test = value <= F.lit(edge)
        column = F.when(test, F.lit(label)) if column is None else column.when(test, F.lit(label))
    return column.otherwise(F.lit(labels[-1]))


def above(value: Column, tiers: Sequence[tuple[float, float]], floor: float) -> Column:
    """The level of the first limit the value is strictly above, else the floor (also for NULL)."""
    column = None
    for limit, level in tiers:
        test = value > F.lit(limit)
        column = F.when(test, F.lit(level)) if column is None else column.when(test, F.lit(level))
    return column.otherwise(F.lit(floor))


def inside(value: Column, low: float, high: float, labels: Sequence) -> Column:
    """labels = (inside, below, above or unknown); both ends belong to the inside."""
    within, below, beyond = labels
    return (
        F.when(value.between(low, high), F.lit(within))
        .when(value < F.lit(low), F.lit(below))
        .otherwise(F.lit(beyond))
    )


def weighted(parts: Sequence[Column], weights: Sequence[float]) -> Column:
    total = None
    for part, weight in zip(parts, weights, strict=True):
        term = part * F.lit(float(weight))
        total = term if total is None else total + term
    return total
