"""Repair and totals of the activity measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellflux.schema import MEASURES, TOTALS


def repaired(measure: str | Column) -> Column:
    """The measure where it is zero or more, else 0.0; so NULL and negatives become 0.0.

    NaN orders above every number in Spark and is kept.
    """
    measure = F.col(measure) if isinstance(measure, str) else measure
    return F.when(measure >= 0, measure).otherwise(F.lit(0.0))


def total_columns(of: list[str] = MEASURES) -> list[Column]:
    """One named sum per measure; pass the totals to add up earlier totals."""
    return [F.sum(source).alias(total) for source, total in zip(of, TOTALS, strict=True)]
