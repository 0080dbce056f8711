"""Sizes, workload classes, retries and percentages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

GIB = 1024**3

# Upper size bounds (bytes) and scheduling weights per class.
CLASS_BOUNDS = {"SMALL": 10 * GIB, "MEDIUM": 100 * GIB, "LARGE": 1000 * GIB}
CLASS_WEIGHTS = {"SMALL": 1, "MEDIUM": 3, "LARGE": 8, "XLARGE": 20, "UNKNOWN": 0}


def gib(size_in_bytes: Column) -> Column:
    return size_in_bytes / F.lit(float(GIB))


def workload_class(size_in_bytes: Column, bounds: Mapping[str, int] = CLASS_BOUNDS) -> Column:
    """SMALL, MEDIUM, LARGE or XLARGE; UNKNOWN when the size was never measured."""
    return (
        F.when(size_in_bytes.isNull(), "UNKNOWN")
        .when(size_in_bytes < bounds["SMALL"], "SMALL")
        .when(size_in_bytes < bounds["MEDIUM"], "MEDIUM")
        .when(size_in_bytes < bounds["LARGE"], "LARGE")
        .otherwise("XLARGE")
    )


def workload_weight(klass: Column, weights: Mapping[str, int] = CLASS_WEIGHTS) -> Column:
    expr = F.lit(1)
    for name, weight in weights.items():
        expr = F.when(klass == name, F.lit(weight)).otherwise(expr)
    return expr


def backoff_seconds(attempt: Column, base_seconds: int) -> Column:
    """``base * 2^(attempt-1)`` once an attempt was made, else 0."""
    return F.when(attempt > 0, F.lit(base_seconds) * F.pow(F.lit(2.0), attempt - 1)).otherwise(F.lit(0.0)).cast("long")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def whole_minutes(start: Column, end: Column) -> Column:
    """Whole minutes between two timestamps, truncated."""
    return F.timestamp_diff("MINUTE", start, end)


def within_tolerance(source: Column, target: Column, percent_allowed: Column | float) -> Column:
    """Difference at most ``percent_allowed`` of the source; an empty source needs an empty target."""
    allowed = F.lit(percent_allowed) if isinstance(percent_allowed, (int, float)) else percent_allowed
    return F.when(source == 0, target == 0).otherwise(
        F.abs(source - target) / F.nullif(source, F.lit(0)) * F.lit(100.0) <= allowed
    )
