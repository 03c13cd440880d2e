"""Small column helpers shared by several domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lower bounds of the probability bands and the label sets in use.
BAND_EDGES = [0.20, 0.50, 0.80]
CHURN_BANDS = ["Low", "Medium", "High", "Critical"]
FLOOD_BANDS = ["Aman", "Waspada", "Siaga", "Awas"]
FLOOD_BANDS_REPORT = ["Aman", "Waspada", "Siaga", "Bahaya"]


def band(value: Column, labels: Sequence[str], edges: Sequence[float] = BAND_EDGES) -> Column:
    """Left-closed bands: ``labels[i]`` holds from ``edges[i-1]`` up to but without ``edges[i]``."""
    out = F.when(value < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        out = out.when(value < edge, label)
    return out.when(value >= edges[-1], labels[-1])


def right_closed(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Buckets (edge, next edge]; null outside."""
    out = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        cond = (value > lo) & (value <= hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, for reports that are compared or shown."""
    return df.select(*[
        F.round(c, digits).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in df.dtypes
    ])
