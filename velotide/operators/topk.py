"""Top-k by a measure.  ``orderBy(...).limit(k)`` plans as
TakeOrderedAndProject: each task keeps its own k best rows and only those
reach the final merge, so nothing unbounded is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: list[str], k: int, tie: list[str] | None = None) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in by] + [F.col(c).asc_nulls_first() for c in (tie or [])]
    return df.orderBy(*order).limit(k)
