"""Keep one row per key.

``first_by`` is ``row_number() over (partition by keys order by ...) = 1``.
Spark plans the ``= 1`` filter as a WindowGroupLimit that runs *before* the
shuffle as well as after it, so a hot key (a third of the rows) is cut to one
row per input partition before it is exchanged.  Ties are broken by every
remaining column, so the result is deterministic (the warehouse left them
open).

Order terms are column names; a leading ``-`` means descending.  Ascending
sorts nulls first and descending nulls last (the warehouse's defaults)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType


def _term(t: str) -> tuple[str, Column]:
    if t.startswith("-"):
        return t[1:], F.col(t[1:]).desc_nulls_last()
    return t, F.col(t).asc_nulls_first()


def ordering(df: DataFrame, keys: list[str], order: list[str], tie_break: bool = True) -> list[Column]:
    """The order terms, then every other sortable column ascending."""
    cols, used = [], set(keys)
    for t in order:
        name, c = _term(t)
        used.add(name)
        cols.append(c)
    if tie_break:
        cols += [F.col(f.name).asc_nulls_first() for f in df.schema.fields
                 if f.name not in used and not isinstance(f.dataType, (MapType, VariantType))]
    return cols


def first_by(df: DataFrame, keys: list[str], order: list[str], tie_break: bool = True) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (then by all columns)."""
    w = Window.partitionBy(*keys).orderBy(*ordering(df, keys, order, tie_break))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest_by(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``by`` (SCD type 1)."""
    return first_by(df, keys, ["-" + by])
