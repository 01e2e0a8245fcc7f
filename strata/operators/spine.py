"""Date spine: one row per day between the smallest and largest date, inclusive.

Stays lazy: the bounds are a global aggregate (partial per partition, one tiny
final task) and the days are generated with ``explode(sequence(lo, hi))``.
No driver round-trip. Empty input → null bounds → zero rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.calendar import calendar_columns


def date_spine(df: DataFrame, date_col: str, out_col: str = "date") -> DataFrame:
    bounds = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"), F.max(F.col(date_col).cast("date")).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias(out_col))


def date_dimension(df: DataFrame, date_col: str) -> DataFrame:
    """Spine plus calendar attributes (a marked date table, key ``date_key``)."""
    return date_spine(df, date_col, "date").select(*calendar_columns("date"))
