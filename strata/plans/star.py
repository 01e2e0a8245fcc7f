"""Generic star-schema builders: dimensions, bridges, facts, the date table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import dedup_by_key
from strata.operators.spine import date_dimension


def dimension(
    df: DataFrame,
    key: Sequence[str] | str,
    columns: Sequence[str | Column],
    dedup: bool = True,
) -> DataFrame:
    """Project a dimension (or bridge, with a composite key) in one select and
    keep one deterministic row per key."""
    keys = [key] if isinstance(key, str) else list(key)
    out = df.select(*columns)
    return dedup_by_key(out, keys) if dedup else out


def fact(df: DataFrame, derived: dict[str, Column], columns: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Derive columns and project the fact in the declared order (one select).

    A column of ``columns`` that is neither derived nor in ``df`` is an error,
    unless it is named in ``optional``: then the fact does without it."""
    missing = [c for c in columns if c not in derived and c not in df.columns and c not in optional]
    if missing:
        raise ValueError(f"the fact's source lacks the columns {missing}")
    return df.select(*[derived[c].alias(c) if c in derived else F.col(c)
                       for c in columns if c in derived or c in df.columns])


def date_table(df: DataFrame, date_col: str) -> DataFrame:
    """Every day from the first to the last ``date_col`` with calendar columns."""
    return date_dimension(df, date_col)
