"""Deterministic keyed de-duplication.

``dropDuplicates(keys)`` keeps an arbitrary survivor, so a check job and the
write job of the same lazy plan can disagree about which row survived. Here
the survivor is the smallest row under an explicit total order, computed as
``min(struct(order..., rest...))`` per key. That is an ordinary aggregate:
Spark combines it map-side before the shuffle, so a key holding a third of
all rows costs one partial row per input partition instead of one giant
sort in a single window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SURVIVOR = "__survivor"


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key; the survivor is the minimum by ``order`` then the
    remaining columns (ascending, nulls first). Column order is kept."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = [c for c in (order or others) if c not in keys]
    rest = [c for c in others if c not in order]
    survivor = F.min(F.struct(*order, *rest)).alias(_SURVIVOR)
    return (
        df.groupBy(*keys)
        .agg(survivor)
        .select(*[F.col(c) if c in keys else F.col(f"{_SURVIVOR}.{c}").alias(c) for c in df.columns])
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "record_count") -> DataFrame:
    """Keys that occur more than once, with their row count (``GROUP BY .. HAVING``)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(count_col))
        .filter(F.col(count_col) > 1)
    )
