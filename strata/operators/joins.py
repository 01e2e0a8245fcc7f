"""Join helpers: size-checked broadcast and key-orphan (anti-join) queries.

Broadcasting is only requested for a side whose optimizer size estimate is
within a bound; beyond it the join is left to a shuffle join (and AQE may
still switch to broadcast at runtime once real sizes are known).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fallback bound when the session has no broadcast threshold configured
# (Spark's own default for spark.sql.autoBroadcastJoinThreshold).
DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def broadcast_bound(df: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` (-1 disables)."""
    try:
        value = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    except Exception:
        value = None
    if value is None:
        return DEFAULT_BROADCAST_BYTES
    value = str(value).strip().lower()
    units = {"b": 1, "k": 1024, "kb": 1024, "m": 1024 ** 2, "mb": 1024 ** 2, "g": 1024 ** 3, "gb": 1024 ** 3}
    for suffix in sorted(units, key=len, reverse=True):
        if value.endswith(suffix) and value[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(value[: -len(suffix)]) * units[suffix]
    return int(value) if value.lstrip("-").isdigit() else DEFAULT_BROADCAST_BYTES


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's ``sizeInBytes`` for this plan, or None if unavailable.

    A plan that generates rows (``explode``) is estimated by the rows that go
    in, which says nothing about the rows that come out: unknown."""
    try:
        if "Generate " in df._jdf.queryExecution().optimizedPlan().toString():
            return None
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # not a classic session / no statistics
        return None


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when the optimizer's size estimate is within the bound (default:
    the session's broadcast threshold). Unknown sizes are never small."""
    bound = broadcast_bound(df) if max_bytes is None else max_bytes
    size = estimated_bytes(df)
    return bound >= 0 and size is not None and size <= bound


def checked_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its estimated size is within the bound;
    otherwise ``df`` unchanged (a shuffle join, or AQE's runtime choice)."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


PART_BYTES = 4 << 20  # of the tables read, per partition of ``spread``
UNKNOWN_BYTES = 1 << 60  # sizes from here on stand for "unknown"


def read_bytes(df: DataFrame) -> int:
    """The size of all that this plan reads, as far as known. Unlike ``estimated_bytes`` it grows
    as the tables do: the optimizer takes a join for as large as the product of its sides."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    except Exception:  # not a classic session / no statistics
        return 0
    return sum(x for x in sizes if x < UNKNOWN_BYTES)


def spread(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` dealt by ``cols`` over a number of partitions that grows with the tables it reads.

    For an aggregate that keeps nearly every row (a distinct value per row, say): adaptive
    execution joins small shuffle partitions by their compressed bytes, and a task's hash tables
    over them grow with the input. A given number of partitions is left as it is. Not for rows
    that an aggregate would fold first: a hot value of ``cols`` comes to one task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(parts, -(-read_bytes(df) // PART_BYTES)), *cols)


def _key_frame(df: DataFrame, cols: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(n) for c, n in zip(cols, names)])


def orphan_keys(
    child: DataFrame,
    child_cols: Sequence[str],
    parent: DataFrame,
    parent_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Distinct child key values with no parent row (named as in the child).

    A null child key never matches, so it is reported as an orphan.
    """
    child_cols = list(child_cols)
    parent_cols = list(parent_cols or child_cols)
    keys = child.select(*child_cols).distinct()
    parents = checked_broadcast(_key_frame(parent, parent_cols, [f"__p{i}" for i in range(len(parent_cols))]))
    cond = [keys[c] == parents[f"__p{i}"] for i, c in enumerate(child_cols)]
    return keys.join(parents, cond, "left_anti")


def orphan_rows(
    child: DataFrame,
    child_cols: Sequence[str],
    parent: DataFrame,
    parent_cols: Sequence[str] | None = None,
    count_col: str = "orphan_rows",
) -> DataFrame:
    """Child rows with no parent, counted per key.

    The child is pre-aggregated to one row per key before the anti-join, so a
    hot key (one value on a third of the rows) is shuffled as one partial row
    per input partition, not as a third of the table.
    """
    child_cols = list(child_cols)
    parent_cols = list(parent_cols or child_cols)
    per_key = child.groupBy(*child_cols).agg(F.count(F.lit(1)).alias(count_col))
    parents = checked_broadcast(_key_frame(parent, parent_cols, [f"__p{i}" for i in range(len(parent_cols))]))
    cond = [per_key[c] == parents[f"__p{i}"] for i, c in enumerate(child_cols)]
    return per_key.join(parents, cond, "left_anti")


def uncovered_parents(
    parent: DataFrame,
    parent_cols: Sequence[str],
    child: DataFrame,
    child_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Parent keys that no child row references (coverage check)."""
    parent_cols = list(parent_cols)
    child_cols = list(child_cols or parent_cols)
    refs = _key_frame(child, child_cols, [f"__c{i}" for i in range(len(child_cols))]).distinct()
    keys = parent.select(*parent_cols)
    cond = [keys[c] == refs[f"__c{i}"] for i, c in enumerate(parent_cols)]
    return keys.join(refs, cond, "left_anti")


def key_set_difference(a: DataFrame, a_cols: Sequence[str], b: DataFrame, b_cols: Sequence[str]) -> DataFrame:
    """``EXCEPT(DISTINCT(a), DISTINCT(b))``: set difference where null = null."""
    left = a.select(*a_cols)
    right = _key_frame(b, b_cols, list(a_cols))
    return left.subtract(right)


def merge_on_keys(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full-outer merge of results that are each unique on ``keys``.

    The parts are aligned (missing columns as typed nulls), stacked with a
    union and collapsed with ``groupBy(keys).agg(max(...))``: one exchange
    with map-side combine instead of a chain of full outer joins, null keys
    matching each other as in a grouping, and every part computed in the
    same job. With no keys each part is a one-row aggregate and the result
    is one row — no cartesian product.
    """
    keys = list(keys)
    if len(parts) == 1:
        return parts[0]
    types: dict[str, object] = {}
    for p in parts:
        for f in p.schema.fields:
            types.setdefault(f.name, f.dataType)
    values = [c for c in types if c not in keys]
    aligned = [
        p.select(*[F.col(c) if c in p.columns else F.lit(None).cast(types[c]).alias(c) for c in keys + values])
        for p in parts
    ]
    stacked = aligned[0]
    for p in aligned[1:]:
        stacked = stacked.unionByName(p)
    aggs = [F.max(c).alias(c) for c in values]
    return stacked.groupBy(*keys).agg(*aggs) if keys else stacked.agg(*aggs)
