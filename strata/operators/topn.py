"""Top-N that keeps ties, in one read of its input and without sending all rows to one task.

``rank() OVER (ORDER BY ..) <= n`` in two levels: first within each of ``SALTS`` groups of
rows (dealt by a hash of the whole row, so equal order keys spread), then over what the
groups kept. Spark limits each task's rows by rank before either exchange, so the first
moves at most n rows and their ties per task, and the second n rows and their ties per group.
The rank limit is only planned up to ``spark.sql.optimizer.windowGroupLimitThreshold``;
beyond it the boundary row is read as a scalar subquery and all rows up to it are kept, which
reads the input twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[tuple[str, bool]]  # (column, ascending)


def _sort_col(name: str, ascending: bool, reverse: bool = False) -> Column:
    asc = ascending != reverse
    c = F.col(name)
    # ascending → nulls first, descending → nulls last (Spark's defaults);
    # the reverse of one is the other.
    return c.asc_nulls_first() if asc else c.desc_nulls_last()


def _before(k: Column, b: Column, ascending: bool) -> Column:
    if ascending:  # nulls first
        return F.coalesce((k.isNull() & b.isNotNull()) | (k < b), F.lit(False))
    return F.coalesce((k.isNotNull() & b.isNull()) | (k > b), F.lit(False))


def not_after(cols: Sequence[Column], bounds: Sequence[Column], ascending: Sequence[bool]) -> Column:
    """Lexicographic ``row <= boundary`` under mixed directions."""
    cond: Column = F.lit(True)
    for k, b, asc in reversed(list(zip(cols, bounds, ascending))):
        cond = _before(k, b, asc) | (k.eqNullSafe(b) & cond)
    return cond


SALTS = 64
LIMIT_THRESHOLD = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_n_with_ties(df: DataFrame, n: int, order: Order) -> DataFrame:
    """Rows ranked ``<= n`` under ``order`` (ties at the cut all kept)."""
    if n > int(df.sparkSession.conf.get(LIMIT_THRESHOLD, "1000")):
        return _up_to_boundary(df, n, order)
    names = set(df.columns)
    salt, rank = (next(x for x in (f"{'_' * i}{c}" for i in range(2, len(names) + 3)) if x not in names) for c in ("salt", "rank"))
    by = [_sort_col(c, a) for c, a in order]
    near = df.withColumn(salt, F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    near = near.withColumn(rank, F.rank().over(Window.partitionBy(salt).orderBy(*by))).filter(F.col(rank) <= n)
    return near.withColumn(rank, F.rank().over(Window.orderBy(*by))).filter(F.col(rank) <= n).drop(salt, rank)


def _up_to_boundary(df: DataFrame, n: int, order: Order) -> DataFrame:
    names = [c for c, _ in order]
    head = df.orderBy(*[_sort_col(c, a) for c, a in order]).limit(n)
    boundary = (
        head.orderBy(*[_sort_col(c, a, reverse=True) for c, a in order])
        .limit(1)
        .select(F.struct(*names).alias("b"))
        .scalar()
    )
    cond = not_after([F.col(c) for c in names], [boundary.getField(c) for c in names], [a for _, a in order])
    return df.filter(cond)
