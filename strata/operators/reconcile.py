"""Reconciliation of two result sets on their keys, with a numeric tolerance.

Used to prove that a hand-written business query and the metric layer give
the same answer. Keys are matched null-safely (a blank member on one side
matches the blank member on the other).

:func:`reconcile` compares two results side by side. :func:`compare_sides` compares any
number of results of any number of questions at once: each is brought into one long form
(:func:`long_form`: question, key, measure, value), the forms are stacked, and one grouping
puts the sides of a value next to each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    tolerance: float = 1e-9,
) -> DataFrame:
    """Full outer comparison: keys, ``<v>_left``, ``<v>_right``, ``status``.

    status ∈ {match, mismatch, only_left, only_right}."""
    lk = [f"__lk{i}" for i in range(len(keys))]
    rk = [f"__rk{i}" for i in range(len(keys))]
    l = left.select(*[F.col(k).alias(a) for k, a in zip(keys, lk)], *[F.col(v).alias(f"{v}_left") for v in values],
                    F.lit(True).alias("__in_left"))
    r = right.select(*[F.col(k).alias(a) for k, a in zip(keys, rk)], *[F.col(v).alias(f"{v}_right") for v in values],
                     F.lit(True).alias("__in_right"))
    cond = [l[a].eqNullSafe(r[b]) for a, b in zip(lk, rk)]
    joined = l.join(r, cond, "full")
    same = F.lit(True)
    for v in values:
        a, b = F.col(f"{v}_left"), F.col(f"{v}_right")
        equal = (a.isNull() & b.isNull()) | F.coalesce(F.abs(a.cast("double") - b.cast("double")) <= tolerance, F.lit(False))
        same = same & equal
    status = (
        F.when(F.col("__in_right").isNull(), F.lit("only_left"))
        .when(F.col("__in_left").isNull(), F.lit("only_right"))
        .when(same, F.lit("match"))
        .otherwise(F.lit("mismatch"))
    )
    return joined.select(
        *[F.coalesce(F.col(a), F.col(b)).alias(k) for k, a, b in zip(keys, lk, rk)],
        *[c for v in values for c in (F.col(f"{v}_left"), F.col(f"{v}_right"))],
        status.alias("status"),
    )


def reconcile_summary(comparison: DataFrame) -> DataFrame:
    """One row of counters over a :func:`reconcile` result."""
    s = F.col("status")
    return comparison.agg(
        F.count(F.lit(1)).alias("compared_rows"),
        F.count(F.when(s == "match", 1)).alias("matched"),
        F.count(F.when(s == "mismatch", 1)).alias("mismatched"),
        F.count(F.when(s == "only_left", 1)).alias("only_left"),
        F.count(F.when(s == "only_right", 1)).alias("only_right"),
    )


TOTAL = "(total)"
BLANK = "(blank)"


def long_form(df: DataFrame, question: str, keys: Sequence[str], measures: dict[str, str], totals: Sequence[str] = ()) -> DataFrame:
    """question, key, measure, value (double): one row per key and measure (column -> measure name).

    Key columns are joined as text, a null one as ``(blank)``; without key columns the key is
    ``(total)``. ``totals``: columns whose sum over all keys is added under that key too, so that
    it can be held against a control total."""
    key = F.concat_ws(" | ", *[F.coalesce(F.col(k).cast("string"), F.lit(BLANK)) for k in keys]) if keys else F.lit(TOTAL)
    one = lambda name, value: F.struct(F.lit(name).alias("measure"), value.cast("double").alias("value"))
    out = df.select(F.lit(question).alias("question"), key.alias("key"), F.inline(F.array(*[one(m, F.col(c)) for c, m in measures.items()])))
    if totals and keys:
        sums = df.agg(*[F.sum(c).alias(c) for c in totals])
        out = out.unionByName(sums.select(F.lit(question).alias("question"), F.lit(TOTAL).alias("key"),
                                          F.inline(F.array(*[one(measures[c], F.col(c)) for c in totals]))))
    return out


def compare_sides(sides: dict[str, Sequence[DataFrame]], tolerance: dict[str, float]) -> DataFrame:
    """question, key, measure, one value per side, status, from the long forms of every side.

    A side takes part in a (question, measure) if it has any row of it, and a side that only has
    the total row takes part in the total only. Status: match; mismatch (sides further apart than
    the measure's tolerance, or blank on one and not on another); missing (a side that takes part
    lacks the key)."""
    stacked = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("side"), "question", "key", "measure", "value")
                                             for name, dfs in sides.items() for df in dfs])
    of = lambda name, value: F.max(F.when(F.col("side") == name, value))
    has = lambda name: F.col(f"__has_{name}")
    rows = stacked.groupBy("question", "key", "measure").agg(
        *[of(name, F.col("value")).alias(name) for name in sides],
        *[F.coalesce(of(name, F.lit(True)), F.lit(False)).alias(f"__has_{name}") for name in sides])
    # which sides know the measure by key, and which by total: a row per question and measure
    total = F.col("key") == TOTAL
    known = (rows.groupBy(F.col("question").alias("__q"), F.col("measure").alias("__m"))
             .agg(*[F.max(has(n) & ~total).alias(f"__keyed_{n}") for n in sides], *[F.max(has(n) & total).alias(f"__total_{n}") for n in sides]))
    rows = rows.join(known, (F.col("question") == F.col("__q")) & (F.col("measure") == F.col("__m")))
    due = {n: F.when(total, F.col(f"__total_{n}")).otherwise(F.col(f"__keyed_{n}")) for n in sides}
    missing = reduce(lambda a, b: a | b, [due[n] & ~has(n) for n in sides])
    present = F.array_compact(F.array(*[F.when(has(n), F.struct(F.col(n).alias("v"))) for n in sides]))
    filled = F.filter(F.transform(present, lambda x: x["v"]), lambda v: v.isNotNull())
    bound = F.lit(0.0)
    for name, allowed in tolerance.items():
        bound = F.when(F.col("measure") == name, F.lit(allowed)).otherwise(bound)
    apart = F.array_max(filled) - F.array_min(filled) > bound
    blank = (F.size(filled) > 0) & (F.size(filled) < F.size(present))
    status = F.when(missing, "missing").when(blank | F.coalesce(apart, F.lit(False)), "mismatch").otherwise("match")
    return rows.select("question", "key", "measure", *sides, status.alias("status"))


def comparison_summary(comparison: DataFrame) -> DataFrame:
    """question, measure and how many keys were compared, matched, apart and missing."""
    s = F.col("status")
    return comparison.groupBy("question", "measure").agg(
        F.count(F.lit(1)).alias("compared"), F.count_if(s == "match").alias("matched"),
        F.count_if(s == "mismatch").alias("mismatched"), F.count_if(s == "missing").alias("missing"))
