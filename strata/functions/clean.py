"""Declarative cleaning: trim, blank→null, value standardisation, typed casts.

A :class:`CleanSpec` is applied in **one** ``select`` (no ``withColumn``
chains), column order preserved. Casts are ``try_cast``: with ANSI mode on, a
plain cast of ``'x'`` to int raises, while the layered flow wants a null plus
a count of rejected values (see :func:`cast_rejects`).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.schema import TableSpec


def blank_to_null(c: Column | str) -> Column:
    """Trim spaces; an empty result becomes null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def trimmed(c: Column | str) -> Column:
    """Trim spaces only; an empty string stays ``''``."""
    return F.trim(_col(c))


def typed(c: Column | str, dtype: str) -> Column:
    """Cast that yields null instead of failing on malformed input."""
    return _col(c).try_cast(dtype)


def value_map(c: Column | str, mapping: dict[str, str]) -> Column:
    """Exact-match replacement; unmatched values pass through unchanged."""
    c = _col(c)
    if not mapping:
        return c
    expr = None
    for src, dst in mapping.items():
        expr = (F.when(c == F.lit(src), F.lit(dst)) if expr is None else expr.when(c == F.lit(src), F.lit(dst)))
    return expr.otherwise(c)


def group_values(c: Column | str, groups: dict[str, list[str]]) -> Column:
    """Many-to-one category grouping: every member of a list maps to its label."""
    c = _col(c)
    expr = None
    for label, members in groups.items():
        cond = c.isin(*members)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return c if expr is None else expr.otherwise(c)


@dataclass(frozen=True)
class CleanSpec:
    """What to do with each column of one table.

    ``blank_to_null`` and ``trim_only`` apply to text; ``value_maps`` run on the
    trimmed text; ``casts`` run last (target type names as in ``TableSpec``).
    Columns not mentioned pass through untouched.
    """

    blank_to_null: tuple[str, ...] = ()
    trim_only: tuple[str, ...] = ()
    value_maps: dict[str, dict[str, str]] = field(default_factory=dict)
    casts: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def from_table(
        table: TableSpec,
        trim_only: tuple[str, ...] = (),
        value_maps: dict[str, dict[str, str]] | None = None,
    ) -> "CleanSpec":
        """Text columns → blank_to_null (unless listed in ``trim_only``);
        typed columns → trim + try_cast to their declared type."""
        text = tuple(c.name for c in table.columns if c.dtype == "string" and c.name not in trim_only)
        casts = {c.name: c.dtype for c in table.columns if c.dtype != "string"}
        return CleanSpec(text, tuple(trim_only), dict(value_maps or {}), casts)

    def expression(self, name: str) -> Column | None:
        """The cleaned expression for ``name`` or None when it passes through."""
        touched = False
        expr: Column = F.col(name)
        if name in self.blank_to_null or name in self.casts:
            expr, touched = blank_to_null(expr), True
        elif name in self.trim_only:
            expr, touched = trimmed(expr), True
        if name in self.value_maps:
            expr, touched = value_map(expr, self.value_maps[name]), True
        if name in self.casts:
            expr, touched = typed(expr, self.casts[name]), True
        return expr.alias(name) if touched else None


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Apply a CleanSpec in a single projection, keeping column order."""
    cols = []
    for name in df.columns:
        expr = spec.expression(name)
        cols.append(expr if expr is not None else F.col(name))
    return df.select(*cols)


def cast_rejects(raw: DataFrame, spec: CleanSpec) -> DataFrame:
    """One row: per cast column, how many non-blank texts failed to convert."""
    aggs = [
        F.count(
            F.when(blank_to_null(c).isNotNull() & typed(blank_to_null(c), t).isNull(), F.lit(1))
        ).alias(c)
        for c, t in spec.casts.items()
    ]
    return raw.agg(*aggs) if aggs else raw.limit(0)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
