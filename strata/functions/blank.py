"""BLANK-aware arithmetic for the metric layer.

Measures follow BI-model rules rather than SQL null propagation:

* ``a - b``: a blank operand acts as 0, but blank - blank is blank;
* ``divide(a, b)``: blank when the divisor is blank or 0 (never an error);
* a filter ``c <> BLANK()`` is false for null **and** for 0 / ``''``;
* a distinct count counts the blank value once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType


def blank_sub(a: Column, b: Column) -> Column:
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))
    )


def blank_add(a: Column, b: Column) -> Column:
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    )


def blank_div(a: Column, b: Column) -> Column:
    """Zero-safe ratio; the numerator is widened to double before dividing."""
    return F.when(b.isNull() | (b == 0), F.lit(None).cast("double")).otherwise(
        a.cast("double") / b.cast("double")
    )


def nonblank(c: Column, kind: DataType | None = None) -> Column:
    """``c <> BLANK()``: not null and not the blank of its type — 0 for numbers (also
    where ``kind`` is not given), the empty text, false; a date has no blank but null."""
    if kind is None or isinstance(kind, NumericType):
        return c.isNotNull() & (c != F.lit(0))
    if isinstance(kind, StringType):
        return c.isNotNull() & (c != F.lit(""))
    if isinstance(kind, BooleanType):
        return c.isNotNull() & c
    return c.isNotNull()


def distinct_with_blank(c: Column) -> Column:
    """Distinct count where null counts as one more value (an aggregate)."""
    return F.count_distinct(c) + F.max(F.when(c.isNull(), F.lit(1)).otherwise(F.lit(0)))
