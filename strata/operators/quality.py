"""Data-quality checks as DataFrame queries, and the gate in front of a write.

Each check yields one row of a check table::

    layer, check_name, check_kind, table_name, observed, expected,
    violations, passed, severity

Scalar checks on the same table (row count, nulls, ranges, distinct count)
are folded into **one** aggregate per table — one scan, however many checks.
Keyed checks: uniqueness is one grouped count; a foreign key into a small
(size-checked) parent key set is a broadcast anti-join; otherwise a foreign
key and the coverage of the same key pair come from one shared key profile
(both key sets stacked and grouped once); orphan-row counts pre-aggregate
the child per key before the anti-join.
The gate collects only the check table (one row per check) to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import duplicate_keys
from strata.operators.joins import is_small, orphan_rows

SCALAR_KINDS = {"row_count", "distinct_count", "not_null", "in_range"}
#: scalar checks that can be evaluated while a table is written (a distinct count cannot be observed)
OBSERVABLE_KINDS = SCALAR_KINDS - {"distinct_count"}


@dataclass(frozen=True)
class Check:
    name: str
    kind: str
    table: str
    columns: tuple[str, ...] = ()
    ref_table: str | None = None
    ref_columns: tuple[str, ...] = ()
    expected: int | None = None
    low: float | None = None
    high: float | None = None
    severity: str = "error"


def row_count(table: str, expected: int, name: str | None = None) -> Check:
    return Check(name or f"{table}_row_count", "row_count", table, expected=expected)


def distinct_count(table: str, column: str, expected: int, name: str | None = None) -> Check:
    return Check(name or f"{table}_{column}_distinct", "distinct_count", table, (column,), expected=expected)


def unique(table: str, *columns: str, name: str | None = None) -> Check:
    return Check(name or f"{table}_{'_'.join(columns)}_unique", "unique", table, tuple(columns), expected=0)


def not_null(table: str, column: str, name: str | None = None) -> Check:
    return Check(name or f"{table}_{column}_not_null", "not_null", table, (column,), expected=0)


def in_range(table: str, column: str, low: float, high: float, name: str | None = None, severity: str = "error") -> Check:
    return Check(name or f"{table}_{column}_in_range", "in_range", table, (column,), expected=0,
                 low=low, high=high, severity=severity)


def foreign_key(
    table: str,
    columns: Sequence[str],
    ref_table: str,
    ref_columns: Sequence[str] | None = None,
    rows: bool = False,
    name: str | None = None,
) -> Check:
    """Child ``table.columns`` must exist in ``ref_table.ref_columns``.
    ``rows=False`` counts distinct orphan keys, ``rows=True`` orphan rows."""
    kind = "foreign_key_rows" if rows else "foreign_key"
    cols = tuple(columns)
    return Check(name or f"{table}_{'_'.join(cols)}_fk_{ref_table}", kind, table, cols, ref_table,
                 tuple(ref_columns or cols), expected=0)


def coverage(table: str, columns: Sequence[str], ref_table: str, ref_columns: Sequence[str] | None = None,
             name: str | None = None) -> Check:
    """Every key of ``table`` is referenced by at least one ``ref_table`` row."""
    cols = tuple(columns)
    return Check(name or f"{table}_covered_by_{ref_table}", "coverage", table, cols, ref_table,
                 tuple(ref_columns or cols), expected=0)


def _observed_expr(check: Check) -> Column:
    if check.kind == "row_count":
        return F.count(F.lit(1))
    col = F.col(check.columns[0])
    if check.kind == "distinct_count":
        return F.count_distinct(col)
    if check.kind == "not_null":
        return F.count(F.when(col.isNull(), F.lit(1)))
    if check.kind == "in_range":
        return F.count(F.when(col.isNotNull() & ~col.between(check.low, check.high), F.lit(1)))
    raise ValueError(check.kind)


def observable(checks: Sequence[Check], tables: Sequence[str]) -> dict[str, dict[str, Column]]:
    """table -> check name -> aggregate, of the checks that a write of ``tables`` can evaluate."""
    out: dict[str, dict[str, Column]] = {}
    for c in checks:
        if c.kind in OBSERVABLE_KINDS and c.table in tables:
            out.setdefault(c.table, {})[c.name] = _observed_expr(c)
    return out


def _pair_profile(child: DataFrame, child_cols: Sequence[str], parent: DataFrame,
                  parent_cols: Sequence[str]) -> DataFrame:
    """One row: ``orphans`` (distinct child keys without a parent) and
    ``uncovered`` (parent rows whose key no child uses).

    Both key sets are stacked with presence flags and grouped once — one
    exchange, combined map-side, so hot keys collapse before the shuffle.
    A key containing null never matches anything (join semantics)."""
    names = [f"__k{i}" for i in range(len(child_cols))]
    c = child.select(*[F.col(x).alias(n) for x, n in zip(child_cols, names)],
                     F.lit(1).alias("__c"), F.lit(0).cast("bigint").alias("__p"))
    p = parent.select(*[F.col(x).alias(n) for x, n in zip(parent_cols, names)],
                      F.lit(0).alias("__c"), F.lit(1).cast("bigint").alias("__p"))
    per_key = c.unionByName(p).groupBy(*names).agg(F.max("__c").alias("__c"), F.sum("__p").alias("__p"))
    has_null = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
    return per_key.agg(
        F.count(F.when((F.col("__c") == 1) & ((F.col("__p") == 0) | has_null), F.lit(1))).alias("orphans"),
        F.coalesce(F.sum(F.when((F.col("__c") == 0) | has_null, F.col("__p"))), F.lit(0)).alias("uncovered"),
    )


def _pair(check: Check) -> tuple:
    """(child table, child cols, parent table, parent cols) of a key check."""
    if check.kind == "foreign_key":
        return check.table, check.columns, check.ref_table, check.ref_columns
    return check.ref_table, check.ref_columns, check.table, check.columns  # coverage


def _keyed_observed(check: Check, tables: dict[str, DataFrame], profiles: dict[tuple, DataFrame],
                    covered_pairs: set[tuple]) -> DataFrame:
    if check.kind == "foreign_key" and _pair(check) not in covered_pairs:
        names = [f"__k{i}" for i in range(len(check.columns))]
        parents = tables[check.ref_table].select(*[F.col(x).alias(n) for x, n in zip(check.ref_columns, names)])
        if is_small(parents):  # a small parent key set: broadcast anti-join, no parent shuffle
            children = tables[check.table].select(*[F.col(x).alias(n) for x, n in zip(check.columns, names)])
            hits = children.distinct().join(F.broadcast(parents), names, "left_anti")  # null never matches
            return hits.agg(F.count(F.lit(1)).alias("observed"))
    if check.kind == "unique":
        return duplicate_keys(tables[check.table], check.columns).agg(F.count(F.lit(1)).alias("observed"))
    if check.kind == "foreign_key_rows":
        return orphan_rows(tables[check.table], check.columns, tables[check.ref_table], check.ref_columns).agg(
            F.coalesce(F.sum("orphan_rows"), F.lit(0)).alias("observed"))
    if check.kind in ("foreign_key", "coverage"):
        pair = _pair(check)
        if pair not in profiles:
            ct, cc, pt, pc = pair
            profiles[pair] = _pair_profile(tables[ct], cc, tables[pt], pc)
        column = "orphans" if check.kind == "foreign_key" else "uncovered"
        return profiles[pair].select(F.col(column).alias("observed"))
    raise ValueError(f"unknown check kind {check.kind!r}")


def _row(check: Check, layer: str, observed: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.kind).alias("check_kind"),
        F.lit(check.table).alias("table_name"),
        observed.cast("bigint").alias("observed"),
        F.lit(check.expected).cast("bigint").alias("expected"),
        F.lit(check.severity).alias("severity"),
    )


def _uses(checks: Sequence[Check]) -> dict[str, int]:
    """How many separate check branches read each table."""
    count: dict[str, int] = {}
    scalar_tables = {c.table for c in checks if c.kind in SCALAR_KINDS}
    for t in scalar_tables:
        count[t] = count.get(t, 0) + 1
    pairs = set()
    for c in checks:
        if c.kind in SCALAR_KINDS:
            continue
        if c.kind in ("foreign_key", "coverage"):
            if _pair(c) in pairs:
                continue
            pairs.add(_pair(c))
        for t in {c.table, c.ref_table} - {None}:
            count[t] = count.get(t, 0) + 1
    return count


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check], layer: str = "",
               materialize: bool = False, known: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """The check table for ``checks`` (lazy; one row per check).

    ``known`` (table -> check name -> observed value): what was counted while the tables
    were written; those checks read nothing.

    ``materialize=True`` first writes every table that two or more check
    branches read to the session's shared scratch folder (concurrently), so
    an expensive derived table is computed once instead of once per check.
    Use it for tables that are lazy plans over raw data; stored tables need
    no staging."""
    if materialize:
        from strata.session import scratch_path  # local import: keeps operators free of session state
        from strata.sources.sinks import stage_tables

        shared = {t: tables[t] for t, n in _uses(checks).items() if n >= 2}
        if shared:
            spark = next(iter(shared.values())).sparkSession
            tables = {**tables, **stage_tables(spark, shared, scratch_path(spark, "checks"))}
    parts: list[DataFrame] = []
    scalar: dict[str, list[Check]] = {}
    counted = [(c, known[c.table][c.name]) for c in checks if c.name in (known or {}).get(c.table, {})]
    if counted:
        spark = next(iter(tables.values())).sparkSession
        schema = ("layer string, check_name string, check_kind string, table_name string, observed bigint, expected bigint, "
                  "severity string")
        parts.append(spark.createDataFrame([(layer, c.name, c.kind, c.table, n, c.expected, c.severity) for c, n in counted], schema))
    for c in checks:
        if c.kind in SCALAR_KINDS and c not in [k for k, _ in counted]:
            scalar.setdefault(c.table, []).append(c)
    for table, cs in scalar.items():
        wide = tables[table].agg(*[_observed_expr(c).alias(f"__o{i}") for i, c in enumerate(cs)])
        rows = F.array(*[_row(c, layer, F.col(f"__o{i}")) for i, c in enumerate(cs)])
        parts.append(wide.select(F.inline(rows)))
    profiles: dict[tuple, DataFrame] = {}  # a foreign key and its coverage share one profile
    covered_pairs = {_pair(c) for c in checks if c.kind == "coverage"}
    for c in checks:
        if c.kind not in SCALAR_KINDS:
            observed = _keyed_observed(c, tables, profiles, covered_pairs)
            parts.append(observed.select(F.inline(F.array(_row(c, layer, F.col("observed"))))))
    if not parts:
        raise ValueError("no checks given")
    if aimless := [c.name for c in checks if c.expected is None]:
        raise ValueError(f"checks without an expected value can never fail: {aimless}")
    table = reduce(DataFrame.unionByName, parts)
    violations = F.abs(F.col("observed") - F.col("expected"))
    return table.select(
        "layer", "check_name", "check_kind", "table_name", "observed", "expected",
        violations.cast("bigint").alias("violations"),
        (violations == 0).alias("passed"),
        "severity",
    )


class QualityGateError(AssertionError):
    def __init__(self, failed: list):
        self.failed = failed
        lines = ", ".join(f"{r['check_name']}={r['observed']} (expected {r['expected']})" for r in failed)
        super().__init__(f"{len(failed)} data-quality check(s) failed: {lines}")


def gate(check_table: DataFrame) -> list:
    """Evaluate the check table once; raise if any error-severity check failed.

    Returns the collected check rows (bounded by the number of checks)."""
    rows = check_table.collect()
    failed = [r for r in rows if not r["passed"] and r["severity"] == "error"]
    if failed:
        raise QualityGateError(failed)
    return rows


def total_violations(check_table: DataFrame, kinds: Sequence[str] | None = None) -> DataFrame:
    """One row: the sum of violations (optionally over some check kinds)."""
    df = check_table if not kinds else check_table.filter(F.col("check_kind").isin(*kinds))
    return df.agg(F.coalesce(F.sum("violations"), F.lit(0)).cast("bigint").alias("total_violations"))
