"""The metric layer: a star model, named measures and ``summarize``.

A :class:`Model` holds tables (lazy DataFrames), many-to-one
:class:`Relationship` s and named :class:`Measure` s. ``summarize`` evaluates
measures per group in a filter context and behaves like a BI model rather
than like a plain SQL GROUP BY:

* group columns may live in any table reachable from a measure's home table
  by walking many→one relationships; rows whose key has no match fall into a
  blank (null) member instead of vanishing;
* filters flow one→many only: a filter on a table the home table cannot
  reach does not touch that measure (an educator filter never reaches the
  delivery fact); grouping a measure by such a table is an error, since the
  total would just repeat per member;
* a measure's own filter on a home column (``CALCULATE(m, c <> BLANK())``)
  replaces any context filter on that column, for that measure only;
* groups whose requested measures are all blank are dropped;
* measures on different home tables are aggregated separately and joined on
  the group keys — never by joining the fact tables first (fan-out would
  double count).

Physical plan: when every table to be joined is provably small (size
estimate within the broadcast bound) the home table is joined with broadcast
dimensions and aggregated once. Otherwise the home table is first
aggregated by its join keys (partial sums/counts; distinct-count columns
kept as keys), so the shuffle join sees one row per key instead of the raw
fact; a hot key is one partial row per input partition, or one per distinct
value where a measure counts distinct values. A home table whose rows are
already one per those keys (``Model.grains``) is not aggregated again below the
join; rows with distinct values are dealt by group and value after it. All
paths return the same rows and types.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, IntegralType, LongType

from strata.functions.blank import blank_add, blank_div, blank_sub, nonblank
from strata.operators.joins import checked_broadcast, is_small, merge_on_keys, spread

NOT_BLANK = "__not_blank__"

FilterValue = Sequence | str | Callable[[Column], Column]

BASE_AGGS = {"sum", "count_rows", "distinct", "avg"}
DERIVED = {"sub": blank_sub, "add": blank_add, "div": blank_div}


@dataclass(frozen=True)
class Relationship:
    """Many-to-one: ``from_table.from_col`` → ``to_table.to_col`` (unique).
    Filters flow from the one side (to_table) to the many side."""

    from_table: str
    from_col: str
    to_table: str
    to_col: str


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    table: str | None = None
    column: str | None = None
    where: tuple[str, str] | None = None  # (home column, "nonblank")
    inputs: tuple[str, ...] = ()
    fmt: str = "0"
    folder: str = ""
    description: str = ""

    @property
    def derived(self) -> bool:
        return self.agg in DERIVED


@dataclass
class Model:
    tables: dict[str, DataFrame]
    relationships: list[Relationship]
    measures: dict[str, Measure]
    hidden: dict[str, tuple[str, ...]] = field(default_factory=dict)
    max_broadcast_bytes: int | None = None  # None: the session's broadcast threshold
    aggregates: list = field(default_factory=list)  # see strata.plans.aggregates
    # relationships (from_table, to_table) whose two tables are stored in the same buckets by their join columns
    colocated: frozenset[tuple[str, str]] = frozenset()
    # table -> columns that hardly two of its rows share; spares an aggregate by them, results do not depend on it
    grains: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def add_measures(self, measures: Iterable[Measure]) -> "Model":
        for m in measures:
            self.measures[m.name] = m
        return self

    def paths(self, start: str, target: str) -> list[list[Relationship]]:
        """Every many→one path from ``start`` to ``target`` that visits no table twice."""
        if start == target:
            return [[]]
        found = []
        queue: deque[tuple[str, list[Relationship]]] = deque([(start, [])])
        while queue:
            table, route = queue.popleft()
            for r in self.relationships:
                if r.from_table == table and r.to_table not in {start, *(x.to_table for x in route)}:
                    if r.to_table == target:
                        found.append([*route, r])
                    else:
                        queue.append((r.to_table, [*route, r]))
        return found

    def path(self, start: str, target: str) -> list[Relationship] | None:
        """The many→one path from ``start`` to ``target``; two paths are an error, since a filter
        would reach the measure in two ways."""
        found = self.paths(start, target)
        if len(found) > 1:
            ways = "; ".join(" → ".join([start, *(r.to_table for r in route)]) for route in found)
            raise ModelError(f"ambiguous paths from {start!r} to {target!r}: {ways}")
        return found[0] if found else None

    def business_view(self, table: str) -> DataFrame:
        """The table without its hidden columns."""
        hidden = set(self.hidden.get(table, ()))
        df = self.tables[table]
        return df.select(*[c for c in df.columns if c not in hidden])


class ModelError(ValueError):
    pass


def _split(ref: str) -> tuple[str, str]:
    table, _, col = ref.partition(".")
    if not col:
        raise ModelError(f"column reference must be 'table.column': {ref!r}")
    return table, col


def _filter_expr(c: Column, value: FilterValue) -> Column:
    if callable(value):
        return value(c)
    if isinstance(value, str):
        if value == NOT_BLANK:
            return c.isNotNull()
        return c == F.lit(value)
    values = list(value)
    if not values:  # an empty slicer selection means "no filter"
        return F.lit(True)
    present = [v for v in values if v is not None]
    expr = c.isin(*present) if present else F.lit(False)
    return expr | c.isNull() if len(present) < len(values) else expr


def _selects_blank(value: FilterValue) -> bool:
    """A slicer selection that includes the blank (null) member."""
    return not callable(value) and not isinstance(value, str) and any(v is None for v in value)


def _base_closure(model: Model, names: Sequence[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        m = model.measures.get(n)
        if m is None:
            raise ModelError(f"unknown measure {n!r}")
        if m.derived:
            for i in m.inputs:
                visit(i)
        elif n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def _derived_order(model: Model, names: Sequence[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        m = model.measures[n]
        if not m.derived or n in order:
            return
        for i in m.inputs:
            visit(i)
        order.append(n)

    for n in names:
        visit(n)
    return order


def _alias(table: str, col: str) -> str:
    return f"{table}__{col}"


class _Branch:
    """All base measures sharing one home table."""

    def __init__(self, model: Model, home: str, measures: list[Measure], group: list[tuple[str, str]],
                 filters: dict[tuple[str, str], FilterValue]):
        self.model, self.home, self.measures, self.group = model, home, measures, group
        self.filters = filters
        self.routes: dict[str, list[Relationship]] = {}
        for table, col in group:
            route = model.path(home, table)
            if route is None:
                raise ModelError(
                    f"cannot group measures of {home!r} by {table}.{col}: no many-to-one path "
                    f"from {home!r} to {table!r} (the filter would not reach the measure)")
            self.routes[table] = route
        self.active_filters: dict[tuple[str, str], FilterValue] = {}
        for (table, col), value in filters.items():
            route = model.path(home, table)
            if route is not None:  # unreachable tables do not filter this home table
                self.routes.setdefault(table, route)
                self.active_filters[(table, col)] = value
        # A dimension filter that selects the blank member must see the fact
        # rows without a match, so it is applied after a left join instead of
        # on the dimension before an inner join.
        self.post_filters = {k: v for k, v in self.active_filters.items()
                             if k[0] != home and _selects_blank(v)}

    # -- home-table columns ---------------------------------------------------
    def _overrides(self, m: Measure) -> set[str]:
        return {m.where[0]} if m.where else set()

    def _home_filters(self) -> tuple[list[Column], dict[str, list[tuple[str, Column]]]]:
        """Row filters on the home table, and filters folded per measure
        because some measure overrides that column."""
        overridden = set().union(*[self._overrides(m) for m in self.measures]) if self.measures else set()
        row_filters: list[Column] = []
        folded: dict[str, list[tuple[str, Column]]] = {}
        for (table, col), value in self.active_filters.items():
            if table != self.home:
                continue
            expr = _filter_expr(F.col(col), value)
            if col in overridden:
                folded.setdefault(col, []).append((col, expr))
            else:
                row_filters.append(expr)
        return row_filters, folded

    def _condition(self, m: Measure, folded: dict[str, list[tuple[str, Column]]]) -> Column | None:
        conds: list[Column] = []
        for col, items in folded.items():
            if col in self._overrides(m):
                continue  # the measure's own filter replaces the context filter
            conds.extend(e for _, e in items)
        if m.where:
            col, kind = m.where
            if kind != "nonblank":
                raise ModelError(f"unsupported measure filter {kind!r}")
            conds.append(nonblank(F.col(col), self.model.tables[self.home].schema[col].dataType))
        return reduce(lambda a, b: a & b, conds) if conds else None

    # -- plan -----------------------------------------------------------------
    def _tree(self) -> list[Relationship]:
        """Relationships to join, parents before children, each once."""
        edges: list[Relationship] = []
        for route in self.routes.values():
            for r in route:
                if r not in edges:
                    edges.append(r)
        return edges

    def _needed_cols(self, edges: list[Relationship]) -> dict[str, list[str]]:
        need: dict[str, list[str]] = {}

        def add(t: str, c: str) -> None:
            need.setdefault(t, [])
            if c not in need[t]:
                need[t].append(c)

        for t, c in self.group:
            add(t, c)
        for t, c in self.post_filters:
            add(t, c)
        for r in edges:
            add(r.from_table, r.from_col)
        return need

    def _filtered_tables(self, edges: list[Relationship]) -> set[str]:
        """Tables whose join must drop unmatched rows (they, or a table
        beyond them, carry a filter)."""
        direct = {t for k in self.active_filters if (t := k[0]) != self.home and k not in self.post_filters}
        out = set(direct)
        changed = True
        while changed:
            changed = False
            for r in edges:
                if r.to_table in out and r.from_table != self.home and r.from_table not in out:
                    out.add(r.from_table)
                    changed = True
        return out

    def _dimension(self, table: str, cols: list[str], key: str) -> DataFrame:
        df = self.model.tables[table]
        for (t, c), value in self.active_filters.items():
            if t == table and (t, c) not in self.post_filters:
                df = df.filter(_filter_expr(F.col(c), value))
        keep = [key] + [c for c in cols if c != key]
        return df.select(*[F.col(c).alias(_alias(table, c)) for c in keep])

    def build(self) -> DataFrame:
        edges = self._tree()
        need = self._needed_cols(edges)
        filtered = self._filtered_tables(edges)
        row_filters, folded = self._home_filters()
        home_df = self.model.tables[self.home]
        for f in row_filters:
            home_df = home_df.filter(f)

        dims: dict[str, DataFrame] = {}
        for r in edges:
            dims[r.to_table] = self._dimension(r.to_table, need.get(r.to_table, []), r.to_col)
        small = all(is_small(d, self.model.max_broadcast_bytes) for d in dims.values())

        conds = {m.name: self._condition(m, folded) for m in self.measures}
        home_keys = [c for c in need.get(self.home, [])]  # own group cols + FKs

        # Columns of the home table, named with the table alias.
        home_proj = [F.col(c).alias(_alias(self.home, c)) for c in home_keys]
        if small or not edges:
            # Direct: join broadcast dimensions, aggregate once.
            cur = home_df.select(*home_proj, *[F.col(c) for c in self._measure_cols()],
                                 *[F.col(c) for c in self._cond_cols() if c not in self._measure_cols()])
            cur = self._join(cur, edges, dims, filtered, broadcast=True)
            aggs = [self._final_direct(m, conds[m.name]) for m in self.measures]
        else:
            # Pre-aggregate by join keys (+ distinct columns), then join.
            pre, flags = self._pre_aggregated(home_df, home_keys, conds)
            cur = self._join(pre, edges, dims, filtered, broadcast=False)
            values = [f"__d{i}" for i, m in enumerate(self.measures) if m.agg == "distinct"]
            if values:
                cur = spread(cur, [*[_alias(t, c) for t, c in self.group], *values])
            aggs = [self._final_merge(i, m, i in flags) for i, m in enumerate(self.measures)]
        group_cols = [F.col(_alias(t, c)).alias(c) for t, c in self.group]
        return cur.groupBy(*group_cols).agg(*aggs) if group_cols else cur.agg(*aggs)

    def _pre_aggregated(self, home_df: DataFrame, need: list[str],
                        conds: dict[str, Column | None]) -> tuple[DataFrame, list[int]]:
        """The home table by its join keys and distinct columns (``__d``, with ``__f`` where a
        condition holds), with partial sums ``__s`` and counts ``__n``; which measures have a condition."""
        def when(m: Measure, value: Column) -> Column:
            c = conds[m.name]
            return value if c is None else F.when(c, value)

        flags = []
        pre_keys = [F.col(c).alias(_alias(self.home, c)) for c in need]
        for i, m in enumerate(self.measures):
            if m.agg == "distinct":
                pre_keys.append(F.col(m.column).alias(f"__d{i}"))
                if conds[m.name] is not None:
                    pre_keys.append(conds[m.name].alias(f"__f{i}"))
                    flags.append(i)
        partials = []
        for i, m in enumerate(self.measures):
            if m.agg == "sum":
                partials.append(F.sum(when(m, F.col(m.column))).alias(f"__s{i}"))
            elif m.agg == "count_rows":
                partials.append(F.count(when(m, F.lit(1))).alias(f"__n{i}"))
            elif m.agg == "avg":
                partials.append(F.sum(when(m, F.col(m.column))).alias(f"__s{i}"))
                partials.append(F.count(when(m, F.col(m.column))).alias(f"__n{i}"))
        grain = self.model.grains.get(self.home)
        own = {*need, *[m.column for m in self.measures if m.agg == "distinct"]}
        # buckets as stored are not joined up: there the fold stays, and joins lie above it
        bucketed = any(t == self.home for t, _ in self.model.colocated)
        if grain and set(grain) <= own and not bucketed:
            return home_df.select(*pre_keys, *[p for i, m in enumerate(self.measures) for p in self._row_partials(i, m, when)]), flags
        pre = home_df.groupBy(*pre_keys).agg(*partials) if partials else home_df.select(*pre_keys).distinct()
        return pre, flags

    def _row_partials(self, i: int, m: Measure, when: Callable[[Measure, Column], Column]) -> list[Column]:
        """The partial sums and counts of a single row, typed as those of an aggregate."""
        if m.agg == "distinct":
            return []
        value = when(m, F.lit(1) if m.agg == "count_rows" else F.col(m.column))
        total = value.cast(self._sum_type(m)).alias(f"__s{i}") if m.agg != "count_rows" else None
        count = value.isNotNull().cast("bigint").alias(f"__n{i}")
        return {"sum": [total], "count_rows": [count], "avg": [total, count]}[m.agg]

    def states(self) -> DataFrame:
        """Group columns (named with their table), distinct columns and partial sums: what
        the measures need to be added up to any coarser grouping. No filters."""
        edges = self._tree()
        need = self._needed_cols(edges)
        dims = {r.to_table: self._dimension(r.to_table, need.get(r.to_table, []), r.to_col) for r in edges}
        small = all(is_small(d, self.model.max_broadcast_bytes) for d in dims.values())
        pre, _ = self._pre_aggregated(self.model.tables[self.home], need.get(self.home, []), {m.name: self._condition(m, {}) for m in self.measures})
        cur = self._join(pre, edges, dims, set(), broadcast=small)
        keys = [_alias(t, c) for t, c in self.group] + [c for c in pre.columns if c.startswith(("__d", "__f"))]
        added = [F.sum(c).alias(c) for c in pre.columns if c.startswith(("__s", "__n"))]
        return cur.groupBy(*keys).agg(*added) if added else cur.select(*keys).distinct()

    def _measure_cols(self) -> list[str]:
        out: list[str] = []
        for m in self.measures:
            if m.column and m.column not in out:
                out.append(m.column)
        return out

    def _cond_cols(self) -> list[str]:
        out: list[str] = []
        for m in self.measures:
            if m.where and m.where[0] not in out:
                out.append(m.where[0])
        for (t, c) in self.active_filters:
            if t == self.home and c not in out:
                out.append(c)
        return out

    def _join(self, cur: DataFrame, edges: list[Relationship], dims: dict[str, DataFrame],
              filtered: set[str], broadcast: bool) -> DataFrame:
        needed_attrs = {t for t, _ in self.group} | {t for t, _ in self.post_filters}
        keep_cols = {_alias(t, c) for t, c in self.group} | {_alias(t, c) for t, c in self.post_filters}

        def below(table: str) -> set[str]:
            return {table}.union(*[below(e.to_table) for e in edges if e.from_table == table])

        # a table that, with all beyond it, only filters: its rows are reduced from the far end
        # and the near side keeps the rows that have a match, without taking columns over
        filtering = {r.to_table for r in edges if r.to_table in filtered and not below(r.to_table) & needed_attrs}

        def reduced(r: Relationship) -> DataFrame:
            dim = dims[r.to_table]
            for e in edges:
                if e.from_table == r.to_table:
                    dim = dim.join(reduced(e), dim[_alias(e.from_table, e.from_col)] == F.col(_alias(e.to_table, e.to_col)), "left_semi")
            dim = dim.select(_alias(r.to_table, r.to_col))
            if broadcast:
                return F.broadcast(dim)
            if (r.from_table, r.to_table) in self.model.colocated:
                return dim.hint("merge")
            return checked_broadcast(dim, self.model.max_broadcast_bytes)

        for r in edges:
            if r.from_table in filtering:
                continue
            left_key, right_key = _alias(r.from_table, r.from_col), _alias(r.to_table, r.to_col)
            if r.to_table in filtering:
                cur = cur.join(reduced(r), F.col(left_key) == F.col(right_key), "left_semi")
                continue
            dim = dims[r.to_table]
            if broadcast:
                dim = F.broadcast(dim)
            elif (r.from_table, r.to_table) in self.model.colocated:
                dim = dim.hint("merge")
            how = "inner" if r.to_table in filtered else "left"
            cur = cur.join(dim, cur[left_key] == dim[right_key], how)
            if right_key not in keep_cols and right_key != left_key:
                cur = cur.drop(right_key)
        for (t, c), value in self.post_filters.items():
            cur = cur.filter(_filter_expr(F.col(_alias(t, c)), value))
        return cur

    def _sum_type(self, m: Measure) -> DataType:
        """The declared type of a sum, whichever way it is computed."""
        kind = self.model.tables[self.home].schema[m.column].dataType
        if isinstance(kind, DecimalType):
            return DecimalType(min(38, kind.precision + 10), kind.scale)
        return LongType() if isinstance(kind, IntegralType) else DoubleType()

    @staticmethod
    def _average(total: Column, n: Column) -> Column:
        """The declared average, a double, from a sum and a count."""
        return total.cast("double") / F.nullif(n, F.lit(0))

    def _final_direct(self, m: Measure, cond: Column | None) -> Column:
        def when(value: Column) -> Column:
            return value if cond is None else F.when(cond, value)

        if m.agg == "sum":
            out = F.sum(when(F.col(m.column))).cast(self._sum_type(m))
        elif m.agg == "count_rows":
            out = F.nullif(F.count(when(F.lit(1))), F.lit(0))
        elif m.agg == "avg":
            value = when(F.col(m.column))
            out = self._average(F.sum(value), F.count(value))
        elif m.agg == "distinct":
            c = F.col(m.column)
            is_blank = c.isNull() if cond is None else (F.coalesce(cond, F.lit(False)) & c.isNull())
            out = F.nullif(F.count_distinct(when(c)) + F.max(F.when(is_blank, 1).otherwise(0)), F.lit(0))
        else:
            raise ModelError(m.agg)
        return out.alias(m.name)

    def _final_merge(self, i: int, m: Measure, flagged: bool) -> Column:
        if m.agg == "sum":
            out = F.sum(f"__s{i}").cast(self._sum_type(m))
        elif m.agg == "count_rows":
            out = F.nullif(F.sum(f"__n{i}"), F.lit(0))
        elif m.agg == "avg":
            out = self._average(F.sum(f"__s{i}"), F.sum(f"__n{i}"))
        elif m.agg == "distinct":
            c = F.col(f"__d{i}")
            keep = F.col(f"__f{i}") if flagged else None
            present = c if keep is None else F.when(keep, c)
            is_blank = c.isNull() if keep is None else (F.coalesce(keep, F.lit(False)) & c.isNull())
            out = F.nullif(F.count_distinct(present) + F.max(F.when(is_blank, 1).otherwise(0)), F.lit(0))
        else:
            raise ModelError(m.agg)
        return out.alias(m.name)


def summarize(
    model: Model,
    group_by: Sequence[str] = (),
    measures: Sequence[str] = (),
    filters: dict[str, FilterValue] | None = None,
    keep_blank_rows: bool = False,
    order_by: Sequence[tuple[str, bool]] | None = None,
) -> DataFrame:
    """Evaluate ``measures`` per combination of ``group_by`` columns.

    ``group_by``: ``"table.column"`` refs. ``filters``: ``{"table.column": v}``
    where ``v`` is a list of allowed values (a slicer; empty = no filter),
    :data:`NOT_BLANK`, a single value, or a function of the column.
    """
    if not measures:
        raise ModelError("at least one measure is required")
    group = [_split(g) for g in group_by]
    names = [c for _, c in group]
    if len(set(names)) != len(names):
        raise ModelError(f"group columns must have distinct names: {names}")
    parsed_filters = {_split(k): v for k, v in (filters or {}).items()}
    base = _base_closure(model, measures)

    by_home: dict[str, list[Measure]] = {}
    for n in base:
        m = model.measures[n]
        if m.agg not in BASE_AGGS:
            raise ModelError(f"measure {n!r}: unknown aggregation {m.agg!r}")
        by_home.setdefault(m.table, []).append(m)

    parts = []
    for home, ms in by_home.items():
        stored = covering(model, home, group, [m.name for m in ms], parsed_filters)
        parts.append(stored.evaluate(model, group, [m.name for m in ms], parsed_filters) if stored is not None
                     else _Branch(model, home, ms, group, parsed_filters).build())
    return finish(_combine(parts, names), model, names, measures, keep_blank_rows, order_by)


def covering(model: Model, home: str, group: Sequence[tuple[str, str]], base: Sequence[str],
             filters: dict[tuple[str, str], FilterValue]):
    """The stored aggregate with the fewest rows that can answer, if any."""
    able = [a for a in model.aggregates if a.home == home and a.covers(model, group, base, filters)]
    return min(able, key=lambda a: a.rows, default=None)


def finish(result: DataFrame, model: Model, names: Sequence[str], measures: Sequence[str], keep_blank_rows: bool,
           order_by: Sequence[tuple[str, bool]] | None) -> DataFrame:
    """Derived measures, the requested columns, without all-blank groups, in order."""
    for n in _derived_order(model, measures):
        m = model.measures[n]
        fn = DERIVED[m.agg]
        result = result.withColumn(n, fn(F.col(m.inputs[0]), F.col(m.inputs[1])))

    result = result.select(*names, *measures)
    if names and not keep_blank_rows:
        result = result.filter(reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in measures]))
    if order_by:
        result = result.orderBy(*[F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last()
                                  for c, asc in order_by])
    return result


def row(model: Model, measures: Sequence[str], filters: dict[str, FilterValue] | None = None) -> DataFrame:
    """One-row table of measures (no grouping); blanks are kept."""
    return summarize(model, (), measures, filters, keep_blank_rows=True)


def _combine(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Per-home-table results, each unique on the group keys, side by side."""
    return merge_on_keys(parts, keys)
