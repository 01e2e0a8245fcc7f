"""Stored aggregates: a report page answered from one pass over its fact.

A :class:`StoredAggregate` keeps, at a grain of columns, what the base measures of one home
table need to be added up further: sums and counts as they are, distinct counts as
mergeable sets (:mod:`strata.operators.distincts`). Attached to a model
(:func:`with_aggregates`), :func:`strata.plans.metrics.summarize` answers from the smallest
one that covers a request, and from the tables where none does.

An aggregate covers a request if all group and filter columns are in its grain, all base
measures are its own, no filter is a function of the column (a function may tell a missing
dimension row from a blank attribute; the grain cannot) and no measure replaces a filter that
is set. Rows whose key has no match are in the grain as blanks, as in ``summarize``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.distincts import coarser, dense_ids, distinct_counts, distinct_state, members
from strata.operators.joins import merge_on_keys
from strata.plans.metrics import FilterValue, Measure, Model, ModelError, _alias, _base_closure, _Branch, _filter_expr, _split
from strata.session import scratch_path


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _added_up(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial sums and counts by fewer keys; the keys alone where there are none."""
    states = [c for c in df.columns if c.startswith(("__s", "__n"))]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in states]) if states else df.select(*keys).distinct()


@dataclass
class StoredAggregate:
    home: str
    grain: tuple[tuple[str, str], ...]
    measures: tuple[Measure, ...]
    sums: DataFrame       # grain columns and the partial sums and counts
    sets: DataFrame       # grain columns and the state of the distinct counts
    rows: int             # of ``sums``

    def covers(self, model: Model, group: Sequence[tuple[str, str]], base: Sequence[str],
               filters: dict[tuple[str, str], FilterValue]) -> bool:
        own = {m.name: m for m in self.measures}
        if not set(base) <= set(own) or any(callable(v) for v in filters.values()):
            return False
        # a filter that cannot reach the home table does not touch its measures
        reaching = [k for k in filters if model.path(self.home, k[0]) is not None]
        replaced = {(self.home, own[n].where[0]) for n in base if own[n].where}
        return set(group) | set(reaching) <= set(self.grain) and not replaced & set(reaching)

    def evaluate(self, model: Model, group: Sequence[tuple[str, str]], base: Sequence[str],
                 filters: dict[tuple[str, str], FilterValue]) -> DataFrame:
        """Group columns and base measures, as the tables would give them."""
        names = [c for _, c in group]
        branch = _Branch(model, self.home, list(self.measures), list(group), {})

        def narrowed(df: DataFrame) -> DataFrame:
            for (t, c), value in filters.items():
                if (t, c) in self.grain:
                    df = df.filter(_filter_expr(F.col(_alias(t, c)), value))
            return df.select(*[F.col(_alias(t, c)).alias(c) for t, c in group], *[x for x in df.columns if x not in
                                                                                  {_alias(t, c) for t, c in self.grain}])

        parts = []
        added = [branch._final_merge(i, m, False) for i, m in enumerate(self.measures) if m.name in base and m.agg != "distinct"]
        if added:
            sums = narrowed(self.sums)
            parts.append(sums.groupBy(*names).agg(*added) if names else sums.agg(*added))
        counted = [m.name for m in self.measures if m.name in base and m.agg == "distinct"]
        if counted:
            counts = distinct_counts(narrowed(self.sets).filter(F.col("measure").isin(counted)), names, counted, blank=True)
            parts.append(counts.select(*names, *[F.nullif(F.col(n), F.lit(0)).alias(n) for n in counted]))
        return merge_on_keys(parts, names)

    def coarser(self, columns: Sequence[str]) -> "StoredAggregate":
        """The aggregate of some of the grain's columns, from this one alone."""
        grain = tuple(_split(c) for c in columns)
        if not set(grain) <= set(self.grain):
            raise ModelError(f"{columns} are not in the grain {self.grain}")
        keys = [_alias(*g) for g in grain]
        sums = _stored(_added_up(self.sums, keys), "aggregate-sums")
        return replace(self, grain=grain, sums=sums, sets=_stored(coarser(self.sets, keys), "aggregate-sets"), rows=sums.count())


def partial_states(model: Model, home: str, grain: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Grain columns, the distinct columns and partial sums: one read of the home table."""
    return _Branch(model, home, list(measures), [_split(g) for g in grain], {}).states()


def stored_aggregate(model: Model, home: str, grain: Sequence[str], measures: Sequence[str]) -> StoredAggregate:
    """Builds the aggregate of the base measures under ``measures`` at ``grain``; the home table is
    read once, all further steps read what that pass stored."""
    base = [model.measures[n] for n in _base_closure(model, measures) if model.measures[n].table == home]
    states = _stored(partial_states(model, home, grain, base), "aggregate-states")
    keys = [_alias(*_split(g)) for g in grain]
    distinct = {m.name: i for i, m in enumerate(base) if m.agg == "distinct"}
    sums = _stored(_added_up(states, keys), "aggregate-sums")
    if distinct:
        columns = {m: f"__d{i}" for m, i in distinct.items()}
        present = {m: F.col(f"__f{i}") for m, i in distinct.items() if f"__f{i}" in states.columns}
        values = _stored(members(states, keys, columns, present), "aggregate-members")
        sets = _stored(distinct_state(values, keys, dense_ids(values)), "aggregate-sets")
    else:
        sets = states.limit(0)
    return StoredAggregate(home, tuple(_split(g) for g in grain), tuple(base), sums, sets, sums.count())


def with_aggregates(model: Model, aggregates: Sequence[StoredAggregate]) -> Model:
    """The model, answering from the aggregates where they cover a request."""
    return replace(model, aggregates=[*model.aggregates, *aggregates])
