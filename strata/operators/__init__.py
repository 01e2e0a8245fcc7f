"""Relational operators built from DataFrame primitives."""

from strata.operators.dedup import dedup_by_key, duplicate_keys
from strata.operators.joins import (
    checked_broadcast,
    estimated_bytes,
    is_small,
    key_set_difference,
    merge_on_keys,
    orphan_keys,
    orphan_rows,
    uncovered_parents,
)
from strata.operators.quality import QualityGateError, gate, run_checks, total_violations
from strata.operators.reconcile import reconcile, reconcile_summary
from strata.operators.spine import date_dimension, date_spine
from strata.operators.topn import top_n_with_ties

__all__ = [
    "QualityGateError",
    "checked_broadcast",
    "date_dimension",
    "date_spine",
    "dedup_by_key",
    "duplicate_keys",
    "estimated_bytes",
    "gate",
    "is_small",
    "key_set_difference",
    "merge_on_keys",
    "orphan_keys",
    "orphan_rows",
    "reconcile",
    "reconcile_summary",
    "run_checks",
    "top_n_with_ties",
    "total_violations",
    "uncovered_parents",
]
