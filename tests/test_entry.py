"""The driver contract: entry() smoke, every query has an oracle, and every
query agrees with its DuckDB oracle on the smallest scale factor."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans import catalog, oracle
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "delivery_records", "event_groups", "people_reached"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.REGISTRY) == set(oracle.ORACLE) and set(catalog.REGISTRY) <= set(E.queries())
    assert set(oracle.ORACLE) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(catalog.REGISTRY) >= 60


def _norm(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


def _key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test data missing")
@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_key)
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    want = sorted((tuple(_norm(r[i]) for i in order) for r in res.fetchall()), key=_key)
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no cross products; no window or exchange funnelling all rows into one task (merges of partial
    # rows are fine, and so are windows over rows that were limited by rank in every task before)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)
    assert _only_limited_windows(plan) and _only_global_merges(plan), name


BOUNDED_CONSUMERS = ("HashAggregate(keys=[]", "SortAggregate(key=[]", "ObjectHashAggregate(keys=[]",
                     "GlobalLimit", "TakeOrderedAndProject", "CollectLimit")
WRAPPERS = ("ShuffleQueryStage", "AQEShuffleRead")


def _only_global_merges(plan: str) -> bool:
    """Every SinglePartition exchange feeds a keyless aggregate (one partial
    row per partition) or a limit (at most n rows per partition), or moves rows that were
    limited by rank (at most n rows and their ties per partition)."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            j = i - 1
            while j >= 0 and any(w in lines[j] for w in WRAPPERS):
                j -= 1
            if _child(lines, i).startswith("WindowGroupLimit"):
                continue
            if j < 0 or not any(c in lines[j] for c in BOUNDED_CONSUMERS):
                return False
    return True


def _child(lines: list[str], i: int) -> str:
    """The operator below line i, without the tree's marks, code generation and projections."""
    below = (re.sub(r"^[\s:+|*-]*(\(\d+\) )?", "", x) for x in lines[i + 1:])
    return next((x for x in below if not x.startswith(("Project", "InputAdapter", "WholeStageCodegen"))), "")


def _only_limited_windows(plan: str) -> bool:
    """Every window stands on a rank limit, which Spark also applies before the exchange."""
    lines = plan.splitlines()
    return all(_child(lines, i).startswith("WindowGroupLimit") for i, x in enumerate(lines) if re.search(r"\bWindow \[", x))
