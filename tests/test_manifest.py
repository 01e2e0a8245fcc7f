"""Published versions: interleaved runs, pinned readers, left-over runs, drift; joins over stored buckets."""

import re

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.joins import estimated_bytes
from strata.plans import standin
from strata.plans.delivery import published_model
from strata.plans.layers import Layer, layer_database, run_layer, run_layers
from strata.plans.metrics import summarize
from strata.session import scratch_path
from strata.sources import manifest as M
from strata.sources.sinks import write_layer
from tests.conftest import SF_SMALL


def layer(expected):
    return Layer("one", lambda t: {"t": t["raw"]}, [Q.row_count("t", expected)], buckets={"t": (2, ["id"])})


def test_two_interleaved_runs_both_get_a_number(spark):
    root = scratch_path(spark, "versions")
    a, b = (write_layer(spark, {"t": spark.range(n)}, root, "one", run_id=r) for n, r in ((3, "a"), (5, "b")))  # both written
    assert M.publish(spark, root, "one", b, "b") == 1    # b ends first
    assert M.published(spark, root, "one")["t"].count() == 5
    assert M.publish(spark, root, "one", a, "a") == 2
    assert M.versions(spark, root, "one") == [1, 2]
    assert M.published(spark, root, "one")["t"].count() == 3
    assert M.published(spark, root, "one", 1)["t"].count() == 5  # a pinned reader


def test_a_number_taken_meanwhile_is_not_overwritten(spark, monkeypatch):
    root = scratch_path(spark, "versions")
    paths = {r: write_layer(spark, {"t": spark.range(n)}, root, "one", run_id=r) for n, r in ((3, "a"), (5, "b"))}
    M.publish(spark, root, "one", paths["a"], "a")
    monkeypatch.setattr(M, "versions", lambda *x: [])  # what b saw before a published
    assert M.publish(spark, root, "one", paths["b"], "b") == 2
    monkeypatch.undo()
    assert [M.manifest(spark, root, "one", n)[0]["run_id"] for n in M.versions(spark, root, "one")] == ["a", "b"]


def test_nothing_published(spark):
    root = scratch_path(spark, "versions")
    assert M.versions(spark, root, "one") == []
    with pytest.raises(FileNotFoundError):
        M.published(spark, root, "one")


def test_left_over_runs_go_once_they_are_old(spark):
    root = scratch_path(spark, "leftover")
    run_layer(spark, layer(4), {"raw": spark.range(4)}, root)
    with pytest.raises(Q.QualityGateError):
        run_layer(spark, layer(4), {"raw": spark.range(6)}, root)
    database = layer_database(spark, root)
    assert M.remove_unpublished(spark, root, "one", ["t"], database) == []  # perhaps still running
    gone = M.remove_unpublished(spark, root, "one", ["t", "unknown"], database, min_age_s=0)
    assert len(gone) == 1 and "/one_t/run=" in gone[0]
    assert M.remove_unpublished(spark, root, "one", ["t"], database, min_age_s=0) == []
    assert M.published(spark, root, "one")["t"].count() == 4


def test_drift_of_type_order_and_columns(spark):
    root = scratch_path(spark, "drift")
    df = spark.range(3).select("id", F.lit("x").alias("a"), F.lit(1.5).alias("b"))
    for table in (df, df.select("b", "id", F.col("a").cast("binary").alias("a"), F.lit(1).alias("z"))):
        run_layer(spark, Layer("one", lambda t: {"t": t["raw"]}), {"raw": table}, root)
    rows = [tuple(r) for r in M.schema_drift(spark, root, "one", {"t": df.schema, "u": spark.range(1).schema}).collect()]
    status = {(r[0], r[1], r[2]): (r[3], r[5], r[6]) for r in rows}
    assert {v[2] for k, v in status.items() if k[:2] == (1, "t")} == {"same"}
    assert status[2, "t", "id"] == (1, "bigint", "moved") and status[2, "t", "b"] == (0, "double", "moved")
    assert status[2, "t", "a"] == (2, "binary", "type changed") and status[2, "t", "z"] == (3, "int", "unexpected")
    assert status[2, "u", "id"] == (None, None, "missing")


def test_a_filter_reaches_the_bridge_without_an_exchange_between_bridge_and_fact(spark):
    root = scratch_path(spark, "bound")
    run_layers(spark, standin.layers(4), standin.load(spark, SF_SMALL), root)
    model = published_model(spark, root)
    assert ("bridge", "fact") in model.colocated and len(model.colocated) == 1
    location = estimated_bytes(model.tables["location"])
    assert location < estimated_bytes(model.tables["fact"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")
    want = summarize(standin.gold(spark, SF_SMALL).model(), ["educator.experience_level"],
                     ["events_delivered_by_educator", "educator_hours"], {"location.region": ["ASIA"]}).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model.max_broadcast_bytes = location
        df = summarize(model, ["educator.experience_level"], ["events_delivered_by_educator", "educator_hours"],
                       {"location.region": ["ASIA"]})
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want))
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    at = next(i for i, x in enumerate(plan) if re.search(r"SortMergeJoin \[bridge__event_id#\d+L?\], \[fact__event_id#\d+L?\], LeftSemi", x))
    depth = len(re.match(r"[\s:|+-]*", plan[at]).group())
    under = [x for x in plan[at + 1:] if len(re.match(r"[\s:|+-]*", x).group()) > depth]
    under = under[:next((i for i, x in enumerate(plan[at + 1:]) if len(re.match(r"[\s:|+-]*", x).group()) <= depth), len(under))]
    exchanges = [x for x in under if "Exchange" in x]
    assert all("BroadcastExchange" in x for x in exchanges) and len(exchanges) == 1, "\n".join(under)  # the location keys
    assert sum("Bucketed: true" in x for x in under) == 2
