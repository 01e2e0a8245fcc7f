"""Counts taken during the write: equal to a scan, checked against the footers, and no second read."""

import re

import pytest
from pyspark.sql import functions as F

from strata.operators import QualityGateError
from strata.operators import quality as Q
from strata.plans import standin
from strata.plans.layers import Layer, run_layers
from strata.session import scratch_path
from strata.sources import sinks
from tests.conftest import SF_SMALL


def rows(spark, n=1000):
    return spark.range(n).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 7).alias("k"), (F.col("id") / 100).alias("v"))


CHECKS = [Q.row_count("t", 1000), Q.not_null("t", "k"), Q.in_range("t", "v", 0, 5), Q.distinct_count("t", "k", 7), Q.unique("t", "id")]


@pytest.mark.parametrize("buckets", [None, {"t": (3, ["id"])}])
def test_observed_values_equal_a_scan(spark, buckets):
    checks = [Q.Check(**{**c.__dict__, "severity": "warning"}) for c in CHECKS]
    layer = Layer("one", lambda t: {"t": t["raw"]}, checks, buckets=buckets or {})
    result = run_layers(spark, [layer], {"raw": rows(spark)}, scratch_path(spark, "observed"))[0]
    want = {r["check_name"]: r["observed"] for r in Q.run_checks(result.tables, checks, "one").collect()}
    assert {r["check_name"]: r["observed"] for r in result.check_rows} == want
    assert want["t_k_not_null"] == 100 and want["t_v_in_range"] == 499 and result.counts == {"t": 1000}
    assert [tuple(r) for r in result.row_counts().collect()] == [("one_t", 1000)]


def test_observed_checks_read_no_stored_column(spark):
    root = scratch_path(spark, "observed")
    results = run_layers(spark, standin.layers(), standin.load(spark, SF_SMALL), root)
    for result in results:
        plan = result.checks._jdf.queryExecution().executedPlan().toString()
        read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
        assert read and not any("satisfaction_score" in x or "event_group_id" in x for x in read)


def test_a_failing_observed_check_stops_the_run(spark):
    layer = Layer("one", lambda t: {"t": t["raw"]}, [Q.not_null("t", "k")])
    with pytest.raises(QualityGateError, match="t_k_not_null=100"):
        run_layers(spark, [layer], {"raw": rows(spark)}, scratch_path(spark, "observed"))


def test_lost_rows_are_noticed(spark, monkeypatch):
    read = sinks.read_layer
    monkeypatch.setattr("strata.plans.layers.read_layer", lambda *a: {n: df.filter("id > 3") for n, df in read(*a).items()})
    root = scratch_path(spark, "observed")
    with pytest.raises(sinks.WriteVerificationError, match="t 1000 against 996"):
        run_layers(spark, [Layer("one", lambda t: {"t": t["raw"]})], {"raw": rows(spark)}, root)


def test_counts_come_from_footers(spark):
    path = scratch_path(spark, "footers")
    rows(spark).write.parquet(path)
    stored = spark.read.parquet(path)
    counted = stored.select().agg(F.count(F.lit(1)))
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()
    assert sinks.stored_rows({"a": stored, "b": stored.limit(3)}) == {"a": 1000, "b": 3} and sinks.stored_rows({}) == {}


@pytest.mark.parametrize("empty", ["local", "filtered", "grouped"])
def test_an_empty_table_is_observed_too(spark, empty):
    df = {"local": spark.createDataFrame([], "id long, k long, v double"), "filtered": rows(spark).filter("v > 1e9"),
          "grouped": rows(spark).filter("v > 1e9").groupBy("id", "k").agg(F.max("v").alias("v"))}[empty]
    layer = Layer("one", lambda t: {"t": t["raw"]}, [Q.row_count("t", 0), Q.not_null("t", "k")])
    result = run_layers(spark, [layer], {"raw": df}, scratch_path(spark, "observed"))[0]
    assert result.counts == {"t": 0} and all(r["passed"] for r in result.check_rows)
