"""Rules that hold at any size: bucketed files, cleaned-up failures, one result type on both
physical paths, no stale schemas, aggregation below a hot key's join."""

import datetime as dt
import os
import re
from collections import Counter
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import QualityGateError, joins, top_n_with_ties
from strata.operators import quality as Q
from strata.operators.joins import read_bytes, spread
from strata.plans import catalog, questions
from strata.plans.layers import Layer, layer_database, run_layers
from strata.plans.metrics import Measure, Model, Relationship, summarize
from strata.session import scratch_path
from strata.sources.ingest import read_parquet
from tests.conftest import SF_SMALL


def _layers(buckets, expected):
    return [Layer("silver", lambda t: {"items": t["raw"]}, [Q.row_count("items", expected)],
                  buckets={"items": (buckets, ["id"])})]


def test_one_file_per_bucket_however_many_tasks_write(spark):
    raw = spark.range(5000).repartition(24)
    path = run_layers(spark, _layers(6, 5000), {"raw": raw}, scratch_path(spark, "buckets"))[0].paths["items"]
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert len(files) == 6


def test_failed_layer_leaves_no_catalog_table(spark):
    root = scratch_path(spark, "failed")
    with pytest.raises(QualityGateError):
        run_layers(spark, _layers(2, 1), {"raw": spark.range(10)}, root)
    assert spark.sql(f"SHOW TABLES IN {layer_database(spark, root)}").filter("NOT isTemporary").count() == 0


def test_a_check_needs_an_expectation(spark):
    with pytest.raises(ValueError, match="never fail"):
        Q.run_checks({"t": spark.range(3)}, [Q.Check("open", "row_count", "t")])


def test_a_rewritten_file_shows_its_new_column(spark):
    path = scratch_path(spark, "rewritten")
    spark.range(3).write.parquet(path)
    assert read_parquet(spark, path).columns == ["id"]
    spark.range(3).withColumn("more", F.lit(1)).write.mode("overwrite").parquet(path)
    assert read_parquet(spark, path).columns == ["id", "more"]


@pytest.mark.parametrize("kind, values, blanks", [
    ("decimal(10,2)", [Decimal("1.25"), Decimal("0.00"), None, Decimal("7.10")], 2),
    ("string", ["a", "", None, "b"], 2),
    ("date", [dt.date(2024, 1, 1), None, dt.date(2024, 2, 1), dt.date(1970, 1, 1)], 1),
    ("boolean", [True, False, None, True], 2),
    ("int", [1, 0, None, 5], 2),
])
def test_both_paths_give_one_schema_and_the_same_rows(spark, kind, values, blanks):
    fact = spark.createDataFrame([(i % 2, v, Decimal(i) / 3, i) for i, v in enumerate(values * 3)],
                                 f"k int, c {kind}, amount decimal(12,4), n int")
    dim = spark.createDataFrame([(0, "even"), (1, "odd")], "k int, name string")
    measures = [Measure("rows", "count_rows", "fact", where=("c", "nonblank")),
                Measure("total", "sum", "fact", "amount", where=("c", "nonblank")),
                Measure("mean", "avg", "fact", "amount"), Measure("kinds", "distinct", "fact", "c"),
                Measure("whole", "sum", "fact", "n")]
    found = []
    for bound in (2 ** 63 - 1, -1):
        model = Model({"fact": fact, "dim": dim}, [Relationship("fact", "k", "dim", "k")], {}, max_broadcast_bytes=bound)
        df = summarize(model.add_measures(measures), ["dim.name"], [m.name for m in measures])
        found.append((df.schema, sorted(map(tuple, df.collect()))))
    assert found[0] == found[1]
    assert sum(r[1] for r in found[0][1]) == 3 * (4 - blanks)
    types = {f.name: f.dataType.simpleString() for f in found[0][0]}
    assert types["total"] == "decimal(22,4)" and types["mean"] == "double" and types["whole"] == "bigint"


def test_hot_key_is_aggregated_below_the_join(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("location_id"), F.lit(2).alias("people_reached"),
        (F.col("id") % 7).cast("string").alias("event_group_id"))
    location = spark.range(50).select(F.col("id").alias("location_id"), (F.col("id") % 4).cast("string").alias("region"))
    want = sorted(map(tuple, questions.reach_by_region(fact, location).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = questions.reach_by_region(fact, location)
        assert sorted(map(tuple, df.collect())) == want
        plan = df._jdf.queryExecution().executedPlan().toString()
        initial = plan.split("== Initial Plan ==")[-1]
        assert "SortMergeJoin" in initial and "BroadcastHashJoin" not in initial
        joins = initial.split("SortMergeJoin")[1:]
        left = joins[0].split("+- Sort [__key")[0]
        assert len(joins) == 1 and left.count("HashAggregate(keys=[") == 2 and "partial_sum(" in left
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _raw_scans(df) -> Counter:
    """How often each raw table is scanned in the planned tree."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return Counter(re.findall(r"FileScan parquet.*?Location: .*?/(\w+)\.parquet\]", plan))


@pytest.mark.parametrize("name, once", [
    ("bq_reach_by_region", ["orders", "lineitem", "customer"]),
    ("bq_educator_ranking", ["lineitem", "supplier"]),
    ("bq_outreach_suburbs_top10", ["orders", "lineitem", "customer"]),
])
def test_questions_scan_each_table_once(spark, name, once):
    scans = _raw_scans(catalog.REGISTRY[name](spark, SF_SMALL))
    assert {t: scans[t] for t in once} == dict.fromkeys(once, 1), scans


def test_monthly_trend_scans_orders_for_the_fact_and_the_calendar_bounds(spark):
    scans = _raw_scans(catalog.REGISTRY["bq_monthly_trend"](spark, SF_SMALL))
    assert scans["lineitem"] <= 1 and scans["orders"] == 2, scans


def test_top_n_limits_rows_in_every_task_and_keeps_ties_past_the_threshold(spark):
    rows = spark.range(4000).select("id", (F.col("id") % 9).alias("v"), F.lit(0).alias("salt"))
    df = top_n_with_ties(rows, 3, [("v", True)])
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("WindowGroupLimit") == 4 and plan.count("Range (") == 1
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, rows.filter("v = 0").collect()))
    assert top_n_with_ties(rows, 1500, [("v", True)]).count() == rows.filter("v < 4").count()


def test_spread_takes_more_partitions_for_larger_inputs(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(100).select("id", F.lit("x" * 100).alias("v"))
    size = read_bytes(df)
    assert size > 0 and read_bytes(df.join(df.withColumnRenamed("v", "w"), "id")) <= 2 * size  # not the product
    assert read_bytes(spark.createDataFrame([(1,)], "id long").join(df, "id")) <= size  # unknown sizes do not count
    old, joins.PART_BYTES = joins.PART_BYTES, size // 50
    try:
        many = spread(df, ["id"])
    finally:
        joins.PART_BYTES = old
    assert many.rdd.getNumPartitions() >= 50 and many.count() == 100
    assert spread(df, ["id"]).rdd.getNumPartitions() == parts


@pytest.mark.parametrize("name", ["mx_educator", "bq_educator_ranking"])
def test_staff_questions_neither_fold_the_bridge_twice_nor_count_in_joined_up_partitions(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.REGISTRY[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    above, below = plan.split("SortMergeJoin")[:2]
    assert above.count("REPARTITION_BY_NUM") == 1
    assert re.findall(r"partial_sum\((\w+)", below) == ["l_quantity"]


def test_rows_that_share_a_grain_are_counted_as_without_it(spark):
    bridge = spark.createDataFrame([(1, 1, 2.0), (1, 1, 3.0), (1, 2, 4.0), (2, 1, None), (None, 1, 5.0), (None, 1, 1.0), (3, None, 7.0), (3, 9, 8.0)],
                                   "event_id long, educator_id long, hours_worked double")
    staff = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "y")], "educator_id long, educator_name string, experience_level string")
    measures = {m.name: m for m in (Measure("events", "distinct", "bridge", "event_id"), Measure("hours", "sum", "bridge", "hours_worked"),
                                    Measure("average", "avg", "bridge", "hours_worked"), Measure("rows", "count_rows", "bridge"),
                                    Measure("timed", "distinct", "bridge", "event_id", where=("hours_worked", "nonblank")))}
    model = Model({"bridge": bridge, "educator": staff}, [Relationship("bridge", "educator_id", "educator", "educator_id")], measures)
    found = []
    for grains in ({}, {"bridge": ("event_id", "educator_id")}):
        for most in (-1, None):
            df = summarize(replace(model, grains=grains, max_broadcast_bytes=most), ["educator.educator_name"], list(measures))
            found.append((sorted(map(tuple, df.collect()), key=str), df.schema.simpleString()))
    assert found.count(found[0]) == 4
    assert ("a", 3, 15.0, 3.0, 6, 2) in found[0][0]
    sums = {"hours": "hours_worked"}
    own = bridge.withColumnRenamed("educator_id", "own")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = [sorted(map(tuple, questions.by_attribute(own, "own", staff, "educator_id", ["educator_name"], sums, {"events": "event_id"}, folded=f)
                             .collect())) for f in (False, True)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert ranked[0] == ranked[1] == [("a", 15.0, 2)]
