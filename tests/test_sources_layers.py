import os

import pytest
from pyspark.sql import functions as F

from strata.operators import QualityGateError
from strata.operators import quality as Q
from strata.plans.layers import Layer, check_report, run_layers
from strata.session import scratch_path
from strata.sources import SchemaMismatch, assert_schema, read_csv, spec
from strata.sources.manifest import published


def _write(spark, name, text):
    """Write a small text file into the shared scratch folder via Spark."""
    path = scratch_path(spark, name)
    lines = text.strip("\n").split("\n")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_csv_with_declared_schema(spark):
    table = spec("t", "id string, qty int, note string", key=["id"])
    path = _write(spark, "csv", "id,qty,note\nA,1,x\nB,,\nC,3\nD,4,y,extra\n")
    df = read_csv(spark, path, table)
    assert df.columns == ["id", "qty", "note", "ingestion_timestamp", "source_file"]
    rows = {r.id: (r.qty, r.note) for r in df.collect()}
    assert rows == {"A": ("1", "x"), "B": (None, None), "C": ("3", None), "D": ("4", "y")}
    assert df.filter(F.col("source_file").isNull()).count() == 0


def test_assert_schema(spark):
    table = spec("t", "id string, qty int")
    df = spark.createDataFrame([("a", 1)], "id string, qty int")
    assert_schema(df, table.typed_schema())
    with pytest.raises(SchemaMismatch):
        assert_schema(df.selectExpr("id", "cast(qty as bigint) qty"), table.typed_schema())


def _tiny_layers(expected_rows):
    def silver(t):
        return {"items": t["raw"].filter(F.col("id").isNotNull()).dropDuplicates(["id"]).select("id", "parent")}

    def gold(t):
        return {"summary": t["items"].groupBy("parent").agg(F.count(F.lit(1)).alias("n"))}

    return [
        Layer("silver", silver, [Q.row_count("items", expected_rows), Q.foreign_key("items", ["parent"], "parents")]),
        Layer("gold", gold, [Q.unique("summary", "parent")]),
    ]


def test_layers_write_check_and_hand_off(spark):
    raw = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q"), (None, "p")], "id int, parent string")
    parents = spark.createDataFrame([("p",), ("q",)], "parent string")
    root = scratch_path(spark, "layers")
    results = run_layers(spark, _tiny_layers(3), {"raw": raw, "parents": parents}, root)
    assert [r.name for r in results] == ["silver", "gold"]
    assert all(p.startswith(root) for r in results for p in r.paths.values())
    assert {r.parent: r.n for r in results[1].tables["summary"].collect()} == {"p": 2, "q": 1}
    assert check_report(results).filter("NOT passed").count() == 0
    counts = {r.table_name: r.row_count for r in results[0].row_counts().collect()}
    assert counts == {"silver_items": 3}
    latest = published(spark, root, "gold")
    assert {r.parent: r.n for r in latest["summary"].collect()} == {"p": 2, "q": 1}


def test_gate_stops_before_next_layer(spark):
    raw = spark.createDataFrame([(1, "p"), (2, "zz")], "id int, parent string")
    parents = spark.createDataFrame([("p",)], "parent string")
    root = scratch_path(spark, "layers-fail")
    with pytest.raises(QualityGateError) as err:
        run_layers(spark, _tiny_layers(2), {"raw": raw, "parents": parents}, root)
    assert "items_parent_fk_parents" in str(err.value)
    with pytest.raises(FileNotFoundError):  # the failed run was never published
        published(spark, root, "silver")


def test_scratch_path_is_under_checkpoint_dir(spark):
    ckpt = spark.sparkContext.getCheckpointDir()
    assert ckpt and scratch_path(spark, "x").startswith(ckpt.rstrip("/"))
    assert os.path.basename(scratch_path(spark, "x")) != os.path.basename(scratch_path(spark, "x"))


def test_bucketed_layer_tables_avoid_shuffles(spark):
    raw = spark.range(200).select((F.col("id") % 17).alias("k"), F.col("id").alias("v"))
    layer = Layer("silver", lambda t: {"items": t["raw"]}, [Q.row_count("items", 200)], buckets={"items": (4, ["k"])})
    root = scratch_path(spark, "bucketed")
    (result,) = run_layers(spark, [layer], {"raw": raw}, root)
    agg = result.tables["items"].groupBy("k").agg(F.sum("v").alias("s"))
    assert agg.count() == 17
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert published(spark, root, "silver")["items"].count() == 200


def test_failed_run_keeps_previous_published_version(spark):
    parents = spark.createDataFrame([("p",), ("q",)], "parent string")
    root = scratch_path(spark, "layers-versions")
    good = spark.createDataFrame([(1, "p"), (2, "q"), (3, "q")], "id int, parent string")
    run_layers(spark, _tiny_layers(3), {"raw": good, "parents": parents}, root)
    bad = spark.createDataFrame([(1, "p"), (2, "zz"), (3, "q")], "id int, parent string")
    with pytest.raises(QualityGateError):
        run_layers(spark, _tiny_layers(3), {"raw": bad, "parents": parents}, root)
    latest = published(spark, root, "gold")["summary"]
    assert {r.parent: r.n for r in latest.collect()} == {"p": 1, "q": 2}
