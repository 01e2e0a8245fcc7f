import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import (
    QualityGateError,
    checked_broadcast,
    date_spine,
    dedup_by_key,
    duplicate_keys,
    gate,
    key_set_difference,
    orphan_keys,
    orphan_rows,
    reconcile,
    reconcile_summary,
    run_checks,
    top_n_with_ties,
    total_violations,
    uncovered_parents,
)
from strata.operators import quality as Q


def test_dedup_is_deterministic_and_keeps_columns(spark):
    df = spark.createDataFrame(
        [(1, 2, "b", 9.0), (1, 1, "z", 1.0), (1, 1, "a", 5.0), (2, 7, "q", 0.0), (None, 3, "n", 1.0),
         (None, 1, "m", 2.0)],
        "k int, o int, s string, v double",
    )
    out = dedup_by_key(df, ["k"], ["o", "s"])
    assert out.columns == df.columns
    got = {r.k: tuple(r) for r in out.collect()}
    assert got[1] == (1, 1, "a", 5.0)  # smallest by (o, s)
    assert got[2] == (2, 7, "q", 0.0)
    assert got[None] == (None, 1, "m", 2.0)  # null key is one group


def test_dedup_hot_key_is_combined_map_side(spark):
    hot = spark.range(0, 30000).select(F.lit(7).alias("k"), (F.col("id") % 1000).alias("o"))
    cold = spark.range(0, 1000).select((F.col("id") + 100).alias("k"), F.col("id").alias("o"))
    out = dedup_by_key(hot.unionByName(cold).repartition(8), ["k"], ["o"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # partial aggregation before the exchange
    assert out.count() == 1001
    assert out.filter("k = 7").collect()[0].o == 0


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert sorted(duplicate_keys(df, ["a"]).collect(), key=str) == sorted([(1, 3), (None, 2)], key=str)
    assert duplicate_keys(df, ["a", "b"]).count() == 2


def test_orphans_and_coverage(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (5,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "pk int")
    assert sorted(orphan_keys(child, ["fk"], parent, ["pk"]).collect(), key=str) == sorted([(5,), (None,)], key=str)
    rows = {r.fk: r.orphan_rows for r in orphan_rows(child, ["fk"], parent, ["pk"]).collect()}
    assert rows == {5: 1, None: 1}
    assert [r.pk for r in uncovered_parents(parent, ["pk"], child, ["fk"]).collect()] == [3]


def test_except_treats_null_as_equal(spark):
    a = spark.createDataFrame([(1,), (None,), (4,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "e int")
    assert [r.k for r in key_set_difference(a, ["k"], b, ["e"]).collect()] == [4]
    # left_anti keeps the null row instead (null never matches)
    assert orphan_keys(a, ["k"], b, ["e"]).count() == 2


def test_checked_broadcast_respects_bound(spark):
    small = spark.range(5)
    unknown = spark.createDataFrame([(1,)], "k int")  # RDD-backed: size unknown, never hinted
    assert "broadcast" not in checked_broadcast(unknown)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in checked_broadcast(small)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in checked_broadcast(small, max_bytes=0)._jdf.queryExecution().analyzed().toString().lower()


def test_checks_table_and_gate(spark):
    t = spark.createDataFrame([(1, 3.0), (1, 9.0), (None, None)], "k int, s double")
    p = spark.createDataFrame([(1,)], "k int")
    checks = [Q.row_count("t", 3), Q.not_null("t", "k"), Q.in_range("t", "s", 1, 5), Q.unique("t", "k"),
              Q.foreign_key("t", ["k"], "p"), Q.coverage("p", ["k"], "t"), Q.distinct_count("t", "k", 2)]
    table = run_checks({"t": t, "p": p}, checks, "bronze")
    got = {r.check_name: (r.observed, r.violations, r.passed) for r in table.collect()}
    assert got["t_row_count"] == (3, 0, True)
    assert got["t_k_not_null"] == (1, 1, False)
    assert got["t_s_in_range"] == (1, 1, False)  # null ignored, 9.0 out of range
    assert got["t_k_unique"] == (1, 1, False)
    assert got["t_k_fk_p"] == (1, 1, False)  # the null key is an orphan
    assert got["p_covered_by_t"] == (0, 0, True)
    assert got["t_k_distinct"] == (1, 1, False)
    assert total_violations(table).collect()[0][0] == 5
    with pytest.raises(QualityGateError):
        gate(table)
    assert len(gate(run_checks({"t": t}, [Q.row_count("t", 3)]))) == 1


def test_date_spine(spark):
    df = spark.createDataFrame([(dt.date(2026, 2, 11),), (dt.date(2026, 2, 14),), (dt.date(2026, 2, 12),)], "d date")
    assert [r.date for r in date_spine(df, "d").collect()] == [dt.date(2026, 2, d) for d in range(11, 15)]
    empty = df.filter("false")
    assert date_spine(empty, "d").count() == 0


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([(n, v) for n, v in zip("abcdefg", [1, 2, 2, 2, 3, 4, 5])], "name string, v int")
    got = sorted(r.name for r in top_n_with_ties(df, 2, [("v", True)]).collect())
    assert got == ["a", "b", "c", "d"]
    got = sorted(r.name for r in top_n_with_ties(df, 2, [("v", True), ("name", True)]).collect())
    assert got == ["a", "b"]
    got = sorted(r.name for r in top_n_with_ties(df, 2, [("v", False)]).collect())
    assert got == ["f", "g"]
    assert top_n_with_ties(df, 50, [("v", True)]).count() == 7
    assert top_n_with_ties(df.filter("false"), 3, [("v", True)]).count() == 0


def test_top_n_nulls_follow_sort_defaults(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), ("c", 2)], "name string, v int")
    assert [r.name for r in top_n_with_ties(df, 1, [("v", True)]).collect()] == ["a"]  # nulls first ascending
    assert [r.name for r in top_n_with_ties(df, 1, [("v", False)]).collect()] == ["c"]  # nulls last descending


def test_reconcile(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), (None, 3.0)], "k string, v double")
    b = spark.createDataFrame([("x", 1.0), ("y", 2.5), (None, 3.0), ("z", 1.0)], "k string, v double")
    cmp = reconcile(a, b, ["k"], ["v"])
    status = {r.k: r.status for r in cmp.collect()}
    assert status == {"x": "match", "y": "mismatch", None: "match", "z": "only_right"}
    assert tuple(reconcile_summary(cmp).collect()[0]) == (4, 2, 1, 0, 1)


def test_merge_on_keys_is_a_null_safe_full_outer_merge(spark):
    from strata.operators import merge_on_keys

    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a bigint")
    b = spark.createDataFrame([("x", 1.5), ("y", 2.5), (None, 3.5)], "k string, b double")
    got = {r.k: (r.a, r.b) for r in merge_on_keys([a, b], ["k"]).collect()}
    assert got == {"x": (1, 1.5), "y": (None, 2.5), None: (2, 3.5)}
    one = merge_on_keys([a.agg(F.sum("a").alias("sa")), b.agg(F.max("b").alias("mb"))], [])
    assert tuple(one.collect()[0]) == (3, 3.5)
    assert "CartesianProduct" not in one._jdf.queryExecution().executedPlan().toString()


def test_foreign_key_and_coverage_paths_agree(spark):
    child = spark.createDataFrame([(1,), (1,), (4,), (None,)], "k long")
    small_parent = spark.range(0, 3).withColumnRenamed("id", "k")            # size known: broadcast anti-join
    rdd_parent = spark.createDataFrame([(0,), (1,), (2,), (2,), (None,)], "k long")  # size unknown: profile
    for parent, uncovered in ((small_parent, None), (rdd_parent, 4)):
        checks = [Q.foreign_key("c", ["k"], "p")]
        if uncovered is not None:
            checks.append(Q.coverage("p", ["k"], "c"))
        got = {r.check_kind: r.observed for r in run_checks({"c": child, "p": parent}, checks).collect()}
        assert got["foreign_key"] == 2  # 4 and the null key
        if uncovered is not None:
            assert got["coverage"] == uncovered  # rows 0, 2, 2 and the null key


def test_checks_with_materialized_inputs_agree(spark):
    t = spark.range(0, 50).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("s"))
    p = spark.range(0, 5).withColumnRenamed("id", "k")
    checks = [Q.row_count("t", 50), Q.not_null("t", "k"), Q.unique("t", "k"), Q.foreign_key("t", ["k"], "p"),
              Q.coverage("p", ["k"], "t"), Q.unique("p", "k")]
    lazy = sorted(map(tuple, run_checks({"t": t, "p": p}, checks).collect()))
    staged = sorted(map(tuple, run_checks({"t": t, "p": p}, checks, materialize=True).collect()))
    assert lazy == staged
    assert dict((r[1], r[4]) for r in lazy)["t_k_fk_p"] == 2  # keys 5 and 6


def test_dedup_orders_nulls_first_like_the_oracle(spark):
    import duckdb

    rows = [(1, None, "b"), (1, 0, "a"), (2, 5, None), (2, 5, "a"), (3, None, None), (3, None, "z")]
    df = spark.createDataFrame(rows, "k int, o int, s string")
    got = sorted(map(tuple, dedup_by_key(df, ["k"], ["o", "s"]).collect()))
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k INT, o INT, s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    want = sorted(con.execute(
        "SELECT k, o, s FROM t QUALIFY row_number() OVER (PARTITION BY k ORDER BY o NULLS FIRST, s NULLS FIRST) = 1"
    ).fetchall())
    assert got == want == [(1, None, "b"), (2, 5, None), (3, None, None)]
