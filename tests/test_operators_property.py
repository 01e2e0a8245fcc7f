"""Property tests: custom operators vs plain SQL on random data with nulls and ties."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import dedup_by_key, top_n_with_ties

rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 3)),
              st.one_of(st.none(), st.integers(0, 2))),
    min_size=0, max_size=30,
)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _duck(data):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k VARCHAR, x INT, y INT)")
    if data:
        con.executemany("INSERT INTO t VALUES (?, ?, ?)", data)
    return con


@SETTINGS
@given(data=rows, n=st.integers(1, 6), x_asc=st.booleans())
def test_top_n_with_ties_equals_rank(spark, data, n, x_asc):
    df = spark.createDataFrame(data, "k string, x int, y int")
    got = sorted(map(tuple, top_n_with_ties(df, n, [("x", x_asc), ("y", True)]).collect()), key=str)
    order = "x ASC NULLS FIRST" if x_asc else "x DESC NULLS LAST"
    want = _duck(data).execute(
        f"SELECT k, x, y FROM (SELECT *, rank() OVER (ORDER BY {order}, y ASC NULLS FIRST) AS r FROM t) "
        f"WHERE r <= {n}").fetchall()
    assert got == sorted(want, key=str)


@SETTINGS
@given(data=rows)
def test_dedup_equals_row_number(spark, data):
    df = spark.createDataFrame(data, "k string, x int, y int")
    got = sorted(map(tuple, dedup_by_key(df, ["k"], ["x", "y"]).collect()), key=str)
    want = _duck(data).execute(
        "SELECT k, x, y FROM t QUALIFY row_number() OVER (PARTITION BY k ORDER BY x NULLS FIRST, y NULLS FIRST) = 1"
    ).fetchall()
    assert got == sorted(want, key=str)


keys = st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=25)


@SETTINGS
@given(child=keys, parent=keys, with_coverage=st.booleans(), stored_parent=st.booleans())
def test_key_checks_equal_sql(spark, child, parent, with_coverage, stored_parent):
    from strata.operators import run_checks
    from strata.operators import quality as Q
    from strata.session import scratch_path

    c = spark.createDataFrame([(k,) for k in child], "k long")
    p = spark.createDataFrame([(k,) for k in parent], "k long")
    if stored_parent:  # a stored table has a known (small) size: the broadcast anti-join path
        path = scratch_path(spark, "parent")
        p.write.parquet(path)
        p = spark.read.schema("k long").parquet(path)
    checks = [Q.foreign_key("c", ["k"], "p"), Q.foreign_key("c", ["k"], "p", rows=True, name="rows"),
              Q.unique("p", "k"), Q.not_null("c", "k")]
    if with_coverage:  # shares the key pair: the profile path
        checks.append(Q.coverage("p", ["k"], "c"))
    got = {r.check_name: r.observed for r in run_checks({"c": c, "p": p}, checks).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE c (k BIGINT)")
    con.execute("CREATE TABLE p (k BIGINT)")
    if child:
        con.executemany("INSERT INTO c VALUES (?)", [(k,) for k in child])
    if parent:
        con.executemany("INSERT INTO p VALUES (?)", [(k,) for k in parent])
    q = lambda sql: con.execute(sql).fetchone()[0]
    assert got["c_k_fk_p"] == q("SELECT COUNT(*) FROM (SELECT DISTINCT k FROM c) x "
                                "WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = x.k)")
    assert got["rows"] == q("SELECT COUNT(*) FROM c WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = c.k)")
    assert got["p_k_unique"] == q("SELECT COUNT(*) FROM (SELECT k FROM p GROUP BY k HAVING COUNT(*) > 1)")
    assert got["c_k_not_null"] == q("SELECT COUNT(*) FROM c WHERE k IS NULL")
    if with_coverage:
        assert got["p_covered_by_c"] == q("SELECT COUNT(*) FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.k = p.k)")
