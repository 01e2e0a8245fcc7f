"""Property test: summarize (broadcast and pre-aggregate paths) equals a SQL
evaluation of the same measures on random facts with blanks and orphans."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.plans.delivery import delivery_model
from strata.plans.metrics import summarize
from strata.plans.oracle import measures

MEASURES = ["total_delivery_records", "total_event_groups", "total_registered", "registered_event_attended",
            "attendance_variance", "attendance_rate", "locations_reached"]

fact_rows = st.lists(
    st.tuples(
        st.sampled_from(["g1", "g2", "g3", None]),                  # event_group_id
        st.sampled_from(["L1", "L2", "L3", "L4", "X9", None]),      # location_id (X9: orphan)
        st.one_of(st.none(), st.integers(0, 30)),                   # registered_count (0 is blank)
        st.one_of(st.none(), st.integers(0, 40)),                   # attended_count
    ),
    min_size=1, max_size=40,
)
regions = st.tuples(*[st.sampled_from(["R1", "R2", None]) for _ in range(4)])


def _norm(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=fact_rows, regs=regions)
def test_summarize_matches_sql(spark, rows, regs):
    facts = [(f"E{i}", g, 1, loc, reg, att, 1) for i, (g, loc, reg, att) in enumerate(rows)]
    locs = [(f"L{i + 1}", r) for i, r in enumerate(regs)]
    schema = ("event_id string, event_group_id string, event_date_key int, location_id string, "
              "registered_count int, attended_count int, delivery_count int")
    fact = spark.createDataFrame(facts, schema)
    location = spark.createDataFrame(locs, "location_id string, region string")
    date = spark.createDataFrame([(1, "2026-01")], "date_key int, year_month string")
    educator = spark.createDataFrame([], "educator_id string")
    bridge = spark.createDataFrame([], "event_id string, educator_id string, hours_worked double")
    model = delivery_model(fact, date, location, educator, bridge)

    con = duckdb.connect()
    con.execute("CREATE TABLE fact (event_id VARCHAR, event_group_id VARCHAR, event_date_key INT, location_id VARCHAR, "
                "registered_count INT, attended_count INT, delivery_count INT)")
    con.executemany("INSERT INTO fact VALUES (?, ?, ?, ?, ?, ?, ?)", facts)
    con.execute("CREATE TABLE loc (location_id VARCHAR, region VARCHAR)")
    con.executemany("INSERT INTO loc VALUES (?, ?)", locs)
    want = con.execute(
        f"SELECT region, {measures(*MEASURES)} FROM (SELECT f.*, l.region FROM fact f "
        "LEFT JOIN loc l ON f.location_id = l.location_id) GROUP BY region").fetchall()

    # an unlimited bound forces the broadcast path (test frames are RDD-backed, so
    # their size is unknown and never "small"); -1 forces pre-aggregation
    for bound in (2 ** 63 - 1, -1):
        model.max_broadcast_bytes = bound
        got = summarize(model, ["location.region"], MEASURES).collect()
        assert _norm(map(tuple, got)) == _norm(want)


bridge_rows = st.lists(
    st.tuples(st.sampled_from(["E0", "E1", "E2", "E3", "E99", None]),  # event_id (E99: orphan)
              st.sampled_from(["T1", "T2"]),
              st.one_of(st.none(), st.integers(0, 8).map(float))),
    max_size=20,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=fact_rows, regs=regions, assignments=bridge_rows)
def test_mixed_home_tables_match_sql(spark, rows, regs, assignments):
    facts = [(f"E{i}", g, 1, loc, reg, att, 1) for i, (g, loc, reg, att) in enumerate(rows)]
    locs = [(f"L{i + 1}", r) for i, r in enumerate(regs)]
    schema = ("event_id string, event_group_id string, event_date_key int, location_id string, "
              "registered_count int, attended_count int, delivery_count int")
    model = delivery_model(
        spark.createDataFrame(facts, schema),
        spark.createDataFrame([(1, "2026-01")], "date_key int, year_month string"),
        spark.createDataFrame(locs, "location_id string, region string"),
        spark.createDataFrame([("T1",), ("T2",)], "educator_id string"),
        spark.createDataFrame(assignments, "event_id string, educator_id string, hours_worked double"),
    )
    con = duckdb.connect()
    con.execute("CREATE TABLE fact (event_id VARCHAR, event_group_id VARCHAR, event_date_key INT, location_id VARCHAR, "
                "registered_count INT, attended_count INT, delivery_count INT)")
    con.executemany("INSERT INTO fact VALUES (?, ?, ?, ?, ?, ?, ?)", facts)
    con.execute("CREATE TABLE loc (location_id VARCHAR, region VARCHAR)")
    con.executemany("INSERT INTO loc VALUES (?, ?)", locs)
    con.execute("CREATE TABLE br (event_id VARCHAR, educator_id VARCHAR, hours_worked DOUBLE)")
    if assignments:
        con.executemany("INSERT INTO br VALUES (?, ?, ?)", assignments)
    want = con.execute("""
        WITH fj AS (SELECT f.*, l.region FROM fact f LEFT JOIN loc l ON f.location_id = l.location_id),
        a AS (SELECT region, CAST(SUM(delivery_count) AS BIGINT) AS d FROM fj GROUP BY region),
        b AS (SELECT fj.region, SUM(b.hours_worked) AS h,
                     NULLIF(COUNT(DISTINCT b.event_id) + MAX(CASE WHEN b.event_id IS NULL THEN 1 ELSE 0 END), 0) AS e
              FROM br b LEFT JOIN fj ON b.event_id = fj.event_id GROUP BY fj.region)
        SELECT COALESCE(a.region, b.region) AS region, a.d, b.h, b.e
        FROM a FULL OUTER JOIN b ON a.region IS NOT DISTINCT FROM b.region
        WHERE a.d IS NOT NULL OR b.h IS NOT NULL OR b.e IS NOT NULL""").fetchall()
    for bound in (2 ** 63 - 1, -1):
        model.max_broadcast_bytes = bound
        got = summarize(model, ["location.region"],
                        ["total_delivery_records", "educator_hours", "events_delivered_by_educator"]).collect()
        assert _norm(map(tuple, got)) == _norm(want)
