"""Metric-layer semantics: blank member, BLANK arithmetic, filter direction,
CALCULATE override, all-blank groups, mixed home tables, and that the
broadcast path and the pre-aggregate path return the same rows."""

import pytest

from strata.plans.delivery import delivery_model
from strata.plans.metrics import NOT_BLANK, ModelError, row, summarize


@pytest.fixture()
def model(spark):
    fact = spark.createDataFrame(
        [
            ("E1", "g1", 1, "L1", 10, 8, 4.0, 1.5, "Talk", "P1"),
            ("E2", "g1", 1, "L2", None, 5, None, 2.0, "Talk", "P2"),
            ("E3", "g2", 2, "L9", 0, 3, 5.0, 0.5, "Training", "P1"),
            ("E4", None, 2, "L1", 20, 25, None, 1.0, "Training", "P2"),
        ],
        "event_id string, event_group_id string, event_date_key int, location_id string, registered_count int, "
        "attended_count int, satisfaction_score double, session_duration_hours double, event_type string, "
        "programme_type string",
    ).selectExpr("*", "1 AS delivery_count", "coalesce(attended_count, 0) AS people_reached")
    date = spark.createDataFrame([(1, "2026-01", "January", 1), (2, "2026-02", "February", 2)],
                                 "date_key int, year_month string, month_name string, month_number int")
    location = spark.createDataFrame([("L1", "R1", "S1"), ("L2", "R2", "S2")], "location_id string, region string, suburb string")
    educator = spark.createDataFrame([("T1", "Senior"), ("T2", "Junior")], "educator_id string, experience_level string")
    bridge = spark.createDataFrame([("E1", "T1", 2.0), ("E1", "T2", 1.0), ("E2", "T1", 3.0)],
                                   "event_id string, educator_id string, hours_worked double")
    return delivery_model(fact, date, location, educator, bridge)


def rows(df):
    return {tuple(r)[0]: tuple(r)[1:] for r in df.collect()}


def both_paths(model, *args, **kw):
    """Evaluate with broadcast dimensions and with forced pre-aggregation.

    The test frames are RDD-backed (unknown size, never "small"), so an
    unlimited bound is needed to force the broadcast path."""
    try:
        model.max_broadcast_bytes = 2 ** 63 - 1
        direct = summarize(model, *args, **kw)
        direct_rows = sorted(map(tuple, direct.collect()), key=str)
        assert "BroadcastHashJoin" in direct._jdf.queryExecution().executedPlan().toString() or not _has_joins(args)
        model.max_broadcast_bytes = -1
        pre_rows = sorted(map(tuple, summarize(model, *args, **kw).collect()), key=str)
        assert direct_rows == pre_rows
    finally:
        model.max_broadcast_bytes = None
    return direct


def _has_joins(args) -> bool:
    group = args[0] if args else []
    return any(not g.startswith("fact.") for g in group)


def test_blank_member_and_blank_rules(model):
    df = both_paths(model, ["location.region"],
                    ["total_delivery_records", "registered_event_attended", "total_registered",
                     "attendance_variance", "attendance_rate", "total_event_groups"])
    got = rows(df)
    assert got["R1"] == (2, 33, 30, 3, 33 / 30, 2)  # E4's null group counts as a value
    assert got["R2"] == (1, None, None, None, None, 1)  # blank - blank = blank
    assert got[None] == (1, None, 0, 0, None, 1)  # unmatched L9 -> blank member; registered 0 is blank


def test_drop_all_blank_groups(model):
    got = rows(both_paths(model, ["location.region"], ["average_satisfaction", "rated_delivery_records"]))
    assert set(got) == {"R1", None}  # R2 has neither measure


def test_filter_direction_and_propagation(model):
    r = row(model, ["total_delivery_records", "events_delivered_by_educator", "educator_hours"],
            {"educator.experience_level": ["Senior"]}).collect()[0]
    assert tuple(r) == (4, 2, 5.0)  # the educator filter never reaches the fact
    got = rows(both_paths(model, ["educator.experience_level"], ["events_delivered_by_educator", "educator_hours"],
                          {"location.region": ["R1"]}))
    assert got == {"Senior": (1, 2.0), "Junior": (1, 1.0)}  # location -> fact -> bridge


def test_grouping_fact_measure_by_unreachable_table_raises(model):
    with pytest.raises(ModelError):
        summarize(model, ["educator.experience_level"], ["total_delivery_records"])


def test_mixed_home_tables_do_not_double_count(model):
    got = rows(both_paths(model, ["location.region"], ["total_delivery_records", "educator_hours"]))
    assert got == {"R1": (2, 3.0), "R2": (1, 3.0), None: (1, None)}
    r = row(model, ["total_delivery_records", "educator_hours"]).collect()[0]
    assert tuple(r) == (4, 6.0)


def test_calculate_filter_replaces_context_filter(model):
    r = row(model, ["total_registered", "registered_event_attended", "total_attended"],
            {"fact.registered_count": lambda c: c > 15}).collect()[0]
    assert tuple(r) == (20, 33, 25)


def test_slicers(model):
    got = rows(both_paths(model, ["date.year_month"], ["total_delivery_records", "total_people_reached"],
                          {"date.month_name": ["February"], "location.region": ["R1", "R2"], "fact.event_type": []}))
    assert got == {"2026-02": (1, 25)}
    got = rows(summarize(model, ["fact.programme_type"], ["average_satisfaction"],
                         {"fact.satisfaction_score": NOT_BLANK}))
    assert got == {"P1": (4.5,)}


def test_empty_context_gives_blank_row(model):
    r = row(model, ["total_delivery_records", "total_event_groups", "attendance_rate"],
            {"location.region": ["nowhere"]}).collect()[0]
    assert tuple(r) == (None, None, None)


def test_hot_key_third_of_rows(spark):
    """One location carries a third of the fact: both physical paths agree."""
    from pyspark.sql import functions as F

    n = 3000
    fact = spark.range(n).select(
        F.concat(F.lit("E"), F.col("id").cast("string")).alias("event_id"),
        (F.col("id") % 97).cast("string").alias("event_group_id"),
        F.lit(1).alias("event_date_key"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("L"), (F.col("id") % 50).cast("string")))
        .alias("location_id"),
        F.lit(1).alias("delivery_count"),
        (F.col("id") % 7).cast("int").alias("people_reached"),
    )
    locs = spark.range(50).select(F.concat(F.lit("L"), F.col("id").cast("string")).alias("location_id"),
                                  (F.col("id") % 5).cast("string").alias("region"))
    locs = locs.unionByName(spark.createDataFrame([("HOT", "R-hot")], "location_id string, region string"))
    date = spark.createDataFrame([(1, "2026-01")], "date_key int, year_month string")
    empty = spark.createDataFrame([], "educator_id string")
    bridge = spark.createDataFrame([], "event_id string, educator_id string, hours_worked double")
    model = delivery_model(fact, date, locs, empty, bridge)
    got = rows(both_paths(model, ["location.region"], ["total_delivery_records", "total_event_groups",
                                                        "total_people_reached", "locations_reached"]))
    assert got["R-hot"][0] == n // 3 and got["R-hot"][3] == 1
    assert sum(v[0] for v in got.values()) == n


def test_slicer_can_select_the_blank_member(model):
    got = rows(both_paths(model, ["location.region"], ["total_delivery_records"],
                          {"location.region": [None, "R2"]}))
    assert got == {None: (1,), "R2": (1,)}
    r = row(model, ["total_delivery_records", "educator_hours"], {"location.region": [None]}).collect()[0]
    assert tuple(r) == (1, None)  # E3 only; it has no staff
    got = rows(both_paths(model, ["fact.event_type"], ["total_delivery_records"],
                          {"fact.event_group_id": [None, "g2"]}))
    assert got == {"Training": (2,)}


def test_business_view_hides_columns(model):
    cols = model.business_view("fact").columns
    assert "attendance_rate" not in cols and "location_id" not in cols and "event_type" in cols
