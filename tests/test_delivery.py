import datetime as dt

import pytest

from strata.plans.delivery import FACT_COLUMNS, gold_dim_location, gold_fact


def test_gold_fact_derivations(spark):
    rows = [
        # event_id, reg, att, engaged, minutes
        ("a", 10, 8, None, 95),      # engaged missing -> attended
        ("b", None, None, None, 60),  # nothing -> 0; no variance, no rate
        ("c", 0, 3, 0, 45),          # a true 0 engaged stays 0; registered 0 -> no rate
        ("d", 20, 25, 7, 100),       # attendance above 100 % is kept
        ("e", 4, None, 2, None),
    ]
    df = spark.createDataFrame(
        [(e, "g", dt.date(2027, 1, 1), "L", r, a, g, m) for e, r, a, g, m in rows],
        "event_id string, event_group_id string, event_date date, location_id string, registered_count int, "
        "attended_count int, engaged_people_count int, session_duration_minutes int",
    )
    with pytest.raises(ValueError, match="event_name"):
        gold_fact(df)
    fact = gold_fact(df, optional=FACT_COLUMNS)
    assert fact.columns == [c for c in FACT_COLUMNS if c in fact.columns]
    out = {r.event_id: r for r in fact.collect()}
    assert out["a"].event_date_key == 20270101 and out["a"].delivery_count == 1
    assert [out[k].people_reached for k in "abcde"] == [8, 0, 0, 7, 2]
    assert [out[k].attendance_variance for k in "abcde"] == [-2, None, 3, 5, None]
    assert [out[k].attendance_rate for k in "abcde"] == [0.8, None, None, 1.25, None]
    assert [out[k].session_duration_hours for k in "abcde"] == [1.58, 1.0, 0.75, 1.67, None]


def test_location_dimension_groups_categories_and_dedups(spark):
    df = spark.createDataFrame(
        [("L1", "Hall A", "Church Hall"), ("L2", "St B", "Church"), ("L3", "Ramp", "Boat Ramp"),
         ("L1", "Hall A", "Church Hall")],
        "location_id string, venue_name string, venue_type string",
    )
    dim = gold_dim_location(df, {"Church": ["Church", "Church Hall"]})
    assert dim.columns == ["location_id", "venue_name", "venue_type", "venue_category"]
    got = {r.location_id: (r.venue_type, r.venue_category) for r in dim.collect()}
    assert got == {"L1": ("Church Hall", "Church"), "L2": ("Church", "Church"), "L3": ("Boat Ramp", "Boat Ramp")}
