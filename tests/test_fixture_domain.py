"""Golden totals of a small outreach domain, from CSV text with known defects to measures."""

import pytest

from strata.functions.clean import cast_rejects
from strata.operators import run_checks
from strata.plans import questions
from strata.plans.delivery import delivery_model
from strata.plans.metrics import row, summarize
from strata.session import scratch_path
from strata.sources import read_csv
from tests import domain_outreach as D

# event, group, date, type, programme, place, registered, attended, engaged, minutes, score
EVENTS = [
    ("E1", "G1", "2024-01-05", "Talk", "A", "L1", "10", "8", "", "60", "4.0"),
    (" E1 ", "G1", "2024-01-05", "Talk", "A", "L1", "10", "8", "", "60", "4.0"),   # the same key again, padded
    ("E2", "G1", "2024-01-20", "Talk", "A", "L2", "0", "5", "7", "30", ""),         # nobody registered
    ("E3", "G2", "2024-02-01", "Class", "B", "L1", "4", "6", "", "90", "5"),        # a rate above 1
    ("E4", "G3", "2024-02-15", "Class", "B", "L9", "", "3", "20", "x", ""),         # no such place, no such number
    ("E5", "G3", "2024-03-01", "Talk", "A", "L2", "ten", "2", "0", "45", "3"),      # a true 0 engaged
    (" ", "G9", "2024-03-02", "Talk", "A", "L1", "2", "1", "", "15", ""),           # no key
]
ASSIGNMENTS = [("E1", "P1", "", "2"), ("E1", "P1", "", "2"), ("E1", "P2", "lead", "1"), ("E2", "P1", "", "3"),
               ("E3", "P2", "", "2.5"), ("E9", "P1", "", "1"), ("E4", "P1", "", "many")]


def _csv(spark, table, rows):
    """Rows (column → text; absent columns empty) as a CSV file read with the declared schema."""
    names = [c.name for c in table.columns]
    lines = [",".join(names)] + [",".join(r.get(n, "") for n in names) for r in rows]
    path = scratch_path(spark, table.name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return read_csv(spark, path, table)


@pytest.fixture(scope="module")
def built(spark):
    event = ("event_id", "event_group_id", "event_date", "event_type", "programme_type", "location_id", "registered_count",
             "attended_count", "engaged_people_count", "session_duration_minutes", "satisfaction_score")
    bronze = {
        "events": _csv(spark, D.EVENTS, [dict(zip(event, r)) for r in EVENTS]),
        "locations": _csv(spark, D.LOCATIONS, [
            {"location_id": "L1", "region": "North", "suburb": "Hill", "venue_type": "Hall"},
            {"location_id": "L2", "region": "South", "suburb": "Bay", "venue_type": "Church Hall"}]),
        "educators": _csv(spark, D.EDUCATORS, [{"educator_id": "P1", "educator_name": "Ann"},
                                               {"educator_id": "P2", "educator_name": "Bo"}]),
        "event_educators": _csv(spark, D.ASSIGNMENTS, [
            dict(zip(("event_id", "educator_id", "educator_role", "hours_worked"), r)) for r in ASSIGNMENTS]),
    }
    silver = D.silver(bronze)
    gold = D.gold(silver)
    model = delivery_model(gold["fact"], gold["date"], gold["location"], gold["educator"], gold["bridge"])
    return bronze, silver, gold, model


def test_totals(built):
    _, _, _, model = built
    r = row(model, ["total_delivery_records", "total_event_groups", "total_people_reached", "total_registered",
                    "total_attended", "registered_event_attended", "attendance_variance", "attendance_rate",
                    "rated_delivery_records", "average_satisfaction", "total_session_hours", "locations_reached",
                    "average_people_reached_per_delivery", "educator_hours", "events_delivered_by_educator"]).collect()[0]
    assert r.asDict() == {
        "total_delivery_records": 6, "total_event_groups": 4, "total_people_reached": 42, "total_registered": 16,
        "total_attended": 25, "registered_event_attended": 15, "attendance_variance": -1, "attendance_rate": 15 / 16,
        "rated_delivery_records": 3, "average_satisfaction": 4.0, "total_session_hours": 4.0, "locations_reached": 3,
        "average_people_reached_per_delivery": 7.0, "educator_hours": 9.5, "events_delivered_by_educator": 5}
    c = questions.model_coverage(model).collect()[0]
    assert (c.fact_delivery_records, c.bridge_assignments, c.events_without_educators, c.date_rows) == (6, 6, 2, 58)


def test_groups(built):
    _, _, gold, model = built
    month = [tuple(r) for r in questions.monthly_trend(gold["fact"], gold["date"]).collect()]
    assert month == [("2024-01", 2, 1, 15), ("2024-02", 2, 2, 26), ("2024-03", 2, 2, 1)]
    region = [tuple(r) for r in questions.reach_by_region(gold["fact"], gold["location"]).collect()]
    assert region == [("North", 3, 3, 15), ("South", 2, 2, 7)]
    blank = {r.region: r.total_people_reached for r in summarize(model, ["location.region"], ["total_people_reached"]).collect()}
    assert blank == {"North": 15, "South": 7, None: 20}
    kinds = [tuple(r) for r in questions.attendance_by_type(gold["fact"]).collect()]
    assert kinds == [("Class", 1, 6, 2, 150.0), ("Talk", 3, 14, 2, 116.7)]
    venues = [tuple(r) for r in questions.venue_categories(gold["fact"], gold["location"]).collect()]
    assert venues == [("Hall", 3, 15), ("Church", 2, 7)]
    staff = [tuple(r)[:1] + tuple(r)[3:] for r in questions.educator_ranking(gold["bridge"], gold["educator"]).collect()]
    assert staff == [("P1", 4, 6.0), ("P2", 2, 3.5)]


def test_checks_name_the_defects(built):
    bronze, silver, _, _ = built
    failed = {r.check_name: r.violations for r in run_checks(
        bronze, D.bronze_checks({"events": 7, "locations": 3}), "bronze").collect() if not r.passed}
    assert failed == {"event_educators_event_id_educator_id_unique": 1, "events_location_id_fk_locations": 1,
                      "event_educators_event_id_fk_events": 1, "events_lead_educator_id_fk_educators": 1,
                      "events_covered_by_event_educators": 3, "locations_row_count": 1}
    failed = {r.check_name: r.violations for r in run_checks(silver, D.silver_checks(), "silver").collect() if not r.passed}
    assert failed == {"events_event_id_not_null": 1, "events_location_id_fk_locations": 1,
                      "events_covered_by_event_educators": 2}
    rejects = cast_rejects(bronze["events"], D.EVENTS_CLEAN).collect()[0]
    assert (rejects.registered_count, rejects.session_duration_minutes, rejects.attended_count) == (1, 1, 0)


def test_row_values(built):
    _, silver, gold, _ = built
    rows = {r.event_id: r for r in gold["fact"].collect()}
    assert len(rows) == 6 and rows["E3"].attendance_rate == 1.5 and rows["E2"].attendance_rate is None
    assert rows["E5"].people_reached == 0 and rows["E5"].registered_count is None
    roles = {(r.event_id, r.educator_id): r.educator_role for r in silver["event_educators"].collect()}
    assert roles[("E1", "P2")] == "lead" and len(roles) == 6
