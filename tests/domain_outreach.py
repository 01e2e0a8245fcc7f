"""Test domain: community outreach deliveries in four CSV files that the tests write.

Declared source schemas, cleaning specs and checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.functions.clean import CleanSpec, clean
from strata.operators import quality as Q
from strata.operators.dedup import dedup_by_key
from strata.plans import delivery
from strata.plans.layers import Layer
from strata.plans.star import date_table
from strata.sources.schema import spec

# The four source files' columns, in file order, with the type
# each column has once cleaned.
EVENTS = spec(
    "events",
    "event_id string, event_group_id string, event_name string, event_date date, event_type string, "
    "programme_type string, location_id string, lead_educator_id string, delivery_language string, "
    "audience_type string, delivery_format string, demonstration_type string, registration_required boolean, "
    "registered_count int, attended_count int, engaged_people_count int, engaged_boats_count int, "
    "session_duration_minutes int, satisfaction_score double, engagement_level string, challenge_category string, "
    "improvement_category string, weather_condition string, data_source string, is_estimated boolean, "
    "event_status string",
    key=["event_id"],
)
LOCATIONS = spec(
    "locations",
    "location_id string, venue_name string, suburb string, region string, venue_type string, "
    "indoor_outdoor string, water_access string",
    key=["location_id"],
)
EDUCATORS = spec(
    "educators",
    "educator_id string, educator_name string, primary_language string, secondary_language string, "
    "experience_level string, active_status boolean",
    key=["educator_id"],
)
ASSIGNMENTS = spec(
    "event_educators",
    "event_id string, educator_id string, educator_role string, hours_worked double, is_estimated boolean",
    key=["event_id", "educator_id"],
)

# Fixed values of the fixture domain.
LANGUAGE_STANDARD = {"English/Te Reo Maori": "English/Te Reo Māori"}
SECONDARY_LANGUAGE_STANDARD = {"Te Reo Maori": "Te Reo Māori"}
VENUE_CATEGORIES = {"Church": ["Church", "Church Hall"]}

EVENTS_CLEAN = CleanSpec.from_table(EVENTS, value_maps={"delivery_language": LANGUAGE_STANDARD})
LOCATIONS_CLEAN = CleanSpec.from_table(LOCATIONS)
EDUCATORS_CLEAN = CleanSpec.from_table(EDUCATORS, value_maps={"secondary_language": SECONDARY_LANGUAGE_STANDARD})
# the bridge keys and role are trimmed only: an empty role stays ''
ASSIGNMENTS_CLEAN = CleanSpec.from_table(ASSIGNMENTS, trim_only=("event_id", "educator_id", "educator_role"))

METADATA = ["ingestion_timestamp", "source_file"]


def _silver(df: DataFrame, spec_, table) -> DataFrame:
    cleaned = clean(df.drop(*[c for c in METADATA if c in df.columns]), spec_)
    return dedup_by_key(cleaned, list(table.key))


def silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "events": _silver(bronze["events"], EVENTS_CLEAN, EVENTS),
        "locations": _silver(bronze["locations"], LOCATIONS_CLEAN, LOCATIONS),
        "educators": _silver(bronze["educators"], EDUCATORS_CLEAN, EDUCATORS),
        "event_educators": _silver(bronze["event_educators"], ASSIGNMENTS_CLEAN, ASSIGNMENTS),
    }


def gold(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    fact = delivery.gold_fact(s["events"])
    return {
        "fact": fact,
        "date": date_table(fact, "event_date"),
        "location": delivery.gold_dim_location(s["locations"], VENUE_CATEGORIES),
        "educator": delivery.gold_dim_educator(s["educators"]),
        "bridge": delivery.gold_bridge(s["event_educators"]),
    }


def bronze_checks(expected: dict[str, int] | None = None) -> list[Q.Check]:
    checks = [
        Q.unique("events", "event_id"),
        Q.unique("locations", "location_id"),
        Q.unique("educators", "educator_id"),
        Q.unique("event_educators", "event_id", "educator_id"),
        Q.foreign_key("events", ["location_id"], "locations"),
        Q.foreign_key("events", ["lead_educator_id"], "educators", ["educator_id"]),
        Q.foreign_key("event_educators", ["event_id"], "events"),
        Q.foreign_key("event_educators", ["educator_id"], "educators"),
        Q.coverage("events", ["event_id"], "event_educators"),
    ]
    for table, n in (expected or {}).items():
        checks.append(Q.row_count(table, n))
    return checks


def silver_checks() -> list[Q.Check]:
    return [
        Q.not_null("events", "event_id"),
        Q.not_null("locations", "location_id"),
        Q.not_null("educators", "educator_id"),
        Q.foreign_key("events", ["location_id"], "locations"),
        Q.foreign_key("event_educators", ["educator_id"], "educators"),
        Q.coverage("events", ["event_id"], "event_educators"),
        Q.in_range("events", "satisfaction_score", 1, 5),
    ]


def gold_checks() -> list[Q.Check]:
    return [
        Q.unique("fact", "event_id"),
        Q.foreign_key("fact", ["location_id"], "location"),
        Q.foreign_key("bridge", ["event_id"], "fact"),
        Q.foreign_key("bridge", ["educator_id"], "educator"),
        Q.coverage("fact", ["event_id"], "bridge"),
    ]


def layers() -> list[Layer]:
    return [Layer("silver", silver, silver_checks()), Layer("gold", gold, gold_checks())]
