"""The delivery model: a fact of delivered events, date / location / staff
dimensions, a many-to-many staffing bridge, and its measure catalogue.

Column names are the model's vocabulary; any source (raw CSV files, or the
TPC-H-shaped stand-in in :mod:`strata.plans.standin`) is first shaped into
the Silver columns below, then the same Gold builders and measures apply.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.calendar import date_key
from strata.functions.clean import group_values
from strata.plans.metrics import Measure, Model, Relationship
from strata.plans.star import dimension, fact
from strata.sources.manifest import published, published_buckets

# The columns that the model's relationships, measures and questions use.
FACT_COLUMNS = (
    "event_id", "event_group_id", "event_name", "event_type", "programme_type", "delivery_language",
    "event_date", "event_date_key", "location_id", "lead_educator_id",
    "registration_required", "registered_count", "attended_count", "engaged_people_count", "people_reached",
    "attendance_variance", "attendance_rate", "session_duration_minutes", "session_duration_hours",
    "satisfaction_score", "delivery_count",
)

# Hidden from report users: row-level rate must not be averaged; keys.
HIDDEN = {
    "fact": ("attendance_rate", "event_date_key", "location_id", "lead_educator_id"),
    "bridge": ("event_id", "educator_id"),
}


def gold_fact(silver_events: DataFrame, extra: tuple[str, ...] = (), optional: tuple[str, ...] = ()) -> DataFrame:
    """The fact: ``FACT_COLUMNS`` and the domain's own ``extra`` columns; a source must have
    them all but those in ``optional``."""
    reg, att = F.col("registered_count"), F.col("attended_count")
    derived = {
        "event_date_key": date_key("event_date"),
        # first non-null of engaged, attended, then 0 (a true 0 stays 0)
        "people_reached": F.coalesce(F.col("engaged_people_count"), att, F.lit(0)),
        "delivery_count": F.lit(1),
        "attendance_variance": F.when(reg.isNotNull() & att.isNotNull(), att - reg),
        # may exceed 1: more people attended than registered
        "attendance_rate": F.when(reg.isNotNull() & (reg > 0) & att.isNotNull(), F.round(att / reg, 4)),
        "session_duration_hours": F.round(F.col("session_duration_minutes") / F.lit(60.0), 2),
    }
    return fact(silver_events, derived, (*FACT_COLUMNS, *extra), optional)


def gold_dim_location(silver_locations: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    cols = [c for c in silver_locations.columns if c not in ("ingestion_timestamp", "source_file",
                                                              "silver_processed_timestamp")]
    at = cols.index("venue_type") + 1
    projected = [F.col(c) for c in cols[:at]] + [group_values("venue_type", categories).alias("venue_category")] + [
        F.col(c) for c in cols[at:]]
    return dimension(silver_locations, "location_id", projected)


def gold_dim_educator(silver_educators: DataFrame) -> DataFrame:
    cols = [c for c in silver_educators.columns if c not in ("ingestion_timestamp", "source_file",
                                                             "silver_processed_timestamp")]
    return dimension(silver_educators, "educator_id", cols)


def gold_bridge(silver_assignments: DataFrame, dedup: bool = True) -> DataFrame:
    """Event ↔ staff assignments, one row per (event_id, educator_id).
    ``dedup=False`` when the source is already unique on that key (e.g. it
    is itself a GROUP BY on it), which saves a sort-based aggregate."""
    cols = [c for c in silver_assignments.columns if c not in ("ingestion_timestamp", "source_file",
                                                               "silver_processed_timestamp")]
    return dimension(silver_assignments, ["event_id", "educator_id"], cols, dedup=dedup)


RELATIONSHIPS = [
    Relationship("fact", "event_date_key", "date", "date_key"),
    Relationship("fact", "location_id", "location", "location_id"),
    Relationship("bridge", "event_id", "fact", "event_id"),
    Relationship("bridge", "educator_id", "educator", "educator_id"),
]


def delivery_measures() -> list[Measure]:
    return [
        Measure("total_delivery_records", "sum", "fact", "delivery_count", fmt="0", folder="Delivery"),
        Measure("total_event_groups", "distinct", "fact", "event_group_id", fmt="0", folder="Delivery"),
        Measure("total_people_reached", "sum", "fact", "people_reached", fmt="#,0", folder="Reach"),
        Measure("total_registered", "sum", "fact", "registered_count", fmt="0", folder="Attendance"),
        Measure("total_attended", "sum", "fact", "attended_count", fmt="0", folder="Attendance"),
        Measure("registered_event_attended", "sum", "fact", "attended_count",
                where=("registered_count", "nonblank"), fmt="0", folder="Attendance",
                description="attendance of deliveries that had registrations (same population as the rate)"),
        Measure("attendance_variance", "sub", inputs=("registered_event_attended", "total_registered"),
                fmt="0", folder="Attendance"),
        Measure("attendance_rate", "div", inputs=("registered_event_attended", "total_registered"),
                fmt="0.0%", folder="Attendance", description="ratio of totals, not a mean of row rates"),
        Measure("average_satisfaction", "avg", "fact", "satisfaction_score", fmt="0.00", folder="Satisfaction"),
        Measure("rated_delivery_records", "sum", "fact", "delivery_count",
                where=("satisfaction_score", "nonblank"), fmt="0", folder="Satisfaction"),
        Measure("total_session_hours", "sum", "fact", "session_duration_hours", fmt="0.0", folder="Time"),
        Measure("average_people_reached_per_delivery", "div",
                inputs=("total_people_reached", "total_delivery_records"), fmt="0.0", folder="Reach"),
        Measure("locations_reached", "distinct", "fact", "location_id", fmt="0", folder="Reach"),
        Measure("events_delivered_by_educator", "distinct", "bridge", "event_id", fmt="0", folder="Educators"),
        Measure("educator_hours", "sum", "bridge", "hours_worked", fmt="0.0", folder="Educators"),
    ]


def delivery_model(
    fact_df: DataFrame,
    date_df: DataFrame,
    location_df: DataFrame,
    educator_df: DataFrame,
    bridge_df: DataFrame,
) -> Model:
    model = Model(
        tables={"fact": fact_df, "date": date_df, "location": location_df, "educator": educator_df,
                "bridge": bridge_df},
        relationships=list(RELATIONSHIPS),
        measures={},
        hidden=dict(HIDDEN),
        grains={"bridge": ("event_id", "educator_id")},  # as gold_bridge gives it
    )
    return model.add_measures(delivery_measures())


def published_model(spark: SparkSession, root: str, layer: str = "gold", number: int | None = None) -> Model:
    """The model bound to a published version of the Gold layer, as it is stored: relationships
    between tables in the same buckets by their join columns are joined where they lie."""
    tables = published(spark, root, layer, number)
    stored = published_buckets(spark, root, layer, number)
    model = delivery_model(*[tables[t] for t in ("fact", "date", "location", "educator", "bridge")])
    together = {(r.from_table, r.to_table) for r in model.relationships
                if r.from_table in stored and r.to_table in stored and stored[r.from_table][0] == stored[r.to_table][0]
                and stored[r.from_table][1] == [r.from_col] and stored[r.to_table][1] == [r.to_col]}
    return replace(model, colocated=frozenset(together))
