"""Report datasets: the data behind each visual, parameterised by slicers.

A slicer selection is a filter context ``{"table.column": [values]}``; an
empty list selects everything. Page 1 offers month, event type and region;
page 2 offers month, event type and programme.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.display import format_measure, format_percent  # noqa: F401 (re-exported)
from strata.plans.metrics import FilterValue, Model, row, summarize

Filters = dict[str, FilterValue] | None

PAGE1_SLICERS = ("date.month_name", "fact.event_type", "location.region")
PAGE2_SLICERS = ("date.month_name", "fact.event_type", "fact.programme_type")


def kpi_overview(model: Model, filters: Filters = None) -> DataFrame:
    return row(model, ["total_delivery_records", "total_event_groups", "total_people_reached",
                       "locations_reached", "attendance_rate"], filters)


def monthly(model: Model, filters: Filters = None) -> DataFrame:
    return summarize(model, ["date.year_month"], ["total_people_reached", "total_delivery_records"], filters,
                     order_by=[("year_month", True)])


def region(model: Model, filters: Filters = None) -> DataFrame:
    return summarize(model, ["location.region"], ["total_people_reached", "total_delivery_records",
                                                  "locations_reached"], filters,
                     order_by=[("total_people_reached", False), ("region", True)])


def programme(model: Model, filters: Filters = None) -> DataFrame:
    return summarize(model, ["fact.programme_type"], ["total_people_reached"], filters,
                     order_by=[("total_people_reached", False), ("programme_type", True)])


def kpi_attendance(model: Model, filters: Filters = None) -> DataFrame:
    return row(model, ["total_registered", "registered_event_attended", "attendance_variance",
                       "attendance_rate", "average_satisfaction"], filters)


def monthly_attendance(model: Model, filters: Filters = None) -> DataFrame:
    return summarize(model, ["date.year_month"], ["total_registered", "registered_event_attended",
                                                  "attendance_rate"], filters, order_by=[("year_month", True)])


def rate_by_type(model: Model, filters: Filters = None) -> DataFrame:
    return summarize(model, ["fact.event_type"], ["attendance_rate", "total_delivery_records",
                                                  "locations_reached"], filters,
                     order_by=[("attendance_rate", False), ("event_type", True)])


def satisfaction_by_programme(model: Model, filters: Filters = None) -> DataFrame:
    # unrated programmes stay blank (and so drop out), never 0
    return summarize(model, ["fact.programme_type"], ["average_satisfaction"], filters,
                     order_by=[("average_satisfaction", False), ("programme_type", True)])


def slicer_members(model: Model, slicers=PAGE1_SLICERS + ("fact.programme_type",)) -> DataFrame:
    """Member lists of each slicer: ``(slicer, member, sort_order)``, as a slicer shows them: months
    sort by month number, other members by label (sort_order null)."""
    by_table: dict[str, list[str]] = {}
    for ref in dict.fromkeys(slicers):
        by_table.setdefault(ref.split(".")[0], []).append(ref)
    parts = []
    for table, refs in by_table.items():  # one pass per table: every row names its members
        members = [F.struct(F.lit(ref).alias("slicer"), F.col(ref.split(".")[1]).cast("string").alias("member"),
                            (F.col("month_number") if ref == "date.month_name" else F.lit(None).cast("int"))
                            .alias("sort_order")) for ref in refs]
        parts.append(model.tables[table].select(F.inline(F.array(*members))).filter(F.col("member").isNotNull()).distinct())
    return reduce(DataFrame.unionByName, parts).orderBy("slicer", F.col("sort_order").asc_nulls_first(), "member")


def formatted(df: DataFrame, model: Model, measures: list[str]) -> DataFrame:
    """Add ``<measure>_text`` columns rendered with each measure's format."""
    return df.select("*", *[format_measure(F.col(m), model.measures[m].fmt).alias(f"{m}_text") for m in measures])


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows for display (returned, not printed). With
    ``order_by`` (a unique key) the rows are deterministic."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
