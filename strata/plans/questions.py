"""Business questions over the Gold layer, written the way an analyst writes
SQL against the star schema: inner joins to dimensions, GROUP BY, ratios of
totals with zero-safe divisors. Their metric-layer twins live in
:mod:`strata.plans.report`; :func:`reconcile_region_reach` proves they agree.

All functions take the Gold tables (``fact``, ``date``, ``location``,
``educator``, ``bridge``) and return lazy DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import is_small, key_set_difference, merge_on_keys, spread
from strata.operators.reconcile import reconcile, reconcile_summary
from strata.operators.topn import top_n_with_ties
from strata.plans.metrics import Model, row, summarize


def _ordered(df: DataFrame, *order: str) -> DataFrame:
    """Sorted by ``column`` or ``-column`` (descending); nulls first ascending, last descending."""
    return df.orderBy(*[F.col(c[1:]).desc_nulls_last() if c[0] == "-" else F.col(c).asc_nulls_first() for c in order])


def by_attribute(fact: DataFrame, key: str, dim: DataFrame, dim_key: str, attributes: list[str],
                 sums: dict[str, str | None], distinct: dict[str, str] | None = None, folded: bool = False) -> DataFrame:
    """Inner join to a dimension and GROUP BY its attributes: ``sums`` (name -> fact column, None: rows)
    and ``distinct`` counts (name -> fact column).

    A dimension within the broadcast bound is joined to the rows. Otherwise the fact is
    aggregated below the join, in one branch and one read: to a row per key and distinct
    value, with partial sums, so a hot key never crosses the join's exchange as raw rows.
    ``folded``: the fact is (mostly) so already, and the second aggregate over the same keys is left
    out. The joined rows with distinct values, hardly fewer than the fact's, are dealt by group and
    value before they are counted, so a task's share does not grow with the fact."""
    distinct = distinct or {}
    add = lambda c: F.lit(1).cast("bigint") if c is None else F.col(c)
    right = dim.select(F.col(dim_key).alias("__key"), *attributes)
    if is_small(right):
        rows = fact.join(F.broadcast(right), fact[key] == right["__key"])
        return rows.groupBy(*attributes).agg(*[F.sum(add(c)).alias(n) for n, c in sums.items()],
                                             *[F.count_distinct(c).alias(n) for n, c in distinct.items()])
    values = [F.col(c).alias(f"__value{i}") for i, c in enumerate(distinct.values())]
    own = F.col(key).alias("__own")
    if folded:
        partial = fact.select(own, *values, *[add(c).alias(n) for n, c in sums.items()])
    else:
        partial = fact.groupBy(own, *values).agg(*[F.sum(add(c)).alias(n) for n, c in sums.items()])
    rows = partial.join(right, partial["__own"] == right["__key"]).drop("__own", "__key")
    if distinct:
        rows = spread(rows, [*attributes, *[f"__value{i}" for i in range(len(distinct))]])
    return (rows.groupBy(*attributes)
            .agg(*[F.sum(n).alias(n) for n in sums],
                 *[F.count_distinct(f"__value{i}").alias(n) for i, n in enumerate(distinct)]))


def totals(fact: DataFrame) -> DataFrame:
    """Deliveries, groups and people reached overall."""
    return fact.agg(
        F.count(F.lit(1)).alias("delivery_records"),
        F.count_distinct("event_group_id").alias("event_groups"),
        F.sum("people_reached").alias("total_people_reached"),
    )


def monthly_trend(fact: DataFrame, date: DataFrame) -> DataFrame:
    """Deliveries, groups and reach per calendar month, in order of the months."""
    out = by_attribute(fact, "event_date_key", date, "date_key", ["year_month"],
                       {"delivery_records": None, "people_reached": "people_reached"},
                       {"event_groups": "event_group_id"})
    return _ordered(out.select("year_month", "delivery_records", "event_groups", "people_reached"), "year_month")


def _regions(fact: DataFrame, location: DataFrame) -> DataFrame:
    return by_attribute(fact, "location_id", location, "location_id", ["region"],
                        {"delivery_records": None, "people_reached": "people_reached"},
                        {"event_groups": "event_group_id"}).select(
        "region", "delivery_records", "event_groups", "people_reached")


def reach_by_region(fact: DataFrame, location: DataFrame) -> DataFrame:
    """Regions, most people reached first."""
    return _ordered(_regions(fact, location), "-people_reached", "region")


def attendance_by_type(fact: DataFrame) -> DataFrame:
    """Registration against attendance per event type (registered deliveries), highest rate first."""
    att, reg = F.sum("attended_count"), F.sum("registered_count")
    return _ordered(fact.filter(F.col("registered_count").isNotNull()).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("registered_events"),
        att.alias("total_attended"),
        (att - reg).alias("attendance_variance"),
        F.round(F.lit(100.0) * att.cast("double") / F.nullif(reg, F.lit(0)).cast("double"), 1)
        .alias("attendance_rate_pct"),
    ), "-attendance_rate_pct", "event_type")


def reach_by_attribute(fact: DataFrame, column: str) -> DataFrame:
    """Deliveries and reach per fact attribute, most people reached first."""
    return _ordered(fact.groupBy(column).agg(
        F.count(F.lit(1)).alias("delivery_records"),
        F.sum("people_reached").alias("people_reached"),
    ), "-people_reached", column)


def venue_categories(fact: DataFrame, location: DataFrame) -> DataFrame:
    """Venue categories, the most frequent first."""
    return _ordered(by_attribute(fact, "location_id", location, "location_id", ["venue_category"],
                                 {"delivery_records": None, "people_reached": "people_reached"}),
                    "-delivery_records", "-people_reached", "venue_category")


def satisfaction_by_type(fact: DataFrame) -> DataFrame:
    """Rated deliveries and average satisfaction per event type, the best first."""
    return _ordered(fact.filter(F.col("satisfaction_score").isNotNull()).groupBy("event_type").agg(
        F.count("satisfaction_score").alias("rated_events"),
        F.round(F.avg("satisfaction_score"), 2).alias("avg_satisfaction_score"),
    ), "-avg_satisfaction_score", "event_type")


def educator_ranking(bridge: DataFrame, educator: DataFrame) -> DataFrame:
    """Staff by distinct deliveries and hours (through the bridge), the busiest first."""
    dim = educator.select("educator_id", "educator_name", "experience_level")
    out = by_attribute(bridge.select("event_id", "hours_worked", F.col("educator_id").alias("__educator")), "__educator",
                       dim, "educator_id", ["educator_id", "educator_name", "experience_level"],
                       {"total_hours": "hours_worked"}, {"events_delivered": "event_id"}, folded=True)
    return _ordered(out.select("educator_id", "educator_name", "experience_level", "events_delivered",
                               F.round("total_hours", 1).alias("total_hours")),
                    "-events_delivered", "-total_hours", "educator_id")


def outreach_regions(fact: DataFrame, location: DataFrame) -> DataFrame:
    """Regions by coverage, the lowest first."""
    return _ordered(_regions(fact, location).withColumn("avg_reach_per_delivery", F.round(
        F.col("people_reached").cast("double") / F.nullif(F.col("delivery_records"), F.lit(0)).cast("double"), 1)),
        "delivery_records", "people_reached", "region")


def staffing(fact: DataFrame, bridge: DataFrame, name_contains: str | None = None) -> DataFrame:
    """Staff count per delivery (left join to a per-event pre-aggregate, so unstaffed deliveries
    keep a null count); with ``name_contains`` only deliveries whose name holds the text, by date."""
    staff = bridge.groupBy("event_id").agg(F.count("educator_id").alias("educator_count"))
    events = fact.select("event_id", "event_name", "event_date", "event_type", "programme_type")
    if name_contains is None:
        return events.join(staff, "event_id", "left")
    found = events.filter(F.col("event_name").contains(name_contains)).join(staff, "event_id", "left")
    return _ordered(found.select("event_id", "event_date", "event_name", "educator_count"), "event_date", "event_id")


# -- metric-layer questions ---------------------------------------------------

SUBURB_MEASURES = ["total_delivery_records", "total_people_reached", "average_people_reached_per_delivery",
                   "locations_reached"]


def reach_by_suburb(model: Model) -> DataFrame:
    """Suburbs, most people reached first."""
    return summarize(model, ["location.region", "location.suburb"], SUBURB_MEASURES,
                     order_by=[("total_people_reached", False), ("region", True), ("suburb", True)])


def lowest_reach_suburbs(model: Model, n: int = 10) -> DataFrame:
    """The n lowest-reach suburbs, the lowest first; ties at the cut are all kept."""
    order = [("total_people_reached", True), ("total_delivery_records", True), ("suburb", True)]
    found = top_n_with_ties(summarize(model, ["location.region", "location.suburb"], SUBURB_MEASURES), n, order)
    return _ordered(found, *[c for c, _ in order], "region")


def venue_detail(model: Model) -> DataFrame:
    return summarize(model, ["location.venue_category", "location.venue_type"],
                     ["total_delivery_records", "total_people_reached"],
                     order_by=[("venue_category", True), ("total_delivery_records", False), ("venue_type", True)])


def time_and_outreach(model: Model) -> DataFrame:
    return row(model, ["total_session_hours", "average_people_reached_per_delivery", "locations_reached"])


def model_coverage(model: Model) -> DataFrame:
    """One row of coverage counters across fact, dimensions and bridge,
    plus the number of deliveries nobody is assigned to (``EXCEPT``)."""
    t = model.tables
    fact, bridge = t["fact"], t["bridge"]

    def blank_distinct(df: DataFrame, c: str):
        return F.count_distinct(c) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))

    parts = [
        fact.agg(
            F.count(F.lit(1)).alias("fact_delivery_records"),
            blank_distinct(fact, "event_id").cast("bigint").alias("distinct_event_ids"),
            blank_distinct(fact, "event_group_id").cast("bigint").alias("distinct_event_groups"),
        ),
        t["date"].agg(F.count(F.lit(1)).alias("date_rows")),
        t["location"].agg(F.count(F.lit(1)).alias("location_rows")),
        t["educator"].agg(F.count(F.lit(1)).alias("educator_rows")),
        bridge.agg(F.count(F.lit(1)).alias("bridge_assignments"),
                   blank_distinct(bridge, "event_id").cast("bigint").alias("distinct_staffed_event_ids")),
        key_set_difference(fact, ["event_id"], bridge, ["event_id"]).agg(
            F.count(F.lit(1)).alias("events_without_educators")),
    ]
    return merge_on_keys(parts, [])


def reconcile_region_reach(fact: DataFrame, location: DataFrame, model: Model) -> DataFrame:
    """Hand-written question vs metric layer for reach by region: one summary row."""
    sql_side = _regions(fact, location)
    metric_side = summarize(model, ["location.region"],
                            ["total_delivery_records", "total_event_groups", "total_people_reached"],
                            filters={"location.region": lambda c: c.isNotNull()})
    metric_side = metric_side.select(
        "region",
        F.col("total_delivery_records").alias("delivery_records"),
        F.col("total_event_groups").alias("event_groups"),
        F.col("total_people_reached").alias("people_reached"),
    )
    cmp = reconcile(sql_side, metric_side, ["region"], ["delivery_records", "event_groups", "people_reached"])
    return reconcile_summary(cmp)
