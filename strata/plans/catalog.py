"""Registered queries over the stand-in tables: one per operator family.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables. The matching DuckDB oracle SQL is in :mod:`strata.plans.oracle`.
Computed columns carry explicit names; doubles that are sums of fractional
values are rounded to 6 decimals so two engines' summation orders agree.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.clean import CleanSpec, cast_rejects, clean
from strata.operators import quality as Q
from strata.operators.dedup import duplicate_keys
from strata.operators.joins import checked_broadcast, key_set_difference, orphan_keys, orphan_rows, uncovered_parents
from strata.operators.quality import run_checks, total_violations
from strata.plans import questions, report, sql_questions, standin
from strata.plans.delivery import delivery_model
from strata.plans.layers import check_report, run_layers
from strata.plans.metrics import NOT_BLANK, Measure, Model, row, summarize
from strata.session import scratch_path
from strata.sources.catalog import register_tables, session_views
from strata.sources.ingest import read_csv, read_parquet
from strata.sources.schema import spec
from strata.sources.sinks import read_layer, row_counts, stage_tables, write_layer

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}

# Fixed slicer selections used by the filter-context queries.
MONTHS = ["March", "April", "May"]
EVENT_TYPES = ["1-URGENT", "2-HIGH", "Unspecified"]
REGIONS = ["AMERICA", "ASIA", "EUROPE"]
PROGRAMMES = ["F", "O"]
PAGE1 = {"date.month_name": MONTHS, "fact.event_type": EVENT_TYPES, "location.region": REGIONS}
PAGE2 = {"date.month_name": MONTHS, "fact.event_type": EVENT_TYPES, "fact.programme_type": PROGRAMMES}

DIRTY_TEXT = CleanSpec(blank_to_null=("order_id", "status", "priority"),
                       value_maps={"priority": standin.PRIORITY_STANDARD})
DIRTY_TRIM = CleanSpec(trim_only=("order_id", "status", "priority"))
DIRTY_TYPED = CleanSpec(blank_to_null=("status", "priority"), value_maps={"priority": standin.PRIORITY_STANDARD},
                        casts={"order_id": "bigint", "customer_id": "int", "order_date": "date",
                               "is_final": "boolean"})


def query(name: str) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return register


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _gold(spark: SparkSession, sf_dir: str) -> standin.Gold:
    return standin.gold(spark, sf_dir)


# -- step 1: cleaning, typing, ingest, projections, filters -------------------

@query("dedup_by_key")
def dedup_by_key(spark, sf_dir):
    return standin.silver_lineitem(_table(spark, sf_dir, "lineitem"))


def _dirty(spark, sf_dir):
    return standin.dirty_orders(_table(spark, sf_dir, "orders"))


@query("clean_text")
def clean_text(spark, sf_dir):
    return clean(_dirty(spark, sf_dir), DIRTY_TEXT).select("source_key", "order_id", "status", "priority")


@query("clean_trim_only")
def clean_trim_only(spark, sf_dir):
    return clean(_dirty(spark, sf_dir), DIRTY_TRIM).select("source_key", "order_id", "status", "priority")


@query("typed_cast")
def typed_cast(spark, sf_dir):
    return clean(_dirty(spark, sf_dir), DIRTY_TYPED).select(
        "source_key", "order_id", "customer_id", "order_date", "is_final", "status", "priority")


CUSTOMER_CSV = spec("customer", "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                                "c_mktsegment string", key=["c_custkey"])


@query("csv_ingest_roundtrip")
def csv_ingest_roundtrip(spark, sf_dir):
    """Write ``customer`` as headered CSV to the shared scratch folder, read
    it back against the declared all-text schema, clean and type it."""
    path = scratch_path(spark, "csv-ingest")
    customer = _table(spark, sf_dir, "customer")
    customer.select(*[F.col(c).cast("string") for c in CUSTOMER_CSV.column_names]) \
        .write.option("header", True).csv(path)
    raw = read_csv(spark, path, CUSTOMER_CSV)
    typed = clean(raw, CleanSpec.from_table(CUSTOMER_CSV))
    return typed.select(*CUSTOMER_CSV.column_names, F.col("source_file").isNotNull().alias("has_source_file"),
                        F.col("ingestion_timestamp").isNotNull().alias("has_ingestion_timestamp"))


@query("constant_and_alias")
def constant_and_alias(spark, sf_dir):
    c = _table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("location_id"), F.col("c_name").alias("venue_name"),
                    F.lit(1).alias("delivery_count"), F.lit("Customer").alias("entity_kind"))


@query("filter_contains")
def filter_contains(spark, sf_dir):
    p = _table(spark, sf_dir, "part")
    return p.filter(F.col("p_name").contains("gear")).select("p_partkey", "p_name", "p_brand")


@query("filter_isin")
def filter_isin(spark, sf_dir):
    return _gold(spark, sf_dir).location.filter(F.col("venue_type").isin("HOUSEHOLD", "FURNITURE"))


@query("filter_null")
def filter_null(spark, sf_dir):
    return _gold(spark, sf_dir).fact.filter(F.col("registered_count").isNull()).select(
        "event_id", "event_type", "attended_count")


@query("filter_out_of_range")
def filter_out_of_range(spark, sf_dir):
    f = _gold(spark, sf_dir).fact
    rate = F.col("attendance_rate")
    return f.filter(rate.isNotNull() & ~rate.between(0, 1)).select("event_id", "attendance_rate")


# -- step 2: star schema ------------------------------------------------------

@query("dim_location")
def dim_location(spark, sf_dir):
    return _gold(spark, sf_dir).location


@query("dim_educator")
def dim_educator(spark, sf_dir):
    return _gold(spark, sf_dir).educator


@query("dim_date")
def dim_date(spark, sf_dir):
    return _gold(spark, sf_dir).date


@query("bridge_event_educator")
def bridge_event_educator(spark, sf_dir):
    return _gold(spark, sf_dir).bridge


@query("fact_event_delivery")
def fact_event_delivery(spark, sf_dir):
    return _gold(spark, sf_dir).fact


# -- step 3: data quality -----------------------------------------------------

def _stored_gold(spark, sf_dir) -> standin.Gold:
    """Silver and then Gold, each table computed once and stored in the shared scratch folder: what
    reads them afterwards scans stored tables, and each raw file was scanned once."""
    raw = standin.load(spark, sf_dir)
    silver = stage_tables(spark, standin.silver_tables(raw), scratch_path(spark, "silver"))
    gold = stage_tables(spark, standin.gold_tables(silver), scratch_path(spark, "gold"))
    return standin.Gold(raw, silver["lineitem"], silver["orders"], **gold)


@query("dq_row_counts")
def dq_row_counts(spark, sf_dir):
    g = _stored_gold(spark, sf_dir)
    counts = row_counts({
        "bronze_lineitem": g.raw["lineitem"], "silver_lineitem": g.lines,
        "bronze_orders": g.raw["orders"], "silver_orders": g.orders,
        "gold_fact_event_delivery": g.fact, "gold_dim_date": g.date, "gold_dim_location": g.location,
        "gold_dim_educator": g.educator, "gold_bridge_event_educator": g.bridge,
    })
    # a distinct projection counts null as a value
    langs = g.fact.select("delivery_language").distinct().agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("gold_fact_event_delivery.delivery_language_members").alias("table_name"), "row_count")
    return counts.unionByName(langs)


@query("dq_duplicate_keys")
def dq_duplicate_keys(spark, sf_dir):
    return duplicate_keys(clean(_dirty(spark, sf_dir), DIRTY_TEXT), ["order_id"])


@query("dq_duplicate_composite")
def dq_duplicate_composite(spark, sf_dir):
    return duplicate_keys(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_null_keys")
def dq_null_keys(spark, sf_dir):
    typed = clean(_dirty(spark, sf_dir), DIRTY_TYPED)
    fact = _gold(spark, sf_dir).fact
    return run_checks({"orders_typed": typed, "fact": fact}, [
        Q.not_null("orders_typed", "order_id"),
        Q.not_null("orders_typed", "customer_id"),
        Q.not_null("orders_typed", "is_final"),
        Q.not_null("fact", "event_id"),
    ], layer="silver")


def _shifted(spark, sf_dir):
    li = standin.shifted(_table(spark, sf_dir, "lineitem"), "l_suppkey", 5)
    orders = standin.shifted(_table(spark, sf_dir, "orders"), "o_custkey", 7)
    return li, orders


@query("dq_orphans_distinct")
def dq_orphans_distinct(spark, sf_dir):
    li, _ = _shifted(spark, sf_dir)
    return orphan_keys(li, ["l_suppkey"], _table(spark, sf_dir, "supplier"), ["s_suppkey"])


@query("dq_orphans_rows")
def dq_orphans_rows(spark, sf_dir):
    li, _ = _shifted(spark, sf_dir)
    return orphan_rows(li, ["l_suppkey"], _table(spark, sf_dir, "supplier"), ["s_suppkey"])


@query("dq_orphans_renamed")
def dq_orphans_renamed(spark, sf_dir):
    _, orders = _shifted(spark, sf_dir)
    customer = _table(spark, sf_dir, "customer")
    return orphan_keys(orders, ["o_custkey"], customer.select(F.col("c_custkey").alias("o_custkey")))


@query("dq_orphans_expr")
def dq_orphans_expr(spark, sf_dir):
    g = _gold(spark, sf_dir)
    events = standin.shifted(g.fact, "lead_educator_id", 3).select("event_id", "lead_educator_id")
    # the keys are compared once each; rows without a key are orphans without any join
    keys = events.filter(F.col("lead_educator_id").isNotNull()).select("lead_educator_id").distinct().alias("event")
    lost = keys.join(g.educator.alias("educator"), F.col("event.lead_educator_id") == F.col("educator.educator_id"),
                     "left_anti")
    return events.filter(F.col("lead_educator_id").isNull()).unionByName(
        events.join(checked_broadcast(lost), "lead_educator_id", "left_semi").select("event_id", "lead_educator_id"))


@query("dq_uncovered_parents")
def dq_uncovered_parents(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return uncovered_parents(g.fact, ["event_id"], g.bridge)


@query("dq_uncovered_except")
def dq_uncovered_except(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return key_set_difference(g.fact, ["event_id"], g.bridge, ["event_id"])


@query("dq_out_of_range")
def dq_out_of_range(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return run_checks({"fact": g.fact}, [
        Q.in_range("fact", "satisfaction_score", 1, 5),
        Q.in_range("fact", "attendance_rate", 0, 1, severity="warning"),
    ], layer="gold")


def _fk_checks(spark, sf_dir):
    li, orders = _shifted(spark, sf_dir)
    g = _gold(spark, sf_dir)
    tables = {"lineitem": li, "orders": orders, "supplier": _table(spark, sf_dir, "supplier"),
              "customer": _table(spark, sf_dir, "customer"),
              "fact": standin.shifted(g.fact, "lead_educator_id", 3), "educator": g.educator}
    checks = [
        Q.foreign_key("lineitem", ["l_suppkey"], "supplier", ["s_suppkey"]),
        Q.foreign_key("lineitem", ["l_suppkey"], "supplier", ["s_suppkey"], rows=True),
        Q.foreign_key("orders", ["o_custkey"], "customer", ["c_custkey"]),
        Q.foreign_key("fact", ["lead_educator_id"], "educator", ["educator_id"]),
    ]
    return run_checks(tables, checks, layer="bronze")


@query("dq_fk_total")
def dq_fk_total(spark, sf_dir):
    return total_violations(_fk_checks(spark, sf_dir))


@query("dq_summary")
def dq_summary(spark, sf_dir):
    """Checks of the stored Gold tables."""
    g = _stored_gold(spark, sf_dir)
    tables = {"fact": g.fact, "bridge": g.bridge, "location": g.location, "educator": g.educator, "date": g.date}
    return run_checks(tables, standin.gold_checks(), layer="gold")


def _expected_checks(spark, sf_dir) -> DataFrame:
    """A right expectation (one fact row per order) and a wrong one (one group per order)."""
    orders = _table(spark, sf_dir, "orders").agg(F.count_distinct("o_orderkey")).first()[0]
    return run_checks({"fact": _gold(spark, sf_dir).fact}, standin.expected_checks(orders, orders), layer="gold")


@query("dq_expected_counts")
def dq_expected_counts(spark, sf_dir):
    return _expected_checks(spark, sf_dir)


@query("dq_gate_failures")
def dq_gate_failures(spark, sf_dir):
    """What a gate that stops a layer reports: one row per failed check."""
    try:
        Q.gate(_expected_checks(spark, sf_dir))
        failed = []
    except Q.QualityGateError as e:
        failed = [(r["check_name"], r["observed"], r["expected"]) for r in e.failed]
    return spark.createDataFrame(failed, "check_name string, observed long, expected long")


@query("cast_rejects")
def cast_rejects_query(spark, sf_dir):
    """Texts that are not blank and do not convert, per cast column."""
    return cast_rejects(_dirty(spark, sf_dir), DIRTY_TYPED).select("customer_id", "is_final")


@query("staffing_drilldown")
def staffing_drilldown(spark, sf_dir):
    """Deliveries whose name holds a text, by date, with their staff count."""
    g = _gold(spark, sf_dir)
    return questions.staffing(g.fact, g.bridge, "77")


@query("fact_preview")
def fact_preview(spark, sf_dir):
    """The first rows of the fact in a total order (a top-20 report)."""
    fact = _gold(spark, sf_dir).fact.select("event_id", "event_date", "people_reached")
    return report.preview(fact, 20, ["event_date", "event_id"])


@query("audited_educators")
def audited_educators(spark, sf_dir):
    """A stored dimension with the sink's audit timestamp, compared as not null."""
    root = scratch_path(spark, "audited")
    paths = write_layer(spark, {"educator": _gold(spark, sf_dir).educator}, root, "gold", audit_column="processed_at")
    return read_layer(spark, paths)["educator"].select("educator_id", "educator_name",
                                                       F.col("processed_at").isNotNull().alias("audited"))


@query("staffing_summary")
def staffing_summary(spark, sf_dir):
    """Staff count per delivery; unstaffed deliveries kept with a null count."""
    g = _gold(spark, sf_dir)
    return questions.staffing(g.fact, g.bridge)


# -- step 4: business questions ------------------------------------------------

@query("bq_totals")
def bq_totals(spark, sf_dir):
    return questions.totals(_gold(spark, sf_dir).fact)


@query("bq_monthly_trend")
def bq_monthly_trend(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return questions.monthly_trend(g.fact, g.date)


@query("bq_reach_by_region")
def bq_reach_by_region(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return questions.reach_by_region(g.fact, g.location)


@query("bq_reach_by_suburb")
def bq_reach_by_suburb(spark, sf_dir):
    return questions.reach_by_suburb(_gold(spark, sf_dir).model())


@query("bq_attendance_by_type")
def bq_attendance_by_type(spark, sf_dir):
    return questions.attendance_by_type(_gold(spark, sf_dir).fact)


@query("bq_reach_by_programme")
def bq_reach_by_programme(spark, sf_dir):
    return questions.reach_by_attribute(_gold(spark, sf_dir).fact, "programme_type")


@query("bq_reach_by_language")
def bq_reach_by_language(spark, sf_dir):
    return questions.reach_by_attribute(_gold(spark, sf_dir).fact, "delivery_language")


@query("bq_venue_category")
def bq_venue_category(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return questions.venue_categories(g.fact, g.location)


@query("bq_venue_detail")
def bq_venue_detail(spark, sf_dir):
    return questions.venue_detail(_gold(spark, sf_dir).model())


@query("bq_satisfaction_by_type")
def bq_satisfaction_by_type(spark, sf_dir):
    return questions.satisfaction_by_type(_gold(spark, sf_dir).fact)


@query("bq_educator_ranking")
def bq_educator_ranking(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return questions.educator_ranking(g.bridge, g.educator)


@query("bq_outreach_regions")
def bq_outreach_regions(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return questions.outreach_regions(g.fact, g.location)


@query("bq_outreach_suburbs_top10")
def bq_outreach_suburbs_top10(spark, sf_dir):
    return questions.lowest_reach_suburbs(_gold(spark, sf_dir).model(), 10)


@query("bq_time_outreach")
def bq_time_outreach(spark, sf_dir):
    return _r6(questions.time_and_outreach(_gold(spark, sf_dir).model()), "total_session_hours")


@query("bq_model_coverage")
def bq_model_coverage(spark, sf_dir):
    return questions.model_coverage(_stored_gold(spark, sf_dir).model())


# -- step 5: metric layer semantics -------------------------------------------

FACT_MEASURES = ["total_delivery_records", "total_event_groups", "total_people_reached", "total_registered",
                 "total_attended", "registered_event_attended", "attendance_variance", "attendance_rate",
                 "average_satisfaction", "rated_delivery_records", "total_session_hours",
                 "average_people_reached_per_delivery", "locations_reached"]


@query("mx_all_by_event_type")
def mx_all_by_event_type(spark, sf_dir):
    df = summarize(_gold(spark, sf_dir).model(), ["fact.event_type"], FACT_MEASURES)
    return _r6(df, "average_satisfaction", "total_session_hours")


@query("mx_educator")
def mx_educator(spark, sf_dir):
    return summarize(_gold(spark, sf_dir).model(), ["educator.educator_name"],
                     ["events_delivered_by_educator", "educator_hours"],
                     order_by=[("events_delivered_by_educator", False), ("educator_name", True)])


@query("mx_filtered_context")
def mx_filtered_context(spark, sf_dir):
    return summarize(_gold(spark, sf_dir).model(), ["date.year_month"],
                     ["total_delivery_records", "total_people_reached", "attendance_rate"], PAGE1)


@query("mx_filter_propagation")
def mx_filter_propagation(spark, sf_dir):
    """A location filter reaches the bridge through the fact (one→many)."""
    return summarize(_gold(spark, sf_dir).model(), ["educator.experience_level"],
                     ["events_delivered_by_educator", "educator_hours"], {"location.region": ["ASIA"]})


@query("mx_filter_direction")
def mx_filter_direction(spark, sf_dir):
    """An educator filter narrows bridge measures but never the fact's."""
    return row(_gold(spark, sf_dir).model(), ["total_delivery_records", "total_people_reached",
                                              "events_delivered_by_educator", "educator_hours"],
               {"educator.experience_level": ["Senior"]})


@query("mx_blank_member")
def mx_blank_member(spark, sf_dir):
    """Fact keys without a location fall into one blank region."""
    g = _gold(spark, sf_dir)
    model = delivery_model(standin.shifted(g.fact, "location_id", 7), g.date, g.location, g.educator, g.bridge)
    return summarize(model, ["location.region"], ["total_delivery_records", "total_people_reached",
                                                  "locations_reached"])


@query("mx_drop_blank_groups")
def mx_drop_blank_groups(spark, sf_dir):
    df = summarize(_gold(spark, sf_dir).model(), ["fact.programme_type", "fact.delivery_language"],
                   ["average_satisfaction", "rated_delivery_records"])
    return _r6(df, "average_satisfaction")


def _fact_with_blank_groups(g: standin.Gold) -> DataFrame:
    return g.fact.withColumn("event_group_id", F.when(F.col("delivery_language").isNotNull(),
                                                      F.col("event_group_id")))


@query("mx_distinct_with_blank")
def mx_distinct_with_blank(spark, sf_dir):
    g = _gold(spark, sf_dir)
    model = delivery_model(_fact_with_blank_groups(g), g.date, g.location, g.educator, g.bridge)
    return summarize(model, ["fact.programme_type"], ["total_event_groups", "total_delivery_records"])


@query("mx_blank_arithmetic")
def mx_blank_arithmetic(spark, sf_dir):
    return summarize(_gold(spark, sf_dir).model(), ["fact.event_type", "fact.delivery_language"],
                     ["registered_event_attended", "total_registered", "attendance_variance", "attendance_rate"])


@query("mx_month_name_sorted")
def mx_month_name_sorted(spark, sf_dir):
    return summarize(_gold(spark, sf_dir).model(), ["date.month_number", "date.month_name"],
                     ["total_delivery_records", "total_people_reached"], order_by=[("month_number", True)])


@query("mx_calculate_override")
def mx_calculate_override(spark, sf_dir):
    """A context filter on registered_count is replaced inside the measure
    that filters that column itself, and kept for the others."""
    return row(_gold(spark, sf_dir).model(), ["total_attended", "registered_event_attended", "total_registered"],
               {"fact.registered_count": lambda c: c > 100})


@query("mx_display_formats")
def mx_display_formats(spark, sf_dir):
    model = _gold(spark, sf_dir).model()
    ms = ["total_delivery_records", "total_people_reached", "attendance_rate", "average_satisfaction",
          "total_session_hours"]
    return report.formatted(row(model, ms), model, ms).select(*[f"{m}_text" for m in ms])


def events_model(events: DataFrame) -> Model:
    """A second fact family without relationships: the event stream."""
    t = events.select("event_id", "user_id", "event_type", "value",
                      F.date_format("ts", "yyyy-MM").alias("year_month"))
    return Model({"events": t}, [], {}).add_measures([
        Measure("event_count", "count_rows", "events"),
        Measure("total_value", "sum", "events", "value"),
        Measure("distinct_users", "distinct", "events", "user_id"),
        Measure("average_value", "avg", "events", "value"),
    ])


@query("mx_events_monthly")
def mx_events_monthly(spark, sf_dir):
    df = summarize(events_model(_table(spark, sf_dir, "events")),
                   ["events.year_month", "events.event_type"],
                   ["event_count", "total_value", "distinct_users", "average_value"])
    return _r6(df, "total_value", "average_value")


# -- the model's own validation queries (KPI rows and grouped summaries) ------------

AVG_REACH = "average_people_reached_per_delivery"


def _rate_text(df: DataFrame) -> DataFrame:
    return df.withColumn("attendance_rate", report.format_percent(F.col("attendance_rate")))


@query("mx_core_kpis")
def mx_core_kpis(spark, sf_dir):
    return row(_gold(spark, sf_dir).model(), ["total_delivery_records", "total_event_groups", "total_people_reached",
                                              "total_registered", "total_attended"])


@query("mx_attendance_kpis")
def mx_attendance_kpis(spark, sf_dir):
    df = row(_gold(spark, sf_dir).model(), ["total_registered", "registered_event_attended", "attendance_variance",
                                            "attendance_rate"])
    return df.withColumn("attendance_rate_text", report.format_percent(F.col("attendance_rate")))


@query("mx_satisfaction_kpis")
def mx_satisfaction_kpis(spark, sf_dir):
    df = row(_gold(spark, sf_dir).model(), ["average_satisfaction", "rated_delivery_records"])
    return _r6(df, "average_satisfaction")


@query("mx_attendance_by_type")
def mx_attendance_by_type(spark, sf_dir):
    df = summarize(_gold(spark, sf_dir).model(), ["fact.event_type"],
                   ["total_delivery_records", "total_registered", "registered_event_attended", "attendance_variance",
                    "attendance_rate"], order_by=[("total_registered", False), ("event_type", True)])
    return _rate_text(df)


@query("mx_satisfaction_by_type")
def mx_satisfaction_by_type(spark, sf_dir):
    df = summarize(_gold(spark, sf_dir).model(), ["fact.event_type"],
                   ["average_satisfaction", "rated_delivery_records"],
                   order_by=[("average_satisfaction", False), ("event_type", True)])
    return _r6(df, "average_satisfaction")


@query("mx_monthly_detail")
def mx_monthly_detail(spark, sf_dir):
    df = summarize(_gold(spark, sf_dir).model(), ["date.year_month"],
                   ["total_delivery_records", "total_event_groups", "total_people_reached", AVG_REACH,
                    "total_session_hours"], order_by=[("year_month", True)])
    return _r6(df, "total_session_hours")


@query("mx_region_detail")
def mx_region_detail(spark, sf_dir):
    return summarize(_gold(spark, sf_dir).model(), ["location.region"],
                     ["total_delivery_records", "total_people_reached", AVG_REACH, "locations_reached"],
                     order_by=[("total_people_reached", False), ("region", True)])


@query("mx_programme_detail")
def mx_programme_detail(spark, sf_dir):
    df = summarize(_gold(spark, sf_dir).model(), ["fact.programme_type"],
                   ["total_delivery_records", "total_people_reached", AVG_REACH, "total_session_hours"],
                   order_by=[("total_people_reached", False), ("programme_type", True)])
    return _r6(df, "total_session_hours")


@query("mx_language_detail")
def mx_language_detail(spark, sf_dir):
    return summarize(_gold(spark, sf_dir).model(), ["fact.delivery_language"],
                     ["total_delivery_records", "total_event_groups", "total_people_reached", AVG_REACH],
                     order_by=[("total_people_reached", False), ("delivery_language", True)])


@query("mx_venue_category_detail")
def mx_venue_category_detail(spark, sf_dir):
    return summarize(_gold(spark, sf_dir).model(), ["location.venue_category"],
                     ["total_delivery_records", "total_people_reached", AVG_REACH, "locations_reached"],
                     order_by=[("total_delivery_records", False), ("total_people_reached", False),
                               ("venue_category", True)])


# -- step 6: report datasets ----------------------------------------------------

@query("rv_kpi_overview")
def rv_kpi_overview(spark, sf_dir):
    return report.kpi_overview(_gold(spark, sf_dir).model(), PAGE1)


@query("rv_monthly")
def rv_monthly(spark, sf_dir):
    return report.monthly(_gold(spark, sf_dir).model(), {"fact.event_type": EVENT_TYPES})


@query("rv_region")
def rv_region(spark, sf_dir):
    return report.region(_gold(spark, sf_dir).model(), {"date.month_name": MONTHS})


@query("rv_programme")
def rv_programme(spark, sf_dir):
    return report.programme(_gold(spark, sf_dir).model(), PAGE1)


@query("rv_kpi_attendance")
def rv_kpi_attendance(spark, sf_dir):
    return _r6(report.kpi_attendance(_gold(spark, sf_dir).model(), PAGE2), "average_satisfaction")


@query("rv_monthly_attendance")
def rv_monthly_attendance(spark, sf_dir):
    return report.monthly_attendance(_gold(spark, sf_dir).model(), {"fact.programme_type": PROGRAMMES})


@query("rv_rate_by_type")
def rv_rate_by_type(spark, sf_dir):
    return report.rate_by_type(_gold(spark, sf_dir).model(), {"date.month_name": MONTHS})


@query("rv_satisfaction_by_programme")
def rv_satisfaction_by_programme(spark, sf_dir):
    df = report.satisfaction_by_programme(_gold(spark, sf_dir).model(), {"fact.event_type": EVENT_TYPES,
                                                                        "fact.satisfaction_score": NOT_BLANK})
    return _r6(df, "average_satisfaction")


@query("rv_slicer_members")
def rv_slicer_members(spark, sf_dir):
    return report.slicer_members(_gold(spark, sf_dir).model())


def _layered(spark, sf_dir):
    """A gated layered build; as many buckets as the session's joins have partitions, so they line up."""
    root = scratch_path(spark, "layered")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return root, run_layers(spark, standin.layers(buckets), standin.load(spark, sf_dir), root)


@query("layered_build_checks")
def layered_build_checks(spark, sf_dir):
    """Silver and Gold written once each, checked on the stored tables, gated."""
    return check_report(_layered(spark, sf_dir)[1])


@query("layered_row_counts")
def layered_row_counts(spark, sf_dir):
    """Row counts of the stored layer tables (post-write verification)."""
    _, results = _layered(spark, sf_dir)
    return reduce(DataFrame.unionByName, [r.row_counts() for r in results])


def _asked_over_views(spark, sf_dir, question):
    """A question over session views of this call alone; they go once the text is analysed."""
    g = _gold(spark, sf_dir)
    tables = {"fact": g.fact, "date": g.date, "location": g.location, "educator": g.educator, "bridge": g.bridge}
    with session_views(spark, {sql_questions.TABLES[k]: v for k, v in tables.items()}) as prefix:
        return spark.sql(sql_questions.sql_text(question, prefix=prefix))


@query("sql_views_weekend_share")
def sql_views_weekend_share(spark, sf_dir):
    """SQL text over session views of the (lazy) Gold tables."""
    return _asked_over_views(spark, sf_dir, "weekend_share")


@query("sql_views_staff_nations")
def sql_views_staff_nations(spark, sf_dir):
    return _asked_over_views(spark, sf_dir, "staff_nations")


@query("sql_catalog_quarter_growth")
def sql_catalog_quarter_growth(spark, sf_dir):
    """SQL text over external catalog tables, in a database of this run, that point at
    the stored Gold layer of a gated layered build."""
    root, results = _layered(spark, sf_dir)
    database = "strata_gold_" + root.rsplit("-", 1)[-1]
    register_tables(spark, {sql_questions.TABLES[k]: p for k, p in results[-1].paths.items()}, database,
                    f"{root}/{database}.db")
    return spark.sql(sql_questions.sql_text("quarter_growth", database))


@query("reconcile_sql_vs_metrics")
def reconcile_sql_vs_metrics(spark, sf_dir):
    g = _stored_gold(spark, sf_dir)
    return questions.reconcile_region_reach(g.fact, g.location, g.model())
