"""Registered queries over stored states: mergeable distinct counts, report pages from
stored aggregates, and what the published layers offer. Oracles: :mod:`strata.plans.stored_oracle`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.distincts import distinct_counts
from strata.operators.reconcile import comparison_summary
from strata.plans import report, standin
from strata.plans.aggregates import StoredAggregate, stored_aggregate, with_aggregates
from strata.plans.audit import model_audit
from strata.plans.catalog import CUSTOMER_CSV, PAGE1, _fact_with_blank_groups, _layered, _stored_gold, query
from strata.plans.delivery import delivery_model, published_model
from strata.plans.layers import Layer, run_layer
from strata.plans.metrics import Model, summarize
from strata.plans.reconciliation import control_totals, reconciled
from strata.session import scratch_path
from strata.sources.ingest import CsvIngest, ingest_csv, read_parquet
from strata.sources.manifest import schema_drift


def _rolled_up(aggregate: StoredAggregate, levels: dict[str, list[str]], measures: dict[str, tuple[str, bool]]) -> DataFrame:
    """level, member and counts (name -> measure, whether a blank counts), every level merged
    from the one stored state."""
    parts = []
    for level, columns in levels.items():
        found = None
        for name, (measure, blank) in measures.items():
            counts = distinct_counts(aggregate.sets.filter(F.col("measure") == measure), columns, [measure], blank)
            member = F.col(columns[0]).cast("string") if columns else F.lit(None).cast("string")
            counts = counts.select(F.lit(level).alias("level"), member.alias("member"),
                                   *[F.col(measure).alias(n) if n == name else F.lit(None).cast("long").alias(n) for n in measures])
            found = counts if found is None else found.unionByName(counts)
        parts.append(found)
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.groupBy("level", "member").agg(*[F.max(n).alias(n) for n in measures])


@query("distinct_rollups")
def distinct_rollups(spark, sf_dir):
    """Distinct event groups (with and without the blank one) and locations by region, month,
    year and in total, all merged from one stored state by region and month."""
    g = standin.gold(spark, sf_dir)
    model = delivery_model(_fact_with_blank_groups(g), g.date, g.location, g.educator, g.bridge)
    stored = stored_aggregate(model, "fact", ["location.region", "date.year", "date.year_month"],
                              ["total_event_groups", "locations_reached"])
    return _rolled_up(stored, {"region": ["location__region"], "month": ["date__year_month"], "year": ["date__year"], "total": []},
                      {"event_groups": ("total_event_groups", False), "event_groups_with_blank": ("total_event_groups", True),
                       "locations": ("locations_reached", False)})


@query("distinct_rollups_staff")
def distinct_rollups_staff(spark, sf_dir):
    """Distinct deliveries by nation and level of the staff and in total, from one stored state:
    a delivery that several nations staff counts once in the total."""
    model = standin.gold(spark, sf_dir).model()
    stored = stored_aggregate(model, "bridge", ["educator.home_nation", "educator.experience_level"],
                              ["events_delivered_by_educator"])
    return _rolled_up(stored, {"nation": ["educator__home_nation"], "experience": ["educator__experience_level"], "total": []},
                      {"events": ("events_delivered_by_educator", False)})


PAGE1_GRAIN = ["date.month_name", "date.year_month", "fact.event_type", "location.region", "fact.programme_type"]
PAGE1_MEASURES = ["total_delivery_records", "total_event_groups", "total_people_reached", "locations_reached", "attendance_rate"]


def page_one(model: Model, filters) -> dict[str, DataFrame]:
    """The datasets of report page 1 in one filter context; the slicer's own list ignores it."""
    return {
        "kpi": report.kpi_overview(model, filters),
        "monthly": report.monthly(model, filters),
        "region": report.region(model, filters),
        "programme": report.programme(model, filters),
        "event_type": summarize(model, ["fact.event_type"], ["total_delivery_records"]),
    }


@query("rv_page1")
def rv_page1(spark, sf_dir):
    """All datasets of report page 1 from one pass over the fact: an aggregate at the page's
    grain and, for the unfiltered list, a coarser one made from it."""
    model = standin.gold(spark, sf_dir).model()
    page = stored_aggregate(model, "fact", PAGE1_GRAIN, PAGE1_MEASURES)
    model = with_aggregates(model, [page, page.coarser(["fact.event_type"])])
    parts = []
    for name, df in page_one(model, PAGE1).items():
        member = [c for c in df.columns if c not in PAGE1_MEASURES]
        parts.append(df.select(F.lit(name).alias("dataset"), (F.col(member[0]) if member else F.lit(None)).cast("string").alias("member"),
                               *[(F.col(m) if m in df.columns else F.lit(None).cast("double" if m == "attendance_rate" else "long")).alias(m)
                                 for m in PAGE1_MEASURES]))
    return reduce(DataFrame.unionByName, parts)


@query("mx_filter_propagation_published")
def mx_filter_propagation_published(spark, sf_dir):
    """The location filter reaches the bridge through the fact, over the published Gold layer:
    bridge and fact lie in the same buckets, so nothing is moved between them."""
    root, _ = _layered(spark, sf_dir)
    return summarize(published_model(spark, root), ["educator.experience_level"],
                     ["events_delivered_by_educator", "educator_hours"], {"location.region": ["ASIA"]})


@query("schema_drift")
def schema_drift_of_orders(spark, sf_dir):
    """Every published version of a layer against its declared schema: the second version
    stores the price as text, lacks the priority and has a column that nobody declared."""
    root = scratch_path(spark, "drift")
    orders = read_parquet(spark, f"{sf_dir}/orders.parquet")
    drifted = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string")).drop("o_orderpriority").withColumn("o_note", F.lit(1))
    layer = Layer("bronze", lambda t: {"orders": t["orders"]})
    for table in (orders, drifted):
        run_layer(spark, layer, {"orders": table}, root)
    return schema_drift(spark, root, "bronze", {"orders": orders.schema})


@query("reconcile_questions")
def reconcile_questions(spark, sf_dir):
    """All business questions against the metric layer and control totals: what was compared
    per question and measure, and how much of it agrees."""
    g = _stored_gold(spark, sf_dir)
    return comparison_summary(reconciled(g.model(), control_totals(g.orders, g.lines)))


@query("model_audit")
def audit_of_the_delivery_model(spark, sf_dir):
    """Every measure against every table: may it be grouped by the table, over how many paths
    (none from the fact to the staff: the lead educator is no relationship), what is hidden."""
    return model_audit(_stored_gold(spark, sf_dir).model())


def _defective_csv(spark, sf_dir) -> CsvIngest:
    """``customer`` as CSV lines, each seventh key without its last field and each eleventh with
    one more than declared (a quoted one that holds a comma), ingested."""
    customer = read_parquet(spark, f"{sf_dir}/customer.parquet")
    names = CUSTOMER_CSV.column_names
    quoted = [F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')) for c in names]
    line = (F.when(F.col("c_custkey") % 7 == 0, F.concat_ws(",", *quoted[:-1]))
            .when(F.col("c_custkey") % 11 == 0, F.concat_ws(",", *quoted, F.lit('"one, more"'))).otherwise(F.concat_ws(",", *quoted)))
    path = scratch_path(spark, "csv-defects")
    customer.select(line.alias("value")).write.text(path)
    return ingest_csv(spark, path, CUSTOMER_CSV, scratch_path(spark, "csv-ingested"), header=False)


@query("csv_rejected_rows")
def csv_rejected_rows(spark, sf_dir):
    """The reject table: text, number of fields and kind of every row that was not accepted."""
    rejected = _defective_csv(spark, sf_dir).rejected
    return rejected.select("row_text", "fields", "kind", F.col("source_file").isNotNull().alias("has_source_file"))


@query("csv_ingest_counts")
def csv_ingest_counts(spark, sf_dir):
    """Rows accepted and rejected by kind, as counted in the storing pass, beside what is stored."""
    done = _defective_csv(spark, sf_dir)
    counted = spark.createDataFrame(list(done.counts.items()), "kind string, counted long")
    kinds = done.accepted.select(F.lit("accepted").alias("kind")).unionByName(done.rejected.select("kind"))
    stored = kinds.groupBy(F.col("kind").alias("__k")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(stored, F.col("kind") == F.col("__k"), "left").select("kind", "counted", F.coalesce("n", F.lit(0)).alias("stored"))


@query("mx_blank_order")
def mx_blank_order(spark, sf_dir):
    """Where a sort puts the blank member: first ascending, last descending (the first
    member of either sort)."""
    model = _stored_gold(spark, sf_dir).model()
    parts = []
    for name, ascending in (("ascending", True), ("descending", False)):
        first = summarize(model, ["fact.delivery_language"], ["total_delivery_records"], order_by=[("delivery_language", ascending)]).limit(1)
        parts.append(first.select(F.lit(name).alias("sort"), F.col("delivery_language").alias("first_member"), "total_delivery_records"))
    return reduce(DataFrame.unionByName, parts)
