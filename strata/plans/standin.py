"""Shape TPC-H-style tables into the delivery model.

Mapping (all derived by Spark from the given tables, every row kept):

* raw rows with duplicate keys: ``lineitem`` keyed by (l_orderkey, l_linenumber);
  survivor = smallest row by ``LINEITEM_ORDER``;
* one delivery per order: ``orders`` ⟕ per-order roll-up of the deduplicated
  lines; group = customer × order year; registered / attended / engaged =
  quantity on lines flagged A / R / N; satisfaction = 1 + 40·max discount on
  lines with status F; duration = 25 minutes per line;
* event type = order priority (``4-NOT SPECIFIED`` standardised);
  programme = order status; language = the first of the return flags
  A, N, R present on the order's lines;
* location = customer ⋈ nation ⋈ region; venue type = market segment;
* staff = supplier ⋈ nation; staffing bridge = (order, supplier) pairs with
  hours = summed quantity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.clean import CleanSpec, clean
from strata.operators import quality as Q
from strata.operators.dedup import dedup_by_key
from strata.operators.joins import checked_broadcast
from strata.plans.delivery import delivery_model, gold_bridge, gold_dim_educator, gold_dim_location, gold_fact
from strata.plans.layers import Layer
from strata.plans.metrics import Model
from strata.plans.star import date_table
from strata.sources.ingest import load_tables

# Fixed values of the stand-in mapping.
LINEITEM_KEY = ("l_orderkey", "l_linenumber")
LINEITEM_ORDER = ("l_shipdate", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
                  "l_tax", "l_returnflag", "l_linestatus")
PRIORITY_STANDARD = {"4-NOT SPECIFIED": "Unspecified"}
LANGUAGE_FLAGS = ("A", "N", "R")
VENUE_CATEGORIES = {"HOME": ["HOUSEHOLD", "FURNITURE"]}
MINUTES_PER_LINE = 25
ORDERS_CLEAN = CleanSpec(blank_to_null=("o_orderstatus", "o_orderpriority"),
                         value_maps={"o_orderpriority": PRIORITY_STANDARD})
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def load(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return load_tables(spark, sf_dir, list(names))


def silver_lineitem(lineitem: DataFrame) -> DataFrame:
    return dedup_by_key(lineitem, LINEITEM_KEY, LINEITEM_ORDER)


def silver_orders(orders: DataFrame) -> DataFrame:
    return dedup_by_key(clean(orders, ORDERS_CLEAN), ["o_orderkey"])


def order_rollup(lines: DataFrame) -> DataFrame:
    """Per-order roll-up. Every aggregate keeps a fixed-width buffer (sums,
    counts, max, min_by over numbers), so Spark plans a hash aggregate with
    map-side combine instead of sorting every partition."""
    flag, qty = F.col("l_returnflag"), F.col("l_quantity")
    has = {f: F.max(F.when(flag == f, F.lit(1))) for f in LANGUAGE_FLAGS}
    language = None
    for f in LANGUAGE_FLAGS:
        language = F.when(has[f] == 1, F.lit(f)) if language is None else language.when(has[f] == 1, F.lit(f))
    return lines.groupBy("l_orderkey").agg(
        F.sum(F.when(flag == "A", qty)).cast("int").alias("registered_count"),
        F.sum(F.when(flag == "R", qty)).cast("int").alias("attended_count"),
        F.sum(F.when(flag == "N", qty)).cast("int").alias("engaged_people_count"),
        (F.count(F.lit(1)) * MINUTES_PER_LINE).cast("int").alias("session_duration_minutes"),
        F.round(F.lit(1.0) + F.lit(40.0) * F.max(F.when(F.col("l_linestatus") == "F", F.col("l_discount"))), 2)
        .alias("satisfaction_score"),
        F.min_by("l_suppkey", "l_linenumber").alias("lead_educator_id"),
        language.alias("delivery_language"),
    )


def silver_events(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per order; roll-up columns are null for an order without lines."""
    rollup = order_rollup(lines)
    joined = orders.join(rollup, orders["o_orderkey"] == rollup["l_orderkey"], "left")
    return joined.select(
        F.col("o_orderkey").alias("event_id"),
        F.concat(F.col("o_custkey").cast("string"), F.lit("-"), F.year("o_orderdate").cast("string"))
        .alias("event_group_id"),
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.col("o_custkey").alias("location_id"),
        "lead_educator_id",
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("event_name"),
        F.col("o_orderpriority").alias("event_type"),
        F.col("o_orderstatus").alias("programme_type"),
        "delivery_language",
        F.col("registered_count").isNotNull().alias("registration_required"),
        "registered_count", "attended_count", "engaged_people_count",
        "session_duration_minutes", "satisfaction_score",
    )


def silver_locations(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    nat = checked_broadcast(nation.select("n_nationkey", "n_name", "n_regionkey"))
    reg = checked_broadcast(region.select("r_regionkey", "r_name"))
    c = customer.join(nat, customer["c_nationkey"] == nat["n_nationkey"], "left")
    c = c.join(reg, c["n_regionkey"] == reg["r_regionkey"], "left")
    return c.select(
        F.col("c_custkey").alias("location_id"),
        F.col("c_name").alias("venue_name"),
        F.col("n_name").alias("suburb"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("venue_type"),
    )


def silver_educators(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    nat = checked_broadcast(nation.select("n_nationkey", "n_name"))
    s = supplier.join(nat, supplier["s_nationkey"] == nat["n_nationkey"], "left")
    bal = F.col("s_acctbal")
    return s.select(
        F.col("s_suppkey").alias("educator_id"),
        F.col("s_name").alias("educator_name"),
        F.col("n_name").alias("home_nation"),
        F.when(bal >= 5000, "Senior").when(bal >= 0, "Intermediate").otherwise("Junior").alias("experience_level"),
        (bal > 0).alias("active_status"),
    )


def silver_assignments(lines: DataFrame) -> DataFrame:
    return lines.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("hours_worked"),
        F.count(F.lit(1)).cast("int").alias("assigned_lines"),
    ).select(
        F.col("l_orderkey").alias("event_id"),
        F.col("l_suppkey").alias("educator_id"),
        "hours_worked",
        "assigned_lines",
    )


@dataclass
class Gold:
    """The Gold layer built lazily from the stand-in tables."""

    raw: dict[str, DataFrame]
    lines: DataFrame
    orders: DataFrame
    fact: DataFrame
    date: DataFrame
    location: DataFrame
    educator: DataFrame
    bridge: DataFrame

    def model(self) -> Model:
        return delivery_model(self.fact, self.date, self.location, self.educator, self.bridge)


def silver_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The Silver layer: typed, cleaned, one row per key."""
    return {
        "lineitem": silver_lineitem(raw["lineitem"]),
        "orders": silver_orders(raw["orders"]),
        "locations": silver_locations(raw["customer"], raw["nation"], raw["region"]),
        "educators": silver_educators(raw["supplier"], raw["nation"]),
    }


def gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The Gold layer (star schema) from Silver tables."""
    lines, orders = silver["lineitem"], silver["orders"]
    fact = gold_fact(silver_events(orders, lines))
    return {
        "fact": fact,
        "date": date_table(fact, "event_date"),
        "location": gold_dim_location(silver["locations"], VENUE_CATEGORIES),
        "educator": gold_dim_educator(silver["educators"]),
        "bridge": gold_bridge(silver_assignments(lines), dedup=False),  # a GROUP BY on its key
    }


def build_gold(raw: dict[str, DataFrame]) -> Gold:
    silver = silver_tables(raw)
    g = gold_tables(silver)
    return Gold(raw, silver["lineitem"], silver["orders"], g["fact"], g["date"], g["location"], g["educator"],
                g["bridge"])


def silver_checks() -> list[Q.Check]:
    return [
        Q.unique("lineitem", "l_orderkey", "l_linenumber"),
        Q.unique("orders", "o_orderkey"),
        Q.not_null("orders", "o_orderkey"),
        Q.foreign_key("orders", ["o_custkey"], "locations", ["location_id"]),
        Q.foreign_key("lineitem", ["l_orderkey"], "orders", ["o_orderkey"], rows=True),
        Q.foreign_key("lineitem", ["l_suppkey"], "educators", ["educator_id"]),
    ]


def gold_checks(coverage_severity: str = "error") -> list[Q.Check]:
    return [
        Q.unique("fact", "event_id"),
        Q.unique("bridge", "event_id", "educator_id"),
        Q.unique("location", "location_id"),
        Q.unique("educator", "educator_id"),
        Q.unique("date", "date_key"),
        Q.not_null("fact", "event_id"),
        Q.not_null("fact", "event_group_id"),
        Q.foreign_key("fact", ["location_id"], "location"),
        Q.foreign_key("fact", ["event_date_key"], "date", ["date_key"]),
        Q.foreign_key("bridge", ["event_id"], "fact"),
        Q.foreign_key("bridge", ["educator_id"], "educator"),
        Q.Check("fact_event_has_educator", "coverage", "fact", ("event_id",), "bridge", ("event_id",), expected=0,
                severity=coverage_severity),
        Q.in_range("fact", "satisfaction_score", 1, 5),
    ]


def expected_checks(rows: int, groups: int) -> list[Q.Check]:
    """What a run of known input must give: the fact's rows and event groups."""
    return [Q.row_count("fact", rows), Q.distinct_count("fact", "event_group_id", groups)]


def layers(bucket_count: int | None = None) -> list[Layer]:
    """Silver and Gold as gated layers. Orders without any line are genuine
    unstaffed deliveries here, so staffing coverage is a warning.

    With ``bucket_count`` the big tables are stored bucketed on their join
    key: Silver lines and orders by order key (the Gold roll-up, the bridge
    and the orders ⟕ roll-up join then need no shuffle), Gold fact and bridge
    by ``event_id`` (bridge → fact joins need no shuffle)."""
    n = bucket_count
    silver_buckets = {"lineitem": (n, ["l_orderkey"]), "orders": (n, ["o_orderkey"])} if n else {}
    gold_buckets = {"fact": (n, ["event_id"]), "bridge": (n, ["event_id"])} if n else {}
    return [
        Layer("silver", silver_tables, silver_checks(), buckets=silver_buckets),
        Layer("gold", gold_tables, gold_checks(coverage_severity="warning"), buckets=gold_buckets),
    ]


def gold(spark: SparkSession, sf_dir: str) -> Gold:
    return build_gold(load(spark, sf_dir))


# -- derived "dirty" inputs for the cleaning and check operators -------------

def dirty_orders(orders: DataFrame) -> DataFrame:
    """A raw, all-text version of ``orders`` with realistic defects derived
    from the data itself: padded text, blanks, non-numeric ids, mixed-case
    booleans and blank keys."""
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders.select(
        F.when((prio == "1-URGENT") & (status == "P"), F.lit("  "))
        .otherwise(F.col("o_orderkey").cast("string")).alias("order_id"),
        F.when(prio == "5-LOW", F.lit("")).otherwise(F.concat(F.lit("  "), status, F.lit(" "))).alias("status"),
        F.concat(F.lit(" "), prio).alias("priority"),
        F.when(status == "P", F.lit("x")).otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")))
        .alias("customer_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        F.when(status == "F", F.lit("TRUE")).when(status == "O", F.lit("false")).otherwise(F.lit("maybe"))
        .alias("is_final"),
        F.col("o_orderkey").alias("source_key"),
    )


def shifted(df: DataFrame, column: str, offset: int) -> DataFrame:
    """``column + offset``: keys that run past the parent's key range."""
    return df.withColumn(column, F.col(column) + F.lit(offset))
