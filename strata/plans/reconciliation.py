"""Every business question held against the metric layer and against control totals.

Three sides: the question as written against the star (``sql``), the same question put to the
metric layer (``model``), and totals taken from the cleaned rows without any star table
(``control``). Tolerances go by the kind of measure: counts and people must be equal, hours may
differ by rounding of sums, rates and averages by the digits that the question rounds to.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.reconcile import compare_sides, long_form
from strata.plans import questions
from strata.plans.metrics import Model, row, summarize

TOLERANCE = {"hours": 0.051, "session_hours": 1e-4, "attendance_rate_pct": 0.0501, "satisfaction": 0.00501, "average_reach": 0.0501}


@dataclass(frozen=True)
class Twin:
    """One question on both sides. ``measures``: measure name -> (its column in the question, its
    measure in the model, factor); ``totals``: measures that may be added up over the keys."""

    name: str
    keys: tuple[str, ...]            # "table.column" in the model; the question's columns bear the same names
    asked: Callable[..., DataFrame]  # of the model's tables
    measures: dict[str, tuple[str, str, float]]
    totals: tuple[str, ...] = ()

    def sides(self, model: Model) -> tuple[DataFrame, DataFrame]:
        names = [k.split(".")[1] for k in self.keys]
        asked = self.asked(model.tables)
        sql = long_form(asked, self.name, names, {c: m for m, (c, _, _) in self.measures.items()}, [self.measures[m][0] for m in self.totals])
        wanted = list(dict.fromkeys(measure for _, measure, _ in self.measures.values()))
        out = summarize(model, list(self.keys), wanted) if self.keys else row(model, wanted)
        for key, name in zip(self.keys, names):
            if key.split(".")[0] != "fact":  # the question's inner join has no blank member
                out = out.filter(F.col(name).isNotNull())
        columns = [(F.col(measure) * F.lit(factor) if factor != 1 else F.col(measure)).alias(m)
                   for m, (_, measure, factor) in self.measures.items()]
        return sql, long_form(out.select(*names, *columns), self.name, names, {m: m for m in self.measures}, self.totals)


_DELIVERIES = {"deliveries": ("delivery_records", "total_delivery_records", 1), "people": ("people_reached", "total_people_reached", 1)}
_GROUPS = {"groups": ("event_groups", "total_event_groups", 1)}
_ADDED = ("deliveries", "people")


def _located(*attributes: str) -> Callable[..., DataFrame]:
    return lambda t: questions.by_attribute(t["fact"], "location_id", t["location"], "location_id", list(attributes),
                                            {"delivery_records": None, "people_reached": "people_reached"})


def _outreach(t: dict[str, DataFrame]) -> DataFrame:
    return t["fact"].agg(F.sum("session_duration_hours").alias("hours"), F.count_distinct("location_id").alias("locations"),
                         (F.sum("people_reached") / F.count(F.lit(1))).alias("reach"))


TWINS = (
    Twin("totals", (), lambda t: questions.totals(t["fact"]),
         {"deliveries": _DELIVERIES["deliveries"], **_GROUPS, "people": ("total_people_reached", "total_people_reached", 1)}),
    Twin("monthly_trend", ("date.year_month",), lambda t: questions.monthly_trend(t["fact"], t["date"]), {**_DELIVERIES, **_GROUPS}, _ADDED),
    Twin("reach_by_region", ("location.region",), lambda t: questions.reach_by_region(t["fact"], t["location"]), {**_DELIVERIES, **_GROUPS}, _ADDED),
    Twin("reach_by_suburb", ("location.region", "location.suburb"), _located("region", "suburb"), _DELIVERIES, _ADDED),
    Twin("attendance_by_type", ("fact.event_type",), lambda t: questions.attendance_by_type(t["fact"]),
         {"attended": ("total_attended", "registered_event_attended", 1), "variance": ("attendance_variance", "attendance_variance", 1),
          "attendance_rate_pct": ("attendance_rate_pct", "attendance_rate", 100)}, ("attended", "variance")),
    Twin("reach_by_programme", ("fact.programme_type",), lambda t: questions.reach_by_attribute(t["fact"], "programme_type"), _DELIVERIES, _ADDED),
    Twin("reach_by_language", ("fact.delivery_language",), lambda t: questions.reach_by_attribute(t["fact"], "delivery_language"), _DELIVERIES, _ADDED),
    Twin("venue_categories", ("location.venue_category",), lambda t: questions.venue_categories(t["fact"], t["location"]), _DELIVERIES, _ADDED),
    Twin("venue_detail", ("location.venue_category", "location.venue_type"), _located("venue_category", "venue_type"), _DELIVERIES, _ADDED),
    Twin("satisfaction_by_type", ("fact.event_type",), lambda t: questions.satisfaction_by_type(t["fact"]),
         {"rated": ("rated_events", "rated_delivery_records", 1), "satisfaction": ("avg_satisfaction_score", "average_satisfaction", 1)}, ("rated",)),
    Twin("educator_ranking", ("educator.educator_id",), lambda t: questions.educator_ranking(t["bridge"], t["educator"]),
         {"events": ("events_delivered", "events_delivered_by_educator", 1), "hours": ("total_hours", "educator_hours", 1)}, ("events",)),
    Twin("outreach_regions", ("location.region",), lambda t: questions.outreach_regions(t["fact"], t["location"]),
         {**_DELIVERIES, **_GROUPS, "average_reach": ("avg_reach_per_delivery", "average_people_reached_per_delivery", 1)}, _ADDED),
    Twin("time_and_outreach", (), _outreach,
         {"session_hours": ("hours", "total_session_hours", 1), "locations": ("locations", "locations_reached", 1),
          "average_reach": ("reach", "average_people_reached_per_delivery", 1)}),
)


def reconciled(model: Model, control: DataFrame) -> DataFrame:
    """question, key, measure, sql, model, control, status. ``control``: measure, value — totals that
    every question with that measure must add up to."""
    sides = [twin.sides(model) for twin in TWINS]
    totals = [(t.name, m) for t in TWINS for m in t.measures if m in t.totals or not t.keys]
    due = model.tables["fact"].sparkSession.createDataFrame(totals, "question string, name string")
    held = due.join(F.broadcast(control), F.col("name") == F.col("measure"))  # a row per control total
    held = held.select("question", F.lit("(total)").alias("key"), "measure", F.col("value").cast("double").alias("value"))
    return compare_sides({"sql": [s for s, _ in sides], "model": [m for _, m in sides], "control": [held]}, TOLERANCE)


def control_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """measure, value: from the cleaned orders and lines of the stand-in, one read of each."""
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    per_order = lines.groupBy("l_orderkey").agg(
        *[F.sum(F.when(flag == f, quantity)).alias(f) for f in ("A", "R", "N")], F.count_distinct("l_suppkey").alias("staff"),
        F.max(F.when(F.col("l_linestatus") == "F", F.lit(1))).alias("rated"))
    people = F.coalesce("N", "R", F.lit(0))
    both = per_order.agg(F.sum(people).alias("people"), F.sum(F.when(F.col("A") > 0, F.col("R"))).alias("attended"),
                         F.sum(F.when(F.col("A") > 0, F.col("R"))).alias("r"), F.sum("A").alias("a"), F.sum("staff").alias("events"),
                         F.sum("rated").alias("rated"))
    counted = orders.agg(F.count(F.lit(1)).alias("deliveries"), F.count_distinct("o_custkey").alias("locations"),
                         F.count_distinct("o_custkey", F.year("o_orderdate")).alias("groups"))
    one = lambda m, c: F.struct(F.lit(m).alias("measure"), c.cast("double").alias("value"))
    return (both.select(F.inline(F.array(one("people", F.col("people")), one("attended", F.col("attended")),
                                         one("variance", F.col("r") - F.col("a")), one("events", F.col("events")), one("rated", F.col("rated")))))
            .unionByName(counted.select(F.inline(F.array(*[one(c, F.col(c)) for c in ("deliveries", "locations", "groups")])))))
