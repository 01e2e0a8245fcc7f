"""Mergeable distinct counts and stored aggregates against direct evaluation."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import distincts as D
from strata.plans import report, standin
from strata.plans import stored_queries as S
from strata.plans.aggregates import partial_states, stored_aggregate, with_aggregates
from strata.plans.catalog import PAGE1
from strata.plans.delivery import delivery_model
from strata.plans.metrics import NOT_BLANK, Measure, Model, Relationship, covering, summarize
from tests.conftest import SF_SMALL


def facts(spark):
    return spark.range(6000).select(
        (F.col("id") % 3).alias("a"), F.when(F.col("id") % 11 > 0, F.col("id") % 5).alias("b"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("g"), (F.col("id") % 900).cast("string"))).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("n"),  # one value of a third of all rows
        F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("z"))


COLUMNS = {"groups": "g", "numbers": "n", "zeros": "z"}


@pytest.mark.parametrize("sparse", [256, 0, 40_000])
def test_counts_from_the_state_equal_direct_counts(spark, monkeypatch, sparse):
    monkeypatch.setattr(D, "SPARSE", sparse)
    df = facts(spark)
    sets = D.members(df, ["a", "b"], COLUMNS)
    ids = D.dense_ids(sets)
    assert sorted(r["id"] for r in ids.collect()) == list(range(ids.count()))
    state = D.distinct_state(sets, ["a", "b"], ids)
    assert tuple(state.columns) == ("a", "b", *D.STATE)
    for keys in (["a", "b"], ["b"], ["a"], []):
        direct = df.groupBy(*keys).agg(*[F.count_distinct(c).alias(m) for m, c in COLUMNS.items()])
        want = sorted(map(tuple, direct.collect()), key=repr)
        assert sorted(map(tuple, D.distinct_counts(state, keys, list(COLUMNS)).collect()), key=repr) == want
        assert sorted(map(tuple, D.distinct_counts(D.coarser(state, keys), keys, list(COLUMNS)).collect()), key=repr) == want
        blank = {tuple(r[:len(keys)]): r[len(keys)] for r in D.distinct_counts(state, keys, ["groups"], blank=True).collect()}
        assert blank == {tuple(r[:len(keys)]): r[len(keys)] + 1 for r in direct.collect()}


def test_buckets_past_the_first_and_rows_that_do_not_count(spark):
    df = spark.range(70_000).select((F.col("id") % 2).alias("k"), "id")
    sets = D.members(df, ["k"], {"all": "id", "some": "id"}, {"some": F.col("id") < 100})
    state = D.distinct_state(sets, ["k"], D.dense_ids(sets))
    assert state.filter("bits IS NOT NULL").count() >= 4 and state.select(F.max("bucket")).first()[0] >= 3
    assert sorted(map(tuple, D.distinct_counts(state, ["k"], ["all", "some"]).collect())) == [(0, 35_000, 50), (1, 35_000, 50)]
    assert [tuple(r) for r in D.distinct_counts(state.limit(0), [], ["all"]).collect()] == [(0,)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def aggregated(spark):
    """A model with orphan keys, and the same model answering from aggregates."""
    g = standin.gold(spark, SF_SMALL)
    fact = standin.shifted(g.fact, "location_id", 7).withColumn("event_group_id", F.when(F.col("event_id") % 5 > 0, F.col("event_group_id")))
    model = delivery_model(fact, g.date, g.location, g.educator, g.bridge)
    page = stored_aggregate(model, "fact", S.PAGE1_GRAIN, S.PAGE1_MEASURES + ["average_satisfaction", "total_session_hours", "total_registered"])
    return model, with_aggregates(model, [page, page.coarser(["fact.event_type", "location.region"]), page.coarser([])])


def exact(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("group, measures, filters, grain", [
    ([], S.PAGE1_MEASURES, None, 0),
    ([], S.PAGE1_MEASURES, PAGE1, 5),
    (["location.region"], ["total_people_reached", "locations_reached", "total_event_groups"], None, 2),
    (["location.region"], ["locations_reached"], {"fact.event_type": ["2-HIGH", None]}, 2),
    (["location.region"], ["locations_reached", "total_registered"], {"location.region": ["ASIA", None]}, 2),
    (["date.year_month"], ["total_session_hours", "average_satisfaction"], {"location.region": NOT_BLANK}, 5),
    (["fact.event_type"], ["attendance_rate"], {"educator.home_nation": ["CHINA"], "fact.event_type": []}, 2),
    (["fact.programme_type", "location.region"], ["total_event_groups"], {"date.month_name": "March"}, 5),
])
def test_an_aggregate_answers_as_the_tables_do(spark, aggregated, group, measures, filters, grain):
    model, fast = aggregated
    got = summarize(fast, group, measures, filters, keep_blank_rows=not group)
    assert exact(got) == exact(summarize(model, group, measures, filters, keep_blank_rows=not group))
    assert not re.search(r"/(lineitem|orders)\.parquet", got._jdf.queryExecution().executedPlan().toString())
    parsed = {tuple(k.split(".")): v for k, v in (filters or {}).items()}
    base = [n for n in measures if n != "attendance_rate"]
    found = covering(fast, "fact", [tuple(x.split(".")) for x in group], base, parsed)
    assert len(found.grain) == grain


@pytest.mark.parametrize("group, measures, filters", [
    (["location.suburb"], ["total_people_reached"], None),                                  # not in the grain
    (["location.region"], ["total_attended"], None),                                        # not an own measure
    (["location.region"], ["total_people_reached"], {"location.region": lambda c: c.isNull()}),
    (["location.region"], ["total_people_reached"], {"location.suburb": ["CHINA"]}),
])
def test_what_no_aggregate_covers_comes_from_the_tables(spark, aggregated, group, measures, filters):
    model, fast = aggregated
    assert rows(summarize(fast, group, measures, filters)) == rows(summarize(model, group, measures, filters))


def test_a_replaced_filter_is_not_answered_from_the_grain(spark):
    t = spark.createDataFrame([(1, 5, "a"), (0, 7, "a"), (None, 9, "b"), (2, 1, "b")], "flag int, v int, k string")
    model = Model({"t": t}, [], {}).add_measures([Measure("v", "sum", "t", "v", where=("flag", "nonblank")), Measure("n", "count_rows", "t")])
    fast = with_aggregates(model, [stored_aggregate(model, "t", ["t.k", "t.flag"], ["v", "n"])])
    for filters in ({"t.flag": [0]}, {"t.k": ["a"]}, None):
        assert rows(summarize(fast, ["t.k"], ["v", "n"], filters)) == rows(summarize(model, ["t.k"], ["v", "n"], filters))
    assert covering(fast, "t", [("t", "k")], ["v"], {("t", "flag"): [0]}) is None
    assert covering(fast, "t", [("t", "k")], ["n"], {("t", "flag"): [0]}) is not None


def test_a_large_dimension_gives_the_same_states(spark):
    t = spark.range(500).select((F.col("id") % 9).alias("k"), (F.col("id") % 40).alias("g"), F.lit(1).alias("one"))
    dim = spark.createDataFrame([(i, f"n{i % 3}") for i in range(7)], "k long, name string")
    made = []
    for bound in (None, -1):
        model = Model({"t": t, "d": dim}, [Relationship("t", "k", "d", "k")], {}, max_broadcast_bytes=bound)
        model.add_measures([Measure("ones", "sum", "t", "one"), Measure("kinds", "distinct", "t", "g")])
        made.append(rows(summarize(with_aggregates(model, [stored_aggregate(model, "t", ["d.name"], ["ones", "kinds"])]), ["d.name"], ["ones", "kinds"])))
    assert made[0] == made[1] == rows(summarize(model, ["d.name"], ["ones", "kinds"]))


def test_a_page_reads_its_fact_once(spark):
    model = standin.gold(spark, SF_SMALL).model()
    base = [m for m in model.measures.values() if m.table == "fact" and m.name in S.PAGE1_MEASURES + ["total_registered", "registered_event_attended"]]
    plan = partial_states(model, "fact", S.PAGE1_GRAIN, base)._jdf.queryExecution().executedPlan().toString()
    scans = Counter(re.findall(r"FileScan parquet.*?Location: .*?/(\w+)\.parquet\]", plan.split("== Initial Plan ==")[-1]))
    assert scans["lineitem"] == 1 and scans["orders"] == 2  # the fact, and the bounds of the calendar
    answered = S.page_one(with_aggregates(model, [stored_aggregate(model, "fact", S.PAGE1_GRAIN, S.PAGE1_MEASURES)]), PAGE1)
    for name, df in answered.items():
        assert "/lineitem.parquet" not in df._jdf.queryExecution().executedPlan().toString(), name
    assert rows(answered["region"]) == rows(report.region(model, PAGE1))
