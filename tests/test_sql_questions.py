"""SQL-text questions give the same rows over session views and over catalog tables."""

import uuid

import pytest

from strata.plans import sql_questions, standin
from strata.session import scratch_path
from strata.sources.catalog import register_tables, session_views
from strata.sources.sinks import write_layer
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def databases(spark):
    g = standin.gold(spark, SF_SMALL)
    tables = {"fact": g.fact, "date": g.date, "location": g.location, "educator": g.educator, "bridge": g.bridge}
    made = []
    for _ in range(2):  # two runs side by side, each with a database of its own
        root = scratch_path(spark, "sql")
        paths = write_layer(spark, tables, root, "gold")
        made.append("strata_test_" + uuid.uuid4().hex)
        register_tables(spark, {sql_questions.TABLES[k]: p for k, p in paths.items()}, made[-1], f"{root}/db")
    with session_views(spark, {sql_questions.TABLES[k]: v for k, v in tables.items()}) as prefix:
        yield prefix, made


@pytest.mark.parametrize("name", sorted(sql_questions.QUESTIONS))
def test_views_and_catalog_agree(spark, databases, name):
    prefix, stored = databases
    want = [tuple(r) for r in spark.sql(sql_questions.sql_text(name, prefix=prefix)).collect()]
    assert want
    for database in stored:
        assert [tuple(r) for r in spark.sql(sql_questions.sql_text(name, database)).collect()] == want


def test_views_are_gone_afterwards_and_the_plan_stays(spark):
    rows = spark.range(3)
    with session_views(spark, {"numbers": rows}) as one, session_views(spark, {"numbers": rows.limit(1)}) as two:
        kept = spark.sql(f"SELECT * FROM {one}numbers")
        assert spark.sql(f"SELECT * FROM {two}numbers").count() == 1
    assert kept.count() == 3
    assert not [t for t in spark.catalog.listTables() if t.name.startswith((one, two))]
