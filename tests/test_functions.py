import datetime as dt

from pyspark.sql import functions as F

from strata.functions import (
    CleanSpec,
    blank_div,
    blank_sub,
    blank_to_null,
    calendar_columns,
    cast_rejects,
    clean,
    distinct_with_blank,
    format_measure,
    group_values,
    nonblank,
    value_map,
)


def test_blank_to_null_and_trim_only(spark):
    df = spark.createDataFrame([("  a ",), ("   ",), ("",), (None,), ("\tb",)], "s string")
    got = [r[0] for r in df.select(blank_to_null("s")).collect()]
    assert got == ["a", None, None, None, "\tb"]  # trim strips spaces only
    spec = CleanSpec(trim_only=("s",))
    assert [r.s for r in clean(df, spec).collect()] == ["a", "", "", None, "\tb"]


def test_typed_casts_never_fail(spark):
    df = spark.createDataFrame(
        [(" 12 ", "4.5", "TRUE", "2026-02-11"), ("x", "abc", "maybe", "2026-13-45"), ("", None, "false", " ")],
        "i string, d string, b string, t string",
    )
    spec = CleanSpec(casts={"i": "int", "d": "double", "b": "boolean", "t": "date"})
    rows = clean(df, spec).collect()
    assert rows[0] == (12, 4.5, True, dt.date(2026, 2, 11))
    assert rows[1] == (None, None, None, None)
    assert rows[2] == (None, None, False, None)
    rejects = cast_rejects(df, spec).collect()[0].asDict()
    assert rejects == {"i": 1, "d": 1, "b": 1, "t": 1}


def test_value_map_and_grouping(spark):
    df = spark.createDataFrame([("English/Te Reo Maori",), ("English",), (None,)], "s string")
    got = [r[0] for r in df.select(value_map("s", {"English/Te Reo Maori": "English/Te Reo Māori"})).collect()]
    assert got == ["English/Te Reo Māori", "English", None]
    v = spark.createDataFrame([("Church",), ("Church Hall",), ("Marina",)], "v string")
    got = [r[0] for r in v.select(group_values("v", {"Church": ["Church", "Church Hall"]})).collect()]
    assert got == ["Church", "Church", "Marina"]


def test_clean_spec_from_table_keeps_column_order(spark):
    from strata.sources.schema import spec

    t = spec("t", "a string, n int, flag boolean, z string")
    df = spark.createDataFrame([(" x ", " 3", "true", "")], "a string, n string, flag string, z string")
    out = clean(df, CleanSpec.from_table(t))
    assert out.columns == ["a", "n", "flag", "z"]
    assert out.collect()[0] == ("x", 3, True, None)


def test_blank_arithmetic(spark):
    df = spark.createDataFrame([(None, None), (5, None), (None, 3), (5, 3), (5, 0)], "a int, b int")
    rows = df.select(blank_sub(F.col("a"), F.col("b")).alias("s"), blank_div(F.col("a"), F.col("b")).alias("d"),
                     nonblank(F.col("b")).alias("nb")).collect()
    assert [r.s for r in rows] == [None, 5, -3, 2, 5]
    assert [r.d for r in rows] == [None, None, None, 5 / 3, None]
    assert [r.nb for r in rows] == [False, False, True, True, False]  # 0 is blank too


def test_distinct_with_blank(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "g string")
    assert df.agg(distinct_with_blank(F.col("g"))).collect()[0][0] == 3
    assert df.agg(F.count_distinct("g")).collect()[0][0] == 2
    assert df.select("g").distinct().count() == 3


def test_calendar_columns_and_iso_week(spark):
    df = spark.createDataFrame([(dt.date(2027, 1, 1),), (dt.date(2026, 7, 26),)], "d date")
    rows = df.select(*calendar_columns("d")).collect()
    assert rows[0].date_key == 20270101 and rows[0].week_of_year == 53  # ISO week of the previous year
    assert rows[0].quarter == "Q1" and rows[0].month_name == "January" and rows[0].day_name == "Friday"
    assert rows[1].year_month == "2026-07" and rows[1].day_of_month == 26 and rows[1].month_number == 7


def test_display_formats(spark):
    df = spark.createDataFrame([(0.8953, 3565, 4.64444, 207.92)], "r double, n bigint, s double, h double")
    row = df.select(format_measure(F.col("r"), "0.0%"), format_measure(F.col("n"), "#,0"),
                    format_measure(F.col("s"), "0.00"), format_measure(F.col("h"), "0.0"),
                    format_measure(F.lit(None).cast("double"), "0.0%")).collect()[0]
    assert tuple(row) == ("89.5%", "3,565", "4.64", "207.9", None)
