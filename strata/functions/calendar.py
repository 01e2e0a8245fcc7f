"""Calendar attributes of a date: the columns of a date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column | str) -> Column:
    """Integer ``yyyyMMdd`` key, computed arithmetically (no string round trip)."""
    d = F.col(c) if isinstance(c, str) else c
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(c: Column | str = "date") -> list[Column]:
    """date_key, date, year, quarter ('Qn'), month_number, month_name,
    year_month ('yyyy-MM'), week_of_year (ISO week, not paired with an ISO
    year, so week 53 may fall in January), day_of_month, day_name."""
    d = F.col(c) if isinstance(c, str) else c
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.date_format(d, "EEEE").alias("day_name"),
    ]
