"""Questions and details come in the requested order: row sequences against the oracle's."""

import duckdb
import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from strata.plans import catalog, oracle
from tests.conftest import SF_SMALL
from tests.test_entry import TABLES, _norm

ORDER = {
    "bq_monthly_trend": "year_month",
    "bq_reach_by_region": "people_reached DESC, region",
    "bq_reach_by_suburb": "total_people_reached DESC, region, suburb",
    "bq_attendance_by_type": "attendance_rate_pct DESC, event_type",
    "bq_reach_by_programme": "people_reached DESC, programme_type",
    "bq_reach_by_language": "people_reached DESC, delivery_language",
    "bq_venue_category": "delivery_records DESC, people_reached DESC, venue_category",
    "bq_venue_detail": "venue_category, total_delivery_records DESC, venue_type",
    "bq_satisfaction_by_type": "avg_satisfaction_score DESC, event_type",
    "bq_educator_ranking": "events_delivered DESC, total_hours DESC, educator_id",
    "bq_outreach_regions": "delivery_records, people_reached, region",
    "bq_outreach_suburbs_top10": "total_people_reached, total_delivery_records, suburb, region",
    "mx_educator": "events_delivered_by_educator DESC, educator_name",
    "mx_month_name_sorted": "month_number",
    "rv_slicer_members": "slicer, sort_order, member",
    "mx_attendance_by_type": "total_registered DESC, event_type",
    "mx_satisfaction_by_type": "average_satisfaction DESC, event_type",
    "mx_monthly_detail": "year_month",
    "mx_region_detail": "total_people_reached DESC, region",
    "mx_programme_detail": "total_people_reached DESC, programme_type",
    "mx_language_detail": "total_people_reached DESC, delivery_language",
    "mx_venue_category_detail": "total_delivery_records DESC, total_people_reached DESC, venue_category",
    "rv_monthly": "year_month",
    "rv_region": "total_people_reached DESC, region",
    "rv_programme": "total_people_reached DESC, programme_type",
    "rv_monthly_attendance": "year_month",
    "rv_rate_by_type": "attendance_rate DESC, event_type",
    "rv_satisfaction_by_programme": "average_satisfaction DESC, programme_type",
    "staffing_drilldown": "event_date, event_id",
    "fact_preview": "event_date, event_id",
    "sql_views_weekend_share": "venue_type",
    "sql_views_staff_nations": "active_staff DESC, home_nation",
    "sql_catalog_quarter_growth": "year, quarter",
}


@pytest.mark.parametrize("name", sorted(ORDER))
def test_rows_come_in_order(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    keys = ", ".join(f"{k} NULLS LAST" if k.endswith("DESC") else f"{k} NULLS FIRST" for k in ORDER[name].split(", "))
    df = catalog.REGISTRY[name](spark, SF_SMALL)
    columns = ", ".join(df.columns)
    want = con.execute(f"SELECT {columns} FROM ({oracle.ORACLE[name]}) ORDER BY {keys}").fetchall()
    assert [tuple(map(_norm, r)) for r in df.collect()] == [tuple(map(_norm, r)) for r in want]
