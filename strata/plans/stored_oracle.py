"""DuckDB SQL of the queries in :mod:`strata.plans.stored_queries`, straight from the raw tables."""

from __future__ import annotations

from strata.plans.oracle import ORACLE, PAGE1, M, with_ctes

_GROUP = "CASE WHEN delivery_language IS NOT NULL THEN event_group_id END"


def _level(level: str, column: str | None, source: str, counts: str) -> str:
    member = f"CAST({column} AS VARCHAR)" if column else "CAST(NULL AS VARCHAR)"
    return f"SELECT '{level}' AS level, {member} AS member, {counts} FROM {source}" + (f" GROUP BY {column}" if column else "")


_FACT_COUNTS = (f"COUNT(DISTINCT {_GROUP}) AS event_groups, "
                f"COUNT(DISTINCT {_GROUP}) + MAX(CASE WHEN ({_GROUP}) IS NULL THEN 1 ELSE 0 END) AS event_groups_with_blank, "
                "COUNT(DISTINCT location_id) AS locations")
_STAFF = "(SELECT b.event_id, e.home_nation, e.experience_level FROM br b LEFT JOIN edu e ON b.educator_id = e.educator_id)"


def _dataset(name: str, member: str | None, columns: list[str], where: str = "") -> str:
    every = ["total_delivery_records", "total_event_groups", "total_people_reached", "locations_reached", "attendance_rate"]
    shown = ", ".join(f"{M[c]} AS {c}" if c in columns else
                      f"CAST(NULL AS {'DOUBLE' if c == 'attendance_rate' else 'BIGINT'}) AS {c}" for c in every)
    return (f"SELECT '{name}' AS dataset, {member or 'CAST(NULL AS VARCHAR)'} AS member, {shown} FROM fjd {where}"
            + (f" GROUP BY {member}" if member else ""))


ORACLE_STORED = {
    "distinct_rollups": with_ctes(" UNION ALL ".join([
        _level("region", "region", "fjd", _FACT_COUNTS), _level("month", "year_month", "fjd", _FACT_COUNTS),
        _level("year", "year(event_date)", "fjd", _FACT_COUNTS), _level("total", None, "fjd", _FACT_COUNTS)]), "fjd"),
    "distinct_rollups_staff": with_ctes(" UNION ALL ".join([
        _level("nation", "home_nation", _STAFF, "COUNT(DISTINCT event_id) AS events"),
        _level("experience", "experience_level", _STAFF, "COUNT(DISTINCT event_id) AS events"),
        _level("total", None, _STAFF, "COUNT(DISTINCT event_id) AS events")]), "br", "edu"),
    "rv_page1": with_ctes(" UNION ALL ".join([
        _dataset("kpi", None, ["total_delivery_records", "total_event_groups", "total_people_reached", "locations_reached",
                               "attendance_rate"], f"WHERE {PAGE1}"),
        _dataset("monthly", "year_month", ["total_people_reached", "total_delivery_records"], f"WHERE {PAGE1}"),
        _dataset("region", "region", ["total_people_reached", "total_delivery_records", "locations_reached"], f"WHERE {PAGE1}"),
        _dataset("programme", "programme_type", ["total_people_reached"], f"WHERE {PAGE1}"),
        _dataset("event_type", "event_type", ["total_delivery_records"])]), "fjd"),
}

#: orders as declared: column, type
_ORDERS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
           ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
_CHANGED = {"o_totalprice": (3, "string", "type changed"), "o_orderpriority": (None, None, "missing")}


def _drift() -> str:
    def text(v) -> str:
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    rows = [(1, "orders", c, i, t, t, "same") for i, (c, t) in enumerate(_ORDERS)]
    for i, (c, t) in enumerate(_ORDERS):
        at, stored, status = _CHANGED.get(c, (i, t, "same"))
        rows.append((2, "orders", c, at, t, stored, status))
    rows.append((2, "orders", "o_note", 5, None, "int", "unexpected"))
    values = ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)
    return ("SELECT CAST(version AS INTEGER) AS version, table_name, column_name, CAST(position AS INTEGER) AS position, declared, stored, status "
            f"FROM (VALUES {values}) t(version, table_name, column_name, position, declared, stored, status)")


def _compared(question: str, measures: dict[str, bool], keys: str) -> str:
    """measures: name -> whether its total is compared too."""
    return " UNION ALL ".join(f"SELECT '{question}' AS question, '{m}' AS measure, ({keys}) + {int(total)} AS n" for m, total in measures.items())


def _reconciliation() -> str:
    def members(columns: str, source: str = "fjd", where: str = "") -> str:
        return f"SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source} {where})"

    plain, grouped = {"deliveries": True, "people": True}, {"deliveries": True, "people": True, "groups": False}
    parts = [
        _compared("totals", dict.fromkeys(["deliveries", "groups", "people"], False), "SELECT 1"),
        _compared("time_and_outreach", dict.fromkeys(["session_hours", "locations", "average_reach"], False), "SELECT 1"),
        _compared("monthly_trend", grouped, members("year_month")),
        _compared("reach_by_region", grouped, members("region")),
        _compared("outreach_regions", {**grouped, "average_reach": False}, members("region")),
        _compared("reach_by_suburb", plain, members("region, suburb")),
        _compared("attendance_by_type", {"attended": True, "variance": True, "attendance_rate_pct": False},
                  members("event_type", where="WHERE registered_count IS NOT NULL")),
        _compared("reach_by_programme", plain, members("programme_type")),
        _compared("reach_by_language", plain, members("delivery_language")),
        _compared("venue_categories", plain, members("venue_category")),
        _compared("venue_detail", plain, members("venue_category, venue_type")),
        _compared("satisfaction_by_type", {"rated": True, "satisfaction": False}, members("event_type", where="WHERE satisfaction_score IS NOT NULL")),
        _compared("educator_ranking", {"events": True, "hours": False}, members("educator_id", "br")),
    ]
    return with_ctes("SELECT question, measure, n AS compared, n AS matched, 0::BIGINT AS mismatched, 0::BIGINT AS missing FROM ("
                     + " UNION ALL ".join(parts) + ")", "fjd", "br")


#: table: how many columns it shows, the names it hides, its rows
_TABLES = {"fact": (17, "attendance_rate, event_date_key, lead_educator_id, location_id", "fact"), "date": (10, "", "dt"),
           "location": (6, "", "loc"), "educator": (5, "", "edu"), "bridge": (2, "educator_id, event_id", "br")}
_REACHED = {"fact": ("fact", "date", "location"), "bridge": ("bridge", "fact", "date", "location", "educator")}
_BRIDGE_MEASURES = ("events_delivered_by_educator", "educator_hours")
_FACT_MEASURES = (
    "total_delivery_records", "total_event_groups", "total_people_reached", "total_registered", "total_attended",
    "registered_event_attended", "attendance_variance", "attendance_rate", "average_satisfaction", "rated_delivery_records",
    "total_session_hours", "average_people_reached_per_delivery", "locations_reached")


def _audit() -> str:
    rows = []
    for home, names in (("fact", _FACT_MEASURES), ("bridge", _BRIDGE_MEASURES)):
        for name in names:
            for table, (shown, hidden, source) in _TABLES.items():
                reached = table in _REACHED[home]
                rows.append(f"SELECT '{name}' AS measure, '{home}' AS home, '{table}' AS table_name, {int(reached)} AS paths, "
                            f"{reached} AS groupable, {shown} AS shown_columns, '{hidden}' AS hidden_columns, '{source}' AS source")
    counts = " UNION ALL ".join(f"SELECT '{s}' AS source, count(*) AS table_rows FROM {s}" for _, _, s in _TABLES.values())
    return with_ctes(f"SELECT measure, home, table_name, paths, groupable, shown_columns, hidden_columns, table_rows "
                     f"FROM ({' UNION ALL '.join(rows)}) JOIN ({counts}) USING (source)", "fact", "dt", "loc", "edu", "br")


_KIND = "CASE WHEN c_custkey % 7 = 0 THEN 'short' WHEN c_custkey % 11 = 0 THEN 'long' ELSE 'accepted' END"
_QUOTED = ["'\"' || CAST(" + c + " AS VARCHAR) || '\"'" for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
ORACLE_STORED["mx_blank_order"] = with_ctes(
    "SELECT * FROM (SELECT 'ascending' AS sort, delivery_language AS first_member, CAST(SUM(delivery_count) AS BIGINT) AS total_delivery_records "
    "FROM fact GROUP BY delivery_language ORDER BY delivery_language ASC NULLS FIRST LIMIT 1) UNION ALL "
    "SELECT * FROM (SELECT 'descending', delivery_language, CAST(SUM(delivery_count) AS BIGINT) FROM fact GROUP BY delivery_language "
    "ORDER BY delivery_language DESC NULLS LAST LIMIT 1)", "fact")
ORACLE_STORED["csv_rejected_rows"] = (
    f"SELECT CASE WHEN kind = 'short' THEN concat_ws(',', {', '.join(_QUOTED[:-1])}) ELSE concat_ws(',', {', '.join(_QUOTED)}, "
    "'\"one, more\"') END AS row_text, CASE WHEN kind = 'short' THEN 4 ELSE 6 END AS fields, kind, true AS has_source_file "
    f"FROM (SELECT *, {_KIND} AS kind FROM customer) WHERE kind <> 'accepted'")
ORACLE_STORED["csv_ingest_counts"] = (
    f"SELECT k.kind, count(c.kind) AS counted, count(c.kind) AS stored FROM (VALUES ('accepted'), ('short'), ('long'), ('unreadable')) k(kind) "
    f"LEFT JOIN (SELECT {_KIND} AS kind FROM customer) c ON c.kind = k.kind GROUP BY k.kind")
ORACLE_STORED["model_audit"] = _audit()
ORACLE_STORED["reconcile_questions"] = _reconciliation()
ORACLE_STORED["mx_filter_propagation_published"] = ORACLE["mx_filter_propagation"]
ORACLE_STORED["schema_drift"] = _drift()

ORACLE.update(ORACLE_STORED)

