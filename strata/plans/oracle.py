"""Independent DuckDB SQL for every registered query (the correctness oracle).

The stand-in mapping is restated here in plain SQL (CTEs below); nothing is
generated from the Spark code. Sums of integers are cast to BIGINT (DuckDB
widens to HUGEINT), calendar parts to INTEGER, and doubles that are sums of
fractional values are rounded to 6 decimals, as on the Spark side.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "li": ((), """
li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, l_shipdate
  FROM lineitem
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate NULLS FIRST, l_suppkey NULLS FIRST, l_partkey NULLS FIRST, l_quantity NULLS FIRST,
             l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST,
             l_linestatus NULLS FIRST) = 1)"""),
    "ord": ((), """
ord AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM (
    SELECT o_orderkey, o_custkey, NULLIF(TRIM(o_orderstatus), '') AS o_orderstatus, o_totalprice, o_orderdate,
           CASE WHEN NULLIF(TRIM(o_orderpriority), '') = '4-NOT SPECIFIED' THEN 'Unspecified'
                ELSE NULLIF(TRIM(o_orderpriority), '') END AS o_orderpriority
    FROM orders)
  QUALIFY row_number() OVER (
    PARTITION BY o_orderkey
    ORDER BY o_custkey NULLS FIRST, o_orderstatus NULLS FIRST, o_totalprice NULLS FIRST,
             o_orderdate NULLS FIRST, o_orderpriority NULLS FIRST) = 1)"""),
    "roll": (("li",), """
roll AS (
  SELECT l_orderkey,
         CAST(SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS INTEGER) AS registered_count,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS INTEGER) AS attended_count,
         CAST(SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS INTEGER) AS engaged_people_count,
         CAST(COUNT(*) * 25 AS INTEGER) AS session_duration_minutes,
         ROUND(1.0::DOUBLE + 40.0::DOUBLE * MAX(CASE WHEN l_linestatus = 'F' THEN l_discount END), 2)
           AS satisfaction_score,
         arg_min(l_suppkey, l_linenumber) AS lead_educator_id,
         CASE WHEN COUNT(*) FILTER (WHERE l_returnflag = 'A') > 0 THEN 'A'
              WHEN COUNT(*) FILTER (WHERE l_returnflag = 'N') > 0 THEN 'N'
              WHEN COUNT(*) FILTER (WHERE l_returnflag = 'R') > 0 THEN 'R' END AS delivery_language
  FROM li GROUP BY l_orderkey)"""),
    "fact": (("ord", "roll"), """
fact AS (
  SELECT o.o_orderkey AS event_id,
         CAST(o.o_custkey AS VARCHAR) || '-' || CAST(year(o.o_orderdate) AS VARCHAR) AS event_group_id,
         CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER)
           AS event_date_key,
         CAST(o.o_orderdate AS DATE) AS event_date,
         o.o_custkey AS location_id,
         r.lead_educator_id,
         'Order ' || CAST(o.o_orderkey AS VARCHAR) AS event_name,
         o.o_orderpriority AS event_type,
         o.o_orderstatus AS programme_type,
         r.delivery_language,
         r.registered_count IS NOT NULL AS registration_required,
         r.registered_count,
         r.attended_count,
         CASE WHEN r.registered_count IS NOT NULL AND r.attended_count IS NOT NULL
              THEN r.attended_count - r.registered_count END AS attendance_variance,
         CASE WHEN r.registered_count IS NOT NULL AND r.registered_count > 0 AND r.attended_count IS NOT NULL
              THEN ROUND(r.attended_count::DOUBLE / r.registered_count::DOUBLE, 4) END AS attendance_rate,
         r.engaged_people_count,
         COALESCE(r.engaged_people_count, r.attended_count, 0) AS people_reached,
         r.session_duration_minutes,
         ROUND(r.session_duration_minutes / 60.0::DOUBLE, 2) AS session_duration_hours,
         r.satisfaction_score,
         1 AS delivery_count
  FROM ord o LEFT JOIN roll r ON r.l_orderkey = o.o_orderkey)"""),
    "loc": ((), """
loc AS (
  SELECT c.c_custkey AS location_id, c.c_name AS venue_name, n.n_name AS suburb, r.r_name AS region,
         c.c_mktsegment AS venue_type,
         CASE WHEN c.c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'HOME' ELSE c.c_mktsegment END
           AS venue_category
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  QUALIFY row_number() OVER (
    PARTITION BY c.c_custkey
    ORDER BY c.c_name NULLS FIRST, n.n_name NULLS FIRST, r.r_name NULLS FIRST, c.c_mktsegment NULLS FIRST) = 1)"""),
    "edu": ((), """
edu AS (
  SELECT s.s_suppkey AS educator_id, s.s_name AS educator_name, n.n_name AS home_nation,
         CASE WHEN s.s_acctbal >= 5000 THEN 'Senior' WHEN s.s_acctbal >= 0 THEN 'Intermediate'
              ELSE 'Junior' END AS experience_level,
         s.s_acctbal > 0 AS active_status
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  QUALIFY row_number() OVER (PARTITION BY s.s_suppkey ORDER BY s.s_name NULLS FIRST, n.n_name NULLS FIRST) = 1)"""),
    "br": (("li",), """
br AS (
  SELECT l_orderkey AS event_id, l_suppkey AS educator_id, SUM(l_quantity) AS hours_worked,
         CAST(COUNT(*) AS INTEGER) AS assigned_lines
  FROM li GROUP BY l_orderkey, l_suppkey)"""),
    "dt": (("fact",), """
days AS (
  SELECT CAST(generate_series AS DATE) AS d
  FROM generate_series((SELECT MIN(event_date) FROM fact)::TIMESTAMP,
                       (SELECT MAX(event_date) FROM fact)::TIMESTAMP, INTERVAL 1 DAY)),
dt AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
         'Q' || CAST(quarter(d) AS VARCHAR) AS quarter, CAST(month(d) AS INTEGER) AS month_number,
         monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
         dayname(d) AS day_name
  FROM days)"""),
    "dirty": ((), """
dirty AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN '  '
              ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '  ' || o_orderstatus || ' ' END AS status,
         ' ' || o_orderpriority AS priority,
         CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE ' ' || CAST(o_custkey AS VARCHAR) || ' ' END AS customer_id,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
         CASE WHEN o_orderstatus = 'F' THEN 'TRUE' WHEN o_orderstatus = 'O' THEN 'false' ELSE 'maybe' END
           AS is_final,
         o_orderkey AS source_key
  FROM orders)"""),
    "cln": (("dirty",), """
cln AS (
  SELECT source_key,
         NULLIF(TRIM(order_id), '') AS order_id,
         NULLIF(TRIM(status), '') AS status,
         CASE WHEN NULLIF(TRIM(priority), '') = '4-NOT SPECIFIED' THEN 'Unspecified'
              ELSE NULLIF(TRIM(priority), '') END AS priority
  FROM dirty)"""),
    "typed": (("dirty",), """
typed AS (
  SELECT source_key,
         TRY_CAST(NULLIF(TRIM(order_id), '') AS BIGINT) AS order_id,
         TRY_CAST(NULLIF(TRIM(customer_id), '') AS INTEGER) AS customer_id,
         TRY_CAST(NULLIF(TRIM(order_date), '') AS DATE) AS order_date,
         TRY_CAST(NULLIF(TRIM(is_final), '') AS BOOLEAN) AS is_final,
         NULLIF(TRIM(status), '') AS status,
         CASE WHEN NULLIF(TRIM(priority), '') = '4-NOT SPECIFIED' THEN 'Unspecified'
              ELSE NULLIF(TRIM(priority), '') END AS priority
  FROM dirty)"""),
    "fj": (("fact", "loc"), """
fj AS (
  SELECT f.*, l.region, l.suburb, l.venue_type, l.venue_category
  FROM fact f LEFT JOIN loc l ON f.location_id = l.location_id)"""),
    "fjd": (("fj", "dt"), """
fjd AS (
  SELECT f.*, d.year_month, d.month_name, d.month_number
  FROM fj f LEFT JOIN dt d ON f.event_date_key = d.date_key)"""),
}


def with_ctes(body: str, *names: str) -> str:
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in CTES[n][0]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",".join(CTES[n][1] for n in ordered) + "\n" + body


def _check_row(layer: str, name: str, kind: str, table: str, observed_sql: str, expected: str = "0",
               severity: str = "error") -> str:
    return (f"SELECT '{layer}' AS layer, '{name}' AS check_name, '{kind}' AS check_kind, '{table}' AS table_name, "
            f"CAST(({observed_sql}) AS BIGINT) AS observed, CAST(({expected}) AS BIGINT) AS expected, "
            f"CAST(abs(({observed_sql}) - ({expected})) AS BIGINT) AS violations, "
            f"({observed_sql}) = ({expected}) AS passed, "
            f"'{severity}' AS severity")


# Measure expressions over fact rows f (fact joined to its dimensions).
M = {
    "total_delivery_records": "CAST(SUM(delivery_count) AS BIGINT)",
    "total_event_groups": "NULLIF(COUNT(DISTINCT event_group_id) + MAX(CASE WHEN event_group_id IS NULL THEN 1 ELSE 0 END), 0)",
    "total_people_reached": "CAST(SUM(people_reached) AS BIGINT)",
    "total_registered": "CAST(SUM(registered_count) AS BIGINT)",
    "total_attended": "CAST(SUM(attended_count) AS BIGINT)",
    "registered_event_attended":
        "CAST(SUM(CASE WHEN registered_count IS NOT NULL AND registered_count <> 0 THEN attended_count END) AS BIGINT)",
    "average_satisfaction": "ROUND(AVG(satisfaction_score), 6)",
    "rated_delivery_records":
        "CAST(SUM(CASE WHEN satisfaction_score IS NOT NULL AND satisfaction_score <> 0 THEN delivery_count END) AS BIGINT)",
    "total_session_hours": "ROUND(SUM(session_duration_hours), 6)",
    "locations_reached": "NULLIF(COUNT(DISTINCT location_id) + MAX(CASE WHEN location_id IS NULL THEN 1 ELSE 0 END), 0)",
}


def _variance(a: str, b: str) -> str:
    return f"CASE WHEN ({a}) IS NULL AND ({b}) IS NULL THEN NULL ELSE COALESCE({a}, 0) - COALESCE({b}, 0) END"


def _divide(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN NULL ELSE ({a})::DOUBLE / ({b})::DOUBLE END"


M["attendance_variance"] = _variance(M["registered_event_attended"], M["total_registered"])
M["attendance_rate"] = _divide(M["registered_event_attended"], M["total_registered"])
M["average_people_reached_per_delivery"] = _divide(M["total_people_reached"], M["total_delivery_records"])


def measures(*names: str) -> str:
    return ", ".join(f"{M[n]} AS {n}" for n in names)


def not_all_blank(*names: str) -> str:
    return "HAVING " + " OR ".join(f"({M[n]}) IS NOT NULL" for n in names)


FACT_MEASURES = ["total_delivery_records", "total_event_groups", "total_people_reached", "total_registered",
                 "total_attended", "registered_event_attended", "attendance_variance", "attendance_rate",
                 "average_satisfaction", "rated_delivery_records", "total_session_hours",
                 "average_people_reached_per_delivery", "locations_reached"]

MONTHS = "('March', 'April', 'May')"
EVENT_TYPES = "('1-URGENT', '2-HIGH', 'Unspecified')"
REGIONS = "('AMERICA', 'ASIA', 'EUROPE')"
PROGRAMMES = "('F', 'O')"
PAGE1 = f"month_name IN {MONTHS} AND event_type IN {EVENT_TYPES} AND region IN {REGIONS}"
PAGE2 = f"month_name IN {MONTHS} AND event_type IN {EVENT_TYPES} AND programme_type IN {PROGRAMMES}"

FK_ROWS = [
    ("lineitem_l_suppkey_fk_supplier", "foreign_key", "lineitem",
     "SELECT COUNT(*) FROM (SELECT DISTINCT l_suppkey + 5 AS k FROM lineitem) c "
     "WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c.k)"),
    ("lineitem_l_suppkey_fk_supplier", "foreign_key_rows", "lineitem",
     "SELECT COUNT(*) FROM lineitem c WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c.l_suppkey + 5)"),
    ("orders_o_custkey_fk_customer", "foreign_key", "orders",
     "SELECT COUNT(*) FROM (SELECT DISTINCT o_custkey + 7 AS k FROM orders) c "
     "WHERE NOT EXISTS (SELECT 1 FROM customer x WHERE x.c_custkey = c.k)"),
    ("fact_lead_educator_id_fk_educator", "foreign_key", "fact",
     "SELECT COUNT(*) FROM (SELECT DISTINCT lead_educator_id + 3 AS k FROM fact) c "
     "WHERE NOT EXISTS (SELECT 1 FROM edu e WHERE e.educator_id = c.k)"),
]

GOLD_CHECKS = [
    ("fact_event_id_unique", "unique", "fact",
     "SELECT COUNT(*) FROM (SELECT event_id FROM fact GROUP BY event_id HAVING COUNT(*) > 1)", "0"),
    ("bridge_event_id_educator_id_unique", "unique", "bridge",
     "SELECT COUNT(*) FROM (SELECT event_id, educator_id FROM br GROUP BY ALL HAVING COUNT(*) > 1)", "0"),
    ("location_location_id_unique", "unique", "location",
     "SELECT COUNT(*) FROM (SELECT location_id FROM loc GROUP BY ALL HAVING COUNT(*) > 1)", "0"),
    ("educator_educator_id_unique", "unique", "educator",
     "SELECT COUNT(*) FROM (SELECT educator_id FROM edu GROUP BY ALL HAVING COUNT(*) > 1)", "0"),
    ("date_date_key_unique", "unique", "date",
     "SELECT COUNT(*) FROM (SELECT date_key FROM dt GROUP BY ALL HAVING COUNT(*) > 1)", "0"),
    ("fact_event_id_not_null", "not_null", "fact", "SELECT COUNT(*) FROM fact WHERE event_id IS NULL", "0"),
    ("fact_event_group_id_not_null", "not_null", "fact",
     "SELECT COUNT(*) FROM fact WHERE event_group_id IS NULL", "0"),
    ("fact_location_id_fk_location", "foreign_key", "fact",
     "SELECT COUNT(*) FROM (SELECT DISTINCT location_id FROM fact) c "
     "WHERE NOT EXISTS (SELECT 1 FROM loc l WHERE l.location_id = c.location_id)", "0"),
    ("fact_event_date_key_fk_date", "foreign_key", "fact",
     "SELECT COUNT(*) FROM (SELECT DISTINCT event_date_key FROM fact) c "
     "WHERE NOT EXISTS (SELECT 1 FROM dt d WHERE d.date_key = c.event_date_key)", "0"),
    ("bridge_event_id_fk_fact", "foreign_key", "bridge",
     "SELECT COUNT(*) FROM (SELECT DISTINCT event_id FROM br) c "
     "WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.event_id = c.event_id)", "0"),
    ("bridge_educator_id_fk_educator", "foreign_key", "bridge",
     "SELECT COUNT(*) FROM (SELECT DISTINCT educator_id FROM br) c "
     "WHERE NOT EXISTS (SELECT 1 FROM edu e WHERE e.educator_id = c.educator_id)", "0"),
    ("fact_event_has_educator", "coverage", "fact",
     "SELECT COUNT(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM br b WHERE b.event_id = f.event_id)", "0"),
    ("fact_satisfaction_score_in_range", "in_range", "fact",
     "SELECT COUNT(*) FROM fact WHERE satisfaction_score IS NOT NULL AND NOT (satisfaction_score BETWEEN 1 AND 5)",
     "0"),
]


SILVER_CHECKS = [
    ("lineitem_l_orderkey_l_linenumber_unique", "unique", "lineitem",
     "SELECT COUNT(*) FROM (SELECT l_orderkey, l_linenumber FROM li GROUP BY ALL HAVING COUNT(*) > 1)", "0"),
    ("orders_o_orderkey_unique", "unique", "orders",
     "SELECT COUNT(*) FROM (SELECT o_orderkey FROM ord GROUP BY ALL HAVING COUNT(*) > 1)", "0"),
    ("orders_o_orderkey_not_null", "not_null", "orders", "SELECT COUNT(*) FROM ord WHERE o_orderkey IS NULL", "0"),
    ("orders_o_custkey_fk_locations", "foreign_key", "orders",
     "SELECT COUNT(*) FROM (SELECT DISTINCT o_custkey FROM ord) c "
     "WHERE NOT EXISTS (SELECT 1 FROM customer x WHERE x.c_custkey = c.o_custkey)", "0"),
    ("lineitem_l_orderkey_fk_orders", "foreign_key_rows", "lineitem",
     "SELECT COUNT(*) FROM li c WHERE NOT EXISTS (SELECT 1 FROM ord o WHERE o.o_orderkey = c.l_orderkey)", "0"),
    ("lineitem_l_suppkey_fk_educators", "foreign_key", "lineitem",
     "SELECT COUNT(*) FROM (SELECT DISTINCT l_suppkey FROM li) c "
     "WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c.l_suppkey)", "0"),
]


def _layered_checks() -> str:
    rows = [_check_row("silver", n, k, t, sql, exp) for n, k, t, sql, exp in SILVER_CHECKS]
    rows += [_check_row("gold", n, k, t, sql, exp, "warning" if n == "fact_event_has_educator" else "error")
             for n, k, t, sql, exp in GOLD_CHECKS]
    return " UNION ALL ".join(rows)


def _layered_counts() -> str:
    parts = [("silver_lineitem", "li"), ("silver_orders", "ord"), ("silver_locations", "customer"),
             ("silver_educators", "supplier"), ("gold_fact", "fact"), ("gold_date", "dt"), ("gold_location", "loc"),
             ("gold_educator", "edu"), ("gold_bridge", "br")]
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {t}" for n, t in parts)


def _suburbs() -> str:
    return (f"SELECT region, suburb, {measures('total_delivery_records', 'total_people_reached', 'average_people_reached_per_delivery', 'locations_reached')} "
            f"FROM fj GROUP BY region, suburb")


def _coverage_row() -> str:
    distinct_blank = "COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
    return (
        "SELECT (SELECT COUNT(*) FROM fact) AS fact_delivery_records, "
        f"(SELECT CAST({distinct_blank.format(c='event_id')} AS BIGINT) FROM fact) AS distinct_event_ids, "
        f"(SELECT CAST({distinct_blank.format(c='event_group_id')} AS BIGINT) FROM fact) AS distinct_event_groups, "
        "(SELECT COUNT(*) FROM dt) AS date_rows, (SELECT COUNT(*) FROM loc) AS location_rows, "
        "(SELECT COUNT(*) FROM edu) AS educator_rows, (SELECT COUNT(*) FROM br) AS bridge_assignments, "
        f"(SELECT CAST({distinct_blank.format(c='event_id')} AS BIGINT) FROM br) AS distinct_staffed_event_ids, "
        "(SELECT COUNT(*) FROM (SELECT event_id FROM fact EXCEPT SELECT event_id FROM br)) AS events_without_educators"
    )


def _row_counts() -> str:
    parts = [("bronze_lineitem", "lineitem"), ("silver_lineitem", "li"), ("bronze_orders", "orders"),
             ("silver_orders", "ord"), ("gold_fact_event_delivery", "fact"), ("gold_dim_date", "dt"),
             ("gold_dim_location", "loc"), ("gold_dim_educator", "edu"), ("gold_bridge_event_educator", "br")]
    sql = " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {t}" for n, t in parts)
    return sql + (" UNION ALL SELECT 'gold_fact_event_delivery.delivery_language_members' AS table_name, "
                  "COUNT(*) AS row_count FROM (SELECT DISTINCT delivery_language FROM fact)")


ORACLE: dict[str, str] = {
    # step 1
    "dedup_by_key": with_ctes("SELECT * FROM li", "li"),
    "clean_text": with_ctes("SELECT source_key, order_id, status, priority FROM cln", "cln"),
    "clean_trim_only": with_ctes(
        "SELECT source_key, TRIM(order_id) AS order_id, TRIM(status) AS status, TRIM(priority) AS priority "
        "FROM dirty", "dirty"),
    "typed_cast": with_ctes(
        "SELECT source_key, order_id, customer_id, order_date, is_final, status, priority FROM typed", "typed"),
    "csv_ingest_roundtrip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, "
                            "true AS has_source_file, true AS has_ingestion_timestamp FROM customer",
    "constant_and_alias": "SELECT c_custkey AS location_id, c_name AS venue_name, 1 AS delivery_count, "
                          "'Customer' AS entity_kind FROM customer",
    "filter_contains": "SELECT p_partkey, p_name, p_brand FROM part WHERE p_name LIKE '%gear%'",
    "filter_isin": with_ctes("SELECT * FROM loc WHERE venue_type IN ('HOUSEHOLD', 'FURNITURE')", "loc"),
    "filter_null": with_ctes("SELECT event_id, event_type, attended_count FROM fact WHERE registered_count IS NULL",
                             "fact"),
    "filter_out_of_range": with_ctes(
        "SELECT event_id, attendance_rate FROM fact "
        "WHERE attendance_rate IS NOT NULL AND NOT (attendance_rate BETWEEN 0 AND 1)", "fact"),
    # step 2
    "dim_location": with_ctes("SELECT * FROM loc", "loc"),
    "dim_educator": with_ctes("SELECT * FROM edu", "edu"),
    "dim_date": with_ctes("SELECT * FROM dt", "dt"),
    "bridge_event_educator": with_ctes("SELECT * FROM br", "br"),
    "fact_event_delivery": with_ctes("SELECT * FROM fact", "fact"),
    # step 3
    "dq_row_counts": with_ctes(_row_counts(), "li", "ord", "fact", "dt", "loc", "edu", "br"),
    "dq_duplicate_keys": with_ctes(
        "SELECT order_id, COUNT(*) AS record_count FROM cln GROUP BY order_id HAVING COUNT(*) > 1", "cln"),
    "dq_duplicate_composite":
        "SELECT l_orderkey, l_linenumber, COUNT(*) AS record_count FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1",
    "dq_null_keys": with_ctes(" UNION ALL ".join([
        _check_row("silver", "orders_typed_order_id_not_null", "not_null", "orders_typed",
                   "SELECT COUNT(*) FROM typed WHERE order_id IS NULL"),
        _check_row("silver", "orders_typed_customer_id_not_null", "not_null", "orders_typed",
                   "SELECT COUNT(*) FROM typed WHERE customer_id IS NULL"),
        _check_row("silver", "orders_typed_is_final_not_null", "not_null", "orders_typed",
                   "SELECT COUNT(*) FROM typed WHERE is_final IS NULL"),
        _check_row("silver", "fact_event_id_not_null", "not_null", "fact",
                   "SELECT COUNT(*) FROM fact WHERE event_id IS NULL"),
    ]), "typed", "fact"),
    "dq_orphans_distinct":
        "SELECT DISTINCT l_suppkey + 5 AS l_suppkey FROM lineitem c "
        "WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c.l_suppkey + 5)",
    "dq_orphans_rows":
        "SELECT l_suppkey + 5 AS l_suppkey, COUNT(*) AS orphan_rows FROM lineitem c "
        "WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c.l_suppkey + 5) GROUP BY 1",
    "dq_orphans_renamed":
        "SELECT DISTINCT o_custkey + 7 AS o_custkey FROM orders o "
        "WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey + 7)",
    "dq_orphans_expr": with_ctes(
        "SELECT event_id, lead_educator_id + 3 AS lead_educator_id FROM fact f "
        "WHERE NOT EXISTS (SELECT 1 FROM edu e WHERE e.educator_id = f.lead_educator_id + 3)", "fact", "edu"),
    "dq_uncovered_parents": with_ctes(
        "SELECT event_id FROM fact f WHERE NOT EXISTS (SELECT 1 FROM br b WHERE b.event_id = f.event_id)",
        "fact", "br"),
    "dq_uncovered_except": with_ctes("SELECT event_id FROM fact EXCEPT SELECT event_id FROM br", "fact", "br"),
    "dq_out_of_range": with_ctes(" UNION ALL ".join([
        _check_row("gold", "fact_satisfaction_score_in_range", "in_range", "fact",
                   "SELECT COUNT(*) FROM fact WHERE satisfaction_score IS NOT NULL "
                   "AND NOT (satisfaction_score BETWEEN 1 AND 5)"),
        _check_row("gold", "fact_attendance_rate_in_range", "in_range", "fact",
                   "SELECT COUNT(*) FROM fact WHERE attendance_rate IS NOT NULL "
                   "AND NOT (attendance_rate BETWEEN 0 AND 1)", severity="warning"),
    ]), "fact"),
    "dq_fk_total": with_ctes(
        "SELECT CAST(" + " + ".join(f"({sql})" for _, _, _, sql in FK_ROWS) + " AS BIGINT) AS total_violations",
        "fact", "edu"),
    "dq_summary": with_ctes(" UNION ALL ".join(
        _check_row("gold", n, k, t, sql, exp) for n, k, t, sql, exp in GOLD_CHECKS), "fact", "br", "loc", "edu", "dt"),
    "staffing_summary": with_ctes(
        "SELECT f.event_id, f.event_name, f.event_date, f.event_type, f.programme_type, s.educator_count FROM fact f LEFT JOIN "
        "(SELECT event_id, COUNT(educator_id) AS educator_count FROM br GROUP BY event_id) s "
        "ON f.event_id = s.event_id", "fact", "br"),
    # step 4
    "bq_totals": with_ctes(
        "SELECT COUNT(*) AS delivery_records, COUNT(DISTINCT event_group_id) AS event_groups, "
        "CAST(SUM(people_reached) AS BIGINT) AS total_people_reached FROM fact", "fact"),
    "bq_monthly_trend": with_ctes(
        "SELECT d.year_month, COUNT(*) AS delivery_records, COUNT(DISTINCT f.event_group_id) AS event_groups, "
        "CAST(SUM(f.people_reached) AS BIGINT) AS people_reached "
        "FROM fact f JOIN dt d ON f.event_date_key = d.date_key GROUP BY d.year_month", "fact", "dt"),
    "bq_reach_by_region": with_ctes(
        "SELECT l.region, COUNT(*) AS delivery_records, COUNT(DISTINCT f.event_group_id) AS event_groups, "
        "CAST(SUM(f.people_reached) AS BIGINT) AS people_reached "
        "FROM fact f JOIN loc l ON f.location_id = l.location_id GROUP BY l.region", "fact", "loc"),
    "bq_reach_by_suburb": with_ctes(_suburbs(), "fj"),
    "bq_attendance_by_type": with_ctes(
        "SELECT event_type, COUNT(*) AS registered_events, CAST(SUM(attended_count) AS BIGINT) AS total_attended, "
        "CAST(SUM(attended_count) - SUM(registered_count) AS BIGINT) AS attendance_variance, "
        "ROUND(100.0::DOUBLE * SUM(attended_count)::DOUBLE / NULLIF(SUM(registered_count), 0)::DOUBLE, 1) "
        "AS attendance_rate_pct FROM fact WHERE registered_count IS NOT NULL GROUP BY event_type", "fact"),
    "bq_reach_by_programme": with_ctes(
        "SELECT programme_type, COUNT(*) AS delivery_records, CAST(SUM(people_reached) AS BIGINT) AS people_reached "
        "FROM fact GROUP BY programme_type", "fact"),
    "bq_reach_by_language": with_ctes(
        "SELECT delivery_language, COUNT(*) AS delivery_records, "
        "CAST(SUM(people_reached) AS BIGINT) AS people_reached FROM fact GROUP BY delivery_language", "fact"),
    "bq_venue_category": with_ctes(
        "SELECT l.venue_category, COUNT(*) AS delivery_records, CAST(SUM(f.people_reached) AS BIGINT) AS people_reached "
        "FROM fact f JOIN loc l ON f.location_id = l.location_id GROUP BY l.venue_category", "fact", "loc"),
    "bq_venue_detail": with_ctes(
        f"SELECT venue_category, venue_type, {measures('total_delivery_records', 'total_people_reached')} "
        "FROM fj GROUP BY venue_category, venue_type", "fj"),
    "bq_satisfaction_by_type": with_ctes(
        "SELECT event_type, COUNT(satisfaction_score) AS rated_events, "
        "ROUND(AVG(satisfaction_score), 2) AS avg_satisfaction_score FROM fact "
        "WHERE satisfaction_score IS NOT NULL GROUP BY event_type", "fact"),
    "bq_educator_ranking": with_ctes(
        "SELECT e.educator_id, e.educator_name, e.experience_level, COUNT(DISTINCT b.event_id) AS events_delivered, "
        "ROUND(SUM(b.hours_worked), 1) AS total_hours FROM br b JOIN edu e ON b.educator_id = e.educator_id "
        "GROUP BY e.educator_id, e.educator_name, e.experience_level", "br", "edu"),
    "bq_outreach_regions": with_ctes(
        "SELECT l.region, COUNT(*) AS delivery_records, COUNT(DISTINCT f.event_group_id) AS event_groups, "
        "CAST(SUM(f.people_reached) AS BIGINT) AS people_reached, "
        "ROUND(SUM(f.people_reached)::DOUBLE / NULLIF(COUNT(*), 0)::DOUBLE, 1) AS avg_reach_per_delivery "
        "FROM fact f JOIN loc l ON f.location_id = l.location_id GROUP BY l.region", "fact", "loc"),
    "bq_outreach_suburbs_top10": with_ctes(
        f"SELECT * EXCLUDE (rk) FROM (SELECT s.*, rank() OVER (ORDER BY total_people_reached ASC NULLS FIRST, "
        f"total_delivery_records ASC NULLS FIRST, suburb ASC NULLS FIRST) AS rk FROM ({_suburbs()}) s) WHERE rk <= 10",
        "fj"),
    "bq_time_outreach": with_ctes(
        f"SELECT {measures('total_session_hours', 'average_people_reached_per_delivery', 'locations_reached')} "
        "FROM fact", "fact"),
    "bq_model_coverage": with_ctes(_coverage_row(), "fact", "dt", "loc", "edu", "br"),
    # step 5
    "mx_all_by_event_type": with_ctes(
        f"SELECT event_type, {measures(*FACT_MEASURES)} FROM fact GROUP BY event_type", "fact"),
    "mx_educator": with_ctes(
        "SELECT e.educator_name, "
        "NULLIF(COUNT(DISTINCT b.event_id) + MAX(CASE WHEN b.event_id IS NULL THEN 1 ELSE 0 END), 0) "
        "AS events_delivered_by_educator, SUM(b.hours_worked) AS educator_hours "
        "FROM br b LEFT JOIN edu e ON b.educator_id = e.educator_id GROUP BY e.educator_name", "br", "edu"),
    "mx_filtered_context": with_ctes(
        f"SELECT year_month, {measures('total_delivery_records', 'total_people_reached', 'attendance_rate')} "
        f"FROM fjd WHERE {PAGE1} GROUP BY year_month "
        f"{not_all_blank('total_delivery_records', 'total_people_reached', 'attendance_rate')}", "fjd"),
    "mx_filter_propagation": with_ctes(
        "SELECT e.experience_level, "
        "NULLIF(COUNT(DISTINCT b.event_id) + MAX(CASE WHEN b.event_id IS NULL THEN 1 ELSE 0 END), 0) "
        "AS events_delivered_by_educator, SUM(b.hours_worked) AS educator_hours "
        "FROM br b JOIN fj f ON b.event_id = f.event_id LEFT JOIN edu e ON b.educator_id = e.educator_id "
        "WHERE f.region IN ('ASIA') GROUP BY e.experience_level", "br", "fj", "edu"),
    "mx_filter_direction": with_ctes(
        f"SELECT (SELECT {M['total_delivery_records']} FROM fact) AS total_delivery_records, "
        f"(SELECT {M['total_people_reached']} FROM fact) AS total_people_reached, "
        "(SELECT NULLIF(COUNT(DISTINCT b.event_id) + MAX(CASE WHEN b.event_id IS NULL THEN 1 ELSE 0 END), 0) "
        " FROM br b JOIN edu e ON b.educator_id = e.educator_id WHERE e.experience_level IN ('Senior')) "
        "AS events_delivered_by_educator, "
        "(SELECT SUM(b.hours_worked) FROM br b JOIN edu e ON b.educator_id = e.educator_id "
        " WHERE e.experience_level IN ('Senior')) AS educator_hours", "fact", "br", "edu"),
    "mx_blank_member": with_ctes(
        f"SELECT region, {measures('total_delivery_records', 'total_people_reached', 'locations_reached')} "
        "FROM (SELECT f.*, l.region FROM (SELECT * REPLACE (location_id + 7 AS location_id) FROM fact) f "
        "LEFT JOIN loc l ON f.location_id = l.location_id) GROUP BY region", "fact", "loc"),
    "mx_drop_blank_groups": with_ctes(
        f"SELECT programme_type, delivery_language, {measures('average_satisfaction', 'rated_delivery_records')} "
        f"FROM fact GROUP BY programme_type, delivery_language "
        f"{not_all_blank('average_satisfaction', 'rated_delivery_records')}", "fact"),
    "mx_distinct_with_blank": with_ctes(
        f"SELECT programme_type, {measures('total_event_groups', 'total_delivery_records')} "
        "FROM (SELECT * REPLACE (CASE WHEN delivery_language IS NOT NULL THEN event_group_id END AS event_group_id) "
        "FROM fact) GROUP BY programme_type", "fact"),
    "mx_blank_arithmetic": with_ctes(
        f"SELECT event_type, delivery_language, "
        f"{measures('registered_event_attended', 'total_registered', 'attendance_variance', 'attendance_rate')} "
        "FROM fact GROUP BY event_type, delivery_language "
        f"{not_all_blank('registered_event_attended', 'total_registered', 'attendance_variance', 'attendance_rate')}",
        "fact"),
    "mx_month_name_sorted": with_ctes(
        f"SELECT month_number, month_name, {measures('total_delivery_records', 'total_people_reached')} "
        "FROM fjd GROUP BY month_number, month_name", "fjd"),
    "mx_calculate_override": with_ctes(
        "SELECT CAST(SUM(CASE WHEN registered_count > 100 THEN attended_count END) AS BIGINT) AS total_attended, "
        f"{M['registered_event_attended']} AS registered_event_attended, "
        "CAST(SUM(CASE WHEN registered_count > 100 THEN registered_count END) AS BIGINT) AS total_registered "
        "FROM fact", "fact"),
    "mx_display_formats": with_ctes(
        "SELECT CAST(CAST(ROUND(d::DOUBLE, 0) AS BIGINT) AS VARCHAR) AS total_delivery_records_text, "
        "format('{:,}', CAST(ROUND(p::DOUBLE, 0) AS BIGINT)) AS total_people_reached_text, "
        "CASE WHEN r IS NOT NULL THEN printf('%.1f%%', ROUND(r * 100, 1)) END AS attendance_rate_text, "
        "CASE WHEN s IS NOT NULL THEN printf('%.2f', ROUND(s, 2)) END AS average_satisfaction_text, "
        "CASE WHEN h IS NOT NULL THEN printf('%.1f', ROUND(h, 1)) END AS total_session_hours_text "
        f"FROM (SELECT {M['total_delivery_records']} AS d, {M['total_people_reached']} AS p, "
        f"{M['attendance_rate']} AS r, AVG(satisfaction_score) AS s, SUM(session_duration_hours) AS h FROM fact)",
        "fact"),
    "mx_events_monthly":
        "SELECT strftime(ts, '%Y-%m') AS year_month, event_type, COUNT(*) AS event_count, "
        "ROUND(SUM(value), 6) AS total_value, "
        "NULLIF(COUNT(DISTINCT user_id) + MAX(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END), 0) AS distinct_users, "
        "ROUND(AVG(value), 6) AS average_value FROM events GROUP BY ALL",
    # step 6
    "rv_kpi_overview": with_ctes(
        f"SELECT {measures('total_delivery_records', 'total_event_groups', 'total_people_reached', 'locations_reached', 'attendance_rate')} "
        f"FROM fjd WHERE {PAGE1}", "fjd"),
    "rv_monthly": with_ctes(
        f"SELECT year_month, {measures('total_people_reached', 'total_delivery_records')} FROM fjd "
        f"WHERE event_type IN {EVENT_TYPES} GROUP BY year_month", "fjd"),
    "rv_region": with_ctes(
        f"SELECT region, {measures('total_people_reached', 'total_delivery_records', 'locations_reached')} "
        f"FROM fjd WHERE month_name IN {MONTHS} GROUP BY region", "fjd"),
    "rv_programme": with_ctes(
        f"SELECT programme_type, {measures('total_people_reached')} FROM fjd WHERE {PAGE1} GROUP BY programme_type",
        "fjd"),
    "rv_kpi_attendance": with_ctes(
        f"SELECT {measures('total_registered', 'registered_event_attended', 'attendance_variance', 'attendance_rate', 'average_satisfaction')} "
        f"FROM fjd WHERE {PAGE2}", "fjd"),
    "rv_monthly_attendance": with_ctes(
        f"SELECT year_month, {measures('total_registered', 'registered_event_attended', 'attendance_rate')} "
        f"FROM fjd WHERE programme_type IN {PROGRAMMES} GROUP BY year_month "
        f"{not_all_blank('total_registered', 'registered_event_attended', 'attendance_rate')}", "fjd"),
    "rv_rate_by_type": with_ctes(
        f"SELECT event_type, {measures('attendance_rate', 'total_delivery_records', 'locations_reached')} "
        f"FROM fjd WHERE month_name IN {MONTHS} GROUP BY event_type", "fjd"),
    "rv_satisfaction_by_programme": with_ctes(
        f"SELECT programme_type, {measures('average_satisfaction')} FROM fjd "
        f"WHERE event_type IN {EVENT_TYPES} AND satisfaction_score IS NOT NULL GROUP BY programme_type "
        f"{not_all_blank('average_satisfaction')}", "fjd"),
    "rv_slicer_members": with_ctes(
        "SELECT DISTINCT 'date.month_name' AS slicer, month_name AS member, month_number AS sort_order FROM dt "
        "UNION ALL SELECT DISTINCT 'fact.event_type', event_type, CAST(NULL AS INTEGER) FROM fact "
        "WHERE event_type IS NOT NULL "
        "UNION ALL SELECT DISTINCT 'location.region', region, CAST(NULL AS INTEGER) FROM loc WHERE region IS NOT NULL "
        "UNION ALL SELECT DISTINCT 'fact.programme_type', programme_type, CAST(NULL AS INTEGER) FROM fact "
        "WHERE programme_type IS NOT NULL", "fact", "dt", "loc"),
    "layered_build_checks": with_ctes(_layered_checks(), "li", "ord", "fact", "br", "loc", "edu", "dt"),
    "layered_row_counts": with_ctes(_layered_counts(), "li", "ord", "fact", "br", "loc", "edu", "dt"),
    "reconcile_sql_vs_metrics": with_ctes(
        "SELECT COUNT(*) AS compared_rows, COUNT(*) AS matched, CAST(0 AS BIGINT) AS mismatched, "
        "CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right "
        "FROM (SELECT DISTINCT l.region FROM fact f JOIN loc l ON f.location_id = l.location_id)", "fact", "loc"),
}

# Questions asked in SQL text (plans/sql_questions.py), restated over the base CTEs.
ORACLE["sql_views_weekend_share"] = with_ctes(
    "SELECT l.venue_type, CAST(SUM(CASE WHEN dayofweek(f.event_date) IN (0, 6) THEN 1 ELSE 0 END) AS BIGINT) "
    "AS weekend_events, COUNT(*) AS events FROM fact f JOIN loc l ON l.location_id = f.location_id "
    "GROUP BY l.venue_type", "fact", "loc")
ORACLE["sql_views_staff_nations"] = with_ctes(
    "SELECT home_nation, COUNT(*) FILTER (WHERE active_status) AS active_staff, "
    "COUNT(*) FILTER (WHERE experience_level = 'Senior') AS seniors FROM edu GROUP BY home_nation "
    "HAVING COUNT(*) FILTER (WHERE active_status) > 0", "edu")
ORACLE["sql_catalog_quarter_growth"] = with_ctes(
    "SELECT year, quarter, events, events - lag(events) OVER (PARTITION BY quarter ORDER BY year) AS growth FROM "
    "(SELECT d.year, d.quarter, COUNT(f.event_id) AS events FROM dt d LEFT JOIN fact f ON f.event_date_key = d.date_key "
    "GROUP BY d.year, d.quarter)", "fact", "dt")

ORACLE["dq_expected_counts"] = with_ctes(" UNION ALL ".join([
    _check_row("gold", "fact_row_count", "row_count", "fact", "SELECT COUNT(*) FROM fact",
               "SELECT COUNT(DISTINCT o_orderkey) FROM orders"),
    _check_row("gold", "fact_event_group_id_distinct", "distinct_count", "fact",
               "SELECT COUNT(DISTINCT event_group_id) FROM fact", "SELECT COUNT(DISTINCT o_orderkey) FROM orders"),
]), "fact")
ORACLE["dq_gate_failures"] = with_ctes(
    "SELECT check_name, observed, expected FROM (" + _check_row(
        "gold", "fact_event_group_id_distinct", "distinct_count", "fact",
        "SELECT COUNT(DISTINCT event_group_id) FROM fact", "SELECT COUNT(DISTINCT o_orderkey) FROM orders")
    + ") WHERE NOT passed", "fact")
ORACLE["cast_rejects"] = with_ctes(
    "SELECT CAST(COUNT(*) FILTER (WHERE NULLIF(TRIM(customer_id), '') IS NOT NULL "
    "AND TRY_CAST(TRIM(customer_id) AS INTEGER) IS NULL) AS BIGINT) AS customer_id, "
    "CAST(COUNT(*) FILTER (WHERE NULLIF(TRIM(is_final), '') IS NOT NULL "
    "AND lower(TRIM(is_final)) NOT IN ('true', 'false')) AS BIGINT) AS is_final FROM dirty", "dirty")
ORACLE["staffing_drilldown"] = with_ctes(
    "SELECT f.event_id, f.event_date, f.event_name, s.educator_count FROM fact f LEFT JOIN "
    "(SELECT event_id, COUNT(educator_id) AS educator_count FROM br GROUP BY event_id) s "
    "ON f.event_id = s.event_id WHERE contains(f.event_name, '77')", "fact", "br")
ORACLE["fact_preview"] = with_ctes(
    "SELECT event_id, event_date, people_reached FROM fact ORDER BY event_date, event_id LIMIT 20", "fact")
ORACLE["audited_educators"] = with_ctes("SELECT educator_id, educator_name, true AS audited FROM edu", "edu")
# The model's validation queries: KPI rows and grouped summaries.
RATE_TEXT = ("CASE WHEN ({r}) IS NOT NULL THEN printf('%.1f%%', ROUND(({r}) * 100, 1)) END")
AVG_REACH = "average_people_reached_per_delivery"
ORACLE["mx_core_kpis"] = with_ctes(
    f"SELECT {measures('total_delivery_records', 'total_event_groups', 'total_people_reached', 'total_registered', 'total_attended')} FROM fact",
    "fact")
ORACLE["mx_attendance_kpis"] = with_ctes(
    f"SELECT {measures('total_registered', 'registered_event_attended', 'attendance_variance', 'attendance_rate')}, "
    f"{RATE_TEXT.format(r=M['attendance_rate'])} AS attendance_rate_text FROM fact", "fact")
ORACLE["mx_satisfaction_kpis"] = with_ctes(
    f"SELECT {measures('average_satisfaction', 'rated_delivery_records')} FROM fact", "fact")
ORACLE["mx_attendance_by_type"] = with_ctes(
    f"SELECT event_type, {measures('total_delivery_records', 'total_registered', 'registered_event_attended', 'attendance_variance')}, "
    f"{RATE_TEXT.format(r=M['attendance_rate'])} AS attendance_rate FROM fact GROUP BY event_type", "fact")
ORACLE["mx_satisfaction_by_type"] = with_ctes(
    f"SELECT event_type, {measures('average_satisfaction', 'rated_delivery_records')} FROM fact GROUP BY event_type "
    f"{not_all_blank('average_satisfaction', 'rated_delivery_records')}", "fact")
ORACLE["mx_monthly_detail"] = with_ctes(
    f"SELECT year_month, {measures('total_delivery_records', 'total_event_groups', 'total_people_reached', AVG_REACH, 'total_session_hours')} "
    "FROM fjd GROUP BY year_month", "fjd")
ORACLE["mx_region_detail"] = with_ctes(
    f"SELECT region, {measures('total_delivery_records', 'total_people_reached', AVG_REACH, 'locations_reached')} "
    "FROM fj GROUP BY region", "fj")
ORACLE["mx_programme_detail"] = with_ctes(
    f"SELECT programme_type, {measures('total_delivery_records', 'total_people_reached', AVG_REACH, 'total_session_hours')} "
    "FROM fact GROUP BY programme_type", "fact")
ORACLE["mx_language_detail"] = with_ctes(
    f"SELECT delivery_language, {measures('total_delivery_records', 'total_event_groups', 'total_people_reached', AVG_REACH)} "
    "FROM fact GROUP BY delivery_language", "fact")
ORACLE["mx_venue_category_detail"] = with_ctes(
    f"SELECT venue_category, {measures('total_delivery_records', 'total_people_reached', AVG_REACH, 'locations_reached')} "
    "FROM fj GROUP BY venue_category", "fj")

