"""Questions asked in Spark SQL text over the Gold tables.

``{gold}`` is the database that holds the tables, with its dot, or the prefix of
session views. The tables are named ``delivery``, ``calendar``, ``place``,
``staff`` and ``assignment`` there.
"""

from __future__ import annotations

TABLES = {"fact": "delivery", "date": "calendar", "location": "place", "educator": "staff", "bridge": "assignment"}

QUESTIONS = {
    # how much of each kind of venue's work falls on weekends
    "weekend_share": """
        SELECT venue_type,
               sum(CASE WHEN dayofweek(event_date) IN (1, 7) THEN 1 ELSE 0 END) AS weekend_events,
               count(*) AS events
        FROM {gold}delivery JOIN {gold}place USING (location_id)
        GROUP BY venue_type
        ORDER BY venue_type NULLS FIRST""",
    # nations with active staff: how many are active, how many senior
    "staff_nations": """
        SELECT home_nation,
               count_if(active_status) AS active_staff,
               count_if(experience_level = 'Senior') AS seniors
        FROM {gold}staff
        GROUP BY home_nation
        HAVING count_if(active_status) > 0
        ORDER BY active_staff DESC, home_nation NULLS FIRST""",
    # events per quarter, quarters without any included, against the same quarter a year before
    "quarter_growth": """
        WITH quarters AS (
            SELECT c.year, c.quarter, count(d.event_id) AS events
            FROM {gold}calendar c LEFT JOIN {gold}delivery d ON c.date_key = d.event_date_key
            GROUP BY c.year, c.quarter)
        SELECT this.year, this.quarter, this.events, this.events - last.events AS growth
        FROM quarters this LEFT JOIN quarters last ON last.quarter = this.quarter AND last.year = this.year - 1
        ORDER BY this.year, this.quarter""",
}


def sql_text(name: str, database: str = "", prefix: str = "") -> str:
    return QUESTIONS[name].format(gold=f"{database}." if database else prefix)
