"""Aggregations. Events stand in for absence registrations: a user and a day make a rollup row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeep.catalog.registry import Tables, query
from dimkeep.functions.dates import day_key
from dimkeep.functions.predicates import keep_known, or_unknown
from dimkeep.operators import rollup

RULES = rollup.RollupRules(priority=("error", "purchase", "signup", "view"))


def events_as_absence(events: DataFrame) -> DataFrame:
    """Registrations: the value says how much of the day, the number in ``props`` gives the grade."""
    number = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    hour = F.hour("ts")
    return events.select(
        "user_id",
        F.to_date("ts").alias("day"),
        day_key(F.to_date("ts")).alias("date_id"),
        F.when(F.col("value") >= 90, 5).when(F.col("value") >= 10, 7).otherwise(6).alias("kind"),
        F.col("event_type").alias("reason"),
        F.when(number >= 90, "x").otherwise(F.floor(number / 10).cast("string")).alias("level"),
        F.when(hour < 12, RULES.first_part).when(hour >= 18, RULES.last_part).alias("part"),
        F.upper(F.substring("event_type", 1, 1)).alias("track"),
    )


def events_rollup(rows: DataFrame) -> DataFrame:
    return rollup.daily_rollup(
        rollup.until(rows, F.col("day"), "2024-01-30"),
        ["user_id", "date_id"],
        kind="kind",
        reason="reason",
        grade="level",
        part="part",
        track="track",
        rules=RULES,
    )


_ABSENCE = """
    SELECT user_id, CAST(ts AS DATE) AS day, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_id,
           CASE WHEN value >= 90 THEN 5 WHEN value >= 10 THEN 7 ELSE 6 END AS kind, event_type AS reason,
           CASE WHEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER) >= 90 THEN 'x'
                ELSE CAST(CAST(regexp_extract(props, '[0-9]+') AS INTEGER) // 10 AS VARCHAR) END AS level,
           CASE WHEN hour(ts) < 12 THEN 'første' WHEN hour(ts) >= 18 THEN 'sidste' END AS part,
           upper(substr(event_type, 1, 1)) AS track
    FROM events"""


def sql_rollup(where: str = "true") -> str:
    return f"""
    SELECT user_id, date_id,
           max(TRY_CAST(level AS INTEGER)) AS grade_level,
           max(track) AS track,
           CASE WHEN bool_or(reason = 'error') THEN 'error' WHEN bool_or(reason = 'purchase') THEN 'purchase'
                WHEN bool_or(reason = 'signup') THEN 'signup' ELSE 'view' END AS absence_reason_code,
           CAST(CASE WHEN bool_or(kind = 5) THEN 1.0
                     WHEN bool_or(kind = 7 AND coalesce(TRY_CAST(level AS INTEGER) BETWEEN 0 AND 6, false)) THEN 1.0
                     WHEN count(*) FILTER (WHERE kind = 7) * 0.5 >= 1.0 THEN 1.0
                     ELSE count(*) FILTER (WHERE kind = 7) * 0.5 END AS DOUBLE) AS absence_value,
           CASE WHEN bool_or(kind = 5) THEN 'Hele dagen'
                WHEN bool_or(kind = 7 AND coalesce(TRY_CAST(level AS INTEGER) BETWEEN 0 AND 6, false)) THEN 'Hele dagen'
                WHEN count(*) FILTER (WHERE kind = 7) >= 2 THEN 'Hele dagen'
                WHEN bool_or(kind = 7 AND coalesce(part = 'første', false)) THEN 'Første lektion'
                WHEN bool_or(kind = 7 AND coalesce(part = 'sidste', false)) THEN 'Sidste lektion' END AS lesson
    FROM ({_ABSENCE})
    WHERE kind IN (5, 7) AND reason IN ('error', 'purchase', 'signup', 'view') AND day <= DATE '2024-01-30' AND ({where})
    GROUP BY user_id, date_id"""


@query(sql_rollup())
def daily_rollup(t: Tables) -> DataFrame:
    rows = events_rollup(events_as_absence(t.events))
    return rows.withColumn("absence_value", F.col("absence_value").cast("double"))


@query("""
SELECT l_partkey, min(l_linestatus) AS l_linestatus, min(coalesce(l_suppkey, -1)) AS l_suppkey,
       CASE WHEN min(l_returnflag) IN ('A', 'N') THEN min(l_returnflag) ELSE '?' END AS l_returnflag
FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey
""")
def collapse_min(t: Tables) -> DataFrame:
    """Each attribute is its own minimum; a flag off the list becomes the sentinel."""
    rows = t.lineitem.withColumn("l_suppkey", or_unknown(F.col("l_suppkey")))
    reduced = rollup.collapse_min(rows, "l_partkey", ["l_linestatus", "l_suppkey", "l_returnflag"])
    return reduced.withColumn("l_returnflag", keep_known(F.col("l_returnflag"), ["A", "N"], "?"))
