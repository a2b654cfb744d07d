"""Calendar functions, school days and gaps. The calendar is the days that events fall on."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeep.catalog.registry import Tables, key_of, query, sql_key
from dimkeep.functions import dates
from dimkeep.functions.predicates import flag
from dimkeep.operators import calendar_gaps as gaps
from dimkeep.operators import lookup
from dimkeep.plans.dims import refresh_school_year_label

AS_OF = date(2024, 1, 31)


@query(f"""
WITH d AS (SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END AS INTEGER) AS y FROM orders)
SELECT o_orderkey, y AS school_year, CAST(y AS VARCHAR) || '/' || CAST(y + 1 AS VARCHAR) AS school_year_name,
       CAST(y * 10000 + 801 AS INTEGER) AS first_day, {sql_key("o_orderdate")} AS date_id,
       CAST(y * 10000 + 801 <= {sql_key("o_orderdate")} AS BOOLEAN) AS started
FROM d
""")
def school_year(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    year = dates.school_year(day)
    first = dates.school_year_start(year)
    return t.orders.select(
        "o_orderkey",
        year.alias("school_year"),
        dates.school_year_name(year).alias("school_year_name"),
        dates.day_key(first).alias("first_day"),
        dates.day_key(day).alias("date_id"),
        (first <= day).alias("started"),
    )


@query(f"""
WITH d AS (
  SELECT DISTINCT {sql_key("o_orderdate")} AS date_id,
         year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END AS y FROM orders),
labelled AS (
  SELECT date_id,
         CASE 1999 - y WHEN 0 THEN 'Indeværende' WHEN 1 THEN 'Indeværende-1' WHEN 2 THEN 'Indeværende-2'
                       WHEN 3 THEN 'Indeværende-3' WHEN 4 THEN 'Indeværende-4' END AS old,
         CASE 2000 - y WHEN 0 THEN 'Indeværende' WHEN 1 THEN 'Indeværende-1' WHEN 2 THEN 'Indeværende-2'
                       WHEN 3 THEN 'Indeværende-3' WHEN 4 THEN 'Indeværende-4' END AS new FROM d)
SELECT date_id, new AS school_year_label,
       CASE WHEN coalesce(old, '') <> coalesce(new, '') THEN 'UPDATE' ELSE 'NONE' END AS action FROM labelled
""")
def relative_label(t: Tables) -> DataFrame:
    """The order days, labelled a year ago and now labelled again."""
    days = t.orders.select(F.to_date("o_orderdate").alias("full_date")).distinct()
    before = days.select(
        dates.day_key(F.col("full_date")).alias("date_id"),
        "full_date",
        dates.relative_label(F.col("full_date"), date(2000, 7, 31)).alias("school_year_label"),
    )
    changed = refresh_school_year_label(before, date(2001, 7, 31))
    return changed.select("date_id", "school_year_label", F.col("_action").alias("action"))


@query("""
WITH b AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS birth FROM orders)
SELECT o_orderkey,
       CAST(2023 - year(birth) - CASE WHEN birth + to_years(CAST(2023 - year(birth) AS INTEGER)) > DATE '2023-02-28' THEN 1 ELSE 0 END AS INTEGER) AS age
FROM b
""")
def age(t: Tables) -> DataFrame:
    born = dates.parse_day(F.date_format("o_orderdate", "yyyyMMdd"))
    return t.orders.select("o_orderkey", dates.age(born, date(2023, 2, 28)).alias("age"))


@query("""
SELECT p_partkey, (p_size >= 10 AND p_size < 40) AS flag, CAST(p_size >= 10 AND p_size < 40 AS SMALLINT) AS number
FROM part
""")
def flags(t: Tables) -> DataFrame:
    size = F.col("p_size")
    text = F.when(size < 5, "0").when(size < 10, "false").when(size < 20, "2").when(size < 40, "TRUE")
    value = flag(text)
    return t.part.select("p_partkey", value.alias("flag"), value.cast("smallint").alias("number"))


def calendar(t: Tables) -> DataFrame:
    """Days of the events; the first of January is a vacation day."""
    day = F.col("full_date")
    return (
        t.events.select(F.to_date("ts").alias("full_date"))
        .distinct()
        .select(
            dates.day_key(day).alias("date_id"),
            day,
            (F.weekday(day) >= 5).alias("is_weekend"),
            (F.dayofyear(day) == 1).alias("is_vacation_day"),
        )
    )


_DAYS = f"""
days AS (
  SELECT DISTINCT {sql_key("ts")} AS date_id, CAST(ts AS DATE) AS full_date FROM events
  WHERE isodow(ts) < 6 AND dayofyear(ts) <> 1)"""
_WINDOW = f"""
{_DAYS}, school_window AS (SELECT date_id FROM days WHERE full_date <= DATE '2024-01-30' ORDER BY full_date DESC LIMIT 10)"""


@query(f"WITH {_DAYS} SELECT event_id, {sql_key('ts')} AS date_id FROM events WHERE {sql_key('ts')} IN (SELECT date_id FROM days)")
def on_school_days(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", key_of("ts").alias("date_id"))
    return lookup.on_school_days(rows, "date_id", calendar(t)).select("event_id", "date_id")


@query(f"WITH {_WINDOW} SELECT date_id FROM school_window")
def last_school_days(t: Tables) -> DataFrame:
    return gaps.last_school_days(calendar(t), AS_OF).select("date_id")


@query(f"""
WITH {_DAYS},
present AS (SELECT DISTINCT {sql_key("ts")} AS date_id FROM events WHERE isodow(ts) NOT IN (3, 4) AND ts >= TIMESTAMP '2024-01-05')
SELECT d.date_id, max(p.date_id) AS source_date_id
FROM days d LEFT JOIN present p ON p.date_id < d.date_id
WHERE d.date_id NOT IN (SELECT date_id FROM present)
GROUP BY d.date_id
""")
def asof_source(t: Tables) -> DataFrame:
    """Nothing counts on Wednesdays, Thursdays and before the fifth."""
    present = (
        t.events.where(~F.weekday("ts").isin(2, 3) & (F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz")))
        .select(key_of("ts").alias("date_id"))
        .distinct()
    )
    return gaps.asof_source(lookup.school_days(calendar(t)).select("date_id"), present)


def _roster(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.max("event_type").alias("track"))


@query(f"""
WITH {_WINDOW},
fact AS (
  SELECT DISTINCT {sql_key("ts")} AS date_id, user_id, event_type AS track FROM events WHERE isodow(ts) NOT IN (3, 4)),
roster AS (SELECT user_id, max(event_type) AS track FROM events GROUP BY user_id),
present AS (SELECT date_id FROM school_window w WHERE EXISTS (SELECT 1 FROM fact f WHERE f.date_id = w.date_id)),
missing AS (
  SELECT w.date_id, (SELECT max(p.date_id) FROM present p WHERE p.date_id < w.date_id) AS source_id
  FROM school_window w WHERE w.date_id NOT IN (SELECT date_id FROM present))
SELECT m.date_id, f.user_id, f.track, 'IF' AS absence_reason_code, CAST(0.0 AS DOUBLE) AS absence_value, CAST(NULL AS VARCHAR) AS lesson
FROM missing m JOIN fact f ON f.date_id = m.source_id
UNION ALL
SELECT m.date_id, r.user_id, r.track, 'IF', 0.0, NULL FROM missing m, roster r WHERE m.source_id IS NULL
""")
def fill_gaps(t: Tables) -> DataFrame:
    """No facts on Wednesdays and Thursdays: two days are copied, two take the roster."""
    fact = t.events.where(~F.weekday("ts").isin(2, 3)).select(
        key_of("ts").alias("date_id"), "user_id", F.col("event_type").alias("track")
    )
    rows = gaps.fill_gaps(fact, calendar(t), _roster(t), AS_OF, copied=["user_id", "track"])
    return rows.withColumn("absence_value", F.col("absence_value").cast("double"))


@query(f"""
WITH roster AS (SELECT user_id, max(event_type) AS track FROM events GROUP BY user_id)
SELECT r.user_id, r.track, 20240130 AS date_id, 'IF' AS absence_reason_code, CAST(0.0 AS DOUBLE) AS absence_value, CAST(NULL AS VARCHAR) AS lesson
FROM roster r
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = r.user_id AND e.event_type = 'error' AND {sql_key("e.ts")} = 20240130)
""")
def baseline_rows(t: Tables) -> DataFrame:
    """Users without an error on the last day."""
    fact = t.events.where("event_type = 'error'").select(key_of("ts").alias("date_id"), "user_id")
    day = dates.day_key_of(dates.yesterday_of(AS_OF))
    rows = gaps.baseline_rows(_roster(t), fact, calendar(t), day, ["user_id"])
    return rows.withColumn("absence_value", F.col("absence_value").cast("double"))
