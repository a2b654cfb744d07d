"""Merges, insert-only loads, deletes. The state "before" is what the tables looked like to an
earlier run: some rows not there yet, some with other values, chosen by their own attributes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeep.catalog.reductions import events_as_absence, events_rollup, sql_rollup
from dimkeep.catalog.registry import Tables, key_of, query, sql_key
from dimkeep.functions.dates import school_year, school_year_name
from dimkeep.functions.predicates import any_of, differs, or_unknown
from dimkeep.operators import merge as change
from dimkeep.operators.calendar_gaps import BASELINE_REASON, BASELINE_VALUE
from dimkeep.operators.lookup import lookup
from dimkeep.operators.merge import ACTION, action_counts, insert_new, mark_members, merge
from dimkeep.operators.rollup import code_names, with_fallback
from dimkeep.plans.facts import departed


def _out(changed: DataFrame) -> DataFrame:
    return changed.withColumnRenamed(ACTION, "action")


# -- merges ---------------------------------------------------------------------


def _merge_names(t: Tables) -> DataFrame:
    source = code_names(t.customer, [("c_custkey", "c_name")], "code", "name")
    before = t.customer.where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("code"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lower("c_name"))
        .when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name"))
        .alias("name"),
    )
    return merge(before, source, ["code"], changed=lambda old, new: differs(old("name"), new("name")))


_NAMES_SQL = """
WITH source AS (SELECT DISTINCT c_custkey AS code, c_name AS name FROM customer),
before AS (
  SELECT c_custkey AS code,
         CASE WHEN c_mktsegment = 'BUILDING' THEN lower(c_name)
              WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS name
  FROM customer WHERE c_acctbal >= 0)
SELECT coalesce(t.code, s.code) AS code,
       CASE WHEN t.code IS NULL OR t.name <> s.name THEN s.name ELSE t.name END AS name,
       CASE WHEN t.code IS NULL THEN 'INSERT' WHEN t.name <> s.name THEN 'UPDATE' ELSE 'NONE' END AS action
FROM before t FULL JOIN source s ON t.code = s.code
"""


@query(_NAMES_SQL)
def merge_insert_update(t: Tables) -> DataFrame:
    return _out(_merge_names(t))


def _merge_segments(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    before = t.customer.where("c_acctbal >= 0").select(
        "c_custkey",
        F.when(segment == "HOUSEHOLD", "").when(~segment.isin("FURNITURE", "MACHINERY"), segment).alias("segment"),
    )
    source = t.customer.select(
        "c_custkey",
        F.when(segment == "FURNITURE", "").when(segment != "HOUSEHOLD", segment).alias("segment"),
    )
    return merge(
        before, source, ["c_custkey"], changed=lambda old, new: differs(old("segment"), new("segment"), "")
    )


_SEGMENTS_SQL = """
WITH before AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ''
                         WHEN c_mktsegment NOT IN ('FURNITURE', 'MACHINERY') THEN c_mktsegment END AS segment
  FROM customer WHERE c_acctbal >= 0),
source AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN ''
                         WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS segment
  FROM customer),
joined AS (
  SELECT s.c_custkey, t.segment AS old, s.segment AS new,
         CASE WHEN t.c_custkey IS NULL THEN 'INSERT'
              WHEN coalesce(t.segment, '') <> coalesce(s.segment, '') THEN 'UPDATE' ELSE 'NONE' END AS action
  FROM source s LEFT JOIN before t ON t.c_custkey = s.c_custkey)
SELECT c_custkey, CASE WHEN action = 'NONE' THEN old ELSE new END AS segment, action FROM joined
"""


@query(_SEGMENTS_SQL)
def merge_blank_as_null(t: Tables) -> DataFrame:
    return _out(_merge_segments(t))


def _merge_parts(t: Tables) -> DataFrame:
    columns = ["p_partkey", "p_brand", "p_retailprice"]
    sentinel = t.part.agg(
        F.lit(-1).cast("bigint").alias("p_partkey"),
        F.lit("?").alias("p_brand"),
        F.lit(0.0).alias("p_retailprice"),
    )
    before = t.part.where("p_type <> 'PROMO'").select(columns).union(sentinel)
    source = t.part.where("p_type <> 'ECONOMY'").select(
        "p_partkey", "p_brand", (F.col("p_retailprice") + F.col("p_size")).alias("p_retailprice")
    )
    return merge(before, source, ["p_partkey"], gone="delete", gone_if=lambda old: old("p_partkey") != -1)


_PARTS_SQL = """
WITH before AS (
  SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_type <> 'PROMO'
  UNION ALL SELECT -1, '?', 0.0),
source AS (
  SELECT p_partkey, p_brand, p_retailprice + p_size AS p_retailprice FROM part WHERE p_type <> 'ECONOMY')
SELECT coalesce(t.p_partkey, s.p_partkey) AS p_partkey,
       coalesce(s.p_brand, t.p_brand) AS p_brand,
       CAST(coalesce(s.p_retailprice, t.p_retailprice) AS DOUBLE) AS p_retailprice,
       CASE WHEN t.p_partkey IS NULL THEN 'INSERT' WHEN s.p_partkey IS NOT NULL THEN 'UPDATE'
            WHEN t.p_partkey <> -1 THEN 'DELETE' ELSE 'NONE' END AS action
FROM before t FULL JOIN source s ON t.p_partkey = s.p_partkey
"""


@query(_PARTS_SQL)
def merge_delete_gone(t: Tables) -> DataFrame:
    return _out(_merge_parts(t))


def _merge_absence(t: Tables) -> DataFrame:
    """Withdrawn sign-ups: their days fall back to the baseline from the 15th on, for users who ever bought."""
    rows = events_as_absence(t.events)
    before = events_rollup(rows.where("day < date'2024-01-30'"))
    source = events_rollup(rows.where("reason <> 'signup'"))
    buyers = t.events.where("event_type = 'purchase' AND value > 50").select("user_id")
    return merge(
        mark_members(before, buyers, ["user_id"], "buyer"),
        source,
        ["user_id", "date_id"],
        changed=lambda old, new: any_of(
            [
                differs(old("absence_reason_code"), new("absence_reason_code")),
                differs(old("absence_value"), new("absence_value")),
                differs(old("lesson"), new("lesson"), ""),
                differs(old("grade_level"), new("grade_level"), -1),
                differs(old("track"), new("track"), ""),
            ]
        ),
        gone={"absence_reason_code": BASELINE_REASON, "absence_value": BASELINE_VALUE, "lesson": None},
        gone_if=lambda old: (old("absence_reason_code") != BASELINE_REASON)
        & (old("date_id") >= 20240115)
        & old("buyer"),
        markers=["buyer"],
        unique=True,
    )


_ABSENCE_SQL = f"""
WITH before AS ({sql_rollup("day < DATE '2024-01-30'")}),
source AS ({sql_rollup("reason <> 'signup'")}),
buyers AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 50),
joined AS (
  SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.date_id, s.date_id) AS date_id,
         t.grade_level AS og, t.track AS ot, t.absence_reason_code AS orc, t.absence_value AS ov, t.lesson AS ol,
         s.grade_level AS ng, s.track AS nt, s.absence_reason_code AS nr, s.absence_value AS nv, s.lesson AS nl,
         CASE WHEN t.user_id IS NULL THEN 'INSERT'
              WHEN s.user_id IS NOT NULL AND (t.absence_reason_code <> s.absence_reason_code
                   OR t.absence_value <> s.absence_value OR coalesce(t.lesson, '') <> coalesce(s.lesson, '')
                   OR coalesce(t.grade_level, -1) <> coalesce(s.grade_level, -1)
                   OR coalesce(t.track, '') <> coalesce(s.track, '')) THEN 'UPDATE'
              WHEN s.user_id IS NULL AND t.absence_reason_code <> 'IF' AND t.date_id >= 20240115
                   AND EXISTS (SELECT 1 FROM buyers b WHERE b.user_id = t.user_id) THEN 'RESET'
              ELSE 'NONE' END AS a
  FROM before t FULL JOIN source s ON t.user_id = s.user_id AND t.date_id = s.date_id)
SELECT user_id, date_id,
       CASE WHEN a IN ('INSERT', 'UPDATE') THEN ng ELSE og END AS grade_level,
       CASE WHEN a IN ('INSERT', 'UPDATE') THEN nt ELSE ot END AS track,
       CASE WHEN a IN ('INSERT', 'UPDATE') THEN nr WHEN a = 'RESET' THEN 'IF' ELSE orc END AS absence_reason_code,
       CASE WHEN a IN ('INSERT', 'UPDATE') THEN nv WHEN a = 'RESET' THEN 0.0 ELSE ov END AS absence_value,
       CASE WHEN a IN ('INSERT', 'UPDATE') THEN nl WHEN a = 'RESET' THEN NULL ELSE ol END AS lesson,
       CASE WHEN a = 'RESET' THEN 'UPDATE' ELSE a END AS action
FROM joined
"""


@query(_ABSENCE_SQL)
def merge_reset_gone(t: Tables) -> DataFrame:
    return _out(_merge_absence(t)).withColumn("absence_value", F.col("absence_value").cast("double"))


_MERGES = {
    "names": (_merge_names, _NAMES_SQL),
    "segments": (_merge_segments, _SEGMENTS_SQL),
    "parts": (_merge_parts, _PARTS_SQL),
    "absence": (_merge_absence, _ABSENCE_SQL),
}


def _counts_sql(name: str, sql: str, read: str = "") -> str:
    return f"""
    SELECT '{name}' AS step, {read}
           count(*) FILTER (WHERE action = 'INSERT') AS inserted,
           count(*) FILTER (WHERE action = 'UPDATE') AS updated,
           count(*) FILTER (WHERE action = 'DELETE') AS deleted
    FROM ({sql})"""


def _stack(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@query(" UNION ALL ".join(_counts_sql(name, sql) for name, (_, sql) in _MERGES.items()))
def merge_actions(t: Tables) -> DataFrame:
    """Rows inserted, updated and deleted by each of the merges above."""
    return _stack(
        [action_counts(run(t)).select(F.lit(name).alias("step"), "*") for name, (run, _) in _MERGES.items()]
    )


_READ = {
    "names": ("customer", "true"),
    "parts": ("part", "p_type <> 'ECONOMY'"),
    "absence": ("events", "event_type IN ('error', 'purchase', 'signup', 'view')"),
}


@query(
    " UNION ALL ".join(
        _counts_sql(name, _MERGES[name][1], f"(SELECT count(*) FROM {table} WHERE {where}) AS rows_read,")
        for name, (table, where) in _READ.items()
    )
)
def step_log(t: Tables) -> DataFrame:
    """What the step log of a run holds, without times: rows read before any join, then the actions."""
    frames = []
    for name, (table, where) in _READ.items():
        read = getattr(t, table).where(where).agg(F.count(F.lit(1))).scalar()
        counts = action_counts(_MERGES[name][0](t))
        frames.append(
            counts.select(F.lit(name).alias("step"), read.alias("rows_read"), "inserted", "updated", "deleted")
        )
    return _stack(frames)


# -- insert-only ----------------------------------------------------------------


@query("""
WITH pairs AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders),
before AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
SELECT o_custkey, o_orderstatus, 'NONE' AS action FROM before
UNION ALL
SELECT o_custkey, o_orderstatus, 'INSERT' FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM before b WHERE b.o_custkey = p.o_custkey AND b.o_orderstatus = p.o_orderstatus)
""")
def insert_new_distinct(t: Tables) -> DataFrame:
    pairs = t.orders.select("o_custkey", "o_orderstatus")
    before = t.orders.where("o_orderdate < timestamp_ntz'1998-01-01'").select(pairs.columns).distinct()
    return _out(insert_new(before, pairs, ["o_custkey", "o_orderstatus"]))


@query(f"""
WITH source AS (
  SELECT o_custkey, {sql_key("o_orderdate")} AS date_id,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN -1 ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS kind
  FROM orders),
before AS (SELECT * FROM source WHERE kind = 1)
SELECT o_custkey, date_id, kind, 'NONE' AS action FROM before
UNION ALL
SELECT o_custkey, date_id, kind, 'INSERT' FROM source s
WHERE NOT EXISTS (SELECT 1 FROM before b WHERE b.o_custkey = s.o_custkey AND b.date_id = s.date_id)
""")
def insert_new_repeats(t: Tables) -> DataFrame:
    """Repeats of a key inside the batch all go in."""
    kind = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.substring("o_orderpriority", 1, 1).cast("int"))
    source = t.orders.select("o_custkey", key_of("o_orderdate").alias("date_id"), or_unknown(kind).alias("kind"))
    return _out(insert_new(source.where("kind = 1"), source, ["o_custkey", "date_id"], distinct=False))


@query("""
WITH named AS (SELECT DISTINCT c_custkey AS code, c_name AS name FROM customer WHERE c_acctbal >= 0)
SELECT code, name FROM named
UNION ALL
SELECT DISTINCT o_custkey, 'Customer ' || CAST(o_custkey AS VARCHAR) FROM orders
WHERE NOT EXISTS (SELECT 1 FROM named n WHERE n.code = o_custkey)
""")
def fallback_source(t: Tables) -> DataFrame:
    named = code_names(t.customer.where("c_acctbal >= 0"), [("c_custkey", "c_name")], "code", "name")
    seen = (
        t.orders.select(F.col("o_custkey").alias("code"))
        .distinct()
        .withColumn("name", F.concat(F.lit("Customer "), F.col("code").cast("string")))
    )
    return with_fallback(named, seen, "code")


@query("""
SELECT l_partkey AS code, l_returnflag AS name FROM lineitem
UNION
SELECT l_suppkey, l_linestatus FROM lineitem
""")
def union_codes(t: Tables) -> DataFrame:
    return code_names(
        t.lineitem, [("l_partkey", "l_returnflag"), ("l_suppkey", "l_linestatus")], "code", "name"
    )


# -- deletes --------------------------------------------------------------------


@query("""
WITH last AS (
  SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY o_custkey),
gone AS (
  SELECT c.c_custkey FROM customer c LEFT JOIN last l ON l.o_custkey = c.c_custkey
  WHERE l.d IS NULL OR year(l.d) - CASE WHEN month(l.d) < 8 THEN 1 ELSE 0 END < 1999)
SELECT o_orderkey, o_custkey,
       CASE WHEN EXISTS (SELECT 1 FROM gone g WHERE g.c_custkey = o_custkey) THEN 'DELETE' ELSE 'NONE' END AS action
FROM orders
""")
def delete_members(t: Tables) -> DataFrame:
    """Orders of customers last seen more than two school years before 2001-08-02."""
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    people = t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("student_id"),
        F.when(F.col("last").isNotNull(), school_year_name(school_year(F.to_date("last")))).alias("last_seen"),
    )
    gone = departed(people, date(2001, 8, 2), years=2).withColumnRenamed("student_id", "o_custkey")
    return _out(change.delete_members(t.orders.select("o_orderkey", "o_custkey"), gone, ["o_custkey"]))


# -- other merge keys -----------------------------------------------------------


@query(f"""
WITH source AS (
  SELECT o_custkey, o_orderkey, {sql_key("o_orderdate")} AS from_date_id,
         CASE WHEN o_orderstatus <> 'O' THEN {sql_key("o_orderdate + INTERVAL 30 DAY")} END AS to_date_id
  FROM orders),
before AS (
  SELECT o_custkey, o_orderkey, {sql_key("o_orderdate")} AS from_date_id,
         CASE WHEN o_orderstatus = 'F' THEN {sql_key("o_orderdate + INTERVAL 30 DAY")} END AS to_date_id
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')
SELECT s.o_custkey, s.o_orderkey, s.from_date_id,
       CASE WHEN t.o_orderkey IS NULL OR coalesce(t.to_date_id, -1) <> coalesce(s.to_date_id, -1)
            THEN s.to_date_id ELSE t.to_date_id END AS to_date_id,
       CASE WHEN t.o_orderkey IS NULL THEN 'INSERT'
            WHEN coalesce(t.to_date_id, -1) <> coalesce(s.to_date_id, -1) THEN 'UPDATE' ELSE 'NONE' END AS action
FROM source s LEFT JOIN before t
  ON t.o_custkey = s.o_custkey AND t.o_orderkey = s.o_orderkey AND t.from_date_id = s.from_date_id
""")
def open_intervals(t: Tables) -> DataFrame:
    """Intervals from text day keys; the end is open where its text is no number."""
    text = F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyyMMdd")
    orders = t.orders

    def intervals(rows: DataFrame, still_open) -> DataFrame:
        return rows.select(
            "o_custkey",
            "o_orderkey",
            F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("from_date_id"),
            F.when(still_open, F.lit("open")).otherwise(text).try_cast("int").alias("to_date_id"),
        )

    before = intervals(orders.where("o_orderdate < timestamp_ntz'2001-01-01'"), F.col("o_orderstatus") != "F")
    source = intervals(orders, F.col("o_orderstatus") == "O")
    return _out(
        merge(
            before,
            source,
            ["o_custkey", "o_orderkey", "from_date_id"],
            changed=lambda old, new: differs(old("to_date_id"), new("to_date_id"), -1),
        )
    )


@query("""
WITH fields AS (SELECT DISTINCT event_type AS field_name FROM events WHERE event_type <> 'click'),
last AS (
  SELECT user_id, event_type AS field_name, arg_max(value, (ts, event_id)) AS field_value
  FROM events JOIN fields ON field_name = event_type GROUP BY ALL),
before AS (
  SELECT user_id, event_type AS field_name, arg_max(value, (ts, event_id)) AS field_value
  FROM events JOIN fields ON field_name = event_type WHERE ts < TIMESTAMP '2024-01-20' GROUP BY ALL)
SELECT s.user_id, s.field_name, s.field_value,
       CASE WHEN t.user_id IS NULL THEN 'INSERT' WHEN t.field_value <> s.field_value THEN 'UPDATE' ELSE 'NONE' END AS action
FROM last s LEFT JOIN before t ON t.user_id = s.user_id AND t.field_name = s.field_name
""")
def key_value_merge(t: Tables) -> DataFrame:
    """Last value per user and field. A field the dimension does not have is dropped."""
    fields = t.events.where("event_type <> 'click'").select(F.col("event_type").alias("field_name")).distinct()

    def last(rows: DataFrame) -> DataFrame:
        known = lookup(rows, fields, "event_type", "field_name", {"field_name": "field_name"}, required=True)
        return known.groupBy("user_id", "field_name").agg(
            F.max_by("value", F.struct("ts", "event_id")).alias("field_value")
        )

    return _out(
        merge(
            last(t.events.where("ts < timestamp_ntz'2024-01-20'")),
            last(t.events),
            ["user_id", "field_name"],
            # grouped by its keys just above
            unique=True,
            changed=lambda old, new: differs(old("field_value"), new("field_value")),
        )
    )


@query("""
WITH lessons AS (
  SELECT l_orderkey, l_linenumber, min(l_returnflag) AS reason, min(l_linestatus) AS grade, min(l_suppkey) AS track
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
source AS (
  SELECT l_orderkey, CASE WHEN reason <> 'R' THEN l_linenumber END AS lesson, reason, grade, track FROM lessons),
before AS (
  SELECT l_orderkey, CASE WHEN reason <> 'R' THEN l_linenumber END AS lesson,
         CASE WHEN grade = 'F' THEN 'N' ELSE reason END AS reason, 'X' AS grade, track
  FROM lessons WHERE l_linenumber < 5),
matched AS (
  SELECT t.l_orderkey, t.lesson, t.track AS old_track, t.reason AS old_reason, t.grade AS old_grade,
         s.reason, s.grade, s.track, s.l_orderkey IS NOT NULL AND t.reason <> s.reason AS hit
  FROM before t LEFT JOIN source s ON t.l_orderkey = s.l_orderkey AND t.lesson = s.lesson)
SELECT l_orderkey, lesson,
       CASE WHEN hit THEN reason ELSE old_reason END AS reason,
       CASE WHEN hit THEN grade ELSE old_grade END AS grade,
       CASE WHEN hit THEN track ELSE old_track END AS track,
       CASE WHEN hit THEN 'UPDATE' ELSE 'NONE' END AS action
FROM matched
UNION ALL
SELECT l_orderkey, lesson, reason, grade, track, 'INSERT' FROM source s
WHERE NOT EXISTS (SELECT 1 FROM before t WHERE t.l_orderkey = s.l_orderkey AND t.lesson = s.lesson)
""")
def lesson_merge(t: Tables) -> DataFrame:
    """A row without a lesson number never matches and goes in again; only a changed reason updates."""
    lessons = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_returnflag").alias("reason"), F.min("l_linestatus").alias("grade"), F.min("l_suppkey").alias("track")
    )
    lesson = F.when(F.col("reason") != "R", F.col("l_linenumber")).alias("lesson")
    source = lessons.select("l_orderkey", lesson, "reason", "grade", "track")
    before = lessons.where("l_linenumber < 5").select(
        "l_orderkey",
        lesson,
        F.when(F.col("grade") == "F", "N").otherwise(F.col("reason")).alias("reason"),
        F.lit("X").alias("grade"),
        "track",
    )
    return _out(
        merge(
            before,
            source,
            ["l_orderkey", "lesson"],
            changed=lambda old, new: differs(old("reason"), new("reason")),
            update=["reason", "grade", "track"],
        )
    )
