"""Extract files. Lines are made from whole tables; the SQL selects the same columns directly."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeep.catalog.registry import Tables, query
from dimkeep.plans.model import schema_of
from dimkeep.session import Scratch
from dimkeep.sources import sections
from dimkeep.sources.delimited import read_delimited
from dimkeep.sources.staging import select_renamed, typed, with_load_date

_COLUMNS = ["Custkey", "Name", "Segment", "Orderkey", "Status", "_extra_2"]
_FILE_ROWS = 100_000


def order_lines(t: Tables) -> DataFrame:
    """Files of two sections, one file per 100,000 order keys: the customers with those keys, then the orders."""

    def at(key: str, first: int):
        file = F.floor(F.col(key) / _FILE_ROWS)
        return file.alias("path"), (F.col(key) - file * _FILE_ROWS + first)

    by_customer, by_order = at("c_custkey", 0)[0], at("o_orderkey", 0)[0]
    files = t.customer.select(by_customer).union(t.orders.select(by_order)).distinct()
    fixed = files.select(
        "path",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(ln).cast("bigint").alias("ln"), F.lit(text).alias("line"))
                    for ln, text in (
                        (0, "2;not;a;header"),
                        (1, "4;lost;before;any header"),
                        (2, "2;Custkey;Name;Segment;; "),
                        (1_000_002, "3;1"),
                        (1_000_003, "  "),
                        (1_000_004, "2;Orderkey;Status"),
                        (9_000_000, "2;Empty;Section"),
                        (9_000_001, "3;0"),
                    )
                ]
            )
        ).alias("l"),
    ).select("path", "l.ln", "l.line")

    path, ln = at("c_custkey", 3)
    segment = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(";;")).when(
        F.col("c_mktsegment") != "HOUSEHOLD", F.concat(F.lit(";"), F.col("c_mktsegment"))
    ).otherwise(F.lit(""))
    customers = t.customer.select(
        path, ln.alias("ln"), F.concat(F.concat_ws(";", F.lit("4"), "c_custkey", "c_name"), segment).alias("line")
    )
    path, ln = at("o_orderkey", 1_000_005)
    orders = t.orders.select(
        path,
        ln.alias("ln"),
        F.concat_ws(
            ";", F.lit("7"), "o_orderkey", "o_orderstatus",
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise(F.lit("")),
        ).alias("line"),
    )
    return fixed.union(customers).union(orders)


_SECTIONS_SQL = """
SELECT '4' AS row_type, CAST(c_custkey AS VARCHAR) AS "Custkey", c_name AS "Name",
       CASE WHEN c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD') THEN c_mktsegment END AS "Segment",
       CAST(NULL AS VARCHAR) AS "Orderkey", CAST(NULL AS VARCHAR) AS "Status", CAST(NULL AS VARCHAR) AS "_extra_2"
FROM customer
UNION ALL
SELECT '7', NULL, NULL, NULL, CAST(o_orderkey AS VARCHAR), o_orderstatus,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END
FROM orders
"""


@query(_SECTIONS_SQL)
def parse_sections(t: Tables) -> DataFrame:
    return sections.parse_sections(order_lines(t), _COLUMNS)


@query("""
SELECT o_orderkey AS order_code, o_custkey AS customer_code, o_orderpriority AS priority,
       20240131 AS load_day
FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'
""")
def stage_select(t: Tables) -> DataFrame:
    """Text columns under their staged names; the second column mapped to a name loses, nulls or not."""
    text = t.orders.select(
        F.col("o_orderkey").cast("string").alias("Ordre"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("Prioritet"),
        F.col("o_custkey").cast("string").alias("Kunde"),
        F.lit("second").alias("_extra_3"),
        F.col("o_orderstatus").alias("Ukendt"),
        F.lit("x").alias("Kladde"),
    )
    mapping = {"Kunde": "customer_code", "Ordre": "order_code", "Prioritet": "priority", "_extra_3": "priority", "Kladde": "draft", "Mangler": "absent"}
    staged = select_renamed(text, mapping, drop={"draft"}).where(F.col("priority").isNotNull())
    staged = with_load_date(staged, datetime(2024, 1, 31, 4))
    schema = schema_of("order_code bigint, customer_code bigint, priority string, stg_load_date timestamp_ntz")
    return typed(staged, schema).select(
        "order_code", "customer_code", "priority", F.date_format("stg_load_date", "yyyyMMdd").cast("int").alias("load_day")
    )


def new_scratch(t: Tables) -> Scratch:
    """Kept until the query's result has been read, so it is not cleared here."""
    return Scratch(t.spark, t.spark.conf.get("spark.sql.warehouse.dir"))


@query(_SECTIONS_SQL)
def read_section_files(t: Tables) -> DataFrame:
    """The same lines through files on disk: written as text, read back in splits, columns looked up."""
    scratch = new_scratch(t)
    folder = scratch.place()
    lines = order_lines(t)
    # A file's lines must lie in order; files hold a bounded number of keys, so this stays even.
    lines.repartition("path").sortWithinPartitions("path", "ln").select("path", F.col("line").alias("value")).write.partitionBy(
        "path"
    ).text(folder)
    read = sections.read_lines(t.spark, folder, scratch)
    wanted = [c for c in sections.section_columns(read) if c in _COLUMNS]
    return sections.parse_sections(read, wanted)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS "Kode", c_name AS "Navn", CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment || '; €' END AS "Køn"
FROM customer
""")
def read_delimited_files(t: Tables) -> DataFrame:
    """Customers written as delimited files with quoted separators and empty cells, in two column orders, and read back."""
    folder = new_scratch(t).place()
    cells = t.customer.select(
        F.col("c_custkey").cast("string").alias("Kode"),
        F.col("c_name").alias("Navn"),
        # The euro sign is byte 0x80 in windows-1252; written as such by the ISO-8859-1 writer.
        F.when(F.col("c_mktsegment") != "BUILDING", F.concat("c_mktsegment", F.lit("; \x80"))).alias("Køn"),
        "c_acctbal",
    )
    owing = F.col("c_acctbal") < 0
    for some, columns in ((owing, ["Kode", "Navn", "Køn"]), (~owing, ["Køn", "Kode", "Navn"])):
        writer = cells.where(some).select(columns).write.mode("append").option("sep", ";").option("header", True)
        writer.option("encoding", "ISO-8859-1").option("escape", '"').csv(folder)
    return read_delimited(t.spark, folder)
