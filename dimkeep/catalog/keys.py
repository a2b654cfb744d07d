"""Lookups and surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeep.catalog.registry import Tables, key_of, query, sql_key
from dimkeep.functions.predicates import first_known, keep_known
from dimkeep.operators import keys
from dimkeep.operators import lookup as lk
from dimkeep.plans.fixed_values import DISTRICTS


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_brand, '-1') AS brand
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'ECONOMY') ON p_partkey = l_partkey
""")
def lookup_default(t: Tables) -> DataFrame:
    return lk.lookup(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
        t.part.where("p_type <> 'ECONOMY'"), "l_partkey", "p_partkey", {"brand": "p_brand"}, default="-1",
    )


@query("""
SELECT l_orderkey, l_linenumber, s_nationkey AS nation
FROM lineitem JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON s_suppkey = l_suppkey
""")
def lookup_required(t: Tables) -> DataFrame:
    rows = lk.lookup(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"),
        t.supplier.where("s_acctbal >= 0"), "l_suppkey", "s_suppkey", {"nation": "s_nationkey"}, required=True,
    )
    return rows.drop("l_suppkey")


@query("""
WITH o AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS code
  FROM orders)
SELECT o_orderkey, coalesce(c_mktsegment, '?') AS segment
FROM o LEFT JOIN customer ON c_custkey = TRY_CAST(code AS BIGINT)
""")
def lookup_trycast(t: Tables) -> DataFrame:
    code = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "n/a").otherwise(F.col("o_custkey").cast("string"))
    rows = t.orders.select("o_orderkey", code.alias("code"))
    found = lk.lookup(
        rows, t.customer, F.col("code").try_cast("bigint"), "c_custkey", {"segment": "c_mktsegment"}, default="?"
    )
    return found.drop("code")


@query("""
WITH c AS (
  SELECT c_custkey, CASE WHEN c_nationkey IN (1, 11, 18, 20, 22, 23) THEN c_nationkey ELSE -1 END AS known,
         replace(c_name, 'Customer', 'Supplier') AS name FROM customer)
SELECT c_custkey, coalesce(n_nationkey, -1) AS district, coalesce(s_nationkey, -1) AS previous,
       CASE WHEN coalesce(s_nationkey, -1) <> -1 THEN s_nationkey ELSE coalesce(n_nationkey, -1) END AS parent
FROM c LEFT JOIN nation ON n_nationkey = known LEFT JOIN supplier ON s_name = name
""")
def lookup_mapped(t: Tables) -> DataFrame:
    """Key through a whitelist, key by name, and the fallback from one to the other."""
    rows = t.customer.select("c_custkey", "c_nationkey", F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("name"))
    rows = lk.lookup(
        rows, t.nation, keep_known(F.col("c_nationkey"), DISTRICTS), "n_nationkey", {"district": "n_nationkey"}, default=-1
    )
    rows = lk.lookup(rows, t.supplier, "name", "s_name", {"previous": "s_nationkey"}, default=-1)
    return rows.select(
        "c_custkey", "district", "previous", first_known(F.col("previous"), F.col("district")).alias("parent")
    )


@query("""
SELECT c_custkey, c_nationkey FROM customer
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE r_name IN ('AFRICA', 'ASIA') AND c_custkey <> 0
""")
def eligible_members(t: Tables) -> DataFrame:
    groups = t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").isin("AFRICA", "ASIA").alias("counts"))
    members = lk.eligible_members(
        t.customer.select("c_custkey", "c_nationkey"),
        t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"),
        groups,
        member_key="c_custkey", unit_key="c_nationkey", group_key="n_regionkey", flag="counts", unknown=0,
    )
    return members.select("c_custkey", "c_nationkey")


@query(f"""
WITH members AS (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
stays AS (
  SELECT o_custkey, o_orderpriority AS unit, CASE WHEN o_orderstatus <> 'O' THEN {sql_key("o_orderdate")} END AS until FROM orders),
ranked AS (
  SELECT o_custkey, unit, rank() OVER (PARTITION BY o_custkey ORDER BY until DESC) AS r FROM stays
  WHERE unit <> '1-URGENT' AND until IS NOT NULL AND o_custkey IN (SELECT c_custkey FROM members))
SELECT DISTINCT o_custkey, CAST(substr(unit, 1, 1) AS INTEGER) AS parent FROM ranked WHERE r = 1
""")
def latest_prior_parent(t: Tables) -> DataFrame:
    """Priorities play the units. Two orders on the last day with different ones give two rows."""
    stays = t.orders.select(
        "o_custkey",
        F.col("o_orderpriority").alias("unit"),
        F.when(F.col("o_orderstatus") != "O", key_of("o_orderdate")).alias("until"),
    )
    here = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "1-URGENT").otherwise("5-LOW")
    units = t.orders.select(
        F.col("o_orderpriority").alias("unit"), F.substring("o_orderpriority", 1, 1).cast("int").alias("parent")
    ).distinct()
    return lk.latest_prior_parent(
        stays, units, t.customer.select(F.col("c_custkey").alias("o_custkey"), here.alias("unit")),
        member="o_custkey", unit="unit", until="until", parent="parent", this_unit="1-URGENT",
    )


@query("""
WITH before AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal >= 0),
new AS (SELECT c_name AS name FROM customer WHERE c_acctbal < 0)
SELECT (SELECT max(id) FROM before) + row_number() OVER (ORDER BY md5(name), name) AS id, name FROM new
""")
def assign_keys(t: Tables) -> DataFrame:
    before = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = t.customer.where("c_acctbal < 0").select(F.col("c_name").alias("name"))
    return keys.assign_keys(before, new, ["name"], "id")


@query("""
SELECT 20240131 AS date_id, c_custkey, n_name, c_mktsegment
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey <> 0
""")
def snapshot(t: Tables) -> DataFrame:
    rows = lk.lookup(
        t.customer.where("c_custkey <> 0"), t.nation, "c_nationkey", "n_nationkey", {"n_name": "n_name"}, required=True
    )
    return rows.select(F.lit(20240131).alias("date_id"), "c_custkey", "n_name", "c_mktsegment")
