"""Final states after upserts, delete-and-rebuild, replaced children and dependent updates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.operators.constraints import broken_rows, orphans, repeated_keys
from claimforge.operators.upsert import rebuild, replace_children, upsert
from claimforge.opsuite.registry import query
from claimforge.opsuite.tables import money, read
from claimforge.sources.layers import Layers, children, rebuilt, upserted
from claimforge.sources.shared import shared_folder


def columns(df: DataFrame, status=None) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", (F.col("o_orderstatus") if status is None else F.lit(status)).alias("status"))


@query("""
select o_orderkey, o_custkey, case when o_orderkey % 3 = 0 then 'U' else o_orderstatus end as status from orders where o_orderkey % 4 <> 3 or o_orderkey % 3 = 0
""")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return upsert(columns(orders.filter("o_orderkey % 4 <> 3")), columns(orders.filter("o_orderkey % 3 = 0"), "U"), ["o_orderkey"])


@query("""
select o_orderkey, o_custkey, o_orderstatus as status, (o_orderkey % 5)::int as load_id from orders where o_orderkey % 5 <> 2
union all select o_orderkey, o_custkey, 'R', 2 from orders where o_orderkey % 10 = 2
""")
def delete_rebuild_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    old = columns(orders).withColumn("load_id", (F.col("o_orderkey") % 5).cast("int"))
    return rebuild(old, columns(orders.filter("o_orderkey % 10 = 2"), "R").withColumn("load_id", F.lit(2)), "load_id", 2)


@query("""
select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')
union all select l_orderkey, l_linenumber, l_quantity + 1 from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F') and l_linenumber <= 3
""")
def replace_children_of_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    parents = read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    new = lines.filter("l_linenumber <= 3").join(parents.hint("shuffle_hash"), "l_orderkey", "left_semi").withColumn("l_quantity", F.col("l_quantity") + 1)
    return replace_children(lines, new, parents, "l_orderkey")


@query("""
with a as (select o_orderkey, o_orderstatus, o_orderdate::date as day, case when o_totalprice < 100000 then null else o_orderdate::date end as paid from orders)
select o_orderkey, paid, case when paid is null and o_orderstatus = 'F' then null else o_orderstatus end as status, case when o_orderstatus = 'P' then 0 else 1 end::int as counted from a
""")
def dependent_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date is nulled, and then a status that depends on it: two columns in a row, not two updates."""
    paid = F.when(money("o_totalprice") >= 100000, F.to_date("o_orderdate"))
    status = F.when(F.col("paid").isNull() & (F.col("o_orderstatus") == "F"), F.lit(None)).otherwise(F.col("o_orderstatus"))
    return read(spark, sf_dir, "orders").withColumn("paid", paid).select("o_orderkey", "paid", status.alias("status"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("counted"))


def layers(spark: SparkSession) -> Layers:
    """New layers in the folder that all executors share."""
    return Layers(spark, f"{shared_folder(spark)}/layers-{uuid.uuid4().hex}")


@query("""
select o_orderkey, o_custkey, case when o_orderkey % 400 < 3 then 'U' else o_orderstatus end as status from orders where o_orderkey % 4 <> 3 or o_orderkey % 400 < 3
""")
def merge_by_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table dealt to 16 buckets of its key, and two batches: each rewrites the buckets that it has rows for and commits a version."""
    orders, out = read(spark, sf_dir, "orders"), layers(spark)
    out.publish("core", lambda _: {"orders": upserted(columns(orders.filter("o_orderkey % 4 <> 3")), "o_orderkey", buckets=16)})
    out.publish("core", lambda _: {"orders": upserted(columns(orders.filter("o_orderkey % 400 = 0"), "U"), "o_orderkey")})
    out.publish("core", lambda _: {"orders": upserted(columns(orders.filter("o_orderkey % 400 in (1, 2)"), "U"), "o_orderkey")})
    return out.read("core", "orders")


@query("""
select l_orderkey, l_linenumber, l_quantity, (l_orderkey % 4)::int as load_id from lineitem where l_orderkey % 4 <> 1 and l_orderkey % 100 <> 0
union all select l_orderkey, l_linenumber, l_quantity + 1, 0 from lineitem where l_orderkey % 100 = 0 and l_linenumber <= 2
union all select l_orderkey, l_linenumber, 0, 1 from lineitem where l_orderkey % 4 = 1 and l_linenumber = 1
""")
def replace_by_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of touched parents are replaced in their buckets, and one load's partition in place; the other parts stay as they are."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    touched = lines.filter("l_orderkey % 100 = 0")
    new = touched.filter("l_linenumber <= 2").withColumn("l_quantity", F.col("l_quantity") + 1)
    out = layers(spark)
    out.publish("core", lambda _: {"lines": children(lines, lines, "l_orderkey", 16)})
    out.publish("core", lambda _: {"lines": children(new, touched, "l_orderkey")})
    loaded = out.read("core", "lines").withColumn("load_id", (F.col("l_orderkey") % 4).cast("int"))
    out.publish("log", lambda _: {"lines": rebuilt(loaded, "load_id", 0, 1, 2, 3)})
    again = lines.filter("l_orderkey % 4 = 1 and l_linenumber = 1").withColumn("l_quantity", F.lit(0.0)).withColumn("load_id", F.lit(1))
    out.publish("log", lambda _: {"lines": rebuilt(again, "load_id", 1)})
    return out.read("log", "lines")


@query("""
select * from (
  select 'orders: price is high' as what, count(*) as rows from orders where not (o_totalprice >= 1000)
  union all select 'orders: urgent ones are open', count(*) from orders where not (o_orderpriority <> '1-URGENT' or o_orderstatus = 'O')
  union all select 'lineitem: shipped late enough', count(*) from lineitem where not (l_shipdate >= timestamp '1995-01-01')
  union all select 'lineitem: discount is small', count(*) from lineitem where not (nullif(l_discount, 0) < 0.05)
  union all select 'orders: o_orderkey is unique', count(*) from (select o_orderkey from orders group by 1 having count(*) > 1)
  union all select 'orders: o_custkey, o_orderstatus is unique', count(*) from (select 1 from orders group by o_custkey, o_orderstatus having count(*) > 1)
  union all select 'lineitem: l_orderkey, l_linenumber is unique', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
  union all select 'orders have customer', count(*) from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)
  union all select 'lineitem have orders', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P'))
where rows > 0
""")
def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All broken constraints of some tables with their numbers: a scan a table for row checks, one grouping for keys, anti-joins for references."""
    orders = read(spark, sf_dir, "orders")
    lines = read(spark, sf_dir, "lineitem")
    customer = read(spark, sf_dir, "customer").filter("c_acctbal > 0")
    rows = broken_rows(
        {"orders": orders, "lineitem": lines},
        {
            "orders": {"price is high": "o_totalprice >= 1000", "urgent ones are open": "o_orderpriority <> '1-URGENT' or o_orderstatus = 'O'"},
            "lineitem": {"shipped late enough": "l_shipdate >= timestamp '1995-01-01'", "discount is small": "nullif(l_discount, 0) < 0.05"},
        },
    )
    keys = repeated_keys([("orders", ("o_orderkey",), orders), ("orders", ("o_custkey", "o_orderstatus"), orders), ("lineitem", ("l_orderkey", "l_linenumber"), lines)])
    alone = orphans([
        ("orders", "customer", "custkey", orders.withColumnRenamed("o_custkey", "custkey"), customer.withColumnRenamed("c_custkey", "custkey")),
        ("lineitem", "orders", "orderkey", lines.withColumnRenamed("l_orderkey", "orderkey"), orders.filter("o_orderstatus <> 'P'").withColumnRenamed("o_orderkey", "orderkey")),
    ])
    return rows.unionByName(keys).unionByName(alone)
