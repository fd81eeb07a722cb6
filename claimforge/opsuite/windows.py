"""Window functions: first rows, duplicates under two keys, lags after a filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimforge.opsuite.registry import query
from claimforge.opsuite.tables import money, read


@query("select distinct on (user_id, event_type) user_id, event_type, event_id, value from events order by user_id, event_type, ts desc, event_id")
def distinct_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user and type."""
    w = Window.partitionBy("user_id", "event_type").orderBy(F.desc("ts"), "event_id")
    return read(spark, sf_dir, "events").withColumn("rank", F.row_number().over(w)).filter("rank = 1").select("user_id", "event_type", "event_id", "value")


@query("""
select event_id, user_id, event_type, row_number() over (partition by user_id, event_type, ts::date order by event_id) > 1 as duplicate from events
""")
def row_number_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row, marked if an earlier one has its key."""
    w = Window.partitionBy("user_id", "event_type", F.to_date("ts")).orderBy("event_id")
    return read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", (F.row_number().over(w) > 1).alias("duplicate"))


@query("""
with l as (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_tax, l_discount) as by_key,
  row_number() over (partition by l_orderkey, l_linenumber, l_returnflag, l_linestatus order by l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_tax, l_discount) as by_row from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_extendedprice, case when by_row > 1 then 'DUP_EXACT' when by_key > 1 then 'DUP_NEAR_KEY' else 'KEPT' end as status from l
""")
def dup_exact_vs_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates by a wide key and, failing that, by the narrow one."""
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_tax", "l_discount"]
    number = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    status = F.when(number("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus") > 1, "DUP_EXACT").when(number("l_orderkey", "l_linenumber") > 1, "DUP_NEAR_KEY").otherwise("KEPT")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", status.alias("status"))


@query("""
with o as (select o_custkey, o_orderkey, o_orderdate::date as day, o_totalprice::decimal(12,2) as price, o_orderpriority from orders where o_orderdate::date between date '1994-01-01' and date '1997-12-31')
select o_custkey, o_orderkey, lag(o_orderpriority) over w is distinct from o_orderpriority as changed, (price - lag(price) over w)::decimal(14,2) as delta from o
window w as (partition by o_custkey order by day, o_orderkey)
""")
def lag_change_after_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes against the previous row of those within a range of dates."""
    w = Window.partitionBy("o_custkey").orderBy("day", "o_orderkey")
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"), money("o_totalprice").alias("price"), "o_orderpriority")
    kept = orders.filter(F.col("day").between("1994-01-01", "1997-12-31"))
    changed = ~F.lag("o_orderpriority").over(w).eqNullSafe(F.col("o_orderpriority"))
    return kept.select("o_custkey", "o_orderkey", changed.alias("changed"), (F.col("price") - F.lag("price").over(w)).cast("decimal(14,2)").alias("delta"))
