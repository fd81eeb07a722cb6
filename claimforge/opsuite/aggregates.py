"""Aggregates: filtered, distinct, boolean, duplicates, ordered tops, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.functions import contains_all, length_or_null
from claimforge.opsuite.registry import query
from claimforge.opsuite.tables import money, read


@query("""
select l_returnflag, l_linestatus, count(*) as n, count(*) filter (where l_discount > 0.05) as discounted,
  (sum(l_extendedprice::decimal(12,2)) filter (where l_tax > 0.02))::decimal(18,2) as taxed,
  (avg(l_quantity) filter (where l_tax > 100))::double as never, round((count(*) filter (where l_discount > 0.05))::decimal(18,4) / nullif(count(*), 0), 4)::decimal(18,4)::double as rate,
  min(l_shipdate::date) as first_ship, max(l_extendedprice::decimal(12,2)) as top_price
from lineitem group by all
""")
def agg_filter_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    many = F.count_if(F.col("l_discount") > 0.05)
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), many.alias("discounted"), F.sum(F.when(F.col("l_tax") > 0.02, money("l_extendedprice"))).cast("decimal(18,2)").alias("taxed"),
        F.avg(F.when(F.col("l_tax") > 100, F.col("l_quantity"))).alias("never"), F.round(many.cast("decimal(18,4)") / F.nullif(F.count("*"), F.lit(0)), 4).cast("double").alias("rate"),
        F.min(F.to_date("l_shipdate")).alias("first_ship"), F.max(money("l_extendedprice")).alias("top_price"),
    )


@query("select l_returnflag, count(distinct l_suppkey) as suppliers, count(distinct l_partkey) as parts, count(distinct l_linestatus) as statuses from lineitem group by 1")
def count_distinct_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_linestatus").alias("statuses")
    )


@query("select o_custkey, bool_and(o_orderstatus in ('F', 'O')) as all_clear, bool_or(o_orderpriority = '1-URGENT') as any_urgent from orders group by 1")
def bool_and_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.bool_and(F.col("o_orderstatus").isin("F", "O")).alias("all_clear"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("any_urgent")
    )


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def having_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


@query("""
select c_nationkey as k from customer where c_acctbal < 0 union select s_nationkey from supplier where s_acctbal < 500 union select n_nationkey from nation where n_regionkey = 1
""")
def union_distinct_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_nationkey").alias("k"))
    b = read(spark, sf_dir, "supplier").filter("s_acctbal < 500").select(F.col("s_nationkey").alias("k"))
    return a.union(b).union(read(spark, sf_dir, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("k"))).distinct()


@query("""
select o_orderkey, 'HIGH_VALUE' as rule, o_totalprice::decimal(12,2)::varchar as value from orders where o_totalprice > 400000
union all select o_orderkey, 'URGENT', o_orderpriority from orders where o_orderpriority = '1-URGENT'
union all select o_orderkey, 'PENDING', o_orderstatus from orders where o_orderstatus = 'P'
""")
def union_all_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outputs of several rules, from one scan: every row is taken apart into its rules."""
    rules = F.array(
        F.struct((F.col("o_totalprice") > 400000).alias("on"), F.lit("HIGH_VALUE").alias("rule"), money("o_totalprice").cast("string").alias("value")),
        F.struct((F.col("o_orderpriority") == "1-URGENT").alias("on"), F.lit("URGENT").alias("rule"), F.col("o_orderpriority").alias("value")),
        F.struct((F.col("o_orderstatus") == "P").alias("on"), F.lit("PENDING").alias("rule"), F.col("o_orderstatus").alias("value")),
    )
    return read(spark, sf_dir, "orders").select("o_orderkey", F.explode(rules).alias("r")).filter("r.on").select("o_orderkey", "r.rule", "r.value")


@query("select o_orderkey, o_custkey, o_totalprice::decimal(12,2) as price from orders order by o_totalprice::decimal(12,2) desc, o_orderkey limit 25")
def topk_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", money("o_totalprice").alias("price"))
    return orders.orderBy(F.desc("price"), "o_orderkey").limit(25)


@query("""
with s as (select l_orderkey, list_sort(list(distinct l_returnflag)) as held from lineitem group by 1)
select l_orderkey, array_to_string(held, ',') as flags, list_has_all(held, ['A', 'R']) as complete, len(list_filter(['A', 'R'], lambda x: not list_contains(held, x)))::int as missing,
  nullif(len(list_filter(held, lambda x: x = 'N')), 0)::int as n_or_null from s
""")
def array_contains_all_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a set holds all that is required, and how much of it is missing."""
    wanted = F.array(F.lit("A"), F.lit("R"))
    sets = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_returnflag")).alias("held"))
    return sets.select(
        "l_orderkey", F.array_join("held", ",").alias("flags"), contains_all(F.col("held"), wanted).alias("complete"), F.size(F.array_except(wanted, F.col("held"))).alias("missing"),
        length_or_null(F.filter("held", lambda x: x == "N")).alias("n_or_null"),
    )


@query("""
select o_custkey, array_to_string(list(o_orderkey order by o_totalprice::decimal(12,2) desc, o_orderkey), ',') as by_price, list(o_orderpriority order by o_orderdate, o_orderkey)[1] as first_priority from orders group by 1
""")
def array_agg_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a group as an array in the order of another column: what orders them goes into the array and out again."""
    price = F.collect_list(F.struct((-money("o_totalprice")).alias("order"), F.col("o_orderkey").alias("value")))
    day = F.min(F.struct("o_orderdate", "o_orderkey", "o_orderpriority"))
    held = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(price).alias("held"), day.alias("first"))
    return held.select("o_custkey", F.array_join(F.transform("held", lambda x: x.value.cast("string")), ",").alias("by_price"), F.col("first.o_orderpriority").alias("first_priority"))


@query("""
select 'orders' as layer, o_orderstatus as status, count(*) as n from orders group by 2 union all select 'lineitem', l_linestatus, count(*) from lineitem group by 2
""")
def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda name, c: read(spark, sf_dir, name).groupBy(F.lit(name).alias("layer"), F.col(c).alias("status")).agg(F.count("*").alias("n"))
    return count("orders", "o_orderstatus").unionByName(count("lineitem", "l_linestatus"))
