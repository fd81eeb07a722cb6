"""Joins: equi, outer with residuals, semi and anti in several forms, range, nearest, identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.operators.matching import Alike, best_alike, rolling_count
from claimforge.operators.matching import nearest_by_date as nearest
from claimforge.opsuite.registry import query
from claimforge.opsuite.tables import money, read


@query("""
select l_orderkey, l_linenumber, o_orderstatus, n_name from lineitem join orders on l_orderkey = o_orderkey and l_linestatus = o_orderstatus
  join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
""")
def inner_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customer, nation = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        lines.join(orders, (lines.l_orderkey == orders.o_orderkey) & (lines.l_linestatus == orders.o_orderstatus))
        .join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("l_orderkey", "l_linenumber", "o_orderstatus", "n_name")
    )


@query("""
select l_orderkey, l_linenumber, l_linestatus, o_orderstatus from lineitem left join orders on l_orderkey = o_orderkey where l_linestatus is distinct from o_orderstatus
""")
def left_join_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicts between a row and what it refers to, or a missing reference."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left").filter(~F.col("l_linestatus").eqNullSafe(F.col("o_orderstatus"))).drop("o_orderkey")


@query("""
with k as (select distinct p_brand, p_type, p_size from part),
a as (select p_brand, p_type, p_size, count(*) as n from part group by all),
b as (select p_brand, p_type, p_size, sum(p_retailprice::decimal(12,2))::decimal(18,2) as price from part where p_partkey % 2 = 0 group by all)
select p_brand, p_type, p_size, n, price from k left join a using (p_brand, p_type, p_size) left join b using (p_brand, p_type, p_size)
""")
def left_using_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, part = ["p_brand", "p_type", "p_size"], read(spark, sf_dir, "part")
    counts = part.groupBy(*keys).agg(F.count("*").alias("n"))
    prices = part.filter("p_partkey % 2 = 0").groupBy(*keys).agg(F.sum(money("p_retailprice")).cast("decimal(18,2)").alias("price"))
    return part.select(*keys).distinct().join(counts, keys, "left").join(prices, keys, "left")


@query("select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')")
def anti_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    orders = read(spark, sf_dir, "orders").select("o_orderkey")
    return orders.join(returned, orders.o_orderkey == returned.l_orderkey, "left_anti")


@query("select c_custkey, c_mktsegment from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')")
def semi_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customer.join(urgent, customer.c_custkey == urgent.o_custkey, "left_semi")


@query("""
select o_orderkey, case when not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0) then 'NO_CREDIT'
  when exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R') then 'RETURNED' else 'FINE' end as rule from orders
""")
def case_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classification by existence, from flags of distinct keys."""
    solvent = read(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("solvent")).distinct()
    returned = read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("returned", F.lit(True))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(solvent, "o_custkey", "left").join(returned, "o_orderkey", "left")
    return orders.select("o_orderkey", F.when(F.col("solvent").isNull(), "NO_CREDIT").when(F.col("returned"), "RETURNED").otherwise("FINE").alias("rule"))


@query("""
with a as (select distinct nullif(o_orderstatus, 'P') as status, o_custkey from orders), b as (select distinct nullif(l_linestatus, 'F') as status, l_suppkey as k from lineitem)
select status, o_custkey from a where not exists (select 1 from b where b.status is not distinct from a.status and b.k = a.o_custkey)
""")
def nullsafe_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_custkey").distinct()
    b = read(spark, sf_dir, "lineitem").select(F.nullif("l_linestatus", F.lit("F")).alias("other"), F.col("l_suppkey").alias("k")).distinct()
    return a.join(b, a.status.eqNullSafe(b.other) & (a.o_custkey == b.k), "left_anti")


@query("""
select doc_id, source from documents where not exists (select 1 from labels where 'doc-' || labels.doc_id = lower('DOC-' || documents.doc_id))
""")
def anti_expr_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    labels = read(spark, sf_dir, "labels").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("stem"))
    return docs.join(labels, F.lower(F.concat(F.lit("DOC-"), F.col("doc_id").cast("string"))) == F.col("stem"), "left_anti")


@query("""
select o_orderkey, o_custkey, (count(*) over (partition by o_custkey order by o_orderdate::date range between interval 29 days preceding and current row))::bigint as recent from orders
""")
def rolling_30d_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the same customer within 30 days up to and including the day."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return rolling_count(orders, ["o_custkey"], "day", 30, "recent").select("o_orderkey", "o_custkey", "recent")


@query("""
select o_orderkey, arg_min(l_linenumber, (abs(datediff('day', o_orderdate::date, l_shipdate::date)) * 1000000 + datediff('day', date '1990-01-01', l_shipdate::date)) * 100 + l_linenumber) as line,
  min(abs(datediff('day', o_orderdate::date, l_shipdate::date)))::int as days
from orders join (select distinct l_orderkey, l_linenumber, l_shipdate from lineitem) on l_orderkey = o_orderkey group by 1
""")
def nearest_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each order its line shipped nearest in time, before or after; ties to the earlier, then the lower."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("ship"), F.col("l_linenumber").alias("line"))
    return nearest(orders, lines, ["o_orderkey"], "day", "ship", ["line"], id_columns=["o_orderkey"]).select("o_orderkey", "line", "days")


@query("""
with c as (select c_custkey, c_nationkey, c_mktsegment, (floor(c_acctbal)::bigint % 40) as bucket, nullif(c_custkey % 3, 0) as dob, c_custkey % 4 as phone from customer),
m as (select a.c_custkey as k, b.c_custkey as s, b.dob is not null as valid, (b.dob is not null)::int + (b.phone > 0)::int as score, b.phone
  from c a join c b on a.c_custkey = b.c_custkey or (a.c_nationkey = b.c_nationkey and a.c_mktsegment = b.c_mktsegment and a.bucket = b.bucket and (a.dob = b.dob or (a.phone = b.phone and a.dob is distinct from b.dob))))
select k as c_custkey, s as survivor from m qualify row_number() over (partition by k order by valid desc, score desc, phone desc nulls last, s) = 1
""")
def identity_match_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's best match: itself or one alike in a blocking key and a further rule."""
    c = read(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", F.expr("cast(floor(c_acctbal) as bigint) % 40").alias("bucket"), F.nullif(F.col("c_custkey") % 3, F.lit(0)).alias("dob"), (F.col("c_custkey") % 4).alias("phone")
    )
    score = F.col("dob").isNotNull().cast("int") + (F.col("phone") > 0).cast("int")
    order = F.struct(F.col("dob").isNull(), -score, -F.col("phone"), F.col("c_custkey").alias("survivor"))
    block = ("c_nationkey", "c_mktsegment", "bucket")
    best = best_alike(c, order, [Alike((*block, "dob")), Alike((*block, "phone"), differ="dob")], "best")
    return best.select("c_custkey", "best.survivor")
