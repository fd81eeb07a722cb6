"""Aggregating marts: scans, inner and left joins, filtered aggregates, guarded ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.opsuite.registry import query
from claimforge.opsuite.tables import money, read


@query(
    """
    with r as (
      select l_orderkey, sum(l_extendedprice::decimal(12,2)) as amount, max((l_returnflag = 'R')::int) as returned
      from lineitem group by 1)
    select n_name, o_orderpriority, o_orderstatus, date_trunc('quarter', o_orderdate::date)::date as quarter_start,
      year(o_orderdate::date)::int as year, quarter(o_orderdate::date)::int as quarter,
      count(*) as order_count, count(distinct o_custkey) as customer_count,
      count(*) filter (where returned is not null) as decided_count, count(*) filter (where returned = 0) as kept_count,
      sum(amount)::decimal(18,2) as total_amount, (sum(amount) filter (where returned = 0))::decimal(18,2) as kept_amount,
      case when count(returned) > 0 then (count(*) filter (where returned <> 0))::double / count(returned)::double end as return_rate
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey left join r on l_orderkey = o_orderkey
    where o_orderdate::date between date '1993-01-01' and date '1997-12-31'
    group by all
    """
)
def region_quarter_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by nation, priority, status and quarter, with counts, sums and guarded rates."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    returned = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(money("l_extendedprice")).alias("amount"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned"))
    )
    day = F.to_date("o_orderdate")
    won = F.col("returned") == 0
    decided = F.count_if(F.col("returned").isNotNull())
    return (
        orders.filter(day.between("1993-01-01", "1997-12-31"))
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(returned, orders.o_orderkey == returned.l_orderkey, "left")
        .groupBy("n_name", "o_orderpriority", "o_orderstatus", F.date_trunc("quarter", day).cast("date").alias("quarter_start"), F.year(day).alias("year"), F.quarter(day).alias("quarter"))
        .agg(
            F.count("*").alias("order_count"),
            F.countDistinct("o_custkey").alias("customer_count"),
            decided.alias("decided_count"),
            F.count_if(won).alias("kept_count"),
            F.sum("amount").cast("decimal(18,2)").alias("total_amount"),
            F.sum(F.when(won, F.col("amount"))).cast("decimal(18,2)").alias("kept_amount"),
            F.when(decided > 0, F.count_if(~won).cast("double") / decided.cast("double")).alias("return_rate"),
        )
    )


@query("""
with p as (select o_custkey, count(*) as n, min(o_orderdate::date) as first_day, max(o_orderdate::date) as last_day,
    sum(o_totalprice::decimal(12,2))::decimal(18,2) as spent,
    count(*) filter (where o_orderdate::date between date '1997-01-01' and date '1997-12-31') as in_window,
    count(*) filter (where o_orderdate::date between date '1997-01-01' and date '1997-12-31' and o_orderstatus = 'F') as failed
  from orders where o_orderdate::date <= date '1997-12-31' group by 1),
later as (select distinct o_custkey from orders where o_orderdate::date > date '1997-12-31' and o_orderdate::date <= date '1998-06-30')
select p.o_custkey, n, spent, in_window, case when in_window > 0 then failed::double / in_window::double end as failed_rate,
  (date '1997-12-31' - first_day)::int as tenure_days, (date '1997-12-31' - last_day)::int as idle_days, l.o_custkey is null as churned
from p left join later l on p.o_custkey = l.o_custkey
""")
def churn_label_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-in-time features at a snapshot, and a label from the outcome window after it."""
    snapshot, end = F.lit("1997-12-31").cast("date"), F.lit("1998-06-30").cast("date")
    orders = read(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), money("o_totalprice").alias("price"), "o_orderstatus")
    window = F.col("day").between("1997-01-01", "1997-12-31")
    past = orders.filter(F.col("day") <= snapshot).groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("price").cast("decimal(18,2)").alias("spent"),
        F.count_if(window).alias("in_window"), F.count_if(window & (F.col("o_orderstatus") == "F")).alias("failed"),
    )
    later = orders.filter((F.col("day") > snapshot) & (F.col("day") <= end)).select("o_custkey").distinct().withColumn("back", F.lit(True))
    return past.join(later, "o_custkey", "left").select(
        "o_custkey", "n", "spent", "in_window", F.when(F.col("in_window") > 0, F.col("failed").cast("double") / F.col("in_window").cast("double")).alias("failed_rate"),
        F.datediff(snapshot, "first_day").alias("tenure_days"), F.datediff(snapshot, "last_day").alias("idle_days"), F.col("back").isNull().alias("churned"),
    )


@query("""
with l as (select l_orderkey, min(l_shipdate::date) as first_ship, max(l_shipdate::date) as last_ship, count(*) as n from lineitem group by 1)
select o_orderkey, (first_ship - o_orderdate::date)::int as queue_days, (last_ship - first_ship)::int as handling_days,
  (last_ship - o_orderdate::date)::int as total_days, n is null as is_pending, n is not null as is_decided,
  case when n is null then null else o_orderstatus = 'F' end as is_final
from orders left join l on o_orderkey = l_orderkey
""")
def duration_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations between the dates of an order and its lines, with three-valued flags."""
    ship = F.to_date("l_shipdate")
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(ship).alias("first_ship"), F.max(ship).alias("last_ship"), F.count("*").alias("n"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        "o_orderkey", F.datediff("first_ship", "day").alias("queue_days"), F.datediff("last_ship", "first_ship").alias("handling_days"), F.datediff("last_ship", "day").alias("total_days"),
        F.col("n").isNull().alias("is_pending"), F.col("n").isNotNull().alias("is_decided"), F.when(F.col("n").isNotNull(), F.col("o_orderstatus") == "F").alias("is_final"),
    )


@query("""
with c as (select o_custkey, greatest(min(o_orderdate::date), date '1995-01-01') as a, least(max(o_orderdate::date), date '1997-12-31') as b from orders group by 1),
m as (select o_custkey, unnest(generate_series(date_trunc('month', a)::date, date_trunc('month', b)::date, interval 1 month))::date as month from c where a <= b),
e as (select o_custkey, count(*) as exposure_months from m group by 1),
s as (select o_custkey, count(distinct date_trunc('month', o_orderdate::date)) as active_months, sum(o_totalprice::decimal(12,2))::decimal(18,2) as spent
  from orders where o_orderdate::date between date '1995-01-01' and date '1997-12-31' group by 1)
select c_mktsegment, sum(exposure_months)::bigint as exposure_months, sum(coalesce(active_months, 0))::bigint as active_months, sum(coalesce(spent, 0))::decimal(18,2) as spent,
  sum(exposure_months)::bigint < 12 as low_exposure
from e left join s on e.o_custkey = s.o_custkey join customer on c_custkey = e.o_custkey group by 1
""")
def month_spine_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spine of months from first to last order within history, counted as exposure."""
    day = F.to_date("o_orderdate")
    orders = read(spark, sf_dir, "orders").select("o_custkey", day.alias("day"), money("o_totalprice").alias("price"))
    start, end = F.greatest(F.min("day"), F.lit("1995-01-01").cast("date")), F.least(F.max("day"), F.lit("1997-12-31").cast("date"))
    spine = (
        orders.groupBy("o_custkey").agg(start.alias("a"), end.alias("b")).filter("a <= b")
        .select("o_custkey", F.explode(F.expr("sequence(trunc(a, 'month'), trunc(b, 'month'), interval 1 month)")).alias("month"))
        .groupBy("o_custkey").agg(F.count("*").alias("exposure"))
    )
    spent = orders.filter(F.col("day").between("1995-01-01", "1997-12-31")).groupBy("o_custkey").agg(F.countDistinct(F.trunc("day", "month")).alias("active"), F.sum("price").alias("price"))
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (
        spine.join(spent, "o_custkey", "left").join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment")
        .agg(F.sum("exposure").alias("exposure_months"), F.sum(F.coalesce("active", F.lit(0))).alias("active_months"), F.sum(F.coalesce("price", F.lit(0))).cast("decimal(18,2)").alias("spent"))
        .withColumn("low_exposure", F.col("exposure_months") < 12)
    )


@query("""
with f as (select user_id, event_id, value > 80 as suspicious from events),
u as (select user_id, count(*) as n, count(*) filter (where suspicious) as bad from f group by 1), t as (select count(*) as total from f)
select f.event_id, f.user_id, u.n, u.bad, n::double / total::double as share, bad::double / n::double as bad_share
from f join u on f.user_id = u.user_id cross join t
""")
def cross_params_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row with its group's counts and the group's share of the grand total."""
    flagged = read(spark, sf_dir, "events").select("event_id", "user_id", (F.col("value") > 80).alias("suspicious"))
    by_user = flagged.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if("suspicious").alias("bad"))
    total = by_user.agg(F.sum("n").alias("total"))
    rates = by_user.crossJoin(F.broadcast(total))  # one row
    return flagged.join(rates, "user_id").select("event_id", "user_id", "n", "bad", (F.col("n").cast("double") / F.col("total").cast("double")).alias("share"), (F.col("bad").cast("double") / F.col("n").cast("double")).alias("bad_share"))
