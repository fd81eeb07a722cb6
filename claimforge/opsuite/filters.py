"""Filters and projections: ranges, lists, patterns, three-valued logic, CASE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.functions import age_band, age_years
from claimforge.opsuite.registry import query
from claimforge.opsuite.tables import money, read


@query("""
with o as (select *, nullif(o_orderstatus, 'P') as status from orders)
select o_orderkey, status, o_orderpriority, status not in ('F') as not_failed, status is distinct from 'O' as differs from o
where o_totalprice between 1000 and 250000 and o_orderpriority in ('1-URGENT', '2-HIGH') and (status not in ('F') or status is null)
""")
def filter_between_inlist_3vl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BETWEEN, IN, NOT IN and IS DISTINCT FROM, where null is unknown."""
    status = F.nullif("o_orderstatus", F.lit("P"))
    orders = read(spark, sf_dir, "orders").withColumn("status", status)
    chosen = orders.filter(F.col("o_totalprice").between(1000, 250000) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (~F.col("status").isin("F") | F.col("status").isNull()))
    return chosen.select("o_orderkey", "status", "o_orderpriority", (~F.col("status").isin("F")).alias("not_failed"), (~F.col("status").eqNullSafe("O")).alias("differs"))


@query("""
select p_partkey, p_name, regexp_matches(p_name, '^(red|small) ') as starts, regexp_matches(p_brand, '(?i)^BRAND#1[0-9]$') as teens,
  not regexp_matches(p_type, 'E') as no_e, p_name like '%_ing' as has_ing
from part where regexp_matches(p_brand, '^Brand#[0-9]+$') and p_name like '%i%'
""")
def regex_like_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns that must, must not, or case-insensitively match, and LIKE with both wildcards."""
    part = read(spark, sf_dir, "part").filter(F.col("p_brand").rlike("^Brand#[0-9]+$") & F.col("p_name").like("%i%"))
    return part.select(
        "p_partkey", "p_name", F.col("p_name").rlike("^(red|small) ").alias("starts"), F.col("p_brand").rlike("(?i)^BRAND#1[0-9]$").alias("teens"),
        (~F.col("p_type").rlike("E")).alias("no_e"), F.col("p_name").like("%_ing").alias("has_ing"),
    )


@query("""
with a as (select o_orderkey, o_orderstatus, date_part('year', age(timestamp '2026-02-28', o_orderdate))::bigint as years from orders)
select o_orderkey, years, case when years < 35 then 'Under 35' when years < 45 then '35-44' else '45-54' end as band,
  case o_orderstatus when 'F' then 'final' when 'O' then 'open' end as status_name
from a
""")
def case_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed years, their band, and a simple CASE without a default."""
    years = age_years(F.col("o_orderdate"), F.lit("2026-02-28").cast("date"))
    status = F.when(F.col("o_orderstatus") == "F", "final").when(F.col("o_orderstatus") == "O", "open")
    return read(spark, sf_dir, "orders").select("o_orderkey", years.alias("years"), age_band(years).alias("band"), status.alias("status_name"))


@query("""
select p_partkey, p_type, p_size, coalesce(nullif(p_name, 'small ring'),
  case when p_type = 'ECONOMY' and p_size = 11 then 'economy eleven' when p_type = 'STANDARD' and p_size = 7 then 'standard seven' when p_type = 'ECONOMY' then 'economy' end) as name
from part
""")
def imputation_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing name imputed from a lookup on two columns."""
    kind, size = F.col("p_type"), F.col("p_size")
    found = F.when((kind == "ECONOMY") & (size == 11), "economy eleven").when((kind == "STANDARD") & (size == 7), "standard seven").when(kind == "ECONOMY", "economy")
    return read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", F.coalesce(F.nullif("p_name", F.lit("small ring")), found).alias("name"))


@query("""
select l_orderkey, l_linenumber, l_quantity, l_extendedprice::decimal(12,2) as price from lineitem
where l_quantity > 0 and abs(l_extendedprice::decimal(12,2) - (l_quantity::decimal(12,2) * 1000)::decimal(14,2)) <= 2500.01
""")
def line_validity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose amount is near quantity times a unit price, in exact decimals."""
    price, quantity = money("l_extendedprice"), money("l_quantity")
    near = F.abs(price - (quantity * 1000).cast("decimal(14,2)")) <= F.lit("2500.01").cast("decimal(8,2)")
    return read(spark, sf_dir, "lineitem").filter((F.col("l_quantity") > 0) & near).select("l_orderkey", "l_linenumber", "l_quantity", price.alias("price"))


@query("""
select event_id, isodow(ts) in (6, 7) as weekend, hour(ts - interval 6 hour)::int as local_hour,
  isodow(ts - interval 6 hour) in (6, 7) or hour(ts - interval 6 hour) < 6 as odd_time from events
""")
def weekend_hour_tz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday and hour in a zone without daylight saving time."""
    local = F.from_utc_timestamp("ts", "America/Regina")
    return read(spark, sf_dir, "events").select(
        "event_id", (F.weekday("ts") >= 5).alias("weekend"), F.hour(local).alias("local_hour"), ((F.weekday(local) >= 5) | (F.hour(local) < 6)).alias("odd_time")
    )
