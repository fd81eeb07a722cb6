"""Normalising and parsing functions over text made from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge import functions as fn
from claimforge.opsuite.registry import query
from claimforge.opsuite.tables import read


@query("""
with t as (select c_custkey, '  ' || lower(c_name) || ' ' as raw, c_mktsegment || ' - Group' as cat from customer)
select c_custkey, upper(trim(raw, ' ')) as id, regexp_replace(lower(trim(cat, ' ')), '[\\s-]+', '_', 'g') as category, nullif(trim(repeat(' ', (c_custkey % 3)::int), ' '), '') as blank from t
""")
def normalize_id_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    raw = F.concat(F.lit("  "), F.lower("c_name"), F.lit(" "))
    category = F.concat("c_mktsegment", F.lit(" - Group"))
    blank = F.expr("repeat(' ', int(c_custkey % 3))")
    return customer.select("c_custkey", fn.normalize_id(raw).alias("id"), fn.normalize_category(category).alias("category"), fn.clean_text(blank).alias("blank"))


@query("""
with t as (select c_custkey, '(306) ' || lpad((c_custkey % 1000)::varchar, 3, '0') || '-' || lpad((c_custkey * 7 % 10000)::varchar, 4, '0') as phone,
  case c_custkey % 4 when 0 then 's4p' || (c_custkey % 10) || 'y2' when 1 then ' H2X 1Y' || (c_custkey % 10) || ' ' when 2 then 'x0a0h0' else '12345' end as postal from customer),
p as (select *, upper(regexp_replace(trim(postal, ' '), '\\s+', '', 'g')) as packed from t),
q as (select *, case when regexp_matches(packed, '^[A-Z][0-9][A-Z][0-9][A-Z][0-9]$') then substr(packed, 1, 3) || ' ' || substr(packed, 4, 3) else upper(trim(postal, ' ')) end as code from p)
select c_custkey, '+1' || regexp_replace(phone, '[^0-9]', '', 'g') as phone, code as postal,
  case substr(code, 1, 1) when 'S' then 'SK' when 'H' then 'QC' when 'X' then case when c_custkey % 8 = 2 then 'NU' else 'NT' end end as province
from q
""")
def normalize_phone_postal(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    digit = (key % 10).cast("string")
    phone = F.concat(F.lit("(306) "), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit("-"), F.lpad((key * 7 % 10000).cast("string"), 4, "0"))
    postal = (
        F.when(key % 4 == 0, F.concat(F.lit("s4p"), digit, F.lit("y2"))).when(key % 4 == 1, F.concat(F.lit(" H2X 1Y"), digit, F.lit(" "))).when(key % 4 == 2, "x0a0h0").otherwise("12345")
    )
    city = F.when(key % 8 == 2, " Iqaluit").otherwise("Yellowknife")
    return read(spark, sf_dir, "customer").select("c_custkey", fn.normalize_phone(phone).alias("phone"), fn.normalize_postal(postal).alias("postal"), fn.postal_province(postal, city).alias("province"))


@query("""
with t as (select c_custkey, ['Sask.', 'p.e.i.', ' ontario', 'NWT', 'British-Columbia', ' ', 'Québec'][(c_custkey % 7 + 1)::int] as raw,
    ['Female', 'm', 'Non-Binary', 'unknown', ''][(c_custkey % 5 + 1)::int] as sex from customer)
select c_custkey, case c_custkey % 7 when 0 then 'SK' when 1 then 'PE' when 2 then 'ON' when 3 then 'NWT' when 4 then 'BC' when 6 then 'QUÉBEC' end as province,
  case c_custkey % 5 when 0 then 'F' when 1 then 'M' when 2 then 'X' when 3 then 'UNKNOWN' end as gender from t
""")
def province_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("c_custkey") % len(values) + 1).cast("int"))
    places = pick(["Sask.", "p.e.i.", " ontario", "NWT", "British-Columbia", " ", "Québec"])
    genders = pick(["Female", "m", "Non-Binary", "unknown", ""])
    return read(spark, sf_dir, "customer").select("c_custkey", fn.normalize_province(places).alias("province"), fn.normalize_gender(genders).alias("gender"))


@query("""
with t as (select o_orderkey, case o_orderkey % 4 when 0 then '$' || o_totalprice::decimal(12,2) when 1 then o_totalprice::decimal(12,2) || ' CAD' when 2 then '1,' || o_orderkey || '.5' else 'abc' end as raw from orders)
select o_orderkey, try_cast(trim(replace(replace(regexp_replace(raw, '(?i)\\s*CAD\\s*$', ''), '$', ''), ',', ''), ' ') as decimal(18,2)) as amount from t
""")
def parse_amount_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, key = F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.col("o_orderkey")
    raw = F.when(key % 4 == 0, F.concat(F.lit("$"), price)).when(key % 4 == 1, F.concat(price, F.lit(" CAD"))).when(key % 4 == 2, F.concat(F.lit("1,"), key.cast("string"), F.lit(".5"))).otherwise("abc")
    return read(spark, sf_dir, "orders").select("o_orderkey", fn.parse_amount(raw).cast("decimal(18,2)").alias("amount"))


@query("""
with t as (select o_orderkey, o_orderdate::date as d from orders)
select o_orderkey, case o_orderkey % 5 when 4 then null else d end as dmy, case when o_orderkey % 5 in (0, 2) then d end as compact from t
""")
def parse_date_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO, day first, month name, day first without padding, and a day that does not exist."""
    key, day = F.col("o_orderkey") % 5, F.to_date("o_orderdate")
    form = lambda f: F.date_format(day, f)
    dmy = F.when(key == 0, form("yyyy-MM-dd")).when(key == 1, form("dd/MM/yyyy")).when(key == 2, form("MMM d, yyyy")).when(key == 3, form("d/M/yyyy")).otherwise("31/02/2024")
    compact = F.when(key == 0, form("yyyyMMdd")).when(key == 2, form("MMM d, yyyy")).otherwise("20240230")
    return read(spark, sf_dir, "orders").select("o_orderkey", fn.parse_date(dmy, "DMY").alias("dmy"), fn.parse_date(compact, "YYYYMMDD").alias("compact"))


@query("""
select event_id, case event_id % 4 when 0 then true when 1 then false end as flag, case event_id % 3 when 0 then event_id::int when 1 then -(event_id::int) end as n from events
""")
def parse_bool_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    flag = F.when(key % 4 == 0, " TRUE ").when(key % 4 == 1, "f").when(key % 4 == 2, "yes").otherwise("")
    number = F.when(key % 3 == 0, F.concat(F.lit("+"), key.cast("string"))).when(key % 3 == 1, F.concat(F.lit("-"), key.cast("string"))).otherwise("1e3")
    return read(spark, sf_dir, "events").select("event_id", fn.parse_boolean(flag).alias("flag"), fn.parse_integer(number).alias("n"))


@query("""
with t as (select p_partkey, p_name || '-o''NEIL' as raw from part),
c as (select p_partkey, unnest(string_split(raw, '')) as ch, generate_subscripts(string_split(raw, ''), 1) as i from t),
f as (select *, lag(ch) over (partition by p_partkey order by i) as before from c)
select p_partkey, string_agg(case when before is null or not regexp_matches(before, '[A-Za-z0-9]') then upper(ch) else lower(ch) end, '' order by i) as title from f group by 1
""")
def initcap_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", fn.initcap_words(F.concat("p_name", F.lit("-o'NEIL"))).alias("title"))


@query("""
select s_suppkey, md5(s_name) as name_hash, left(s_name, 4) || '***' as redacted, length(s_name) as n, replace(s_name, '#', ' ') as spaced, 'supplier[' || s_suppkey || '].name' as path from supplier
""")
def pii_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names reduced to a hash and a stub, with a formatted path."""
    return read(spark, sf_dir, "supplier").select(
        "s_suppkey", F.md5("s_name").alias("name_hash"), F.concat(F.left("s_name", F.lit(4)), F.lit("***")).alias("redacted"), F.length("s_name").cast("long").alias("n"),
        F.replace("s_name", F.lit("#"), F.lit(" ")).alias("spaced"), F.format_string("supplier[%s].name", F.col("s_suppkey")).alias("path"),
    )
