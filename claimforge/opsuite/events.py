"""Semi-structured rows and rule events: JSON, rule rows, quarantine, cascades, issue counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.operators.drift import Field, audit
from claimforge.opsuite.registry import query
from claimforge.opsuite.tables import read


@query("""
select event_id, (props::json->>'$.k')::int as k, json_exists(props::json, '$.k') as has_k, json_exists(props::json, '$.missing') as has_missing,
  case when json_type(props::json, '$.k') in ('UBIGINT', 'BIGINT') then 'number' else lower(json_type(props::json, '$.k')) end as kind from events
""")
def json_extract_keys_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths, presence of keys, and the family of a value's type."""
    v = F.try_parse_json("props")
    keys = F.json_object_keys("props")
    kind = F.schema_of_variant(F.variant_get(v, "$.k", "variant"))
    family = F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE)"), "number").otherwise(F.lower(kind))
    return read(spark, sf_dir, "events").select(
        "event_id", F.try_variant_get(v, "$.k", "int").alias("k"), F.array_contains(keys, "k").alias("has_k"), F.array_contains(keys, "missing").alias("has_missing"), family.alias("kind")
    )


@query("""
with e as (select event_id, '[' || (props::json->>'$.k') || ',"' || event_type || '",null]' as items from events),
x as (select event_id, unnest(from_json(items::json, '["json"]')) as item, unnest(range(3))::int as pos from e)
select event_id, pos, json_extract_string(item, '$') as item from x
""")
def json_explode_ordinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The elements of an array with their positions; a JSON null is a null."""
    items = F.concat(F.lit("["), F.get_json_object("props", "$.k"), F.lit(',"'), F.col("event_type"), F.lit('",null]'))
    parsed = F.try_variant_get(F.try_parse_json(items), "$", "array<string>")
    return read(spark, sf_dir, "events").select("event_id", F.posexplode(parsed).alias("pos", "item"))


@query("""
with e as (select event_id, ' ' || upper(event_type) || ' ' as raw, event_type as clean, value::decimal(12,2) as value from events)
select event_id, 'FMT_CATEGORY_CASE' as rule, 'event_type' as field, raw as before, clean as after from e where raw is distinct from clean
union all select event_id, 'TYPE_AMOUNT_TEXT', 'value', '$' || value, value::varchar from e where value > 50
""")
def lateral_rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per field that a rule changed: one array of structs, taken apart once."""
    raw, value = F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")), F.col("value").cast("decimal(12,2)")
    rule = lambda on, name, field, before, after: F.when(on, F.struct(F.lit(name).alias("rule"), F.lit(field).alias("field"), before.alias("before"), after.alias("after")))
    rules = F.array_compact(F.array(
        rule(~raw.eqNullSafe(F.col("event_type")), "FMT_CATEGORY_CASE", "event_type", raw, F.col("event_type")),
        rule(value > 50, "TYPE_AMOUNT_TEXT", "value", F.concat(F.lit("$"), value.cast("string")), value.cast("string")),
    ))
    return read(spark, sf_dir, "events").select("event_id", F.inline(rules))


#: What the documents of ``json_drift_walk`` must look like.
ORDER_DOCUMENT = [
    Field("order_id", legacy=("OrderID",)),
    Field("lines", "array", drifted=("object",), legacy=("orderLines",)),
    Field("tags", "array", drifted=("string",), required="error"),
    Field("customer.segment", required="error"),
    Field("clerk", required="warning"),
    Field("lines[*].quantity", "number", drifted=("string",)),
    Field("customer.balance", "number", drifted=("string",)),
]


@query("""
with l as (select l_orderkey as k, row_number() over (partition by l_orderkey order by l_linenumber, l_quantity) - 1 as place, count(*) over (partition by l_orderkey) as n, l_quantity::bigint as q from lineitem),
o as (select o_orderkey as k, (floor(c_acctbal))::bigint as balance from orders join customer on o_custkey = c_custkey),
e as (
  select k, 'JSON_KEY_DRIFT' as rule_id, 'order_id' as field_name, 'warning' as severity, 'normalized' as action, 'OrderID' as original_value, 'order_id' as clean_value, '{"legacy_key":"OrderID"}' as details from o where k % 7 = 0
  union all select k, 'JSON_KEY_DRIFT', 'lines', 'warning', 'normalized', 'orderLines', 'lines', '{"legacy_key":"orderLines"}' from o where k % 5 = 0 and k in (select k from l)
  union all select distinct k, 'JSON_SHAPE_DRIFT', 'lines', 'warning', 'normalized', 'object', 'array', '{"source_shape":"object","target_shape":"array"}' from l where n = 1
  union all select k, 'JSON_SHAPE_DRIFT', 'tags', 'warning', 'normalized', 'string', 'array', '{"source_shape":"string","target_shape":"array"}' from o where k % 3 = 1
  union all select k, 'JSON_MISSING_KEY', 'tags', 'error', 'flagged', null, null, '{"key_absent":true}' from o where k % 3 = 2
  union all select k, 'JSON_MISSING_KEY', 'customer.segment', 'error', 'flagged', null, null, '{"key_absent":true}' from o where k % 11 = 0
  union all select k, 'JSON_MISSING_KEY', 'clerk', 'warning', 'flagged', null, null, '{"key_absent":true}' from o where k % 13 = 0
  union all select k, 'JSON_TYPE_DRIFT', 'lines[' || place || '].quantity', 'warning', 'normalized', q::varchar, null, '{"source_type":"string","target_type":"number"}' from l where q % 10 = 0
  union all select k, 'JSON_TYPE_DRIFT', 'customer.balance', 'warning', 'normalized', balance::varchar, null, '{"source_type":"string","target_type":"number"}' from o where k % 17 = 0)
select k as o_orderkey, rule_id, field_name, severity, action, original_value, clean_value, details from e
""")
def json_drift_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift of a document for each order: old names, other shapes and types, missing keys, with paths into arrays.

    Documents are made of orders, customers and lines, with drift by rules of the keys, and parsed again.
    """
    text = lambda *parts: F.concat(*(x if not isinstance(x, str) else F.lit(x) for x in parts))
    number = F.col("l_quantity").cast("long")
    quoted = lambda when, x: F.when(when, text('"', x, '"')).otherwise(x)
    line = text('{"quantity":', quoted(number % 10 == 0, number.cast("string")), ',"unit":null}')
    held = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity", line.alias("line"))))  # the few lines of an order
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(held, lambda x: x.line).alias("lines"))
    k, balance = F.col("o_orderkey"), F.floor("c_acctbal").cast("string")
    parts = [
        text(F.when(k % 7 == 0, '"OrderID":').otherwise('"order_id":'), k.cast("string")),
        F.when(F.col("lines").isNotNull(), text(F.when(k % 5 == 0, '"orderLines":').otherwise('"lines":'), F.when(F.size("lines") == 1, F.col("lines")[0]).otherwise(text("[", F.array_join("lines", ","), "]")))),
        F.when(k % 3 == 0, '"tags":["a","b"]').when(k % 3 == 1, '"tags":"a,b"'),
        text('"customer":{"balance":', quoted(k % 17 == 0, balance), F.when(k % 11 == 0, "").otherwise(',"segment":null'), "}"),
        F.when(k % 13 != 0, '"clerk":"C1"'),
    ]
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(customer, F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    made = orders.select("o_orderkey", text("{", F.concat_ws(",", *parts), "}").alias("text"))
    # the walk costs far more than the bytes of a document tell, so adaptive execution must not put them on a few cores
    dealt = made.repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    return audit(dealt.select("o_orderkey", F.try_parse_json("text").alias("payload")), "payload", ORDER_DOCUMENT)


CASCADE = """
with c as (select c_custkey, case when c_acctbal < 0 then 'rejected' else 'accepted' end as status from customer where c_custkey % 17 <> 0),
o as (select o_orderkey, o_custkey, case when c.c_custkey is null then 'ORPHAN_FK' when c.status = 'rejected' then 'UPSTREAM_PARENT_REJECTED' when o_totalprice < 5000 then 'INVALID_REQUIRED' end as reason
  from orders left join c on o_custkey = c_custkey),
l as (select l_orderkey, l_linenumber, case when o.o_orderkey is null then 'ORPHAN_FK' when o.reason is not null then 'UPSTREAM_PARENT_REJECTED' when l_quantity < 2 then 'INVALID_REQUIRED' end as reason
  from lineitem left join o on l_orderkey = o_orderkey)
"""


def cascade(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders and lines with the reason for which they are rejected, from their parents down."""
    customer = read(spark, sf_dir, "customer").filter("c_custkey % 17 <> 0").select("c_custkey", (F.col("c_acctbal") < 0).alias("c_bad"))
    reason = F.when(F.col("c_custkey").isNull(), "ORPHAN_FK").when(F.col("c_bad"), "UPSTREAM_PARENT_REJECTED").when(F.col("o_totalprice") < 5000, "INVALID_REQUIRED")
    orders = read(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "o_custkey", reason.alias("reason"))
    parent = orders.select("o_orderkey", F.col("reason").alias("parent_reason"))
    own = F.when(F.col("o_orderkey").isNull(), "ORPHAN_FK").when(F.col("parent_reason").isNotNull(), "UPSTREAM_PARENT_REJECTED").when(F.col("l_quantity") < 2, "INVALID_REQUIRED")
    lines = read(spark, sf_dir, "lineitem").join(parent, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("l_orderkey", "l_linenumber", own.alias("reason"))
    return orders, lines


@query(CASCADE + "select 'order' as layer, coalesce(reason, 'accepted') as status, count(*) as n from o group by 2 union all select 'line', coalesce(reason, 'accepted'), count(*) from l group by 2")
def fk_cascade_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda df, name: df.groupBy(F.lit(name).alias("layer"), F.coalesce("reason", F.lit("accepted")).alias("status")).agg(F.count("*").alias("n"))
    orders, lines = cascade(spark, sf_dir)
    return count(orders, "order").unionByName(count(lines, "line"))


@query(CASCADE + """, q as (select 'orders' as source, o_orderkey as key, reason from o where reason is not null union all select 'lineitem', l_orderkey, reason from l where reason is not null),
have as (select 'orders' as source, o_orderkey as key from orders where o_orderstatus = 'P')
select distinct source, key, reason from q where not exists (select 1 from have where have.source = q.source and have.key is not distinct from q.key)""")
def quarantine_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows as quarantine entries, unless one is there already."""
    orders, lines = cascade(spark, sf_dir)
    entry = lambda df, source, key: df.filter("reason is not null").select(F.lit(source).alias("source"), F.col(key).alias("key"), "reason")
    new = entry(orders, "orders", "o_orderkey").unionByName(entry(lines, "lineitem", "l_orderkey"))
    have = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.lit("orders").alias("h_source"), F.col("o_orderkey").alias("h_key"))
    return new.join(have, (F.col("source") == F.col("h_source")) & F.col("key").eqNullSafe(F.col("h_key")), "left_anti").distinct()


@query("""
with i as (select user_id, event_type from events where event_type in ('error', 'purchase') and value > 20)
select c_custkey, coalesce(count(event_type), 0)::int as issues from customer left join i on user_id = c_custkey group by 1
""")
def dq_issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues counted per record, 0 where there are none."""
    issues = read(spark, sf_dir, "events").filter(F.col("event_type").isin("error", "purchase") & (F.col("value") > 20)).groupBy("user_id").agg(F.count("*").alias("n"))
    customer = read(spark, sf_dir, "customer").select("c_custkey")
    return customer.join(issues, customer.c_custkey == issues.user_id, "left").select("c_custkey", F.coalesce("n", F.lit(0)).cast("int").alias("issues"))
