"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimforge.llm.common import quoted, store, tag

WEIGHTS = (5, 2, 1)
MOST = 3
SEEDS = 32


def words(text: str) -> Column:
    """Maximal runs of characters other than ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, share: float = 1.0) -> DataFrame:
    """Add ``target`` to ``(source, source_size)``: the words that the mix takes from each source.

    Sources by code point, null last, weigh as ``weights`` repeating. A target is
    ``least(most * source_size, level * weight)`` with the one level that makes the targets sum to
    ``share`` of all sizes (or to all caps, if these are less): the fixed point of handing what is
    over the caps to the others by weight. The level follows from running sums over the sources in
    the order in which they reach their caps. There is one row per source here, not per document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, everything = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    return (
        sources.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * float(most))
        .withColumn("total", F.sum("source_size").over(everything) * share)
        .withColumn("level_here", level)
        # capping a source that is over its cap raises the level, capping another lowers it: the level is the greatest
        .withColumn("level", F.max("level_here").over(everything))
        .withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
        .select("source", "source_size", "target")
    )


def copies(rate: Column, key: Column, seed: Column) -> Column:
    """floor(rate) and one more with probability its fraction, by a hash of the key and the seed.

    Two 32-bit words of the key's md5 give all the seeds' draws: word1 + seed * word2.
    """
    word = [F.conv(F.substring(F.md5(key), 1 + 8 * i, 8), 16, 10).cast("long") for i in range(2)]
    draw = ((word[0] + seed * word[1]) % F.lit(1 << 32)).cast("double") / float(1 << 32)
    return F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")


def draw_key(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def recipe(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seeds: int = SEEDS, share: float = 1.0) -> DataFrame:
    """(source, source_size, target, rate, seed) from stored ``(doc_id, source, size)`` rows."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    aimed = store(targets(per_source, weights, most, share).withColumn("rate", rate), "targets")
    trial = sized.join(aimed, sized["source"].eqNullSafe(aimed["source"])).groupBy(aimed["source"], "target").agg(
        *(F.sum(F.col("size") * copies(F.col("rate"), draw_key("doc_id"), F.lit(k))).alias(f"t{k}") for k in range(seeds))
    )
    off = F.array(*(F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k).alias("k")) for k in range(seeds)))
    chosen = store(trial.select("source", F.array_min(off)["k"].alias("seed")), "seeds")
    return aimed.join(chosen, aimed["source"].eqNullSafe(chosen["source"])).drop(chosen["source"])


def sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return store(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(text).alias("size")), "sizes")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """How often each row of ``docs`` goes into the mix.

    Returns ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``
    (size times copies). Copies are floor(rate), and one more with probability equal to the
    fraction of the rate by a hash of the id. Of ``seeds`` seeds of that hash, each source uses the
    one that brings its taken words nearest to its target (ties to the smallest seed); so the same
    table always gives the same mix. ``options``: weights, most, seeds, share.

    A null text has size 0. A null source is a source of its own. A null id is hashed as an empty
    text; rows that share an id get equally many copies. A source without words has target 0 and
    its documents are not taken. Other columns are not carried. An empty table gives an empty one.
    Sizes are added up per source before any shuffle, so a source of any share is no hot spot.
    """
    sized = sizes(docs, doc_id, text, source)
    ready = recipe(sized, **options)
    return (
        sized.join(ready, sized["source"].eqNullSafe(ready["source"]))
        .withColumn("copies", copies(F.col("rate"), draw_key("doc_id"), F.col("seed")))
        .select("doc_id", sized["source"], "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs``, all columns, with every row repeated as often as :func:`mix` takes it."""
    names = {c: tag(c) for c in ("source", "rate", "seed")}
    ready = recipe(sizes(docs, doc_id, text, source), **options).select(*(F.col(c).alias(k) for c, k in names.items()))
    n = copies(F.col(names["rate"]), draw_key(doc_id), F.col(names["seed"])).cast("int")
    columns, copy = [docs[quoted(c)] for c in docs.columns], tag("copy")
    return docs.join(ready, docs[source].eqNullSafe(ready[names["source"]])).select(*columns, F.explode(F.array_repeat(F.lit(0), n)).alias(copy)).drop(copy)


def op4_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Mixes all ``documents`` to weights 5, 2, 1 over the sources."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = """
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size, md5(coalesce(doc_id::varchar, '')) as h
  from documents),
s as (select source, sum(size)::bigint as source_size from sized group by 1),
w as (select *, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight, source_size * 3.0::double as cap from s),
l as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
    / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as here from w),
t as (select source, source_size, least(cap, weight * max(here) over ()) as target from l),
r as (select *, case when source_size > 0 then target / source_size else 0 end as rate from t),
d as (select doc_id, sized.source, size, source_size, target, rate, ('0x' || substr(h, 1, 8))::bigint as a, ('0x' || substr(h, 9, 8))::bigint as b
  from sized join r on sized.source is not distinct from r.source),
trial as (select source, k, abs(sum(size * (floor(rate) + (((a + k * b) % 4294967296) / 4294967296.0::double < rate - floor(rate))::int)) - any_value(target)) as off
  from d, (select unnest(range(32)) as k) group by 1, 2),
best as (select source, k from trial qualify row_number() over (partition by source order by off, k) = 1)
select doc_id, size, source_size, target,
  (size * (floor(rate) + (((a + k * b) % 4294967296) / 4294967296.0::double < rate - floor(rate))::int))::bigint as taken
from d join best on d.source is not distinct from best.source
"""
