"""Mixing sources to target weights by capped water-filling.

A source of weight w and size s (words) gets the target ``min(level * w, cap * s)``;
``level`` is the one at which the targets sum to the budget.  It is found in closed
form: sources in the order of ``cap * s / w`` are clamped one by one, and the
running sums tell after how many the rest fits.  This is where repeated clamping
and proportional redistribution end.

A target is ``f`` times its source's size.  Every document is taken whole
``floor(f)`` times, and the rest is filled with whole documents in the order of a
seeded hash; the document in which the target falls is taken in part.  Running
sums over a source would need one task for its documents, so sums of hash ranges
(``RANGES`` a source, then ``RANGES`` within the one in which the target falls; partial aggregates over a narrow table
of sizes) close in on that document, and texts are read once more to be compared with it.

Defined results: null texts have size 0, texts of any length are counted whole; an empty table gives no rows; sources of
size 0 take nothing; rows that share an id and a size are interchangeable; new columns replace others of their names, all
other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.textkit import load, without_columns
from tessera.session import discard, materialize

WEIGHTS = (5, 2, 1)
BUDGET, CAP = 1.5, 2.0
SEED = "mix-1"
RANGES = 4096
#: A plan of more sources than this is joined without a broadcast.
SOURCE_ROWS = 100_000


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def cycled_weights(sources: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """Weights 5, 2, 1, 5, ... along the sources by code point, null last (one row per source, so one task is enough)."""
    at = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, budget: Column | None = None, cap: float = CAP) -> DataFrame:
    """Append ``target`` to ``source, source_size, weight``; the budget is 1.5 times all sizes unless given."""
    every = W.partitionBy()
    total = budget if budget is not None else BUDGET * F.sum("source_size").over(every)
    order = W.orderBy("ratio", "cap", "weight", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    rows = sources.withColumn("cap", cap * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = rows.withColumn("__budget", total).withColumn("__caps", F.coalesce(F.sum("cap").over(order), F.lit(0.0)))
    before = before.withColumn("__weights", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)))
    # The level if exactly the sources before this one are clamped; the first that fits is right.
    before = before.withColumn("__level", (F.col("__budget") - F.col("__caps")) / F.col("__weights"))
    level = F.min(F.when(F.col("__level") <= F.col("ratio"), F.struct("ratio", F.col("__level").alias("level")))).over(every)["level"]
    return before.withColumn("__at", level).select("source", "source_size", "weight", F.when(F.col("__at").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("__at") * F.col("weight"))).alias("target"))


def seeded(column: str, seed: str = SEED) -> Column:
    """28 bits of a hash of the id that any SQL engine can compute."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(column).cast("string"), F.lit("null")))), 1, 7), 16, 10).cast("long")


def _close_in(sizes: DataFrame, plan: DataFrame, width: int) -> DataFrame:
    """For each source of ``plan`` the hash range of ``width`` in which its rest is reached: ``source, cut, before``."""
    rows = sizes.join(plan, F.col("__source").eqNullSafe(F.col("source"))).where("lo is null or __h between lo and hi")
    sums = rows.groupBy("__source", F.floor(F.col("__h") / width).alias("range")).agg(F.sum("__size").alias("words"), F.max("rest").alias("rest"), F.max("before").alias("before"))
    upto = W.partitionBy("__source").orderBy("range").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = sums.withColumn("upto", F.col("before") + F.sum("words").over(upto)).where("upto >= rest")
    return sums.groupBy("__source").agg(F.min(F.struct("range", (F.col("upto") - F.col("words")).alias("before"))).alias("c")).select("__source", F.col("c.range").alias("cut"), "c.before")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weigh: Callable[[DataFrame], DataFrame] = cycled_weights, seed: str = SEED) -> DataFrame:
    """Append ``size, source_size, target, copies`` (whole repetitions) and ``taken`` (words, repeats counted)."""
    spark, kept = docs.sparkSession, []
    docs = docs.withColumns({"__source": F.col(f"`{source}`"), "__id": F.col(f"`{id_col}`"), "__h": seeded(id_col, seed), "__size": word_count(F.col(f"`{text}`"))})
    names = without_columns(docs, ["size", "source_size", "target", "copies", "taken", "__source", "__id", "__h", "__size"]).columns
    sizes = materialize(docs.select("__source", "__id", "__h", "__size"), "sizes", kept)
    totals = sizes.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"))
    plan = materialize(water_fill(weigh(totals)), "targets", kept)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0).cast("long"))
    plan = plan.withColumn("whole", whole).withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    few = plan.count() <= SOURCE_ROWS
    near = F.broadcast if few else lambda x: x
    at = plan.select("source", "rest", F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"), F.lit(0).cast("long").alias("before"))
    for width in ((1 << 28) // RANGES, (1 << 28) // RANGES // RANGES):
        cut = _close_in(sizes, near(at), width).select("__source", (F.col("cut") * width).alias("lo"), ((F.col("cut") + 1) * width - 1).alias("hi"), "before")
        at = materialize(plan.select("source", "rest").join(cut, F.col("source").eqNullSafe(F.col("__source"))).select("source", "rest", "lo", "hi", "before"), "cuts", kept)
    # The documents of one narrow range are put in order; rows of one key are interchangeable, so they are one step.
    inside = sizes.join(near(at), F.col("__source").eqNullSafe(F.col("source"))).where("__h between lo and hi")
    inside = inside.groupBy("__source", "__h", "__id", "__size").agg(F.count("*").alias("rows"), F.max("rest").alias("rest"), F.max("before").alias("before"))
    order = W.partitionBy("__source").orderBy("__h", "__id", "__size").rowsBetween(W.unboundedPreceding, -1)
    inside = inside.withColumn("before", F.col("before") + F.coalesce(F.sum(F.col("rows") * F.col("__size")).over(order), F.lit(0).cast("long")))
    key = F.struct("__h", "__id", "__size")
    edge = inside.where(F.col("before") + F.col("rows") * F.col("__size") >= F.col("rest")).groupBy(F.col("__source").alias("__s")).agg(F.min(F.struct(key.alias("key"), "before", "rows")).alias("e"))
    plan = plan.join(edge, F.col("source").eqNullSafe(F.col("__s")), "left").select(F.col("source").alias("__p"), "source_size", "target", "whole", "rest", "e.key", "e.before", "e.rows")
    plan = materialize(plan.withColumnsRenamed({c: f"__{c}" for c in ("source_size", "target", "whole", "rest", "key", "before", "rows")}), "plan")
    joined = docs.join(near(plan), F.col("__source").eqNullSafe(F.col("__p")))
    # Documents before the one in which the target falls are in, those after it are out.
    left = F.greatest(F.lit(0).cast("long"), F.col("__rest") - F.col("__before"))
    part = F.when(key < F.col("__key"), F.col("__size")).when(key > F.col("__key"), F.lit(0).cast("long"))
    if plan.where("__rows > 1").isEmpty():
        joined = joined.withColumn("__part", F.coalesce(part, F.least("__size", left)))
    else:  # of equal rows at the edge each takes what those before it leave
        tied = joined.where(part.isNull()).withColumn("__n", F.row_number().over(W.partitionBy("__source").orderBy(F.lit(1))) - 1)
        tied = tied.withColumn("__part", F.greatest(F.lit(0).cast("long"), F.least(F.col("__size"), left - F.col("__n") * F.col("__size")))).drop("__n")
        joined = tied.unionByName(joined.withColumn("__part", part).where(F.col("__part").isNotNull()))
    discard(spark, kept)
    return joined.select(*[F.col(f"`{c}`") for c in names], F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__whole").alias("copies"), (F.col("__whole") * F.col("__size") + F.coalesce("__part", F.lit(0))).alias("taken"))


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: a row for each repetition of each document, the partial one cut to its words."""
    mixed = mix(docs.withColumnsRenamed({c: f"d_{c}" for c in docs.columns}), "d_doc_id", "d_text", "d_source")
    full = F.sequence(F.lit(1), F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int"))
    rest = F.col("taken") - F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0)) * F.col("size")
    times = F.when(F.col("taken") >= F.col("size"), full).otherwise(F.array().cast("array<int>"))
    times = F.when((F.col("size") > 0), times).otherwise(F.array().cast("array<int>"))
    pieces = F.concat(F.transform(times, lambda i: F.struct(i.alias("repetition"), F.col("size").alias("words"))), F.when(rest > 0, F.array(F.struct((F.size(times) + 1).alias("repetition"), rest.alias("words")))).otherwise(F.array().cast("array<struct<repetition:int,words:bigint>>")))
    rows = mixed.withColumn("piece", F.explode(pieces))
    words = F.filter(F.split("d_text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    text = F.when(F.col("piece.words") == F.col("size"), F.col("d_text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.col("piece.words").cast("int")), " "))
    out = [text.alias("text") if c == "text" else F.col(f"`d_{c}`").alias(c) for c in docs.columns]
    return rows.select(*out, F.col("piece.repetition").alias("mix_repetition"), F.col("piece.words").alias("mix_words"))


QUERIES = {"op10_mixture": op10_mixture}

ORACLE = {
    "op10_mixture": f"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    ('0x' || substring(md5('{SEED}:' || coalesce(doc_id::varchar, 'null')), 1, 7))::bigint as h from documents),
s as (select source, sum(size)::bigint as source_size from d group by 1),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight from s),
c as (select *, 2.0::double * source_size as cap, 2.0::double * source_size / weight as ratio from w),
p as (select *, ({BUDGET}::double * (select sum(source_size) from s) - coalesce(sum(cap) over before, 0.0::double))
      / (sum(weight) over () - coalesce(sum(weight) over before, 0.0::double)) as level
  from c window before as (order by ratio, cap, weight, source nulls last rows between unbounded preceding and 1 preceding)),
t as (select source, source_size, least(cap, weight * (select level from p where level <= ratio order by ratio, level limit 1)) as target from p),
u as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from t),
v as (select *, round(target - whole * source_size)::bigint as rest from u),
x as (select d.doc_id, d.size, v.source_size, v.target, v.whole, v.rest,
    coalesce(sum(d.size) over (partition by d.source order by h, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from d join v on d.source is not distinct from v.source)
select doc_id, size, source_size, target, (whole * size + greatest(0, least(size, rest - before)))::bigint as taken from x
"""
}
