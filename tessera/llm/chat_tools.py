"""Tool-call linking for chat formatting, with DataFrame expressions alone.

Calls and results meet in an equi-join on (conversation, call id).  Arguments are
parsed as VARIANT, whose objects keep their fields sorted by name, so ``to_json``
of one is canonical; their field types are held against a schema table.  A call's
level is one more than the highest level of the calls it depends on.  Chains are
contracted by pointer doubling, in rounds that grow with the logarithm of their
length, before calls with several dependencies are settled; each round is a written
table.  ``(topo_level, seq)`` orders a conversation's calls.

Defined results: rows with a null conversation or call id are left out; of several
results for one id the smallest text counts, and ``n_results`` tells their number;
repeated calls each get a row; a dependency on a missing call is reported and
ignored for the order; calls in or behind a cycle have a null level; arguments that are null
or no JSON object are reported; a tool without a schema, or of null name, is reported; texts of any
length are handled whole; other columns of the inputs are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.llm.textkit import load
from tessera.session import discard, materialize, new_path

KEY = ["conv_id", "call_id"]

#: A schema table has a row for each field of each tool: more rows than this are joined without a broadcast.
SCHEMA_ROWS = 100_000


def json_type(kind: Column) -> Column:
    """The JSON-schema type of what schema_of_variant tells."""
    return (
        F.when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "VOID", "null")
        .when((kind == "BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE") | (kind == "FLOAT"), "number")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .otherwise(F.lower(kind))
    )


def validate(calls: DataFrame, schemas: DataFrame, arguments: str = "arguments", name: str = "name") -> DataFrame:
    """Append ``errors``: what is wrong with each call's arguments, sorted.

    ``schemas`` has ``tool, field, type, required``; ``type`` is a JSON-schema type name, and an integer is a number too.
    """
    fields = schemas.groupBy("tool").agg(F.array_sort(F.collect_set(F.struct("field", "type", "required"))).alias("__fields"))
    fields = fields.withColumnRenamed("tool", "__tool")
    if schemas.limit(SCHEMA_ROWS + 1).count() <= SCHEMA_ROWS:
        fields = F.broadcast(fields)
    parsed = calls.withColumn("__parsed", F.try_parse_json(arguments))
    is_object = F.coalesce(F.schema_of_variant("__parsed").startswith("OBJECT"), F.lit(False))
    # A map of raw variants, then of type names, so that everything below is one row's work.
    types = F.transform_values(F.from_json(F.when(is_object, F.col(arguments)), "map<string,variant>"), lambda _, v: json_type(F.schema_of_variant(v)))
    row = parsed.withColumn("__ok", is_object).withColumn("__types", types).join(fields, F.col(name) == F.col("__tool"), "left")
    known = F.transform("__fields", lambda f: f["field"])
    extra = F.transform(F.array_except(F.map_keys("__types"), known), lambda k: F.concat(F.lit("unknown field: "), k))
    missing = F.transform(F.filter("__fields", lambda f: f["required"] & ~F.array_contains(F.map_keys("__types"), f["field"])), lambda f: F.concat(F.lit("missing field: "), f["field"]))

    def wrong(f: Column) -> Column:
        has = F.element_at("__types", f["field"])
        return has.isNotNull() & (has != f["type"]) & ~((has == "integer") & (f["type"] == "number"))

    bad = F.transform(F.filter("__fields", wrong), lambda f: F.concat(F.lit("wrong type: "), f["field"]))
    errors = (
        F.when(F.col("__fields").isNull(), F.array(F.lit("unknown tool")))
        .when(~F.col("__ok"), F.array(F.lit("arguments are no JSON object")))
        .otherwise(F.array_sort(F.concat(extra, missing, bad)))
    )
    return row.withColumn("errors", errors).select(*[F.col(f"`{c}`") for c in calls.columns], "errors")


def topo_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Levels of the nodes ``(conv_id, call_id)`` that depend on others by ``(conv_id, call_id, needs)``.

    Returns ``conv_id, call_id, level`` of those whose dependencies can all be met; nodes without edges have no row
    (their level is 0), nodes in or behind a cycle have none either.

    A level is the largest of ``w + level(needs)`` over a node's edges, and an edge to nowhere (null ``needs``) gives
    ``w`` alone.  Each round contracts all nodes with one open edge or none (``_contract``) and puts what they
    stand for into the edges of the others, so a round takes away whole chains, however long, and all that becomes a
    chain thereby.  Rounds end when no edge is open, or when those left all lead into cycles.
    """
    spark = nodes.sparkSession
    out, left, kept = new_path(spark, "levels"), [], []
    schema = nodes.select(*KEY, F.lit(0).cast("long").alias("level")).schema
    spark.createDataFrame([], schema).write.parquet(out)
    inner = edges.select("conv_id", F.col("needs").alias("call_id")).distinct().join(edges.select(*KEY).distinct(), KEY, "left_semi")
    inner = materialize(inner.withColumnRenamed("call_id", "needs").withColumn("__open", F.lit(True)), "edges", kept)
    graph = edges.distinct().join(inner, ["conv_id", "needs"], "left")
    graph = graph.select(*KEY, F.when(F.col("__open"), F.col("needs")).alias("needs"), F.lit(1).cast("long").alias("w")).distinct()
    graph, before = materialize(graph, "edges", kept), None
    while True:
        open_ = F.col("needs").isNotNull()
        state = graph.groupBy(*KEY).agg(F.count("needs").alias("n"), F.max("needs").alias("needs"), F.max(F.when(open_, F.col("w"))).alias("w"), F.coalesce(F.max(F.when(~open_, F.col("w"))), F.lit(0).cast("long")).alias("base"))
        state = materialize(state, "calls", kept)
        several = state.where("n > 1")
        lines = _contract(state.where("n <= 1").drop("n"), kept)
        lines.where("needs is null").select(*KEY, F.col("base").alias("level")).write.mode("append").parquet(out)
        left.append(lines.where("needs is not null"))
        if several.isEmpty():
            break
        place = lines.select("conv_id", F.col("call_id").alias("needs"), F.col("needs").alias("to"), F.col("w").alias("far"), "base")
        rows = graph.join(several.select(*KEY), KEY, "left_semi").join(place, ["conv_id", "needs"], "left")
        both = F.array(F.struct(F.col("to").alias("needs"), (F.col("w") + F.col("far")).alias("w")), F.struct(F.lit(None).cast("string").alias("needs"), (F.col("w") + F.col("base")).alias("w")))
        rows = rows.withColumn("e", F.explode(F.when(F.col("base").isNull(), F.array(F.struct("needs", "w"))).otherwise(both)))
        graph = rows.where("e.w is not null").groupBy(*KEY, F.col("e.needs").alias("needs")).agg(F.max("e.w").alias("w"))
        graph = materialize(graph, "edges", kept)
        size = graph.where(open_).count()
        if size == before:
            break
        before = size
    # What waits for a later round's node: the last round's first.
    for lines in reversed(left):
        if not lines.isEmpty():
            known = spark.read.schema(schema).parquet(out).withColumnRenamed("call_id", "needs")
            met = lines.join(known, ["conv_id", "needs"]).select(*KEY, F.greatest("base", F.col("w") + F.col("level")).alias("level"))
            met.write.mode("append").parquet(out)
    discard(spark, kept)
    return spark.read.schema(schema).parquet(out)


def _contract(lines: DataFrame, kept: list[str]) -> DataFrame:
    """Follow ``needs`` through ``lines`` to its end by pointer doubling.

    ``(conv_id, call_id, needs, w, base)`` says that the level is the larger of ``base`` and ``w + level(needs)``, or
    ``base`` if ``needs`` is null; returns such rows whose ``needs`` is null or no line.  Each round doubles
    the reach of every pointer, and chains lie within conversations, so after as many rounds as the
    largest number of a conversation's lines has binary digits only cycles are left open, and they have no rows.
    """
    now = lines.withColumn("more", F.col("needs").isNotNull())
    rounds = most = 0
    while True:
        now = materialize(now.observe(seen := Observation(), F.count_if("more").alias("more")), "lines", kept)
        if not seen.get["more"]:
            break
        if rounds == 4:  # short chains are done by now
            most = lines.groupBy("conv_id").count().agg(F.max("count")).first()[0].bit_length()
        if rounds >= 4 and rounds > most:
            now = now.where("not more")
            break
        rounds += 1
        to = now.select("conv_id", F.col("call_id").alias("needs"), F.col("needs").alias("__needs"), F.col("w").alias("__w"), F.col("base").alias("__base"), F.col("more").alias("__more"))
        step = now.where("more").join(to, ["conv_id", "needs"], "left")
        met = F.col("__base").isNotNull()
        step = step.select(
            *KEY,
            F.when(met, F.col("__needs")).otherwise(F.col("needs")).alias("needs"),
            F.when(met, F.col("w") + F.col("__w")).otherwise(F.col("w")).alias("w"),
            F.when(met, F.greatest("base", F.col("w") + F.col("__base"))).otherwise(F.col("base")).alias("base"),
            F.coalesce("__more", F.lit(False)).alias("more"),
        )
        now = now.where("not more").unionByName(step)
    return now.drop("more")


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Link, order, validate and serialise tool calls.

    ``calls``: ``conv_id, call_id, seq, name, arguments, depends_on`` (array of call ids);
    ``results``: ``conv_id, call_id, content``.  Returns a row per call with
    ``topo_level, seq, status, n_results, errors, canonical_json``.
    """
    spark, kept = calls.sparkSession, []
    calls = calls.where("conv_id is not null and call_id is not null").select("conv_id", "call_id", "seq", "name", "arguments", "depends_on")
    found = results.where("conv_id is not null and call_id is not null").groupBy(*KEY).agg(F.min("content").alias("content"), F.count("*").alias("n_results"))
    ids = calls.select(*KEY).distinct()
    wanted = calls.select("conv_id", "call_id", F.explode("depends_on").alias("needs")).where("needs is not null").distinct()
    wanted = wanted.join(ids.select("conv_id", F.col("call_id").alias("needs"), F.lit(True).alias("known")), ["conv_id", "needs"], "left")
    wanted = materialize(wanted, "needs", kept)
    edges = wanted.where("known").select(*KEY, "needs")
    levels = topo_levels(ids, edges)
    # All that is known of a call id is folded into one row, so calls are shuffled once.
    lost = F.when(F.col("known").isNull(), F.concat(F.lit("missing dependency: "), "needs"))
    facts = found.unionByName(wanted.select(*KEY, lost.alias("lost"), F.col("known").alias("bound")), allowMissingColumns=True).unionByName(levels, allowMissingColumns=True)
    facts = facts.groupBy(*KEY).agg(F.max("content").alias("content"), F.max("n_results").alias("n_results"), F.array_sort(F.collect_set("lost")).alias("lost"), F.max("bound").alias("bound"), F.max("level").alias("level"))
    facts = materialize(facts, "facts")
    discard(spark, kept)
    row = validate(calls, schemas).join(facts, KEY, "left")
    cyclic = F.coalesce(F.col("bound") & F.col("level").isNull(), F.lit(False))
    none = F.array().cast("array<string>")
    errors = F.array_sort(F.concat("errors", F.coalesce("lost", none), F.when(cyclic, F.array(F.lit("dependency cycle"))).otherwise(none)))
    parsed = F.coalesce(F.try_parse_json("arguments"), F.to_variant_object(F.struct(F.col("arguments").alias("raw"))))
    # Keys stand in code-point order, and the arguments' own keys are sorted by VARIANT.
    canonical = F.to_json(F.struct(parsed.alias("arguments"), F.col("call_id").alias("id"), F.col("name"), F.col("content").alias("result")), {"ignoreNullFields": "false"})
    return row.select(
        *KEY,
        F.when(~cyclic, F.coalesce("level", F.lit(0))).alias("topo_level"),
        "seq",
        F.when(F.col("n_results").isNull(), "missing_result").otherwise("linked").alias("status"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.array_join(errors, "; ").alias("errors"),
        canonical.alias("canonical_json"),
    )


def orphan_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results that no call asked for."""
    return results.join(calls.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti")


def turn_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations read as calls and results.

    The table holds no tool calls, so its turns stand for some, flaws included.  An assistant turn is the result of the
    call one turn before it.  Every other turn calls a tool named after its role (null is an unknown tool) with its text and turn as
    arguments: of every 7 text lengths one gives broken JSON, of every 5 a turn as a string, of every 3 a field too many.
    A call needs that of two turns before (whether it is one or not), the call of turn 1 that of turn 0, and a system turn with a
    comma the call of the next turn, which closes a cycle.
    """
    ident = lambda t: F.concat(F.lit("call_"), t.cast("string"))
    turn, role = F.col("turn"), F.col("role")
    size = F.coalesce(F.length("text"), F.lit(1))
    options = {"ignoreNullFields": "false"}
    arguments = (
        F.when(size % 7 == 0, F.concat(F.lit("{"), "text"))
        .when(size % 5 == 0, F.to_json(F.struct("text", turn.cast("string").alias("turn")), options))
        .when(size % 3 == 0, F.to_json(F.struct(size.alias("size"), "text", "turn"), options))
        .otherwise(F.to_json(F.struct("text", "turn"), options))
    )
    needs = F.array_compact(F.array(F.when(turn >= 2, ident(turn - 2)).when(turn == 1, ident(turn - 1)), F.when((role == "system") & F.col("text").contains(","), ident(turn + 1))))
    asks = conversations.where(~role.eqNullSafe("assistant")).select("conv_id", ident(turn).alias("call_id"), turn.alias("seq"), role.alias("name"), arguments.alias("arguments"), needs.alias("depends_on"))
    answers = conversations.where(role == "assistant").select("conv_id", ident(turn - 1).alias("call_id"), F.coalesce("text", F.lit("")).alias("content"))
    return asks, answers


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks, answers = turn_calls(load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    schemas = spark.sql(
        "select * from values ('user','text','string',true), ('user','turn','integer',true), ('system','text','string',true), ('system','turn','integer',true) as t(tool, field, type, required)"
    )
    return link_calls(asks, answers, schemas)


QUERIES = {"op2_tool_calls": op2_tool_calls}

ORACLE = {
    "op2_tool_calls": """
with recursive c as (
  select conv_id, 'call_' || turn as call_id, turn, role, text, coalesce(length(text), 1) as size from conversations
  where role is distinct from 'assistant' and conv_id is not null and turn is not null),
r as (select conv_id, 'call_' || (turn - 1) as call_id, min(coalesce(text, '')) as content, count(*) as n_results
  from conversations where role = 'assistant' and conv_id is not null group by all),
w as (select conv_id, turn, case when turn >= 2 then turn - 2 when turn = 1 then 0 end as needs from c
  union select conv_id, turn, turn + 1 from c where role = 'system' and contains(text, ',')),
e as (select distinct w.* from w join c d on d.conv_id = w.conv_id and d.turn = w.needs),
lost as (select conv_id, turn, list(distinct 'missing dependency: call_' || needs) as ls from w
  where needs is not null and not exists (select 1 from c d where d.conv_id = w.conv_id and d.turn = w.needs) group by all),
reach as (select conv_id, turn, needs from e union select reach.conv_id, reach.turn, e.needs from reach join e on e.conv_id = reach.conv_id and e.turn = reach.needs),
ring as (select conv_id, turn from reach where turn = needs),
dead as (select conv_id, turn from ring union select reach.conv_id, reach.turn from reach join ring on ring.conv_id = reach.conv_id and ring.turn = reach.needs),
lv as (
  select conv_id, turn, 0 as level from c where not exists (select 1 from e where e.conv_id = c.conv_id and e.turn = c.turn)
  union
  select e.conv_id, e.turn, lv.level + 1 from lv join e on e.conv_id = lv.conv_id and e.needs = lv.turn
  where not exists (select 1 from dead where dead.conv_id = e.conv_id and dead.turn = e.turn)),
top as (select conv_id, turn, max(level)::bigint as level from lv group by all),
x as (select c.*, r.content, r.n_results, top.level, lost.ls, exists (select 1 from dead where dead.conv_id = c.conv_id and dead.turn = c.turn) as is_dead
  from c left join r on r.conv_id = c.conv_id and r.call_id = c.call_id left join top on top.conv_id = c.conv_id and top.turn = c.turn left join lost on lost.conv_id = c.conv_id and lost.turn = c.turn)
select conv_id, call_id, level as topo_level, turn as seq,
  case when n_results is null then 'missing_result' else 'linked' end as status,
  coalesce(n_results, 0) as n_results,
  array_to_string(list_sort(list_concat(coalesce(ls, []), case when is_dead then ['dependency cycle'] else [] end,
    case when role is null or role not in ('user', 'system') then ['unknown tool']
      when size % 7 = 0 then ['arguments are no JSON object']
      else list_concat(case when text is null then ['wrong type: text'] else [] end,
        case when size % 5 = 0 then ['wrong type: turn'] when size % 3 = 0 then ['unknown field: size'] else [] end) end)), '; ') as errors,
  '{"arguments":{' || case when size % 7 = 0 then '"raw":' || to_json('{' || text)::varchar
      when size % 5 = 0 then '"text":' || coalesce(to_json(text)::varchar, 'null') || ',"turn":"' || turn || '"'
      when size % 3 = 0 then '"size":' || size || ',"text":' || coalesce(to_json(text)::varchar, 'null') || ',"turn":' || turn
      else '"text":' || coalesce(to_json(text)::varchar, 'null') || ',"turn":' || turn end
    || '},"id":"' || call_id || '","name":' || coalesce(to_json(role)::varchar, 'null') || ',"result":' || coalesce(to_json(content)::varchar, 'null') || '}' as canonical_json
from x
"""
}
