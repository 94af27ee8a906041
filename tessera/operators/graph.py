"""The property graph as node and edge tables, and queries over it.

A label is a table, a relationship type a two-column edge table.  MERGE is an
aggregate by key: attributes set on creation take the first value in document
order (``min_by``), attributes set every time the last (``max_by``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.text import electrolyte, numeric_and_unit, precursor_name, precursor_role, profile_text
from tessera.operators import documents as D
from tessera.operators.vector import top_k
from tessera.session import materialize

# The properties that a material's profile names.
KEY_PROPERTIES = ("specific_capacitance", "energy_density", "specific_surface_area", "capacitance_retention")


def merge_nodes(rows: DataFrame, key: str, order: Column, on_create: list[str] = (), on_match: list[str] = ()) -> DataFrame:
    """One row per non-null key; ``on_create`` columns take the first, ``on_match`` the last value in order."""
    first = [F.min_by(c, order).alias(c) for c in on_create]
    last = [F.max_by(c, order).alias(c) for c in on_match]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*(first + last or [F.count("*").alias("mentions")]))


def merge_edges(rows: DataFrame, src: Column | str, dst: Column | str, once: bool = False) -> DataFrame:
    """Distinct edges with both ends; ``once`` says that none comes twice, so that no row need be shuffled."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (src, dst))
    edges = rows.select(a.cast("string").alias("src_id"), b.cast("string").alias("dst_id")).where("src_id is not null and dst_id is not null")
    return edges if once else edges.distinct()


def build_graph(docs: DataFrame) -> dict[str, DataFrame]:
    """Node and edge tables of extracted documents (``documents.extraction`` with normalised values).

    A condition whose name mentions an electrolyte merges one electrolyte node by name; other conditions
    become test conditions with a number and unit split off.  Edges of a document whose DOI no other one has are distinct by
    their place in it; only those of the others are merged by a shuffle.
    """
    parts = _by_repeated_doi(docs)
    # Routes are read once: most tables below are made of them.
    routes = [materialize(D.step_rows(part), "steps") for part, _ in parts]
    mats, props, conds, steps = D.materials(docs), D.properties(docs), D.conditions(docs), D.identified_steps(reduce(DataFrame.union, routes))
    place = F.struct("doi", "material_index")
    g: dict[str, DataFrame] = {}
    g["paper_source"] = merge_nodes(docs.select("doi", "title"), "doi", F.col("title"), on_match=["title"])
    own = mats.select(
        "material_id", F.coalesce("name", F.lit("")).alias("name"), F.coalesce("original_name", "name").alias("original_name"), F.coalesce("formula", F.lit("")).alias("chemical_formula"), "role",
        F.coalesce("electrolyte", F.lit(False)).alias("is_electrolyte"), F.lit(None).cast("string").alias("components_json"), F.lit(None).cast("string").alias("solvent"),
    )
    is_el = _is_electrolyte()
    el = _electrolytes(conds)
    nodes = merge_nodes(el, "name", F.struct("doi", "material_index", "property_index", "condition_index"), on_match=["components_json", "solvent"])
    nodes = nodes.select(D.uid("elec", "name").alias("material_id"), "name", F.col("name").alias("original_name"), F.lit("").alias("chemical_formula"), F.lit("electrolyte").alias("role"), F.lit(True).alias("is_electrolyte"), "components_json", "solvent")
    g["material"] = own.union(nodes)
    g["morphology"] = mats.where("morphology is not null and morphology <> ''").select(F.col("morphology").alias("description")).distinct()
    g["synthesis_step"] = steps.select("step_id", "step_order", F.coalesce("method", F.lit("")).alias("description"))
    g["synthesis_method"] = steps.where("method is not null and method <> ''").select(F.col("method").alias("name")).distinct()
    pre = steps.select("doi", "material_index", "step_order", "step_id", F.posexplode("precursors").alias("pos", "original_name"))
    pre = pre.withColumns({"name": precursor_name("original_name"), "role_hint": precursor_role("original_name")})
    g["precursor"] = merge_nodes(pre, "name", F.struct("doi", "material_index", "step_order", "pos"), on_create=["original_name", "role_hint"])
    par = steps.select("doi", "step_id", F.posexplode("parameters").alias("pos", "q")).select("doi", "step_id", D.uid("param", "step_id", "pos").alias("parameter_id"), "q.*")
    g["parameter"] = par.select("parameter_id", F.col("parameter_name").alias("name"), D.variant_text("value").alias("value"), "unit", "description", "original_unit", D.variant_text("original_value").alias("original_value"))
    g["property"] = props.select("property_id", "property_name", "original_property_name", F.col("value_text").alias("value"), "unit", F.col("original_value_text").alias("original_value"), "original_unit", variant_number("value").alias("number"))
    split = numeric_and_unit("value_text")
    plain = conds.where(~is_el)
    g["test_condition"] = plain.select("condition_id", "condition_name", F.coalesce(split["num"].cast("string"), "value_text").alias("value"), F.coalesce(F.nullif(split["unit"], F.lit("")), "unit", F.lit("")).alias("unit"), F.col("value_text").alias("raw_value"))

    everything = [mats.select(F.col("material_id").alias("i"), "doi"), steps.select("step_id", "doi"), pre.select(D.uid("prec", "name"), "doi"), props.select("property_id", "doi"), el.select(D.uid("elec", "name"), "doi")]
    reported = everything[0]
    for other in everything[1:]:
        reported = reported.union(other)
    g["REPORTED_IN"] = merge_edges(reported, "i", "doi")
    edges = [_edges(part, D.identified_steps(rows), once) for (part, once), rows in zip(parts, routes, strict=True)]
    return g | {name: reduce(DataFrame.union, [e[name] for e in edges]) for name in edges[0]}


def _is_electrolyte() -> Column:
    return F.lower(F.coalesce("condition_name", F.lit(""))).contains("electrolyte")


def _electrolytes(conds: DataFrame) -> DataFrame:
    el = conds.where(_is_electrolyte() & F.col("value_text").isNotNull() & (F.col("value_text") != "")).withColumn("e", electrolyte("value_text"))
    return el.withColumns({"name": F.col("e.original"), "components_json": F.to_json("e.components"), "solvent": F.col("e.solvent")})


def _by_repeated_doi(docs: DataFrame) -> list[tuple[DataFrame, bool]]:
    """Documents whose DOI no other one has (true), and the rest, if any; blank DOIs are among the rest, as ids take null for a blank."""
    more = docs.groupBy("doi").agg(F.count("*").alias("n")).where("n > 1 or doi is null or doi = ''").select(F.col("doi").alias("again"))
    more = materialize(more, "repeated")
    if more.isEmpty():
        return [(docs, True)]
    same = F.col("doi").eqNullSafe(F.col("again"))
    return [(materialize(docs.join(more, same, how), "part"), how == "left_anti") for how in ("left_anti", "left_semi")]


def _edges(docs: DataFrame, steps: DataFrame, once: bool) -> dict[str, DataFrame]:
    """The edges between the parts of documents; ``once`` says that no DOI repeats, so a place in a document names one row."""
    mats, props, conds = D.materials(docs), D.properties(docs), D.conditions(docs)
    par = steps.select("step_id", F.posexplode("parameters").alias("pos", "q")).select("step_id", D.uid("param", "step_id", "pos").alias("parameter_id"))
    names = F.transform("precursors", lambda p: precursor_name(p))
    used = steps.select("step_id", F.explode(F.array_distinct(names)).alias("name"))
    # A step's place names the one before it.
    after = steps.where("step_order > 1").select(D.uid("step", "doi", "material_index", F.col("step_order") - 2).alias("src_id"), F.col("step_id").alias("dst_id"))
    # A property with one condition has one electrolyte at most; those of several are merged.
    el = [merge_edges(_electrolytes(c), "property_id", D.uid("elec", "name"), once and single) for c, single in ((conds.where("n_conditions = 1"), True), (conds.where("n_conditions > 1"), False))]
    return {
        "HAS_MORPHOLOGY": merge_edges(mats.where("morphology <> ''"), "material_id", "morphology", once),
        "PRODUCED_BY": merge_edges(steps, "material_id", "step_id", once),
        "NEXT_STEP": after if once else next_links(steps, "material_id", "step_order", "step_id"),
        "USES_METHOD": merge_edges(steps.where("method <> ''"), "step_id", "method", once),
        "USES_PRECURSOR": merge_edges(used, "step_id", "name", once),
        "HAS_PARAMETER": merge_edges(par, "step_id", "parameter_id", once),
        "EXHIBITS_PROPERTY": merge_edges(props, "material_id", "property_id", once),
        "MEASURED_UNDER": merge_edges(conds.where(~_is_electrolyte()), "property_id", "condition_id", once),
        "USING_ELECTROLYTE": el[0].union(el[1]) if once else merge_edges(_electrolytes(conds), "property_id", D.uid("elec", "name")),
    }


def next_links(rows: DataFrame, group: str, order: str, id_col: str) -> DataFrame:
    """Edges from each row of a group to the next in order; a group of one has none."""
    before = rows.withColumn("src_id", F.lag(id_col).over(W.partitionBy(group).orderBy(order)))
    return before.where("src_id is not null").select(F.col("src_id").cast("string").alias("src_id"), F.col(id_col).cast("string").alias("dst_id"))


def violations(nodes: DataFrame, key: str) -> DataFrame:
    """Keys that a unique constraint would refuse, with their number of rows."""
    return nodes.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1))


def write_graph(graph: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """One Parquet table per label and relationship below ``path``."""
    for name, df in graph.items():
        df.write.mode(mode).parquet(f"{path}/{name}")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; the rest stays."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


# ---- queries -------------------------------------------------------------------


def numeric(value: Column | str) -> Column:
    """A stored text as a number, if it spells one."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), v.try_cast("double"))


def variant_number(value: Column | str) -> Column:
    """The number that a VARIANT leaf is; a text is none, even if it spells one."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(F.schema_of_variant(v).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(v, "$", "double"))


def search_with_property(vectors: DataFrame, probe: list[float], exhibits: DataFrame, props: DataFrame, name: str, least: float, k: int = 20, limit: int = 10, coerce: bool = True) -> DataFrame:
    """Top k materials, then those with a property above a bound: one row per material and property, best first.

    With ``coerce`` texts that spell numbers count; without it only values that are numbers do, which the
    column ``number`` of the property table holds.
    """
    best = F.broadcast(top_k(vectors, probe, k))
    number = numeric("value") if coerce else F.col("number")
    p = props.where((F.col("property_name") == name) & (number > least)).select(F.col("property_id").alias("dst_id"), "property_name", "value", "unit")
    rows = best.join(exhibits, F.col("id") == F.col("src_id")).join(p, "dst_id")
    return rows.orderBy(F.desc("score"), "id", "dst_id").limit(limit).drop("src_id")


def search_with_profile(vectors: DataFrame, probe: list[float], exhibits: DataFrame, props: DataFrame, names: list[str], k: int = 10) -> DataFrame:
    """Top k materials with the largest value of each named property, as text (``max``) and as a number (``max_num``).

    Each property is aggregated before it is joined, so several of them do not multiply rows; the k winners are
    found once and written.
    """
    out = best = materialize(top_k(vectors, probe, k), "winners")
    for n in names:
        mine = exhibits.join(F.broadcast(best.select("id")), F.col("src_id") == F.col("id")).join(props.where(F.col("property_name") == n).withColumnRenamed("property_id", "dst_id"), "dst_id")
        agg = mine.groupBy("id").agg(F.max("value").alias(f"{n}_max"), F.max(numeric("value")).alias(f"{n}_max_num"), F.max("unit").alias(f"{n}_unit"))
        out = out.join(agg, "id", "left")
    return out.orderBy(F.desc("score"), "id")


def labelled_search(vectors: DataFrame, probe: list[float], nodes: DataFrame, label: Column, k: int) -> DataFrame:
    """Top k first, then a label predicate; fewer rows than k may come back."""
    return F.broadcast(top_k(vectors, probe, k)).join(nodes, "id").where(label).orderBy(F.desc("score"), "id")


def profiles(graph: dict[str, DataFrame], names: tuple = KEY_PROPERTIES, most: int = 5) -> DataFrame:
    """``material_id, text`` for every material that is no electrolyte; each branch is aggregated before it is joined."""
    m = graph["material"].where(~F.col("is_electrolyte"))
    morph = graph["HAS_MORPHOLOGY"].groupBy("src_id").agg(F.min("dst_id").alias("morphology"))
    of_step = graph["PRODUCED_BY"].select(F.col("src_id").alias("mat"), F.col("dst_id").alias("step"))
    methods = of_step.join(graph["USES_METHOD"].withColumnRenamed("src_id", "step"), "step").groupBy("mat").agg(F.array_sort(F.collect_set("dst_id")).alias("methods"))
    used = graph["USES_PRECURSOR"].select(F.col("src_id").alias("step"), F.col("dst_id").alias("name")).join(graph["precursor"], "name")
    precursors = of_step.join(used, "step").groupBy("mat").agg(F.array_sort(F.collect_set("original_name")).alias("precursors"))
    p = graph["property"].where(F.col("property_name").isin(*names)).withColumnRenamed("property_id", "dst_id")
    p = graph["EXHIBITS_PROPERTY"].join(p, "dst_id").select(F.col("src_id").alias("mat"), "property_name", F.coalesce("original_value", "value").alias("v"), F.coalesce("original_unit", "unit").alias("u"), numeric("value").alias("num"))
    p = p.groupBy("mat", "property_name", "v", "u").agg(F.max("num").alias("num"))
    order = W.partitionBy("mat").orderBy(F.desc_nulls_last("num"), F.desc_nulls_last("v"), "property_name", "u")
    p = p.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most)
    p = p.groupBy("mat").agg(F.array_sort(F.collect_list(F.struct("r", F.col("property_name").alias("name"), F.col("v").alias("value"), F.col("u").alias("unit")))).alias("props"))
    row = m.join(morph, m["material_id"] == morph["src_id"], "left")
    for branch in (methods, precursors, p):
        row = row.join(branch, row["material_id"] == branch["mat"], "left").drop("mat")
    none = F.array().cast("array<string>")
    text = profile_text(F.col("name"), F.col("original_name"), F.col("role"), F.col("morphology"), F.coalesce("methods", none), F.coalesce("precursors", none), F.coalesce("props", F.array().cast("array<struct<r:int,name:string,value:string,unit:string>>")))
    return row.select("material_id", text.alias("text"))


def set_attribute(nodes: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """Set a column of the nodes that ``values (key, column)`` names, to the largest value of a repeated key; others keep theirs."""
    v = values.groupBy(F.col(key).alias("__k")).agg(F.max(column).alias("__v"))
    out = nodes if column in nodes.columns else nodes.withColumn(column, F.lit(None).cast(values.schema[column].dataType))
    return out.join(v, F.col(key) == F.col("__k"), "left").withColumn(column, F.coalesce("__v", column)).drop("__k", "__v")
