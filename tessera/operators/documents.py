"""Extracted documents: JSON scans, nested arrays to rows, generic walks, validation."""

from __future__ import annotations

import json
import math
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.text import DASHES, doi_to_file, normalize_text, strip
from tessera.schemas import EXTRACTION, STEP
from tessera.session import materialize

# ---- scans ------------------------------------------------------------------


def read_json_dir(spark: SparkSession, path: str, recursive: bool = False, suffix: str = "*.json") -> DataFrame:
    """``file_path, text, doc`` of whole JSON files; a file that is no JSON has a null ``doc``."""
    rows = spark.read.text(path, wholetext=True, pathGlobFilter=suffix, recursiveFileLookup=recursive).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text"))
    return rows.withColumn("doc", F.try_parse_json("text"))


def good(scanned: DataFrame) -> DataFrame:
    return scanned.where("doc is not null")


def bad(scanned: DataFrame) -> DataFrame:
    """Quarantine: paths of files that could not be parsed."""
    return scanned.where("doc is null").select("file_path")


def extraction(scanned: DataFrame, text: str = "text") -> DataFrame:
    """Parse extracted documents; the DOI defaults to the file's stem."""
    stem = F.regexp_replace(F.element_at(F.split("file_path", "/"), -1), r"\.json$", "")
    doc = F.from_json(text, EXTRACTION, {"mode": "PERMISSIVE"})
    return scanned.withColumn("d", doc).select("file_path", F.coalesce(F.nullif(F.col("d.metadata.doi"), F.lit("")), stem).alias("doi"), F.col("d.metadata.title").alias("title"), F.coalesce(F.col("d.materials"), F.array().cast(f"array<{EXTRACTION.split('materials:array<', 1)[1][:-2]}>")).alias("materials"))


# ---- nested arrays to rows -----------------------------------------------------


def uid(prefix: str, *parts: Column | str) -> Column:
    """A deterministic id: prefix and 16 hex digits of the hash of what identifies the row."""
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(F.concat_ws("|", *cols), 256), 1, 16))


def materials(docs: DataFrame) -> DataFrame:
    """A row per material with its 0-based position."""
    rows = docs.select("doi", F.posexplode("materials").alias("material_index", "m"))
    return rows.select("doi", "material_index", uid("mat", "doi", "material_index").alias("material_id"), "m.*")


def name_records(docs: DataFrame) -> DataFrame:
    """``doi, material_index, raw_name, formula, role`` of materials with a non-empty name."""
    rows = materials(docs).where("name is not null and name <> ''")
    return rows.select("doi", "material_index", strip("name").alias("raw_name"), "formula", "role")


def properties(docs: DataFrame) -> DataFrame:
    """A row per property; values are text (objects as JSON) next to the variant."""
    rows = materials(docs).select("doi", "material_index", "material_id", F.posexplode("performance_and_properties").alias("property_index", "p"))
    out = rows.select("doi", "material_index", "material_id", "property_index", uid("prop", "doi", "material_index", "property_index").alias("property_id"), "p.*")
    return out.withColumns({"value_text": variant_text("value"), "original_value_text": variant_text("original_value")})


def conditions(docs: DataFrame) -> DataFrame:
    rows = properties(docs).select("doi", "material_index", "property_index", "property_id", F.size("test_conditions").alias("n_conditions"), F.posexplode("test_conditions").alias("condition_index", "c"))
    out = rows.select("doi", "material_index", "property_index", "property_id", "n_conditions", "condition_index", uid("cond", "doi", "material_index", "property_index", "condition_index").alias("condition_id"), "c.*")
    return out.withColumn("value_text", variant_text("value"))


def step_rows(docs: DataFrame) -> DataFrame:
    """A row per synthesis step with its 0-based place, without ids; a single object is a list of one."""
    route = F.col("synthesis_route")
    kind = F.schema_of_variant(route)
    as_list = F.when(kind.startswith("ARRAY"), F.try_variant_get(route, "$", f"array<{STEP}>")).when(kind.startswith("OBJECT"), F.array(F.try_variant_get(route, "$", STEP)))
    return materials(docs).select("doi", "material_index", F.posexplode(as_list).alias("pos", "s")).select("doi", "material_index", "pos", "s.*")


def identified_steps(rows: DataFrame) -> DataFrame:
    """Rows of ``step_rows`` with the ids of material and step, numbered from 1."""
    ids = [uid("mat", "doi", "material_index").alias("material_id"), uid("step", "doi", "material_index", "pos").alias("step_id")]
    return rows.select("doi", "material_index", *ids, (F.col("pos") + 1).alias("step_order"), "method", "precursors", "parameters")


def steps(docs: DataFrame) -> DataFrame:
    """A row per synthesis step, numbered from 1."""
    return identified_steps(step_rows(docs))


def variant_text(c: Column | str) -> Column:
    """A leaf as text: strings bare, everything else as JSON."""
    v = F.col(c) if isinstance(c, str) else c
    kind = F.schema_of_variant(v)
    return F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind != "VOID", F.to_json(v))


def units_used(docs: DataFrame) -> DataFrame:
    """``unit`` of properties, conditions and parameters: non-empty strings, stripped (one row per occurrence)."""
    params = steps(docs).select(F.explode("parameters").alias("p")).select(F.col("p.unit").alias("unit"))
    every = properties(docs).select("unit").union(conditions(docs).select("unit")).union(params)
    return every.select(strip("unit").alias("unit")).where("unit is not null and unit <> ''")


# ---- walks over arbitrary JSON -------------------------------------------------


def _walk(make: Callable[[object], Iterator[tuple]], schema: str, df: DataFrame, key: str, text: str) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in schema.split(", ")]
        for part in parts:
            out = []
            for k, t in zip(part[key], part[text], strict=True):
                try:
                    doc = json.loads(t) if t is not None else None
                except ValueError:
                    continue
                out += [(k, *row) for row in make(doc)]
            yield pd.DataFrame(out, columns=names)

    return df.select(key, text).mapInPandas(run, schema)


def every_unit(df: DataFrame, key: str = "file_path", text: str = "text") -> DataFrame:
    """``key, unit`` of every ``unit`` field at any depth of arbitrary JSON."""

    def make(node: object) -> Iterator[tuple]:
        stack = [node]
        while stack:
            x = stack.pop()
            if isinstance(x, dict):
                u = x.get("unit")
                if isinstance(u, str) and u.strip():
                    yield (u.strip(),)
                stack += reversed(list(x.values()))
            elif isinstance(x, list):
                stack += reversed(x)

    return _walk(make, f"{key} string, unit string", df, key, text)


def value_objects(df: DataFrame, key: str = "file_path", text: str = "text", within: str | None = None) -> DataFrame:
    """``key, path, value, unit, name, json`` of every object with a ``unit`` (or, ``within`` a named list, every object of it).

    Values are text, objects and lists as JSON; ``json`` is the value as it stands.  Each object is met once, nested ones too.
    """

    def leaf(v: object) -> str | None:
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        return v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)

    def make(node: object) -> Iterator[tuple]:
        stack: list[tuple[str, object, bool]] = [("$", node, False)]
        while stack:
            path, x, inside = stack.pop()
            if isinstance(x, dict):
                if inside or within is None and "unit" in x:
                    yield path, leaf(x.get("value")), leaf(x.get("unit")), leaf(x.get("property_name")), json.dumps(x.get("value"), ensure_ascii=False)
                for k in reversed(list(x)):
                    if k == within and isinstance(x[k], list):
                        stack += [(f"{path}.{k}[{i}]", e, True) for i, e in reversed(list(enumerate(x[k])))]
                    else:
                        stack.append((f"{path}.{k}", x[k], False))
            elif isinstance(x, list):
                stack += [(f"{path}[{i}]", e, False) for i, e in reversed(list(enumerate(x)))]

    return _walk(make, f"{key} string, path string, value string, unit string, name string, json string", df, key, text)


def json_text(c: Column) -> Column:
    """A text as a JSON string; null stays null."""
    whole = F.to_json(F.array(c))
    return F.when(c.isNotNull(), whole.substr(F.lit(2), F.length(whole) - 2))


def write_back(docs: DataFrame, updates: DataFrame, fields: list[str], key: str = "file_path", text: str = "text") -> DataFrame:
    """Documents with ``fields`` of the objects at ``updates (key, path)`` set to the columns of those names.

    Columns are JSON texts; a null column leaves its field alone.  A document without updates stays as it is, letter by letter.
    """
    change = F.struct("path", F.to_json(F.struct(*fields)).alias("set"))
    folded = updates.groupBy(F.col(key).alias("__key")).agg(F.collect_list(change).alias("__changes"))
    joined = docs.join(folded, F.col(key) == F.col("__key"), "left").drop("__key")

    @F.pandas_udf("string")
    def apply(texts: pd.Series, changes: pd.Series) -> pd.Series:
        def one(t: str | None, found: list | None) -> str | None:
            if t is None or found is None or not len(found):
                return t
            doc = json.loads(t)
            places = {c["path"]: json.loads(c["set"]) for c in found}
            for path, x in _objects(doc):
                for name, value in places.get(path, {}).items():
                    x[name] = json.loads(value)
            return json.dumps(doc, ensure_ascii=False)

        return pd.Series([one(t, c) for t, c in zip(texts, changes, strict=True)], dtype=object)

    return joined.withColumn(text, apply(text, "__changes")).drop("__changes")


def _objects(doc: object) -> Iterator[tuple[str, dict]]:
    """Every object of a document with its path, as ``value_objects`` names it."""
    stack: list[tuple[str, object]] = [("$", doc)]
    while stack:
        path, x = stack.pop()
        if isinstance(x, dict):
            yield path, x
            stack += [(f"{path}.{k}", v) for k, v in x.items()]
        elif isinstance(x, list):
            stack += [(f"{path}[{i}]", v) for i, v in enumerate(x)]


def convert_documents(docs: DataFrame, entries: DataFrame, key: str = "file_path", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Convert every value object of JSON documents in place; returns the documents and the flat rows of what was done.

    The unit is rewritten and ``original_unit, original_value`` are added wherever there is a unit; the value becomes a number
    where it could be converted and stays as it is otherwise.  An object inside a value is converted once, like any other.
    """
    from tessera.operators.units import normalize_units

    done = materialize(normalize_units(value_objects(docs, key, text), entries), "converted")
    number = F.when(F.col("status") == "normalized", F.col("value"))
    updates = done.where("status <> 'missing_unit'").select(key, "path", number.alias("value"), json_text(F.col("unit")).alias("unit"), json_text(F.col("original_unit")).alias("original_unit"), F.col("json").alias("original_value"))
    return write_back(docs, updates, ["value", "unit", "original_unit", "original_value"], key, text), done


def rename_documents(docs: DataFrame, mapping: DataFrame, key: str = "file_path", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rename the properties of JSON documents in place, old names kept; returns the documents and the flat rows of what was done."""
    from tessera.operators.units import apply_property_map

    rows = value_objects(docs, key, text, within="performance_and_properties").withColumnRenamed("name", "property_name")
    done = materialize(apply_property_map(rows, mapping), "renamed")
    updates = done.where("status <> 'empty'").select(key, "path", F.when(F.col("status") == "normalized", json_text(F.col("property_name"))).alias("property_name"), json_text(F.col("original_property_name")).alias("original_property_name"))
    return write_back(docs, updates, ["property_name", "original_property_name"], key, text), done


def _normal(s: str) -> str:
    s = unicodedata.normalize("NFKC", s)
    return " ".join("".join("-" if ch in DASHES else ch for ch in s).split())


def normalize_json(df: DataFrame, text: str = "text") -> DataFrame:
    """Normalise every string and key of JSON texts; keys that fall together keep the last value; broken texts become null."""

    def clean(x: object) -> object:
        if isinstance(x, str):
            return _normal(x)
        if isinstance(x, list):
            return [clean(e) for e in x]
        if isinstance(x, dict):
            return {_normal(k): clean(v) for k, v in x.items()}
        return x

    @F.pandas_udf("string")
    def udf(s: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            try:
                return None if t is None else json.dumps(clean(json.loads(t)), ensure_ascii=False)
            except ValueError:
                return None

        return s.map(one)

    return df.withColumn(text, udf(text))


def normalize_lists(values: DataFrame, keys: list[str], value: str = "value", pos: str = "pos") -> DataFrame:
    """Normalise the strings of ordered lists (long form) and drop later repeats within each list; the first place stays."""
    normal = values.withColumn(value, normalize_text(value))
    return normal.groupBy(*keys, value).agg(F.min(pos).alias(pos)).orderBy(*keys, pos)


# ---- JSONL ----------------------------------------------------------------------


def request_lines(docs: DataFrame, record_id: Column, system: str, prompt: Column, temperature: float = 0.0) -> DataFrame:
    """One JSON line per document for batch inference; the prompt texts are the caller's."""
    messages = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), prompt.alias("content")))
    line = F.to_json(F.struct(record_id.alias("recordId"), F.struct(messages.alias("messages"), F.lit(temperature).alias("temperature")).alias("modelInput")))
    return docs.select(line.alias("value"))


def validate_lines(lines: DataFrame, line_no: str = "line", value: str = "value") -> DataFrame:
    """``line, error`` for every broken rule of every line."""
    v = F.try_parse_json(value)
    has = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")).isNotNull(), F.lit(False))
    errors = F.when(v.isNull(), F.array(F.lit("invalid JSON"))).otherwise(
        F.array_compact(
            F.array(
                F.when(~has("$.recordId"), "missing recordId"),
                F.when(~has("$.modelInput"), "missing modelInput"),
                F.when(has("$.modelInput") & ~has("$.modelInput.messages"), "missing messages"),
            )
        )
    )
    return lines.select(line_no, F.explode(errors).alias("error"))


def chunks(rows: DataFrame, order: str, size: int) -> DataFrame:
    """Append ``batch``: consecutive groups of ``size`` rows in key order, numbered from 0.

    The row number is a per-range count plus the sum of the ranges before, so no task sees all rows.
    """
    ranged = rows.repartitionByRange(order).withColumn("__part", F.spark_partition_id())
    # Written once: the two uses below must see the same ranges, whatever the planner makes of each.
    ranged = materialize(ranged, "ranges")
    counts = ranged.groupBy("__part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("__part", "before")
    local = ranged.withColumn("__i", F.row_number().over(W.partitionBy("__part").orderBy(order)))
    return local.join(F.broadcast(before), "__part").withColumn("batch", F.floor((F.col("before") + F.col("__i") - 1) / size)).drop("__part", "__i", "before")


def file_name(doi: Column | str) -> Column:
    return F.concat(doi_to_file(doi), F.lit(".json"))
