"""Unit vocabulary, conversion maps and their application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.numeric import STATUSES, conversion, conversion_status, factor_operation, safe_float
from tessera.functions.text import strip

#: Maps are dimension tables; one of more rows is joined without a broadcast.
MAP_ROWS = 1_000_000


def small(df: DataFrame, rows: int = MAP_ROWS) -> DataFrame:
    """Broadcast a table whose size, counted here, is under the bound; leave a larger one to the planner."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def one_per_key(table: DataFrame, key: str, order: str, keep: str = "last") -> DataFrame:
    """One row per key: the first or the last by ``order``, folded before the shuffle."""
    pick = F.min_by if keep == "first" else F.max_by
    return table.groupBy(F.col(key).alias("__k0")).agg(pick(F.struct(*table.columns), F.struct(order)).alias("__s")).select("__s.*")


def conversion_map(entries: DataFrame, keep: str = "last") -> DataFrame:
    """``key, si_unit, op`` from ``pos, original, si_unit, factor``; blank keys go, repeats keep the last (or first)."""
    keyed = entries.withColumn("key", strip("original")).where("key is not null and key <> ''")
    return one_per_key(keyed, "key", "pos", keep).select("key", "si_unit", factor_operation(F.col("factor")).alias("op"))


def normalize_units(rows: DataFrame, entries: DataFrame, value: str = "value", unit: str = "unit", keep: str = "last") -> DataFrame:
    """Apply a conversion map to rows with a value (text) and a unit.

    Replaces ``value`` and ``unit`` and appends ``original_value, original_unit, status``.  Nested objects
    are rows of their own (see ``documents.value_objects``), so each is converted once.
    """
    table = small(conversion_map(entries, keep))
    # What several results need is a column of its own, so that it is computed once.
    joined = rows.withColumns({"__unit": strip(unit), "__number": safe_float(F.col(value))}).join(table, F.col("__unit") == F.col("key"), "left")
    done = joined.withColumn("__status", conversion_status(F.col("__unit"), F.col("key").isNotNull(), F.col("op"), F.col("__number")))
    c = conversion(F.col(value), F.col(unit), F.col("__unit"), F.col("si_unit"), F.col("op"), F.col("__number"), F.col("__status"))
    keep_cols = [F.col(x) for x in rows.columns if x not in (value, unit)]
    return done.withColumn("__c", c).select(*keep_cols, F.col("__c.value").alias(value), F.col("__c.unit").alias(unit), F.col("__c.original_value").alias("original_value"), F.col("__c.original_unit").alias("original_unit"), F.col("__status").alias("status"))


def unit_statistics(normalized: DataFrame) -> DataFrame:
    """One row: how many values came to each status; the counts add up to ``visited``."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    return normalized.agg(F.count("*").alias("visited"), *counts)


def unmatched_units(normalized: DataFrame) -> DataFrame:
    """Distinct units that the map lacks, sorted, with their occurrences."""
    return normalized.where("status = 'unmatched'").groupBy(F.col("original_unit").alias("unit")).agg(F.count("*").alias("n")).orderBy("unit")


def vocabulary(rows: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank strings in code-point order."""
    return rows.select(strip(column).alias(column)).where(F.col(column).isNotNull() & (F.col(column) != "")).distinct().orderBy(column)


def uncovered(units: DataFrame, entries: DataFrame, unit: str = "unit") -> DataFrame:
    """Distinct units without an entry, both sides stripped."""
    have = small(entries.select(strip("original").alias("__o")).distinct())
    used = vocabulary(units, unit)
    return used.join(have, F.col(unit) == F.col("__o"), "left_anti").orderBy(unit)


def map_hygiene(entries: DataFrame, used: DataFrame, unit: str = "unit") -> DataFrame:
    """Tell each entry of a map apart: ``invalid`` (null or blank), ``duplicate`` (not the first), ``unused``, ``kept``."""
    bare = entries.withColumn("key", strip(F.col("original").cast("string")))
    first = F.row_number().over(W.partitionBy("key").orderBy("pos"))
    have = small(used.select(strip(unit).alias("__u")).distinct())
    rows = bare.withColumn("__n", first).join(have, F.col("key") == F.col("__u"), "left")
    fate = (
        F.when(F.col("key").isNull() | (F.col("key") == ""), "invalid")
        .when(F.col("__n") > 1, "duplicate")
        .when(F.col("__u").isNull(), "unused")
        .otherwise("kept")
    )
    return rows.withColumn("fate", fate).drop("__n", "__u", "key")


def apply_property_map(rows: DataFrame, mapping: DataFrame, name: str = "property_name") -> DataFrame:
    """Rename properties by ``pos, property, normalized``; keeps ``original_property_name`` and tells a ``status``.

    Keys are stripped, case counts, later repeats win; a null or blank target leaves the name alone.
    """
    table = one_per_key(mapping.withColumn("__k", strip("property")), "__k", "pos").select("__k", strip("normalized").alias("__t"), F.lit(True).alias("__has"))
    bare = strip(name)
    joined = rows.join(small(table), bare == F.col("__k"), "left")
    usable = F.col("__t").isNotNull() & (F.col("__t") != "")
    status = (
        F.when(bare.isNull() | (bare == ""), "empty")
        .when(F.col("__has").isNull(), "unmatched")
        .when(~usable, "no_target")
        .otherwise("normalized")
    )
    done = joined.withColumn("__s", status)
    out: list[Column] = [F.when(F.col("__s") == "normalized", F.col("__t")).otherwise(F.col(name)).alias(name) if c == name else F.col(c) for c in rows.columns]
    return done.select(*out, F.when(F.col("__s") != "empty", bare).alias("original_property_name"), F.col("__s").alias("status"))


def property_statistics(normalized: DataFrame) -> DataFrame:
    return normalized.agg(F.count("*").alias("visited"), *[F.count_if(F.col("status") == s).alias(s) for s in ("empty", "unmatched", "no_target", "normalized")])
