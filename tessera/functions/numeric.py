"""Numbers in dirty text, unit conversion factors and conversion itself, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import strip

_FLOAT = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
_SPECIAL = r"(?i)^[+-]?(inf|infinity|nan)$"
_ADD = r"(?iU)^\s*add\s+([+-]?\d+\.?\d*)\s*$"


def safe_float(c: Column) -> Column:
    """The number a text spells, as Python's float() reads it; null otherwise (NaN for a spelled nan).

    A plain cast would take ``100F`` (farads) or ``1d`` for numbers.
    """
    text = strip(c.cast("string"))
    number = F.regexp_replace(text, "_", "")
    special = F.lower(F.regexp_replace(text, r"^\+", ""))
    return (
        F.when(text.rlike(_FLOAT), number.try_cast("double"))
        .when(text.rlike(_SPECIAL), F.when(special.endswith("nan"), F.lit(float("nan"))).when(special.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    )


def variant_float(v: Column) -> Column:
    """``safe_float`` of a VARIANT leaf: numbers and booleans count, objects, arrays and NaN numbers do not."""
    kind = F.schema_of_variant(v)
    plain = F.when(kind.rlike(r"^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"), F.try_variant_get(v, "$", "double"))
    plain = F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double")).otherwise(plain)
    return F.when(kind == "STRING", safe_float(F.try_variant_get(v, "$", "string"))).otherwise(F.when(~F.isnan(plain), plain))


def factor_operation(factor: Column) -> Column:
    """struct(op, amount) of a conversion factor's text: ``add`` an amount, ``multiply`` by one, or null."""
    added = F.regexp_extract(factor, _ADD, 1)
    number = safe_float(factor)
    return (
        F.when(F.coalesce(added, F.lit("")) != "", F.struct(F.lit("add").alias("op"), added.try_cast("double").alias("amount")))
        .when(number.isNotNull() & ~F.isnan(number), F.struct(F.lit("multiply").alias("op"), number.alias("amount")))
    )


def resolve_si_unit(si_unit: Column, original: Column) -> Column:
    """The unit to write: the original where there is none, ``1`` for dimensionless, else the stripped SI unit."""
    bare = strip(si_unit)
    low = F.lower(bare)
    return F.when(bare.isNull() | (bare == "") | (low == "unable to convert"), original).when(low == "dimensionless", "1").otherwise(bare)


#: What can become of a value and unit; each visited object gets exactly one.
STATUSES = ("missing_unit", "unmatched", "missing_factor", "non_numeric", "normalized")


def conversion_status(unit: Column, matched: Column, op: Column, number: Column) -> Column:
    """What becomes of a value: ``unit`` is stripped, ``number`` the value's ``safe_float``."""
    return (
        F.when(unit.isNull() | (unit == ""), "missing_unit")
        .when(~F.coalesce(matched, F.lit(False)), "unmatched")
        .when(op.isNull(), "missing_factor")
        .when(number.isNull(), "non_numeric")
        .otherwise("normalized")
    )


def conversion(value: Column, unit: Column, bare: Column, si_unit: Column, op: Column, number: Column, status: Column) -> Column:
    """struct(value, unit, original_value, original_unit) of one value.

    ``value`` is text (a number or not), ``bare`` the stripped unit, ``op`` a ``factor_operation``.  A matched unit is rewritten
    even where the value stays; the originals are kept wherever there is a unit.
    """
    changed = F.when(op["op"] == "add", number + op["amount"]).otherwise(number * op["amount"])
    there = status != "missing_unit"
    return F.struct(
        F.when(status == "normalized", changed.cast("string")).otherwise(value).alias("value"),
        F.when(status.isin("missing_unit", "unmatched"), unit).otherwise(resolve_si_unit(si_unit, bare)).alias("unit"),
        F.when(there, value).alias("original_value"),
        F.when(there, bare).alias("original_unit"),
    )
