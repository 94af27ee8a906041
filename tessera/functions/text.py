"""Text functions as column expressions.

Patterns run on the JVM with ``(?U)``, so word, digit and blank classes are Unicode-aware.
NFKC has no built-in; ``nfkc`` is an Arrow UDF and leaves ASCII strings alone.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that stand for a hyphen, and decorative symbols that a name loses.
DASHES = "‐‑‒–—−"
DECORATIONS = "*•★♣♦♥♠†‡"
FILLERS = ("composite", "electrode", "as prepared", "sample", "film", "coated", "deposited", "synthesized", "fabricated", "material")
DESCRIPTORS = ("aqueous", "solution", "electrolyte", "gel")
UNITS = ("M", "mM", "µM", "uM", "mol/L")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


def nfkc(c: Column | str) -> Column:
    return _nfkc(_col(c))


def strip(c: Column | str) -> Column:
    """Remove blanks of every kind at both ends."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def squeeze(c: Column | str) -> Column:
    """Runs of blanks become one blank; none stay at the ends."""
    return strip(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def dashes(c: Column | str) -> Column:
    return F.translate(_col(c), DASHES, "-" * len(DASHES))


def normalize_text(c: Column | str) -> Column:
    """NFKC, then one hyphen for all dashes, then single blanks (in this order: NFKC makes dashes of its own)."""
    return squeeze(dashes(nfkc(c)))


def clean_name(c: Column | str) -> Column:
    """Lower-case NFKC name without decorative symbols."""
    low = F.lower(nfkc(c))
    return squeeze(F.translate(low, DECORATIONS, " " * len(DECORATIONS)))


def clean_material_name(c: Column | str) -> Column:
    """Lower-case name without filler words and punctuation other than slash and hyphen."""
    low = strip(F.lower(_col(c)))
    bare = F.regexp_replace(low, r"(?U)\b(" + "|".join(FILLERS) + r")\b", "")
    return squeeze(F.regexp_replace(bare, r"(?U)[^\w\s/-]", ""))


def doi_to_file(c: Column | str) -> Column:
    return F.translate(_col(c), "/:", "__")


def file_to_doi(c: Column | str) -> Column:
    """The inverse as far as there is one: every underscore becomes a slash."""
    return F.translate(F.regexp_replace(_col(c), r"\.json$", ""), "_", "/")


def precursor_name(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), r"(?U)(?d)\s*\(.*?\)", ""))


def precursor_role(c: Column | str) -> Column:
    """The first parenthesised text, or an empty string."""
    return F.regexp_extract(_col(c), r"(?d)\((.*?)\)", 1)


_NUMBER = r"(?U)(?ds)^([+-]?\d+\.?\d*)\s*([^\n]*)"


def leading_number(c: Column | str) -> Column:
    """The number that a string starts with; null where there is none."""
    return F.regexp_extract(_col(c).cast("string"), _NUMBER, 1).try_cast("double")


def after_number(c: Column | str) -> Column:
    return F.regexp_extract(_col(c).cast("string"), _NUMBER, 2)


def numeric_and_unit(c: Column | str) -> Column:
    """struct(num, unit): a number in front and what follows it; null and empty where there is none."""
    return F.struct(leading_number(c).alias("num"), F.coalesce(after_number(c), F.lit("")).alias("unit"))


def merged_value(raw: Column | str, given_unit: Column | str | None = None) -> Column:
    """struct(value, unit): the parsed number as text else the raw value; the parsed unit else the given one else empty."""
    parsed = numeric_and_unit(raw)
    other = F.lit("") if given_unit is None else F.coalesce(_col(given_unit), F.lit(""))
    return F.struct(
        F.coalesce(parsed["num"].cast("string"), _col(raw).cast("string")).alias("value"),
        F.coalesce(F.nullif(parsed["unit"], F.lit("")), other).alias("unit"),
    )


COMPONENT = "array<struct<solute:string,concentration:double,unit:string>>"


def electrolyte(c: Column | str, strict_units: bool = False) -> Column:
    """struct(original, components, solvent) of an electrolyte description.

    A part is a concentration, an optional unit and a solute; without a unit it is M, without a number
    the whole part is the solute.  ``strict_units`` ends a unit at a word end and knows both micro signs.
    """
    original = strip(c)
    text = strip(F.regexp_replace(original, r"(?iU)\b(" + "|".join(DESCRIPTORS) + r")\b", ""))
    tail = r"(?iU)\bin\s+([\w\s,]+)$"
    solvent = strip(F.regexp_extract(text, tail, 1))
    salts = strip(F.regexp_replace(text, tail, ""))
    units = "|".join(UNITS)
    pattern = r"(?U)^(\d+\.?\d*)\s*((?:" + units + r"|μM)(?!\w))?\s*(\w[\w\s]*)" if strict_units else r"(?U)^(\d+\.?\d*)\s*(" + units + r")?\s*(\w[\w\s]*)"

    def part(p: Column) -> Column:
        number = F.regexp_extract(p, pattern, 1)
        found = number != ""
        return F.struct(
            F.when(found, strip(F.regexp_extract(p, pattern, 3))).otherwise(p).alias("solute"),
            F.when(found, number.try_cast("double")).alias("concentration"),
            F.when(found, F.coalesce(F.nullif(F.regexp_extract(p, pattern, 2), F.lit("")), F.lit("M"))).alias("unit"),
        )

    parts = F.filter(F.transform(F.split(salts, r"(?U)\s+\+\s+|\s+and\s+"), strip), lambda p: p != "")
    empty = _col(c).isNull() | (_col(c) == "")
    return F.struct(
        F.when(empty, "").otherwise(original).alias("original"),
        F.when(~empty, F.transform(parts, part)).otherwise(F.array().cast(COMPONENT)).alias("components"),
        F.when(empty, "").otherwise(solvent).alias("solvent"),
    )


def reply_json(c: Column | str) -> Column:
    """The JSON text of a model's reply: without reasoning, from a fence, else from the outermost braces, else all of it."""
    plain = strip(F.regexp_replace(_col(c), r"(?s)<reasoning>.*?</reasoning>", ""))
    fenced = F.regexp_extract(plain, r"(?sU)```json\s*(.*?)\s*```", 1)
    braces = F.regexp_extract(plain, r"(?s)(\{.*\})", 1)
    return F.when(plain.rlike(r"(?sU)```json\s*(.*?)\s*```"), strip(fenced)).otherwise(F.coalesce(F.nullif(braces, F.lit("")), plain))


def labelled(label: str, c: Column) -> Column:
    """``label: text``, or null where there is no text."""
    return F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"{label}: "), c))


def profile_text(name: Column, original: Column, role: Column, morphology: Column, methods: Column, precursors: Column, properties: Column) -> Column:
    """One line that describes a material; empty parts are left out.

    ``methods`` and ``precursors`` are arrays of strings, ``properties`` of struct(name, value, unit).
    """
    text = lambda x: F.coalesce(x.cast("string"), F.lit("None"))
    props = F.transform(properties, lambda p: F.concat(text(p["name"]), F.lit(": "), text(p["value"]), F.lit(" "), text(p["unit"])))
    return F.concat_ws(
        " ",
        F.concat(F.lit("Material: "), text(name)),
        F.concat(F.lit("Original name: "), text(original)),
        F.concat(F.lit("Role: "), text(role)),
        labelled("Morphology", morphology),
        labelled("Synthesis methods", F.array_join(methods, ", ")),
        labelled("Precursors", F.array_join(precursors, ", ")),
        labelled("Key properties", F.array_join(props, ", ")),
    )
