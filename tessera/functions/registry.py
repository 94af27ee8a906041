"""The text and number functions as SQL functions of a session.

Most bodies are the SQL of the very column expressions that the engine uses.  Expressions with lambdas (electrolytes,
dopants, profile texts) have no SQL text that parses again, and are left to the DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.functions import numeric, text
from tessera.operators import resolve

SQL_FUNCTIONS = {
    "file_to_doi": ("name string", "string", r"translate(regexp_replace(name, '\\.json$', ''), '_', '/')"),
    "cosine_similarity": ("a array<double>, b array<double>", "double", "try_divide(aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x), sqrt(aggregate(a, 0D, (s, x) -> s + x * x)) * sqrt(aggregate(b, 0D, (s, x) -> s + x * x)))"),
    "dot_product": ("a array<double>, b array<double>", "double", "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x)"),
    "uid": ("prefix string, parts array<string>", "string", "concat(prefix, '-', substring(sha2(concat_ws('|', parts), 256), 1, 16))"),
}

#: Column functions of one string.
COLUMN_FUNCTIONS = {
    "strip": text.strip,
    "squeeze": text.squeeze,
    "dashes": text.dashes,
    "doi_to_file": text.doi_to_file,
    "clean_material_name": text.clean_material_name,
    "precursor_name": text.precursor_name,
    "precursor_role": text.precursor_role,
    "leading_number": text.leading_number,
    "after_number": text.after_number,
    "numeric_and_unit": text.numeric_and_unit,
    "reply_json": text.reply_json,
    "safe_float": lambda c: numeric.safe_float(F.col(c)),
    "factor_operation": lambda c: numeric.factor_operation(F.col(c)),
    "concentration": resolve.concentration,
    "bare_formula": resolve.bare_formula,
    "product_codes": resolve.product_codes,
    "clean_canonical": resolve.clean_canonical,
}


def register(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions; returns their names."""
    made = dict(SQL_FUNCTIONS)
    one = spark.range(0).select(F.lit(None).cast("string").alias("s"))
    for name, function in COLUMN_FUNCTIONS.items():
        df = one.select(function("s").alias("x"))
        body = df._jdf.queryExecution().analyzed().expressions().apply(0).child().sql()
        made[name] = ("s string", df.schema["x"].dataType.simpleString(), body)
    for name, (args, kind, body) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
    return sorted(made)
