import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.functions import text as X


def col(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("x")).collect()]


def test_normalize_text(spark):
    raw = ["F g⁻¹", "m²", "a‐b‑c‒d–e—f−g", "a  \t b", "µm", None, "", "  x "]
    want = ["F g-1", "m2", "a-b-c-d-e-f-g", "a b", "μm", None, "", "x"]
    got = col(spark, raw, X.normalize_text("v"))
    assert got == want
    assert col(spark, got, X.normalize_text("v")) == want


def test_clean_names(spark):
    assert col(spark, ["★Ni†(OH)2  Film*", None], X.clean_name("v")) == ["ni (oh)2 film", None]
    assert col(spark, ["Coated  MnO2/C-film (sample)", "As Prepared X"], X.clean_material_name("v")) == ["mno2/c-", "x"]


def test_file_names_lose_underscores(spark):
    assert col(spark, ["10.1/a:b_c"], X.doi_to_file("v")) == ["10.1_a_b_c"]
    assert col(spark, ["10.1_a_b_c.json"], X.file_to_doi("v")) == ["10.1/a/b/c"]


def test_precursors(spark):
    raw = ["KOH (activator)", "A (x) B (y)", "none", "()"]
    assert col(spark, raw, X.precursor_name("v")) == ["KOH", "A B", "none", ""]
    assert col(spark, raw, X.precursor_role("v")) == ["activator", "x", "", ""]


def test_numeric_split(spark):
    raw = ["1 A/g", "0-1.0V", "1e5", ".5", "~5", " 5", "2,000 cycles", "-3.5 V", None]
    got = col(spark, raw, X.numeric_and_unit("v"))
    assert [(r["num"], r["unit"]) for r in got] == [(1.0, "A/g"), (0.0, "-1.0V"), (1.0, "e5"), (None, ""), (None, ""), (None, ""), (2.0, ",000 cycles"), (-3.5, "V"), (None, "")]


def test_electrolytes(spark):
    raw = ["6 M KOH", "1 M A + 0.5 mM B in PC", "gel electrolyte", "5 MnO2", "6 M", "10", "5 μM KCl", "1 M PVA/KOH", "", None]
    got = col(spark, raw, X.electrolyte("v"))
    parts = [[(c["solute"], c["concentration"], c["unit"]) for c in r["components"]] for r in got]
    assert parts == [
        [("KOH", 6.0, "M")], [("A", 1.0, "M"), ("B", 0.5, "mM")], [], [("nO2", 5.0, "M")], [("M", 6.0, "M")], [("0", 1.0, "M")],
        [("μM KCl", 5.0, "M")], [("PVA", 1.0, "M")], [], [],
    ]
    assert got[1]["solvent"] == "PC" and got[8]["original"] == "" and got[9]["original"] == ""
    strict = col(spark, ["5 MnO2", "5 μM KCl"], X.electrolyte("v", strict_units=True))
    assert [r["components"][0]["solute"] for r in strict] == ["MnO2", "KCl"]


def test_reply_json(spark):
    raw = ["<reasoning>{x}\n</reasoning>```json\n{\"a\":1}\n```", "so {\"a\":{\"b\":2}} and {\"c\":3} ok", "none", None]
    assert col(spark, raw, X.reply_json("v")) == ['{"a":1}', '{"a":{"b":2}} and {"c":3}', "none", None]


def test_profile_text_leaves_out_what_is_missing(spark):
    none = F.array().cast("array<string>")
    props = F.array().cast("array<struct<name:string,value:string,unit:string>>")
    got = spark.range(1).select(X.profile_text(F.lit("A"), F.lit(None).cast("string"), F.lit("r"), F.lit(""), F.array(F.lit("m1"), F.lit("m2")), none, props)).first()[0]
    assert got == "Material: A Original name: None Role: r Synthesis methods: m1, m2"


def test_safe_float(spark):
    raw = ["100F", "1d", "0x1p3", "1_000", " 5 ", "inf", "-Infinity", "1e3", "", "abc", None, ".5", "5."]
    assert col(spark, raw, N.safe_float(F.col("v"))) == [None, None, None, 1000.0, 5.0, math.inf, -math.inf, 1000.0, None, None, None, 0.5, 5.0]
    assert math.isnan(col(spark, ["nan"], N.safe_float(F.col("v")))[0])


def test_variant_float(spark):
    raw = ['"1e3"', "5", "5.5", "true", '{"a":1}', "null", '"100F"']
    assert col(spark, raw, N.variant_float(F.parse_json("v"))) == [1000.0, 5.0, 5.5, 1.0, None, None, None]


@pytest.mark.parametrize(("factor", "want"), [("1000", ("multiply", 1000.0)), ("add 273.15", ("add", 273.15)), ("ADD -5", ("add", -5.0)), ("add 5.", ("add", 5.0)), (None, None), ("x", None)])
def test_factor_operation(spark, factor, want):
    got = col(spark, [factor], N.factor_operation(F.col("v")))[0]
    assert (got and tuple(got)) == want


def test_resolve_si_unit(spark):
    df = spark.createDataFrame([(None, "a"), (" ", "a"), ("Dimensionless", "a"), ("Unable to convert", "a"), (" m ", "a")], "s string, o string")
    assert [r[0] for r in df.select(N.resolve_si_unit(F.col("s"), F.col("o"))).collect()] == ["a", "a", "1", "a", "m"]


def test_sql_functions(spark):
    from tessera.functions.registry import COLUMN_FUNCTIONS, register

    assert "uid" in register(spark)
    row = spark.sql("select doi_to_file('a/b') f, cosine_similarity(array(1D, 0D), array(2D, 0D)) c, cosine_similarity(array(0D), array(1D)) z").first()
    assert (row["f"], row["c"], row["z"]) == ("a_b", 1.0, None)
    values = ["5 mM  LiPF6 (salt)", " Film 3 M A123 B-doped ", "1_000", "add 2.5", "```json {\"a\": 1} ```", "Binder: x\\y 'q'", "", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for name, function in COLUMN_FUNCTIONS.items():
        rows = df.select(F.expr(f"{name}(s)").alias("sql"), function("s").alias("column")).collect()
        assert [r["sql"] for r in rows] == [r["column"] for r in rows], name
