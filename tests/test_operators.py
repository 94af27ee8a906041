import itertools
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import documents as D
from tessera.operators import graph as G
from tessera.operators import ledger as L
from tessera.operators import resolve as R
from tessera.operators import units as U
from tessera.operators import components
from tessera.operators.components import connected_components
from tessera.operators.vector import top_k
from tessera.schemas import PROPERTY_MAP, UNIT_CONVERSION


# ---- components ------------------------------------------------------------------


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_match_brute_force(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(7, 7), (5, 4)]
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame([*edges, *edges[:5], (3, 3), (None, 1)], "src long, dst long")
    got = {r["id"]: r["component"] for r in connected_components(df).collect()}
    assert got == brute_components(edges)


def test_components_of_names_over_many_tasks(spark):
    rng = random.Random(4)
    names = [f"{w}{i}" for i in range(60) for w in ("a", "é", "\U0001F600")]
    edges = [(a, b) for a, b in ((rng.choice(names), rng.choice(names)) for _ in range(150)) if a != b]
    edges += [("hub", f"leaf {i}") for i in range(200)] + [(f"p{i:03}", f"p{i + 1:03}") for i in range(200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len({r["id"] for r in got})
    assert {r["id"]: r["component"] for r in got} == brute_components(edges)


def test_edges_fold_into_stars_block_by_block(monkeypatch):
    rng = random.Random(5)
    for block, span in ((8, 30), (8, 300), (1 << 20, 60)):
        monkeypatch.setattr(components, "BLOCK", block)
        edges = [(rng.randrange(span), rng.randrange(span)) for _ in range(90)]
        edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
        batches = [pa.RecordBatch.from_pydict({"u": [u for u, _ in edges[i : i + 3]], "v": [v for _, v in edges[i : i + 3]]}) for i in range(0, len(edges), 3)]
        out = [(r["u"], r["v"]) for b in components._contract(iter(batches)) for r in b.to_pylist()]
        assert all(u > v for u, v in out) and len(out) <= len(edges)
        assert brute_components(out) == brute_components(edges)
        if block > 8:
            assert dict(out) == {x: r for x, r in brute_components(edges).items() if x != r}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# ---- names ------------------------------------------------------------------------


def test_ratio_is_the_longest_common_subsequence():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for ch in a:
            prev = 0
            for j, c in enumerate(b, 1):
                prev, row[j] = row[j], max(row[j], row[j - 1], prev + 1) if ch == c else max(row[j], row[j - 1])
        return row[-1]

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randrange(12))) for _ in range(2))
        want = 200.0 * lcs(a, b) / (len(a) + len(b)) if a and b else (100.0 if a == b else 0.0)
        assert R.indel_ratio(a, b) == pytest.approx(want)


def test_fuzzy_pairs_match_all_pairs(spark):
    rng = random.Random(2)
    names = sorted({"".join(rng.choice("abcde") for _ in range(rng.randrange(3, 9))) + rng.choice(["", " x", " yy"]) for _ in range(120)})
    got = {(r["a"], r["b"]) for r in R.fuzzy_pairs(spark.createDataFrame([(n,) for n in names], "n string"), "n", 80.0).collect()}
    key = lambda s: " ".join(sorted(s.split()))
    want = {(a, b) for a, b in itertools.combinations(names, 2) if R.indel_ratio(key(a), key(b)) >= 80.0}
    assert got == want and want


def test_fuzzy_pairs_compare_few(spark):
    rng = random.Random(31)
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(3)) for _ in range(400)]
    names += [n[:-1] for n in names[:40]] + [" ".join(reversed(n.split())) for n in names[:20]] + ["", " ", "a", "ab"]
    compared = []
    real = R._ratio
    R._ratio = lambda a, b: compared.append(1) or real(a, b)
    try:
        got = R.fuzzy_pairs(spark.createDataFrame([(n,) for n in names], "n string"), "n", 85.0)
    finally:
        R._ratio = real
    want = {(a, b) for a in set(names) for b in set(names) if a < b and a.strip() and R.indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) >= 85.0}
    assert {(r["a"], r["b"]) for r in got.collect()} == want and len(want) > 50


def test_cluster_labels(spark):
    df = spark.createDataFrame([("nickel oxide",), ("oxide nickel",), ("zinc",), (None,), ("zinc",)], "n string")
    got = {r["name"]: r["label"] for r in R.cluster_names(df, "n").collect()}
    assert got == {"nickel oxide": 0, "oxide nickel": 0, "zinc": 1}
    assert [(r["size"], r["names"]) for r in R.clusters(R.cluster_names(df, "n")).collect()] == [(2, ["nickel oxide", "oxide nickel"])]


def test_similar_pairs_match_all_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    v = rng.normal(size=(80, 5))
    v /= np.linalg.norm(v, axis=1)[:, None]
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id int, embedding array<double>")
    got = {(r["a"], r["b"]) for r in R.similar_pairs(df, 0.8, 4).collect()}
    s = v @ v.T
    want = set()
    for i in range(len(v)):
        near = [j for j in sorted(range(len(v)), key=lambda j: (-s[i, j], j)) if j != i and s[i, j] >= 0.8][:3]
        want |= {(min(i, j), max(i, j)) for j in near}
    assert got == want and want
    filed = {(r["a"], r["b"]) for r in R.similar_pairs(df, 0.8, 4, lists=6, probes=6).collect()}
    assert filed == want
    some = {(r["a"], r["b"]) for r in R.similar_pairs(df, 0.8, 4, lists=6, probes=3).collect()}
    assert len(some & want) >= 0.9 * len(want)


def test_similar_pairs_by_lists_are_exact(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 12))
    x = np.concatenate([x, x[:200] + rng.normal(scale=0.15, size=(200, 12))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, embedding array<double>")
    s = x @ x.T
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if s[i, j] >= 0.9}
    got = {(r["a"], r["b"]) for r in R.similar_pairs(df, 0.9, 1000, lists=40).collect()}
    assert got == want and len(want) > 100
    few = {(r["a"], r["b"]) for r in R.similar_pairs(df, 0.9, 1000, lists=40, probes=10).collect()}
    assert few <= want and len(few) >= 0.9 * len(want)


def test_nearest_rows_in_strips(monkeypatch):
    rng = np.random.default_rng(7)
    q, m = rng.normal(size=(150, 8)), rng.normal(size=(230, 8))
    m[50:90] = m[3]
    m[100:110] = q[:10]
    s = np.array([R._dots(np.repeat(v[None], len(m), axis=0), m) for v in q])
    for strip, pending in (((1024, 4096), 1 << 20), ((7, 11), 40), ((64, 32), 0)):
        monkeypatch.setattr(R, "STRIP", strip)
        monkeypatch.setattr(R, "PENDING", pending)
        for least, k in ((1.0, 5), (-100.0, 3), (0.5, 300), (1e9, 4)):
            want = [(i, j) for i in range(len(q)) for j in sorted(np.flatnonzero(s[i] >= least), key=lambda j: (-s[i, j], j))[:k]]
            a, b, score = R._nearest(q, m, least, k)
            assert list(zip(a.tolist(), b.tolist(), strict=True)) == want
            assert (score == s[a, b]).all()


def test_equal_vectors_are_searched_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    v = np.concatenate([x, np.repeat(x[:1], 600, axis=0), np.repeat(x[1:2], 3, axis=0)])[rng.permutation(723)]
    s = np.array([R._dots(np.repeat(u[None], len(v), axis=0), v) for u in v])
    np.fill_diagonal(s, -2.0)
    want = set()
    for i in range(len(v)):
        near = sorted(np.flatnonzero(s[i] >= 0.7), key=lambda j: (-s[i, j], j))[:4]
        want |= {(min(i, int(j)), max(i, int(j))) for j in near}
    df = spark.createDataFrame([(i, u.tolist()) for i, u in enumerate(v)], "id int, embedding array<double>")
    real, compared = R._nearest, spark.sparkContext.accumulator(0)
    monkeypatch.setattr(R, "_nearest", lambda q, m, least, k: compared.add(len(q) * len(m)) or real(q, m, least, k))
    for lists in (1, 8):
        assert {(r["a"], r["b"]) for r in R.similar_pairs(df, 0.7, 5, lists=lists).collect()} == want
    assert compared.value <= 2 * 120 * 120


def test_one_product_serves_both_sides(monkeypatch):
    rng = np.random.default_rng(9)
    q, m = (rng.normal(size=(n, 8)).astype("float32") for n in (150, 230))
    m[50:90] = m[3]
    q[20:40] = m[3]
    s = np.array([R._dots(np.repeat(v[None], len(m), axis=0), m) for v in q])
    for strip, pending in (((1024, 4096), 1 << 20), ((7, 11), 40), ((64, 32), 0)):
        monkeypatch.setattr(R, "STRIP", strip)
        monkeypatch.setattr(R, "PENDING", pending)
        for least, k in ((1.0, 5), (-100.0, 3), (0.5, 300), (1e9, 4)):
            for (a, b, score), t in zip(R._meet(q, m, least, k), (s, s.T), strict=True):
                want = [(i, j) for i in range(len(t)) for j in sorted(np.flatnonzero(t[i] >= least), key=lambda j: (-t[i, j], j))[:k]]
                assert list(zip(a.tolist(), b.tolist(), strict=True)) == want
                assert (score == t[a, b]).all()


def test_blocks_meet_once(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(300, 6))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype("float32").astype(float)
    s = np.array([R._dots(np.repeat(u[None], len(x), axis=0), x) for u in x])
    np.fill_diagonal(s, -2.0)
    want = {}
    for i in range(len(x)):
        want |= {(min(i, int(j)), max(i, int(j))): s[i, j] for j in sorted(np.flatnonzero(s[i] >= 0.7), key=lambda j: (-s[i, j], j))[:4]}
    monkeypatch.setattr(R, "BLOCK", 32)
    monkeypatch.setattr(R, "BLOCK_MOST", 32)
    compared = spark.sparkContext.accumulator(0)
    one, two = R._nearest, getattr(R, "_meet", None)
    monkeypatch.setattr(R, "_nearest", lambda q, m, least, k: compared.add(len(q) * len(m)) or one(q, m, least, k))
    monkeypatch.setattr(R, "_meet", lambda q, m, least, k, both=True: compared.add(both * len(q) * len(m)) or two(q, m, least, k, both), raising=False)
    for kind in ("float", "double"):
        df = spark.createDataFrame([(i, u.tolist()) for i, u in enumerate(x)], f"id int, embedding array<{kind}>")
        for lists, probes in ((1, None), (7, None), (7, 7)):
            before = compared.value
            got = {(r["a"], r["b"]): r["score"] for r in R.similar_pairs(df, 0.7, 5, lists=lists, probes=probes).collect()}
            assert got == want
            assert probes or compared.value - before <= 0.7 * 300 * 300


def test_edge_features(spark):
    rows = [(1, "10 mg x"), (2, "la,sr-codoped"), (3, "n, s co-doped"), (4, "code AB12 1234"), (5, "0.5 mol/l z")]
    got = {r["id"]: r for r in R.features(spark.createDataFrame(rows, "id int, cleaned_name string").withColumns({"formula": F.lit(" Fe O "), "role": F.lit("")})).collect()}
    assert got[1]["conc"] == 10.0 and got[5]["conc"] == 0.5 and got[4]["conc"] is None
    assert got[2]["dopes"] == ["sr"] and got[3]["dopes"] == ["co"] and got[1]["dopes"] is None
    assert got[4]["codes"] == ["1234"] and got[1]["form"] == "feo" and got[1]["part"] is None
    kept = R.features(spark.createDataFrame(rows, "id int, cleaned_name string").withColumns({"formula": F.lit(None).cast("string"), "role": F.lit("a")}), case_preserving=True)
    assert {r["id"]: r["codes"] for r in kept.collect()}[4] == ["1234", "AB12"]


def test_filters_need_a_contradiction(spark):
    rec = spark.createDataFrame([(1, "1 m koh", None, "e"), (2, "2 m koh", None, "e"), (3, "1 m koh!", "koh", ""), (4, "1 m koh?", "naoh", "e")], "id long, cleaned_name string, formula string, role string")
    edges = spark.createDataFrame([(1, 2), (1, 3), (3, 4), (1, 4)], "a long, b long")
    assert {(r["a"], r["b"]) for r in R.filter_edges(edges, rec).collect()} == {(1, 3), (1, 4)}


def test_block_edges_match_all_pairs(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["1 m koh", "2 m koh", "koh", "koh 1234", "koh 1000 n-doped", "koh s-doped", "mok", None]), rng.choice(["KOH", "k oh", "NaOH", "", None]), rng.choice(["e", "a", "", None]), rng.choice(["p", "q", None])) for i in range(150)]
    rows += [(i, "1 m koh", "KOH", "e", "hot") for i in range(200, 260)]
    rec = spark.createDataFrame(rows, "id long, cleaned_name string, formula string, role string, k string")
    pairs = [(x[0], y[0]) for x, y in itertools.combinations(rows, 2) if x[4] is not None and x[4] == y[4]]
    edges = spark.createDataFrame(pairs, "a long, b long")
    for fuzzy in (0.0, 60.0):
        got = [(r["a"], r["b"]) for r in R.block_edges(rec, "k", fuzzy=fuzzy).collect()]
        want = sorted((r["a"], r["b"]) for r in R.filter_edges(edges, rec, fuzzy=fuzzy).collect())
        assert sorted(got) == want and len(pairs) > len(want) > 1770


def test_edge_filter_query_makes_no_refused_pair(spark, tmp_path):
    from tessera.plans.catalog import QUERIES

    rows = [(i, "hot bolt", "Brand#1", "T", i % 50) for i in range(1000)] + [(2000 + i, "hot bolt", None, "T", 1) for i in range(5)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    real = R._ratio
    count = spark.sparkContext.accumulator(0)
    R._ratio = F.pandas_udf(lambda a, b: count.add(len(a)) or a.map(lambda _: 100.0), "double")
    try:
        found = QUERIES["hard_edge_filters"](spark, str(tmp_path)).collect()
    finally:
        R._ratio = real
    assert len({(r["a"], r["b"]) for r in found}) == len(found) == 50 * 190
    assert count.value <= 100  # classes: one a size; all pairs that are kept were 9,500


def test_canonical_pick(spark):
    rows = [(1, "b c"), (1, "bb"), (1, "aa"), (2, "binder - pvdf (x)"), (3, "conductive additive: carbon")]
    got = {r["component"]: r["canonical_name"] for r in R.pick_canonical(spark.createDataFrame(rows, "component int, cleaned_name string")).collect()}
    assert got == {1: "aa", 2: "pvdf (x)", 3: "carbon"}


def test_resolve_names_end_to_end(spark):
    rows = [("d1", 0, "Nickel Oxide★", "NiO", "a"), ("d2", 0, "nickel oxide", None, "a"), ("d3", 0, "Nickel  Oxides", "NiO", "a"), ("d4", 0, "zinc", None, None)]
    out = R.resolve_names(spark.createDataFrame(rows, "doi string, material_index int, raw_name string, formula string, role string"), least=0.6).collect()
    got = {r["doi"]: r["canonical_name"] for r in out}
    assert got["d1"] == got["d2"] == got["d3"] == "nickel oxide" and got["d4"] == "zinc"


# ---- units and properties -------------------------------------------------------------


MAP = [(0, "mA", "A", "0.001"), (1, "C", "K", "add 273.15"), (2, "x", "Dimensionless", None), (3, "mA", "A", "0.5"), (4, "u", "Unable to convert", "2"), (5, "bad", "s", "q")]


def test_conversion_cascade(spark):
    rows = [(1, "10", "mA"), (2, "1", " C "), (3, "7", "x"), (4, "n/a", "mA"), (5, "1", "zz"), (6, "1", " "), (7, "3", "u"), (8, None, "mA"), (9, "1", "bad"), (10, "100F", "mA")]
    out = U.normalize_units(spark.createDataFrame(rows, "i int, value string, unit string"), spark.createDataFrame(MAP, UNIT_CONVERSION))
    got = {r["i"]: (r["status"], r["value"], r["unit"], r["original_value"], r["original_unit"]) for r in out.collect()}
    assert got[1] == ("normalized", "5.0", "A", "10", "mA") and got[2] == ("normalized", "274.15", "K", "1", "C")
    assert got[3] == ("missing_factor", "7", "1", "7", "x") and got[4] == ("non_numeric", "n/a", "A", "n/a", "mA")
    assert got[5] == ("unmatched", "1", "zz", "1", "zz") and got[6] == ("missing_unit", "1", " ", None, None)
    assert got[7] == ("normalized", "6.0", "u", "3", "u") and got[8][0] == "non_numeric" and got[9][0] == "missing_factor" and got[10][0] == "non_numeric"
    s = U.unit_statistics(out).first().asDict()
    assert s.pop("visited") == sum(s.values()) == 10
    first = U.normalize_units(spark.createDataFrame(rows[:1], "i int, value string, unit string"), spark.createDataFrame(MAP, UNIT_CONVERSION), keep="first")
    assert first.first()["value"] == "0.01"


def test_map_hygiene_adds_up(spark):
    rows = [(0, "a", "s", "1"), (1, " a ", "s", "1"), (2, "b", "s", "1"), (3, None, "s", "1"), (4, " ", "s", "1"), (5, "b", "s", "1")]
    got = {r["pos"]: r["fate"] for r in U.map_hygiene(spark.createDataFrame(rows, UNIT_CONVERSION), spark.createDataFrame([("a",), ("c",)], "unit string")).collect()}
    assert got == {0: "kept", 1: "duplicate", 2: "unused", 3: "invalid", 4: "invalid", 5: "duplicate"}
    assert [r["unit"] for r in U.uncovered(spark.createDataFrame([(" c ",), ("a",), (None,), ("c",)], "unit string"), spark.createDataFrame(rows, UNIT_CONVERSION)).collect()] == ["c"]


def test_property_map(spark):
    m = spark.createDataFrame([(0, "cap", "capacity"), (1, " cap ", " capacitance "), (2, "n", None), (3, "b", " ")], PROPERTY_MAP)
    rows = spark.createDataFrame([(1, " cap"), (2, "n"), (3, "b"), (4, "q"), (5, " "), (6, None), (7, "CAP")], "i int, property_name string")
    got = {r["i"]: (r["property_name"], r["original_property_name"], r["status"]) for r in U.apply_property_map(rows, m).collect()}
    assert got == {1: ("capacitance", "cap", "normalized"), 2: ("n", "n", "no_target"), 3: ("b", "b", "no_target"), 4: ("q", "q", "unmatched"), 5: (" ", None, "empty"), 6: (None, None, "empty"), 7: ("CAP", "CAP", "unmatched")}


# ---- documents and graph -----------------------------------------------------------------


DOC = {
    "metadata": {"doi": "10/a", "title": "T"},
    "materials": [
        {
            "name": "NiO", "formula": "NiO", "role": "active_material", "morphology": "nanosheet", "electrolyte": False,
            "synthesis_route": [{"method": "hydrothermal", "precursors": ["KOH (activator)", "KOH (base)"], "parameters": [{"parameter_name": "t", "value": 5, "unit": "h"}]}, {"method": "annealing", "precursors": [], "parameters": []}],
            "performance_and_properties": [
                {"property_name": "specific_capacitance", "value": "300", "unit": "F g-1", "test_conditions": [{"condition_name": "current", "value": "1 A/g"}, {"condition_name": "Electrolyte", "value": "6 M KOH"}]},
                {"property_name": "energy_density", "value": {"min": 1}, "unit": "Wh/kg", "test_conditions": None},
            ],
        },
        {"name": " KOH ", "role": None, "electrolyte": True, "synthesis_route": {"method": "mixing", "precursors": None, "parameters": None}, "performance_and_properties": None},
    ],
}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("docs")
    (d / "a.json").write_text(json.dumps(DOC, indent=1))
    (d / "b.json").write_text('{"materials": null}')
    (d / "c.json").write_text("{broken")
    return D.read_json_dir(spark, str(d))


def test_scan_and_quarantine(docs):
    assert D.good(docs).count() == 2 and [r[0].rsplit("/", 1)[1] for r in D.bad(docs).collect()] == ["c.json"]
    assert {r["doi"] for r in D.extraction(D.good(docs)).collect()} == {"10/a", "b"}


def test_nested_rows(docs):
    ex = D.extraction(D.good(docs))
    assert [(r["raw_name"], r["material_index"]) for r in D.name_records(ex).orderBy("material_index").collect()] == [("NiO", 0), ("KOH", 1)]
    assert [(r["material_index"], r["step_order"], r["method"]) for r in D.steps(ex).orderBy("material_index", "step_order").collect()] == [(0, 1, "hydrothermal"), (0, 2, "annealing"), (1, 1, "mixing")]
    assert {r["value_text"] for r in D.properties(ex).collect()} == {"300", '{"min":1}'}
    assert sorted(r["unit"] for r in D.units_used(ex).collect()) == ["F g-1", "Wh/kg", "h"]


def test_walks(docs):
    assert sorted(r["unit"] for r in D.every_unit(docs).collect()) == ["F g-1", "Wh/kg", "h"]
    inside = D.value_objects(docs, within="performance_and_properties").collect()
    assert [r["name"] for r in inside] == ["specific_capacitance", "energy_density"]
    assert {r["path"] for r in D.value_objects(docs).collect()} >= {"$.materials[0].synthesis_route[0].parameters[0]"}


def test_documents_are_converted_in_place(spark):
    entries = spark.createDataFrame(MAP, UNIT_CONVERSION)
    doc = {"m": [{"value": 10, "unit": " mA ", "note": "é"}, {"value": {"value": "1", "unit": "C"}, "unit": "C"}, {"unit": "zz", "value": "n/a"}, {"value": 1, "unit": None}], "k": [1, "x"]}
    plain = '{"a":  1}'
    df = spark.createDataFrame([("f", json.dumps(doc)), ("g", plain), ("h", "{"), ("i", None)], "file_path string, text string")
    out, rows = D.convert_documents(df, entries)
    got = {r["file_path"]: r["text"] for r in out.collect()}
    assert got["g"] == plain and got["h"] == "{" and got["i"] is None
    m = json.loads(got["f"])["m"]
    assert m[0] == {"value": 5.0, "unit": "A", "note": "é", "original_unit": "mA", "original_value": 10}
    assert m[1]["unit"] == "K" and m[1]["original_value"] == {"value": "1", "unit": "C"} and m[1]["value"] == {"value": 274.15, "unit": "K", "original_unit": "C", "original_value": "1"}
    assert m[2] == {"unit": "zz", "value": "n/a", "original_unit": "zz", "original_value": "n/a"} and m[3] == {"value": 1, "unit": None}
    assert json.loads(got["f"])["k"] == [1, "x"] and U.unit_statistics(rows).first()["visited"] == 5


def test_properties_are_renamed_in_place(spark):
    mapping = spark.createDataFrame([(0, "Cs ", "capacitance"), (1, "none", None)], "pos int, property string, normalized string")
    doc = {"materials": [{"performance_and_properties": [{"property_name": " Cs"}, {"property_name": "none"}, {"property_name": ""}, {"property_name": "other"}]}]}
    out, _ = D.rename_documents(spark.createDataFrame([("f", json.dumps(doc))], "file_path string, text string"), mapping)
    got = json.loads(out.first()["text"])["materials"][0]["performance_and_properties"]
    assert got == [{"property_name": "capacitance", "original_property_name": "Cs"}, {"property_name": "none", "original_property_name": "none"}, {"property_name": ""}, {"property_name": "other", "original_property_name": "other"}]


def test_normalize_json(spark):
    df = spark.createDataFrame([('{"a²": "x–y", "a2": [" b  c "]}',), ("{",), (None,)], "text string")
    assert [r[0] for r in D.normalize_json(df).collect()] == ['{"a2": ["b c"]}', None, None]


def test_normalize_lists_keeps_first_place(spark):
    df = spark.createDataFrame([("c", 0, "m²"), ("c", 1, "x"), ("c", 2, "m2")], "k string, pos int, value string")
    assert [(r["value"], r["pos"]) for r in D.normalize_lists(df, ["k"]).collect()] == [("m2", 0), ("x", 1)]


def test_graph(docs):
    g = G.build_graph(D.extraction(D.good(docs)))
    n = {k: v.count() for k, v in g.items()}
    assert n["paper_source"] == 2 and n["material"] == 3 and n["morphology"] == 1 and n["synthesis_step"] == 3 and n["precursor"] == 1
    assert n["NEXT_STEP"] == 1 and n["USING_ELECTROLYTE"] == 1 and n["MEASURED_UNDER"] == 1 and n["test_condition"] == 1 and n["EXHIBITS_PROPERTY"] == 2
    p = g["precursor"].first()
    assert (p["name"], p["original_name"], p["role_hint"]) == ("KOH", "KOH (activator)", "activator")
    c = g["test_condition"].first()
    assert (c["value"], c["unit"], c["raw_value"]) == ("1.0", "A/g", "1 A/g")
    e = g["material"].where("components_json is not null").first()
    assert e["name"] == "6 M KOH" and json.loads(e["components_json"])[0]["solute"] == "KOH"
    for key, label in (("doi", "paper_source"), ("material_id", "material"), ("property_id", "property"), ("step_id", "synthesis_step")):
        assert G.violations(g[label], key).count() == 0
    text = {r["material_id"]: r["text"] for r in G.profiles(g).collect()}
    assert list(text.values()) == ["Material: NiO Original name: NiO Role: active_material Morphology: nanosheet Synthesis methods: annealing, hydrothermal Precursors: KOH (activator) Key properties: specific_capacitance: 300 F g-1, energy_density: {\"min\":1} Wh/kg"]


def test_edges_of_documents_alone_need_no_shuffle(spark):
    def doc(doi, k):
        step = {"method": f"m{k % 3}", "precursors": ["KOH (base)", "KOH", f"P{k}", "", None], "parameters": [{"parameter_name": "t", "value": k}]}
        conds = [{"condition_name": "electrolyte", "value": v} for v in ["1 M KOH", "1 M KOH", f"{k} M KOH"][: k % 4]] + [{"condition_name": "scan rate", "value": 5}]
        mats = [{"name": "a", "morphology": f"n{k % 2}", "synthesis_route": route, "performance_and_properties": [{"property_name": "q", "value": 1, "test_conditions": conds}] * 2} for route in (step, [step] * (k % 3), [step, None, step], None)]
        return (f"/x/{k}.json", json.dumps({"metadata": {"doi": doi, "title": "T"}, "materials": mats}))

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    alone = [doc(f"d{k}", k) for k in range(7)]
    again = [doc("d1", 8), doc("twice", 9), doc("twice", 10), doc("twice", 9)]
    for texts in (alone, alone + again, again + [doc("", 11), (None, doc("", 12)[1])]):
        docs = D.extraction(spark.createDataFrame(texts, "file_path string, text string"))
        g, want = G.build_graph(docs), G._edges(docs, D.steps(docs), False)
        for name, df in want.items():
            assert rows(g[name]) == rows(df) and df.count(), name
    g = G.build_graph(D.extraction(spark.createDataFrame(alone, "file_path string, text string")))
    for name in ("PRODUCED_BY", "NEXT_STEP", "USES_METHOD", "USES_PRECURSOR", "HAS_PARAMETER", "EXHIBITS_PROPERTY", "MEASURED_UNDER", "HAS_MORPHOLOGY"):
        assert "Exchange" not in g[name]._jdf.queryExecution().executedPlan().toString(), name


def test_merge_first_and_last(spark):
    rows = spark.createDataFrame([("k", 1, "a", "x"), ("k", 2, "b", "y"), (None, 3, "c", "z")], "k string, o int, f string, l string")
    assert [tuple(r) for r in G.merge_nodes(rows, "k", F.col("o"), ["f"], ["l"]).collect()] == [("k", "a", "y")]


def test_top_k_ties_and_zero_vectors(spark):
    df = spark.createDataFrame([(3, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (4, None)], "id int, embedding array<double>")
    assert [(r["id"], r["score"]) for r in top_k(df, [1.0, 0.0], 5).collect()] == [(1, 1.0), (3, 1.0)]
    assert top_k(df, [], 5).count() == 0


def test_property_search(spark):
    v = spark.createDataFrame([("m1", [1.0, 0.0]), ("m2", [0.9, 0.1]), ("m3", [0.0, 1.0])], "id string, embedding array<double>")
    ex = spark.createDataFrame([("m1", "p1"), ("m2", "p2"), ("m2", "p3")], "src_id string, dst_id string")
    pr = spark.createDataFrame([("p1", "cap", "5", "F"), ("p2", "cap", "300", "F"), ("p3", "cap", "1000", "F")], "property_id string, property_name string, value string, unit string")
    assert [(r["id"], r["value"]) for r in G.search_with_property(v, [1.0, 0.0], ex, pr, "cap", 100, k=2, limit=3).collect()] == [("m2", "300"), ("m2", "1000")]
    prof = G.search_with_profile(v, [1.0, 0.0], ex, pr, ["cap"], 3).collect()
    assert [(r["id"], r["cap_max"], r["cap_max_num"]) for r in prof] == [("m1", "5", 5.0), ("m2", "300", 1000.0), ("m3", None, None)]


def test_raw_predicate_takes_numbers_alone(spark):
    v = spark.createDataFrame([("m", [1.0])], "id string, embedding array<double>")
    ex = spark.createDataFrame([("m", f"p{i}") for i in range(5)], "src_id string, dst_id string")
    leaves = spark.createDataFrame([("p0", "400000"), ("p1", '"400000"'), ("p2", '"100F"'), ("p3", "4e5"), ("p4", '{"min": 1}')], "property_id string, j string")
    pr = leaves.withColumn("v", F.try_parse_json("j")).select("property_id", F.lit("cap").alias("property_name"), D.variant_text("v").alias("value"), F.lit("F").alias("unit"), G.variant_number("v").alias("number"))
    found = lambda coerce: sorted(r["dst_id"] for r in G.search_with_property(v, [1.0], ex, pr, "cap", 300000, coerce=coerce).collect())
    assert found(False) == ["p0", "p3"] and found(True) == ["p0", "p1", "p3"]


def test_attributes_of_repeated_keys_do_not_multiply_nodes(spark):
    nodes = spark.createDataFrame([("a", "old"), ("b", "old"), (None, "old")], "k string, d string")
    values = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z"), (None, "n")], "k string, d string")
    assert sorted((r["k"] or "", r["d"]) for r in G.set_attribute(nodes, values, "k", "d").collect()) == [("", "old"), ("a", "y"), ("b", "old")]


def test_jsonl_rules(spark):
    lines = spark.createDataFrame([(1, "{"), (2, "{}"), (3, '{"recordId":1,"modelInput":{"messages":[]}}'), (4, '{"modelInput":{}}'), (5, "")], "line int, value string")
    got = sorted((r["line"], r["error"]) for r in D.validate_lines(lines).collect())
    assert got == [(1, "invalid JSON"), (2, "missing modelInput"), (2, "missing recordId"), (4, "missing messages"), (4, "missing recordId"), (5, "invalid JSON")]


def test_chunks(spark):
    got = D.chunks(spark.range(0, 25).withColumnRenamed("id", "k"), "k", 10).orderBy("k").collect()
    assert [r["batch"] for r in got] == [i // 10 for i in range(25)]


# ---- ledgers --------------------------------------------------------------------------


def test_work_lists(spark):
    ledger = spark.createDataFrame([("a/1", 0, None, 0), ("a/2", 1, 1, 1), ("a/3", 3, 3, 2), (None, 0, 0, 3), ("a/2", 1, 2, 4)], "doi string, downloaded int, llm_processed int, o int")
    assert [r["doi"] for r in L.to_download(ledger).collect()] == ["a/1"]
    files = spark.createDataFrame([("a_1.json",), ("a_2.json",), ("a_3.json",), ("zz.json",)], "file_name string")
    assert {r["doi"] for r in L.to_process(files, ledger, "o").collect()} == {"a/1", "a/2", "a/3"}
    log = spark.createDataFrame([("a/1", 2, 1), ("a/1", 1, 2)], "doi string, status int, ts int")
    assert {r["doi"]: r["downloaded"] for r in L.append_status(ledger.where("doi is not null and o < 4"), log, "downloaded").collect()}["a/1"] == 1


def test_reply_fallback_and_names(spark):
    want = spark.createDataFrame([(0, "A"), (0, "B")], "batch int, name string")
    got = spark.createDataFrame([(0, "A", "a", True, None)], "batch int, name string, canonical_name string, electrolyte boolean, error string")
    rows = {r["name"]: (r["canonical_name"], r["electrolyte"], r["missing"]) for r in L.reply_join(want, got).collect()}
    assert rows == {"A": ("a", True, False), "B": ("B", False, True)}
    assert [r["name"] for r in L.missing_names(want, got).collect()] == ["B"]
    out = {r["original_name"]: (r["name"], r["electrolyte"]) for r in L.apply_names(want, got).collect()}
    assert out == {"A": ("a", True), "B": ("B", False)}


def test_enrich_and_authors(spark):
    left = spark.createDataFrame([(" 10/A ",), ("x",)], "doi string")
    right = spark.createDataFrame([("10/a", "2020", 0), ("10/a", "2021", 1), ("10/a", None, 2), (None, "2", 3)], "doi string, cover_date string, o int")
    assert [r["cover_date"] for r in L.enrich(left, right, "doi", "cover_date", "o").orderBy("doi").collect()] == ["2021", None]
    row = spark.range(1).select(L.authors(F.array(*[F.lit(x) for x in ["a", "", *"bcdefghijk"]])).alias("s")).first()["s"]
    assert row["author_count"] == 11 and row["authors"].count(";") == 9


def test_search_records(spark):
    page = '[{"eid":"1","prism:doi":"d","dc:title":"t","prism:publicationName":"p","prism:coverDate":"2020","citedby-count":"7","openaccess":"1"},{"eid":"2"}]'
    rows = L.search_records(spark.createDataFrame([(page,)], "entries string")).orderBy("eid").collect()
    assert [(r["eid"], r["doi"], r["citedby_count"], r["open_access"]) for r in rows] == [("1", "d", 7, "1"), ("2", None, 0, "0")]
