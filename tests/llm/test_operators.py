"""Each operator against brute force or an exact round trip, and the odd cases: nulls, empty tables, ties, repeats, clashing names."""

import base64
import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat_tools, decontaminate, language_id, licenses, minmax_dedup, mixture, mjpeg, span_dedup, toxicity, warc
from tessera.llm.textkit import alnum_words, space_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOCS)


def words(rng, n, vocab="abcdefghij", size=5):
    return " ".join("".join(rng.choice(vocab) for _ in range(rng.randrange(2, size))) for _ in range(n))


# ---- 1 ------------------------------------------------------------------------------


def ppm_brute(train, order, text):
    """Code length of a text by the definition, with dictionaries."""
    follow = {}
    for t in train:
        data = bytes(order) + t.lower().encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                c = follow.setdefault(data[i - k : i], {})
                c[data[i]] = c.get(data[i], 0) + 1
    data = bytes(order) + text.lower().encode()
    bits = 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            c = follow.get(data[i - k : i])
            if c is None:
                continue
            n, d = sum(c.values()), len(c)
            if data[i] in c:
                bits -= np.log2(c[data[i]] / (n + d))
                break
            bits -= np.log2(d / (n + d))
        else:
            bits += 8
    return bits


def test_ppm_code_lengths_match_the_definition(monkeypatch):
    rng = random.Random(1)
    train = {"a": [words(rng, 20, "abcd") for _ in range(3)], "b": [words(rng, 20, "cdeé") for _ in range(3)]}
    model = language_id.PPM.fit(train, 3)
    texts = [words(rng, 9, "abcdeé") for _ in range(5)] + ["", "xyz", "É!"]
    total, size = model.score(texts)
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.languages):
            assert total[i, j] == pytest.approx(ppm_brute(train[lang], 3, t))
        assert size[i] == len(t.lower().encode())
    whole = model.score([texts[0] * 50])[0]
    monkeypatch.setattr(language_id, "CELLS", 128)
    assert model.score([texts[0] * 50])[0] == pytest.approx(whole)
    monkeypatch.setattr(language_id, "CHUNK", 7)
    assert language_id.PPM.fit(train, 3).score([texts[0] * 50])[0] == pytest.approx(whole)


def test_language_rows(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 30, "abcde" if i % 2 else "vwxyz"), "p" if i % 2 else "q", "s") for i in range(40)]
    rows += [(40, None, "p", "s"), (41, "12 34", None, None), (42, "", "p", "s"), (42, "", "p", "s")]
    df = make_docs(spark, rows).withColumn("lang_pred", F.lit("clash"))
    model = language_id.train(df)
    got = language_id.identify(df, model).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got if r["doc_id"] < 40)
    assert [r["lang_pred"] for r in got if r["doc_id"] >= 40] == ["und"] * 4
    kept = language_id.stage(spark, df, "")
    assert kept.columns == df.columns and kept.count() == 40
    empty = language_id.stage(spark, df.limit(0), "")
    assert empty.count() == 0
    # However small the sample, every language with text is learned, and none without.
    tiny = language_id.train(make_docs(spark, [*rows, (50, "", "empty", "s"), (51, None, "none", "s"), (52, "only one", "rare", "s")]), bound=1)
    assert tiny.languages == ["p", "q", "rare"]
    assert set(tiny.predict(["\x01\x02a" * 9, "zq"])[0]) <= {"p", "q", "rare"}


# ---- 2 ------------------------------------------------------------------------------


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            ("c", "1", 0, "add", '{"b": 2, "a": 1}', []), ("c", "2", 1, "add", '{"a": "x", "z": 1}', ["1"]), ("c", "3", 2, "add", "[1]", ["2", "1", "none"]),
            ("c", "x", 3, "add", '{"a":1,"b":1.5}', ["y"]), ("c", "y", 4, "nope", "{}", ["x"]), ("c", None, 5, "add", "{}", None), ("d", "1", 0, "add", None, None),
        ],
        "conv_id string, call_id string, seq int, name string, arguments string, depends_on array<string>",
    )
    results = spark.createDataFrame([("c", "1", "r"), ("c", "1", "q"), ("c", "9", "lost")], "conv_id string, call_id string, content string")
    schemas = spark.createDataFrame([("add", "a", "integer", True), ("add", "b", "number", True)], "tool string, field string, type string, required boolean")
    got = {(r["conv_id"], r["call_id"]): r for r in chat_tools.link_calls(calls, results, schemas).collect()}
    assert len(got) == 6
    one = got["c", "1"]
    assert (one["topo_level"], one["status"], one["n_results"], one["errors"]) == (0, "linked", 2, "")
    assert one["canonical_json"] == '{"arguments":{"a":1,"b":2},"id":"1","name":"add","result":"q"}'
    assert got["c", "2"]["topo_level"] == 1 and got["c", "2"]["errors"] == "missing field: b; unknown field: z; wrong type: a"
    assert got["c", "3"]["topo_level"] == 2 and got["c", "3"]["errors"] == "arguments are no JSON object; missing dependency: none"
    assert got["c", "x"]["topo_level"] is None and got["c", "x"]["errors"] == "dependency cycle" and got["c", "y"]["errors"] == "dependency cycle; unknown tool"
    assert got["d", "1"]["status"] == "missing_result" and '"arguments":{"raw":null}' in got["d", "1"]["canonical_json"]
    assert [r["call_id"] for r in chat_tools.orphan_results(calls, results).collect()] == ["9"]
    assert chat_tools.link_calls(calls.limit(0), results, schemas).count() == 0


def brute_levels(edges):
    deps = {}
    for c, v, u in edges:
        deps.setdefault((c, v), set()).add((c, u))
    level = {n: 0 for s in deps.values() for n in s if n not in deps}
    changed = True
    while changed:
        changed = False
        for n in deps:
            if n not in level and all(d in level for d in deps[n]):
                level[n], changed = 1 + max(level[d] for d in deps[n]), True
    return {n: k for n, k in level.items() if n in deps}


def test_levels_match_brute_force(spark):
    rng = random.Random(3)
    edges = {("long", str(i + 1), str(i)) for i in range(300)}
    for c in range(12):
        n = rng.randrange(2, 20)
        edges |= {(f"g{c}", str(v), str(rng.randrange(v))) for v in range(1, n) for _ in range(rng.choice([0, 1, 1, 2, 3]))}
        if c % 3 == 0:
            edges.add((f"g{c}", str(rng.randrange(n)), str(rng.randrange(n))))
    edges |= {("ladder", str(i + 2), str(j)) for i in range(5) for j in (i, i + 1)}
    edges |= {("ring", str(i), str((i + 1) % 40)) for i in range(40)} | {("ring", "z", "3"), ("ring", "y", "z"), ("self", "a", "a"), ("self", "b", "a")}
    df = spark.createDataFrame(sorted(edges), "conv_id string, call_id string, needs string")
    ids = df.select("conv_id", "call_id").union(df.select("conv_id", "needs")).distinct()
    got = {(r["conv_id"], r["call_id"]): r["level"] for r in chat_tools.topo_levels(ids, df).collect()}
    assert got == brute_levels(edges) and got["long", "300"] == 300
    assert chat_tools.topo_levels(ids, df.limit(0)).count() == 0


def test_turns_with_odd_roles_and_long_texts(spark):
    rows = [(1, 0, None, "a"), (1, 1, "assistant", "b"), (1, 2, "user", "x" * 300_001), (1, 3, "assistant", None), (None, 0, "user", "q"), (2, None, "user", "q"), (2, 0, "user", None), (2, 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("level", F.lit("clash"))
    calls, results = chat_tools.turn_calls(df)
    schemas = spark.createDataFrame([("user", "text", "string", True), ("user", "turn", "integer", True)], "tool string, field string, type string, required boolean")
    got = {(r["conv_id"], r["call_id"]): r for r in chat_tools.link_calls(calls, results, schemas).collect()}
    assert set(got) == {(1, "call_0"), (1, "call_2"), (2, "call_0")}
    assert got[1, "call_0"]["errors"] == "unknown tool" and got[1, "call_0"]["status"] == "linked"
    assert got[1, "call_2"]["topo_level"] == 1 and "x" * 300_001 in got[1, "call_2"]["canonical_json"]
    assert got[2, "call_0"]["errors"] == "wrong type: text" and got[2, "call_0"]["status"] == "missing_result"


# ---- 3 ------------------------------------------------------------------------------


def brute_overlap(items, text, window=10):
    wins = {}
    for name, t in items:
        w = alnum_words(t)
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[a : a + n]), set()).add(name)
    w, hit, found = alnum_words(text), set(), set()
    for n in {len(k) for k in wins}:
        for a in range(len(w) - n + 1):
            if tuple(w[a : a + n]) in wins:
                hit |= set(range(a, a + n))
                found |= wins[tuple(w[a : a + n])]
    return hit, {f for f in found if f is not None}


def test_overlap_matches_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        items = [(str(i), words(rng, rng.choice([1, 2, 3, 12, 25]), "ab", 4)) for i in range(5)] + [(None, words(rng, 3, "ab", 4)), ("n", None)]
        a = decontaminate.ItemAutomaton([(n, alnum_words(t)) for n, t in items])
        text = words(rng, 60, "ab", 4) + " " + (items[3][1] or "")
        spans, found, _ = a.scan(alnum_words(text))
        hit, want = brute_overlap(items, text)
        assert {i for s, e in spans for i in range(s, e)} == hit and found == want


def test_decontaminate_stage(spark):
    rng = random.Random(5)
    item = words(rng, 30)
    rows = [(1, "Start here, " + words(rng, 40, "xyz") + ". " + item.upper() + "! end of it", "p", "s"), (2, item, "p", "s"), (3, "clean text", "p", "s"), (4, None, None, None), (5, "", "p", "s"), (3, "clean text", "p", "s")]
    df = make_docs(spark, rows).withColumn("spans", F.lit(1)).withColumn("items", F.lit("x"))
    bench = spark.createDataFrame([(1, item), (2, None), (None, "zz top")], "item_id int, text string")
    out = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(df, bench).collect()}
    assert set(out) == {1, 3, 4, 5} and out[1].startswith("Start here,") and out[1].endswith("! end of it") and item.upper() not in out[1]
    assert decontaminate.decontaminate(df, bench).columns == df.columns
    # A one-word item takes its word out of no text, but a text of little else goes.
    word = spark.createDataFrame([(1, "clean"), (2, item)], "item_id int, text string")
    assert decontaminate.decontaminate(df, word).where("text = 'clean text'").count() == 2
    assert decontaminate.decontaminate(df, word, drop_coverage=0.5).where("text = 'clean text'").count() == 0
    one = decontaminate.find_overlaps(df, bench).select("doc_id", "spans", "items").collect()
    long = make_docs(spark, [(9, words(rng, 30_000, "xyz") + " " + item, "p", "s")])
    assert [list(r["spans"][0]) for r in decontaminate.find_overlaps(long, bench).collect()] == [[30_000, 30_030]]
    bench = bench.union(spark.createDataFrame([(3, " ".join(item.split()[9:] + ["more"])), (4, " ".join(item.split()[5:15]))], bench.schema))
    one = decontaminate.find_overlaps(df, bench).select("doc_id", "spans", "items").collect()
    many = decontaminate.find_overlaps(df, bench, block_words=2).select("doc_id", "spans", "items").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))
    assert decontaminate.decontaminate(df, bench.limit(0)).count() == 6


# ---- 4 ------------------------------------------------------------------------------


def brute_classes(rows, size, percent=80):
    sets = {}
    for i, t in rows:
        w = space_words(t)
        k = min(size, len(w))
        sets.setdefault(i, []).append({tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def mutated(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = "m" + str(rng.randrange(10**6))
    return " ".join(w)


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(6)
    base = words(rng, 60)
    rows = [(100 + i, mutated(rng, base, rng.randrange(0, 9))) for i in range(60)]
    rows += [(200 + i, words(rng, rng.randrange(1, 12), "ab", 3)) for i in range(60)]
    rows += [(i, base) for i in range(300, 320)] + [(400, None), (401, ""), (402, "one"), (403, "ONE"), (404, " \t")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    for size in (2, 5):
        got = minmax_dedup.near_duplicates(df, size=size).collect()
        assert len(got) == len(rows)
        assert {r["doc_id"]: r["component_id"] for r in got} == brute_classes(rows, size)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(minmax_dedup, "SMALL", 3)
    monkeypatch.setattr(minmax_dedup, "BLOCK", 7)
    rng = random.Random(7)
    base = words(rng, 80)
    rows = [(i, mutated(rng, base, rng.randrange(2, 9))) for i in range(90)]
    rows += [(500, rows[0][1]), (500, "something else entirely here"), (None, rows[0][1]), (501, "something else entirely here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minmax_dedup.near_duplicates(df, size=2).collect()
    want = brute_classes([r for r in rows if r[0] is not None], 2)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]
    kept = minmax_dedup.stage(spark, df, "")
    ids = sorted((-1 if r["doc_id"] is None else r["doc_id"]) for r in kept.collect())
    # In the stage each row stands for itself: both texts of id 500 are judged alone.
    alone = brute_classes([(k, t) for k, (i, t) in enumerate(rows) if i is not None], 5)
    assert ids == sorted([rows[k][0] for k in set(alone.values())] + [-1]) and kept.columns == df.columns
    assert minmax_dedup.near_duplicates(df.limit(0)).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    rng = random.Random(17)
    a, b, c = (words(rng, 90) for _ in range(3))
    df = spark.createDataFrame([(1, a, 0), (5, mutated(rng, a, 1), 1), (5, b, 2), (5, b, 3), (7, c, 4), (7, a, 5), (8, None, 6), (8, " ", 7), (9, "", 8)], "doc_id long, text string, `x.y` int")
    kept = minmax_dedup.stage(spark, df, "")
    assert sorted(r["x.y"] for r in kept.collect() if r["x.y"] not in (2, 3)) == [0, 4, 6, 7, 8]
    assert sum(r["x.y"] in (2, 3) for r in kept.collect()) == 1 and kept.columns == df.columns


# ---- 5 ------------------------------------------------------------------------------


def test_spans(spark):
    rng = random.Random(8)
    passage = ". ".join(words(rng, 8) for _ in range(7)) + "."
    other = lambda: ". ".join(words(rng, 8) for _ in range(4)) + "."
    rows = [(3, f"{other()}\n{passage}\n{other()}"), (1, f"{other()} {passage} {other()}"), (2, passage), (4, None), (5, ""), (6, "short."), (7, "short."), (None, passage), (8, f"{passage}\n{passage}")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_removed int")
    got = {r["doc_id"]: (r["text"], r["n_removed"], r["first_doc_ids"]) for r in span_dedup.dedup_spans(df).collect()}
    text = dict(rows)
    assert got[1] == (text[1], 0, None) and got[2] == ("", 7, [1]) and got[8] == ("", 14, [1])
    assert passage not in got[3][0] and got[3][0].count(".") == 8
    assert got[4][0] is None and got[5][0] == "" and got[6][0] == got[7][0] == "short." and got[None][0] == passage
    kept = span_dedup.stage(spark, df, "")
    assert kept.columns == df.columns and sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == [-1, 1, 3, 4, 5, 6, 7]
    assert span_dedup.dedup_spans(df.limit(0)).count() == 0


def test_rows_that_share_an_id_lose_their_own_repeats_only(spark):
    rng = random.Random(18)
    p, u, q = (". ".join(words(rng, 8) for _ in range(6)) + "." for _ in range(3))
    df = spark.createDataFrame([(1, p), (5, f"{p}\nsomething else."), (5, u), (5, u), (6, f"{q}\n{q}"), (6, p)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in span_dedup.dedup_spans(df).collect())
    assert got == sorted([(1, p), (5, "something else."), (5, u), (5, u), (6, q), (6, "")])


def test_words_cover_the_text_whatever_the_blocks(monkeypatch):
    rng = random.Random(9)
    texts = ["", "...", "one", *("".join(words(rng, rng.choice([1, 4, 9, 60]), "abÉ\u4e2d") + rng.choice([". ", "\n", " -- ", "! ", ".\n\n", "..."]) for _ in range(20)) for _ in range(20)), "", "x" * 500]
    whole = span_dedup.words_of([t.encode() for t in texts])
    assert [n for n in np.diff(whole.first)] == [len(alnum_words(t)) for t in texts]
    for t in texts[3:-2]:
        w = span_dedup.words_of([t.encode()])
        data = t.encode()
        pieces = [data[a:b] for a, b in zip(w.begin, [*w.begin[1:], len(data)], strict=True)]
        assert b"".join(pieces) == data and [alnum_words(x.decode()) for x in pieces] == [[x] for x in alnum_words(t)]
        assert not span_dedup.without(t, [(0 << 32) | (len(pieces) - 1) << 1])[1] and span_dedup.without(t, [])[1] == t.strip()
        assert len({h for h, x in zip(w.hash.tolist(), alnum_words(t), strict=True)}) == len(set(alnum_words(t)))
    monkeypatch.setattr(span_dedup, "BLOCK", 64)
    for a, b in zip(whole, span_dedup.words_of([t.encode() for t in texts]), strict=True):
        assert (a == b).all()


def test_sentence_runs_are_the_shortest_and_cover_every_shared_stretch():
    rng = random.Random(19)
    for _ in range(60):
        sizes = [rng.choice([1, 3, 6, 9, 15, 30]) for _ in range(rng.randrange(1, 25))]
        count = np.cumsum([0, *sizes])
        total = lambda s, e: int(count[e + 1] - count[s])
        fits = lambda s, e: e - s >= 2 and total(s, e) >= 20
        runs = set(zip(*(x.tolist() for x in span_dedup.sentence_runs(count, np.zeros(len(sizes), int))), strict=True))
        assert all(fits(s, e) and not (fits(s + 1, e) and fits(s, e - 1)) for s, e in runs)
        for s, e in itertools.combinations(range(len(sizes)), 2):
            if fits(s, e):
                inside = [r for r in runs if s <= r[0] and r[1] <= e]
                assert {i for a, b in inside for i in range(a, b + 1)} == set(range(s, e + 1))


def test_spans_against_brute_force(spark):
    """What goes stands in an earlier place, and of what repeats at length no more than the ends stay."""
    rng = random.Random(20)

    def prose(n):
        return " ".join(w + rng.choice(["", "", "", "", ".", ",", "\n"]) for w in words(rng, n, "abcdefghijklmnop", 9).split())

    passages = [prose(n) for n in (30, 46, 60, 60, 90, 150)]
    rows = [(i, " ".join(rng.choice([prose(rng.randrange(1, 50)), rng.choice(passages)]) for _ in range(rng.randrange(1, 6)))) for i in range(60)]
    rows += [(60, rows[7][1]), (61, rows[8][1] + " " + rows[8][1])]
    got = {r["doc_id"]: alnum_words(r["text"]) for r in span_dedup.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    places = {}
    for i, t in rows:
        w = alnum_words(t)
        for a in range(len(w) - 19):
            places.setdefault(tuple(w[a : a + 20]), []).append((i, a))
    removed = 0
    for i, t in rows:
        w, left = alnum_words(t), got[i]
        # Words are nearly all different, so the kept ones can be told apart in order.
        stays, at = [], 0
        for x in w:
            stays.append(at < len(left) and left[at] == x)
            at += stays[-1]
        assert at == len(left)
        earlier = set()
        for a in range(len(w) - 19):
            if min(places[tuple(w[a : a + 20])]) < (i, a):
                earlier |= set(range(a, a + 20))
        gone = {k for k, s in enumerate(stays) if not s}
        removed += len(gone)
        assert gone <= earlier
        for _, run in itertools.groupby(sorted(earlier), key=lambda k, c=itertools.count(): k - next(c)):
            run = list(run)
            if len(run) >= 45:
                assert len(set(run) - gone) <= 50 and gone & set(run)
    assert removed > 500


def common_words(a, b):
    """Words of text b that runs shared with a cover."""
    _, h, c, _, _, _ = span_dedup.all_runs([a.encode()])
    known = set(zip(h.tolist(), c.tolist(), strict=True))
    _, h, c, s, e, _ = span_dedup.all_runs([b"some text. before", b.encode(), b"and after"])
    return {i for k, x, y in zip(zip(h.tolist(), c.tolist(), strict=True), s.tolist(), e.tolist(), strict=True) if k in known for i in range(x, y + 1)}


@pytest.mark.parametrize("every", [0, 5, 11, 22])
def test_passages_at_random_offsets_share_a_run(every):
    rng = random.Random(every)

    def prose(n):
        out = words(rng, n, "abcdefghijklmnop", 9).split()
        at = rng.randrange(1, every + 1) if every else n
        while at < n:
            out[at] += "."
            at += rng.randrange(max(every - 3, 1), every + 4)
        return out

    for size in (45, 51, 60, 120):
        for _ in range(60):
            passage = prose(size)
            left = [prose(rng.randrange(1, 60)) for _ in range(2)]
            a, b = (" ".join(x + passage + prose(rng.randrange(1, 60))) for x in left)
            at = len(left[1])
            got = sorted(common_words(a, b) & set(range(at, at + size)))
            assert got and got[0] - at <= 25 and at + size - 1 - got[-1] <= 25
            assert size < 100 or got == list(range(got[0], got[-1] + 1))


def test_cuts_in_passages_laid_out_against_the_sentences():
    rng = random.Random(11)
    for _ in range(100):
        parts = [words(rng, n, "abcdefghijklmnop", 9) for n in (14, 22, 22, 14)]
        passage = ". ".join(parts)
        a, b = (f"{words(rng, 9)} {passage} {words(rng, 9)}" for _ in range(2))
        assert len(common_words(a, b)) >= 26


def test_copies_of_few_sentences_go(spark):
    rng = random.Random(10)
    vocabulary = list({words(rng, 1, "abcdefghijklmnop", 9) for _ in range(3000)})
    hashes = span_dedup.words_of([" ".join(vocabulary).encode()]).hash
    unpicked = [w for w, h in zip(vocabulary, hashes.tolist(), strict=True) if h % span_dedup.PICK]
    one, two, short = (" ".join(rng.choice(unpicked) for _ in range(n)) for n in (160, 55, 20))
    two = two.replace(" ", ". ", 1)
    rows = [(1, one), (2, one), (3, f"({two})"), (4, f"({two})"), (5, short), (6, short), (7, short[: short.rindex(" ")]), (8, "the " * 200), (9, "x " + "the " * 150), (10, f"start {one} end")]
    got = {r["doc_id"]: r for r in span_dedup.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["text"] for i in (1, 3, 5, 7)] == [dict(rows)[i] for i in (1, 3, 5, 7)]
    assert [(got[i]["text"], got[i]["first_doc_ids"]) for i in (2, 4, 6)] == [("", [1]), ("", [3]), ("", [5])]
    assert 26 <= got[8]["text"].split().count("the") <= 60 and got[9]["text"].split().count("the") < 26
    assert got[10]["text"].startswith("start") and got[10]["text"].endswith("end") and len(got[10]["text"].split()) <= 2 + 2 * 25


# ---- 6 ------------------------------------------------------------------------------


def test_avi_round_trip():
    rng = np.random.default_rng(0)
    for n in (1, 2, 9):
        frames = rng.integers(0, 256, (n, 12, 16), dtype=np.uint8)
        data = mjpeg.write_avi(frames)
        assert (mjpeg.decode_frames(mjpeg.Avi(data).frames) == frames).all()
        cut = data[: data.rindex(b"idx1")]
        assert mjpeg.Avi(b"RIFF" + (len(cut) - 8).to_bytes(4, "little") + cut[8:]).frames == mjpeg.Avi(data).frames
    head = mjpeg._Head(mjpeg.Avi(data).frames[0])
    packed = mjpeg.Avi(data).frames[0][head.size : -2].replace(b"\xff\x00", b"\xff")
    slow = head.slow(packed).reshape(12, 16).astype(int)
    slow[0, 0] += 128
    slow[:, 0] = np.cumsum(slow[:, 0])
    assert (np.cumsum(slow, axis=1) % 256 == frames[0]).all()
    for bad in (b"", b"RIFFxxxxAVI ", data[:300]):
        with pytest.raises(ValueError):
            mjpeg.Avi(bad)


def test_media_rows(spark):
    rows = [(1, "é" * 100), (2, None), (3, ""), (4, "x" * 192), (5, "x" * 192), (6, "a" * 1920 + "\x7f\x01" * 960)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, extra int")
    got = {r["doc_id"]: r for r in mjpeg.read_avi(mjpeg.to_avi(df)).collect()}
    for i, t in rows:
        raw = (t or "").encode()
        want = raw + b" " * (-len(raw) % 192 if raw else 192)
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-16:]))
    assert got[4]["media_sha256"] == got[5]["media_sha256"] and got[2]["media_sha256"] == got[3]["media_sha256"]
    assert [c["start_frame"] for c in got[6]["clips"]] == [0, 10]
    assert mjpeg.clip_rows(mjpeg.read_avi(mjpeg.to_avi(df))).count() == 7
    assert mjpeg.read_avi(mjpeg.to_avi(df.limit(0))).count() == 0
    clash = mjpeg.read_avi(mjpeg.to_avi(df.withColumnsRenamed({"extra": "n_bytes"})).withColumn("clips", F.lit("x")))
    assert clash.columns.count("n_bytes") == clash.columns.count("clips") == 1


def test_broken_files_and_long_texts(spark, monkeypatch):
    data = mjpeg.write_avi(np.arange(192 * 3, dtype=np.uint16).astype(np.uint8).reshape(3, 12, 16))
    first = mjpeg.Avi(data).places[0][0]
    broken = [data[:300], b"", b"RIFF", data[:first] + b"\0\0" + data[first + 2 :], data[: first + 60] + b"\xff" * 99 + data[first + 159 :]]
    rows = spark.createDataFrame([(i, b) for i, b in enumerate([None, data, *broken])], "id int, media binary")
    got = mjpeg.read_avi(rows).orderBy("id").collect()
    assert got[0]["payload_bytes"] is got[0]["error"] is None and got[1]["payload_bytes"] == 576 and got[1]["error"] is None
    assert all(r["error"] and r["clips"] is None and r["media_bytes"] == len(b) for r, b in zip(got[2:], broken, strict=True))
    rng = random.Random(22)
    texts = [words(rng, n) + "é" for n in (3, 400, 9000)]
    whole = [mjpeg.inspect(mjpeg.write_avi(np.frombuffer(mjpeg.payload_of(t)[1], np.uint8).reshape(-1, 12, 16))) for t in texts]
    monkeypatch.setattr(mjpeg, "BLOCK", 3)
    for t, w in zip(texts, whole, strict=True):
        media = mjpeg.write_avi(np.frombuffer(mjpeg.payload_of(t)[1], np.uint8).reshape(-1, 12, 16))
        assert mjpeg.inspect(media) == w and b"".join(x.tobytes() for x in mjpeg.Avi(media).blocks(3)) == mjpeg.payload_of(t)[1]


def test_shots_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(40):
        levels = rng.integers(0, 16, rng.integers(2, 40)) * 16
        frames = np.repeat(levels, rng.integers(1, 9))[:, None, None].astype(np.uint8) + rng.integers(0, 20, (1, 12, 16)).astype(np.uint8)
        hist = [[sum(int(x) >> 4 == k for x in f.ravel()) / 192 for k in range(16)] for f in frames]
        diff = [sum(abs(x - y) for x, y in zip(a, b, strict=True)) for a, b in itertools.pairwise(hist)]
        want = [0]
        for k, d in enumerate(diff):
            near = [diff[j] for j in range(max(0, k - 8), min(len(diff), k + 9)) if j != k] or [0.0]
            limit = min(np.mean(near) + 2 * np.std(near), 1.5)
            want += [k + 1] if d > limit + 1e-6 and d >= 0.5 else []
        near_limit = set(mjpeg.shots(frames)) ^ set(want)
        assert not near_limit


def test_shots_of_short_clips_and_dense_cuts():
    black, white = np.zeros((12, 16), np.uint8), np.full((12, 16), 255, np.uint8)
    for n in range(2, 30):
        for at in range(1, n):
            assert mjpeg.shots(np.stack([black] * at + [white] * (n - at))) == [0, at]
    for every in range(1, 8):
        frames = np.stack([(black, white)[i // every % 2] for i in range(60)])
        assert mjpeg.shots(frames) == list(range(0, 60, every))
    short = np.stack([black, black])
    short[1, 1:] = 32
    assert mjpeg.shots(short) == [0, 1] and len(mjpeg.inspect(mjpeg.write_avi(short))["clips"]) == 1
    rng = np.random.default_rng(1)
    assert all(mjpeg.shots(rng.integers(0, 64, (n, 12, 16), dtype=np.uint8)) == [0] for n in range(1, 40))


# ---- 7 ------------------------------------------------------------------------------


def test_licenses(spark):
    from tessera.llm.license_texts import LICENSES, NOTICES, TEXTS

    mit = TEXTS["MIT"]
    british = "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + mit.upper().replace("SUBLICENSE", "SUB-LICENCE")
    rows = [(1, mit), (2, british), (3, mit + " more"), (4, None), (5, ""), (6, "text\nreleased under the MIT licence!\nx"), (6, "..."), (7, "x " * 400_000 + "\nReleased under the MIT License.")]
    df = spark.createDataFrame([(i, t, "z", "clash") for i, t in rows], "doc_id long, text string, known_id string, license_id string")
    got = licenses.scan(df, licenses.known_table(spark, LICENSES), NOTICES).collect()
    assert [(r["doc_id"], r["license_id"], r["notice_ids"]) for r in got] == [(1, "MIT", ""), (2, "MIT", ""), (3, None, ""), (4, None, ""), (5, None, ""), (6, None, "MIT"), (6, None, ""), (7, None, "MIT")]
    assert got[3]["canonical_sha256"] is None and got[4]["canonical_sha256"] == hashlib.sha256(b"").hexdigest() and got[0]["known_id"] == "z"
    assert [got[i]["n_words"] for i in (3, 4, 6, 7)] == [None, 0, 0, 400_005]
    assert licenses.scan(df.limit(0), licenses.known_table(spark, []), {}).count() == 0


def test_every_licence_in_its_published_wrappings(spark, tmp_path):
    import textwrap

    from tessera.llm.license_texts import LICENSES, TEXTS

    def forms(t):
        return [t, "\n\n".join(textwrap.fill(x, 79) for x in t.split("\n")), "Copyright (c) 2001-2024 The Authors <a@b.org>. All rights reserved.\n\n" + textwrap.fill(t, 60), "(c) 2020 Somebody\n" + t.replace("\n", " "), textwrap.fill(t, 72).replace("\n", "\r\n")]

    rows = [(k, x) for k, t in LICENSES for x in forms(t)] + [("MIT", "Copyright (c) 2020 X Y. " + TEXTS["MIT"].replace("\n", " ")), ("ISC", "Copyright 2020 X " + TEXTS["ISC"].replace("\n", " "))]
    df = spark.createDataFrame(rows, "want string, text string")
    got = licenses.scan(df, licenses.known_table(spark, LICENSES), {}).collect()
    assert len({t for _, t in LICENSES}) > 40 and [r["license_id"] for r in got] == [k for k, _ in rows]
    for k, t in TEXTS.items():
        (tmp_path / f"{k}.txt").write_text(t)
    known = licenses.known_files(spark, f"file://{tmp_path}")
    assert {r["known_id"] for r in known.collect()} == set(TEXTS)
    assert licenses.scan(df, known, {}).where("license_id = want").count() == 5 * len(TEXTS) + 2


@pytest.mark.skipif(not os.path.exists("/usr/share/common-licenses/GPL-3"), reason="needs licence texts")
def test_long_licences_from_files(spark):
    folder = "/usr/share/common-licenses"
    names = [n for n in sorted(os.listdir(folder)) if not os.path.islink(f"{folder}/{n}")]
    texts = {n: open(f"{folder}/{n}", encoding="utf-8", errors="replace").read() for n in names}
    df = spark.createDataFrame([(n, re.sub(r"\bLICENSE\b", "Licence", t.upper().replace("\n", "\r\n"))) for n, t in texts.items()] + [("none", texts[names[0]] + " more")], "want string, text string")
    got = licenses.scan(df, licenses.known_files(spark, [f"file://{folder}/{n}" for n in names]), {}).collect()
    assert len(names) > 8 and {r["want"]: r["license_id"] for r in got} == {n: n for n in names} | {"none": None}


# ---- 8 ------------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    rows = [(2, "u2", "same"), (1, "u1", "same"), (3, "u3", None), (4, None, ""), (5, "a\r\nb", "é\r\n\r\nWARC/1.1\r\n\r\n"), (6, "v", "x" * 3_000_000), (1, "u1", "same"), (None, "n", "same"), (None, "n", "alone")]
    df = spark.createDataFrame([(i, u, h, 0) for i, u, h in rows], "page_id long, url string, html string, offset int")
    path = f"file://{tmp_path}/w"
    warc.write_warc(df, path)
    index = warc.build_index(spark, path)
    got = warc.read_payloads(index).collect()
    assert len(got) == len(rows) and all(r["intact"] for r in got)
    seen = {}
    for r in got:
        seen.setdefault((r["page_id"], r["record_type"]), []).append(bytes(r["payload"]).decode())
    assert seen[1, "response"] == ["same", "same"] and seen[2, "revisit"] == [""] and seen[5, "response"] == [rows[4][2]] and seen[6, "response"] == [rows[5][2]]
    assert seen[None, "revisit"] == [""] and seen[None, "response"] == ["alone"] and (4, "revisit") in seen
    assert {r["refers_to"] for r in got if r["page_id"] == 2} == {1}
    assert {r["payload_digest"] for r in got if r["page_id"] == 2} == {base64.b32encode(hashlib.sha1(b"same").digest()).decode()}
    some = warc.read_payloads(index.where("page_id = 5")).collect()
    assert [bytes(r["payload"]).decode() for r in some] == [rows[4][2]]
    warc.write_warc(df.limit(0), f"{path}0")
    assert warc.build_index(spark, f"{path}0").count() == 0
    plain = f"{path}1"
    warc.write_warc(df, plain, min_bytes=10)
    assert warc.build_index(spark, plain).where("record_type = 'revisit'").count() == 0


def test_foreign_archives(spark, tmp_path):
    import gzip

    def record(kind, ident, body, extra=""):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{ident}>\r\n{extra}Content-Length: {len(body)}\r\n\r\n"
        return head.encode() + body + b"\r\n\r\n"

    body = bytes(random.Random(4).randbytes(50_000))
    records = [record("warcinfo", "0", b"software: x"), record("response", "1", body, f"WARC-Target-URI: http://a/\r\nWARC-Payload-Digest: sha1:{warc.base32_sha1(body)}\r\n"), record("metadata", "2", b"")]
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "zip").mkdir()
    (tmp_path / "zip" / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    for folder in ("plain", "zip"):
        index = warc.build_index(spark, f"file://{tmp_path}/{folder}")
        got = warc.read_payloads(index).orderBy("offset").collect()
        assert [(r["record_type"], r["record_id"], r["page_id"], r["url"], r["intact"]) for r in got] == [("warcinfo", "<urn:uuid:0>", None, None, None), ("response", "<urn:uuid:1>", None, "http://a/", True), ("metadata", "<urn:uuid:2>", None, None, None)]
        assert bytes(got[1]["payload"]) == body and bytes(got[0]["payload"]) == b"software: x"


def test_look_ups_by_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(i, "u", "same" if i % 3 else str(i)) for i in range(60)], "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    warc.write_warc(df, path)
    got = warc.read_payloads(warc.build_index(spark, path)).collect()
    assert sorted(r["page_id"] for r in got) == list(range(60)) and all(r["intact"] for r in got)
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {1} and sum(r["record_type"] == "revisit" for r in got) == 39


def test_ranges_are_coalesced():
    got = warc.coalesce_ranges([(0, 10), (10, 5), (100, 5), (300, 50)], gap=100, most=200)
    assert got == [(0, 105, [0, 1, 2]), (300, 50, [3])]


# ---- 9 ------------------------------------------------------------------------------


def test_counterfactual_penalty_levels_identity_terms(spark):
    rng = random.Random(10)
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        # A biased sample: the toxic texts mention one group far more often.
        term = "muslims" if rng.random() < (0.9 if toxic else 0.1) else "christians"
        rows.append((i, f"{words(rng, 12)} {term} {'zork ' * rng.choice([0, 1, 1]) if toxic else ''}{words(rng, 5)}.", int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")

    def gap(penalty):
        m = toxicity.train(df, penalty=penalty)
        return abs(m.score("they are muslims here") - m.score("they are christians here")), m

    free, _ = gap(0.0)
    tied, model = gap(toxicity.PENALTY)
    assert free > 0.2 and tied < free / 4
    assert model.score("you zork") > model.score("you there")


def test_every_identity_term_is_swapped():
    first, *others = toxicity.swaps("Muslims and gay women talk.")
    assert first == "muslims and gay women talk." and {"jews and gay women talk.", "muslims and straight women talk.", "muslims and gay men talk."} <= set(others)
    assert len(others) == 5 + 4 + 4 and len(toxicity.swaps("nothing here")) > 1 and toxicity.pairs_of(None) == toxicity.pairs_of(" \n") == []
    # Of a text's sentences one that mentions a group is taken.
    for bins, change in toxicity.pairs_of("One here. Two there. The elderly talk. Three."):
        assert sum(change) == len(bins) - 2 * sum(c < 0 for c in change) and set(toxicity.word_bins("elderly")) & set(bins)


def test_scores_against_brute_force(spark):
    """The model's weights, by the definition of features and loss."""
    rng = random.Random(21)
    rows = [(i, words(rng, 12) + (" grumble" if i % 3 == 0 else " calm"), int(i % 3 == 0)) for i in range(120)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    x = np.zeros((len(rows), len(model.weights)))
    place = {b: k for k, b in enumerate(model.weights)}
    for r, (_, t, _) in enumerate(rows):
        for w in set(t.split()):
            for b in toxicity.word_bins(w):
                if b in place:
                    x[r, place[b]] += 1
    z = x @ np.array(list(model.weights.values())) + model.base
    assert [model.score(t) for _, t, _ in rows] == pytest.approx((1 / (1 + np.exp(-z))).tolist())
    assert all((model.score(t) > 0.5) == bool(y) for _, t, y in rows)
    got = toxicity.score(spark.createDataFrame([(1, rows[0][1], "clash")], "doc_id long, text string, score string"), model).collect()
    assert got[0]["score"] == pytest.approx(model.score(rows[0][1])) and got[0]["predicted"] == 1


def test_toxicity_rows(spark):
    rng = random.Random(11)
    rows = [(i, words(rng, 30) + (" grumble snarl" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df)
    odd = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, words(rng, 20000) + " Grumble SNARL", 1), (3, "fine", 0)], "doc_id long, text string, label int")
    got = toxicity.score(odd, model).orderBy("doc_id", "score").collect()
    assert got[0]["score"] == got[1]["score"] and got[2]["predicted"] == 0 and got[3]["predicted"] == 1 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(odd.limit(0), model).count() == 0
    only = toxicity.train(df.where("toxic = 0"))
    assert only.score("x") < 0.05 and toxicity.train(df.limit(0)).score("x") == pytest.approx(0.5)


# ---- 10 -----------------------------------------------------------------------------


def fill_by_rounds(sizes, weights, budget, cap=2.0):
    target, fixed = {}, set()
    while True:
        left = budget - sum(cap * sizes[s] for s in fixed)
        w = sum(weights[s] for s in sizes if s not in fixed)
        target = {s: cap * sizes[s] if s in fixed else left * weights[s] / w for s in sizes}
        over = {s for s in sizes if s not in fixed and target[s] > cap * sizes[s]}
        if not over:
            return target
        fixed |= over


def test_water_filling_is_the_fixed_point(spark):
    rng = random.Random(12)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 5, 50, 500, 5000]) for i in range(rng.randrange(2, 9))}
        if not any(sizes.values()):
            continue
        df = mixture.cycled_weights(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        got = mixture.water_fill(df).collect()
        want = fill_by_rounds(sizes, {r["source"]: r["weight"] for r in got}, 1.5 * sum(sizes.values()))
        for r in got:
            assert r["target"] == pytest.approx(want[r["source"]])


def test_mixture(spark):
    rng = random.Random(13)
    rows = [(i, words(rng, rng.randrange(0, 60)), "p", rng.choice(["a", "a", "a", "b", "ü", None])) for i in range(600)]
    rows += [(600, None, "p", "a"), (601, "", "p", "null words"), (7, "twice", "p", "b"), (7, "twice", "p", "b")]
    df = make_docs(spark, rows).withColumn("size", F.lit("clash"))
    got = mixture.mix(df).collect()
    again = mixture.mix(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    by = {}
    for r in got:
        t, n, s = by.get(r["source"], (0, 0, 0))
        by[r["source"]] = (r["target"], n + r["taken"], s + r["size"])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["size"] == len(space_words(r["text"]))
    for t, n, s in by.values():
        assert abs(t - n) <= 1 and t <= 2 * s
    staged = mixture.stage(spark, df, "")
    assert sum(r["mix_words"] for r in staged.collect()) == sum(n for _, n, _ in by.values())
    assert all(len(space_words(r["text"])) == r["mix_words"] for r in staged.collect())
    assert mixture.mix(df.limit(0)).count() == 0


def test_mixture_of_equal_rows(spark):
    """Rows that no key tells apart share the edge of the target."""
    rows = [(None, "a b c", "p", "a")] * 50 + [(1, "a b c d", "p", "b")] * 50 + [(2, "x " * 50_000, "p", "c")]
    got = mixture.mix(make_docs(spark, rows)).collect()
    for s in "abc":
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 1 and all(r["taken"] <= 2 * r["size"] for r in mine)
