import json
import time

import pytest

from tessera.sources import files, harvest, xml_docs
from tessera.streaming import incremental

XML = """<full xmlns:dc="d" xmlns:ce="c" xmlns:p="p" xmlns:x="x"><coredata><dc:title> T </dc:title><p:doi>10/a</p:doi><dc:description>A <b> b</b>c</dc:description><dc:subject>k1</dc:subject><dc:subject/></coredata>
<x:doc><ce:sections><ce:section><ce:section-title>Intro</ce:section-title><ce:para>H<ce:inf>2</ce:inf>O x<ce:sup>2</ce:sup> <math><mfrac><mi>a</mi><msub><mi>b</mi><mn>1</mn></msub></mfrac></math></ce:para><ce:para> </ce:para>
<ce:section><ce:section-title>Sub</ce:section-title><ce:para>deep</ce:para></ce:section></ce:section></ce:sections></x:doc>
<ce:table><ce:caption>Cap</ce:caption><tgroup><colspec colname="a"/><colspec colname="b"/><colspec colname="c"/>
<thead><row><entry colname="a" morerows="1">M</entry><entry namest="b" nameend="c">G</entry></row><row><entry colname="b">x</entry><entry colname="c">y</entry></row></thead>
<tbody><row><entry colname="a" morerows="1">1</entry><entry>2</entry><entry>3</entry></row><row><entry colname="c">4</entry></row></tbody></tgroup></ce:table></full>"""


def test_xml(spark):
    broken = XML.replace('<entry colname="c">4', '<entry colname="q">4')
    df = spark.createDataFrame([(XML,), ("<a>",), (broken,), (None,)], "text string")
    rows = xml_docs.parse_papers(df).collect()
    ok = rows[0]
    assert (ok["title"], ok["doi"], ok["abstract"], ok["keywords"]) == ("T", "10/a", "A bc", ["k1", None])
    assert [(s["path"], s["title"], s["paragraphs"]) for s in ok["sections"]] == [([0], "Intro", ["H_2O x^2 [MATH:(a)/(b_1)]"]), ([0, 0], "Sub", ["deep"])]
    t = ok["tables"][0]
    assert t["caption"] == "Cap" and t["headers"] == ["M", "G - x", "G - y"] and t["rows"] == [["1", "2", "3"], ["1", None, "4"]]
    assert [r["error"] is None for r in rows] == [True, False, False, False]
    assert xml_docs.accepted(xml_docs.parse_papers(df)).count() == 1
    assert [r["paragraph"] for r in xml_docs.paragraph_rows(xml_docs.accepted(xml_docs.parse_papers(df))).collect()] == ["H_2O x^2 [MATH:(a)/(b_1)]", "deep"]


def test_flat_paragraphs_and_default_columns():
    flat = '<f><coredata/><doc><sections><para>one</para><para/></sections></doc><table><tbody><row><entry>v</entry></row></tbody></table></f>'
    got = xml_docs.parse(flat)
    assert got["sections"] == [{"path": [0], "depth": 1, "title": None, "paragraphs": ["one"]}]
    assert len(got["tables"][0]["headers"]) == 20 and got["tables"][0]["rows"][0][0] == "v" and got["title"] is None


def test_rectangles_of_tables():
    def table(head="", rows="", n=3):
        spec = "".join(f'<colspec colname="c{i}"/>' for i in range(n))
        return xml_docs.parse(f"<f><coredata/><table>{spec}<thead>{head}</thead><tbody>{rows}</tbody></table></f>")["tables"][0]

    t = table('<row><entry morerows="2">A</entry><entry namest="c1" nameend="c2">B</entry></row><row><entry>x</entry><entry>y</entry></row><row><entry>x</entry><entry colname="c2">z</entry><entry>over</entry></row>')
    assert t["headers"] == ["A", "B - x", "B - y - z"]
    t = table('<row><entry namest="q">A</entry><entry nameend="c1" colname="c1">B</entry></row>')
    assert t["headers"] == ["A", "B", ""]
    t = table("", '<row><entry morerows="2">a</entry><entry/><entry>c</entry><entry>lost</entry></row><row><entry>d</entry></row><row><entry colname="c0">own</entry><entry morerows="9">e</entry></row><row><entry>f</entry></row>')
    assert t["rows"] == [["a", "", "c"], ["a", "d", None], ["own", "e", None], ["f", "e", None]]


def test_line_numbers_run_over_splits(spark, tmp_path):
    texts = {"a": "".join(f"line {i} {'x' * (i % 50)}\n" for i in range(2000)), "b": "one\r\n\r\nthree", "c": ""}
    for name, t in texts.items():
        (tmp_path / name).write_bytes(t.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = files.read_lines(spark, f"file://{tmp_path}").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, t in texts.items():
        mine = sorted((r["line"], r["value"]) for r in got if r["file"].endswith(f"/{name}"))
        assert mine == list(enumerate(t.splitlines(), 1))


def test_math_with_three_children():
    from xml.etree import ElementTree as ET

    assert xml_docs.math_text(ET.fromstring("<mfrac><mi>a</mi><mi>b</mi><mi>c</mi></mfrac>")) == "abc"
    assert xml_docs.math_text(ET.fromstring("<msup><mi>a</mi><mi>b</mi><mi>c</mi></msup>")) == "a^b"


def fake_search(query, cursor, count):
    at = 0 if cursor == "*" else int(cursor)
    records = [{"eid": f"{query}{i}", "prism:doi": f"10/{i}", "citedby-count": "3"} for i in range(at, min(at + count, 60))]
    return 200, records, str(at + count) if at + count < 60 else None


def test_search_source(spark):
    harvest.register(spark, fake_search)
    df = spark.read.format("literature_search").option("queries", "a\nb").load()
    assert df.count() == 120
    few = spark.read.format("literature_search").option("queries", "a").option("max_results", "30").load()
    assert few.count() == 30
    assert list(harvest.pages(lambda q, c, n: (500, [1], None), "q")) == []


def test_limiter_and_retries():
    now = [0.0]
    slept = []

    def sleep(s):
        slept.append(s)
        now[0] += s

    lim = harvest.SlidingWindowLimiter(2, 1.0, lambda: now[0], sleep)
    for _ in range(5):
        lim.acquire()
    assert now[0] == 2.0

    def refuse():
        raise harvest.Refused("no")

    def throttle():
        raise harvest.Throttled("slow")

    slept.clear()
    assert harvest.with_retries(refuse, 3, sleep) == (None, "no") and slept == []
    assert harvest.with_retries(throttle, 3, sleep) == (None, "slow") and slept == [3, 4]
    assert harvest.with_retries(lambda: 5) == (5, None)


def test_fetches(spark):
    def fetch(k):
        if k == "bad":
            raise ValueError("x")
        if k == "slow":
            raise TimeoutError("t")
        return f"<{k}>"

    out = harvest.fetch_all(spark.createDataFrame([("a",), ("bad",), ("slow",)], "doi string"), fetch, rate=100, attempts=1)
    assert {r["doi"]: (r["body"], r["status"]) for r in out.collect()} == {"a": ("<a>", 1), "bad": (None, 2), "slow": (None, 3)}
    keys = spark.createDataFrame([(str(i),) for i in range(20)], "doi string")
    started = time.monotonic()
    out = harvest.fetch_all(keys, lambda k: time.sleep(30 if k == "7" else 0.3) or k, rate=1000, attempts=1, workers=20, timeout=2.0).collect()
    assert time.monotonic() - started < 15
    assert {r["doi"]: r["status"] for r in out} == {str(i): 3 if i == 7 else 1 for i in range(20)}
    details = harvest.fetch_details(spark.createDataFrame([("1",), ("2",)], "eid string"), lambda k: {"title": "t", "authors": ["a", None, "b"], "abstract": "z"} if k == "1" else {}[k])
    got = {r["eid"]: r for r in details.collect()}
    assert got["1"]["authors"] == "a; b" and got["1"]["author_count"] == 2 and got["1"]["abstract"] == "z" and got["2"]["error"]


def test_lines_and_documents(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a":1}\n\n{"a":2}\n')
    assert [(r["line"], r["value"]) for r in files.read_lines(spark, str(tmp_path / "x.jsonl")).orderBy("line").collect()] == [(1, '{"a":1}'), (2, ""), (3, '{"a":2}')]
    files.write_documents(spark.createDataFrame([("p/a.json", "1"), ("b.json", "2")], "rel_path string, text string"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    mirror = spark.createDataFrame([("p/q/a.json", "{\"a\": 1}"), ("b.json", None)], "rel_path string, text string")
    for _ in range(2):
        assert files.write_mirror(mirror, f"file://{tmp_path}/mirror") == 2
    assert {str(f.relative_to(tmp_path / "mirror")): f.read_text() for f in (tmp_path / "mirror").rglob("*") if f.is_file()} == {"p/q/a.json": '{"a": 1}', "b.json": ""}
    assert files.write_mirror(mirror.limit(0), f"file://{tmp_path}/mirror") == 0
    with pytest.raises(Exception, match="no path below"):
        files.write_mirror(spark.createDataFrame([("../a", "")], "rel_path string, text string"), f"file://{tmp_path}/mirror")
    files.write_vocabulary(spark.createDataFrame([("b",), ("a",)], "unit string"), str(tmp_path / "words"), "unit")
    assert [r["unit"] for r in spark.read.json(str(tmp_path / "words" / "json")).collect()] == ["a", "b"]
    assert spark.read.parquet(str(tmp_path / "words" / "parquet")).count() == 2


def test_incremental_runs(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(json.dumps({"x": 1}))

    def work(df):
        return df.where("value like '%x%'")

    def run():
        incremental.process_new(incremental.stream_texts(spark, str(src)), work, str(tmp_path / "out"), str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination()

    run()
    (src / "b.json").write_text("{}")
    run()
    run()
    status = {r["file_path"].rsplit("/", 1)[1]: r["status"] for r in incremental.latest_status(spark, str(tmp_path / "log")).collect()}
    assert status == {"a.json": 1, "b.json": 2}
