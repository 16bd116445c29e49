import json

import pytest

from corpusmill.sources import html, jsonl, sinks

LINES = ["", "{oops", "[1]", "{}", '{"a": null}', '{"a": 1}', '{"a": "x", "b": 2}', '{"a": NaN}', '{"a": "y"} tail', '{"a": "1", "a": "2"}']


def read(frame, policy):
    df = frame(list(enumerate(LINES)), "line_no long, value string")
    return {r.line_no: (r.a, r.problem) for r in jsonl.records(df, ["a"], policy).collect()}


def test_lenient_policy(frame):
    assert read(frame, jsonl.Policy()) == {4: (None, None), 6: ("x", None), 9: ("2", None)}


def test_missing_can_be_empty_and_lines_can_stay(frame):
    got = read(frame, jsonl.Policy(missing="empty", wrong_type="keep", invalid="keep", blank="keep"))
    assert got[3] == ("", None) and got[1] == (None, "invalid JSON") and got[0] == (None, "blank line") and got[2][1] == "not an object" and len(got) == len(LINES)


@pytest.mark.parametrize("name", sorted(jsonl.POLICIES))
def test_every_policy_decides_every_case(frame, name):
    policy = jsonl.POLICIES[name]
    for case, line in (("blank", ""), ("invalid", "{oops"), ("missing", "{}"), ("wrong_type", "[1]")):
        df = jsonl.records(frame([(0, line)], "line_no long, value string"), ["a"], policy)
        action = getattr(policy, case)
        if action == "fail":
            with pytest.raises(Exception, match="line 0"):
                df.collect()
        else:
            assert df.count() == (0 if action == "skip" else 1)


def test_valid_lines_are_kept_byte_for_byte(frame):
    lines = ['{"b":1.0, "a":1.50}', "3", "x", "", "null"]
    got = jsonl.valid_lines(frame(list(enumerate(lines)), "line_no long, value string")).collect()
    assert sorted(r.value for r in got) == sorted(['{"b":1.0, "a":1.50}', "3", "null"])


def test_lines_have_places(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text("".join(f"{name}{i}\n" for i in range(300)))
    got = [(r.file[-7:], r.line_no, r.value) for r in jsonl.lines(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted((f"{n}.jsonl", i, f"{n}{i}") for n in "ab" for i in range(300))
    assert jsonl.existing(spark, [str(tmp_path), str(tmp_path / "none")]) == [str(tmp_path)]


def test_logs_and_personas(spark, tmp_path):
    (tmp_path / "log").write_text(" 1 \n\n2\n1\n")
    assert sorted(r.id for r in jsonl.processed_log(spark, str(tmp_path / "log")).collect()) == ["1", "2"]
    assert jsonl.processed_log(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "p.json").write_text(json.dumps({"personas": [{"role_context": "r"}, {"x": None}]}, indent=1))
    assert [r.persona for r in jsonl.personas(spark, str(tmp_path / "p.json")).collect()] == [{"role_context": "r"}, {"x": None}]


def test_sinks(spark, frame, tmp_path):
    df = frame([(1, None, float("nan")), (2, "é", 1.5)], "i int, s string, d double")
    sinks.write_jsonl(df, str(tmp_path / "j"), single_order="i")
    rows = [json.loads(x) for p in sorted((tmp_path / "j").glob("*.json")) for x in p.read_text().splitlines()]
    assert rows[0]["s"] is None and rows[1] == {"i": 2, "s": "é", "d": 1.5}
    sinks.write_table(df, str(tmp_path / "t"))
    sinks.write_table(df.limit(0), str(tmp_path / "t"))
    assert sorted((r.i, r.d) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(1, None), (2, 1.5)]
    sinks.write_batch(df.select("i"), df.select("i"), str(tmp_path / "b"), 0)
    sinks.write_batch(df.select("i"), df.select("i"), str(tmp_path / "b"), 0)
    assert sinks.batch_ids(spark, str(tmp_path / "b")).count() == 2 and sinks.batch_records(spark, str(tmp_path / "b"), "i int").count() == 2


PAGE = """<html><h2>Type<b>Error</b> <i>x</i></h2><div><ul><li>a</div><p>First <br>text<p>Second</p><h3>Other errors</h3><h2>none</h2>
<dl><dt> KeyError <dd> a &amp; b <dt>plain<dd>c<dt>MyException</dl>
<table><tbody><tr><th><a><code><span>E1</span></code></a></th><td><span>one</span></td></tr><tr><th><code><span>E2</span></code></th><td>no span</td></tr><tr><td> l </td><td>r</td></tr><tr><td>only</td></tr></tbody></table>"""


def test_html():
    assert html.headings(PAGE) == [("TypeErrorx", "Firsttext")]
    assert html.headings(PAGE, ("h2", "h3")) == [("TypeErrorx", "Firsttext"), ("Other errors", "")]
    assert html.definitions(PAGE) == [("KeyError", "a & b"), ("MyException", "")]
    assert html.header_table(PAGE) == [("E1", "one")]
    assert ("l", "r") in html.cell_table(PAGE) and ("only", "N/A") in html.cell_table(PAGE)
    assert html.headings("") == [] and html.headings("<h2>error") == [("error", "")]


def test_pages_with_nulls(frame):
    df = frame([(1, None), (2, ""), (3, PAGE)], "page_id long, html string")
    assert [r.title for r in html.extract(df, html.definitions, "s").orderBy("idx").collect()] == ["KeyError", "MyException"]


def test_selectors():
    root = html.tree('<div id="a" class="x y"><p>1</p><div class="y"><p id="q">2</p><p>3</p></div></div><p>4</p>')
    texts = lambda q: [n.text() for n in html.select(root, q)]
    assert texts("#a > p") == ["1"] and texts("#a p") == ["1", "2", "3"] and texts("div.y > p:nth-child(2)") == ["3"] and texts("p") == ["1", "2", "3", "4"]
    assert texts("div.x.y > .y #q") == ["2"] and texts("#none p") == [] and texts("p:nth-child(9)") == []
    assert html.cell_table(PAGE, "#none") == [] and html.header_table(PAGE, "table > tbody") == html.header_table(PAGE)


def test_ascii_lines_equal_pythons(frame, spark, tmp_path):
    texts = ["plain", "é\u2028한", "😀 x", "", None, "\\u00e9 \"q\"\n"]
    sinks.write_jsonl(frame([(i, t) for i, t in enumerate(texts)], "i int, t string"), str(tmp_path / "a"), ascii_only=True)
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "a")).collect())
    assert got == sorted(json.dumps({"i": i, "t": t}, separators=(",", ":")) for i, t in enumerate(texts))
