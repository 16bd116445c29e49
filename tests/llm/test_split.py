import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import split as S


def check(text, limit, overlap, kind):
    cut = S.pieces(text, limit, overlap, kind)
    if len(text) <= limit:
        assert cut == []
        return cut
    assert "".join(text[a:b] for a, b in cut) == text
    for k, (a, b) in enumerate(cut):
        assert b - (max(0, a - overlap) if k else 0) <= limit and b > a and (k == 0 or a >= overlap or a == cut[k - 1][1])
    return cut


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n#def:(){}\"<>.é。", max_size=600), st.integers(30, 90), st.integers(0, 20), st.sampled_from(["py", "md", "json", "xml", "toml", "yaml", "ini", None]))
def test_round_trip(text, limit, overlap, kind):
    check(text, limit, overlap, kind)


def test_cuts_at_definitions_lines_and_nowhere():
    code = "".join(f"def f{i}():\n" + "    x = 1\n" * 20 + "\n" for i in range(40))
    cut = check(code, 1000, 100, "py")
    assert all(code[a:].startswith("def ") for a, _ in cut)
    text = "line of words\n" * 900
    assert all(text[b - 1] == "\n" for _, b in check(text, 1000, 100, None))
    assert len(check("x" * 5000, 1000, 200, None)) == 6
    with pytest.raises(ValueError):
        S.pieces("x" * 10, 5, 5)


def test_frames(frame):
    docs = frame([(1, "a.py", "x" * 6001), (2, "a.py", "x" * 6000), (3, None, "é" * 7000), (4, "a.md", None), (5, "a.py", "")], "file_id long, file_path string, content string")
    triples = frame([(1, "y\n" * 1001), (2, None)], "triple_id long, target_code string")
    assert sorted(tuple(r) for r in S.p4_found(docs, triples).collect()) == [("fim_triples", 1), ("source_docs", 1), ("source_docs", 3)]
    rows = S.p4_pieces(docs, triples).where("tbl = 'source_docs' AND rec_id = 1").orderBy("piece_no").collect()
    assert rows[0].text[-200:] == rows[1].text[:200] and rows[1].start_char == len(rows[0].text) - 200 and rows[0].n_pieces == 2
    assert S.p4_pieces(docs.limit(0), triples.limit(0)).count() == 0
