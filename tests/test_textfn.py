

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import textfn

SPACES = [chr(c) for c in range(0x10000) if chr(c).isspace()]


def values(frame, texts, column):
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", column.alias("v"))
    return [r.v for r in df.orderBy("i").collect()]


def test_strip_and_split_agree_with_python_on_all_white_space(frame):
    texts = [f"{c}a{c}b{c}" for c in SPACES] + ["", " ", "\n", "a\n", "a\n\n", "\r\n", "a\r\nb\rc", "\x1c\x85 x "]
    assert values(frame, texts, textfn.py_strip("t")) == [t.strip() for t in texts]
    assert values(frame, texts, textfn.py_splitlines("t")) == [t.splitlines() for t in texts]


def test_lines_keep_their_ends_and_join_to_the_text(frame):
    texts = ["", "a", "a\n", "a\n\nb", "\n\n"]
    assert values(frame, texts, F.array_join(textfn.lines_keeping_ends("t"), "")) == texts
    assert values(frame, ["a\n\nb"], textfn.lines_keeping_ends("t")) == [["a\n", "\n", "b"]]


def test_comments_are_removed_in_order(frame):
    texts = ['x = "#a"\n', '"""a # b"""\nc', "'''x\ny'''z", "a  b", None]
    assert values(frame, texts, textfn.remove_comments("t")) == ['x = "\n', '"""a \nc', "z", "a  b", ""]


def test_special_characters(frame):
    assert values(frame, ["a+b c", "", "  ", None, "é 　"], textfn.special_char_ratio("t")) == [0.2, 1.0, 1.0, 1.0, 1 / 3]


def test_code_blocks_and_spacing(frame):
    assert values(frame, ["```python\nA\n```", " hi ", "```\nx```y```python\nz\n```"], textfn.code_blocks("t")) == [["A\n"], ["hi"], ["x", "z\n"]]
    assert values(frame, ["\n\na\n\n\n\nb\n"], textfn.normalize_spacing("t")) == ["a\n\nb"]


def test_allowed_characters_capitals_and_slashes(frame):
    assert values(frame, ["abc\n", "<｜fim", "한", "", None], textfn.only_allowed_characters("t")) == [True, True, False, True, False]
    assert values(frame, ["tOOL bOX", "", "é"], textfn.py_capitalize("t")) == ["Tool box", "", "É"]
    assert values(frame, ["a\\/b", "a/b", None], textfn.unescape_slashes("t")) == ["a/b", "a/b", None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_categories=["Cs"], max_codepoint=0xFFFF), max_size=30), min_size=1, max_size=20))
def test_strip_is_pythons_on_any_text(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", textfn.py_strip("t").alias("v")).orderBy("i").collect()]
    assert got == [t.strip() for t in texts]


