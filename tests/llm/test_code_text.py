import pytest

from corpusmill.llm import functions as F
from corpusmill.llm import prose as P
from corpusmill.llm import syntax as Y
from corpusmill.llm.language import language


@pytest.mark.parametrize(
    ("ext", "text", "want"),
    [
        ("py", "x = 1\n", ("ok", "py")),
        ("py", "def f(\n", ("corrupt", None)),
        ("py", "<a><b>1</b></a>", ("wrong_extension", "xml")),
        ("py", "return 1", ("ok", "py")),
        ("py", "x = '\0'", ("corrupt", None)),
        ("json", '{"a": [1, 2.5, "x"]}', ("ok", "json")),
        ("json", "{'a': 1}", ("wrong_extension", "py")),
        ("json", '{"a": NaN}', ("wrong_extension", "py")),
        ("json", '{"a": 1}{"b": 2}', ("corrupt", None)),
        ("json", "[s]\na : 1\n", ("wrong_extension", "ini")),
        ("json", "9" * 6000, ("ok", "json")),
        ("toml", 'a = "x"\n[b]\nc = 1979-05-27\n', ("ok", "toml")),
        ("toml", "a = \n", ("corrupt", None)),
        ("xml", "<a>&amp;</a>", ("ok", "xml")),
        ("xml", "<a><b></a>", ("corrupt", None)),
        ("xml", "<a/><b/>", ("corrupt", None)),
        ("yaml", ": : :", ("skipped", None)),
        ("py", "  \n", ("skipped", None)),
        ("py", None, ("skipped", None)),
        (None, "x", ("skipped", None)),
    ],
)
def test_verdicts(ext, text, want):
    assert Y.judge(ext, text) == want


def test_rates(frame):
    rows = [(i, "hot" if i % 3 else None, f"d/a.b.{'PY' if i % 2 else 'json'}", "x = (" if i % 4 == 1 else "{}", "odd") for i in range(40)] + [(99, "r", "noext", "x", ""), (98, "r", None, None, None)]
    df = frame(rows, "file_id long, repo string, file_path string, content string, lang string")
    out = {(r.repo, r.lang): (r.n_files, r.n_invalid, r.invalid_rate) for r in Y.p3_rates(df).collect()}
    assert sum(n for n, _, _ in out.values()) == 40 and sum(b for _, b, _ in out.values()) == 10 and all(b / n == rate for n, b, rate in out.values())
    assert Y.p3_found(df).count() == 10 and Y.p3_found(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("The result is sorted by the row buffer.", "en"), ("Falls das Protokoll fehlt, wird stattdessen die Tabelle verwendet.", "de"), ("Si falta el directorio, se usa el archivo de entrada.", "es"),
        ("Si la configuration est absente, on utilise l'index par défaut.", "fr"), ("서버를 다시 시작한 뒤에는 상태를 확인해 주세요.", "ko"), ("この関数はログを読み込んで索引を返します。", "ja"), ("这里必须先排序，否则结果会不一样。", "zh"),
        ("", None), ("x = 1", None), ("foo_bar baz", None),
    ],
)
def test_languages(text, want):
    assert language(text) == want


CODE = '''#!/usr/bin/env python3
# x = compute(a, b, c)
"""Falls das Protokoll fehlt, wird stattdessen die Tabelle verwendet."""
Q = "SELECT worker, channel FROM sensor WHERE ribbon > 5104"
P = "/srv/a/b c/d e/f g h"
N = "Anna Berta Carla Dora Emil"
b = b"The bytes are not a text that counts here."
# y = old[0]
# The loop stops as soon as the row buffer is full.
f"""Si falta el {name}, se usa el archivo de entrada de la última ejecución."""
z = 1  # この関数はログを読み込んで索引を返します。
"""
:param a: row
:return: index
"""
'''


def test_sentences_of_a_file(frame):
    df = frame([(1, "a.py", CODE), (2, "a.py", CODE), (3, "a.py", CODE + "("), (4, "a.md", CODE), (5, "a.py", None), (6, "a.py", "")], "file_id long, file_path string, content string")
    got = sorted(tuple(r) for r in P.p5_found(df).collect())
    assert got == sorted((i, lang) for i in (1, 2) for lang in ("de", "en", "es", "ja"))
    shares = P.file_languages(df).collect()
    assert all(0 < r.share < 1 for r in shares) and {r.n_spans for r in shares} == {1}
    assert P.p5_found(df.limit(0)).count() == 0


def test_literals_side_by_side_and_nested_quotes():
    def langs(code):
        return {k for s in P.spans(code) for k in P.sentences(s)}

    assert langs('x = ("The result is "\n     "sorted by the row buffer.")\n') == {"en"}
    assert langs('x = ["The result is", "sorted by the row"]\n') == set()
    assert langs('f"{a["k"]} # The result of {b["k"]} is sorted by the row buffer."\n') == {"en"}
    assert langs('x = "\\uc11c\\ubc84\\ub97c \\ub2e4\\uc2dc \\uc2dc\\uc791\\ud55c \\ub4a4\\uc5d0\\ub294 \\uc0c1\\ud0dc\\ub97c \\ud655\\uc778\\ud574 \\uc8fc\\uc138\\uc694."\n') == {"ko"}
    assert langs("") == langs('""') == langs('"""') == langs('f"{"') == set()


def test_a_comment_shared_by_a_third_of_all_files(frame):
    rows = [(i, "a.py", f"# The loop stops as soon as the row buffer is full.\nx = {i}\n" if i % 3 == 0 else f"# Sie {i} warten bis der Index der Tabelle fertig ist.\n") for i in range(600)]
    got = {tuple(r) for r in P.p5_found(frame(rows, "file_id long, file_path string, content string").repartition(6)).collect()}
    assert got == {(i, "en" if i % 3 == 0 else "de") for i in range(600)}


FUNCTIONS = '''
@cached
# The comment below the decorator is above the def of this function.
def a():
    pass

# The rows are sorted before they are written out.
@cached
async def b():
    def inner():
        """Returns the number of rows that were changed."""
    return inner

# x = old(1)
def c(): pass

# -----------------------
def d(): "TODO: describe what this function does and why"

class K:
    def save_table(self):
        """Save to the table of the table."""

    def e(self):
        f"""The docstring of this one is no constant at all."""

    def f(self):
        """:param a:
        :param b:
        :return:"""

    # The comment of a method counts too, of course.
    def g(self):
        if 1:
            """The text is not the first statement of it."""

    # This comment doesn't count since a docstring is there.
    def h(self):
        ""

# A blank line parts this comment from the function.

def i(): pass

# この関数はログを読み込んで索引を返します。
def j(): pass
'''


def test_documented_functions():
    assert [n for n, *_ in F.pairs(FUNCTIONS)] == ["b", "b.inner", "K.g", "j"]
    lines = FUNCTIONS.split("\n")
    assert [lines[line - 1].split("(")[0].split()[-1] for _, line, _, _ in F.pairs(FUNCTIONS)] == ["b", "inner", "g", "j"]
    _, _, code, text = F.pairs(FUNCTIONS)[0]
    assert code.startswith("@cached\nasync def b") and text == "The rows are sorted before they are written out."


def test_trivial_documentation():
    assert F.trivial("save the table of the users", "save_table_users") and not F.trivial("save the table of all users", "save_table_users")
    assert F.trivial("FIXME write a lot of words here", "f") and F.trivial("", "f") and F.trivial("Args:\n    a (int): row\n    b: index", "f") and not F.trivial("Args:\n    a: the row that is read first of all", "f")
    assert not F.trivial("这个函数先读取日志然后返回", "f") and F.trivial("读取日志", "f")


def test_pairs_of_odd_rows(frame):
    df = frame([(1, "a.py", FUNCTIONS, 3), (1, "a.py", FUNCTIONS.replace("\n", "\r\n"), 3), (2, "a.txt", FUNCTIONS, 3), (3, "a.py", None, 3), (4, "a.py", "def f(", 3)], "file_id long, file_path string, content string, def_line int")
    assert sorted(tuple(r) for r in F.p7_found(df).collect()) == sorted([(1, line) for _, line, _, _ in F.pairs(FUNCTIONS)] * 2)
    assert F.p7_found(df.limit(0)).count() == 0


def test_lines_of_different_languages_are_different_sentences():
    assert set(P.sentences("<<<<<<< is the mark of an open merge\nAchtung, das Verzeichnis darf nicht mehr als 361 Zeilen enthalten.\n=======")) == {"en", "de"}
    assert P.sentences("Keep the order of the rows because\nthe index depends on it") == {"en": len("Keep the order of the rows because the index depends on it")}
