import pytest

from corpusmill.operators import fim

HEADED = "# h\nimport a\nimport b\nx = 1\n"


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("i", *(["idx"] if "idx" in df.columns else [])).collect()]


@pytest.mark.parametrize(
    ("code", "want"),
    [
        (HEADED, [("# h", "import a", "import b"), ("import a", "import b", "x = 1")]),
        (HEADED[4:], [("import a", "import b", "x = 1")]),
        ("def f(", [("", "def f(", "")]),
        ("", []),
        (None, []),
    ],
)
def test_statement_triples(frame, code, want):
    assert rows(fim.statement_triples(frame([(1, code)], "i int, content string"), "i"), "prefix_code", "target_code", "suffix_code") == want


def test_unparsed_files_can_be_dropped(frame):
    assert fim.statement_triples(frame([(1, "def f(")], "i int, content string"), "i", drop_unparsed=True).count() == 0


def test_statement_triples_reassemble(frame):
    code = "".join(f"v{i} = {i}\n" for i in range(9))
    got = rows(fim.statement_triples(frame([(1, code)], "i int, content string"), "i"), "prefix_code", "target_code")
    assert [t for _, t in got] == [f"v{i} = {i}" for i in range(1, 8)] and all(int(p[1]) + 1 == int(t[1]) for p, t in got)


@pytest.mark.parametrize(
    ("code", "want"),
    [
        ("import a\nimport b\nimport c\ndef f():\n    return 1\ndef g():\n    return 2\n    # t", [("import a\nimport b\nimport c", "def f():\n    return 1", "def g():\n    return 2\n    # t")]),
        ("import a\nimport b\nimport c\nclass A:\n    def m(self):\n        return 1\nx=1\ny=2\nz=3\n", [("import a\nimport b\nimport c", "class A:", "def m(self):\n        return 1\nx=1\ny=2\nz=3")]),
        ("", []),
        (None, []),
    ],
)
def test_function_triples(frame, code, want):
    assert rows(fim.function_triples(frame([(1, code)], "i int, content string"), "i"), "prefix_code", "target_code", "suffix_code") == want


def test_sampling_is_seeded_and_ordered():
    chunks = [f"c{i}" for i in range(20)]
    first = fim.sampled(chunks, 7, 1, 5)
    assert first == fim.sampled(chunks, 7, 1, 5) and len(first) == 5
    assert first == sorted(first, key=chunks.index) and fim.sampled(chunks, 7, 2, 5) != first and fim.sampled(chunks[:5], 7, 1, 5) == chunks[:5]


def test_a_long_region_is_cut():
    text = "def f():\n" + "\n".join(f"    x{i} = {i}" for i in range(40))
    chunks = fim.definition_chunks(text)
    assert [c.count("\n") + 1 for c in chunks] == [30, 11]
    assert [c for _, _, c in fim.located(text, chunks)] == chunks[:1]  # the second one lost its indent


def test_imports_move(frame):
    df = frame([(1, "import a\nimport b\nimport c\nx=1\n", "y=2", "s"), (2, "import a\nimport b\n", "y", "s"), (3, "import a\nfrom b import c\nimport d\nimport e", None, None), (4, None, "t", "s")], "i int, prefix_code string, target_code string, suffix_code string")
    assert rows(fim.move_imports(df), "prefix_code", "target_code", "suffix_code") == [
        ("import a\nimport b\nx=1\n", "import c\ny=2", "s"),
        ("import a\nimport b\n", "y", "s"),
        ("import a\nfrom b import c\n", "import d\nimport e", None),
        (None, "t", "s"),
    ]


def test_chat_form(frame):
    df = frame([(1, "p\n", "t", "s\n"), (2, None, "t", "s")], "i int, prefix_code string, target_code string, suffix_code string")
    (row,) = fim.chat_form(df).collect()
    assert row.messages[0].content.endswith("```python\np\n# (Complete the code here)\ns\n```\n\n")
    assert "<｜fim begin｜>p\n<｜fim hole｜>s\n<｜fim end｜>t<|EOT|>\n```" in row.messages[1].content
