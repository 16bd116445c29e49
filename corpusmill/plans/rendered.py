"""Inputs rendered from rows by native templates: Python files from parts, HTML pages from repositories.

Their structure is a pure function of the row, so what an operator must find in them can be stated in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IMPORTS = ("import os", "import sys", "from math import sqrt", "import json")


def code_corpus(part: DataFrame) -> DataFrame:
    """(doc_id, content): a header comment, one to four imports, one to three functions, sometimes a class, three assignments;
    every eleventh file breaks off in a definition."""
    p = F.col("p_partkey")
    key = p.cast("string")
    header = F.when(p % 3 == 0, F.concat(F.lit("# item "), key, F.lit("\n"))).otherwise("")
    imports = F.array_join(F.slice(F.array(*map(F.lit, IMPORTS)), 1, (p % 4 + 1).cast("int")), "\n")
    functions = F.array_join(
        F.transform(F.sequence(F.lit(0), (p % 3).cast("int")), lambda i: F.concat(F.lit("def f"), i.cast("string"), F.lit("_"), key, F.lit("(a, b):\n    if a > b:\n        return a\n    return b\n"))), ""
    )
    klass = F.when(p % 5 == 0, F.concat(F.lit("class C"), key, F.lit('(Base):\n    """Holds '), key, F.lit('."""\n\n    def m(self):\n        return '), key, F.lit("\n"))).otherwise("")
    tail = F.concat(F.lit("x = 1\ny = 2\nz = 3\n"), F.when(p % 11 == 0, "def broken(\n").otherwise(""))
    return part.select(p.alias("doc_id"), F.concat(header, imports, F.lit("\n"), functions, klass, tail).alias("content"))


def code_corpus_sql() -> str:
    """The same files in SQL, with their statements as a list."""
    imports = ", ".join(f"'{i}'" for i in IMPORTS)
    return f"""
        files AS (
          SELECT p_partkey AS p, p_partkey % 11 = 0 AS broken, CASE WHEN p_partkey % 3 = 0 THEN '# item ' || p_partkey ELSE '' END AS header,
                 list_slice([{imports}], 1, p_partkey % 4 + 1) AS imports,
                 list_transform(range(0, p_partkey % 3 + 1), lambda i: 'def f' || i || '_' || p_partkey || '(a, b):' || chr(10) || '    if a > b:' || chr(10) || '        return a' || chr(10) || '    return b') AS funs,
                 CASE WHEN p_partkey % 5 = 0 THEN ['class C' || p_partkey || '(Base):' || chr(10) || '    \"\"\"Holds ' || p_partkey || '.\"\"\"' || chr(10) || chr(10) || '    def m(self):' || chr(10) || '        return ' || p_partkey] ELSE [] END AS klass
          FROM part),
        corpus AS (
          SELECT *, list_concat(list_concat(imports, funs), list_concat(klass, ['x = 1', 'y = 2', 'z = 3'])) AS stmts,
                 CASE WHEN header = '' THEN '' ELSE header || chr(10) END || array_to_string(list_concat(list_concat(imports, funs), list_concat(klass, ['x = 1', 'y = 2', 'z = 3'])), chr(10)) || chr(10)
                 || CASE WHEN broken THEN 'def broken(' || chr(10) ELSE '' END AS content
          FROM files)"""


#: Where a page's own table is; another one holds its menu.
MAIN_TABLE = "#main > div.text:nth-child(2) table"


def pages(repos: DataFrame) -> DataFrame:
    """(repo, html): each repository as a page with headings, a definition list and a table."""
    r, stars = F.col("repo"), F.coalesce(F.col("n_stars"), F.lit(0)).cast("string")
    word = F.when(F.coalesce(F.col("n_stars"), F.lit(0)) % 2 == 0, F.lit("Error")).otherwise(F.lit("Notice"))
    html = F.concat(
        F.lit("<html><body><h2>"), word, F.lit(" in <b>"), r, F.lit("</b></h2><div><p>Stars: "), stars, F.lit("</p></div><h3>Other</h3><p>rest</p><dl><dt>"), r, F.lit("Exception</dt><dd> has "), stars,
        F.lit(" stars </dd><dt>plain</dt><dd>no</dd></dl><table><tr><th><code><span>menu</span></code></th><td><span>x</span></td></tr></table><div id=\"main\"><p>a</p><div class=\"wide text\"><table><tbody><tr><th><a><code><span>E"), stars, F.lit("</span></code></a></th><td><span>"), r, F.lit("</span></td></tr><tr><td>"), stars, F.lit("</td></tr></tbody></table></div></div></body></html>"),
    )
    return repos.select(r.alias("repo"), F.coalesce(F.col("n_stars"), F.lit(0)).alias("stars"), F.monotonically_increasing_id().alias("page_id"), html.alias("html"))


def answers(part: DataFrame) -> DataFrame:
    """(p_partkey, answer): a wish about each part, in the frames that language models put around an answer, and in some that they don't."""
    p, name = F.col("p_partkey"), F.col("p_name")
    wish = F.concat(F.lit("Write "), name)
    framed = F.concat(F.lit("Write "), name)
    for k, (before, after, _) in ANSWER_FORMS.items():
        framed = F.when(p % len(ANSWER_FORMS) == k, F.concat(F.lit(before), wish, F.lit(after))).otherwise(framed)
    return part.select(p, framed.alias("answer"))


_INPUT = "a natural user request (input) that describes its functionality and purpose"
#: What stands before and behind the wish, by key, and what of it stays after cleaning: the wish alone, or all.
ANSWER_FORMS = {
    0: ("", "", "wish"),
    1: ("A suitable user request could be:\n\n", "", "wish"),
    2: ("  Here's a natural request:\n\n", " ", "wish"),
    3: (f"The given code snippet is a Python function that returns x.\n\nBased on this, {_INPUT} could be:\n\n", "", "wish"),
    4: ("This code is a parser.\n\nIt has two parts.\n\n", "", "wish"),
    5: ('"', '"\n\nThis request describes the functionality and purpose of it.', "wish"),
    6: ('"', '"', "wish"),
    7: ("The given code snippet is a Python class which walks x.\n\n", "", "all"),
    8: ("The given code snippet appears to be a Python script that creates x.\n\n", "", "wish"),
    9: (f"{_INPUT} of this code could be:\n\n", "", "wish"),
    10: ("user request:\n\n", '\n\n"', "wish_quote"),
}


def answers_sql() -> str:
    """What is left of each answer."""
    quoted = lambda text: "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    cases = " ".join(f"WHEN {k} THEN {quoted(before)} || wish || {quoted(after)}" for k, (before, after, stays) in ANSWER_FORMS.items() if stays == "all")
    cases += " ".join(f" WHEN {k} THEN wish || {quoted(after)}" for k, (before, after, stays) in ANSWER_FORMS.items() if stays == "wish_quote")
    return f"SELECT p_partkey, CASE p_partkey % {len(ANSWER_FORMS)} {cases} ELSE wish END AS answer FROM (SELECT p_partkey, 'Write ' || p_name AS wish FROM part)"


#: Files that try the chunker's edges, ``{p}`` a number, each with its chunks.
ODD_FILES = (
    ("def a_{p}():\n    return {p}\n\nLIMIT_{p} = some_function(1, 2, 3, 4)\n", ["def a_{p}():\n    return {p}"]),
    ("import os\n\nclass K_{p}: pass\n", ["import os\n\nclass K_{p}: pass"]),
    ("@wrap\ndef d_{p}():\n    return {p}\n", ["@wrap", "@wrap\ndef d_{p}():\n    return {p}"]),
    ("async def s_{p}():\n    return 1\n", ["async def s_{p}():\n    return 1"]),
    ("#!/bin/run {p}\nx = 1\n", ["#!/bin/run {p}\nx = 1"]),
    ("def a():\n    return 1\ntry:\n    go({p})\nfinally:\n    end()\n", ["def a():\n    return 1", "try:\n    go({p})\nfinally:\n    end()"]),
    ("def b_{p}():\n    return 1\ntry_{p}()\n", ["def b_{p}():\n    return 1"]),
    ("class C_{p}(Base):\n    x = 1\n\n    def m(self):\n        return {p}\n\n    limit = {p}\n", ["class C_{p}(Base):", "def m(self):\n    return {p}"]),
    ("# note {p}\n# more\n# and more\nimport os\nvalue = compute(os, 1, 2, 3, 4, 5)\n", ["# note {p}\n# more\n# and more", "import os\nvalue = compute(os, 1, 2, 3, 4, 5)"]),
    ("def broken_{p}(\n", []),
)


def odd_files(part: DataFrame) -> DataFrame:
    """(doc_id, content)"""
    p = F.col("p_partkey")
    text = F.get(F.array(*(F.lit(t) for t, _ in ODD_FILES)), (p % len(ODD_FILES)).cast("int"))
    return part.select(p.alias("doc_id"), F.replace(text, F.lit("{p}"), p.cast("string")).alias("content"))


def odd_chunks_sql() -> str:
    quoted = lambda text: "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    rows = ", ".join(f"({k}, {i}, {quoted(c)})" for k, (_, cs) in enumerate(ODD_FILES) for i, c in enumerate(cs))
    return f"SELECT p_partkey AS doc_id, i::INT AS idx, replace(c, '{{p}}', p_partkey::VARCHAR) AS chunk FROM part JOIN (VALUES {rows}) t(k, i, c) ON p_partkey % {len(ODD_FILES)} = k"
