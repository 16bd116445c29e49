"""Problem 7: functions and methods paired with their documentation.

Files are parsed into syntax trees; functions and methods (nested and async too) are visited in source order; documentation is
the docstring or, only without one, the comment lines directly above the function and its decorators.

Defined results: null, empty, blank and unparsable files give no pair; functions without documentation or with trivial one give
none; redelivered files give pairs under each file_id; ``has_docstring`` of the structure table is not consulted.
"""

from __future__ import annotations

import ast
import re
import textwrap
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.language import HAN, KANA
from corpusmill.runtime import map_columns

# Words that add nothing to a function's name.
FILLERS = frozenset("a an the of for to and".split())
FIELD = re.compile(
    r"^\s*(?::\w+[^:]*:|@\w+(?:\s+\w+)?:?|[-*]?\s*\*{0,2}\w+\s*(?:\([^)]*\))?\s*:)\s*(\S*(?:\s+\S+)*)\s*$"
)
SECTION = re.compile(r"^\s*(?:args?|arguments|params?|parameters|returns?|raises|yields?|notes?|examples?|attributes)\s*:?\s*$|^\s*-{3,}\s*$", re.I)


def words(text: str) -> list[str]:
    return [w for w in text.split() if re.search(r"[^\W_]", w)]


def trivial(doc: str, name: str) -> bool:
    """Too short, a to-do opener, bare field labels, or nothing but the function's name."""
    text = doc.strip()
    if re.match(r"\W*(?:TODO|FIXME|XXX)\b", text, re.I):
        return True
    kept = []
    fields_only = True
    for line in text.split("\n"):
        if not line.strip() or SECTION.match(line):
            continue
        field = FIELD.match(line)
        if field and len(words(field[1])) <= 1 and not (len(HAN.findall(field[1])) + len(KANA.findall(field[1])) >= 10):
            continue
        fields_only = False
        kept.append(line)
    if fields_only:
        return True
    east = len(HAN.findall(text)) + len(KANA.findall(text))
    if len(words(text)) < 5 and east < 10:
        return True
    parts = {p.lower() for p in re.split(r"_+|(?<=[a-z])(?=[A-Z])", name) if p}
    said = {w.lower() for w in re.findall(r"[^\W_]+", text)}
    return said - FILLERS <= parts


def is_code(lines: list[str]) -> bool:
    """Whether comment lines are commented-out code and nothing else."""
    body = textwrap.dedent("\n".join(lines)).strip("\n")
    if not body.strip():
        return False
    for candidate in (body, body + "\n    pass" if body.rstrip().endswith(":") else body):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            try:
                tree = ast.parse(candidate)
            except (SyntaxError, ValueError, RecursionError, MemoryError):
                continue
        return not all(isinstance(n, ast.Expr) and isinstance(n.value, (ast.Name, ast.Constant)) for n in tree.body)
    return False


def comment_above(lines: list[str], first: int) -> str | None:
    """The comment lines that end directly above line ``first`` (counted from 1), or None."""
    block: list[str] = []
    at = first - 2
    while at >= 0 and (s := lines[at].strip()).startswith("#"):
        if s.startswith("#!") and at == 0:
            break
        block.append(re.sub(r"^#+:?\s?", "", s))
        at -= 1
    block.reverse()
    if not block or is_code(block):
        return None
    prose = [x for x in block if not is_code([x]) or not re.search(r"[=()\[\]]", x)]
    return "\n".join(prose)


def visit(body: list[ast.stmt], owner: str, out: list[tuple[ast.AST, str]]) -> None:
    for node in body:
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
            out.append((node, owner + node.name))
            visit(node.body, f"{owner}{node.name}.", out)
        elif isinstance(node, ast.ClassDef):
            visit(node.body, f"{owner}{node.name}.", out)
        else:
            for field in ("body", "orelse", "finalbody"):
                inner = getattr(node, field, None)
                if inner and isinstance(inner, list) and isinstance(inner[0], ast.stmt):
                    visit(inner, owner, out)
            for part in (*getattr(node, "handlers", ()), *getattr(node, "cases", ())):
                visit(part.body, owner, out)


def pairs(source: str | None) -> list[tuple[str, int, str, str]]:
    """(qualified name, line of def, code with decorators, description) of each documented function."""
    if not source or "def" not in source:
        return []
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        try:
            tree = compile(source, "<file>", "exec", flags=ast.PyCF_ONLY_AST, dont_inherit=True)
        except (SyntaxError, ValueError, RecursionError, MemoryError, OverflowError):
            return []
    nodes: list[tuple[ast.AST, str]] = []
    visit(tree.body, "", nodes)
    if not nodes:
        return []
    lines = re.split(r"\r\n|\r|\n", source)
    out = []
    for node, qualified in nodes:
        first = min([node.lineno, *(d.lineno for d in node.decorator_list)])
        head = node.body[0]
        if isinstance(head, ast.Expr) and isinstance(head.value, ast.Constant) and isinstance(head.value.value, str):
            doc = head.value.value
        else:
            doc = comment_above(lines, first)
        if doc is not None and not trivial(doc, node.name):
            out.append((qualified, node.lineno, "\n".join(lines[first - 1 : node.end_lineno]), "\n".join(x.strip() for x in doc.strip().split("\n"))))
    return out


def code_doc_pairs(docs: DataFrame) -> DataFrame:
    """(file_id, name, def_line, code, description): one row per documented function; map-only."""

    def batch(ids, texts):
        out = {"file_id": [], "name": [], "def_line": [], "code": [], "description": []}
        for i, t in zip(ids, texts):
            for row in pairs(t):
                for k, v in zip(out, (i, *row)):
                    out[k].append(v)
        return out

    src = docs.where(F.col("file_path").endswith(".py") & F.col("content").contains("def"))
    return map_columns(src, ["file_id", "content"], batch, "file_id bigint, name string, def_line int, code string, description string")


def p7_found(docs: DataFrame) -> DataFrame:
    return code_doc_pairs(docs).select("file_id", "def_line")
