"""Problem 5: natural language in comments and string literals of Python files.

Spans are extracted from files that parse, deduplicated by a 128-bit hash, classified once per distinct span, and the labels are
joined back to weight each file's shares. Only distinct texts travel to the classifier; a file's own rows carry hashes.

Defined results: null, empty, blank and unparsable files and files without sentences give no row; a file delivered twice gives
rows under both ids; shares are characters of the spans' sentences over the characters of the file.
"""

from __future__ import annotations

import hashlib
import io
import re
import tokenize

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.language import HAN, HANGUL, KANA, WORD, language
from corpusmill.llm.syntax import parses_python
from corpusmill.operators.joins import skew_safe_join
from corpusmill.runtime import map_columns, materialize

TOKEN = re.compile(
    r"#[^\n]*|([A-Za-z]{0,2})('''(?:[^\\']|\\.|'(?!''))*'''|\"\"\"(?:[^\\\"]|\\.|\"(?!\"\"))*\"\"\"|'(?:[^'\\\n]|\\.)*'|\"(?:[^\"\\\n]|\\.)*\")",
    re.S,
)
LITERAL = re.compile(r"([A-Za-z]{0,2})(.*)", re.S)
CODED = re.compile(r"\\u([0-9a-fA-F]{4})|\\U([0-9a-fA-F]{8})|\\x([0-9a-fA-F]{2})")
SQL = re.compile(r"^\s*(?:SELECT\b.*\bFROM\b|INSERT\s+INTO\b|UPDATE\b.*\bSET\b|DELETE\s+FROM\b|CREATE\s+(?:TABLE|INDEX|VIEW)\b|ALTER\s+TABLE\b|DROP\s+TABLE\b|WITH\b.*\bAS\s*\()", re.S | re.I)
CODE_LINE = re.compile(r"^(?:[\w.\[\]\"', ]+\s*[-+*/|&]?=[^=]|(?:def|class|import|from|return|raise|assert|for|while|if|elif|else|with|try|except|async|await|del|print|lambda|yield)\b.*[:()=\]]\s*$|@\w|[\w.]+\(.*\)\s*[:;]?$|[\[{(<].*[\]})>]\s*,?$|>>>|\$ |:\w+ )")
ASSIGNMENT = re.compile(r"^\s*(?:[\w.\[\]\"']+(?:\s*,\s*[\w.\[\]]+)*\s*[-+*/|&]?=\s*[^=\s]\S*(?:\s*[-+*/%|&<>]+\s*\S+)*|[\w.]+\([^()]*\))\s*$")
ENDERS = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])|\n\s*\n|\n(?=\s*(?::\w+|@\w+|[-*•]\s|\d+[.)]\s|Args?:|Returns?:|Raises:))")
LABEL = re.compile(r"^\s*(?::\w+(?:\s+[\w.\[\], *]+)?:|@\w+(?:\s+\w+)?|\w+\s*\([\w\[\], ]+\):|(?:Args?|Returns?|Raises|Yields|Note|Example)s?:)\s*")
PLAIN = re.compile(r"[(\"'`«¿¡]*[^\W\d_]+(?:['’-][^\W\d_]+)*[)\"'`».,;:!?…]*")
EAST = re.compile(r"[ぁ-鿿]")


def _exact_tokens(source: str):
    """(start, end, literal or None for a comment) by the standard tokenizer, for f-strings that hold quotes of their own kind."""
    starts = [0]
    for x in source.splitlines(keepends=True):
        starts.append(starts[-1] + len(x))
    opened: list[tuple[int, str]] = []
    text = ""
    for t in tokenize.generate_tokens(io.StringIO(source).readline):
        a, b = starts[t.start[0] - 1] + t.start[1], starts[t.end[0] - 1] + t.end[1]
        if t.type == tokenize.COMMENT:
            yield a, b, None
        elif t.type == tokenize.FSTRING_START:
            opened.append((a, t.string))
            text = text if len(opened) > 1 else ""
        elif t.type == tokenize.FSTRING_END:
            begin, _ = opened.pop()
            if not opened:
                yield begin, b, "r'" + text + "'"
        elif t.type == tokenize.FSTRING_MIDDLE and len(opened) == 1:
            text += t.string
        elif opened and t.string == "{" and len(opened) == 1:
            text += " x "
        elif t.type == tokenize.STRING and not opened:
            yield a, b, t.string


def _tokens(source: str) -> list[tuple[int, int, str | None]]:
    """(start, end, literal or None for a comment) in order."""
    out = []
    for m in TOKEN.finditer(source):
        if m[2] is None:
            out.append((m.start(), m.end(), None))
            continue
        if "f" in m[1].lower() and m[2].count("{") != m[2].count("}"):
            try:
                return list(_exact_tokens(source))
            except (tokenize.TokenError, SyntaxError, IndexError):
                return []
        out.append((m.start(), m.end(), m[0]))
    return out


def _body(literal: str) -> str | None:
    """What a string literal says; None for bytes."""
    prefix, quoted = LITERAL.match(literal).groups()
    prefix = prefix.lower()
    if "b" in prefix:
        return None
    body = quoted[3:-3] if quoted[:3] in ("'''", '"""') and len(quoted) >= 6 else quoted[1:-1]
    if "f" in prefix:
        body = re.sub(r"\{[^{}]*\}", " x ", body)
    if "\\" in body and "r" not in prefix:
        if CODED.search(body):
            body = CODED.sub(lambda m: chr(int(m[1] or m[2] or m[3], 16)) if int(m[1] or m[2] or m[3], 16) < 0x110000 else " ", body)
        body = re.sub(r"\\([nrt])", " ", body.replace("\\'", "'").replace('\\"', '"').replace("\\\n", ""))
    return body


def spans(source: str) -> list[str]:
    """Comment blocks and string literals that may hold a sentence; literals side by side are one."""
    out: list[str] = []
    block: list[str] = []
    last = -2
    line = at = 0
    string_end = -1
    for start, end, literal in _tokens(source):
        if literal is None:
            line += source.count("\n", at, start)
            at = start
            own = not source[source.rfind("\n", 0, start) + 1 : start].strip()
            if block and not (own and line == last + 1):
                out.append("\n".join(block))
                block = []
            block.append(source[start:end].lstrip("#! ").rstrip())
            last = line if own else -2
            if not own:
                out.append("\n".join(block))
                block = []
        elif (body := _body(literal)) is not None:
            if block:
                out.append("\n".join(block))
                block, last = [], -2
            if string_end >= 0 and literal[-3:] not in ('"""', "'''") and start - string_end < 400 and not source[string_end:start].strip():
                out[-1] += body if out[-1][-1:].isspace() or body[:1].isspace() else " " + body
            else:
                out.append(body)
            string_end = end
            continue
        string_end = -1
    if block:
        out.append("\n".join(block))
    return [s for s in out if len(s) >= 10 and (len(s.split(None, 5)) >= 5 or EAST.search(s))]


def _by_language(part: str) -> list[str]:
    """Lines without a full stop are one sentence that goes on, unless their languages differ: then each run of one language is one."""
    runs: list[tuple[str | None, list[str]]] = []
    for line in part.split("\n"):
        long = len(line.split(None, 5)) >= 5 or len(EAST.findall(line)) >= 10
        lang = language(line) if long else None
        if runs and (lang is None or runs[-1][0] is None or lang == runs[-1][0]):
            runs[-1] = (runs[-1][0] or lang, [*runs[-1][1], line])
        else:
            runs.append((lang, [line]))
    return ["\n".join(lines) for _, lines in runs]


def sentences(span: str) -> dict[str, int]:
    """Characters of sentences by language: five words at least, in ja and zh ten characters."""
    found: dict[str, int] = {}
    if SQL.match(span) and not re.search(r"[.!?]\s+[A-Z]", span):
        return found
    if "\n" in span and ("=" in span or "(" in span):  # commented-out code between lines of prose
        span = "\n".join("" if ASSIGNMENT.match(x) else x for x in span.split("\n"))
    parts = ENDERS.split(span)
    if "\n" in span:
        parts = [p for part in parts for p in (_by_language(part) if "\n" in part else (part,))]
    for part in parts:
        s = LABEL.sub("", " ".join(x.strip().lstrip("#*>|/ ").strip() for x in part.split("\n")) if "\n" in part else part.strip().lstrip("#*>|/ ")).strip()
        if len(s) < 10:
            continue
        eastern = not s.isascii() and max(s) >= "\u1100"
        east = len(HAN.findall(s)) + len(KANA.findall(s)) if eastern else 0
        words = [w for w in s.split() if w.isalpha() or WORD.search(w)]
        if east < 10 and len(words) < 5:
            continue
        hangul = sum(1 for w in words if HANGUL.search(w)) if eastern else 0
        if east < 10 and not hangul and CODE_LINE.match(s) or SQL.match(s):
            continue
        lang = language(s)
        if lang is None or (lang in ("ja", "zh") and east < 10) or (lang == "ko" and (len(words) < 5 or hangul < 3)):
            continue
        if lang not in ("ja", "zh", "ko"):
            plain = sum(1 for w in words if w.isalpha() or PLAIN.fullmatch(w))
            if len(words) < 5 or plain < 4 or plain * 2 < len(words):
                continue
        found[lang] = found.get(lang, 0) + len(s)
    return found


def extract(docs: DataFrame) -> DataFrame:
    """(file_id, h, n_file, text): a row per span of each .py file that parses; text only where the span is new to its batch."""

    def batch(ids, paths, texts):
        out = {"file_id": [], "h": [], "n_file": [], "text": []}
        seen: set[bytes] = set()
        for i, path, t in zip(ids, paths, texts):
            if not t or not path or path.rpartition(".")[2] != "py":
                continue
            found = spans(t)
            if not found or not parses_python(t):
                continue
            for s in found:
                h = hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                out["file_id"].append(i)
                out["h"].append(h)
                out["n_file"].append(len(t))
                out["text"].append(None if h in seen else s)
                seen.add(h)
        return out

    src = docs.where(F.col("file_path").endswith(".py") & F.col("content").isNotNull())
    return map_columns(src, ["file_id", "file_path", "content"], batch, "file_id bigint, h binary, n_file int, text string")


def classify(spans_df: DataFrame) -> DataFrame:
    """(h, nl_lang, n_chars): each distinct span classified once. The spans' hash spreads rows evenly, copies were dropped per batch."""

    def batch(hs, texts):
        out = {"h": [], "nl_lang": [], "n_chars": []}
        for h, t in dict(zip(hs, texts)).items():
            for lang, n in sentences(t).items():
                out["h"].append(h)
                out["nl_lang"].append(lang)
                out["n_chars"].append(n)
        return out

    distinct = spans_df.where(F.col("text").isNotNull()).select("h", "text").dropDuplicates(["h"])
    return map_columns(distinct, ["h", "text"], batch, "h binary, nl_lang string, n_chars int")


def file_languages(docs: DataFrame) -> DataFrame:
    """(file_id, nl_lang, n_spans, n_chars, share) of each file and language."""
    rows = materialize(extract(docs), "spans")
    labels = materialize(classify(rows), "labels")  # the join reads them twice
    joined = skew_safe_join(rows.select("file_id", "h", "n_file"), labels, "h")
    return joined.groupBy("file_id", "nl_lang").agg(
        F.count("*").alias("n_spans"), F.sum("n_chars").alias("n_chars"), (F.sum("n_chars") / F.max("n_file")).alias("share")
    )


def p5_found(docs: DataFrame) -> DataFrame:
    return file_languages(docs).select("file_id", "nl_lang")
