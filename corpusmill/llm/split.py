"""Problem 4: splitting oversized items at natural boundaries.

A text is parsed into a structure tree: headings with their paragraphs, lists and fenced blocks, statements by their nesting, values
by their brackets, elements by their tags, sections. Where a node without inner structure is still too large, its blank-line paragraphs,
lines, sentences, words and in the end characters are its subtrees. From the leaves up sibling subtrees are merged as long as they stay
under the limit; only oversized nodes are opened. Each piece after the first begins with the last ``overlap`` characters of the one
before, and no piece is longer than the limit.

Defined results: null, empty and texts within the limit give no piece (they need no split); a text without any boundary is cut
between characters; text that breaks its format's nesting keeps the nesting that is left; pieces without their overlap join to the whole
text again.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import map_columns

#: Where a subtree begins, and how deep it is nested.
Mark = tuple[int, int]
#: Nesting below this counts as equally deep.
DEEPEST = 100
LINE = re.compile(r"[^\n]*(?:\n|\Z)")
HEADING = re.compile(r"(#{1,6})[ \t]")
LIST_ITEM = re.compile(r"([ \t]*)(?:[-*+]|\d{1,9}[.)])[ \t]")
CODE_SCAN = re.compile(r"#[^\n]*|'''(?:[^\\]|\\.)*?'''|\"\"\"(?:[^\\]|\\.)*?\"\"\"|'(?:[^'\\\n]|\\.)*'|\"(?:[^\"\\\n]|\\.)*\"|[()\[\]{}]|\\\n|\n", re.S)
GOES_ON = re.compile(r"(?:else|elif|except|finally|case)\b|[)\]}]")
JSON_SCAN = re.compile(r"\"(?:[^\"\\]|\\.)*\"|[{\[]|[}\]]|,", re.S)
REST_OF_LINE = re.compile(r"[ \t]*\r?\n?")
XML_SCAN = re.compile(r"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<![^<>]*>|</[A-Za-z_][^<>]*>|<[A-Za-z_](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>", re.S)
SECTION = re.compile(r"^[ \t]*\[+([^\]\n]*)\]", re.M)


def _markdown(text: str) -> list[Mark]:
    """Headings nest by their level; paragraphs, fenced blocks and list items (by indentation) lie below them."""
    marks, fence, fresh = [], None, True
    for m in LINE.finditer(text):
        line, bare = m[0], m[0].strip()
        if fence:
            fence = None if bare.startswith(fence) else fence
        elif bare.startswith(("```", "~~~")):
            marks.append((m.start(), 8))
            fence = bare[:3]
        elif h := HEADING.match(line):
            marks.append((m.start(), len(h[1])))
        elif i := LIST_ITEM.match(line):
            marks.append((m.start(), 9 + len(i[1].expandtabs(4))))
        elif fresh and bare:
            marks.append((m.start(), 8))
        fresh = not bare and not fence
    return marks


def _statements(text: str) -> list[Mark]:
    """Statements nest by indentation; lines inside strings and brackets belong to their statement, decorators and comments to what they
    stand above, ``else`` and its like to what they go on."""
    marks: list[Mark] = []
    open_brackets, start, joined = 0, 0, False

    def line(end: int) -> None:
        nonlocal start, joined
        raw = text[start:end]
        bare = raw.strip()
        if bare:
            depth = len(raw.expandtabs(8)) - len(raw.expandtabs(8).lstrip())
            if not (joined and marks and marks[-1][1] == depth):
                marks.append((start, depth + 1 if GOES_ON.match(bare) else depth))
            joined = bare[0] in "@#"
        start = end

    for m in CODE_SCAN.finditer(text):
        t = m[0]
        if t in "([{":
            open_brackets += 1
        elif t in ")]}":
            open_brackets = max(0, open_brackets - 1)
        elif t == "\n" and not open_brackets:
            line(m.end())
        elif t == "\n" and text[m.end() : m.end() + 1].strip() and (text.startswith(("def ", "class ", "@"), m.end())):
            open_brackets = 0  # a bracket that is never closed ends with the next definition
            line(m.end())
    line(len(text))
    return marks


def _indented(text: str) -> list[Mark]:
    return [(m.start(), len(x) - len(x.lstrip(" -"))) for m in LINE.finditer(text) if (x := m[0].rstrip()) and x.lstrip()[:1] not in "]}"]


def _values(text: str) -> list[Mark]:
    """Fields and elements nest by their brackets; each begins behind the comma or bracket in front of it."""
    marks, depth = [], 0
    for m in JSON_SCAN.finditer(text):
        if m[0] in "{[":
            depth += 1
        elif m[0] in "}]":
            depth = max(0, depth - 1)
        if m[0] in "{[,":
            marks.append((REST_OF_LINE.match(text, m.end()).end(), depth))
    return marks


def _elements(text: str) -> list[Mark]:
    marks, depth = [], 0
    for m in XML_SCAN.finditer(text):
        if m[0].startswith("</"):
            depth = max(0, depth - 1)
            continue
        at = text.rfind("\n", 0, m.start()) + 1
        marks.append((at if not text[at : m.start()].strip() else m.start(), depth))
        if m[0][1] not in "!?" and not m[0].endswith("/>"):
            depth += 1
    return marks


def _sections(text: str) -> list[Mark]:
    """Sections nest by the dots of their names."""
    return [(m.start(), m[1].count(".")) for m in SECTION.finditer(text)]


PARSERS = {"py": _statements, "md": _markdown, "json": _values, "xml": _elements, "toml": _sections, "ini": _sections, "yaml": _indented}
# Boundaries inside a node without inner structure, from coarse to fine: each pattern matches the empty place before a new subtree.
FINER = (re.compile(r"(?<=\n\n)(?=[^\n\r])|(?<=\r\n\r\n)(?=[^\r\n])"), re.compile(r"(?<=\n)"), re.compile(r"(?<=[.!?。;,])(?=\s)|(?<=[。！？])"), re.compile(r"(?<=\s)(?=\S)"))


def tree_marks(text: str, kind: str | None) -> list[Mark]:
    """Beginnings of the subtrees of a text in order, each place once with its smallest depth."""
    least: dict[int, int] = {}
    for at, depth in PARSERS[kind](text) if kind in PARSERS else ():
        least[at] = min(depth, least.get(at, DEEPEST), DEEPEST)
    return sorted(least.items())


def merged(parts: list[tuple[int, int]], fits: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """Neighbours joined from the left as long as they fit."""
    out: list[tuple[int, int]] = []
    for a, b in parts:
        if out and fits(out[-1][0], b):
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def pieces(text: str | None, limit: int, overlap: int = 200, kind: str | None = None) -> list[tuple[int, int]]:
    """(start of new text, end) of each piece; a piece's text begins ``overlap`` characters before its start, the first one at 0."""
    if not text or len(text) <= limit:
        return []
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be smaller than the limit")
    marks = tree_marks(text, kind)
    places = [at for at, _ in marks]

    def room(start: int) -> int:
        return limit - overlap if start else limit

    def fits(start: int, end: int) -> bool:
        return end - start <= room(start)

    def packed(start: int, end: int, level: int) -> list[tuple[int, int]]:
        """A node's pieces: its children's, merged; a child is opened only if it is oversized itself. ``level`` of ``FINER`` is the
        coarsest that has not been tried on the node."""
        if fits(start, end):
            return [(start, end)]
        lo, hi = bisect_left(places, start + 1), bisect_left(places, end)
        if lo < hi:
            top = min(depth for _, depth in marks[lo:hi])
            cuts = [at for at, depth in marks[lo:hi] if depth == top]
        elif level < len(FINER):
            cuts = [m.start() for m in FINER[level].finditer(text, start, end) if start < m.start() < end]
            level += 1
        else:
            first = start + room(start)
            rest = range(first, end, limit - overlap)
            return [(start, first), *((a, min(a + limit - overlap, end)) for a in rest)]
        children = zip([start, *cuts], [*cuts, end])
        return merged([p for a, b in children for p in packed(a, b, level)], fits)

    return packed(0, len(text), 0)


def split(df: DataFrame, id_col: str, text_col: str, limit: int, overlap: int = 200, path_col: str | None = None) -> DataFrame:
    """(id, piece_no, n_pieces, start_char, text) of each item above the limit. Items within it never leave the JVM."""

    def batch(ids, kinds, texts):
        out = {"id": [], "piece_no": [], "n_pieces": [], "start_char": [], "text": []}
        for i, kind, t in zip(ids, kinds, texts):
            cut = pieces(t, limit, overlap, kind)
            for k, (a, b) in enumerate(cut):
                at = max(0, a - overlap) if k else 0
                for name, v in zip(out, (i, k, len(cut), at, t[at:b])):
                    out[name].append(v)
        return out

    kind = F.lower(F.substring_index(F.col(path_col), ".", -1)) if path_col else F.lit("py")
    src = df.where(F.length(text_col) > limit).select(F.col(id_col).alias("__id"), kind.alias("__kind"), F.col(text_col).alias("__text"))
    return map_columns(src, src.columns, batch, "id bigint, piece_no int, n_pieces int, start_char int, text string")


def p4_pieces(docs: DataFrame, triples: DataFrame, limit: int = 6000, target_limit: int = 2000, overlap: int = 200) -> DataFrame:
    files = split(docs, "file_id", "content", limit, overlap, "file_path").withColumn("tbl", F.lit("source_docs"))
    targets = split(triples, "triple_id", "target_code", target_limit, overlap).withColumn("tbl", F.lit("fim_triples"))
    return files.unionByName(targets).select("tbl", F.col("id").alias("rec_id"), "piece_no", "n_pieces", "start_char", "text")


def p4_found(docs: DataFrame, triples: DataFrame) -> DataFrame:
    return p4_pieces(docs, triples).where(F.col("piece_no") == 0).select("tbl", "rec_id")


def p4_rejoined(docs: DataFrame, triples: DataFrame, overlap: int = 200) -> DataFrame:
    """(tbl, rec_id, within, text_md5): whether all pieces of an item are within the limit, and the digest of its pieces put together again without what they repeat."""
    own = F.when(F.col("piece_no") == 0, F.col("text")).otherwise(F.expr(f"substring(text, {overlap} + 1)"))
    parts = p4_pieces(docs, triples, overlap=overlap).select("tbl", "rec_id", "piece_no", F.length("text").alias("n"), own.alias("own"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "own"))), lambda x: x["own"]), "")
    return parts.groupBy("tbl", "rec_id").agg((F.max("n") <= F.when(F.col("tbl") == "source_docs", 6000).otherwise(2000)).alias("within"), F.md5(whole).alias("text_md5"))
