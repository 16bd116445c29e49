"""Text functions as native column expressions, with the exact meaning of Python's string methods.

All of them keep null as null unless stated otherwise, work on whole texts and stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as ``str.isspace`` has it, and the line boundaries of ``str.splitlines``.
PY_SPACE = r"\s\x1c-\x1f"
PY_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
#: Fill-in-the-middle and end markers of the training format (the bars are U+FF5C, the words are apart by a space).
FIM_BEGIN, FIM_HOLE, FIM_END, END_OF_TURN = "<｜fim begin｜>", "<｜fim hole｜>", "<｜fim end｜>", "<|EOT|>"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: Spark's own ``trim`` only knows the plain space."""
    return F.regexp_replace(as_column(c), f"(?U)^[{PY_SPACE}]+|[{PY_SPACE}]+\\z", "")


def is_blank(c: Column | str) -> Column:
    """Empty or nothing but white space; null for null."""
    return ~as_column(c).rlike(f"(?U)[^{PY_SPACE}]")


def py_splitlines(c: Column | str) -> Column:
    """``str.splitlines()``: no empty element at the end, an empty array for empty text."""
    c = as_column(c)
    parts = F.split(c, PY_BREAK, -1)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(
        F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    )


def lines_keeping_ends(c: Column | str) -> Column:
    """``str.splitlines(keepends=True)`` for line feeds: pieces that join to the text again."""
    parts = F.split(as_column(c), "(?<=\\n)", -1)
    return F.filter(parts, lambda x: x != "")


def py_capitalize(c: Column | str) -> Column:
    """``str.capitalize()``: first character upper, the rest lower."""
    c = as_column(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def remove_comments(c: Column | str) -> Column:
    """Line comments, then triple-quoted blocks, deleted in this order; ``#`` inside a string counts as a comment. Null gives ''."""
    c = F.regexp_replace(as_column(c), "(?d)#.*", "")
    c = F.regexp_replace(c, '(?s)""".*?"""', "")
    return F.coalesce(F.regexp_replace(c, "(?s)'''.*?'''", ""), F.lit(""))


def special_char_ratio(c: Column | str) -> Column:
    """Share of characters other than ASCII letters, ASCII digits and white space; 1.0 for null and blank text."""
    c = as_column(c)
    count = F.length(F.regexp_replace(c, f"(?U)[{PY_SPACE}]|[a-zA-Z0-9]", ""))
    return F.when(F.coalesce(is_blank(c), F.lit(True)), F.lit(1.0)).otherwise(count / F.length(c))


def comment_line_ratio(lines: Column) -> Column:
    """Share of lines that open with ``#`` or a triple quote once stripped; 0.0 without lines."""
    opening = F.filter(lines, lambda x: x.rlike(f"(?U)^[{PY_SPACE}]*(?:#|\"\"\"|''')"))
    return F.when(F.size(lines) == 0, F.lit(0.0)).otherwise(F.size(opening) / F.size(lines))


def only_allowed_characters(c: Column | str) -> Column:
    """Whether every character is ASCII or U+FF5C; true for empty, false for null."""
    return F.coalesce(~as_column(c).rlike("[^\\x00-\\x7F\\x{FF5C}]"), F.lit(False))


def unescape_slashes(c: Column | str) -> Column:
    return F.replace(as_column(c), F.lit("\\/"), F.lit("/"))


def code_blocks(c: Column | str) -> Column:
    """Contents of plain or python fences; without any, the stripped text as the only block."""
    c = as_column(c)
    blocks = F.regexp_extract_all(c, F.lit("(?s)```(?:python)?\\n(.*?)```"), F.lit(1))
    return F.when(F.size(blocks) > 0, blocks).otherwise(F.array(py_strip(c)))


def normalize_spacing(c: Column | str) -> Column:
    """Stripped, with runs of line feeds cut to one blank line."""
    return F.regexp_replace(py_strip(c), "\\n{2,}", "\n\n")


def portable_draw(seed: int, bound: int, *parts: Column | str) -> Column:
    """A number from 0 to ``bound - 1`` that only depends on the seed and the row's own key, by MD5: the same in any SQL engine."""
    key = F.concat_ws("|", F.lit(str(seed)), *(as_column(p).cast("string") for p in parts))
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % bound).cast("int")
