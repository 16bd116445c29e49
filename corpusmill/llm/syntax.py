"""Problem 3: source files that do not parse.

The grammars are ranked by the tokens of a file that speak for each, and the file is parsed against all of them in that order. If its
claimed grammar isn't among those that accept it, the first accepting one shows a wrong extension, and none at all corruption
(truncation, merge conflict, damage).

Defined results: null, empty and blank contents and extensions without a checked grammar have verdict ``skipped`` and never count as
invalid; a file without an extension has language null; repeated rows are judged one by one; whole texts are parsed.
"""

from __future__ import annotations

import json
import re
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import map_columns

GRAMMARS = ("py", "json", "toml", "xml", "ini", "env", "yaml", "md")
CLAIMED = ("py", "json", "toml", "xml")


def parses_python(text: str) -> bool:
    import ast

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        try:
            compile(text, "<file>", "exec", flags=ast.PyCF_ONLY_AST, dont_inherit=True)
        except (SyntaxError, ValueError, RecursionError, MemoryError, OverflowError):
            return False
    return True


def _no_constant(name: str):
    raise ValueError(name)


_JSON = json.JSONDecoder(parse_int=len, parse_float=len, parse_constant=_no_constant)


def parses_json(text: str) -> bool:
    try:
        _JSON.decode(text)
    except (ValueError, RecursionError):
        return False
    return not text.startswith("﻿")


def parses_toml(text: str) -> bool:
    import tomllib

    try:
        tomllib.loads(text)
    except (tomllib.TOMLDecodeError, ValueError, RecursionError, TypeError, AttributeError):
        return False
    return True


def parses_xml(text: str) -> bool:
    from xml.parsers import expat

    parser = expat.ParserCreate("utf-8")
    try:
        parser.Parse(text.encode("utf-8"), True)
    except (expat.ExpatError, UnicodeEncodeError, ValueError):
        return False
    return True


INI_FIRST = re.compile(r"(?:[ \t]*(?:[#;][^\n]*)?\r?\n)*[ \t]*(\S)")


def parses_ini(text: str) -> bool:
    import configparser

    first = INI_FIRST.match(text)
    if not first or first[1] != "[":  # no section stands in front of the first value
        return False
    parser = configparser.RawConfigParser(allow_no_value=False, strict=False)
    try:
        parser.read_string(text)
    except (configparser.Error, ValueError, AttributeError):
        return False
    return bool(parser.sections())


def parses_env(text: str) -> bool:
    lines = [x for x in text.split("\n") if x.strip() and not x.lstrip().startswith("#")]
    return bool(lines) and all(re.match(r"\s*(?:export\s+)?[A-Za-z_][A-Za-z0-9_.]*=", x) for x in lines)


YAML_LINE = re.compile(r"\s*(?:#.*|---.*|\.\.\.|(?:-\s+)*(?:[\w./<>\"'-]+(?: [\w./-]+)*:(?:\s.*)?|-(?:\s.*)?))$")


def parses_yaml(text: str) -> bool:
    """Block mappings and sequences: every line is a key, an item, a comment, or belongs to a value that began on a line less indented."""
    if "\t" in text.split(":", 1)[0] or not re.search(r"^\s*(?:-\s+)?[\w./\"'-]+:(?:\s|$)", text, re.M):
        return False
    holder, held = -1, False
    for line in text.split("\n"):
        bare = line.strip()
        indent = len(line) - len(line.lstrip(" "))
        if not bare or held and indent > holder:
            continue
        held = False
        if not YAML_LINE.match(line.rstrip()) or re.search(r"\{\s*$|[;{]\s*$", bare):
            return False
        if re.search(r"(?::|-)\s*[|>][+-]?\d*$", bare):
            holder, held = indent, True
    return True


def parses_markdown(text: str) -> bool:
    """Prose with headings: every text is Markdown, so one must have a heading, all its fences closed, and no code outside them to count
    as that."""
    if re.search(r"^[ \t]*(?:def|class|import|from|return|async|@\w)\b|[={}();]\s*$", re.sub(r"^```.*?^```", "", text, flags=re.M | re.S), re.M):
        return False
    return bool(re.search(r"^#{1,6} \S", text, re.M)) and len(re.findall(r"^\s*```", text, re.M)) % 2 == 0 and bool(re.search(r"^[A-Z*`>-][^=;{}]*[.:]\s*$", text, re.M))


PARSERS = {"py": parses_python, "json": parses_json, "toml": parses_toml, "xml": parses_xml, "ini": parses_ini, "env": parses_env, "yaml": parses_yaml, "md": parses_markdown}
# Tokens that speak for a grammar, and how strongly.
SIGNS = {
    "py": (re.compile(r"^[ \t]*(?:def|class|async def|return|import|from|if|for|while|with|try|@\w+)\b|:[ \t]*$", re.M), 2.0),
    "json": (re.compile(r"\"[^\"\n]*\"\s*:|^\s*[\]}],?\s*$|\A\s*[\[{]", re.M), 2.0),
    "toml": (re.compile(r"^\s*(?:\[\[?[\w.\"-]+\]\]?\s*$|[\w.-]+\s*=\s*(?:[\"'\[{]|true|false|[-+]?\d))", re.M), 1.5),
    "xml": (re.compile(r"</?[A-Za-z][\w:.-]*(?:\s[^<>]*)?/?>|<\?xml"), 2.0),
    "ini": (re.compile(r"^\s*(?:\[[^\]\n]+\]\s*$|[\w.-]+\s*[:=]\s*\S)", re.M), 1.0),
    "env": (re.compile(r"^(?:export\s+)?[A-Z_][A-Z0-9_]*=", re.M), 1.8),
    "yaml": (re.compile(r"^\s*(?:- )?[\w-]+:(?:\s+[^\s({].*)?$", re.M), 1.2),
    "md": (re.compile(r"^(?:#{1,6} \S|[-*] \S|```)", re.M), 1.0),
}


def rank(text: str) -> list[str]:
    """All grammars, the one that most tokens speak for first; ties keep the order of ``GRAMMARS``."""
    score = {g: weight * sum(1 for _ in pattern.finditer(text)) for g, (pattern, weight) in SIGNS.items()}
    return sorted(GRAMMARS, key=lambda g: (-score[g], GRAMMARS.index(g)))


def judge(ext: str | None, text: str | None) -> tuple[str, str | None]:
    """(verdict, language that the content parses as): verdicts ``ok``, ``wrong_extension``, ``corrupt`` and ``skipped``."""
    if text is None or not text.strip() or ext not in CLAIMED:
        return "skipped", None
    accepting = [g for g in rank(text) if PARSERS[g](text)]
    if ext in accepting:
        return "ok", ext
    return ("wrong_extension", accepting[0]) if accepting else ("corrupt", None)


def check_files(df: DataFrame, path_col: str = "file_path", text_col: str = "content", keep: tuple[str, ...] = ("file_id", "repo")) -> DataFrame:
    """(keep..., lang, verdict, parsed_as) of each file; map-only, kept columns never pass through Python more than once."""
    kept = ", ".join(f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def batch(*columns):
        exts, texts, rest = columns[0], columns[1], columns[2:]
        judged = [judge(e, t) for e, t in zip(exts, texts)]
        return {"lang": exts, "verdict": [v for v, _ in judged], "parsed_as": [p for _, p in judged]} | {f"k{i}": c for i, c in enumerate(rest)}

    ext = F.when(F.col(path_col).contains("."), F.lower(F.substring_index(F.col(path_col), ".", -1)))
    src = df.select(ext.alias("__ext"), F.col(text_col).alias("__text"), *(F.col(c).alias(f"__{c}") for c in keep))
    out = map_columns(src, src.columns, batch, f"lang string, verdict string, parsed_as string, {kept}")
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "lang", "verdict", "parsed_as")


def p3_found(docs: DataFrame) -> DataFrame:
    return check_files(docs, keep=("file_id",)).where(F.col("verdict").isin("wrong_extension", "corrupt")).select("file_id")


def p3_rates(docs: DataFrame) -> DataFrame:
    """Files, invalid files and their share per repository and language. Rows combine before the shuffle, so a repository with a
    third of all files sends a handful of counters."""
    bad = F.col("verdict").isin("wrong_extension", "corrupt")
    return (
        check_files(docs)
        .where(F.col("verdict") != "skipped")
        .groupBy("repo", "lang")
        .agg(F.count("*").alias("n_files"), F.sum(bad.cast("long")).alias("n_invalid"), F.sum((F.col("verdict") == "wrong_extension").cast("long")).alias("n_wrong_extension"))
        .withColumn("invalid_rate", F.col("n_invalid") / F.col("n_files"))
    )
