"""Fill-in-the-middle builders: statement triples, function-level triples, import moving and the chat form.

Defined results: a text that doesn't parse gives one triple with empty context (drop it with ``drop_unparsed``); null texts give
no triple; empty contexts are dropped where a builder asks for complete ones; equal chunks of a file share a position.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import pyast, textfn
from corpusmill.functions.textfn import END_OF_TURN, FIM_BEGIN, FIM_END, FIM_HOLE
from corpusmill.runtime import map_columns

SUFFIX_LINES = 3
CHUNK_LINES = 30
CHUNKS_PER_FILE = 5
CONTEXT_LINES = 3
# Fixed value: a line that opens a definition; its colon has to be on the same line; ``async def`` doesn't count.
DEFINITION = re.compile(r"^\s*(?:def|class)\s+\w+\s*\(?.*\)?:")


def statement_triples(df: DataFrame, key: str, content: str = "content", suffix_lines: int = SUFFIX_LINES, drop_unparsed: bool = False) -> DataFrame:
    """(key, idx, prefix_code, target_code, suffix_code): each top-level statement between its neighbours.

    The first statement's prefix is everything above it; a suffix is the first lines of the next statement. Only triples with a
    non-blank prefix and suffix stay, besides those of unparsable texts.
    """
    lines = textfn.py_splitlines("__text")
    rows = df.where(F.col(content).isNotNull()).select(F.col(key), F.col(content).alias("__text"))
    rows = rows.withColumn("__spans", pyast.statement_spans(F.col("__text"))).withColumn("__lines", lines)
    text_of = lambda s: F.array_join(F.slice("__lines", s["first"], s["last"] - s["first"] + 1), "\n")
    parts = rows.withColumn("__parts", F.transform("__spans", text_of))
    triple = F.transform(
        F.col("__parts"),
        lambda part, i: F.struct(
            i.alias("idx"),
            F.when(i == 0, F.array_join(F.slice("__lines", 1, F.get("__spans", F.lit(0))["first"] - 1), "\n")).otherwise(F.get("__parts", i - 1)).alias("prefix_code"),
            part.alias("target_code"),
            F.coalesce(F.array_join(F.slice(F.split(F.get("__parts", i + 1), "\n", -1), 1, suffix_lines), "\n"), F.lit("")).alias("suffix_code"),
        ),
    )
    whole = F.array(F.struct(F.lit(0).alias("idx"), F.lit("").alias("prefix_code"), F.col("__text").alias("target_code"), F.lit("").alias("suffix_code")))
    empty = F.slice(whole, 1, 0)
    out = parts.select(key, F.explode(F.when(F.col("__spans").isNull(), empty if drop_unparsed else whole).otherwise(F.when(F.size("__spans") > 0, triple).otherwise(empty))).alias("t"), F.col("__spans").isNull().alias("__whole"))
    complete = ~textfn.is_blank("t.prefix_code") & ~textfn.is_blank("t.suffix_code")
    return out.where(F.col("__whole") | complete).select(key, "t.idx", "t.prefix_code", "t.target_code", "t.suffix_code")


def definition_chunks(text: str, chunk_lines: int = CHUNK_LINES) -> list[str]:
    """Stripped chunks of a text: what stands before the first definition, then each region in pieces of ``chunk_lines`` lines.

    Without a definition the whole text is the only chunk.
    """
    lines = text.split("\n")
    starts = [i for i, x in enumerate(lines) if DEFINITION.match(x)]
    if not starts:
        return [text]
    regions = [(0, starts[0], len(lines))] + [(a, b, chunk_lines) for a, b in zip(starts, [*starts[1:], len(lines)])]
    cut = ["\n".join(lines[at : min(at + step, b)]).strip() for a, b, step in regions for at in range(a, b, step)]
    return [c for c in cut if c]


def located(text: str, chunks: list[str]) -> list[tuple[int, int, str]]:
    """(first line, number of lines, chunk) of each chunk that is found as whole lines, from the place of the chunk before it on.

    Stripping costs an indented chunk its first indent, so it isn't found and is left out.
    """
    framed = f"\n{text}\n"
    found, at, line = [], 0, 0
    for c in chunks:
        hit = framed.find(f"\n{c}\n", at)
        if hit >= 0:
            line += framed.count("\n", at, hit)
            at = hit
            found.append((line, c.count("\n") + 1, c))
    return found


def sampled(chunks: list[str], key: object, seed: int, keep: int) -> list[str]:
    """At most ``keep`` chunks of a file, drawn by a seeded hash of key and place and put back in their order."""
    if len(chunks) <= keep:
        return chunks
    drawn = sorted(range(len(chunks)), key=lambda i: (hashlib.md5(f"{seed}|{key}|{i}".encode()).hexdigest(), i))[:keep]
    return [chunks[i] for i in sorted(drawn)]


def function_triples(
    df: DataFrame, key: str, content: str = "content", seed: int = 42, chunk_lines: int = CHUNK_LINES, keep: int = CHUNKS_PER_FILE, context: int = CONTEXT_LINES, unescape: bool = True
) -> DataFrame:
    """(key, idx, prefix_code, target_code, suffix_code): definition-level chunks found again in their file, with their context.

    Triples need ``context`` lines on either side. Map-only, one pass per file.
    """

    def batch(keys, texts):
        out = {"k": [], "idx": [], "prefix_code": [], "target_code": [], "suffix_code": []}
        for k, t in zip(keys, texts):
            lines = t.split("\n")
            for i, (at, n, chunk) in enumerate(located(t, sampled(definition_chunks(t, chunk_lines), k, seed, keep))):
                if at >= context and len(lines) - at - n >= context:
                    for name, v in zip(out, (k, i, "\n".join(lines[:at]).strip(), chunk, "\n".join(lines[at + n :]).strip())):
                        out[name].append(v)
        return out

    text = textfn.unescape_slashes(content) if unescape else F.col(content)
    rows = df.where(F.col(content).isNotNull()).select(key, text.alias("__text")).where(F.col("__text") != "")
    kind = df.schema[key].dataType.simpleString()
    out = map_columns(rows, [key, "__text"], batch, f"k {kind}, idx int, prefix_code string, target_code string, suffix_code string")
    return out.withColumnRenamed("k", key)


def move_imports(df: DataFrame) -> DataFrame:
    """The last one (of exactly three) or two (of more) import lines of a prefix become the head of the target.

    Rows with fewer import lines or a null prefix stay as they are; null target and suffix count as empty once lines move.
    """
    is_import = lambda x: textfn.py_strip(x).rlike("^(?:import|from) ")
    marked = df.withColumn("__lines", textfn.lines_keeping_ends("prefix_code"))
    marked = marked.withColumn("__places", F.filter(F.transform("__lines", lambda x, i: F.when(is_import(x), i)), lambda i: i.isNotNull()))
    count = F.size("__places")
    moved = F.when(count == 3, F.array(F.get("__places", F.lit(2)))).otherwise(F.array(F.get("__places", count - 2), F.get("__places", count - 1)))
    marked = marked.withColumn("__moved", F.when(F.col("prefix_code").isNotNull() & (count >= 3), moved))
    stays = F.array_join(F.filter("__lines", lambda _, i: ~F.array_contains("__moved", i)), "")
    goes = F.array_join(F.transform("__moved", lambda i: F.get("__lines", i)), "")
    some = F.col("__moved").isNotNull()
    return marked.withColumns(
        {
            "prefix_code": F.when(some, stays).otherwise(F.col("prefix_code")),
            "target_code": F.when(some, F.concat(goes, F.coalesce("target_code", F.lit("")))).otherwise(F.col("target_code")),
        }
    ).select(*df.columns)


def chat_form(df: DataFrame) -> DataFrame:
    """(messages): a triple as a user request with a gap and an assistant turn with the marked triple. Rows with a null part are
    left out, as in a strict reader."""
    p, t, s = F.col("prefix_code"), F.col("target_code"), F.col("suffix_code")
    # The wording of the two turns.
    ask = F.concat(F.lit("Please complete the blank part of the following Python code:\n\n```python\n"), p, F.lit("# (Complete the code here)\n"), s, F.lit("```\n\n"))
    marked = F.concat(F.lit(FIM_BEGIN), p, F.lit(FIM_HOLE), s, F.lit(FIM_END), t, F.lit(END_OF_TURN))
    answer = F.concat(F.lit("Yes, I have completed the code as requested. Here is the completed code:\n\n```python\n"), marked, F.lit("\n```"))
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    whole = p.isNotNull() & t.isNotNull() & s.isNotNull()
    return df.where(whole).withColumn("messages", F.array(turn("user", ask), turn("assistant", answer)))
