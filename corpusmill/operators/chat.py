"""Operators on chat records and line files: merging, rendering, code blocks, spacing, numbering.

Defined results: null messages count as no messages; null contents stay null; unknown roles are kept; merging keeps the first row
by order key; rows without the wanted parts give no output row. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import textfn
from corpusmill.operators.quality import first_of_each
from corpusmill.runtime import materialize

TRIPLE = ("prefix_code", "target_code", "suffix_code")
RULE = "-" * 30


def numbered(df: DataFrame, order: str, name: str = "n") -> DataFrame:
    """Rows numbered from 1 in the order of ``order``: sorted by range, counted per partition, shifted by the counts before.

    No task sees more than its range; the driver holds one count per partition.
    """
    placed = df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__part", F.spark_partition_id()).withColumn("__place", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    placed = materialize(placed, "numbered")
    counts = sorted(placed.groupBy("__part").count().collect())
    before, shift = 0, []
    for p, n in counts:
        shift.append((p, before))
        before += n
    offsets = df.sparkSession.createDataFrame(shift or [(0, 0)], "__part int, __before long")
    return placed.join(F.broadcast(offsets), "__part").withColumn(name, (F.col("__before") + F.col("__place") + 1)).drop("__part", "__place", "__before")


def canonical_triple(df: DataFrame) -> DataFrame:
    """Exactly the three triple columns; a column that is missing counts as empty text, an explicit null stays null."""
    return df.select(*(F.col(c) if c in df.columns else F.lit("").alias(c) for c in TRIPLE))


def merge_unique(df: DataFrame, order: str) -> DataFrame:
    """The first row of each distinct triple, with its order key."""
    return first_of_each(df, list(TRIPLE), order).select(order, *TRIPLE)


def merge_all(*parts: DataFrame) -> DataFrame:
    """All rows of all parts."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dialogue_text(messages: Column) -> Column:
    """One dialogue without its heading: a block per turn, then a rule."""
    def block(m: Column) -> Column:
        label = (
            F.when(m["role"] == "user", F.lit("User"))
            .when(m["role"] == "assistant", F.lit("Assistant"))
            .otherwise(textfn.py_capitalize(F.coalesce(m["role"], F.lit("unknown_role"))))
        )
        return F.concat(label, F.lit(":\n"), F.coalesce(m["content"], F.lit("")), F.lit("\n\n"))

    return F.concat(F.array_join(F.transform(F.coalesce(messages, F.array()), block), ""), F.lit(RULE + "\n\n"))


def pretty_dialogues(df: DataFrame, order: str, messages: str = "messages") -> DataFrame:
    """(order, n, value): dialogues as text, numbered in order."""
    return numbered(df.select(order, messages), order).select(order, "n", F.concat(F.lit("--- Dialogue "), F.col("n").cast("string"), F.lit(" ---\n"), dialogue_text(F.col(messages))).alias("value"))


def assistant_code(df: DataFrame, key: str, messages: str = "messages") -> DataFrame:
    """(key, turn, block, code): code blocks of every assistant turn with content."""
    turns = df.where(F.col(messages).isNotNull()).select(key, F.posexplode(messages).alias("turn", "m"))
    turns = turns.where((F.col("m.role") == "assistant") & F.col("m.content").isNotNull())
    return turns.select(key, "turn", F.posexplode(textfn.code_blocks("m.content")).alias("block", "code"))


def normalized_spacing(df: DataFrame, messages: str = "messages") -> DataFrame:
    """The first assistant turn that has content is stripped and its blank lines are cut to one; all else stays."""
    m = F.col(messages)
    speaks = lambda x: (x["role"] == "assistant") & x["content"].isNotNull()
    first = F.get(F.filter(F.transform(m, lambda x, i: F.when(speaks(x), i)), lambda i: i.isNotNull()), F.lit(0))
    tidy = F.transform(m, lambda x, i: F.struct(x["role"].alias("role"), F.when(i == first, textfn.normalize_spacing(x["content"])).otherwise(x["content"]).alias("content")))
    return df.withColumn(messages, F.when(first.isNull(), m).otherwise(tidy))


def turns(df: DataFrame, key: str, messages: str = "messages") -> DataFrame:
    """(key, turn, role, content): one row per turn."""
    return df.where(F.col(messages).isNotNull()).select(key, F.posexplode(messages).alias("turn", "m")).select(key, "turn", "m.role", "m.content")


def regrouped(df: DataFrame, key: str) -> DataFrame:
    """The inverse of ``turns``: (key, messages) in turn order. A dialogue is one row by nature, its turns gather in one task."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "content")))
    return df.groupBy(key).agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages"))


def chat_record(instruction: Column, code: Column) -> Column:
    """A user turn with the instruction and an assistant turn with the stripped code."""
    return F.array(
        F.struct(F.lit("user").alias("role"), instruction.alias("content")),
        F.struct(F.lit("assistant").alias("role"), textfn.py_strip(code).alias("content")),
    )


def instruction_prompt(code: Column) -> Column:
    """The request for a natural user request that describes a piece of code."""
    return F.concat(
        F.lit("Here is the Python code that somebody received. Write the request, in English, that this person may have made; say what the code does and what it is for:\n\n[CODE]\n"), code, F.lit("\n[/CODE]")
    )


def projected_content(df: DataFrame, key: str, content: str = "content") -> DataFrame:
    """(key, content): rows that have content, with escaped slashes undone."""
    return df.where(F.col(content).isNotNull()).select(key, textfn.unescape_slashes(content).alias("content"))
