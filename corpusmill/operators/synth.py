"""Synthetic examples: templated error reports and persona conversations, drawn by hash so that a seed fixes every row.

Defined results: ``count`` 0 gives no row; snippets of fewer than three lines and personas with characters outside the allowed set
take no part; without any snippet or persona the result is empty; a draw never depends on partitioning.
"""

from __future__ import annotations

import textwrap

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import textfn
from corpusmill.functions.textfn import FIM_BEGIN, FIM_END, FIM_HOLE, portable_draw
from corpusmill.operators.chat import numbered
from corpusmill.operators.joins import bounded_broadcast
from corpusmill.runtime import materialize

# Words that invented names are put together from.
FIRST = ("order", "sensor", "cache", "parcel", "batch", "widget", "ledger")
SECOND = ("total", "index", "queue", "config", "record", "buffer", "report")


def random_name(seed: int, slot: str, *key: Column | str, class_name: bool = False) -> Column:
    """``first_second``, or ``FirstSecond`` as a class name."""
    a = F.get(F.array(*map(F.lit, FIRST)), portable_draw(seed, len(FIRST), *key, F.lit(slot + "a")))
    b = F.get(F.array(*map(F.lit, SECOND)), portable_draw(seed, len(SECOND), *key, F.lit(slot + "b")))
    return F.concat(F.initcap(a), F.initcap(b)) if class_name else F.concat_ws("_", a, b)


def _case(title: str, log: str, description: str, buggy: str, fixed: str) -> tuple[str, str, str, str, str]:
    return title, "Traceback (most recent call last):\n  File \"<stdin>\", line {line}, in <module>\n".replace("{line}", str(buggy.strip("\n").count("\n") + 1)) + log, description, textwrap.dedent(buggy).strip("\n"), textwrap.dedent(fixed).strip("\n")


# (kind, simple case, complex case); None repeats the simple case. Slots: {n} 10..500, {m} 100..999, {p} 10..100, {q} 100..200, {L} a list of
# 3 to 6 numbers up to 100 and {i} an index 1 to 3 behind its length, {a} {b} two different lengths of 3 to 6, {v} {w} names, {t} the first with
# another last letter (or by chance the same), {C} a class name, {z} ten letters, {e} eight digits.
TEMPLATES = (
    ("TypeError", _case("TypeError: object of type 'int' has no len()", "TypeError: object of type 'int' has no len()", "A number has no length.", "{v} = {n}\nprint(len({v}))", "{v} = {n}\nprint(len(str({v})))"),
     _case("TypeError: can only concatenate str (not \"int\") to str", "TypeError: can only concatenate str (not \"int\") to str", "Text and a number were added.", "def show({v}):\n    return 'value ' + {v}\n\nshow({m})", "def show({v}):\n    return f'value {{v}}'\n\nshow({m})")),
    ("IndexError", _case("IndexError: list index out of range", "IndexError: list index out of range", "The index lies behind the end of the list.", "{v} = {L}\nprint({v}[{i}])", "{v} = {L}\nprint({v}[-1])"),
     _case("IndexError: pop from empty list", "IndexError: pop from empty list", "An empty list has nothing to pop.", "pending = []\npending.pop()", "pending = []\nif pending:\n    pending.pop()")),
    ("KeyError", _case("KeyError: 'size'", "KeyError: 'size'", "The mapping has no such key.", "{v} = {'colour': 'red'}\nprint({v}['size'])", "{v} = {'colour': 'red'}\nprint({v}.get('size'))"),
     _case("KeyError: 'street'", "KeyError: 'street'", "A nested mapping lacks the key.", "{v} = {'home': {'city': 'Oslo'}}\nprint({v}['home']['street'])", "{v} = {'home': {'city': 'Oslo'}}\nprint({v}.get('home', {}).get('street', ''))")),
    ("AttributeError", _case("AttributeError: 'int' object has no attribute 'append'", "AttributeError: 'int' object has no attribute 'append'", "A number can't be appended to.", "{v} = {m}\n{v}.append(1)", "{v} = [{m}]\n{v}.append(1)"),
     _case("AttributeError: '{C}' object has no attribute 'start'", "AttributeError: '{C}' object has no attribute 'start'", "The class doesn't define the method.", "class {C}:\n    pass\n\n{C}().start()", "class {C}:\n    def start(self):\n        return True\n\n{C}().start()")),
    ("NameError", _case("NameError: name '{t}' is not defined", "NameError: name '{t}' is not defined", "The name is misspelt.", "{v} = 1\nprint({t})", "{v} = 1\nprint({v})"),
     _case("NameError: name '{w}' is not defined", "NameError: name '{w}' is not defined", "The name only exists inside a function.", "def {v}():\n    {w} = 1\n\n{v}()\nprint({w})", "def {v}():\n    return 1\n\n{w} = {v}()\nprint({w})")),
    ("ValueError", _case("ValueError: operands could not be broadcast together with shapes ({a},) ({b},)", "ValueError: operands could not be broadcast together with shapes ({a},) ({b},)", "Two arrays of different length were added.", "import numpy as np\n\n{v} = np.zeros({a})\n{w} = np.ones({b})\nprint({v} + {w})", "import numpy as np\n\n{v} = np.zeros({a})\n{w} = np.ones({a})\nprint({v} + {w})"),
     _case("ValueError: cannot reshape array", "ValueError: cannot reshape array of size 7 into shape (2,3)", "The number of elements doesn't fit the shape.", "import numpy as np\n\nprint(np.arange(7).reshape(2, 3))", "import numpy as np\n\nprint(np.arange(6).reshape(2, 3))")),
    ("ZeroDivisionError", _case("ZeroDivisionError: division by zero", "ZeroDivisionError: division by zero", "The divisor is zero.", "print({p} / 0)", "share = 0\nprint({p} / share if share else 0.0)"),
     _case("ZeroDivisionError: division by zero", "ZeroDivisionError: division by zero", "The mean over nobody was asked for.", "total = {q}\nmembers = []\nprint(total / len(members))", "total = {q}\nmembers = []\nprint(total / len(members) if members else 0)")),
    ("RecursionError", _case("RecursionError: maximum recursion depth exceeded", "RecursionError: maximum recursion depth exceeded", "The function calls itself without an end.", "def {v}(n):\n    return {v}(n - 1)\n\n{v}(3)", "def {v}(n):\n    return {v}(n - 1) if n else 0\n\n{v}(3)"),
     _case("RecursionError: maximum recursion depth exceeded", "RecursionError: maximum recursion depth exceeded", "Two functions call each other without an end.", "def ping():\n    return pong()\n\ndef pong():\n    return ping()\n\nping()", "def ping():\n    return 'pong'\n\nping()")),
    ("ModuleNotFoundError", _case("ModuleNotFoundError: No module named '{z}_utils'", "ModuleNotFoundError: No module named '{z}_utils'", "The module isn't installed.", "import {z}_utils", "try:\n    import {z}_utils\nexcept ModuleNotFoundError:\n    {z}_utils = None"),
     _case("ImportError: cannot import name '{w}' from '{v}'", "ImportError: cannot import name '{w}' from '{v}' (unknown location)", "The package doesn't offer the name.", "import sys\nimport types\n\nsys.modules['{v}'] = types.ModuleType('{v}')\nfrom {v} import {w}", "import sys\nimport types\n\nsys.modules['{v}'] = types.ModuleType('{v}')\nsys.modules['{v}'].{w} = print\nfrom {v} import {w}")),
    ("FileNotFoundError", _case("FileNotFoundError: [Errno 2] No such file or directory: 'lost_{e}.txt'", "FileNotFoundError: [Errno 2] No such file or directory: 'lost_{e}.txt'", "The file isn't there.", "open('lost_{e}.txt')", "import os\n\nif os.path.exists('lost_{e}.txt'):\n    open('lost_{e}.txt')"), None),
    ("PermissionError", _case("PermissionError: [Errno 13] Permission denied: '/etc/shadow'", "PermissionError: [Errno 13] Permission denied: '/etc/shadow'", "The file may not be read.", "open('/etc/shadow')", "try:\n    open('/etc/shadow')\nexcept PermissionError:\n    print('not allowed')"), None),
    ("SyntaxError", _case("SyntaxError: expected ':'", "SyntaxError: expected ':'", "A colon is missing.", "if True\n    print('yes')", "if True:\n    print('yes')"),
     _case("SyntaxError: '(' was never closed", "SyntaxError: '(' was never closed", "A bracket is left open.", "print('a'", "print('a')")),
    ("IndentationError", _case("IndentationError: expected an indented block", "IndentationError: expected an indented block after function definition on line 1", "The body isn't indented.", "text = 'def show():\\nreturn 1'\nexec(text)", "text = 'def show():\\n    return 1'\nexec(text)"),
     _case("IndentationError: unindent does not match any outer indentation level", "IndentationError: unindent does not match any outer indentation level", "A line returns to a level that isn't there.", "text = 'if True:\\n    print(1)\\n  print(2)'\nexec(text)", "text = 'if True:\\n    print(1)\\nprint(2)'\nexec(text)")),
)


def error_examples(spark: SparkSession, count: int, seed: int = 42, numpy: bool = True) -> DataFrame:
    """(id, kind, error_context, fixed_code_snippet): ``count`` examples of evenly drawn kinds, simple and complex ones alike."""
    kinds = [t for t in TEMPLATES if numpy or t[0] != "ValueError"]
    rows = []
    for i, (kind, simple, hard) in enumerate(kinds):
        rows += [(i, 0, kind, *simple), (i, 1, kind, *(hard or simple))]
    templates = spark.createDataFrame(rows, "__k int, __c int, kind string, title string, log string, description string, buggy string, fixed string")
    ids = spark.range(count)
    drawn = ids.withColumn("__k", portable_draw(seed, len(kinds), "id", F.lit("kind"))).withColumn("__c", portable_draw(seed, 2, "id", F.lit("case")))
    number = lambda bound, slot, least: portable_draw(seed, bound, "id", F.lit(slot)).cast("int") + least
    draw = lambda bound, slot, least: number(bound, slot, least).cast("string")
    first = random_name(seed, "v", "id")
    slots = {
        "{v}": first,
        "{w}": random_name(seed, "w", "id"),
        "{C}": random_name(seed, "C", "id", class_name=True),
        "{n}": draw(491, "n", 10),
        "{m}": draw(900, "m", 100),
        "{p}": draw(91, "p", 10),
        "{q}": draw(101, "q", 100),
        "{L}": F.concat(F.lit("["), F.array_join(F.slice(F.array(*(draw(100, f"L{i}", 1) for i in range(6))), 1, number(4, "len", 3)), ", "), F.lit("]")),
        "{i}": (number(4, "len", 3) + number(3, "i", 1)).cast("string"),
        "{a}": draw(4, "a", 3),
        "{b}": (F.pmod(number(4, "a", 0) + number(3, "b", 1), F.lit(4)) + 3).cast("string"),
        "{t}": F.concat(F.substring(first, 1, F.length(first) - 1), F.chr(number(26, "x", 97))),
        "{z}": F.concat(*(F.chr(number(26, f"z{i}", 97)) for i in range(10))),
        "{e}": F.concat(*(draw(10, f"e{i}", 0) for i in range(8))),
    }
    drawn = drawn.withColumns({f"__{slot[1]}_slot": value for slot, value in slots.items()})  # each draw once, however often a template names it
    joined = drawn.join(F.broadcast(templates), ["__k", "__c"])  # a fixed table of two rows per kind
    for c in ("title", "log", "description", "buggy", "fixed"):
        text = F.col(c)
        for slot in slots:
            text = F.replace(text, F.lit(slot), F.col(f"__{slot[1]}_slot"))
        joined = joined.withColumn(c, text)
    context = F.struct(F.col("title"), F.col("log").alias("error_log"), F.lit("python").alias("language"), F.col("description"), F.col("buggy").alias("buggy_code_snippet"))
    return joined.select("id", "kind", context.alias("error_context"), F.col("fixed").alias("fixed_code_snippet"))


# Persona keys in the order in which they make up the system turn, and the marks of the answer's addition.
PERSONA_KEYS = ("role_context", "tone_context", "task_instruction", "output_requirement")
DEFAULT_ROLE = "You are a helpful AI assistant."
ADDITIONS = (
    ("--- Explanation ---", "The lines above close the gap. They do the step that the code around them needs, and they keep to its names."),
    ("--- Rationale ---", "The filled part is kept short and plain. Another way would work too, but this one is easier to read here."),
    ("--- Notes ---", "The missing part follows the style of the code around it. It needs no further imports."),
    ("--- Test Coverage ---", "The added lines are covered on the usual path and on one edge case."),
)


def system_turn(persona: Column) -> Column:
    """The persona's four texts joined by one space each; only a missing role has a default."""
    texts = [F.coalesce(persona[k], F.lit(DEFAULT_ROLE if k == "role_context" else "")) for k in PERSONA_KEYS]
    joined = texts[0]
    for t in texts[1:]:
        joined = F.concat(joined, F.lit(" "), t)
    return textfn.py_strip(joined)


def allowed_personas(personas: DataFrame, column: str = "persona") -> DataFrame:
    """Personas all of whose values hold allowed characters only; null values count as the text None."""
    return personas.where(F.forall(F.map_values(column), lambda v: textfn.only_allowed_characters(F.coalesce(v, F.lit("None")))))


def conversation(lines: Column, persona: Column, seed: int, key: Column | str) -> Column:
    """(user, assistant) of a snippet's lines with a gap between the first and the last, and the persona's kind of addition."""
    n = F.size(lines)
    wide = lambda slot: F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), textfn.as_column(key).cast("string"), F.lit(slot))), 1, 8), 16, 10).cast("long")
    a = (F.lit(1) + F.pmod(wide("a"), (n - 2).cast("long"))).cast("int")
    b = (a + F.pmod(wide("b"), (n - 1 - a).cast("long"))).cast("int")
    join = lambda x: F.array_join(x, "\n")
    gap = F.concat(F.lit(FIM_BEGIN), join(F.slice(lines, 1, a)), F.lit(FIM_HOLE), join(F.slice(lines, b + 2, n)), F.lit(FIM_END))
    # Fixed value: the opening of the user turn.
    ask = "Please complete the missing part of the following Python code snippet:\n\n"
    wish = F.coalesce(persona["output_requirement"], F.lit(""))
    addition = F.lit("")
    for mark, text in reversed(ADDITIONS):
        addition = F.when(F.contains(wish, F.lit(mark)), F.lit(f"\n\n{mark}\n{text}")).otherwise(addition)
    return F.struct(
        F.concat(F.lit(ask), gap).alias("user"),
        F.concat(join(F.slice(lines, a + 1, b - a + 1)), addition).alias("assistant"),
    )


#: Draws and personas that are broadcast at most (tens of bytes, a few hundred bytes each).
DRAWS_BROADCAST = 1_000_000
PEOPLE_BROADCAST = 100_000


def persona_pairs(snippets: DataFrame, personas: DataFrame, count: int, order: str, content: str = "content", seed: int = 42) -> DataFrame:
    """(id, messages): ``count`` independent draws, with replacement, of a snippet and a persona.

    Both sides are numbered and met by equality on the drawn numbers: no pair table is ever built. Only keys are numbered; the texts
    stay where they are and meet the drawn keys, which are broadcast up to ``DRAWS_BROADCAST`` draws, unless there are more draws than snippets.
    """
    spark = snippets.sparkSession
    lines = F.split(textfn.py_strip(content), "\n", -1)
    indexed = numbered(snippets.where(F.size(lines) >= 3).select(F.col(order).alias("__key")), "__key", "__s")
    people = numbered(allowed_personas(personas).withColumn("__o", F.to_json(F.array_sort(F.map_entries("persona")))), "__o", "__p").select("__p", "persona")
    n, m = indexed.count(), people.count()
    if not n or not m:
        return spark.createDataFrame([], "id bigint, messages array<struct<role:string,content:string>>")
    wide = lambda slot, k: F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string"), F.lit(slot))), 1, 12), 16, 10).cast("long"), F.lit(k)) + 1
    draws = spark.range(count).withColumn("__s", wide("s", n)).withColumn("__p", wide("p", m))
    drawn = materialize(draws.join(indexed, "__s").select("id", "__p", "__key"), "draws")
    texts = snippets.select(F.col(order).alias("__key"), lines.alias("__lines"))
    few = n > count  # fewer draws than snippets: most texts aren't drawn and stay; otherwise the texts, no more than draws, are spread
    met = texts.join(bounded_broadcast(drawn, DRAWS_BROADCAST) if few else drawn.hint("shuffle_hash"), "__key").join(bounded_broadcast(people, PEOPLE_BROADCAST), "__p").withColumn("__c", conversation(F.col("__lines"), F.col("persona"), seed, "id"))
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    out = met.select("id", F.array(turn("system", system_turn(F.col("persona"))), turn("user", F.col("__c.user")), turn("assistant", F.col("__c.assistant"))).alias("messages"))
    return out.where(~textfn.is_blank(F.get("messages", F.lit(2))["content"]))
