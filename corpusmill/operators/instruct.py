"""Instruction builders: incremental scan, chunking, a completion provider, answer cleaning, budgets and chat records.

Defined results: documents with null or empty content give no record but count as processed; chunks whose answer is empty after
cleaning are dropped; ids are marked together with the batch that holds their records, so a crash neither loses nor repeats one.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import pyast, textfn
from corpusmill.operators.chat import chat_record, instruction_prompt
from corpusmill.operators.joins import anti_join_in_place
from corpusmill.runtime import _arrow

RECORD_BUDGET = 6_000
DOCUMENT_BUDGET = 60_000
LICENCE_CHUNK = 500


class RateLimited(Exception):
    """A provider asks to come back later."""


@dataclass(frozen=True)
class Request:
    """What a provider is asked besides the prompt: its instructions, and the length and randomness of the answer."""

    system: str = ""
    max_tokens: int = 1_500
    temperature: float = 0.0


class CompletionProvider(Protocol):
    """One client per task. Whether a provider's terms allow training on its output is the operator's responsibility."""

    def complete(self, prompt: str, request: Request) -> str | Sequence[str]:
        """The answer, as one text or in blocks that are joined."""
        ...


class OfflineProvider:
    """Deterministic stand-in without a network: names the first definition of the code in the prompt."""

    def complete(self, prompt: str, request: Request) -> str:
        import re

        m = re.search(r"(?:def|class)\s+(\w+)", prompt)
        return f'"Please write {m[1] if m else "a short script"} in Python."'


#: The two builders' requests: their instructions are the same, a whole file may be told about at more length.
SYSTEM = (
    "You write training data. You are shown a piece of Python code that answers somebody's wish. Put that wish into English words, as a question or a command that a user "
    "could have typed. Name what shall be reached, not how the code does it. Reply with the wish alone, without introduction or remarks."
)
FUNCTION_REQUEST = Request(SYSTEM, 1_500)
DOCUMENT_REQUEST = Request(SYSTEM, 2_000)


def completed(
    df: DataFrame, prompt: str, make: Callable[[], CompletionProvider], request: Request = Request(), attempts: int = 5, base_wait: float = 1.0, jitter: float = 1.0, name: str = "answer", parallel: int = 4
) -> DataFrame:
    """``df`` with the provider's answer to each prompt and, in ``<name>_error``, why there is none.

    On a rate limit a prompt waits ``base_wait * 2**i`` seconds and up to ``jitter`` more, so that tasks don't come back together; after
    ``attempts`` of them, and on any other failure, the answer is empty text and the error is named. A null prompt has neither.
    A task has ``parallel`` prompts under way at once.
    """
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields)}, `{name}` string, `{name}_error` string"
    arrow_schema = _arrow(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make()

        def ask(text: str | None) -> tuple[str | None, str | None]:
            if text is None:
                return None, None
            for i in range(attempts):
                try:
                    said = client.complete(text, request)
                    return (said if isinstance(said, str) else "".join(said)), None
                except RateLimited:
                    if i + 1 < attempts:
                        time.sleep(base_wait * 2**i + random.uniform(0, jitter))
                except Exception as e:
                    return "", type(e).__name__
            return "", RateLimited.__name__

        with ThreadPoolExecutor(parallel) as pool:
            for batch in batches:
                asked = list(pool.map(ask, batch.column(batch.schema.get_field_index(prompt)).to_pylist()))
                answers = [pa.array(column, pa.string()) for column in (zip(*asked) if asked else ((), ()))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, arrow_schema)] + answers, schema=arrow_schema)

    return df.mapInArrow(run, schema)


def failures(asked: DataFrame, name: str = "answer") -> DataFrame:
    """(error, n_prompts): prompts without an answer by error."""
    return asked.where(F.col(f"{name}_error").isNotNull()).groupBy(F.col(f"{name}_error").alias("error")).agg(F.count("*").alias("n_prompts"))


def unprocessed(docs: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Documents whose key isn't in the log yet; log lines are stripped, empty ones ignored. Documents that the log's bitmap rules out
    stay where they are."""
    log = processed.select(textfn.py_strip(F.col(processed.columns[0]).cast("string")).alias("__key")).where("__key <> ''").distinct()
    return anti_join_in_place(docs.withColumn("__key", F.col(key).cast("string")), log, "__key").drop("__key")


def newest(docs: DataFrame, key: str, limit: int) -> DataFrame:
    """The ``limit`` documents with the largest key, in that order."""
    return docs.orderBy(F.desc(key)).limit(limit)


def licence_chunk(chunk) -> F.Column:
    return (F.length(chunk) > LICENCE_CHUNK) & (F.contains(chunk, F.lit("Copyright")) | F.contains(chunk, F.lit("License")))


def function_chunks(docs: DataFrame, key: str, content: str = "content") -> DataFrame:
    """(key, idx, chunk): function-level chunks without licence texts."""
    rows = docs.where(F.col(content).isNotNull() & (F.col(content) != "")).select(key, F.posexplode(pyast.code_chunks(F.col(content))).alias("idx", "c"))
    rows = rows.select(key, "idx", textfn.py_strip("c").alias("chunk")).where("chunk <> ''")
    return rows.where(~licence_chunk(F.col("chunk")))


def _answered(rows: DataFrame, key: str, code: str, make, budget: int | None, request: Request) -> DataFrame:
    asked = completed(rows.withColumn("__prompt", instruction_prompt(F.col(code))), "__prompt", make, request, name="__raw")
    told = asked.withColumn("__instruction", pyast.cleaned_answer(F.col("__raw"))).where("__instruction <> ''")
    if budget is not None:
        told = told.where(F.length("__instruction") + F.length(code) <= budget)
    return told.withColumn("messages", chat_record(F.col("__instruction"), F.col(code)))


def function_instructions(docs: DataFrame, key: str, content: str = "content", make: Callable[[], CompletionProvider] = OfflineProvider, budget: int = RECORD_BUDGET) -> DataFrame:
    """(key, idx, messages): a record per chunk within the budget."""
    return _answered(function_chunks(docs, key, content), key, "chunk", make, budget, FUNCTION_REQUEST).select(key, "idx", "messages")


def document_instructions(docs: DataFrame, key: str, content: str = "content", make: Callable[[], CompletionProvider] = OfflineProvider, budget: int = DOCUMENT_BUDGET) -> DataFrame:
    """(key, messages): a record per document of at most ``budget`` characters."""
    rows = docs.where(F.col(content).isNotNull()).select(key, textfn.py_strip(content).alias("code")).where((F.col("code") != "") & (F.length("code") <= budget))
    return _answered(rows, key, "code", make, None, DOCUMENT_REQUEST).select(key, "messages")


def processed_ids(docs: DataFrame, records: DataFrame, key: str, content: str = "content", mark_failed: bool = False) -> DataFrame:
    """Keys to log for a batch: those with records and those without content; with ``mark_failed`` all of the batch."""
    if mark_failed:
        return docs.select(key).distinct()
    empty = docs.where(F.col(content).isNull() | (F.col(content) == "")).select(key)
    return records.select(key).unionByName(empty).distinct()
