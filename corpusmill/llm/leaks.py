"""Problem 9: evaluation texts leaking into training text.

The corpus gets a positional inverted index that knows nothing of any test set: a posting table keyed by range of documents and term,
each row a term's documents and positions within the range. It is built in one pass, stored, and serves every test set after that.
For a test set, the postings of its terms are taken from the table. Each window of ``min_words`` words of an item names its rarest
terms (by occurrences in the corpus), two more than may be replaced, so an exact or nearly exact copy keeps two of them; their
posting lists, adjusted by offset, are intersected, and where two agree, the lists of all the item's terms are compared along that
alignment. Runs of at least ``min_words`` words that begin and end with equal words and have at most one replaced word in
``per_replaced`` are reported.

Defined results: null, empty and short documents hold nothing; items whose task has fewer words than the window can't leak; the
instruction sentence that several items share and code stubs at an item's end are not part of the task; a document that holds
an item twice is reported once; repeated documents are reported each.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.textfn import py_strip
from corpusmill.runtime import map_columns, materialize

MIN_WORDS = 15
PER_REPLACED = 6
#: Words of one range of documents (a longer document is a range of its own).
RANGE_WORDS = 500_000
#: Words of the test items that the driver holds and sends to the executors at once; larger test sets go in blocks.
BLOCK_WORDS = 1_000_000
#: Offset-adjusted postings, and words along alignments, that a task compares at once.
STEP = 4_000_000
TAG = re.compile(r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>\n]*)?/?>|&(?:nbsp|amp|lt|gt|quot|#\d+);")
PREFIX = re.compile(r"^[ \t]*(?:(?:[>|#*+;%-]|//|--)[ \t]*)*(?:(?:\d{1,4}[.):|]|\[\d+\]|[Ll]ine \d+:|L\d+[.:]?)[ \t]+)?", re.M)
SOFT = re.compile(r"(?<=[^\W\d_])-\n[ \t>|#*/]*(?=[^\W\d_])|[­​‌‍⁠﻿]")
WORD = re.compile(r"[^\W_]+")
STUB = re.compile(r"\n\s*\n\s*(?:```\w*\s*\n)?(?:def |class |async def |@).*", re.S)


def words(text: str) -> list[str]:
    """Words in reading order: no case, punctuation, markup, line prefixes or width variants."""
    text = unicodedata.normalize("NFKC", text)
    if "<" in text or "&" in text:
        text = TAG.sub(" ", text)
    text = SOFT.sub("", text)
    return WORD.findall(PREFIX.sub("", text).casefold())


def task_text(text: str, shared: bool) -> str:
    """An item's stated task: without a shared instruction paragraph in front and without a code stub behind."""
    body = STUB.sub("", text.replace("\r\n", "\n"))
    head, gap, rest = body.partition("\n\n")
    return rest if gap and shared else body


def item_words(items: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(item_id, words) of the items that can leak."""
    texts = items.where("text IS NOT NULL AND text <> ''").select("item_id", F.regexp_replace("text", "\r\n", "\n").alias("text"))
    texts = texts.withColumn("head", F.when(F.contains("text", F.lit("\n\n")), py_strip(F.substring_index("text", "\n\n", 1))))
    shared = texts.where("head IS NOT NULL").groupBy("head").agg((F.count("*") > 1).alias("shared"))
    marked = texts.join(shared, "head", "left").select("item_id", "text", F.coalesce("shared", F.lit(False)).alias("shared"))
    out = map_columns(marked, ["item_id", "text", "shared"], lambda i, t, s: {"item_id": i, "words": [words(task_text(*x)) for x in zip(t, s)]}, "item_id bigint, words array<string>")
    return out.where(F.size("words") >= min_words)


INDEX = "docs_in bigint, term string, docs array<int>, counts array<int>, positions array<int>, ids array<bigint>"


def _postings(number: int, ids: list[int], sizes: list[int], terms: list[str], tokens: np.ndarray) -> pa.RecordBatch:
    """A range's rows, by term: the documents (numbered within the range) that hold it, how often, and where. The row of the empty term,
    which no word is, holds the documents' ids."""
    by_name = sorted(range(len(terms)), key=terms.__getitem__)
    rank = np.empty(len(terms), np.int64)
    rank[by_name] = np.arange(len(terms))
    token = rank[tokens]
    order = np.argsort(token, kind="stable")  # tokens come by document and position
    term = token[order]
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)[order]
    position = (np.arange(len(tokens)) - np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)).astype(np.int32)[order]
    fresh = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])])) if len(term) else np.array([], np.int64)
    counts = np.diff(np.append(fresh, len(term))).astype(np.int32)
    holders = np.concatenate([[0, 0], np.cumsum(np.bincount(term[fresh], minlength=len(terms)))]).astype(np.int32)
    places = np.concatenate([[0, 0], np.cumsum(np.bincount(term, minlength=len(terms)))]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(v, pa.int32())) for o, v in ((holders, doc[fresh]), (holders, counts), (places, position))]
    named = pa.array([ids, *[None] * len(terms)], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([number] * (len(terms) + 1), pa.int64()), pa.array(["", *(terms[i] for i in by_name)]), *lists, named], names=["docs_in", "term", "docs", "counts", "positions", "ids"])


def build_index(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_words: int = RANGE_WORDS) -> DataFrame:
    """The posting table (``INDEX``) of all words of all documents, keyed by range (``docs_in``) and term; map-only."""

    def run(batches):
        made = 0
        part = TaskContext.get().partitionId()
        ids, sizes, parts = [], [], []
        vocabulary: dict[str, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__

        def flush():
            nonlocal made
            out = _postings((part << 32) + made, ids, sizes, list(vocabulary), np.concatenate(parts) if parts else np.array([], np.int64))
            made += 1
            ids.clear(), sizes.clear(), parts.clear(), vocabulary.clear()
            return out

        held = 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words(t) if t else []
                if not w:
                    continue
                ids.append(i)
                sizes.append(len(w))
                parts.append(np.array([vocabulary[x] for x in w], np.int64))
                held += len(w)
                if held >= range_words:
                    yield flush()
                    held = 0
        if ids:
            yield flush()

    return documents.where(F.col(text_col).isNotNull()).select(id_col, text_col).mapInArrow(run, INDEX)


def anchors(sequence: list[int], frequency: dict[int, int], min_words: int, per_replaced: int) -> list[int]:
    """Positions of the rarest terms of each window: two more than can be replaced in it, so two of them agree in any match."""
    need = -(-6 * min_words // (5 * per_replaced)) + 2
    chosen: set[int] = set()
    for a in range(len(sequence) - min_words + 1):
        window = sorted(range(a, a + min_words), key=lambda p: (frequency.get(sequence[p], 0), sequence[p], p))
        chosen.update(window[:need])
    return sorted(chosen)


def longest_run(positions: np.ndarray, min_words: int, per_replaced: int) -> int:
    """Words of the longest stretch that begins and ends with a match and has few enough misses; 0 below ``min_words``.

    A stretch from match a to match b has few enough where ``per * (span - matches) <= span``, that is where ``g(b) <= g(a) + 1`` for
    ``g(i) = (per - 1) * position - per * i``; the last such b is found in the smallest values of g from the right.
    """
    p = np.asarray(positions)
    if len(p) < 2:
        return 0
    g = (per_replaced - 1) * p - per_replaced * np.arange(len(p))
    ahead = np.minimum.accumulate(g[::-1])[::-1]
    span = int((p[np.searchsorted(ahead, g + 1, "right") - 1] - p).max()) + 1
    return span if span >= min_words else 0


def _compare(postings: pa.Table, number: dict[str, int], begin: dict[int, list[tuple[int, int]]], items: list[tuple[int, np.ndarray]], min_words: int, per_replaced: int) -> dict[str, list]:
    """The items that one range of documents holds."""
    out = {"doc_id": [], "item_id": [], "n_words": []}
    table = postings.combine_chunks()
    terms = table["term"].to_pylist()
    ids = next((x for x in table["ids"].to_pylist() if x is not None), [])
    flat = lambda c: table[c].combine_chunks().flatten().to_numpy() if table.num_rows else np.array([], np.int32)
    lengths = table["positions"].combine_chunks().value_lengths().to_numpy()
    token = np.repeat(np.array([number.get(t, -1) for t in terms], np.int32), lengths)
    doc, position = np.repeat(flat("docs"), flat("counts")), flat("positions").astype(np.int64)
    gap = max(len(w) for _, w in items)
    size = np.zeros(len(ids), np.int64)
    np.maximum.at(size, doc, position + 1)
    base = gap + np.concatenate([[0], np.cumsum(size + gap)])[:-1]  # documents lie apart, so that no alignment touches two
    at = base[doc] + position
    text = np.full(int(at.max(initial=0)) + 2 * gap + 1, -1, np.int32)
    text[at] = token
    first = np.concatenate([[0], np.cumsum(lengths)])
    rows = {number[t]: i for i, t in enumerate(terms) if t in number}
    by_item: dict[int, list[tuple[int, int]]] = {}
    for t, starts in begin.items():
        if t in rows:
            for k, p in starts:
                by_item.setdefault(k, []).append((p, rows[t]))
    least = min_words - min_words // per_replaced
    best: dict[tuple[int, int], int] = {}
    for k, starts in by_item.items():
        wanted = items[k][1]
        shifts: list[np.ndarray] = []
        agreed = [np.array([], np.int64)]
        lists = [at[first[r] : first[r + 1]] - p for p, r in starts]
        for lo, hi in _slices(sum(map(len, lists)), len(text)):  # alignments of one stretch of the range at a time
            part = np.sort(np.concatenate([x[(x >= lo) & (x < hi)] for x in lists] if hi - lo < len(text) + gap else lists))
            agreed.append(np.unique(part[1:][part[1:] == part[:-1]]))
        shifts = np.concatenate(agreed)
        step = max(1, STEP // len(wanted))
        for a in range(0, len(shifts), step):
            some = shifts[a : a + step]
            equal = text[some[:, None] + np.arange(len(wanted))] == wanted
            for row in np.flatnonzero(equal.sum(1) >= least):
                hits = np.flatnonzero(equal[row])
                run = longest_run(hits, min_words, per_replaced)
                if run:
                    d = int(np.searchsorted(base, some[row] + hits[0], "right")) - 1
                    best[d, k] = max(run, best.get((d, k), 0))
    for (d, k), run in best.items():
        for name, v in zip(out, (ids[d], items[k][0], run)):
            out[name].append(v)
    return out


def _slices(total: int, width: int) -> list[tuple[int, int]]:
    """Stretches of 0..width, as many as keep about ``STEP`` of ``total`` in each."""
    n = max(1, -(-total // STEP))
    edges = [width * i // n for i in range(n + 1)]
    return list(zip([-width, *edges[1:-1]], [*edges[1:-1], 2 * width]))


RESULT = "doc_id bigint, item_id bigint, n_words int"


def search(index: DataFrame, tests: list[tuple[int, list[str]]], min_words: int = MIN_WORDS, per_replaced: int = PER_REPLACED) -> DataFrame:
    """(doc_id, item_id, n_words) of a block of test items over the posting table. Only the postings of their terms are read on; a
    range's lists, bounded by ``RANGE_WORDS``, meet in one task."""
    spark = index.sparkSession
    vocabulary = sorted({w for _, ws in tests for w in ws})
    number = {t: i for i, t in enumerate(vocabulary)}
    wanted = F.broadcast(spark.createDataFrame([("",), *((t,) for t in vocabulary)], "term string"))  # at most ``BLOCK_WORDS`` words and one
    postings = index.join(wanted, "term", "left_semi")
    held = postings.where("term <> ''").groupBy("term").agg(F.sum(F.size("positions")).alias("n")).collect()  # one row per test term
    frequency = {number[r["term"]]: r["n"] for r in held}
    items = [(i, np.array([number[w] for w in ws], np.int32)) for i, ws in tests]
    begin: dict[int, list[tuple[int, int]]] = {}
    for k, (_, sequence) in enumerate(items):
        for p in anchors(sequence.tolist(), frequency, min_words, per_replaced):
            begin.setdefault(int(sequence[p]), []).append((k, p))
    shared = spark.sparkContext.broadcast((number, begin, items))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int32())])
    return postings.groupBy("docs_in").applyInArrow(lambda table: pa.Table.from_pydict(_compare(table, *shared.value, min_words, per_replaced), schema=schema), RESULT)


def leaks(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, per_replaced: int = PER_REPLACED, index: DataFrame | None = None) -> DataFrame:
    """(doc_id, item_id, n_words): each document and each item it holds a passage of, with the longest passage's words.

    Without the stored ``index`` of an earlier run the documents are indexed first. Test items are searched for in blocks of about
    ``BLOCK_WORDS`` words; the driver holds one block at a time, and no join moves the corpus.
    """
    spark = documents.sparkSession
    tests = materialize(item_words(items, min_words), "tests")
    total = tests.agg(F.sum(F.size("words"))).first()[0]
    if not total:
        return spark.createDataFrame([], RESULT)
    if index is None:
        index = materialize(build_index(documents), "postings")
    blocks = -(-total // BLOCK_WORDS)
    out = None
    for b in range(blocks):
        block = [(r[0], r[1]) for r in tests.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()]
        if block:
            found = search(index, block, min_words, per_replaced)
            found = materialize(found, "leaks") if blocks > 1 else found
            out = found if out is None else out.unionByName(found)
    return out


def p9_found(documents: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(documents, items).select("doc_id", "item_id")
