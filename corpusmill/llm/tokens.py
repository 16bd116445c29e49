"""Problem 8: encoding with a public byte-level BPE tokenizer.

Pre-tokenisation works on whole batches without a regex: an array of codepoint classes, then an associative scan over the
transition functions of a small automaton (each block of text is reduced to the function it applies to the state, the functions
are composed, and every position gets its state), which yields the token starts. The slices feed a cached pair merging; offsets
are kept, so that every id can be traced to its characters and decoded again.

Defined results: null and empty texts give an empty list of ids; text that looks like a special token is plain text;
lone surrogates are encoded as the replacement character; whole texts are encoded, whatever their length.
"""

from __future__ import annotations

import base64
import heapq
import os
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import map_columns

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CACHE_PIECES = 200_000

# Codepoint classes; APOS1 and APOS2 are apostrophes before a one- or two-letter contraction, SEP stands between texts.
LETTER, NUMBER, OTHER, SPACE, BLANK, APOS1, APOS2, SEP = range(8)
# Automaton states: what the last character belongs to. BLANK_END is a white-space run that ends in a plain space so far.
S_NONE, S_LETTER, S_NUMBER, S_OTHER, S_BLANK, S_SPACE, S_ONE, S_TWO = range(8)
# Contractions that are tokens of their own.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, does a token start here) for each class and state."""
    to = np.zeros((8, 8), np.uint8)
    starts = np.zeros((8, 8), bool)
    for state in range(8):
        for cls, run in ((LETTER, S_LETTER), (NUMBER, S_NUMBER), (OTHER, S_OTHER)):
            to[cls, state] = run
            starts[cls, state] = state not in (run, S_SPACE)
        for cls, run in ((SPACE, S_SPACE), (BLANK, S_BLANK)):
            to[cls, state] = run
            starts[cls, state] = state not in (S_BLANK, S_SPACE)
        for cls, run in ((APOS1, S_ONE), (APOS2, S_TWO)):
            inside = state in (S_OTHER, S_SPACE)
            to[cls, state] = S_OTHER if inside else run
            starts[cls, state] = not inside
        to[SEP, state], starts[SEP, state] = S_NONE, True
    # Letters of a contraction: no start, then the token is complete.
    to[:, S_TWO], starts[:, S_TWO] = S_ONE, False
    to[:, S_ONE], starts[:, S_ONE] = S_NONE, False
    to[SEP, :], starts[SEP, :] = S_NONE, True
    return to, starts


TO, STARTS = _transitions()


@lru_cache(1)
def codepoint_classes() -> np.ndarray:
    """Class of each codepoint, from the character database of the running Python."""
    import unicodedata

    table = np.full(0x110000, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for cp in range(0x110000):
        c = kinds.get(unicodedata.category(chr(cp))[0])
        if c is not None:
            table[cp] = c
    # Unicode White_Space.
    for cp in (*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        table[cp] = BLANK
    table[0x20] = SPACE
    return table


def _scan(classes: np.ndarray, block: int = 64) -> np.ndarray:
    """State before each character: block-wise associative scan over transition functions."""
    n = len(classes)
    blocks = -(-n // block)
    grid = np.full((blocks, block), SEP, np.uint8)
    grid.reshape(-1)[:n] = classes
    # Each block as one function: its effect on all states at once.
    effect = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    flat = TO.reshape(-1)
    for k in range(block):
        effect = flat[grid[:, k : k + 1].astype(np.uint16) * 8 + effect]
    # Exclusive scan of the blocks' functions by doubling: compose(a then b)[s] = b[a[s]].
    prefix = effect
    step = 1
    while step < blocks:
        combined = prefix.copy()
        combined[step:] = np.take_along_axis(prefix[step:], prefix[:-step].astype(np.intp), 1)
        prefix = combined
        step *= 2
    state = np.zeros(blocks, np.uint8)
    state[1:] = prefix[:-1, S_NONE]
    out = np.empty((blocks, block), np.uint8)
    for k in range(block):
        out[:, k] = state
        state = flat[grid[:, k].astype(np.uint16) * 8 + state]
    return out.reshape(-1)[:n]


def token_starts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """(all texts joined with a separator before each, starts of tokens in it, positions of separators)."""
    joined = "\0" + "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    seps = np.concatenate(([0], np.cumsum(lengths + 1)))
    classes = codepoint_classes()[points]
    apos = np.flatnonzero(points == 0x27)
    if len(apos):
        after = np.concatenate((points, np.zeros(2, np.uint32)))
        one, two = after[apos + 1], after[apos + 2]
        classes[apos[np.isin(one, [ord(c) for c in ONE_LETTER])]] = APOS1
        pair = np.zeros(len(apos), bool)
        for a, b in TWO_LETTERS:
            pair |= (one == ord(a)) & (two == ord(b))
        classes[apos[pair]] = APOS2
    classes[seps] = SEP
    state = _scan(classes)
    start = STARTS[classes, state]
    # The last character of a white-space run stands alone or joins what follows: it starts a token unless the text ends there.
    blank = (classes == SPACE) | (classes == BLANK)
    following = np.concatenate((classes[1:], [SEP]))
    start |= blank & ~np.isin(following, (SPACE, BLANK, SEP))
    return joined, np.flatnonzero(start), seps


class PairMerger:
    """Byte-pair merging by rank with a bounded cache of finished pieces."""

    def __init__(self, path: str = DEFAULT_VOCABULARY) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.cache: dict[str, list[int]] = {}

    def __call__(self, piece: str) -> list[int]:
        ids = self.cache.get(piece)
        if ids is None:
            ids = self.merge(piece.encode("utf-8", "replace") if not _surrogate(piece) else piece.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode())
            if len(self.cache) >= CACHE_PIECES:
                self.cache.clear()
            if len(piece) <= 64:
                self.cache[piece] = ids
        return ids

    def merge(self, data: bytes) -> list[int]:
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        # Parts as a linked list; candidate pairs wait in a heap, stale ones are recognised by their extent.
        nxt, prv, size = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, extent = heapq.heappop(heap)
            j = nxt[i]
            if size[i] == 0 or j >= n or size[i] + size[j] != extent:
                continue
            size[i], size[j] = extent, 0
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                if (r := ranks.get(data[i : k + size[k]])) is not None:
                    heapq.heappush(heap, (r, i, extent + size[k]))
            if (h := prv[i]) >= 0 and (r := ranks.get(data[h : i + extent])) is not None:
                heapq.heappush(heap, (r, h, size[h] + extent))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : i + size[i]]])
            i = nxt[i]
        return out


def _surrogate(piece: str) -> bool:
    return any("\ud800" <= c <= "\udfff" for c in piece)


@lru_cache(2)
def merger(path: str) -> PairMerger:
    return PairMerger(path)


def encode_batch(texts: list[str | None], path: str = DEFAULT_VOCABULARY, offsets: bool = False) -> tuple[list[list[int]], list[list[dict]] | None]:
    """Ids of each text, and per pre-token the (start character, number of ids) where ``offsets`` is set."""
    merge = merger(path)
    present = [i for i, t in enumerate(texts) if t]
    out: list[list[int]] = [[] for _ in texts]
    spans: list[list[dict]] | None = [[] for _ in texts] if offsets else None
    if not present:
        return out, spans
    joined, starts, seps = token_starts([texts[i] for i in present])
    bounds = np.searchsorted(starts, seps)
    cuts = starts.tolist()
    get, cached = merge.cache.get, merge
    for k, i in enumerate(present):
        first, last = int(bounds[k]) + 1, int(bounds[k + 1])
        ids: list[int] = []
        edge = cuts[first:last] + [int(seps[k + 1])]
        marks = []
        for a, b in zip(edge, edge[1:]):
            piece = joined[a:b]
            got = get(piece)
            if got is None:
                got = cached(piece)
            ids.extend(got)
            if offsets:
                marks.append({"start": a - int(seps[k]) - 1, "n_ids": len(got)})
        out[i] = ids
        if spans is not None:
            spans[i] = marks
    return out, spans


@lru_cache(2)
def _bytes_of(path: str) -> dict[int, bytes]:
    return {v: k for k, v in merger(path).ranks.items()}


def decode(ids: list[int], path: str = DEFAULT_VOCABULARY) -> str:
    back = _bytes_of(path)
    return b"".join(back[i] for i in ids).decode("utf-8", "replace")


def encode(df: DataFrame, id_col: str, text_col: str, path: str = DEFAULT_VOCABULARY, offsets: bool = False) -> DataFrame:
    """(id, ids[, spans]) of every row; map-only. ``path`` must be readable on every executor."""
    if not os.path.exists(path):
        raise FileNotFoundError(path)

    def batch(ids, texts):
        out = {"id": [], "ids": [], "spans": []}
        held: list[str | None] = []
        rows, size = [], 0

        def flush():
            got, spans = encode_batch(held, path, offsets)
            out["id"].extend(rows)
            out["ids"].extend(got)
            out["spans"].extend(spans if offsets else ())

        for i, t in zip(ids, texts):
            rows.append(i)
            held.append(t)
            size += len(t or "")
            if size > 2_000_000:
                flush()
                held, rows, size = [], [], 0
        if rows:
            flush()
        return out if offsets else {"id": out["id"], "ids": out["ids"]}

    schema = "id bigint, ids array<int>" + (", spans array<struct<start:int,n_ids:int>>" if offsets else "")
    return map_columns(df, [id_col, text_col], batch, schema)


def p8_ids(documents: DataFrame, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    return encode(documents, "doc_id", "text", path).withColumnRenamed("id", "doc_id")


def p8_pieces(documents: DataFrame, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, spans): where each pre-token begins in the text and how many ids it has."""
    return encode(documents, "doc_id", "text", path, offsets=True).select(F.col("id").alias("doc_id"), "spans")


def p8_decoded(documents: DataFrame, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, text_md5): digest of each text put together again from its ids; null and empty texts have none, which read as empty text."""
    back = map_columns(p8_ids(documents, path), ["doc_id", "ids"], lambda docs, ids: {"doc_id": docs, "text": [decode(i, path) for i in ids]}, "doc_id bigint, text string")
    return back.select("doc_id", F.md5("text").alias("text_md5"))
