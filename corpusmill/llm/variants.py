"""Problem 2: duplicates hidden by formatting differences.

A row's canonical bytes are its letters and digits, case-folded; for .json files that are valid JSON and for .env files a second
form puts the fields of any object, or the lines, in order. The canonical bytes are read as digits that double in width (2, 2, 4, 8,
16, 32, 64 ... bytes); a bucket of equal leading digits that holds too many rows is split by its next digit, and only that bucket,
until each fits. Then each bucket counts its keys in a trie whose terminals hold count and smallest id. Raw and ordered forms go
through the same counting, and groups are the connected components over both relations.

Digits of up to 16 bytes are the bytes themselves; wider ones travel as their 128-bit BLAKE2b fingerprint, so that kilobytes of equal
openings need few digits and texts stay out of the shuffle.

Defined results: null contents and contents without letter and digit belong to no group; identical contents count as copies; a
row that is alone is a group of one; an empty table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.joins import skew_safe_join
from corpusmill.runtime import map_columns, materialize

#: Canonical bytes that are digits as they are (2, 2, 4, 8 and 16 of them), bytes of a wider digit's fingerprint.
PLAIN_BYTES = 32
DIGIT_BYTES = 16
#: Rows that a bucket may hold without being split; never less than a ``1 / MOST_SPLITS`` of all rows, so that fewer buckets than
#: ``MOST_SPLITS`` are ever split at one level and their list can be broadcast.
BUCKET_ROWS = 20_000
MOST_SPLITS = 50_000
_NOISE = re.compile(r"[\W_]+")


def plain(text: str) -> str:
    """Letters and digits of a text, case-folded."""
    return _NOISE.sub("", text.casefold())


def _sorted_json(value) -> str:
    if isinstance(value, _Fields):
        return "".join(sorted(plain(k) + "\0" + _sorted_json(v) for k, v in value.items))
    if isinstance(value, list):
        return "".join(map(_sorted_json, value))
    if value is None or isinstance(value, bool):
        return {None: "null", True: "true", False: "false"}[value]
    return plain(str(value))


class _Fields:
    """An object's members in written order; repeated names stay."""

    def __init__(self, items: list) -> None:
        self.items = items


_DECODER = json.JSONDecoder(object_pairs_hook=_Fields, parse_int=str, parse_float=str, parse_constant=str)


def ordered(ext: str | None, text: str) -> str | None:
    """The form in which a file's own order of fields (.json) or lines (.env) doesn't matter, or None where order matters."""
    if ext == "json":
        try:
            return "json\0" + _sorted_json(_DECODER.decode(text))
        except (ValueError, RecursionError):
            return None
    if ext == "env":
        return "env\0" + "\0".join(sorted(p for x in text.splitlines() if (p := plain(x))))
    return None


def key(form: str) -> bytes:
    """The digits of a form's canonical bytes. A last digit that is no wider than a fingerprint's bytes less one stands as it is, so
    its length tells both apart."""
    data = form.encode("utf-8", "surrogatepass")
    out, at = [data[:PLAIN_BYTES]], PLAIN_BYTES
    while at < len(data):
        digit = data[at : 2 * at]
        out.append(digit if len(digit) < DIGIT_BYTES else hashlib.blake2b(digit, digest_size=DIGIT_BYTES).digest())
        at *= 2
    return b"".join(out)


def prefix_bytes(level: int) -> int:
    """Bytes of a key that its first ``level`` digits take."""
    plain_levels = PLAIN_BYTES.bit_length() - 1
    return 2**level if level <= plain_levels else PLAIN_BYTES + DIGIT_BYTES * (level - plain_levels)


def keyed(docs: DataFrame, id_col: str = "file_id", path_col: str = "file_path", text_col: str = "content") -> DataFrame:
    """(id, raw, ord): canonical keys of each row that has a letter or digit; map-only."""

    def batch(ids, exts, texts):
        out = {"id": [], "raw": [], "ord": []}
        for i, ext, t in zip(ids, exts, texts):
            if t and (p := plain(t)):
                o = ordered(ext, t)
                out["id"].append(i)
                out["raw"].append(key(p))
                out["ord"].append(None if o is None else key(o))
        return out

    ext = F.when(F.col(path_col).contains("."), F.lower(F.substring_index(F.col(path_col), ".", -1)))
    src = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), ext.alias("__ext"), F.col(text_col).alias("__text"))
    return map_columns(src, src.columns, batch, "id bigint, raw binary, ord binary")


class Trie:
    """A byte trie with path compression: a node keeps one lone key as it is and branches only when a second key arrives.

    ``children[byte]`` is a nested dict or a terminal ``[key, count, smallest id]``.
    """

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, k: bytes, count: int, least: int) -> None:
        node, depth = self.root, 0
        while True:
            b = k[depth] if depth < len(k) else -1
            child = node.get(b)
            if child is None:
                node[b] = [k, count, least]
                return
            if isinstance(child, dict):
                node, depth = child, depth + 1
                continue
            if child[0] == k:
                child[1] += count
                child[2] = min(child[2], least)
                return
            other = child[0]
            node[b] = {(other[depth + 1] if depth + 1 < len(other) else -1): child}
            node, depth = node[b], depth + 1

    def terminals(self):
        stack = [self.root]
        while stack:
            for child in stack.pop().values():
                if isinstance(child, dict):
                    stack.append(child)
                else:
                    yield child


GROUP = "k binary, n bigint, least bigint"
#: Rows that a task combines before it hands them on.
COMBINE_ROWS = 250_000


def _counted(trie: Trie) -> pa.RecordBatch:
    rows = list(trie.terminals())
    return pa.RecordBatch.from_pydict({"k": pa.array([r[0] for r in rows], pa.binary()), "n": pa.array([r[1] for r in rows], pa.int64()), "least": pa.array([r[2] for r in rows], pa.int64())})


def _combine(batches):
    """Copies within a task meet before anything is shuffled: a key with a third of all rows leaves a task once per ``COMBINE_ROWS``."""
    trie, held = Trie(), 0
    for batch in batches:
        for k, n, least in zip(*(batch.column(c).to_pylist() for c in ("k", "n", "least"))):
            trie.add(k, n, least)
        held += batch.num_rows
        if held >= COMBINE_ROWS:
            yield _counted(trie)
            trie, held = Trie(), 0
    if held:
        yield _counted(trie)


def _count_buckets(batches):
    """A trie per bucket. Rows come sorted by bucket, so one bucket is in memory at a time."""
    trie, current, held = Trie(), None, False
    for batch in batches:
        for bucket, k, n, least in zip(*(batch.column(c).to_pylist() for c in ("bucket", "k", "n", "least"))):
            if bucket != current:
                if held:
                    yield _counted(trie)
                trie, current = Trie(), bucket
            trie.add(k, n, least)
            held = True
    if held:
        yield _counted(trie)


def buckets(combined: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``combined`` with ``bucket``, the leading digits by which each row's bucket is told apart: as many as it takes until at most
    ``bucket_rows`` rows share them, or all of a key.

    A level counts only the rows of buckets that the level before found too large. A bucket is too large only if it has further
    digits: rows that share a whole key are combined, one key is one terminal however many they are.
    """
    most = max(bucket_rows, combined.count() // MOST_SPLITS)
    live, level = combined, 0
    depth = F.lit(0)
    placed = combined
    while True:
        level += 1
        head = F.substring("k", 1, prefix_bytes(level))
        sizes = live.where(F.length("k") > prefix_bytes(level)).groupBy(head.alias("__p")).agg(F.count("*").alias("__m"))
        full = materialize(sizes.where(F.col("__m") > most).select("__p"), "full")
        if full.isEmpty():
            break
        live = live.join(F.broadcast(full), head == F.col("__p"), "left_semi")
        flag = f"__l{level}"
        placed = placed.join(F.broadcast(full.select(F.col("__p").alias(flag))), head == F.col(flag), "left")
        depth = depth + F.col(flag).isNotNull().cast("int")
    width = F.element_at(F.array(*(F.lit(prefix_bytes(i + 1)) for i in range(level))), depth + 1)
    return placed.select(*combined.columns, F.col("k").substr(F.lit(1), width).alias("bucket"))


def radix_count(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(k, n, least) of each distinct key, by recursive radix partitioning and a trie per bucket. Buckets of one task are counted one
    after another."""
    combined = materialize(rows.mapInArrow(_combine, GROUP), "radix")
    tasks = max(-(-combined.count() // (4 * bucket_rows)), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return buckets(combined, bucket_rows).repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_count_buckets, GROUP)


def components(links: DataFrame) -> DataFrame:
    """(v, root) of each vertex of ``links`` (v, root): the smallest vertex of its connected component.

    Each round every vertex takes the smallest label around it and then the label of that label, so the rounds grow with the logarithm
    of the longest chain.
    """
    links = materialize(links, "stars")
    if links.isEmpty():
        return links
    both = materialize(links.unionByName(links.select(F.col("root").alias("v"), F.col("v").alias("root"))).distinct(), "links")
    labels = materialize(both.groupBy("v").agg(F.least(F.col("v"), F.min("root")).alias("root")), "labels")
    while True:
        around = skew_safe_join(both.select("v", F.col("root").alias("__o")), labels.select(F.col("v").alias("__o"), "root"), "__o").groupBy("v").agg(F.min("root").alias("__near"))
        nearer = materialize(labels.join(around, "v").select("v", F.col("root").alias("__was"), F.least("root", "__near").alias("__via")), "nearer")
        further = labels.select(F.col("v").alias("__via"), F.col("root").alias("__far"))
        jumped = materialize(skew_safe_join(nearer, further, "__via").select("v", "__was", F.least("__via", "__far").alias("root")), "jumped")
        labels = jumped.select("v", "root")
        if jumped.where("root <> __was").isEmpty():
            return labels


def groups(keys: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(raw, n, keep_id, several): each distinct raw key with its rows, its group's smallest id, and whether the group has several rows.

    Rows with equal raw keys are one group; so are rows with equal ordered keys, and whatever both relations connect.
    """
    one = F.lit(1).cast("long").alias("n")
    by_raw = materialize(radix_count(keys.select(F.col("raw").alias("k"), one, F.col("id").alias("least")), bucket_rows).withColumnRenamed("k", "raw"), "rawkeys")
    forms = materialize(keys.where(F.col("ord").isNotNull()).select("raw", "ord").distinct(), "forms")
    pairs = materialize(skew_safe_join(forms, by_raw.select("raw", F.col("least").alias("v")), "raw").select("ord", "v"), "pairs")
    stars = radix_count(pairs.select(F.col("ord").alias("k"), one, F.col("v").alias("least")), bucket_rows).where("n > 1")
    stars = materialize(stars.select(F.col("k").alias("ord"), F.col("least").alias("root")), "stars")
    links = skew_safe_join(pairs, stars, "ord").where("v <> root").select("v", "root")
    labels = components(links).select(F.col("v").alias("least"), "root")
    grouped = by_raw.join(labels, "least", "left")
    return grouped.select("raw", "n", F.coalesce("root", "least").alias("keep_id"), (F.col("root").isNotNull() | (F.col("n") > 1)).alias("several"))


def collapse(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(keep_id, copies): one row per group with the smallest id and its number of rows."""
    return groups(materialize(keyed(docs), "keys"), bucket_rows).groupBy("keep_id").agg(F.sum("n").alias("copies"))


def p2_found(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(keep_id, copy_id) of every row that isn't its group's first."""
    keys = materialize(keyed(docs), "keys")
    members = materialize(groups(keys, bucket_rows).where("several").select("raw", "keep_id"), "members")
    joined = skew_safe_join(keys.select("id", "raw"), members, "raw")
    return joined.where(F.col("id") != F.col("keep_id")).select("keep_id", F.col("id").alias("copy_id"))
