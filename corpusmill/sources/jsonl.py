"""Line files: order-keyed reading, strict JSON per line, and the error policies of the tools that read them.

Every policy says what happens to a blank line, an invalid line, a missing field and a value of another type:
``skip`` leaves the line out, ``fail`` ends the read with an error, ``empty`` puts empty text, ``keep`` keeps the line as it is.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import textfn
from corpusmill.runtime import map_columns


@dataclass(frozen=True)
class Policy:
    blank: str = "skip"
    invalid: str = "skip"
    missing: str = "skip"
    wrong_type: str = "skip"


# How each kind of reader treats odd lines.
POLICIES = {
    "unique_merge": Policy("skip", "skip", "empty", "fail"),
    "content_extract": Policy("skip", "skip", "skip", "fail"),
    "short_fim": Policy("skip", "fail", "skip", "fail"),
    "long_fim": Policy("skip", "skip", "skip", "skip"),
    "import_mover": Policy("skip", "skip", "skip", "skip"),
    "chat_reformat": Policy("skip", "skip", "empty", "skip"),
    "persona_builder": Policy("skip", "skip", "skip", "fail"),
    "code_blocks": Policy("fail", "fail", "skip", "fail"),
    "plain_merge": Policy("skip", "skip", "keep", "keep"),
    "spacing": Policy("skip", "skip", "keep", "keep"),
    "dialogue": Policy("keep", "keep", "empty", "keep"),
}


def lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """(file, line_no, value): lines with their place. Files are ordered by name, lines by position (counted from 0).

    Spark's text reader keeps a file's order within each split; splits are ordered by their offset.
    """
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths))
    placed = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__id"), "value")
    firsts = placed.groupBy("file", "__at").agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("file").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(firsts.withColumn("__before", before), ["file", "__at"]).select("file", (F.col("__before") + F.col("__id") - F.col("__first")).alias("line_no"), "value")


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the paths that exist, in any file system Spark knows."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            out.append(p)
    return out


def records(df: DataFrame, fields: Sequence[str], policy: Policy = Policy(), value: str = "value", key: str = "line_no") -> DataFrame:
    """(key, fields..., value): text fields of JSON lines under a policy. An explicit null stays null, a missing field doesn't count as null.

    JSON is read as Python reads it: NaN and repeated names are accepted, anything after the value is not.
    """

    def batch(keys, values):
        out: dict[str, list] = {"k": [], **{f: [] for f in fields}, "raw": [], "problem": []}
        for k, v in zip(keys, values):
            problem, row = None, dict.fromkeys(fields)
            if v is None or not v.strip():
                problem = f"{policy.blank}:blank line"
            else:
                try:
                    data = json.loads(v)
                    if not isinstance(data, dict):
                        problem = f"{policy.wrong_type}:not an object"
                    else:
                        for f in fields:
                            if f not in data:
                                if policy.missing == "empty":
                                    row[f] = ""
                                else:
                                    problem = f"{policy.missing}:no {f}"
                            elif data[f] is None or isinstance(data[f], str):
                                row[f] = data[f]
                            else:
                                problem = f"{policy.wrong_type}:{f} is no text"
                except (ValueError, RecursionError):
                    problem = f"{policy.invalid}:invalid JSON"
            action = (problem or "").partition(":")[0]
            if action == "skip":
                continue
            if action == "fail":
                raise ValueError(f"line {k}: {problem.partition(':')[2]}")
            for name, x in zip(out, (k, *(row[f] for f in fields), v, None if problem is None else problem.partition(":")[2])):
                out[name].append(x)
        return out

    schema = "k bigint, " + "".join(f"`{f}` string, " for f in fields) + "raw string, problem string"
    out = map_columns(df, [key, value], batch, schema)
    return out.select(F.col("k").alias(key), *fields, F.col("raw").alias(value), "problem")


def valid_lines(df: DataFrame, value: str = "value", key: str = "line_no") -> DataFrame:
    """Lines that hold one JSON value, unchanged byte for byte."""

    def batch(keys, values):
        out = {"k": [], "raw": []}
        for k, v in zip(keys, values):
            try:
                json.loads(v or "")
            except (ValueError, RecursionError):
                continue
            out["k"].append(k)
            out["raw"].append(v)
        return out

    return map_columns(df, [key, value], batch, "k bigint, raw string").select(F.col("k").alias(key), F.col("raw").alias(value))


def personas(spark: SparkSession, path: str) -> DataFrame:
    """(persona): the objects under ``personas`` of one JSON document, as maps of text; none where the key is missing."""
    schema = T.StructType([T.StructField("personas", T.ArrayType(T.MapType(T.StringType(), T.StringType())))])
    return spark.read.schema(schema).json(path, multiLine=True).select(F.explode("personas").alias("persona"))


def processed_log(spark: SparkSession, path: str) -> DataFrame:
    """(id): distinct stripped lines of a log of ids; a missing log is empty."""
    if not existing(spark, [path]):
        return spark.createDataFrame([], "id string")
    return spark.read.text(path).select(textfn.py_strip("value").alias("id")).where("id <> ''").distinct()


def documents(spark: SparkSession, path: str, fmt: str = "parquet", where: str | None = None, limit: int = 0, drop: Sequence[str] = ("_id",)) -> DataFrame:
    """Documents of a collection: filter and limit reach the source, errors are raised, not swallowed."""
    df = spark.read.format(fmt).load(path)
    if where:
        df = df.where(where)
    return (df.limit(limit) if limit else df).drop(*drop)
