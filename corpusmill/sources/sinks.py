"""Sinks: JSON lines, tables, text, and batches with their log of processed ids.

Defined results: an empty frame writes no part that a reader would see as a row; nulls are written as explicit nulls; a batch's
records and ids are read only once the batch's commit mark, written after both, is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources.jsonl import existing


def ascii_json(line: Column) -> Column:
    """A JSON text with every character beyond ASCII as ``\\uXXXX``, those beyond sixteen bits as two of them."""
    units = F.hex(F.encode(line, "UTF-16BE"))
    unit = lambda i: F.substring(units, i * 4 + 1, F.lit(4))
    shown = lambda u: F.when(u < "0080", F.chr(F.conv(u, 16, 10).cast("int"))).otherwise(F.concat(F.lit("\\u"), F.lower(u)))
    escaped = F.array_join(F.transform(F.sequence(F.lit(0), (F.length(units) / 4).cast("int") - 1), lambda i: shown(unit(i))), "")
    return F.when(line.rlike("[^\\x00-\\x7F]"), escaped).otherwise(line)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", single_order: str | None = None, ascii_only: bool = False) -> None:
    """JSON lines with nulls kept. ``single_order`` sorts rows by range before the write, so that files follow the order; ``ascii_only``
    escapes all other characters."""
    out = df.repartitionByRange(single_order).sortWithinPartitions(single_order) if single_order else df
    if ascii_only:
        line = F.to_json(F.struct(*out.columns), {"ignoreNullFields": "false"})
        out.select(ascii_json(line).alias("value")).write.mode(mode).text(path)
        return
    out.write.mode(mode).option("ignoreNullFields", "false").json(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = {f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(floats) if floats else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", drop: tuple[str, ...] = ("_id",)) -> None:
    """Append to a collection: without its internal id, NaN as null; nothing happens for an empty frame."""
    out = nan_to_null(df.drop(*drop))
    if not out.isEmpty():
        out.write.mode(mode).format(fmt).save(path)


def write_text(df: DataFrame, path: str, value: str = "value", mode: str = "overwrite") -> None:
    """One text per row, whose own line feeds end it."""
    df.select(F.col(value).alias("value")).write.mode(mode).text(path)


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed batches: one mark per batch ever written."""
    if not existing(spark, [f"{path}/commits"]):
        return []
    marks = spark.read.schema("batch bigint").option("recursiveFileLookup", "true").json(f"{path}/commits")
    return sorted(r[0] for r in marks.where("batch IS NOT NULL").distinct().collect())


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    return batch_id in _batches(spark, path)


def write_batch(records: DataFrame, ids: DataFrame, path: str, batch_id: int) -> None:
    """A batch's records and processed ids, then its commit mark. A batch that is committed already stays as it is; one that broke
    off before its mark was never read and is written anew."""
    spark = records.sparkSession
    if is_committed(spark, path, batch_id):
        return
    records.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/records/batch={batch_id}")
    ids.select(F.col(ids.columns[0]).cast("string").alias("id")).write.mode("overwrite").json(f"{path}/ids/batch={batch_id}")
    spark.range(1).select(F.lit(batch_id).cast("long").alias("batch")).coalesce(1).write.mode("overwrite").json(f"{path}/commits/batch={batch_id}")


def _committed(spark: SparkSession, path: str, what: str, schema: str) -> DataFrame:
    folders = existing(spark, [f"{path}/{what}/batch={b}" for b in _batches(spark, path)])
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folders)


def batch_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id): ids of all committed batches."""
    return _committed(spark, path, "ids", "id string").where("id IS NOT NULL").distinct()


def batch_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of all committed batches."""
    return _committed(spark, path, "records", schema)
