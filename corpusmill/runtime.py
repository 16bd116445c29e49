"""Session helpers shared by all operators: table access, cut lineage, Arrow-batch mapping."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``. Only on one machine (local mode) may it be unset; a temporary folder
    serves there."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusmill-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; what is written there is removed by ``release`` or when the driver ends."""
    if not _written:
        atexit.register(release, spark)
    path = f"{shared_dir(spark)}/corpusmill-{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage so that a lost executor costs a re-read, not a re-computation, and lets later readers prune columns. The
    table is removed by ``release`` or when the driver ends.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove all tables that were written so far; results that still read them must have been written or shown."""
    while _written:
        _remove(spark, _written.pop())


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM may be gone already; the folder belongs to the session's checkpoint area
        pass


def map_columns(
    df: DataFrame, columns: list[str], fn: Callable[..., dict[str, Any]], schema: str
) -> DataFrame:
    """Run ``fn(*python lists of columns) -> {output column: list}`` over Arrow batches of ``df``; a batch may change its row count."""
    arrow_schema = _arrow(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        gc.set_threshold(200_000, 20, 100)  # syntax trees are acyclic: the cyclic collector only costs time here
        for batch in batches:
            out = fn(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))
            arrays = [pa.array(out[f.name], type=f.type) for f in arrow_schema]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    return df.select(*columns).mapInArrow(run, schema)


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    struct = StructType.fromDDL(ddl)
    return to_arrow_schema(struct)
