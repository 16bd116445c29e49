"""Incremental instruction building over a folder of documents as a stream: new files become batches, each written once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpusmill.operators.instruct import CompletionProvider, OfflineProvider, function_instructions, processed_ids, unprocessed
from corpusmill.sources.sinks import batch_ids, is_committed, write_batch


def build_instructions(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    checkpoint: str,
    key: str = "doc_id",
    content: str = "content",
    make: Callable[[], CompletionProvider] = OfflineProvider,
    files_per_batch: int = 100,
    mark_failed: bool = False,
) -> StreamingQuery:
    """Records of documents that no earlier batch holds; ends once all present files are done and goes on from there next time.

    The checkpoint replays an unfinished batch under its old number. Where the sink has committed that batch already the replay does
    nothing; where it broke off, none of its ids count as processed and it is written anew. So no record is lost or doubled.
    """
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def each(batch: DataFrame, batch_id: int) -> None:
        if is_committed(batch.sparkSession, target, batch_id):
            return
        done = batch_ids(batch.sparkSession, target)
        fresh = unprocessed(batch.dropDuplicates([key]), done, key).persist()
        records = function_instructions(fresh, key, content, make).persist()
        write_batch(records, processed_ids(fresh, records.select(key).distinct(), key, content, mark_failed), target, batch_id)
        records.unpersist()
        fresh.unpersist()

    return docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
