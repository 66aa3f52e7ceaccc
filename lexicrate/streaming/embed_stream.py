"""Incremental, restartable embedding of a growing folder of documents (IO5).

Structured Streaming file source -> ``foreachBatch`` running the batch
embedding job (E4) on each micro-batch.  Each document is embedded from its
own chunks only, so no streaming state is needed.  ``foreachBatch`` is
at-least-once, so every batch overwrites its own output folder
(``batch_id=<n>``): a replayed batch rewrites the same files instead of
duplicating rows.  The checkpoint folder is the resume point.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lexicrate.operators.embed import embed_documents


def start_embedding_stream(spark: SparkSession, source_dir: str, schema: StructType, out_dir: str,
                           checkpoint_dir: str, *, id_col: str, text_col: str,
                           files_per_batch: int | None = None):
    """Start the stream with ``trigger(availableNow=True)``: process what is
    there now, in batches of ``files_per_batch`` files (unset: Spark's choice), then
    stop.  Returns the StreamingQuery."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir)

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        emb = embed_documents(batch, id_col, text_col)
        emb.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={batch_id}"))

    return (stream.writeStream.foreachBatch(run_batch)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


def run_to_completion(spark: SparkSession, source_dir: str, schema: StructType, out_dir: str,
                      checkpoint_dir: str, *, id_col: str, text_col: str, files_per_batch: int | None = None) -> None:
    q = start_embedding_stream(spark, source_dir, schema, out_dir, checkpoint_dir,
                               id_col=id_col, text_col=text_col, files_per_batch=files_per_batch)
    q.awaitTermination()  # an available-now query ends by itself
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
