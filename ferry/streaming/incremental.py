"""The load job (J1) fed by Structured Streaming: files arriving in a source folder are copied
as they come, under the same value rules, names and row id, with a per-batch count check (K8).

The reference copies whole tables in batch only; this is the same pipeline with a streaming
file source, not an additional operator. Each micro-batch is written to its own
``batch=<id>`` folder with overwrite, so a replayed batch (after a failure, foreachBatch is
at-least-once) replaces its own output instead of duplicating rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions import text as X
from ferry.functions.names import column_mapping
from ferry.functions.normalise import normalise
from ferry.session import run_dir
from ferry.sources.writers import add_row_id


def stream_copy(spark: SparkSession, source_path: str, schema: T.StructType, target_path: str,
                checkpoint_location: str | None = None, fmt: str = "parquet",
                max_chars: int = X.TARGET_TEXT_CHARS, available_now: bool = True) -> list[dict]:
    """Copy everything present under ``source_path`` (and, with ``available_now=False``, keep
    copying new files); returns one record per processed batch: batch id, rows in, rows written."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_path)
    text = normalise(stream, "load", max_chars)
    mapping = column_mapping(text.columns)
    renamed = text.toDF(*[mapping[c] for c in text.columns])
    log: list[dict] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        obs = Observation(f"ferry_batch_{batch_id}")
        out = add_row_id(batch).observe(obs, F.count(F.lit(1)).alias("rows"))
        path = f"{target_path}/batch={batch_id}"
        out.write.mode("overwrite").parquet(path)
        written = spark.read.parquet(path).count()
        log.append({"batch_id": batch_id, "rows_in": int(obs.get["rows"]), "rows_written": written})

    writer = renamed.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_location or run_dir(spark, "stream-checkpoint"))
    query = (writer.trigger(availableNow=True) if available_now else writer).start()
    if available_now:
        query.awaitTermination()
    return log
