"""Structured Streaming: landed files in micro-batches, state upserted per batch.

The checkpoint takes the place of a hand-kept offset file; a batch that is run again
gives the same state, because marking a date twice changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docket.operators.incremental import mark_seen


def landed(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", per_batch: int = 10, newest_first: bool = False, glob: str = "*") -> DataFrame:
    """A stream of landed files, at most so many per batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_batch).option("pathGlobFilter", glob)
    return reader.option("latestFirst", str(newest_first).lower()).load(path)


def drained(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process everything that has landed, batch by batch, then stop."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def seen_store(folder: str) -> Callable[[DataFrame, int], None]:
    """Append each batch's (committee_slug, date) to the folder, once per batch number."""

    def each(batch: DataFrame, number: int) -> None:
        batch.select("committee_slug", "date").distinct().write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return each


def load_seen_store(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.schema("committee_slug string, date string, batch int").parquet(folder)
    return mark_seen(rows.limit(0), rows)


def scratch(folder: str) -> str:
    return f"{folder}/stream-{uuid.uuid4().hex}"
